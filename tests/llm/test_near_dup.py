from __future__ import annotations

import random

import numpy as np
import pyarrow as pa

from rowsift.llm import graphs
from rowsift.llm import near_dup as n


def shingles(text):
    words = []
    for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in (text or "")).replace("\t", " ").replace("\n", " ").split(" "):
        w = w.strip("\x0b\x0c\r")
        if w:
            words.append(w)
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute(rows, percent=75):
    sets = [(i, shingles(t)) for i, t in rows if i is not None]
    up = {i: i for i, _ in sets}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for k, (a, x) in enumerate(sets):
        for b, y in sets[:k]:
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                p, q = sorted((find(a), find(b)))
                up[q] = p
    return {i: find(i) for i in up}


def check(docs, rows):
    got = n.near_duplicates(docs).collect()
    want, sizes = brute(rows), dict(rows)
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is not None:
            assert r.component_id == want[r.doc_id], r.doc_id
            assert r.kept == (r.doc_id == r.component_id)
            assert r.n_shingles == len(shingles(sizes[r.doc_id]))


def edited(rng, words, k):
    out = list(words)
    for _ in range(k):
        out[rng.randrange(len(out))] = f"e{rng.random()}"
    return " ".join(out)


def test_planted_copies_of_all_sizes(docs_of):
    rng = random.Random(2)
    rows, i = [], 0
    for size in (1, 3, 5, 6, 8, 12, 20, 40, 80, 300, 1500):
        base = [f"v{rng.randrange(400)}" for _ in range(size)]
        for k in range(14):
            # from untouched copies to texts about as far as the threshold
            rows.append((i, edited(rng, base, k * size // 160)))
            i += 1
    rng.shuffle(rows)
    check(docs_of(rows), rows)


def test_chain_and_hot_group(docs_of):
    rng = random.Random(5)
    base = [f"c{k}" for k in range(100)]
    # windows along a long text: neighbours are linked, ends are not
    text = [f"t{k}" for k in range(400)]
    rows = [(k, " ".join(text[6 * k : 6 * k + 100])) for k in range(45)]
    rows += [(100 + k, " ".join(base)) for k in range(150)]
    rows += [(300 + k, edited(rng, base, 2)) for k in range(150)]
    rows += [(600 + k, " ".join(base[:60]) + " " + " ".join(f"o{k}-{j}" for j in range(40))) for k in range(60)]
    check(docs_of(rows), rows)


def test_small_blocks_lose_no_link(docs_of, monkeypatch):
    monkeypatch.setattr(n, "BLOCK_SHINGLES", 200)
    monkeypatch.setattr(n, "BROADCAST_IDS", 3)
    rng = random.Random(7)
    base = [f"c{k}" for k in range(60)]
    rows = [(k, edited(rng, base, rng.randint(0, 6))) for k in range(150)]
    check(docs_of(rows), rows)


def test_estimate_is_near_the_truth():
    rng = np.random.default_rng(3)
    for share in (0.0, 0.3, 0.75, 0.95):
        both = rng.integers(0, 2**64, int(4000 * share), dtype=np.uint64)
        x, y = (np.unique(np.r_[both, rng.integers(0, 2**64, 4000 - len(both), dtype=np.uint64)]) for _ in range(2))
        truth = len(np.intersect1d(x, y)) / len(np.union1d(x, y))
        got, used = n.estimate(n.registers(x)[None], n.registers(y)[None])
        assert abs(got[0] - truth) < 0.13 and used[0] == n.REGISTERS


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(1, 80)] + [(200, 201), (201, 201)], "a long, b long")
    got = dict(graphs.components(links).collect())
    assert got == {k: 1 for k in range(1, 81)} | {200: 200, 201: 200}


def test_awkward_rows(spark, awkward, nothing, docs_of):
    rows = n.near_duplicates(awkward).collect()
    by_id = {r.doc_id: r for r in rows}
    assert len(rows) == 11 and by_id[None].component_id is None and by_id[None].kept
    assert by_id[3].component_id == by_id[4].component_id == 3 and not by_id[4].kept
    assert by_id[1].n_shingles == by_id[2].n_shingles == by_id[6].n_shingles == 0
    assert all(by_id[i].component_id == i for i in (1, 2, 5, 6, 7, 8))
    kept = n.keep_one(awkward)
    assert kept.columns == awkward.columns
    assert sorted((r.doc_id or 0) for r in kept.collect()) == sorted((r.doc_id or 0) for r in rows if r.kept)
    assert n.near_duplicates(nothing).count() == 0
    # one doc_id with two texts ties two groups together
    a, b = " ".join(f"a{k}" for k in range(30)), " ".join(f"b{k}" for k in range(30))
    tied = n.near_duplicates(docs_of([(1, a), (2, a), (2, b), (3, b)])).collect()
    assert {r.component_id for r in tied} == {1}


def family_block(texts, parts, own):
    sets = n.shingle_sets([t.encode() for t in texts])
    columns = {
        "own": pa.array(own, pa.int32()),
        "rep": pa.array(range(len(texts)), pa.int64()),
        "part": pa.array(parts, pa.int64()),
        "n": pa.array([len(s) for s in sets], pa.int64()),
        "regs": pa.array([n.registers(s).tobytes() for s in sets], pa.binary()),
        "hashes": pa.array([s.tobytes() for s in sets], pa.binary()),
    }
    return pa.table(columns), [set(s.tolist()) for s in sets]


def test_a_family_is_compared_without_meeting_pair_by_pair(monkeypatch):
    """Texts of one template, most of them just below the threshold: each pair used to be intersected on its own."""
    rng = random.Random(5)
    words = [f"w{k}" for k in range(150)]
    texts = [edited(rng, words, rng.choice([1, 2, 3, 6])) for _ in range(60)] + ["", "one two"]
    own = [k % 2 for k in range(len(texts))]
    monkeypatch.setattr(np, "intersect1d", None)
    for i, j in ((0, 1), (0, 0)):
        block, sets = family_block(texts, range(len(texts)), own if i != j else [0] * len(texts))
        links = n.links_across(block, i, j, 75)
        want = {(a, b) for b in range(len(texts)) for a in range(b) if (i == j or own[a] != own[b]) and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])}
        assert {(a, b) for a, b, _ in links} <= want and all(nb == max(len(sets[a]), len(sets[b])) for a, b, nb in links)

        def joined(pairs):
            up = list(range(len(texts)))
            for a, b in pairs:
                up = [up[a] if u == up[b] else u for u in up]
            return [min(k for k in range(len(up)) if up[k] == u) for u in up]

        assert joined((a, b) for a, b, _ in links) == joined(want) and len(links) < len(want)
