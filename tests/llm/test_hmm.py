from __future__ import annotations

import itertools
import math
import random
import zlib
from collections import Counter

import numpy as np

from rowsift.llm import hmm as h


def model_of(rng, states, classes):
    return h.Hmm(
        h._normal(rng.random(states), 0), h._normal(rng.random((states, states)), 1), h._normal(rng.random((classes, states)), 0)
    )


def all_paths(m, seq):
    states = len(m.start)
    total, starts, steps, emits = 0.0, np.zeros(states), np.zeros((states, states)), np.zeros(m.emit.shape)
    for path in itertools.product(range(states), repeat=len(seq)):
        p = m.start[path[0]] * m.emit[seq[0], path[0]]
        for i in range(1, len(seq)):
            p *= m.step[path[i - 1], path[i]] * m.emit[seq[i], path[i]]
        total += p
        starts[path[0]] += p
        for i, s in enumerate(path):
            emits[seq[i], s] += p
            if i:
                steps[path[i - 1], s] += p
    return math.log(total), starts / total, steps / total, emits / total


def test_recursions_against_all_paths():
    rng = np.random.default_rng(0)
    m = model_of(rng, 3, 7)
    lengths = np.array([3, 1, 5, 2, 5])
    classes = rng.integers(0, 7, lengths.sum()).astype(np.uint16)
    at = np.r_[0, np.cumsum(lengths)]
    want = [all_paths(m, classes[a:b]) for a, b in itertools.pairwise(at)]
    for size in (1, 6, 1000):
        logs, sums = np.zeros(len(lengths)), None
        for part, seen, active in h.batches(classes, lengths, size):
            logs[part] = h.forward(m, seen, active, False)[0]
            found = h.expected_counts(m, seen, active)
            sums = found if sums is None else [a + b for a, b in zip(sums, found, strict=True)]
        assert np.allclose(logs, [w[0] for w in want])
        for k in range(3):
            assert np.allclose(sums[k], sum(w[k + 1] for w in want))


def some_rows(n, seed=3):
    rng = random.Random(seed)
    tongues = [[f"{x}{k}" for k in range(40)] for x in "ABc"]
    return [(i, " ".join(rng.choice(tongues[i % 3]) for _ in range(rng.randint(0, 60))) + ("\n" if i % 2 else "")) for i in range(n)]


def lower(text):
    return [w.lower() for w in (text or "").split()]


def base(rows):
    held = {i: i is not None and zlib.crc32(str(i).encode()) % 5 == 1 for i, _ in rows}
    counts = Counter(w for i, t in rows if not held[i] for w in [*lower(t), None])
    total = sum(counts.values())
    out = {}
    for i, t in rows:
        words = [*lower(t), None]
        out[i] = (held[i], len(words), sum(counts[w] > 0 for w in words), total, sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (len(counts) + 1))) for w in words))
    return out


def test_base_against_brute_force_and_gain(docs_of):
    rows = some_rows(400)
    want = base(rows)
    got = h.language_scores(docs_of(rows), states=3, block_tokens=500).collect()
    assert len(got) == len(rows)
    for r in got:
        w = want[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == w[:4]
        assert abs(r.base_score - w[4]) < 1e-6 * max(1, abs(w[4]))
    held = [r for r in got if r.held_out]
    # the tongues are states, so unseen documents become likelier
    assert sum(r.score for r in held) > 0.85 * sum(r.base_score for r in held)


def test_the_model_is_a_distribution(docs_of):
    """All texts of one word and the end, over known and unknown words, sum to less than one; classes sum to one."""
    docs = docs_of(some_rows(120, 5))
    packed = h.written(h.blocks(docs.select("doc_id", "text"), 400), "blocks")
    ends = sum(not x for r in packed.collect() for x in r.held)
    words = h._dictionaries(packed)
    lex = h.lexicon(words, ends)
    coded = h.written(h.encoded(packed, words, lex), "encoded")
    m = h.train(coded, lex, 3, 2)
    assert np.allclose(m.start.sum(), 1) and np.allclose(m.step.sum(axis=1), 1) and np.allclose(m.emit.sum(axis=0), 1)
    assert (m.emit > 0).all()
    # likelihood does not fall from one iteration to the next
    logs = []
    for k in range(3):
        scored = h.scored(coded, lex, h.train(coded, lex, 3, k)).filter("not held_out")
        logs.append(scored.agg({"score": "sum"}).first()[0])
    assert logs[0] <= logs[1] + 1e-6 <= logs[2] + 2e-6


def test_blocks_do_not_change_scores(docs_of):
    rows = some_rows(100, 9)
    one = {r.doc_id: r.score for r in h.language_scores(docs_of(rows), states=3).collect()}
    many = {r.doc_id: r.score for r in h.language_scores(docs_of(rows).repartition(5), states=3, block_tokens=50).collect()}
    assert all(abs(one[i] - many[i]) < 1e-6 * max(1, abs(one[i])) for i in one)


def test_awkward_rows(awkward, nothing, docs_of):
    rows = h.language_scores(awkward, states=2, iterations=1).collect()
    by_id = {r.doc_id: r for r in rows}
    assert len(rows) == 11 and by_id[1].n_tokens == by_id[2].n_tokens == by_id[6].n_tokens == 1
    assert not by_id[None].held_out and by_id[5].n_tokens == 60_001
    assert abs(by_id[3].score - by_id[None].score) < 1e-9
    assert all(math.isfinite(r.score) and math.isfinite(r.base_score) for r in rows)
    assert h.language_scores(nothing).count() == 0
    held = next(i for i in range(100) if h.is_held_out(i))
    alone = h.language_scores(docs_of([(held, "a b")])).collect()[0]
    assert alone.held_out and alone.train_tokens == 0 and alone.n_known == 0 and math.isfinite(alone.score)
