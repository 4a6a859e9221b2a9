from __future__ import annotations

import hashlib
import random

import numpy as np

from rowsift.llm import fingerprints as f


def plain_cuts(data: bytes):
    """Chunk ends by rolling over one byte at a time."""
    out, start, i = [], 0, 0
    while start < len(data):
        n = len(data) - start
        end = len(data)
        if n > f.LEAST:
            for size in range(f.LEAST, n + 1):
                h = 0
                for b in data[start + size - 16 : start + size]:
                    h = ((h << 1) + int(f._GEAR[b])) % 2**32
                mask = int(f.HARD) if size <= f.USUAL else int(f.EASY)
                if size == f.MOST or h & mask == 0:
                    end = start + size
                    break
        out.append(end)
        start = end
    return out


def text_of(seed, n):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 9))) for _ in range(n))


def test_cuts_against_a_rolling_hash():
    for seed, n in ((1, 0), (2, 1), (3, 3), (4, 40), (5, 700)):
        data = text_of(seed, n).encode()
        assert f.cuts(np.frombuffer(data, np.uint8)) == plain_cuts(data)


def test_insertion_moves_few_chunks():
    text = text_of(9, 3000)
    own, moved = f.chunks(f.fingerprint(text)), f.chunks(f.fingerprint("new words " + text[:4000] + "more" + text[4000:]))
    assert f.containment(own, moved) > 0.95
    assert f.containment(own, f.chunks(f.fingerprint(text_of(10, 3000)))) < 0.02


def brute(rows):
    out = {}
    for k, (i, t) in enumerate(rows):
        text, after = t or "", rows[(k + 1) % len(rows)][1] or ""
        tail = len(text) // 4
        edit = text[: len(text) - tail] + after[:tail]
        own, other, nxt = (f.fingerprint(x) for x in (text, edit, after))
        near = [f.containment(f.chunks(own), f.chunks(x)) for x in (other, nxt)]
        out[i] = (len(text), hashlib.sha256(edit.encode()).hexdigest(), own, other, *near)
    return out


def test_neighbours_over_many_ranges(docs_of):
    rows = [(i, None if i == 7 else text_of(i, i * 3 % 50)) for i in range(120)]
    docs = docs_of(random.Random(1).sample(rows, len(rows)))
    want = brute(rows)
    for size in (1 << 30, 900, 60):
        got = f.compare_with_edit(docs, range_bytes=size).collect()
        assert {r.doc_id: tuple(r)[1:] for r in got} == want


def test_awkward_rows(spark, awkward, nothing, docs_of):
    rows = f.compare_with_edit(awkward, range_bytes=1000).collect()
    assert len(rows) == 11
    prints = {r.doc_id: r for r in rows}
    assert prints[1].fingerprint == "" == prints[2].fingerprint and prints[1].near_next == 1.0
    assert prints[3].fingerprint == prints[4].fingerprint == prints[None].fingerprint != ""
    assert all(0 <= x <= 1 for r in rows for x in (r.near_edited, r.near_next))
    assert f.compare_with_edit(nothing).count() == 0
    alone = f.compare_with_edit(docs_of([(5, "only one text here, of some length")])).collect()
    assert len(alone) == 1 and alone[0].near_next == 1.0
    from pyspark.sql import functions as F

    assert f.with_fingerprint(awkward.withColumn("fingerprint", F.lit(0))).columns[-1] == "_fingerprint"
