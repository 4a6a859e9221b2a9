from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from rowsift.llm import spelling as s


def is_near(u, v):
    if len(u) > len(v):
        u, v = v, u
    if len(u) == len(v):
        return sum(a != b for a, b in zip(u, v)) == 1
    return len(v) == len(u) + 1 and any(v[:i] + v[i + 1 :] == u for i in range(len(v)))


def near_map(words):
    return {(u, v) for u in words for v in words if u != v and is_near(u, v)}


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text("abc", max_size=6), max_size=12, unique=True))
def test_acceptor_accepts_its_strings_alone_and_is_minimal(strings):
    a = s.Acceptor(sorted(strings))

    def language(state):
        return ([""] if a.final[state] else []) + [c + r for c, to in a.arcs[state].items() for r in language(to)]

    assert sorted(language(a.start)) == sorted(strings)
    languages = [tuple(sorted(language(q))) for q in range(len(a.arcs))]
    assert len(set(languages)) == len(languages)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text("abc", min_size=4, max_size=4), max_size=10, unique=True), st.lists(st.text("abc", min_size=5, max_size=5), max_size=10, unique=True))
def test_composition(short, long):
    a, b = s.Acceptor(sorted(short)), s.Acceptor(sorted(long))
    assert set(s.Composition(a, a).replaced()) == {(u, v) for u, v in near_map(short) if u < v}
    assert set(s.Composition(a, b).inserted()) == {(u, v) for u in short for v in long if is_near(u, v)}


def brute(rows):
    counts = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'null' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    near = {w: [] for w in words}
    for u, v in near_map(words):
        near[u].append(v)
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 2 * n else None

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return sorted((w, form[w] or "", root(w), n, len(near[w]), words.get(form[w]) or 0) for w, n in words.items())


def rows_of(df):
    return sorted((r.word, r.form or "", r.root, r.n, r.n_near, r.form_n or 0) for r in df.collect())


def some_rows(n, seed):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcÄäé") for _ in range(rng.randint(4, 9))) for _ in range(40)]
    words += [w[:i] + rng.choice("abx") + w[i + rng.randint(0, 1) :] for w in words for i in (0, 2, len(w))]
    chain = "hubword " * 30 + "hubwordx " * 9 + "hubwordxy " * 4
    return [(i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 40))) + "×AB÷1") for i in range(n)] + [(n, chain)]


@pytest.mark.parametrize("limit", [s.PART_CHARS, 12])
def test_against_brute_force(docs_of, monkeypatch, limit):
    monkeypatch.setattr(s, "PART_CHARS", limit)
    rows = some_rows(120, 6)
    want = brute(rows)
    assert rows_of(s.variants(docs_of(rows))) == want
    assert any(r[1] for r in want) and any(r[2] not in (r[0], r[1]) for r in want)


def test_long_words_and_hot_beginnings(docs_of, monkeypatch):
    monkeypatch.setattr(s, "PART_CHARS", 60)
    long = "ab" * 5000
    words = [long, long[:4000] + "c" + long[4000:], long + "d", long[:-1] + "z"]
    words += ["commonstart" + x + y for x in "abcdefg" for y in "uvwxyz"]
    rows = [(i, " ".join(words)) for i in range(4)]
    assert rows_of(s.variants(docs_of(rows))) == brute(rows)


def test_awkward_and_empty_tables(awkward, nothing):
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    assert rows_of(s.variants(awkward)) == brute(rows)
    assert s.variants(nothing).count() == 0
