from __future__ import annotations

import hashlib
import random
from collections import defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st

from rowsift.llm import line_dedup as d

SPACES = " \t\n\x0b\x0c\r"


def brute(rows, min_chars=d.MIN_CHARS, min_docs=d.MIN_DOCS):
    def key(line):
        k = "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(SPACES))
        return k if len(k) >= min_chars else None

    holders = defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            if i is not None and key(line):
                holders[key(line)].add(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not (i is not None and key(x) and len(holders[key(x)]) >= min_docs and max(holders[key(x)]) != i)]
        out.append((i, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


def rows_of(report):
    return sorted(((r.doc_id, r.n_lines, r.n_dropped, r.kept_sha256) for r in report.collect()), key=str)


def some_rows(n, seed):
    rng = random.Random(seed)
    lines = [f"{'Long Line Ä' * rng.randint(1, 6)} {k}" for k in range(25)] + ["", " ", "short"]
    return [(i, "\n".join(rng.choice(["", " ", "\t"]) + rng.choice(lines) for _ in range(rng.randint(1, 8)))) for i in range(n)]


def test_against_brute_force(docs_of):
    rows = some_rows(120, 3)
    docs = docs_of(rows)
    assert rows_of(d.line_report(docs, d.build_state(docs))) == brute(rows)


def test_exact_without_filters(docs_of, monkeypatch):
    monkeypatch.setattr(d, "FILTER_BYTES", -1)
    rows = some_rows(60, 5)
    docs = docs_of(rows)
    assert rows_of(d.line_report(docs, d.build_state(docs))) == brute(rows)


def test_many_shards(docs_of, monkeypatch):
    monkeypatch.setattr(d, "SHARD_KEYS", 2)
    rows = some_rows(80, 6)
    docs = docs_of(rows)
    state = d.build_state(docs)
    assert state.shards > 4
    assert rows_of(d.line_report(docs, state)) == brute(rows)


def test_adding_and_removing_is_reversible(docs_of):
    rows = some_rows(90, 8)
    first, rest = rows[:50], rows[50:]
    state = d.build_state(docs_of(first))
    more = d.add_documents(state, docs_of(rest))
    assert rows_of(d.line_report(docs_of(rows), more)) == brute(rows)
    # again the same documents: nothing new
    assert rows_of(d.line_report(docs_of(rows), d.add_documents(more, docs_of(rest)))) == brute(rows)
    back = d.remove_documents(more, docs_of(rest).select("doc_id"))
    assert rows_of(d.line_report(docs_of(first), back)) == brute(first)
    assert sorted(back.counts.collect()) == sorted(state.counts.collect())


@settings(max_examples=60, deadline=None)
@given(st.sets(st.binary(min_size=16, max_size=16), max_size=200), st.sets(st.binary(min_size=16, max_size=16), max_size=50))
def test_filter_holds_and_forgets(keys, others):
    keys, others = sorted(keys), sorted(others - keys)
    f = d.CuckooFilter.of(keys)
    assert f.contains(keys).all()
    before = f.contains(others).tolist()
    extra = [k for k, was in zip(others, before, strict=True) if not was and f.insert(k)]
    assert f.contains(extra).all() and f.contains(keys).all()
    assert all(f.delete(k) for k in extra)
    assert f.contains(keys).all()


def test_awkward_rows(awkward, nothing, docs_of):
    state = d.build_state(awkward, min_docs=2)
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    assert rows_of(d.line_report(awkward, state)) == brute(rows, min_docs=2)
    kept = d.drop_lines(awkward, state)
    assert kept.columns == awkward.columns and kept.count() == 11
    got = {r.doc_id: r for r in kept.collect()}
    assert got[1].text is None and got[1].n_chars is None
    assert got[4].text == "" and got[4].n_chars == 0 and got[9].text.count("\n") == 1
    assert got[None].text
    assert d.line_report(nothing, d.build_state(nothing)).count() == 0
