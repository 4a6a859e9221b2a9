from __future__ import annotations

from collections import Counter

import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from rowsift.llm import bpe, mixing
from rowsift.llm.common import written
from tests.llm import test_line_dedup, test_near_dup
from tools.check_oracle import compare, connect

SF = "/root/testdata/sf0.001"


def test_stages_take_effect_one_after_the_other(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    seen = [docs]
    for name, stage in corpus_pipeline.STAGES:
        seen.append(written(stage(spark, seen[-1], SF), name))
    assert all(d.columns == columns for d in seen[:-1])
    rows = [[(r.doc_id, r.text) for r in d.collect()] for d in seen[:-1]]
    start, ruled, cut, apart, mixed = rows
    assert set(ruled) <= set(start) and len(ruled) < len(start)
    # rules: labelled good documents of ten words or more stay
    good = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").filter("quality = 1").collect()}
    repeats = {i for i, t in start if len(t.split()) < 10}
    assert len(good - repeats - {i for i, _ in ruled}) <= 0.02 * len(good)
    # lines, near duplicates
    want = {r[0]: r[3] for r in test_line_dedup.brute(ruled)}
    import hashlib

    assert {i: hashlib.sha256(t.encode()).hexdigest() for i, t in cut} == want
    component = test_near_dup.brute(cut)
    assert sorted(apart) == sorted(r for r in cut if component[r[0]] == r[0])
    # mix: copies as decided
    decided = {r.doc_id: r.taken // r.size for r in mixing.mix_by_source(seen[3]).collect() if r.size}
    copies = Counter(i for i, _ in mixed)
    assert all(copies[i] == n for i, n in decided.items())
    # encoding: the library's counts
    library = Tokenizer.from_file(bpe.default_path())
    n = {i: len(library.encode(t, add_special_tokens=False).ids) for i, t in set(mixed)}
    assert Counter((r.doc_id, r.n_tokens) for r in seen[-1].collect()) == Counter((i, n[i]) for i, _ in mixed)
    again = {(r.doc_id, r.ids_sha256) for r in corpus_pipeline.run(spark, SF).collect()}
    assert again == {(r.doc_id, r.ids_sha256) for r in seen[-1].collect()}


@pytest.mark.parametrize("name", sorted(n for n in entry.oracle_sql() if n.startswith("op")))
def test_matches_sql(spark, name):
    ok, text = compare(spark, connect(SF), name, SF)
    assert ok, text


def test_all_are_registered():
    names = {n.split("_")[0] for n in entry.queries() if n.startswith("op")}
    assert names == {f"op{n}" for n in range(1, 11)} and "pipeline" in entry.queries()
