from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from rowsift.llm import sharding as s


def by_lists(shards, slots):
    """The table from whole preference lists, claimed in turns."""
    prefer = []
    for name in shards:
        start, step = s._number(f"offset:{name}") % slots, s._number(f"skip:{name}") % (slots - 1) + 1
        prefer.append([(start + k * step) % slots for k in range(slots)])
    assert all(sorted(p) == list(range(slots)) for p in prefer)
    table = {}
    while len(table) < slots:
        for i, p in enumerate(prefer):
            if len(table) < slots:
                table[next(x for x in p if x not in table)] = i
    return [table[k] for k in range(slots)]


@pytest.mark.parametrize("n,slots", [(1, 7), (3, 31), (7, 101)])
def test_table_against_preference_lists(n, slots):
    names = s.default_shards(n)
    assert s.lookup_table(names, slots=slots) == by_lists(names, slots)


def test_shares_and_weights():
    counts = Counter(s.lookup_table(s.default_shards()))
    assert max(counts.values()) - min(counts.values()) <= 1
    counts = Counter(s.lookup_table(["a", "b", "c"], [2, 1, 0], 1009))
    assert counts[2] == 0 and abs(counts[0] - 2 * counts[1]) <= 2


def test_losing_a_shard_moves_little():
    names = s.default_shards(20)
    before, after = s.lookup_table(names, slots=10_007), s.lookup_table(names[:-1], slots=10_007)
    moved = sum(a != b for a, b in zip(before, after, strict=True) if a != 19)
    assert moved < 0.15 * 10_007


def test_bad_parameters():
    for bad in ({"slots": 100}, {"weights": [0.0, 0.0]}, {"weights": [1.0]}):
        with pytest.raises(ValueError):
            s.lookup_table(["a", "b"], **bad)
    with pytest.raises(ValueError):
        s.lookup_table(["a", "a"])


def test_placement(spark, awkward, nothing, tmp_path):
    placed = s.place(awkward)
    assert placed.columns == [*awkward.columns, "_slot", "shard"]
    rows = placed.collect()
    assert len(rows) == 11 and all(r.shard for r in rows)
    assert len({r.shard for r in rows if r.doc_id == 3}) == 1
    assert s.place(nothing).count() == 0
    table = s.lookup_table(s.default_shards())
    for r in s.place(spark.range(50).withColumnRenamed("id", "doc_id")).collect():
        assert r.slot == s._number(str(r.doc_id)) % s.SLOTS
        assert r.shard == s.default_shards()[table[r.slot]]
    out = str(tmp_path / "shards")
    s.write_shards(spark.range(500).withColumnRenamed("id", "doc_id"), out, shards=["x", "y"])
    back = spark.read.parquet(out)
    assert back.count() == 500 and {r[0] for r in back.select("shard").distinct().collect()} == {"x", "y"}


def test_query_against_the_rule(spark):
    from rowsift.llm.queries import op6_sharding

    got = op6_sharding(spark, "/root/testdata/sf0.001")
    assert got.filter(F.col("slot") >= s.SLOTS).count() == 0
    assert got.count() == spark.read.parquet("/root/testdata/sf0.001/documents.parquet").count()
