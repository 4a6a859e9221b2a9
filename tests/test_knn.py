from __future__ import annotations

import numpy as np
import pytest

from pyspark.sql import functions as F

from rowsift.functions.hashing import hash_uniform
from rowsift.functions.runtime import materialize
from rowsift.operators import knn
from rowsift.operators.knn import knn_edges, knn_regress, knn_vote, leave_one_out_probs


def brute(x, ids, k, q=None, qids=None):
    self_join = q is None
    q, qids = (x, ids) if self_join else (q, qids)
    out = set()
    for i in range(len(q)):
        d = np.round(np.sqrt(((x - q[i]) ** 2).sum(1)), 9)
        order = [j for j in np.lexsort((ids, d)) if not (self_join and j == i)][:k]
        out |= {(int(qids[i]), int(ids[j]), r + 1, float(d[j])) for r, j in enumerate(order)}
    return out


def frame(spark, x, ids):
    rows = [(int(i), [float(v) for v in r]) for i, r in zip(ids, x)]
    return spark.createDataFrame(rows, "row_id bigint, features array<double>")


SMALL = {"rows_per_cell": 20, "block_rows": 30, "visit_rows": 40}


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(0)
    return {
        "copies": np.vstack([np.zeros((150, 2)), rng.normal(size=(200, 2)).round(1)]),
        "clusters": np.vstack([rng.normal(c, 0.3, size=(120, 3)) for c in (0, 5, 20)]),
        "plain": rng.normal(size=(200, 8)),
    }


@pytest.mark.parametrize("name", ["copies", "clusters", "plain"])
@pytest.mark.parametrize("settings", [SMALL, {}], ids=["many_cells", "one_cell"])
def test_self_join(spark, data, name, settings):
    x = data[name]
    ids = np.random.default_rng(1).permutation(len(x)) + 100
    got = {tuple(r) for r in knn_edges(frame(spark, x, ids), 4, **settings).collect()}
    assert got == brute(x, ids, 4)


@pytest.mark.parametrize("settings", [SMALL, {}], ids=["many_cells", "one_cell"])
def test_queries_against_base(spark, data, settings):
    x, q = data["clusters"], data["copies"][100:200]
    q = np.hstack([q, np.zeros((len(q), 1))])
    ids, qids = np.arange(len(x)), np.arange(len(q)) + 5000
    got = {tuple(r) for r in knn_edges(frame(spark, x, ids), 3, frame(spark, q, qids), **settings).collect()}
    assert got == brute(x, ids, 3, q, qids)


def test_k_is_capped_and_empty_input(spark):
    got = knn_edges(frame(spark, np.eye(3), [1, 2, 3]), 10).groupBy("i").count().collect()
    assert {r["count"] for r in got} == {2}
    assert knn_edges(frame(spark, np.eye(3), [1, 2, 3]).limit(0), 2).count() == 0


def test_vote_and_regression(spark):
    edges = spark.createDataFrame(
        [(1, 2, 1, 0.0), (1, 3, 2, 2.0), (4, 2, 1, 1.0), (4, 3, 2, 2.0)], "i bigint, j bigint, rank int, dist double"
    )
    rows = spark.createDataFrame([(2, 1, 10.0), (3, 0, 40.0)], "row_id bigint, label int, y double")
    votes = {r["i"]: (r["predicted"], r["probs"]) for r in knn_vote(edges, rows, 2).collect()}
    assert votes[1] == (0, [0.5, 0.5])
    means = {r["i"]: r["predicted"] for r in knn_regress(edges, rows).collect()}
    assert means[1] == 10.0 and means[4] == pytest.approx((10 / 1 + 40 / 2) / (1 + 1 / 2))
    both = rows.unionByName(spark.createDataFrame([(1, 1, 0.0), (4, 0, 0.0)], rows.schema))
    p = {r["row_id"]: r["probs"] for r in leave_one_out_probs(edges, both, 2).collect()}
    assert p[1] == pytest.approx([(1 + 0.5) / 3] * 2)
    assert all(abs(sum(v) - 1) < 1e-8 for v in p.values())


def test_visits_grow_slower_than_rows(spark):
    """With ten times the rows and the same root, a row visits less than twice as many blocks: the tree gets deeper."""
    per_row, depth = [], []
    for n in (4_000, 40_000):
        vec = F.array(*[hash_uniform(5, f"x{c}", F.col("id").cast("string")) for c in range(3)])
        points = spark.range(n).select("id", vec.alias("vec"))
        distinct = materialize(knn._distinct_vectors(points, 6))
        tree = knn._pivot_tree(distinct, n, 3, 100, 50, 16, None)
        rows = materialize(tree.build(distinct, n).withColumn("qid", F.col("vid")))
        assert rows.count() == n and rows.groupBy("cell", "block").count().agg(F.max("count")).first()[0] < 250
        first = rows.select("qid", "vec", "cell", "block", F.lit(float("inf")).alias("bound"))
        found = knn._visit(first, rows, 6, 8192)
        per_row.append(tree.visits(knn._bounded(rows, found, 6), 8192).count() / n)
        depth.append(len(tree.levels))
    assert depth[1] > depth[0] >= 1
    assert per_row[1] < 2 * per_row[0]


def test_vectors_without_structure_travel_once_per_stripe(spark, monkeypatch):
    """Bounds rule nothing out here; each row used to be sent to every block."""
    x = np.random.default_rng(5).normal(size=(1200, 24))
    x[1100:] = x[:100]
    ids = np.arange(len(x)) * 3
    sent = []
    meet = knn._meet

    def seen(left, *rest, **named):
        sent.append(left.count())
        return meet(left, *rest, **named)

    monkeypatch.setattr(knn, "_meet", seen)
    monkeypatch.setattr(knn, "_TRIED", 30)
    monkeypatch.setattr(knn, "_STRIPES", 3)
    monkeypatch.setattr(knn, "_CHUNK", 64)
    settings = {"rows_per_cell": 20, "block_rows": 30, "visit_rows": 400}
    got = {tuple(r) for r in knn_edges(frame(spark, x, ids), 4, **settings).collect()}
    assert got == brute(x, ids, 4)
    assert max(sent) <= 2 * len(x)
    q, qids = x[:50] + 0.25, np.arange(50) + 9000
    got = {tuple(r) for r in knn_edges(frame(spark, x, ids), 3, frame(spark, q, qids), **settings).collect()}
    assert got == brute(x, ids, 3, q, qids)


def test_stripes_keep_their_number_until_they_are_full():
    assert [knn._stripes(n, 64, 4096) for n in (5_000, 100_000, 700_000)] == [2, 12, 12]
    assert knn._stripes(7_000_000, 64, 4096) * knn._STRIPE_BYTES >= 7_000_000 * 64 * 8


def test_rows_found_do_not_grow_with_the_stripes(spark, monkeypatch):
    """Every stripe of rows used to give up to ``keep`` rows a query, and every pair of stripes was shuffled."""
    monkeypatch.setattr(knn, "_TASKS", 6)
    x = np.random.default_rng(6).normal(size=(900, 16))
    base = frame(spark, x, np.arange(900)).select(F.col("row_id").alias("vid"), F.col("features").alias("vec"), F.array("row_id").alias("members"))
    asked = base.select(F.col("vid").alias("qid"), "vec", F.lit(float("inf")).alias("bound"))
    found = knn._in_stripes(asked, base, 4, 3, 30, 16)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" in plan and "Exchange" not in plan
    assert found.groupBy("qid").count().agg(F.max("count")).first()[0] <= 4 * 2
    near = {}
    for r in found.collect():
        near.setdefault(r["qid"], []).append((r["dist"], r["members"][0]))
    want = {}
    for i, j, _, dist in brute(x, np.arange(900), 3):
        want.setdefault(i, [(0.0, i)]).append((dist, j))
    assert {i: sorted(v)[:4] for i, v in near.items()} == {i: sorted(v) for i, v in want.items()}


def test_rows_found_grow_no_faster_than_the_queries(spark):
    """Twelve stripes met four shares of the rows where three met three, so what was given out grew faster than the rows."""
    x = np.random.default_rng(9).normal(size=(240, 8))
    base = frame(spark, x, np.arange(240)).select(F.col("row_id").alias("vid"), F.col("features").alias("vec"), F.array("row_id").alias("members"))
    asked = base.select(F.col("vid").alias("qid"), "vec", F.lit(float("inf")).alias("bound"))
    assert [knn._in_stripes(asked, base, 4, n, n, 8).count() for n in (3, 12)] == [240 * 4 * 3] * 2


def _shuffles(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_distinct_vectors_are_shuffled_once(spark):
    """They used to be shuffled for the limit of copies, and again for the groups."""
    rows = [(9, [0.0, 1.0]), (4, [-0.0, 1.0]), (7, [0.0, 1.0]), (2, [0.0, 1.0]), (5, [3.0, 1.0])]
    found = knn._distinct_vectors(spark.createDataFrame(rows, "id bigint, vec array<double>"), 3)
    assert _shuffles(found) == 1
    assert {(r["vid"], tuple(r["members"]), r["more"]) for r in found.collect()} == {(2, (2, 4, 7), True), (5, (5,), False)}


def test_own_blocks_are_searched_after_one_shuffle(spark):
    """Rows of a self-join used to be shuffled as visitors, as block, and to meet their bounds."""
    x = np.random.default_rng(3).normal(size=(60, 3)).round(2)
    rows = frame(spark, x, np.arange(60)).select(F.col("row_id").alias("vid"), F.col("features").alias("vec"), F.array("row_id").alias("members"))
    rows = rows.withColumns({"cell": F.when(F.col("vid") < 3, 8).otherwise(9).cast("bigint"), "block": (F.col("vid") % 2).cast("int")})
    found = knn._visit_own(rows, 4)
    assert _shuffles(found) == 1
    home = [(i < 3, i % 2) for i in range(60)]
    got = found.collect()
    assert sorted(r["qid"] for r in got) == list(range(60))
    for r in got:
        mine = [j for j in range(60) if home[j] == home[r["qid"]]]
        dist = np.round(np.sqrt(((x[mine] - x[r["qid"]]) ** 2).sum(1)), 9)
        want = sorted(zip(dist.tolist(), mine))[:4]
        assert [(e["dist"], e["members"][0]) for e in r["near"]] == want
        assert r["bound"] == (want[3][0] if len(want) == 4 else np.inf) and r["vec"] == x[r["qid"]].tolist()


def test_self_join_deals_no_visitors_for_its_own_blocks(spark, monkeypatch):
    """Where stripes follow, vectors met their own blocks by a cogroup and their bounds by a join: three shuffles for one."""
    x = np.random.default_rng(5).normal(size=(600, 24))
    met, packed = [], []
    meet, pack = knn._meet, knn._packed
    monkeypatch.setattr(knn, "_meet", lambda left, *rest: met.append(left.count()) or meet(left, *rest))
    monkeypatch.setattr(knn, "_packed", lambda df, parts, *rest: packed.append(parts) or pack(df, parts, *rest))
    monkeypatch.setattr(knn, "_bounded", None)
    monkeypatch.setattr(knn, "_TRIED", 30)
    got = {tuple(r) for r in knn_edges(frame(spark, x, np.arange(600)), 4, rows_per_cell=20, block_rows=30, visit_rows=400).collect()}
    assert got == brute(x, np.arange(600), 4)
    assert len(packed) == 2 and all(n < 600 for n in met)


def test_even_rows_are_packed_where_they_are(spark, monkeypatch):
    """Rows that lie in partitions enough were shuffled once more to be packed."""
    parts, pack = [], knn._packed
    monkeypatch.setattr(knn, "_packed", lambda df, n, *rest: parts.append(n) or pack(df, n, *rest))
    x = np.random.default_rng(7).normal(size=(120, 5))
    base = frame(spark, x, np.arange(120)).select(F.col("row_id").alias("vid"), F.col("features").alias("vec"), F.array("row_id").alias("members"))
    asked = base.select(F.col("vid").alias("qid"), "vec", F.lit(float("inf")).alias("bound"))
    many, few = (knn._in_stripes(asked, base.repartition(n), 3, 12, 12, 5) for n in (6, 1))
    assert parts == [12, None, 12, 12]
    nearest = lambda d: sorted((r["qid"], r["dist"]) for r in d.groupBy("qid").agg(F.sort_array(F.collect_list("dist"))[2].alias("dist")).collect())
    assert nearest(many) == nearest(few)


@pytest.mark.parametrize("shift", [0.0, 3.0, 1e6])
def test_single_precision_loses_no_neighbour(shift):
    x = np.round(np.random.default_rng(8).normal(size=(700, 12)), 3) + shift
    exact = np.round(np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1)), knn.KEY_DIGITS)
    ids = np.arange(700)
    want = [[(exact[i, j], j) for j in np.lexsort((ids, exact[i]))[:5]] for i in ids]
    bound = np.array([w[-1][0] for w in want])
    r, k, dist = knn._nearest_rows(x, bound * 1.5, x, ids, 5)
    got = [[] for _ in ids]
    for a, b, d in zip(r, k, dist, strict=True):
        got[a].append((d, b))
    assert got == want


def test_distances_to_pivots_are_made_tile_by_tile(monkeypatch):
    """A batch of 10,000 rows used to meet all pivots at once."""
    made = []
    squared = knn._squared

    def seen(a, b):
        made.append(len(a) * len(b))
        return squared(a, b)

    rng = np.random.default_rng(2)
    x, pivots = rng.normal(size=(2000, 2)), rng.normal(size=(40, 2))
    apart = ((x[:, None, :] - pivots[None]) ** 2).sum(-1)
    radius, bound = np.full(40, 0.2), np.full(2000, 0.1)
    whole = knn._near_bound(squared(x, pivots), pivots, radius, bound, None)
    monkeypatch.setattr(knn, "_squared", seen)
    assert (knn._nearest_pivot(x, pivots) == apart.argmin(axis=1)).all()
    assert [list(c) for c in knn._cells_in_reach(x, pivots, radius, bound, None)] == [list(np.nonzero(m)[0]) for m in whole]
    assert max(made) <= knn._TILE * 40
