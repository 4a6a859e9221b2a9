"""What must hold whatever the number of keys, classes, levels or copies."""

from __future__ import annotations

import os
import subprocess
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

from rowsift.catalog import all_queries
from rowsift.functions import skew
from rowsift.operators import annotators, features, knn, labels, sampling, vision
from tests.conftest import SF

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_a_thousand_hot_keys(spark):
    big = spark.range(60_000).select((F.col("id") % 1003).alias("k"), "id")
    big = big.unionByName(spark.range(20).select(F.lit(None).cast("bigint").alias("k"), (F.col("id") + 60_000).alias("id")))
    dim = spark.range(1010).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    for how in ("inner", "left"):
        got = skew.skew_join(big, dim, ["k"], how, hot_rows=20)
        want = big.join(dim, ["k"], how)
        assert sorted(got.columns) == sorted(want.columns)
        total = [d.agg(F.count("*"), F.sum("v"), F.sum("id")).first() for d in (got, want)]
        assert total[0] == total[1]


def test_a_crowd_of_boxes(spark):
    side = F.lit(0.4)
    boxes = spark.range(100_000).select(
        F.lit(1).alias("image_id"),
        F.col("id").alias("box_id"),
        F.lit(0).alias("class_id"),
        (F.col("id") % 320 * 0.2).alias("x1"),
        (F.floor(F.col("id") / 320) * 0.2).alias("y1"),
    )
    boxes = boxes.withColumns({"x2": F.col("x1") + side, "y2": F.col("y1") + side})
    pairs = vision.box_iou(boxes, boxes)
    # each box meets itself and its eight neighbours, but for the border
    n = pairs.filter("t_box_id = 32160").count()
    assert n == 9 and pairs.filter("t_box_id = p_box_id").count() == 100_000


def test_boxes_of_all_sizes(spark):
    """Small and huge boxes in one image: all overlaps are found, with few copies of a box."""
    import random

    rng = random.Random(8)
    cols = "image_id bigint, box_id bigint, class_id int, x1 double, y1 double, x2 double, y2 double"

    def some(n):
        out = []
        for i in range(n):
            side = 2.0 ** rng.randint(-3, 10)
            x, y = rng.uniform(-300, 1500), rng.uniform(-300, 1500)
            out.append((rng.randint(1, 2), i, 0, x, y, x + side * rng.uniform(0.2, 1), y + side * rng.uniform(0.2, 1)))
        return out

    a, b = some(150), some(150)
    truth, pred = spark.createDataFrame(a, cols), spark.createDataFrame(b, cols)
    got = vision.box_iou(truth, pred).select("image_id", "t_box_id", "p_box_id").collect()
    want = {
        (t[0], t[1], p[1])
        for t in a
        for p in b
        if t[0] == p[0] and min(t[5], p[5]) > max(t[3], p[3]) and min(t[6], p[6]) > max(t[4], p[4])
    }
    assert len(got) == len(want) and {tuple(r) for r in got} == want
    levels = vision._levels_of(vision._leveled(pred))
    copies = vision._on_grid(vision._leveled(truth), levels, "t").count()
    assert copies < 150 * 4 * len(levels)
    crowd = vision.box_issues(truth.unionByName(truth), pred.withColumn("score", F.lit(0.9))).groupBy("side").count()
    once = vision.box_issues(truth, pred.withColumn("score", F.lit(0.9))).groupBy("side").count()
    n = {r["side"]: r["count"] for r in once.collect()}
    assert {r["side"]: r["count"] for r in crowd.collect()} == {"truth": 2 * n["truth"], "prediction": n["prediction"]}


def test_very_many_classes(spark):
    df = spark.range(90_000).select(F.col("id").alias("row_id"), (F.col("id") % 30_000).cast("int").alias("label"))
    folds = sampling.kfold(df, 3, "label")
    per = folds.groupBy("label").agg(F.countDistinct("fold").alias("d"))
    assert per.filter("d <> 3").isEmpty()
    split = sampling.stratified_split(df, "label", 0.34)
    assert split.filter("is_test").count() == 30_600
    assert split.groupBy("label").agg(F.sum(F.col("is_test").cast("int")).alias("t")).filter("t NOT IN (1, 2)").isEmpty()


def test_table_path_equals_driver_path(spark, monkeypatch):
    df = spark.range(600).select(F.col("id").alias("row_id"), (F.col("id") % 7).cast("int").alias("label"))
    first = sorted(sampling.kfold(df, 5, "label").collect()), sorted(sampling.stratified_split(df, "label").collect())
    monkeypatch.setattr(sampling, "MANY_CUTS", 0)
    second = sorted(sampling.kfold(df, 5, "label").collect()), sorted(sampling.stratified_split(df, "label").collect())
    assert first == second


def test_label_issues_over_400_classes(spark):
    k = 400
    df = spark.range(8000).select(
        F.col("id").alias("row_id"),
        (F.col("id") % k).cast("int").alias("truth"),
        F.when((F.floor(F.col("id") / k) == 3) & (F.col("id") % 4 == 0), (F.col("id") * 7 + 1) % k).otherwise(F.col("id") % k).cast("int").alias("label"),
    )
    probs = F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: F.when(i == F.col("truth"), 0.601).otherwise(0.001))
    df = df.withColumn("probs", probs.cast("array<double>"))
    found = labels.flag_label_issues(df.drop("truth"), k)
    planted = df.filter("label <> truth").select("row_id")
    assert found.select("row_id").exceptAll(planted).isEmpty() and found.count() > 0.9 * planted.count()


def test_worst_rows_never_takes_rows_without_a_score(spark):
    df = spark.createDataFrame([(1, None), (2, 0.5), (3, 0.1), (4, 0.5)], "row_id long, score double")
    for n, want in ((0, []), (1, [3]), (2, [2, 3]), (3, [2, 3, 4]), (100_001, [2, 3, 4])):
        assert sorted(r.row_id for r in labels.worst_rows(df, "score", n).collect()) == want


def test_active_learning_with_one_class(spark):
    votes = spark.createDataFrame([(1, 1, 0), (1, 2, 0)], "example_id long, annotator_id long, label int")
    model = spark.createDataFrame([(1, [1.0])], "example_id long, probs array<double>")
    assert annotators.active_learning(votes, model, 1).first().al_score == 1.0


NEIGHBOUR_QUERIES = ["outlier_scores", "near_duplicates", "non_iid", "knn_vote", "loo_probs", "label_issues", "anomaly_knn", "clf_metrics"]


@pytest.mark.parametrize("name", NEIGHBOUR_QUERIES)
def test_neighbours_are_searched_once(spark, name, monkeypatch, tmp_path):
    calls = []
    real = knn._nearest_in_block

    def counted(keep):
        search = real(keep)
        log = str(tmp_path / "visits")

        def logged(visits, block):
            if len(visits) and len(block):
                with open(log, "a") as f:
                    f.write(f"{hash(tuple(sorted(visits['qid'])))} {hash(tuple(sorted(block['vid'])))}\n")
            return search(visits, block)

        calls.append(1)
        return logged

    monkeypatch.setattr(knn, "_nearest_in_block", counted)
    all_queries()[name](spark, SF).write.format("noop").mode("overwrite").save()
    visits = open(tmp_path / "visits").read().splitlines()
    assert calls and len(visits) == len(set(visits))


def test_probes_keep_most_neighbours(spark):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(40, 8)) * 4
    x = centres[rng.integers(0, 40, 3000)] + rng.normal(size=(3000, 8))
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "row_id long, features array<double>")
    exact = {(r.i, r.j) for r in knn.knn_edges(df, 10, block_rows=64, rows_per_cell=64).collect()}
    near = {(r.i, r.j) for r in knn.knn_edges(df, 10, block_rows=64, rows_per_cell=64, probes=8).collect()}
    assert len(exact & near) > 0.9 * len(exact)


def test_runs_from_another_folder(tmp_path):
    code = (
        f"import sys; sys.path.insert(0, {REPO!r})\n"
        "import __spark_entry__ as e\n"
        "from pyspark.sql import SparkSession\n"
        "s = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false').config('spark.sql.shuffle.partitions', '4').getOrCreate()\n"
        f"print('rows', e.queries()['knn_graph'](s, {SF!r}).count())\n"
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "rows 5000" in done.stdout, done.stderr[-2000:]


def _angles(a, b):
    """Cosines of the principal angles between two column spaces."""
    return np.linalg.svd(np.linalg.qr(a)[0].T @ np.linalg.qr(b)[0])[1]


def test_random_basis_spans_the_exact_subspace(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 64)) * 0.9 ** np.arange(64) @ np.linalg.qr(rng.normal(size=(64, 64)))[0]
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "row_id bigint, features array<double>")
    exact = np.linalg.svd(x, full_matrices=False)[2][:8].T
    assert features.range_basis(df, "features", 64, 8, passes=30).shape == (64, 8)
    assert _angles(exact, features.range_basis(df, "features", 64, 8, passes=30)).min() > 0.999
    assert _angles(exact, features._gram_basis(df, "features", 64, 8)).min() > 1 - 1e-9


def test_twenty_thousand_sparse_columns_are_reduced(spark):
    """Ten directions of 2,000 columns each, with a little noise: the projection keeps all but the noise."""
    n, width = 600, 20_000
    rng = np.random.default_rng(4)
    rows = []
    for i in range(n):
        at = np.sort(rng.choice(2000, 400, replace=False)) * 10 + i % 10
        rows.append((i, ([int(v) for v in at], [float(v) for v in 1 + 0.01 * rng.normal(size=400)])))
    df = spark.createDataFrame(rows, "row_id bigint, features struct<indices:array<int>,values:array<double>>")
    out = features.reduce_dimensions(df, "features", width, 10)
    assert out.columns == ["row_id", "features"]
    got = {r.row_id: np.array(r.features) for r in out.collect()}
    assert len(got) == n and all(len(v) == 10 for v in got.values())
    unit = {i: v / np.linalg.norm(v) for i, v in got.items()}
    assert all(abs(unit[i] @ unit[i % 10]) > 0.9 for i in got)
    assert all(abs(unit[i] @ unit[(i + 1) % 10]) < 0.1 for i in range(10))
