"""Invariants and small exact cases."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from rowsift.operators import annotators, anomaly, audit, corruption, features, labels, metrics, sampling, vision


def one(df):
    return df.first().asDict()


def values(df):
    return {r["metric"]: r["value"] for r in df.collect()}


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(100).select(F.col("id").alias("row_id"), (F.col("id") % 3).cast("int").alias("label"))


def test_flip_labels(rows):
    out = corruption.flip_labels(rows, "label", 0.3).withColumnRenamed("label", "new")
    both = out.join(rows, "row_id")
    assert both.filter("was_corrupted").count() == 30
    assert both.filter("was_corrupted AND new = label").count() == 0
    assert both.filter("NOT was_corrupted AND new <> label").count() == 0
    again = corruption.flip_labels(rows, "label", 0.3)
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, again.collect()))
    other = corruption.flip_labels(rows, "label", 0.3, seed=7)
    assert sorted(map(tuple, out.collect())) != sorted(map(tuple, other.collect()))


def test_flip_labels_edge_cases(rows):
    assert corruption.flip_labels(rows, "label", 0.0).filter("was_corrupted").count() == 0
    same = rows.withColumn("label", F.lit(1))
    assert corruption.flip_labels(same, "label", 0.5).filter("was_corrupted").count() == 0


def test_splits(rows):
    s = sampling.stratified_split(rows, "label", 0.2)
    assert s.filter("is_test").count() == 20
    assert {r["count"] for r in s.filter("is_test").groupBy("label").count().collect()} <= {6, 7}
    assert sampling.plain_split(rows, 0.25).filter("is_test").count() == 25
    assert sampling.plain_split(rows, 0.35, floor_train=True).filter("NOT is_test").count() == 65
    assert sampling.sample_cap(rows, 1000).count() == 100 and sampling.sample_cap(rows, 7).count() == 7


def test_folds(rows, spark):
    f = sampling.kfold(rows, 5, "label")
    assert {r["count"] for r in f.groupBy("label", "fold").count().collect()} <= {6, 7}
    tokens = spark.range(90).select((F.col("id") % 9).alias("sent_id"), F.col("id").alias("tok_i"))
    g = sampling.kfold_group(tokens, "sent_id", 3).select("sent_id", "fold").distinct().collect()
    assert len(g) == 9 and sorted(r["fold"] for r in g) == [0, 0, 0, 1, 1, 1, 2, 2, 2]
    assert sampling.usable_folds(rows, "label", 50) == 33
    with pytest.raises(ValueError):
        sampling.usable_folds(rows.filter("label = 0"), "label", 5)


def test_preprocessing(spark):
    df = spark.createDataFrame(
        [(1, 1.0, 4.0, "a"), (2, 2.0, None, "b"), (3, None, 6.0, None), (4, 10.0, 6.0, "b")],
        "row_id bigint, a double, b double, cat string",
    )
    prep = features.fit_preprocessor(df, ["a", "b"], ["cat"], scale=False)
    got = [r["features"] for r in prep.transform(df).orderBy("row_id").collect()]
    assert got == [[1.0, 4.0, 1.0, 0.0], [2.0, 6.0, 0.0, 1.0], [2.0, 6.0, 0.0, 1.0], [10.0, 6.0, 0.0, 1.0]]
    scaled = features.fit_preprocessor(df, ["a"], impute="mean").transform(df)
    x = np.array([r["features"][0] for r in scaled.collect()])
    assert abs(x.mean()) < 1e-12 and abs(x.std() - 1) < 1e-12
    unseen = spark.createDataFrame([(9, 0.0, 0.0, "zzz")], df.schema)
    assert prep.transform(unseen).first()["features"] == [0.0, 0.0, 0.0, 0.0]
    assert features.column_roles(df.withColumn("f", F.lit(True)), ["row_id"]) == (["a", "b", "f"], ["cat"])


def test_one_hot_pools_rare_levels(spark):
    df = spark.createDataFrame([(v,) for v in "aaabbcd"], "cat string")
    prep = features.fit_preprocessor(df, [], ["cat"], max_categories=3)
    got = {r["cat"]: r["h"] for r in prep.one_hot(df, "cat", "h").collect()}
    assert got == {"a": [1, 0, 0], "b": [0, 1, 0], "c": [0, 0, 1], "d": [0, 0, 1]}
    assert prep.width == 3
    more = prep.one_hot(spark.createDataFrame([("zz",), (None,), ("c",)], "cat string"), "cat", "h")
    assert {r["cat"]: r["h"] for r in more.collect()} == {"zz": [0, 0, 0], None: [None, None, 0], "c": [0, 0, 1]}


def test_one_hot_of_very_many_levels(spark):
    df = spark.range(400_000).select(F.concat(F.lit("v"), F.when(F.col("id") % 2 == 0, F.lit(0)).otherwise(F.col("id"))).alias("cat"))
    prep = features.fit_preprocessor(df, [], ["cat"], max_categories=5)
    assert prep.levels["cat"][0] == "v0" and prep.width == 5
    got = prep.one_hot(df, "cat", "h").agg(F.sum(F.col("h")[0]).alias("v0"), F.sum(F.element_at("h", -1)).alias("rare")).first()
    assert (got["v0"], got["rare"]) == (200_000, 200_000 - 3)


def test_reduce_dimensions(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(60, 12)) * np.arange(1, 13)
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "row_id bigint, features array<double>")
    got = np.array([r["features"] for r in features.reduce_dimensions(df, "features", 12, limit=5).orderBy("row_id").collect()])
    s = np.linalg.svd(x, compute_uv=False)[:5]
    assert got.shape == (60, 5) and np.allclose(np.linalg.norm(got, axis=0), s)
    with pytest.raises(ValueError):
        features.reduce_dimensions(df, "features", 0)


def test_token_neighbours_across_chunks(spark):
    df = spark.range(50).select(F.lit(1).cast("bigint").alias("sent_id"), F.col("id").cast("int").alias("tok_i"),
                                F.concat(F.lit("W"), "id").alias("token"))
    a = features.token_features(df, chunk=7).orderBy("tok_i").collect()
    assert [r["prev_w"] for r in a] == ["<BOS>"] + [f"w{i}" for i in range(49)]
    assert [r["next_w"] for r in a] == [f"w{i}" for i in range(1, 50)] + ["<EOS>"]


def test_classification_metrics(spark):
    df = spark.createDataFrame([(0, 0), (1, 0), (1, 1), (2, 2), (2, 3)], "y int, h int")
    m = values(metrics.classification_metrics(df, "y", "h"))
    assert m["accuracy"] == pytest.approx(0.6) and m["f1_micro"] == pytest.approx(0.6)
    assert m["f1_macro"] == pytest.approx((2 / 3 + 2 / 3 + 2 / 3 + 0) / 4)
    assert m["precision_weighted"] == pytest.approx((0.5 + 2 + 2) / 5)


def test_auc_and_log_loss(spark):
    rng = np.random.default_rng(5)
    y, s = rng.integers(0, 2, 300), rng.random(300).round(1)
    df = spark.createDataFrame([(int(a), float(b), [1 - float(b), float(b)]) for a, b in zip(y, s)], "y int, s double, probs array<double>")
    pos, neg = s[y == 1], s[y == 0]
    want = ((pos[:, None] > neg).mean() + 0.5 * (pos[:, None] == neg).mean())
    assert one(metrics.roc_auc(df, "y", "s"))["auc"] == pytest.approx(want)
    assert one(metrics.roc_auc(df.filter("y = 1"), "y", "s"))["auc"] is None
    p = np.where(y == 1, s, 1 - s)
    assert one(metrics.log_loss(df, "y", "probs"))["log_loss"] == pytest.approx(-np.log(np.maximum(p, 1e-15)).mean())


def test_multilabel_and_regression_metrics(spark):
    df = spark.createDataFrame([([1, 0], [1, 0]), ([1, 1], [0, 1])], "y array<int>, h array<int>")
    m = values(metrics.multilabel_metrics(df, "y", "h", 2))
    assert (m["subset_accuracy"], m["hamming_loss"]) == (0.5, 0.25)
    reg = spark.createDataFrame([(1.0, 1.5), (2.0, 1.5), (3.0, 3.5), (4.0, 3.5)], "y double, h double")
    m = values(metrics.regression_metrics(reg, "y", "h"))
    assert m["mae"] == 0.5 and m["rmse"] == 0.5 and m["r2"] == pytest.approx(0.8)


@pytest.mark.parametrize("found, true, p, r", [([1, 2], [1, 2], 1, 1), ([1, 3], [1, 2], 0.5, 0.5), ([3], [1], 0, 0), ([1], [], 0, 0), ([], [1], 0, 0)])
def test_set_quality(spark, found, true, p, r):
    ids = lambda v: spark.createDataFrame([(i,) for i in v], "row_id int")
    q = one(metrics.set_quality(ids(found), ids(true)))
    assert (q["precision"], q["recall"]) == (p, r)


def planted(spark, n=600, k=3, seed=0):
    """Sharp probabilities for the clean class, a tenth of the labels wrong."""
    rng = np.random.default_rng(seed)
    clean = rng.integers(0, k, n)
    probs = rng.dirichlet(np.ones(k), n) * 0.2
    probs[np.arange(n), clean] += 0.8
    given = clean.copy()
    bad = rng.choice(n, n // 10, replace=False)
    given[bad] = (given[bad] + 1) % k
    rows = [(int(i), int(given[i]), [float(x) for x in probs[i]]) for i in range(n)]
    return spark.createDataFrame(rows, "row_id bigint, label int, probs array<double>"), set(map(int, bad))


@pytest.mark.parametrize("how", ["prune_by_noise_rate", "by_class", "confident_joint"])
def test_label_issues_find_planted_errors(spark, how):
    df, bad = planted(spark)
    found = {r["row_id"] for r in labels.flag_label_issues(df, 3, filter_by=how).collect()}
    assert len(found & bad) / len(bad) > 0.9 and len(found & bad) / len(found) > 0.9


def test_rank_issues_and_thresholds(spark):
    df, _ = planted(spark)
    found = labels.flag_label_issues(df, 3)
    ranked = labels.rank_issues(found, 10).collect()
    assert len(ranked) == 10 and [r["score"] for r in ranked] == sorted(r["score"] for r in ranked)
    assert all(r["score"] <= 0.05 for r in labels.rank_issues(found, 1000, 0.05).collect())
    every = {r["label"]: r["threshold"] for r in labels.class_thresholds(df, threshold="all_rows").collect()}
    assert every[0] == pytest.approx(np.mean([r["probs"][0] for r in df.collect()]), abs=1e-6)
    with pytest.raises(ValueError):
        labels.flag_label_issues(df, 3, filter_by="other")


def test_regression_issue_order(spark):
    q = spark.createDataFrame([(1, 0.1, False), (2, 0.2, True), (3, 0.3, True)], "row_id int, label_score double, is_label_issue boolean")
    assert [r["row_id"] for r in labels.regression_issues(q, 2).collect()] == [2]


def test_prune_helpers(spark):
    assert labels.prune_size(125, 0.02) == 2 and labels.prune_size(1000, 0.2, 50) == 50
    empty = spark.createDataFrame([], "row_id bigint, score double")
    some = spark.createDataFrame([(5, 0.2), (6, 0.1)], "row_id bigint, score double")
    assert [r["row_id"] for r in labels.choose_prune([(empty, "score"), (some, "score")], 1).collect()] == [6]
    assert labels.choose_prune([(empty, "score")], 3).count() == 0
    left = labels.prune(spark.range(5).withColumnRenamed("id", "row_id"), spark.createDataFrame([(1,), (3,)], "row_id bigint"))
    assert sorted(r["row_id"] for r in left.collect()) == [0, 2, 4]


def far_points(spark):
    rng = np.random.default_rng(42)
    x = np.vstack([rng.normal(size=(90, 5)), rng.uniform(5, 10, size=(10, 5))])
    return spark.createDataFrame(
        [(i, [float(v) for v in r], int(i >= 90)) for i, r in enumerate(x)], "row_id bigint, features array<double>, ground_truth int"
    )


@pytest.mark.parametrize("name, low, high", [("knn", 10, 10), ("isolation_forest", 10, 10), ("lof", 8, 12), ("ensemble", 5, 15)])
def test_strategies_flag_far_points(spark, name, low, high):
    from rowsift.plans.configs import AnomalyConfig
    from rowsift.plans.tasks import run_anomaly

    out = run_anomaly(far_points(spark), AnomalyConfig(strategy=name, contamination=0.1))
    assert low <= out.summary["n_anomalies_detected"] <= high
    if name in ("knn", "isolation_forest"):
        assert out.summary["f1_score"] == 1.0
    s = [r["score"] for r in out.frames["top"].collect()]
    assert s == sorted(s) and all(0 <= v <= 1 for v in s)


def test_failing_member_stops_the_ensemble(spark, monkeypatch):
    """The mean of the other members, or 0.5 for every row, used to come back as the result."""
    from rowsift.plans.configs import AnomalyConfig
    from rowsift.plans.tasks import run_anomaly

    def broken(df, edges, cfg):
        raise OSError("no space")

    df, config = far_points(spark), AnomalyConfig(strategy="ensemble", contamination=0.1)
    for names in (["lof"], list(anomaly.ENSEMBLE)):
        for name in names:
            monkeypatch.setitem(anomaly._STRATEGIES, name, broken)
        with pytest.raises(RuntimeError, match="ensemble failed: OSError: no space"):
            run_anomaly(df, config)
        with pytest.raises(RuntimeError, match="ensemble failed"):
            anomaly.get_strategy("ensemble")(df.select("row_id", "features"), None, config)


def test_strategy_registry():
    assert anomaly.list_strategies() == ["ensemble", "isolation_forest", "knn", "lof"]
    with pytest.raises(ValueError):
        anomaly.get_strategy("other")


def test_summary_without_truth_and_constant_scores(spark):
    df = spark.createDataFrame([(1, 0.5, False), (2, 0.5, False)], "row_id int, score double, is_anomaly boolean")
    s = one(anomaly.anomaly_summary(df))
    assert s["n_total"] == 2 and s["precision"] is None and s["contamination_rate"] == 0.0
    assert {r["s"] for r in audit.inverted_min_max(df, "score", "s").collect()} == {0.5}


def test_non_iid_detects_order(spark):
    from rowsift.operators.knn import knn_edges

    x = np.linspace(0, 50, 300)
    df = spark.createDataFrame([(i, [float(v)]) for i, v in enumerate(x)], "row_id bigint, features array<double>")
    mixed = df.withColumn("pos", F.md5(F.col("row_id").cast("string")))
    edges = knn_edges(df, 5)
    sorted_gaps = audit.neighbour_gaps(edges, audit.row_positions(df, ["row_id"]))
    mixed_gaps = audit.neighbour_gaps(edges, audit.row_positions(mixed, ["pos"]))
    assert one(audit.non_iid_test(sorted_gaps, 300))["is_non_iid"]
    assert not one(audit.non_iid_test(mixed_gaps, 300))["is_non_iid"]
    assert audit.non_iid_scores(sorted_gaps, 300, True).filter("is_non_iid_issue").count() >= 1


def test_checks_are_fault_tolerant(spark):
    def broken():
        raise RuntimeError("no")

    done, errors = audit.run_checks({"a": lambda: spark.range(1), "b": broken})
    assert list(done) == ["a"] and errors == {"b": "RuntimeError: no"}


def test_consensus_ties_and_errors(spark):
    df = spark.createDataFrame([(1, 1, 0), (1, 2, 1), (2, 1, 1), (2, 2, 1), (3, 1, 2), (3, 2, 0)], "example_id bigint, annotator_id bigint, label int")
    got = {r["example_id"]: (r["label"], r["agreement"]) for r in annotators.consensus(df).collect()}
    assert got == {1: (1, 0.5), 2: (1, 1.0), 3: (0, 0.5)}
    wide = annotators.label_matrix(df)
    assert wide.columns == ["example_id", "user_1", "user_2"] and wide.count() == 3
    with pytest.raises(ValueError):
        annotators.annotation_codes(df.withColumn("label", F.lit(None).cast("int")))
    with pytest.raises(ValueError):
        annotators.dense_annotations(df, min_per_annotator=50)
    assert annotators.worst_examples(df.select("example_id"), "quality").count() == 0


def test_boxes(spark):
    cols = "image_id bigint, box_id bigint, class_id int, score double, x1 double, y1 double, x2 double, y2 double"
    truth = spark.createDataFrame(
        [(1, 1, 0, 1.0, 0.0, 0.0, 10.0, 10.0), (1, 2, 0, 1.0, 100.0, 100.0, 120.0, 120.0), (2, 3, 1, 1.0, 0.0, 0.0, 200.0, 200.0), (3, 4, 0, 1.0, 0.0, 0.0, 10.0, 10.0)], cols
    )
    pred = spark.createDataFrame(
        [(1, 9, 0, 0.9, 0.0, 0.0, 10.0, 10.0), (2, 8, 0, 0.9, 0.0, 0.0, 200.0, 200.0), (3, 7, 0, 0.9, 5.0, 0.0, 15.0, 10.0), (3, 6, 0, 0.9, 300.0, 0.0, 310.0, 9.0)], cols
    )
    iou = {(r["t_box_id"], r["p_box_id"]): r["iou"] for r in vision.box_iou(truth, pred).collect()}
    assert iou == {(1, 9): 1.0, (3, 8): 1.0, (4, 7): pytest.approx(1 / 3)}
    got = {(r["box_id"], r["side"]): r["issue"] for r in vision.box_issues(truth, pred).collect()}
    assert got == {(2, "truth"): "missing", (3, "truth"): "swapped", (4, "truth"): "badly_located", (6, "prediction"): "overlooked"}


def test_softmin_padding_and_empty_mask(spark):
    px = spark.createDataFrame([(1, 0, 0, 1, 0.2), (1, 0, 1, 0, 0.1)], "image_id bigint, y int, x int, label int, p double")
    q = np.array([0.2, 0.9, 1.0, 1.0])
    want = (q * np.exp(-q / 0.1)).sum() / np.exp(-q / 0.1).sum()
    assert one(vision.softmin_quality(px, padded=(2, 2)))["quality"] == pytest.approx(want, abs=1e-8)
    images = spark.createDataFrame([(1, 8, 8)], "image_id bigint, width int, height int")
    empty = px.withColumn("label", F.lit(0))
    assert vision.corrupt_mask(empty, images).filter("was_corrupted").count() == 0


def test_mean_and_primary_metric(spark):
    rows = spark.createDataFrame([("roc_auc", 0.5), ("f1_weighted", 0.9)], "metric string, value double")
    assert metrics.mean_metric(rows).first()["value"] == pytest.approx(0.7)
    assert metrics.mean_metric(rows, percent=True).first()["value"] == pytest.approx(70)
    assert metrics.mean_metric(rows.limit(0)).first()["value"] == 0
    assert metrics.primary_metric(rows).first()["primary"] == 0.5
    assert metrics.primary_metric(rows.filter("metric <> 'roc_auc'")).first()["primary"] == 0.9
