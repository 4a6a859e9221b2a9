"""Forests without a depth limit: exact fits, both phases, both ways of scoring."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from rowsift.operators import forest, models
from rowsift.operators.forest import ForestParams, fit_forest

WHOLE = ForestParams(trees=1, tried=1.0, bootstrap=False)


def depth(tree):
    out = np.zeros(len(tree.child), int)
    for node, at in enumerate(tree.child):  # children come after their parent
        if at >= 0:
            out[at : at + 2] = out[node] + 1
    return int(out.max())


def column(df, name):
    return np.array([r[name] for r in df.orderBy("row_id").collect()])


@pytest.fixture(scope="module")
def chain(spark):
    """Each split of least squares takes off the largest row only, so the tree is a chain."""
    rows = [(i, [float(i)], 4.0**i) for i in range(45)]
    return spark.createDataFrame(rows, "row_id bigint, features array<double>, label double")


@pytest.fixture(scope="module")
def noise(spark):
    rng = np.random.default_rng(3)
    x, y = rng.normal(size=(600, 4)), rng.integers(0, 3, 600)
    rows = [(i, [float(v) for v in r], int(y[i])) for i, r in enumerate(x)]
    return y, spark.createDataFrame(rows, "row_id bigint, features array<double>, label int").repartition(4)


def test_depth_beyond_thirty_is_fitted_exactly(chain):
    fitted = fit_forest(chain, 0, WHOLE)
    assert depth(forest.Packed.of(fitted.subtrees.first())) >= 40
    assert np.allclose(column(fitted.predict(chain), "predicted"), 4.0 ** np.arange(45), rtol=1e-12)


def test_split_equals_brute_force():
    rng = np.random.default_rng(1)
    for n_classes in (3, 0):
        for _ in range(30):
            x = rng.integers(0, 6, (25, 3)).astype(float)
            w = rng.integers(1, 4, 25).astype(float)
            y = rng.integers(0, 3, 25) if n_classes else rng.normal(size=25)

            def impurity(rows):
                if n_classes:
                    c = np.bincount(y[rows], w[rows])
                    return c.sum() - (c**2).sum() / c.sum()
                return (w[rows] * (y[rows] - np.average(y[rows], weights=w[rows])) ** 2).sum()

            def cost(f, t):
                low = x[:, f] <= t
                return impurity(low) + impurity(~low)

            best = min(cost(f, t) for f in range(3) for t in np.unique(x[:, f])[:-1])
            assert np.isclose(cost(*forest._exact_split(x, y, w, n_classes, 1)), best)


@pytest.mark.parametrize("task_rows", [50_000, 40])
def test_noise_is_fitted_exactly_in_both_phases(noise, monkeypatch, task_rows):
    monkeypatch.setattr(forest, "TASK_ROWS", task_rows)
    y, df = noise
    fitted = fit_forest(df, 3, WHOLE)
    assert (len(fitted.tops[0].child) > 1) == (task_rows == 40)  # the top comes from histograms
    assert (column(fitted.classify(df), "predicted") == y).all()
    if task_rows == 40:
        sizes = [len(t) for t in fitted.subtrees.select("child").toPandas()["child"]]
        assert len(sizes) > 10 and max(sizes) < 2 * 40


def test_both_ways_of_scoring_agree(noise, monkeypatch):
    _, df = noise
    monkeypatch.setattr(forest, "TASK_ROWS", 100)
    monkeypatch.setattr(forest, "WAVE", 2)
    fitted = fit_forest(df, 3, ForestParams(trees=5))
    sent = column(fitted.classify(df), "probs")
    monkeypatch.setattr(forest, "SENT_NODES", 0)
    monkeypatch.setattr(forest, "TASK_ROWS", 30)  # ends with more rows are dealt
    assert np.allclose(column(fitted.classify(df), "probs"), sent)
    assert np.allclose(sent.sum(axis=1), 1)


def test_reruns_agree(noise):
    _, df = noise
    first = column(fit_forest(df, 3, ForestParams(trees=4)).classify(df), "probs")
    again = column(fit_forest(df.repartition(7), 3, ForestParams(trees=4)).classify(df), "probs")
    assert np.array_equal(first, again)


def test_rows_inside_one_bin_get_bins_of_their_own(spark, monkeypatch):
    monkeypatch.setattr(forest, "TASK_ROWS", 50)
    rows = [(i, [float(i) if i < 300 else 1000.0 + i * 1e-3], i % 2) for i in range(1500)]
    df = spark.createDataFrame(rows, "row_id bigint, features array<double>, label int").repartition(4)
    fitted = fit_forest(df, 2, ForestParams(trees=1, tried=1.0, bootstrap=False, bins=4))
    assert (column(fitted.classify(df), "predicted") == np.arange(1500) % 2).all()


def test_many_equal_rows_are_one_leaf(spark, monkeypatch):
    monkeypatch.setattr(forest, "TASK_ROWS", 50)
    df = spark.range(600).select(F.col("id").alias("row_id"), F.array(F.lit(1.0), F.lit(2.0)).alias("features"), (F.col("id") % 3).alias("label"))
    fitted = fit_forest(df, 3, WHOLE)
    assert fitted.subtrees.isEmpty() and np.allclose(column(fitted.classify(df), "probs"), 1 / 3)
    numbers = fit_forest(df, 0, WHOLE).predict(df)
    assert np.allclose(column(numbers, "predicted"), 1.0)


def test_odd_tables(spark, noise):
    y, df = noise
    empty = fit_forest(df.limit(0), 3, WHOLE)
    assert np.allclose(column(empty.classify(df), "probs"), 1 / 3)
    one = fit_forest(df.limit(1), 3, ForestParams(trees=3))  # some trees draw nothing
    assert np.allclose(column(one.classify(df), "probs").sum(axis=1), 1)
    holes = df.withColumn("features", F.array(F.when(F.col("row_id") % 5 > 0, F.col("features")[0]), F.lit(float("nan"))))
    holes = holes.withColumn("label", F.when(F.col("row_id") % 5 == 0, 2).otherwise(F.col("row_id") % 2))
    got = column(fit_forest(holes, 3, WHOLE).classify(holes), "predicted")
    assert (got == column(holes, "label")).all()
    unlabelled = df.withColumn("label", F.when(F.col("row_id") < 300, F.col("label")))
    got = column(fit_forest(unlabelled, 3, WHOLE).classify(df), "predicted")
    assert (got[:300] == y[:300]).all()


def test_model_menu(noise, chain):
    _, df = noise
    spec = models.model_spec("classification", "random_forest", trees=5, max_depth=None)
    out = models.out_of_fold_probs(df, spec, 3, 3)
    assert out.count() == 600 and np.allclose(column(out, "probs").sum(axis=1), 1)
    spec = models.model_spec("regression", "random_forest", trees=5, max_depth=None)
    drawn_twice = models.fit_regressor(spec, chain, weight=F.when(F.col("row_id") < 40, 2.0).otherwise(0.0))(chain)
    assert column(drawn_twice, "predicted").max() <= 4.0**39  # rows of no weight do not count


def depths(child) -> list[int]:
    """Splits above each node of a tree, whose children come after it."""
    depth = [0] * len(child)
    for n, c in enumerate(child):
        if c >= 0:
            depth[c] = depth[c + 1] = depth[n] + 1
    return depth


def test_depth_limit_in_tasks_and_in_tops(spark, monkeypatch):
    """Only the forest of pyspark.ml, whose nodes all lie on the driver, used to have a depth limit."""
    rng = np.random.default_rng(5)
    rows = [(i, [float(v) for v in rng.normal(size=4)], int(rng.integers(3))) for i in range(400)]
    df = spark.createDataFrame(rows, "row_id bigint, features array<double>, label int")
    for limit in (3, 30, None):
        whole = forest.fit_forest(df, 3, forest.ForestParams(trees=3, max_depth=limit))
        assert len(whole.tops) == 3 and whole.subtrees.count() == 3
        most = max(max(depths(r["child"])) for r in whole.subtrees.collect())
        assert most == 3 if limit == 3 else most > 5
    monkeypatch.setattr(forest, "TASK_ROWS", 60)
    top = forest.fit_forest(df, 3, forest.ForestParams(trees=3, max_depth=2))
    assert max(max(depths(t.child)) for t in top.tops) <= 2
    assert all(max(depths(r["child"])) + depths(top.tops[r["tree"]].child)[r["node"]] <= 2 for r in top.subtrees.collect())
    out = top.classify(df).collect()
    assert len(out) == 400 and all(abs(sum(r["probs"]) - 1) < 1e-9 for r in out)


def test_large_forests_do_not_grow_on_the_driver(spark, monkeypatch):
    """All nodes of 300 trees and of several folds used to lie on the driver at once."""
    from pyspark.ml import classification

    from rowsift.operators import models

    monkeypatch.setattr(classification.RandomForestClassifier, "fit", lambda *_: pytest.fail("grown on the driver"))
    rows = [(i, [float(i % 7), float(i % 5)], i % 2) for i in range(60)]
    df = spark.createDataFrame(rows, "row_id bigint, features array<double>, label int")
    spec = models.model_spec("classification", "random_forest", trees=8, max_depth=30)
    monkeypatch.setattr(models, "DRIVER_NODES", 8 * 2 * 60 - 1)
    out = models.fit_classifier(spec, df, 2)(df).collect()
    assert len(out) == 60 and all(len(r["probs"]) == 2 for r in out)
    assert not models._too_many_nodes(df, 8, 2) and models._too_many_nodes(df, 1, None)
