"""Model fits against closed forms, and the flows on data with planted errors."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from rowsift.functions.hashing import hash_poisson1
from rowsift.operators import models
from rowsift.operators.sampling import kfold
from rowsift.plans import general, tasks
from rowsift.plans import configs as C
from rowsift.plans.results import RunOutput


def frame(spark, x, y, kind="int"):
    rows = [(i, [float(v) for v in r], y[i].item()) for i, r in enumerate(x)]
    return spark.createDataFrame(rows, f"row_id bigint, features array<double>, label {kind}")


@pytest.fixture(scope="module")
def linear(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(200, 4)) * [1, 3, 0.5, 2]
    y = x @ [1.0, -2.0, 0.5, 0.0] + 3 + rng.normal(0, 0.5, 200)
    return x, y, frame(spark, x, y, "double")


@pytest.fixture(scope="module")
def classes(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 4))
    y = np.digitize(x[:, 0], [-0.5, 0.5])
    return x, y, frame(spark, x, y)


@pytest.mark.parametrize("alpha", [1.0, 50.0])
def test_ridge_matches_closed_form(linear, alpha):
    x, y, df = linear
    c = x - x.mean(0)
    w = np.linalg.solve(c.T @ c + alpha * np.eye(4), c.T @ (y - y.mean()))
    want = y.mean() + c @ w
    score = models.fit_regressor(models.model_spec("regression", "ridge", alpha=alpha), df)
    got = np.array([r["predicted"] for r in score(df).orderBy("row_id").collect()])
    assert np.allclose(got, want, atol=1e-6)


def test_logistic_matches_gradient_descent(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(150, 2)) * [1, 4]
    y = (x[:, 0] + 0.2 * x[:, 1] + rng.normal(size=150) > 0).astype(int)
    w, b = np.zeros(2), 0.0
    for _ in range(20_000):  # sum of losses + |w|^2 / 2
        p = 1 / (1 + np.exp(-(x @ w + b)))
        w -= 0.002 * (x.T @ (p - y) + w)
        b -= 0.002 * (p - y).sum()
    df = frame(spark, x, y)
    got = models.fit_classifier(models.model_spec("classification", "logistic_regression"), df, 2)(df)
    p1 = np.array([r["probs"][1] for r in got.orderBy("row_id").collect()])
    assert np.allclose(p1, 1 / (1 + np.exp(-(x @ w + b))), atol=2e-3)


@pytest.mark.parametrize("name, params", [("logistic_regression", {}), ("random_forest", {"trees": 10, "max_depth": 5}), ("hist_gradient_boosting", {"rounds": 3}), ("knn", {})])
def test_out_of_fold_probs(classes, name, params):
    _, y, df = classes
    out = models.out_of_fold_probs(df, models.model_spec("classification", name, **params), 3, 3).collect()
    assert len(out) == len(y) == len({r["row_id"] for r in out})
    assert all(abs(sum(r["probs"]) - 1) < 1e-6 and len(r["probs"]) == 3 for r in out)
    assert np.mean([r["predicted"] == r["label"] for r in out]) > 0.7


@pytest.mark.parametrize("name, params", [("ridge", {}), ("random_forest", {"trees": 10}), ("hist_gradient_boosting", {"rounds": 5}), ("knn", {})])
def test_out_of_fold_predictions(linear, name, params):
    _, y, df = linear
    out = models.out_of_fold_predictions(df, models.model_spec("regression", name, **params), 3).collect()
    assert len({r["row_id"] for r in out}) == len(y)
    assert np.corrcoef([r["label"] for r in out], [r["predicted"] for r in out])[0, 1] > 0.7


def test_ridge_sums_equal_separate_fits(linear):
    """Folds by subtraction and Poisson resamples from one pass, against a fit of each by the closed form."""
    x, y, df = linear
    spec = models.model_spec("regression", "ridge")
    folded = kfold(df, 3)
    got = {r["row_id"]: r for r in models.out_of_fold_with_spread(folded, spec, 3, rounds=2).collect()}
    weights = [hash_poisson1(42 + b, "bootstrap", F.col("row_id").cast("string")).alias(f"w{b}") for b in range(2)]
    rows = folded.select("row_id", "fold", "features", "label", *weights).collect()
    z, t = np.array([r["features"] for r in rows]), np.array([r["label"] for r in rows])

    def fitted(w):
        mx, my = (z * w[:, None]).sum(0) / w.sum(), (t * w).sum() / w.sum()
        zc = (z - mx) * np.sqrt(w)[:, None]
        c = np.linalg.solve(zc.T @ zc + np.eye(z.shape[1]), zc.T @ ((t - my) * np.sqrt(w)))
        return my + (z - mx) @ c

    folds = np.array([r["fold"] for r in rows])
    oof = {f: fitted((folds != f).astype(float)) for f in range(3)}
    spread = np.std([fitted(np.array([r[f"w{b}"] for r in rows])) for b in range(2)], axis=0)
    for i, r in enumerate(rows):
        assert got[r["row_id"]]["predicted"] == pytest.approx(oof[r["fold"]][i], abs=1e-9)
        assert got[r["row_id"]]["spread"] == pytest.approx(spread[i], abs=1e-9)
    one = models.out_of_fold_predictions(df, models.model_spec("regression", "ridge"), 3)
    assert "fold" not in one.columns and one.count() == len(y)


def test_missing_class_in_training_is_padded(classes):
    _, _, df = classes
    spec = models.model_spec("classification", "logistic_regression")
    out = models.fit_classifier(spec, df.filter("label < 2"), 3)(df).first()
    assert len(out["probs"]) == 3 and out["probs"][2] == 0.0


def test_constant_bit(spark, classes):
    x, y, _ = classes
    rows = [(i, [float(v) for v in r], [1, int(r[0] > 0)]) for i, r in enumerate(x)]
    df = spark.createDataFrame(rows, "row_id bigint, features array<double>, y array<int>")
    out = models.fit_binary_relevance(df, 2)(df).collect()
    assert {r["p"][0] for r in out} == {1.0}
    assert np.mean([r["yhat"][1] == r["y"][1] for r in out]) > 0.9


def test_factory_errors():
    for task, name in [("classification", "ridge"), ("regression", "logistic_regression"), ("classification", "extra_trees"), ("ranking", "knn")]:
        with pytest.raises(ValueError):
            models.model_spec(task, name)
    with pytest.raises(ValueError):
        models.model_spec("classification", "knn", depth=3)


def test_sweep_skips_failing_model(monkeypatch, classes):
    _, _, df = classes
    broken = models.ModelSpec("classification", "logistic_regression", {"c": "x"})
    rows, errors = models.sweep([broken, models.model_spec("classification", "knn")], df, df, 3)
    assert {r["variant"] for r in rows.collect()} == {"knn"} and list(errors) == ["logistic_regression"]


def test_variant_delta(spark):
    m = spark.createDataFrame(
        [("baseline", "roc_auc", 0.7), ("b", "roc_auc", 0.9), ("b", "f1_weighted", 0.1), ("c", "f1_weighted", 0.2)],
        "variant string, metric string, value double",
    )
    got = [(r["variant"], round(r["primary"], 6), round(r["delta"], 6)) for r in models.variant_delta(m).collect()]
    assert got == [("b", 0.9, 0.2), ("baseline", 0.7, 0.0), ("c", 0.2, -0.5)]


def unit(out: RunOutput):
    assert all(0 <= r["value"] <= 1 for r in out.metrics.filter("metric <> 'log_loss'").collect())


def test_multiclass_run(classes):
    _, _, df = classes
    cfg = C.MulticlassConfig(noise_frac=0.2, prune_frac=0.2, cv_folds=3)
    a, b = tasks.run_multiclass(df, cfg), tasks.run_multiclass(df, cfg)
    unit(a)
    assert a.summary == b.summary and a.summary["n_issues_found"] > 0
    assert a.summary["n_train"] + a.summary["n_test"] == 300 and a.summary["n_planted"] == 48
    assert a.summary["precision_at_prune"] > 0.7
    assert {r["variant"] for r in a.metrics.collect()} == {"baseline", "pruned_retrain"}


def test_multilabel_run(spark, classes):
    x, _, _ = classes
    rows = [(i, [float(v) for v in r], [int(v > 0.3) for v in r[:3]]) for i, r in enumerate(x)]
    df = spark.createDataFrame(rows, "row_id bigint, features array<double>, y array<int>")
    out = tasks.run_multilabel(df, 3, C.MultilabelConfig(noise_frac=0.1, cv_folds=3))
    unit(out)
    assert out.summary["n_planted"] == 24 and out.summary["precision_at_prune"] > 0.7


def test_regression_run(linear):
    _, _, df = linear
    out = tasks.run_regression(df, C.RegressionConfig(model="ridge", noise_frac=0.1, prune_frac=0.1, cv_folds=3))
    assert out.summary["n_planted"] == 16 == out.summary["n_pruned"] and out.summary["recall_at_prune"] > 0.6
    r2 = {r["variant"]: r["value"] for r in out.metrics.filter("metric = 'r2'").collect()}
    assert r2["pruned_retrain"] > r2["baseline"]


def test_token_run(spark):
    rng = np.random.default_rng(3)
    vocab = [f"w{i}" for i in range(30)]
    rows = []
    for s in range(80):
        for t in range(int(rng.integers(5, 12))):
            w = int(rng.integers(30))
            rows.append((s, t, vocab[w], "ABC"[w % 3]))
    df = spark.createDataFrame(rows, "sent_id bigint, tok_i int, token string, tag string")
    cfg = C.TokenConfig(max_train_sentences=None, max_dev_sentences=None, noise_frac=0.1, cv_folds=2, max_iter=20, prune_frac=0.1)
    out = tasks.run_token(df.filter("sent_id < 60"), df.filter("sent_id >= 60"), cfg, vector_size=1 << 12)
    unit(out)
    assert out.summary["precision_at_prune"] > 0.8


def test_token_tagger_scores_with_dense_coefficients(spark):
    """Few used columns of many: the fitted model keeps its coefficients sparse by class and walked them for every row."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.linalg import Vectors, VectorUDT
    from pyspark.sql import types as T

    rng = np.random.default_rng(8)
    size = 1 << 12
    used = [sorted(rng.choice(60, int(rng.integers(0, 5)), replace=False).tolist()) for _ in range(200)]
    rows = [(i, int(sum(c) % 3) if c else 0, Vectors.sparse(size, c, [1.0] * len(c))) for i, c in enumerate(used)]
    rows.append((200, 1, Vectors.dense([1.0] + [0.0] * (size - 1))))
    schema = T.StructType([T.StructField("i", T.LongType()), T.StructField("label", T.IntegerType()), T.StructField("features", VectorUDT())])
    df = spark.createDataFrame(rows, schema)
    scored = models.fit_token_tagger(df, 4, 20)(df)
    assert "ArrowEvalPython" in scored.select("probs")._jdf.queryExecution().executedPlan().toString()
    want = LogisticRegression(
        labelCol="label", family="multinomial", regParam=1.0 / 201, standardization=False, maxIter=20, tol=models.TAGGER_TOLERANCE
    ).fit(df).transform(df)
    got = {r["i"]: r for r in scored.collect()}
    for r in want.collect():
        assert np.allclose(got[r["i"]]["probs"], [*r["probability"].toArray(), 0.0], atol=1e-9)
        assert got[r["i"]]["predicted"] == int(np.argmax(r["probability"].toArray()))
    one = df.withColumn("label", F.lit(2))  # a single class has an infinite intercept
    assert {tuple(r["probs"]) for r in models.fit_token_tagger(one, 3, 5)(one).collect()} == {(0.0, 0.0, 1.0)}


def test_outlier_run(spark):
    rng = np.random.default_rng(4)
    df = spark.createDataFrame(
        [(i, float(a), float(b)) for i, (a, b) in enumerate(rng.normal(5, 1, size=(300, 2)))], "row_id bigint, a double, b double"
    )
    out = tasks.run_outlier(df, ["a", "b"], C.OutlierConfig(outlier_frac=0.03))
    assert out.summary["n_injected"] == 9 and out.summary["recall_vs_injected"] > 0.8 and not out.errors
    assert {r["issue_type"] for r in out.frames["issue_summary"].collect()} == {"outlier", "near_duplicate", "non_iid"}


def test_multiannotator_run(spark):
    rng = np.random.default_rng(6)
    truth = rng.integers(0, 2, 60)
    rows = [(e, a, ["no", "yes"][int(truth[e] ^ (rng.random() < 0.15))]) for e in range(60) for a in range(6) if rng.random() < 0.7]
    ann = spark.createDataFrame(rows, "example_id bigint, annotator_id bigint, label string")
    feats = spark.createDataFrame([(e, [float(truth[e] + rng.normal(0, 0.3))]) for e in range(60)], "example_id bigint, features array<double>")
    out = tasks.run_multiannotator(ann, feats, C.MultiannotatorConfig(cv_folds=3, top_k=5))
    assert out.summary["n_classes"] == 2 and out.frames["label_next"].count() == 5
    agreed = {r["example_id"]: r["label"] for r in out.frames["weighted"].collect()}
    assert np.mean([agreed[e] == truth[e] for e in agreed]) > 0.85


def test_general_run_classification(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(size=240)
    rows = [(i, float(v), "abc"[i % 3], ">50K" if v > 0 else "<=50K") for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "row_id bigint, x double, cat string, income string")
    cfg = C.AuditConfig(issues=C.IssueConfig(cv_folds=3, train_clean_learning=True), noise=C.NoiseConfig(label_noise_fraction=0.1))
    out = general.run_audit(df, "income", cfg)
    assert out.errors == {} and out.summary["n_train"] + out.summary["n_test"] == 240
    assert {r["variant"] for r in out.metrics.collect()} == {"baseline", "pruned_retrain", "clean_learning"}
    assert {r["label"] for r in out.frames["label_issues"].collect()} <= {">50K", "<=50K"}
    assert out.frames["issue_summary"].count() == 4
    ex = out.frames["issue_examples"].filter("issue_type = 'label'").first()
    assert ex["row"]["x"] is not None
    one = out.to_frame(spark).first()
    assert one["model"] == "logistic_regression" and len(one["metrics"]) > 0
    with pytest.raises(ValueError):
        general.run_audit(df, "missing", cfg)


def test_general_run_regression_and_sweep(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=200)
    rows = [(i, float(v), "wxyz"[i % 4], float(10 * v + rng.normal(0, 0.5))) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "row_id bigint, x double, season string, cnt double")
    out = general.run_audit(df, "cnt", C.AuditConfig(task="regression", issues=C.IssueConfig(cv_folds=3)))
    assert out.errors == {} and out.summary["n_pruned"] > 0
    assert out.metrics.filter("variant = 'baseline' AND metric = 'r2'").first()["value"] > 0.9
    fast = C.AuditConfig(task="regression", issues=C.IssueConfig(enabled=False))
    swept, errors = general.run_sweep(df, "cnt", ["ridge", "logistic_regression"], fast)
    assert {r["model"] for r in swept.collect()} == {"ridge"} and "logistic_regression" in errors
    assert swept.filter(F.col("metric") == "r2").count() == 1


def test_forests_keep_node_ids_between_passes(spark, monkeypatch):
    """Every pass used to send all trees so far and walk them from the root."""
    from pyspark.ml import classification, regression

    asked = []
    for kind in (classification.RandomForestClassifier, regression.RandomForestRegressor):
        monkeypatch.setattr(kind, "fit", lambda self, df, fit=kind.fit: asked.append(self) or fit(self, df))
    rows = [(i, [float(i % 7), float(i % 5)], i % 2) for i in range(60)]
    df = spark.createDataFrame(rows, "row_id bigint, features array<double>, label int")
    models.fit(models.model_spec("classification", "random_forest", trees=2, max_depth=2), df, 2)
    models.fit(models.model_spec("regression", "random_forest", trees=2, max_depth=2), df.withColumn("label", df["label"].cast("double")))
    assert len(asked) == 2 and all(a.getCacheNodeIds() for a in asked)


def test_sweep_fits_models_side_by_side(monkeypatch, classes):
    """Models used to wait for one another; the errors and the order stay."""
    import threading

    both, score = threading.Barrier(2, timeout=30), models.fit_and_score

    def met(variant, *rest):
        both.wait()
        if variant == "knn":
            raise ValueError("no neighbours")
        return score(variant, *rest)

    monkeypatch.setattr(models, "fit_and_score", met)
    specs = [models.model_spec("classification", n) for n in ("logistic_regression", "knn")]
    out, errors = models.sweep(specs, classes[2], classes[2], 3)
    assert {r["variant"] for r in out.collect()} == {"logistic_regression"}
    assert errors == {"knn": "ValueError: no neighbours"}


@pytest.mark.parametrize("error", [OSError("no space"), ValueError("no neighbours")])
def test_model_sweep_does_not_hide_a_failed_model(spark, monkeypatch, error):
    """The rows of the other models used to come back as the whole sweep."""
    from rowsift.catalog import learning

    real = models.fit_and_score

    def one(variant, *rest):
        if variant == "knn":
            raise error
        spec, *others = rest
        return real(variant, models.model_spec("classification", "logistic_regression", max_iter=2), *others)

    points = spark.createDataFrame([(i, [float(i % 5), float(i % 7)], i % 3) for i in range(60)], "row_id bigint, features array<double>, label int")
    monkeypatch.setattr(models, "fit_and_score", one)
    monkeypatch.setattr(learning, "labelled_points", lambda *_: points)
    with pytest.raises((RuntimeError, OSError), match="no space|models failed.*no neighbours"):
        learning.model_sweep(spark, "")


def test_sweep_raises_what_is_not_the_models_fault(monkeypatch, classes):
    """A failed job used to be noted beside the rows of the other models."""

    def lost(variant, *rest):
        raise OSError("no space")

    monkeypatch.setattr(models, "fit_and_score", lost)
    with pytest.raises(OSError):
        models.sweep([models.model_spec("classification", n) for n in ("knn", "logistic_regression")], classes[2], classes[2], 3)
