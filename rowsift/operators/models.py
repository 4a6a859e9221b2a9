"""Model fits with pyspark.ml, out-of-fold predictions, variants and sweeps.

Frames carry (row_id, label, features ARRAY<DOUBLE>). Penalties are scaled so
that a model matches one fitted on the summed (not averaged) loss.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowsift.functions.arrays import argmax
from rowsift.functions.hashing import hash_poisson1
from rowsift.functions.runtime import materialize, row_count
from rowsift.operators.boosting import BoostingParams, fit_softmax_boosting
from rowsift.operators.forest import ForestParams, fit_forest
from rowsift.operators.knn import knn_edges, knn_regress, knn_vote
from rowsift.operators.labels import flag_label_issues, prune
from rowsift.operators.metrics import (
    classification_metrics,
    log_loss,
    regression_metrics,
    roc_auc,
    roc_auc_macro,
)
from rowsift.operators.sampling import kfold, kfold_group

#: Fits that may be in flight at once; each is itself a distributed job.
PARALLEL_FITS = 4
#: Most nodes of a forest that ``pyspark.ml`` may grow, as it holds all of them on the driver, several hundred bytes each.
DRIVER_NODES = 250_000
#: Most columns of a ridge that is fitted from Gram matrices of all folds and resamples at once.
RIDGE_WIDTH = 1024


@dataclass(frozen=True)
class ModelSpec:
    """What to fit: task, model name and parameter overrides."""

    task: str
    name: str
    params: dict[str, object] = field(default_factory=dict)
    seed: int = 42

    def merged(self) -> dict[str, object]:
        return {**DEFAULTS[(self.task, self.name)], **self.params}


#: Default parameters per (task, model); fixed values of the model menu. A forest of ``max_depth`` None has no limit.
DEFAULTS: dict[tuple[str, str], dict[str, object]] = {
    ("classification", "logistic_regression"): {"max_iter": 500, "c": 1.0},
    ("classification", "random_forest"): {"trees": 300, "max_depth": 30},
    ("classification", "hist_gradient_boosting"): {"rounds": 100, "step": 0.1, "max_depth": 5},
    ("classification", "softmax_boosting"): {"rounds": 100, "step": 0.1, "max_leaves": 31, "min_rows": 20, "bins": 255},
    ("classification", "knn"): {"n_neighbors": 15},
    ("regression", "ridge"): {"alpha": 1.0},
    ("regression", "random_forest"): {"trees": 500, "max_depth": 30},
    ("regression", "hist_gradient_boosting"): {"rounds": 100, "step": 0.1, "max_depth": 5},
    ("regression", "knn"): {"n_neighbors": 25},
}


def model_spec(task: str, name: str, seed: int = 42, **params: object) -> ModelSpec:
    """Check a model name against the task; unknown pairs raise ValueError."""
    if task not in ("classification", "regression"):
        raise ValueError(f"unknown task: {task}")
    if (task, name) not in DEFAULTS:
        raise ValueError(f"unsupported {task} model: {name}")
    unknown = set(params) - set(DEFAULTS[(task, name)])
    if unknown:
        raise ValueError(f"unknown parameters for {name}: {sorted(unknown)}")
    return ModelSpec(task, name, params, seed)


def _padded(vector: Column, n_classes: int) -> Column:
    probs = vector_to_array(vector)
    zeros = F.array_repeat(F.lit(0.0), F.greatest(F.lit(n_classes) - F.size(probs), F.lit(0)))
    return F.concat(probs, zeros)


Scorer = Callable[[DataFrame], DataFrame]


def _too_many_nodes(train: DataFrame, trees: int, max_depth: int | None) -> bool:
    """Whether a forest may have more nodes than the driver is to hold: a tree has fewer than two per row, or as many as its depth allows."""
    return max_depth is None or trees * min(2 * row_count(train), 2 ** (int(max_depth) + 1)) > DRIVER_NODES


def fit_classifier(spec: ModelSpec, train: DataFrame, n_classes: int) -> Scorer:
    """Fit and return a function that adds ``probs`` (n_classes long) and ``predicted``."""
    p = spec.merged()
    if spec.name == "knn":
        return _knn_classifier(train, int(p["n_neighbors"]), n_classes)
    if spec.name == "softmax_boosting":
        return fit_softmax_boosting(train, n_classes, BoostingParams(**p)).score
    if spec.name == "random_forest" and _too_many_nodes(train, int(p["trees"]), p["max_depth"]):
        return fit_forest(train, n_classes, ForestParams(trees=int(p["trees"]), seed=spec.seed, max_depth=p["max_depth"])).classify
    from pyspark.ml import classification as C

    ready = train.select(F.col("label").cast("double").alias("_y"), array_to_vector("features").alias("_x"))
    names = {"featuresCol": "_x", "labelCol": "_y", "predictionCol": "_yhat"}
    if spec.name == "hist_gradient_boosting":
        model = {"maxIter": int(p["rounds"]), "stepSize": float(p["step"]), "maxDepth": int(p["max_depth"]), "seed": spec.seed}

        def one(k: int):
            binary = ready.withColumn("_y", (F.col("_y") == k).cast("double"))
            booster = C.GBTClassifier(**names, **model).setProbabilityCol(f"_p{k}").setRawPredictionCol(f"_r{k}")
            return booster.fit(binary)

        if n_classes == 2:
            fitted = [one(1)]
        else:
            with ThreadPoolExecutor(PARALLEL_FITS) as pool:
                fitted = list(pool.map(one, range(n_classes)))

        def score_boosted(df: DataFrame) -> DataFrame:
            out = df.withColumn("_x", array_to_vector("features"))
            for m in fitted:
                out = m.transform(out).drop("_yhat")
            if n_classes == 2:
                yes = vector_to_array("_p1")[1]
                out = out.withColumn("probs", F.array(1 - yes, yes))
            else:
                each = F.array(*[vector_to_array(f"_p{k}")[1] for k in range(n_classes)])
                total = F.aggregate(each, F.lit(0.0), lambda a, x: a + x)
                out = out.withColumn("probs", F.transform(each, lambda x: x / total))
            return out.select(*df.columns, "probs").withColumn("predicted", argmax("probs"))

        return score_boosted
    if spec.name == "logistic_regression":
        est = C.LogisticRegression(
            **names,
            regParam=1.0 / (float(p["c"]) * max(1, row_count(ready))),
            elasticNetParam=0.0,
            standardization=False,
            maxIter=int(p["max_iter"]),
        )
    else:
        est = C.RandomForestClassifier(
            **names, numTrees=int(p["trees"]), maxDepth=int(p["max_depth"]), seed=spec.seed, cacheNodeIds=True
        )
    fitted_one = est.fit(ready)

    def score(df: DataFrame) -> DataFrame:
        out = fitted_one.transform(df.withColumn("_x", array_to_vector("features")))
        out = out.withColumn("probs", _padded(F.col("probability"), n_classes))
        return out.select(*df.columns, "probs").withColumn("predicted", argmax("probs"))

    return score


def _knn_classifier(train: DataFrame, k: int, n_classes: int) -> Scorer:
    def score(df: DataFrame) -> DataFrame:
        edges = knn_edges(train, k, queries=df)
        votes = knn_vote(edges, train, n_classes)
        return df.join(votes.withColumnRenamed("i", "row_id"), "row_id").select(*df.columns, "probs", "predicted")

    return score


def fit_regressor(spec: ModelSpec, train: DataFrame, weight: Column | None = None) -> Scorer:
    """Fit and return a function that adds ``predicted``."""
    p = spec.merged()
    if spec.name == "knn":

        def by_neighbours(df: DataFrame) -> DataFrame:
            edges = knn_edges(train, int(p["n_neighbors"]), queries=df)
            means = knn_regress(edges, train, target="label")
            return df.join(means.withColumnRenamed("i", "row_id"), "row_id").select(*df.columns, "predicted")

        return by_neighbours
    if spec.name == "random_forest" and p["max_depth"] is None:
        return fit_forest(train, 0, ForestParams(trees=int(p["trees"]), seed=spec.seed), weight).predict
    from pyspark.ml import regression as R

    w = F.lit(1.0) if weight is None else weight
    ready = train.select(
        F.col("label").cast("double").alias("_y"), array_to_vector("features").alias("_x"), w.alias("_w")
    ).filter("_w > 0")
    names = {"featuresCol": "_x", "labelCol": "_y", "predictionCol": "_yhat", "weightCol": "_w"}
    if spec.name == "ridge":
        # the solver divides the penalty by the weighted std of the target
        stats = ready.agg(F.sum("_w").alias("n"), F.sum(F.col("_w") * F.col("_y")).alias("s"),
                          F.sum(F.col("_w") * F.col("_y") * F.col("_y")).alias("ss")).first()
        n = stats["n"] or 1.0
        var = max(0.0, (stats["ss"] or 0.0) / n - ((stats["s"] or 0.0) / n) ** 2)
        est = R.LinearRegression(
            **names,
            regParam=float(p["alpha"]) / n * (var**0.5 or 1.0),
            elasticNetParam=0.0,
            standardization=False,
            solver="normal",
        )
    elif spec.name == "random_forest":
        est = R.RandomForestRegressor(
            **names, numTrees=int(p["trees"]), maxDepth=int(p["max_depth"]), seed=spec.seed, cacheNodeIds=True
        )
    else:
        est = R.GBTRegressor(
            **names,
            maxIter=int(p["rounds"]),
            stepSize=float(p["step"]),
            maxDepth=int(p["max_depth"]),
            seed=spec.seed,
        )
    fitted = est.fit(ready)

    def score(df: DataFrame) -> DataFrame:
        out = fitted.transform(df.withColumn("_x", array_to_vector("features")))
        return out.select(*df.columns, F.col("_yhat").alias("predicted"))

    return score


def fit(spec: ModelSpec, train: DataFrame, n_classes: int = 0) -> Scorer:
    if spec.task == "classification":
        return fit_classifier(spec, train, n_classes)
    return fit_regressor(spec, train)


#: Learns a feature transformation on training rows and returns it.
Featurizer = Callable[[DataFrame], Callable[[DataFrame], DataFrame]]


def _over_folds(
    df: DataFrame,
    k: int,
    score_fold: Callable[[DataFrame, DataFrame], DataFrame],
    featurize: Featurizer | None = None,
) -> DataFrame:
    """Union of ``score_fold(other folds, this fold)`` for every fold.

    ``featurize`` is learnt anew on the training part of each fold.
    """
    held = materialize(df)

    def one(f: int) -> DataFrame:
        train = held.filter(F.col("fold") != f).drop("fold")
        test = held.filter(F.col("fold") == f).drop("fold")
        if featurize:
            ready = featurize(train)
            train, test = ready(train), ready(test)
        return score_fold(train, test)

    with ThreadPoolExecutor(min(k, PARALLEL_FITS)) as pool:
        parts = list(pool.map(one, range(k)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def out_of_fold_probs(
    df: DataFrame, spec: ModelSpec, n_classes: int, k: int = 5, seed: int = 42, featurize: Featurizer | None = None
) -> DataFrame:
    """Adds ``probs`` and ``predicted`` from models that never saw the row.

    A ``fold`` column in ``df`` is used as it is; otherwise folds are stratified. The models
    of a softmax booster grow in the same passes for all folds.
    """
    folded = df if "fold" in df.columns else kfold(df, k, "label", seed=seed)
    if spec.name == "softmax_boosting" and featurize is None:
        held = materialize(folded)
        booster = fit_softmax_boosting(held, n_classes, BoostingParams(**spec.merged()), folds=k)
        return booster.score(held, "fold").drop("fold")
    return _over_folds(folded, k, lambda train, test: fit_classifier(spec, train, n_classes)(test), featurize)


def out_of_fold_predictions(
    df: DataFrame, spec: ModelSpec, k: int = 5, seed: int = 42, featurize: Featurizer | None = None
) -> DataFrame:
    """Adds ``predicted`` from regressors that never saw the row."""
    folded = df if "fold" in df.columns else kfold(df, k, seed=seed)
    width = None if featurize else _ridge_width(df, spec)
    if width:
        return _ridge_scored(folded, width, spec, k, 0, seed)
    return _over_folds(folded, k, lambda train, test: fit_regressor(spec, train)(test), featurize)


@dataclass
class RidgeSums:
    """Gram matrices of (1, features, label) by fold and by bootstrap resample, summed in one pass.

    ``folds[f]`` sums the rows of fold f, so the fit without it follows by subtraction;
    ``resamples[b]`` sums rows by their Poisson(1) weight.
    """

    folds: np.ndarray
    resamples: np.ndarray

    @staticmethod
    def solve(gram: np.ndarray, alpha: float) -> np.ndarray:
        """Intercept and coefficients of the fit with penalty ``alpha`` on the coefficients alone."""
        n, mean = gram[0, 0], gram[0, 1:] / max(gram[0, 0], 1.0)
        inner = gram[1:, 1:] - n * np.outer(mean, mean)
        d = len(inner) - 1
        w = np.linalg.lstsq(inner[:d, :d] + alpha * np.eye(d), inner[:d, d], rcond=None)[0]
        return np.append(mean[d] - mean[:d] @ w, w)

    def without_fold(self, f: int, alpha: float) -> np.ndarray:
        return self.solve(self.folds.sum(axis=0) - self.folds[f], alpha)


def ridge_sums(df: DataFrame, width: int, k: int = 0, rounds: int = 0, seed: int = 42) -> RidgeSums:
    """One pass over (row_id, features, label[, fold]): each task sums its rows, the sums of all tasks are added.

    The matrices grow with the columns, not with the rows; they are summed row by row of a matrix.
    """
    side, sets = width + 2, k + rounds
    weights = [hash_poisson1(seed + b, "bootstrap", F.col("row_id").cast("string")) for b in range(rounds)]
    fold = F.col("fold").cast("int") if k else F.lit(0)
    rows = df.select(F.col("features").alias("x"), F.col("label").cast("double").alias("y"), fold.alias("fold"), F.array(*weights).cast("array<double>").alias("w"))

    def partial(batches):
        total = np.zeros((sets, side, side))
        for batch in batches:
            if len(batch):
                x = np.stack(batch["x"].to_numpy())
                z = np.column_stack([np.ones(len(x)), x, batch["y"].to_numpy()])
                at = batch["fold"].to_numpy()
                for f in range(k):
                    total[f] += z[at == f].T @ z[at == f]
                for b, w in enumerate(np.stack(batch["w"].to_numpy()).T if rounds else ()):
                    total[k + b] += (z * w[:, None]).T @ z
        for s in range(sets):
            yield pd.DataFrame({"set": s, "row": range(side), "sums": list(total[s])})

    def added(parts: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"set": parts["set"].iloc[:1], "row": parts["row"].iloc[:1], "sums": [np.stack(parts["sums"].to_numpy()).sum(axis=0)]})

    schema = "set int, row int, sums array<double>"
    grams = np.zeros((sets, side, side))
    for r in rows.mapInPandas(partial, schema).groupBy("set", "row").applyInPandas(added, schema).toLocalIterator():
        grams[r["set"], r["row"]] = r["sums"]
    return RidgeSums(grams[:k], grams[k:])


def _ridge_scored(df: DataFrame, width: int, spec: ModelSpec, k: int, rounds: int, seed: int) -> DataFrame:
    """Adds ``predicted`` when there are folds and ``spread`` when there are resamples."""
    held = materialize(df)
    sums = ridge_sums(held, width, k, rounds, seed)
    alpha = float(spec.merged()["alpha"])
    by_fold = np.array([sums.without_fold(f, alpha) for f in range(k)]).reshape(k, width + 1)
    by_resample = np.array([sums.solve(g, alpha) for g in sums.resamples]).reshape(rounds, width + 1)

    @F.pandas_udf("predicted double, spread double")
    def score(x: pd.Series, fold: pd.Series) -> pd.DataFrame:
        z = np.column_stack([np.ones(len(x)), np.stack(x.to_numpy())])
        predicted = (z * by_fold[fold.to_numpy()]).sum(axis=1) if k else np.zeros(len(x))
        spread = (z @ by_resample.T).std(axis=1) if rounds else np.zeros(len(x))
        return pd.DataFrame({"predicted": predicted, "spread": spread})

    out = held.withColumn("_s", score("features", F.col("fold").cast("int") if k else F.lit(0)))
    kept = [c for c in df.columns if not (k and c == "fold")]
    return out.select(*kept, *(["_s.predicted"] if k else []), *(["_s.spread"] if rounds else []))


def _ridge_width(df: DataFrame, spec: ModelSpec) -> int | None:
    """Number of features if the model is a ridge narrow enough to be fitted by its sums."""
    if spec.name != "ridge":
        return None
    first = df.select(F.size("features").alias("d")).first()
    return first["d"] if first is not None and 0 < first["d"] <= RIDGE_WIDTH else None


def out_of_fold_with_spread(df: DataFrame, spec: ModelSpec, k: int = 5, seed: int = 42, rounds: int = 5) -> DataFrame:
    """Adds ``predicted`` from regressors that never saw the row and ``spread`` of bootstrap fits.

    A ridge is fitted for all folds and resamples in one pass over the rows.
    """
    folded = df if "fold" in df.columns else kfold(df, k, seed=seed)
    width = _ridge_width(df, spec)
    if width:
        return _ridge_scored(folded, width, spec, k, rounds, seed)
    oof = out_of_fold_predictions(folded, spec, k, seed)
    return oof.join(bootstrap_spread(df, spec, rounds, seed).select("row_id", "spread"), "row_id")


def fit_binary_relevance(train: DataFrame, n_bits: int, max_iter: int = 500, bits: str = "y") -> Scorer:
    """One logistic model per bit; adds ``p`` (probabilities) and ``yhat`` (0/1).

    A bit that is constant in training keeps that constant as its probability.
    """
    from pyspark.ml.classification import LogisticRegression

    at = [F.element_at(bits, j + 1) for j in range(n_bits)]
    ready = train.select(array_to_vector("features").alias("_x"), *[a.cast("double").alias(f"_y{j}") for j, a in enumerate(at)])
    stats = ready.agg(F.count(F.lit(1)).alias("n"), *[F.avg(f"_y{j}").alias(f"m{j}") for j in range(n_bits)]).first()

    def one(j: int):
        if stats[f"m{j}"] in (0.0, 1.0):
            return None
        return LogisticRegression(
            featuresCol="_x",
            labelCol=f"_y{j}",
            predictionCol=f"_h{j}",
            probabilityCol=f"_p{j}",
            rawPredictionCol=f"_r{j}",
            regParam=1.0 / stats["n"],
            elasticNetParam=0.0,
            standardization=False,
            maxIter=max_iter,
        ).fit(ready)

    with ThreadPoolExecutor(PARALLEL_FITS) as pool:
        models = list(pool.map(one, range(n_bits)))

    def score(df: DataFrame) -> DataFrame:
        out = df.withColumn("_x", array_to_vector("features"))
        probs = []
        for j, m in enumerate(models):
            if m is None:
                probs.append(F.lit(float(stats[f"m{j}"])))
            else:
                out = m.transform(out)
                probs.append(vector_to_array(f"_p{j}")[1])
        out = out.withColumn("p", F.array(*probs))
        return out.select(*df.columns, "p").withColumn(
            "yhat", F.transform("p", lambda x: F.when(x > 0.5, 1).otherwise(0))
        )

    return score


def out_of_fold_bits(
    df: DataFrame, n_bits: int, k: int = 5, seed: int = 42, featurize: Featurizer | None = None
) -> DataFrame:
    """Adds ``p`` and ``yhat`` from bit models that never saw the row."""
    folded = df if "fold" in df.columns else kfold(df, k, seed=seed)
    return _over_folds(folded, k, lambda train, test: fit_binary_relevance(train, n_bits)(test), featurize)


def out_of_fold_tags(df: DataFrame, n_classes: int, k: int = 3, seed: int = 42, max_iter: int = 800) -> DataFrame:
    """Adds ``probs`` from taggers that never saw the sentence."""
    folded = df if "fold" in df.columns else kfold_group(df, "sent_id", k, seed)
    return _over_folds(folded, k, lambda train, test: fit_token_tagger(train, n_classes, max_iter)(test))


#: Change of the loss at which a tagger has converged.
TAGGER_TOLERANCE = 1e-4


def _softmax_probs(coefficients: np.ndarray, intercepts: np.ndarray, n_classes: int):
    """Column function: class probabilities of a vector column, from dense coefficients (columns x classes).

    ``pyspark.ml`` may keep the coefficients sparse by class and then walks all of them for every row.
    """

    @F.arrow_udf("array<double>")
    def probs(vectors: pa.Array) -> pa.Array:
        n, sparse = len(vectors), vectors.field("type").to_numpy(zero_copy_only=False) == 0
        values = vectors.field("values")
        sizes = pc.list_value_length(values).to_numpy(zero_copy_only=False)
        x, row = values.flatten().to_numpy(zero_copy_only=False), np.repeat(np.arange(n), sizes)
        at = np.arange(len(x)) - np.repeat(np.cumsum(sizes) - sizes, sizes)  # a dense vector names no columns
        at[sparse[row]] = vectors.field("indices").flatten().to_numpy(zero_copy_only=False)
        terms = coefficients[at] * x[:, None]
        margin = np.stack([np.bincount(row, t, n) for t in terms.T], axis=1) + intercepts
        top = margin.max(axis=1, keepdims=True)
        with np.errstate(invalid="ignore"):
            share = np.where(margin == top, 1.0, np.exp(margin - top))
        out = np.zeros((n, max(n_classes, share.shape[1])))
        out[:, : share.shape[1]] = share / share.sum(axis=1, keepdims=True)
        return pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * out.shape[1], pa.int32()), pa.array(out.ravel()))

    return probs


def fit_token_tagger(train: DataFrame, n_classes: int, max_iter: int = 800) -> Scorer:
    """Multinomial logistic model on a sparse ``features`` vector column."""
    from pyspark.ml.classification import LogisticRegression

    ready = train.select("features", F.col("label").cast("double").alias("_y"))
    model = LogisticRegression(
        featuresCol="features",
        labelCol="_y",
        predictionCol="_yhat",
        family="multinomial",
        regParam=1.0 / max(1, row_count(ready)),
        elasticNetParam=0.0,
        standardization=False,
        maxIter=max_iter,
        tol=TAGGER_TOLERANCE,
    ).fit(ready)
    probs = _softmax_probs(model.coefficientMatrix.toArray().T.copy(), model.interceptVector.toArray(), n_classes)

    def score(df: DataFrame) -> DataFrame:
        out = df.withColumn("probs", probs("features"))
        return out.select(*df.columns, "probs").withColumn("predicted", argmax("probs"))

    return score


def bootstrap_spread(df: DataFrame, spec: ModelSpec, rounds: int = 5, seed: int = 42) -> DataFrame:
    """Adds ``spread``: population std of the predictions of bootstrap fits.

    A resample is a Poisson(1) weight per row, so no rows are copied.
    """
    width = _ridge_width(df, spec)
    if width:
        return _ridge_scored(df, width, spec, 0, rounds, seed)
    fits = [
        fit_regressor(spec, df, hash_poisson1(seed + b, "bootstrap", F.col("row_id").cast("string")))
        for b in range(rounds)
    ]
    out = df
    for b, f in enumerate(fits):
        out = f(out).withColumnRenamed("predicted", f"_b{b}")
    cols = [F.col(f"_b{b}") for b in range(rounds)]
    mean = sum(cols[1:], cols[0]) / rounds
    square = sum(((c - mean) * (c - mean) for c in cols[1:]), (cols[0] - mean) * (cols[0] - mean))
    return out.withColumn("spread", F.sqrt(square / rounds)).drop(*[f"_b{b}" for b in range(rounds)])


# -- scores and variants -----------------------------------------------------


def score_metrics(scored: DataFrame, task: str, n_classes: int = 0) -> DataFrame:
    """(metric, value) rows of a scored test set; AUC only when it can be computed."""
    if task == "regression":
        return regression_metrics(scored, "label", "predicted")
    basic = classification_metrics(scored, "label", "predicted")
    if n_classes == 2:
        auc = roc_auc(scored.withColumn("_s", F.element_at("probs", 2)), "label", "_s")
    else:
        auc = roc_auc_macro(scored, "label", "probs")
    loss = log_loss(scored, "label", "probs")
    one = lambda d, c, name: d.select(F.lit(name).alias("metric"), F.col(c).alias("value")).filter("value IS NOT NULL")
    return basic.unionByName(one(auc, "auc", "roc_auc")).unionByName(one(loss, "log_loss", "log_loss"))


def primary_name(task: str) -> tuple[str, ...]:
    """Metric names in order of preference for the primary metric of a task."""
    return ("r2",) if task == "regression" else ("roc_auc", "f1_weighted")


def fit_and_score(
    variant: str,
    spec: ModelSpec,
    train: DataFrame,
    test: DataFrame,
    n_classes: int = 0,
    featurize: Featurizer | None = None,
) -> DataFrame:
    """(variant, metric, value) rows of one fit."""
    if featurize:
        ready = featurize(train)
        train, test = ready(train), ready(test)
    scored = materialize(fit(spec, train, n_classes)(test))
    return score_metrics(scored, spec.task, n_classes).select(F.lit(variant).alias("variant"), "metric", "value")


def variant_delta(metrics: DataFrame, task: str = "classification", baseline: str = "baseline") -> DataFrame:
    """(variant, primary, delta) against the baseline variant, best first."""
    order = primary_name(task)
    pick = [F.max(F.when(F.col("metric") == m, F.col("value"))) for m in order]
    table = metrics.groupBy("variant").agg(F.coalesce(*pick).alias("primary"))
    base = F.max(F.when(F.col("variant") == baseline, F.col("primary"))).over(Window.partitionBy())
    return table.withColumn("delta", F.col("primary") - base).orderBy(F.desc("primary"), "variant")


def clean_learning(
    train: DataFrame,
    test: DataFrame,
    spec: ModelSpec,
    n_classes: int,
    k: int = 5,
    featurize: Featurizer | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Find label issues by cross-validation, drop them, refit: (metrics, issues)."""
    probs = materialize(out_of_fold_probs(train, spec, n_classes, k, featurize=featurize).select("row_id", "label", "probs"))
    issues = materialize(flag_label_issues(probs, n_classes))
    kept = prune(train, issues)
    return fit_and_score("clean_learning", spec, kept, test, n_classes, featurize), issues


def sweep(
    specs: Sequence[ModelSpec],
    train: DataFrame,
    test: DataFrame,
    n_classes: int = 0,
    featurize: Featurizer | None = None,
) -> tuple[DataFrame, dict[str, str]]:
    """(variant = model, metric, value) of every model, and the errors of those whose settings or values do not fit.

    Only a ``ValueError`` leaves a model out: a job, a worker or a driver step that failed says nothing about the
    model and is raised. The caller must look at the errors, as the rows alone do not show that a model is missing.
    """
    held_train, held_test = materialize(train), materialize(test)

    def one(spec: ModelSpec) -> DataFrame | str:
        try:
            return materialize(fit_and_score(spec.name, spec, held_train, held_test, n_classes, featurize))
        except ValueError as e:  # the other models go on
            return f"{type(e).__name__}: {e}".splitlines()[0]

    # fits are many short jobs one after the other, so models wait for each other's driver steps, not for cores
    with ThreadPoolExecutor(PARALLEL_FITS) as pool:
        done = list(pool.map(one, specs))
    parts = [d for d in done if not isinstance(d, str)]
    errors = {s.name: d for s, d in zip(specs, done, strict=True) if isinstance(d, str)}
    if not parts:
        raise RuntimeError(f"every model failed: {errors}")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out, errors
