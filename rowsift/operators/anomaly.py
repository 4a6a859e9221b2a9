"""Anomaly strategies. Scores lie in [0, 1] and low means anomalous."""

from __future__ import annotations

import math
import random
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowsift.functions.arrays import safe_divide
from rowsift.functions.hashing import hash_key
from rowsift.functions.ranking import KEY_DIGITS, exact_percentile, range_rank
from rowsift.functions.runtime import collect_small, materialize, row_count
from rowsift.functions.skew import skew_join
from rowsift.operators.audit import inverted_min_max, mean_distance
from rowsift.operators.knn import knn_edges

#: Fixed values of the isolation forest paper.
EULER_GAMMA = 0.5772156649
TREE_ROWS = 256


def flag_lowest(scores: DataFrame, contamination: float, score: str = "score", out: str = "is_anomaly") -> DataFrame:
    """Flag scores strictly below the ``contamination`` percentile."""
    bar = exact_percentile(scores, score, contamination)
    return scores.withColumn(out, F.coalesce(F.col(score) < F.lit(bar), F.lit(False)))


def fill_score(scores: DataFrame, score: str = "score") -> DataFrame:
    """Missing scores become 0.5."""
    return scores.withColumn(score, F.coalesce(score, F.lit(0.5)))


def knn_scores(edges: DataFrame) -> DataFrame:
    """(row_id, score) from the mean neighbour distance."""
    return fill_score(inverted_min_max(mean_distance(edges), "d").select("row_id", "score"))


def lof_scores(edges: DataFrame) -> DataFrame:
    """(row_id, score, lof): local outlier factor of Breunig et al. 2000.

    Neighbour values are looked up with hot-key splitting, because one row may
    be the neighbour of very many others.
    """
    reach_of = edges.groupBy(F.col("i").alias("j")).agg(F.max("dist").alias("k_dist"))
    reach = skew_join(edges, reach_of, ["j"]).select("i", "j", F.greatest("k_dist", "dist").alias("reach"))
    density = materialize(
        reach.groupBy("i").agg((1.0 / F.greatest(F.avg("reach"), F.lit(1e-10))).alias("lrd"))
    )
    around = skew_join(edges.select("i", "j"), density.select(F.col("i").alias("j"), F.col("lrd").alias("lrd_j")), ["j"])
    mean = around.groupBy("i").agg(F.avg("lrd_j").alias("near"))
    lof = mean.join(density, "i").select(
        F.col("i").alias("row_id"), F.round(F.col("near") / F.col("lrd"), KEY_DIGITS).alias("lof")
    )
    return inverted_min_max(lof, "lof").select("row_id", "score", "lof")


# -- isolation forest --------------------------------------------------------


def _average_path(m):
    """Mean depth of an unsuccessful search among m rows."""
    m = np.asarray(m, dtype=float)
    big = np.maximum(m, 2.0)
    return np.where(m > 1, 2.0 * (np.log(big - 1.0) + EULER_GAMMA) - 2.0 * (big - 1.0) / big, 0.0) * np.where(
        m > 2, 1.0, 0.0
    ) + np.where(m == 2, 1.0, 0.0)


def _tree_builder(seed: int):
    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        tree = int(pdf["tree"].iloc[0])
        x = np.stack(pdf.sort_values("row_id")["features"].to_numpy()).astype(float)
        rng = np.random.default_rng([seed, tree])
        deepest = max(1, math.ceil(math.log2(max(2, len(x)))))
        column, split, left, right, length = [], [], [], [], []
        work = [(np.arange(len(x)), 0, -1, False)]
        while work:
            rows, depth, parent, on_right = work.pop()
            me = len(column)
            if parent >= 0:
                (right if on_right else left)[parent] = me
            low, high = x[rows].min(axis=0), x[rows].max(axis=0)
            usable = np.nonzero(high > low)[0]
            leaf = depth >= deepest or len(rows) <= 1 or not len(usable)
            c = -1 if leaf else int(rng.choice(usable))
            at = 0.0 if leaf else float(rng.uniform(low[c], high[c]))
            column.append(c)
            split.append(at)
            left.append(-1)
            right.append(-1)
            length.append(depth + float(_average_path(len(rows))) if leaf else 0.0)
            if not leaf:
                goes = x[rows, c] <= at
                work.append((rows[goes], depth + 1, me, False))
                work.append((rows[~goes], depth + 1, me, True))
        return pd.DataFrame(
            {"tree": [tree], "col": [column], "at": [split], "l": [left], "r": [right], "len": [length]}
        )

    return build


def _tree_samples(df: DataFrame, n: int, trees: int, per_tree: int, seed: int) -> DataFrame:
    """(tree, row_id, features): ``per_tree`` rows for each tree, all of them if there are fewer.

    The wanted ranks of each tree are drawn here, trees * per_tree numbers; one ranking
    of the rows by hash finds them. Trees may share rows, whatever the size of the table.
    """
    wanted = [
        (tree, rank)
        for tree in range(trees)
        for rank in random.Random(f"{seed}:{tree}").sample(range(1, n + 1), min(per_tree, n))
    ]
    table = df.sparkSession.createDataFrame(wanted, "tree int, _rank bigint")
    keyed = df.select("row_id", hash_key(seed, "forest", "row_id").alias("_key"))
    ranked = range_rank(keyed, [F.col("_key"), F.col("row_id")], out="_rank", rows=n)
    ids = ranked.withColumn("_rank", F.col("_rank").cast("bigint")).join(F.broadcast(table), "_rank").select("tree", "row_id")
    return df.select("row_id", "features").join(F.broadcast(ids), "row_id").select("tree", "row_id", "features")


def forest_scores(df: DataFrame, trees: int = 100, seed: int = 42, per_tree: int = TREE_ROWS) -> DataFrame:
    """(row_id, score) of an isolation forest over ``features ARRAY<DOUBLE>``.

    Trees are built one group each from at most 256 rows, so the whole forest
    is at most trees * 511 nodes; rows are scored in Arrow batches.
    """
    n = row_count(df)
    size = min(per_tree, n)
    samples = _tree_samples(df, n, trees, size, seed)
    built = samples.groupBy("tree").applyInPandas(
        _tree_builder(seed),
        "tree int, col array<int>, at array<double>, l array<int>, r array<int>, len array<double>",
    )
    rows = sorted(collect_small(built, trees), key=lambda r: r["tree"])
    forest = [
        (np.array(r["col"]), np.array(r["at"]), np.array(r["l"]), np.array(r["r"]), np.array(r["len"]))
        for r in rows
    ]
    shared = df.sparkSession.sparkContext.broadcast(forest)
    norm = float(_average_path(size)) or 1.0

    @F.pandas_udf("double")
    def isolation(features: pd.Series) -> pd.Series:
        x = np.stack(features.to_numpy()).astype(float)
        depth = np.zeros(len(x))
        for col, at, left, right, length in shared.value:
            node = np.zeros(len(x), dtype=np.int64)
            while True:
                c = col[node]
                inner = np.nonzero(c >= 0)[0]
                if not len(inner):
                    break
                here = node[inner]
                goes = x[inner, c[inner]] <= at[here]
                node[inner] = np.where(goes, left[here], right[here])
            depth += length[node]
        return pd.Series(np.exp2(-(depth / len(shared.value)) / norm))

    raw = materialize(df.select("row_id", F.round(isolation("features"), KEY_DIGITS).alias("s")))
    return inverted_min_max(raw, "s").select("row_id", "score")


# -- ensemble and registry ---------------------------------------------------


def ensemble_scores(members: list[DataFrame]) -> DataFrame:
    """Mean of the members' scores per row."""
    out = members[0].select("row_id", F.col("score").alias("s0"))
    for i, m in enumerate(members[1:], 1):
        out = out.join(m.select("row_id", F.col("score").alias(f"s{i}")), "row_id")
    total = sum((F.col(f"s{i}") for i in range(1, len(members))), F.col("s0"))
    return out.select("row_id", F.round(total / len(members), KEY_DIGITS).alias("score"))


def _strategy_knn(df: DataFrame, edges: DataFrame | None, cfg) -> DataFrame:
    return knn_scores(edges if edges is not None else knn_edges(df, cfg.n_neighbors))


def _strategy_lof(df: DataFrame, edges: DataFrame | None, cfg) -> DataFrame:
    found = edges if edges is not None else knn_edges(df, cfg.n_neighbors)
    return lof_scores(found).select("row_id", "score")


def _strategy_forest(df: DataFrame, edges: DataFrame | None, cfg) -> DataFrame:
    return forest_scores(df, cfg.n_estimators, cfg.seed)


#: Members of the ensemble, in the order of their mean.
ENSEMBLE = ("knn", "isolation_forest", "lof")


def ensemble_members(df: DataFrame, edges: DataFrame | None, cfg) -> list[DataFrame]:
    """Scores of every member. One that fails stops the ensemble: a mean of the others would look like a result."""
    found = edges if edges is not None else knn_edges(df, cfg.n_neighbors)
    members = []
    for name in ENSEMBLE:
        try:
            members.append(materialize(get_strategy(name)(df, found, cfg)))
        except Exception as e:
            raise RuntimeError(f"member {name} of the ensemble failed: {type(e).__name__}: {e}") from e
    return members


def _strategy_ensemble(df: DataFrame, edges: DataFrame | None, cfg) -> DataFrame:
    return ensemble_scores(ensemble_members(df, edges, cfg))


Strategy = Callable[[DataFrame, "DataFrame | None", object], DataFrame]

_STRATEGIES: dict[str, Strategy] = {
    "knn": _strategy_knn,
    "isolation_forest": _strategy_forest,
    "lof": _strategy_lof,
    "ensemble": _strategy_ensemble,
}


def list_strategies() -> list[str]:
    return sorted(_STRATEGIES)


def get_strategy(name: str) -> Strategy:
    """Strategy function (rows, shared edges or None, config) -> (row_id, score)."""
    if name not in _STRATEGIES:
        raise ValueError(f"unknown strategy: {name}; known: {', '.join(list_strategies())}")
    return _STRATEGIES[name]


# -- results -----------------------------------------------------------------


def anomaly_summary(scored: DataFrame, truth: Column | None = None) -> DataFrame:
    """One row: sizes, rate and, with ground truth, TP/FP/FN, precision, recall, F1."""
    found = F.col("is_anomaly")
    base = [
        F.count(F.lit(1)).alias("n_total"),
        F.count_if(found).alias("n_anomalies_detected"),
        F.coalesce(F.avg(found.cast("double")), F.lit(0.0)).alias("contamination_rate"),
    ]
    if truth is None:
        empty = {c: "bigint" for c in ("n_actual_anomalies", "true_positives", "false_positives", "false_negatives")}
        empty |= {c: "double" for c in ("precision", "recall", "f1_score")}
        return scored.agg(*base).select("*", *[F.lit(None).cast(t).alias(c) for c, t in empty.items()])
    is_bad = truth.cast("boolean")
    counts = scored.agg(
        *base,
        F.count_if(is_bad).alias("n_actual_anomalies"),
        F.count_if(found & is_bad).alias("true_positives"),
        F.count_if(found & ~is_bad).alias("false_positives"),
        F.count_if(~found & is_bad).alias("false_negatives"),
    )
    tp, fp, fn = (F.col(c).cast("double") for c in ("true_positives", "false_positives", "false_negatives"))
    return counts.withColumns(
        {
            "precision": safe_divide(tp, tp + fp),
            "recall": safe_divide(tp, tp + fn),
            "f1_score": safe_divide(2 * tp, 2 * tp + fp + fn),
        }
    )


def top_anomalies(scored: DataFrame, k: int = 20) -> DataFrame:
    """The k rows of lowest score."""
    return scored.orderBy("score", "row_id").limit(k)


def confusion_counts(scored: DataFrame, truth: str = "ground_truth") -> DataFrame:
    return scored.groupBy(
        F.col(truth).cast("int").alias("truth"), F.col("is_anomaly").cast("int").alias("predicted")
    ).agg(F.count(F.lit(1)).alias("n"))


def score_histogram(scored: DataFrame, bins: int = 50, truth: str | None = None, score: str = "score") -> DataFrame:
    """Equal-width bins over the score range: (bin 1..bins, [truth], n)."""
    r = scored.agg(F.min(score).alias("lo"), F.max(score).alias("hi")).first()
    width = (r["hi"] - r["lo"]) if r["hi"] is not None else 0.0
    at = F.least(F.floor((F.col(score) - F.lit(r["lo"])) / F.lit(width or 1.0) * bins) + 1, F.lit(bins))
    keys = [at.cast("int").alias("bin")] + ([F.col(truth).cast("int").alias("truth")] if truth else [])
    return scored.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
