"""Likely wrong labels from out-of-sample class probabilities (confident learning).

Input rows are (row_id, label INT, probs ARRAY<DOUBLE>); ``by`` columns make
independent problems of one table, as multi-label data needs (one per bit).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowsift.functions.arrays import argmax, prob_at, safe_divide
from rowsift.functions.ranking import KEY_DIGITS, exact_percentile, sort_key, top_ranked
from rowsift.functions.runtime import checked_broadcast, collect_small, materialize


#: Up to this many classes the search for the confident class is plain generated
#: code; beyond it, an array function.
_UNROLL = 32


def self_confidence(df: DataFrame) -> DataFrame:
    return df.withColumn("self_confidence", F.round(prob_at("probs", "label"), KEY_DIGITS))


def class_thresholds(df: DataFrame, by: Sequence[str] = (), threshold: str = "given") -> DataFrame:
    """(by..., label, threshold): mean probability of a class over its rows.

    ``threshold='all_rows'`` averages over the whole table instead.
    """
    if threshold == "given":
        return df.groupBy(*by, "label").agg(
            F.round(F.avg(prob_at("probs", "label")), KEY_DIGITS).alias("threshold")
        )
    if threshold != "all_rows":
        raise ValueError(f"unknown threshold: {threshold}")
    long = df.select(*by, F.posexplode("probs").alias("label", "_p"))
    return long.groupBy(*by, "label").agg(F.round(F.avg("_p"), KEY_DIGITS).alias("threshold"))


def _with_confident(df: DataFrame, n_classes: int, by: Sequence[str], threshold: str) -> DataFrame:
    """Adds ``confident``: most probable class at or above its threshold, else null.

    Thresholds come back as one array of n_classes numbers (per ``by`` value),
    so the rows are neither exploded nor shuffled.
    """
    table: dict[tuple, list] = {}
    for r in collect_small(class_thresholds(df, by, threshold)):
        bars = table.setdefault(tuple(r[b] for b in by), [float("inf")] * n_classes)
        bars[r["label"]] = float(round(r["threshold"] * 10**KEY_DIGITS))
    if by:
        schema = ", ".join(f"`{b}` {df.schema[b].dataType.simpleString()}" for b in by)
        bars = df.sparkSession.createDataFrame(
            [(*g, t) for g, t in table.items()], schema + ", _bars array<double>"
        )
        df = df.join(F.broadcast(bars), list(by))
    else:
        df = df.withColumn("_bars", F.array(*[F.lit(t) for t in table.get((), [float("inf")] * n_classes)]))
    seen = lambda p, i: F.struct(sort_key(p).alias("p"), (-i).alias("neg"))
    passes = lambda p, i: sort_key(p) >= F.element_at("_bars", i + 1)
    if 2 <= n_classes <= _UNROLL:
        at = [(F.element_at("probs", i + 1), F.lit(i)) for i in range(n_classes)]
        best = F.greatest(*[F.when(passes(p, i), seen(p, i)) for p, i in at])
    else:
        sure = F.transform("probs", lambda p, i: F.when(passes(p, i), seen(p, i)))
        best = F.array_max(F.filter(sure, lambda x: x.isNotNull()))
    return df.withColumn("confident", -best["neg"]).drop("_bars")


def confident_joint(
    df: DataFrame, n_classes: int, by: Sequence[str] = (), threshold: str = "given"
) -> DataFrame:
    """(by..., label, confident, n): rows given as ``label`` that look like ``confident``."""
    rows = _with_confident(df, n_classes, by, threshold).filter("confident IS NOT NULL")
    return rows.groupBy(*by, "label", "confident").agg(F.count(F.lit(1)).alias("n"))


def noise_rates(joint: DataFrame, label_counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(label, confident, joint, given_if_true, true_if_given); input has K*K rows.

    Each row of the joint is rescaled to the class size of its given label.
    """
    row = Window.partitionBy(*by, "label")
    column = Window.partitionBy(*by, "confident")
    every = Window.partitionBy(*by)
    sized = joint.join(label_counts, [*by, "label"])
    scaled = sized.withColumn("_s", F.col("n") / F.sum("n").over(row) * F.col("class_n"))
    q = scaled.withColumn("joint", F.col("_s") / F.sum("_s").over(every))
    return q.select(
        *by,
        "label",
        "confident",
        "joint",
        safe_divide(F.col("joint"), F.sum("joint").over(column)).alias("given_if_true"),
        safe_divide(F.col("joint"), F.sum("joint").over(row)).alias("true_if_given"),
    )


def class_sizes(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by, "label").agg(F.count(F.lit(1)).alias("class_n"))


def flag_label_issues(
    df: DataFrame,
    n_classes: int,
    by: Sequence[str] = (),
    id_col: str = "row_id",
    filter_by: str = "prune_by_noise_rate",
    threshold: str = "given",
) -> DataFrame:
    """Rows whose label looks wrong: (by..., id, label, suggested_label, score).

    ``prune_by_noise_rate``: for every pair of given class i and other class j
    the rows of i with the largest p_j - p_i, as many as the joint says.
    ``by_class``: per given class the lowest self-confidence rows.
    ``confident_joint``: rows counted off the diagonal.
    A row whose most probable class is its label is never flagged.
    """
    by = list(by)
    wrong = argmax("probs") != F.col("label")
    if filter_by == "confident_joint":
        hits = _with_confident(df, n_classes, by, threshold).filter("confident <> label")
        return _issue_rows(hits.filter(wrong), by, id_col)
    size_table = materialize(class_sizes(df, by))
    rates = noise_rates(confident_joint(df, n_classes, by, threshold), size_table, by)
    if by:
        totals = size_table.groupBy(*by).agg(F.sum("class_n").alias("_all"))
        off = rates.join(checked_broadcast(totals), by).filter("label <> confident")
    else:
        off = rates.filter("label <> confident").withColumn("_all", F.lit(size_table.agg(F.sum("class_n").alias("n")).first()["n"]))
    size = F.col("joint") * F.col("_all")
    cells = off.withColumn("_n", F.bround(F.round(size, 6), 0).cast("bigint")).filter("_n > 0")
    if filter_by == "by_class":
        n_table = cells.groupBy(*by, "label").agg(F.sum("_n").alias("_n"))
        scored = df.withColumn("_score", F.round(prob_at("probs", "label"), KEY_DIGITS))
        hits = top_ranked(scored, n_table, "_score", id_col, [*by, "label"])
        return _issue_rows(hits.filter(wrong), by, id_col)
    if filter_by != "prune_by_noise_rate":
        raise ValueError(f"unknown filter: {filter_by}")
    n_table = materialize(
        cells.select(*by, F.col("label").cast("int").alias("label"), F.col("confident").cast("int").alias("_other"), "_n")
    )
    others = n_table.groupBy(*by, "label").agg(F.sort_array(F.collect_list("_other")).alias("_others"))
    slim = df.select(*by, id_col, F.col("label").cast("int").alias("label"), "probs")
    long = (
        slim.join(checked_broadcast(others), [*by, "label"])
        .withColumn("_other", F.explode("_others"))
        .withColumn("_margin", sort_key(prob_at("probs", "_other") - prob_at("probs", "label")))
        .select(*by, id_col, "label", "_other", "_margin", wrong.alias("_wrong"),
                argmax("probs").alias("_best"), prob_at("probs", "label").alias("_p"))
    )
    picked = top_ranked(long, n_table, "_margin", id_col, [*by, "label", "_other"], descending=True)
    return (
        picked.filter("_wrong")
        .groupBy(*by, id_col)
        .agg(
            F.first("label").alias("label"),
            F.first("_best").alias("suggested_label"),
            F.round(F.first("_p"), KEY_DIGITS).alias("score"),
        )
    )


def _issue_rows(hits: DataFrame, by: Sequence[str], id_col: str) -> DataFrame:
    return hits.select(
        *by,
        id_col,
        F.col("label").cast("int").alias("label"),
        argmax("probs").alias("suggested_label"),
        F.round(prob_at("probs", "label"), KEY_DIGITS).alias("score"),
    )


def rank_issues(
    issues: DataFrame, max_issues: int | None = None, score_threshold: float | None = None, id_col: str = "row_id"
) -> DataFrame:
    """Worst first, optionally only scores up to a threshold and at most ``max_issues``."""
    kept = issues if score_threshold is None else issues.filter(F.col("score") <= score_threshold)
    ordered = kept.orderBy("score", id_col)
    return ordered if max_issues is None else ordered.limit(max_issues)


def multilabel_issues(df: DataFrame, n_bits: int, truth: str = "y", probs: str = "p", id_col: str = "row_id") -> DataFrame:
    """(id, score, n_bits_flagged) of rows with at least one suspicious bit.

    The score is the smallest self-confidence over all bits of the row.
    """
    given = F.zip_with(truth, probs, lambda y, p: F.when(y == 1, p).otherwise(1 - p))
    long = df.select(
        id_col,
        F.round(F.array_min(given), KEY_DIGITS).alias("_score"),
        F.posexplode(F.arrays_zip(F.col(truth).alias("y"), F.col(probs).alias("p"))).alias("bit", "e"),
    ).select(
        id_col,
        "_score",
        "bit",
        F.col("e.y").cast("int").alias("label"),
        F.array(1 - F.col("e.p"), F.col("e.p")).alias("probs"),
    )
    flagged = flag_label_issues(long, 2, ["bit"], id_col)
    per_row = flagged.groupBy(id_col).agg(F.count(F.lit(1)).alias("n_bits_flagged"))
    scores = df.select(id_col, F.round(F.array_min(given), KEY_DIGITS).alias("score"))
    return per_row.join(scores, id_col).select(id_col, "score", "n_bits_flagged")


def token_issues(tokens: DataFrame, n_classes: int, keys: tuple[str, str] = ("sent_id", "tok_i")) -> DataFrame:
    """(sent_id, tok_i, label, suggested_label, score) of suspicious tokens."""
    rows = tokens.select(F.struct(*keys).alias("row_id"), "label", "probs")
    found = flag_label_issues(rows, n_classes)
    return found.select(*[F.col(f"row_id.{k}").alias(k) for k in keys], "label", "suggested_label", "score")


def sentence_scores(tokens: DataFrame, how: str = "min", sent: str = "sent_id") -> DataFrame:
    """(sent_id, score): minimum or mean token self-confidence."""
    if how not in ("min", "mean"):
        raise ValueError(f"unknown sentence score: {how}")
    p = prob_at("probs", "label")
    score = F.min(p) if how == "min" else F.avg(p)
    return tokens.groupBy(sent).agg(F.round(score, KEY_DIGITS).alias("score"))


# -- numeric targets ---------------------------------------------------------


def regression_quality(
    df: DataFrame,
    target: str = "y",
    predicted: str = "predicted",
    spread: Column | str = "spread",
    id_col: str = "row_id",
    flag_share: float = 0.05,
) -> DataFrame:
    """(id, label, predicted_label, label_score, is_label_issue).

    Score 1 / (1 + |residual| / spread); the lowest ``flag_share`` is flagged.
    """
    z = F.abs(F.col(target) - F.col(predicted)) / F.greatest(
        F.col(spread) if isinstance(spread, str) else spread, F.lit(1e-12)
    )
    scored = materialize(
        df.select(
            F.col(id_col),
            F.col(target).alias("label"),
            F.col(predicted).alias("predicted_label"),
            F.round(1 / (1 + z), KEY_DIGITS).alias("label_score"),
        )
    )
    bar = exact_percentile(scored, "label_score", flag_share)
    return scored.withColumn("is_label_issue", F.col("label_score") < F.lit(bar))


def regression_issues(quality: DataFrame, max_issues: int | None = None, id_col: str = "row_id") -> DataFrame:
    """The flagged rows; with ``max_issues`` only those among so many rows of lowest score."""
    worst = quality if max_issues is None else quality.orderBy("label_score", id_col).limit(max_issues)
    return worst.filter(F.coalesce("is_label_issue", F.lit(False)))


# -- pruning -----------------------------------------------------------------


def prune_size(n_train: int, fraction: float, max_samples: int | None = None) -> int:
    """round(fraction * n), at most ``max_samples``."""
    size = round(fraction * n_train)
    return size if max_samples is None else min(max_samples, size)


def choose_prune(sources: Sequence[tuple[DataFrame, str]], n: int, id_col: str = "row_id") -> DataFrame:
    """Worst ``n`` ids of the first non-empty (frame, score column) source."""
    for frame, score in sources:
        if frame is not None and not frame.isEmpty():
            return worst_rows(frame, score, n, id_col)
    first = next(f for f, _ in sources if f is not None)
    return first.select(id_col).limit(0)


def worst_rows(df: DataFrame, score: str, n: int, id_col: str = "row_id") -> DataFrame:
    """Ids of the ``n`` rows of lowest (score, id); rows without a score are never among them."""
    rows = df.select(id_col, score).filter(F.col(score).isNotNull())
    if n <= 0 or rows.isEmpty():
        return rows.select(id_col).limit(0)
    return top_ranked(rows, n, score, id_col).select(id_col)


def prune(df: DataFrame, bad_ids: DataFrame, id_col: str = "row_id") -> DataFrame:
    """Rows that are not in the prune set."""
    return df.join(bad_ids.select(id_col), id_col, "left_anti")
