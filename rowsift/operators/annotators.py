"""Several annotators per example: (example_id, annotator_id, label INT) rows.

A label that was not given is an absent row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowsift.functions.arrays import argmax, prob_at
from rowsift.functions.ranking import KEY_DIGITS
from rowsift.functions.runtime import checked_broadcast
from rowsift.functions.skew import skew_join
from rowsift.operators.features import encode, label_codes


def annotation_codes(df: DataFrame, label: str = "label") -> tuple[DataFrame, int]:
    """Labels recoded to 0..K-1 over the whole table, and K; no label at all is an error."""
    given = df.filter(F.col(label).isNotNull())
    codes = label_codes(given, label)
    k = codes.count()
    if k == 0:
        raise ValueError("all annotator labels are missing")
    return encode(given, label, codes, "_code").withColumn(label, F.col("_code")).drop("_code"), k


def coverage(df: DataFrame) -> DataFrame:
    """(n_examples, n_annotators, coverage, mean_labels_per_example)."""
    c = df.agg(
        F.count("label").alias("n"),
        F.countDistinct("example_id").alias("n_examples"),
        F.countDistinct("annotator_id").alias("n_annotators"),
    )
    return c.select(
        "n_examples",
        "n_annotators",
        (F.col("n") / (F.col("n_examples") * F.col("n_annotators"))).alias("coverage"),
        (F.col("n") / F.col("n_examples")).alias("mean_labels_per_example"),
    )


def vote_counts(df: DataFrame) -> DataFrame:
    """(example_id, label, votes): the pre-aggregate the vote operators share."""
    return df.groupBy("example_id", "label").agg(F.count(F.lit(1)).alias("votes"))


def consensus(df: DataFrame) -> DataFrame:
    """(example_id, label, n_labels, agreement) by majority vote.

    Ties go to the label that is more frequent overall, then the smaller code.
    """
    votes = vote_counts(df)
    overall = votes.groupBy("label").agg(F.sum("votes").alias("overall"))
    ranked = votes.join(checked_broadcast(overall), "label")
    best = F.max(F.struct("votes", "overall", (-F.col("label")).alias("neg")))
    return (
        ranked.groupBy("example_id")
        .agg(best.alias("b"), F.sum("votes").alias("n_labels"))
        .select(
            "example_id",
            (-F.col("b.neg")).cast("int").alias("label"),
            "n_labels",
            (F.col("b.votes") / F.col("n_labels")).alias("agreement"),
        )
    )


def annotator_quality(df: DataFrame, model: DataFrame) -> DataFrame:
    """(annotator_id, n_labels, quality): share of an annotator's labels the model agrees with."""
    predicted = model.select("example_id", argmax("probs").alias("_best"))
    seen = skew_join(df, predicted, ["example_id"])
    return seen.groupBy("annotator_id").agg(
        F.count(F.lit(1)).alias("n_labels"),
        F.round(F.avg((F.col("label") == F.col("_best")).cast("double")), KEY_DIGITS).alias("quality"),
    )


def weighted_vote(df: DataFrame, quality: DataFrame) -> DataFrame:
    """(example_id, label, weight): label of largest summed annotator quality."""
    weighed = skew_join(df, quality.select("annotator_id", "quality"), ["annotator_id"])
    sums = weighed.groupBy("example_id", "label").agg(F.round(F.sum("quality"), 6).alias("w"))
    best = F.max(F.struct("w", (-F.col("label")).alias("neg")))
    return sums.groupBy("example_id").agg(best.alias("b")).select(
        "example_id", (-F.col("b.neg")).cast("int").alias("label"), F.col("b.w").alias("weight")
    )


def consensus_quality(agreed: DataFrame, model: DataFrame) -> DataFrame:
    """(example_id, label, quality): mean of agreement and model probability, low = bad."""
    both = agreed.join(model.select("example_id", "probs"), "example_id")
    q = (F.col("agreement") + prob_at("probs", "label")) / 2
    return both.select("example_id", "label", F.round(q, KEY_DIGITS).alias("quality"))


def active_learning(df: DataFrame, model: DataFrame, n_classes: int) -> DataFrame:
    """(example_id, al_score): low = label this one next.

    One minus the mean of model uncertainty and the entropy of the label shares.
    """
    votes = vote_counts(df)
    # sum of c ln c gives the entropy without a second pass over the examples
    spread = votes.groupBy("example_id").agg(
        F.sum("votes").alias("n"), F.sum(F.col("votes") * F.log(F.col("votes").cast("double"))).alias("clogc")
    )
    # one class leaves nothing open
    h = F.lit(0.0)
    if n_classes > 1:
        h = (F.log(F.col("n").cast("double")) - F.col("clogc") / F.col("n")) / F.log(F.lit(float(n_classes)))
    u = 1 - F.array_max("probs")
    return spread.join(model.select("example_id", "probs"), "example_id").select(
        "example_id", F.round(1 - (u + h) / 2, KEY_DIGITS).alias("al_score")
    )


def worst_examples(scores: DataFrame, score: str, k: int = 20) -> DataFrame:
    """The k examples of lowest score; empty when the score column is absent."""
    if score not in scores.columns:
        return scores.select("example_id").limit(0)
    return scores.orderBy(score, "example_id").limit(k)


def missing_classes(codes: DataFrame, agreed: DataFrame) -> DataFrame:
    """Codes that no example has as its consensus label."""
    present = agreed.select(F.col("label").alias("code")).distinct()
    return codes.select("code").join(present, "code", "left_anti")


def dense_annotations(
    df: DataFrame,
    max_annotators: int = 50,
    min_per_example: int = 10,
    max_examples: int = 800,
    min_per_annotator: int = 100,
) -> DataFrame:
    """The busiest annotators and the examples most of them labelled.

    Most active annotators, then examples with enough of their labels, then the
    most labelled of those, then annotators with enough labels left. Ties break
    on the smaller id. Fewer than two annotators is an error.
    """

    def busiest(rows: DataFrame, key: str, limit: int, at_least: int = 1) -> DataFrame:
        counts = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= at_least)
        return counts.orderBy(F.desc("n"), key).limit(limit).select(key)

    rows = df.join(checked_broadcast(busiest(df, "annotator_id", max_annotators)), "annotator_id", "left_semi")
    chosen = busiest(rows, "example_id", max_examples, min_per_example)
    rows = rows.join(checked_broadcast(chosen), "example_id", "left_semi")
    active = busiest(rows, "annotator_id", max_annotators, min_per_annotator)
    n = active.count()
    if n < 2:
        raise ValueError(f"need at least 2 annotators, got {n}")
    return rows.join(checked_broadcast(active), "annotator_id", "left_semi")


def label_matrix(df: DataFrame) -> DataFrame:
    """Wide export: one row per example, one column user_<id> per annotator."""
    return (
        df.withColumn("_c", F.concat(F.lit("user_"), F.col("annotator_id")))
        .groupBy("example_id")
        .pivot("_c")
        .agg(F.first(F.col("label").cast("double")))
    )
