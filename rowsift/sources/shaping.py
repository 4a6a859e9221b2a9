"""Reshaping that turns a loaded table into operator input."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowsift.functions.arrays import multi_hot
from rowsift.functions.hashing import hash_key
from rowsift.functions.runtime import checked_broadcast
from rowsift.operators.features import column_roles
from rowsift.operators.sampling import sample_cap


def split_target(df: DataFrame, target: str) -> tuple[DataFrame, DataFrame]:
    """(features, target); a missing target column is an error."""
    if target not in df.columns:
        raise ValueError(f"target column {target} is not in the table")
    return df.drop(target), df.select(target)


def prepare(
    df: DataFrame,
    target: str | None = None,
    max_rows: int | None = None,
    target_offset: int = 0,
    id_col: str = "row_id",
    seed: int = 42,
) -> DataFrame:
    """Generic provider: target (default last column) as ``label``, offset and row cap applied."""
    name = target or df.columns[-1]
    if name not in df.columns:
        raise ValueError(f"target column {name} is not in the table")
    y = F.col(name) + F.lit(target_offset) if target_offset else F.col(name)
    return sample_cap(df.withColumn("label", y).drop(*([name] if name != "label" else [])), max_rows, id_col, seed)


def zero_based(df: DataFrame, label: str) -> DataFrame:
    """Codes 1..K to 0..K-1."""
    return df.withColumn(label, (F.col(label) - 1).cast("int"))


def booleans_to_bits(df: DataFrame, columns: Sequence[str], out: str = "y") -> DataFrame:
    return df.withColumn(out, multi_hot(*[F.col(c) for c in columns]))


def rare_class_flag(df: DataFrame, label: str, below: float = 0.05, out: str = "is_anomaly") -> DataFrame:
    """1 for rows whose class holds less than ``below`` of the table, else 0."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("_n"))
    total = df.count()
    rare = counts.select(label, (F.col("_n") / F.lit(total) < below).cast("int").alias(out))
    return df.join(checked_broadcast(rare), label, "left").withColumn(out, F.coalesce(out, F.lit(0)))


def not_normal_flag(df: DataFrame, label: str, normal: Sequence[str], out: str = "is_anomaly") -> DataFrame:
    """1 unless the label is one of ``normal``; keeps numeric columns and the flag."""
    numeric, _ = column_roles(df, [label])
    return df.select(*numeric, (~F.col(label).isin(*normal)).cast("int").alias(out))


def feature_array(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    label: str | None = None,
    id_col: str = "row_id",
    out: str = "features",
) -> DataFrame:
    """(row_id, features, [ground_truth]): given columns, or every numeric one but the label."""
    skip = [c for c in (label, id_col) if c]
    chosen = list(columns) if columns else column_roles(df, skip)[0]
    absent = [c for c in chosen if c not in df.columns]
    if absent or not chosen:
        raise ValueError(f"feature columns are missing: {absent or 'none found'}")
    vector = F.array(*[F.col(c).cast("double") for c in chosen]).alias(out)
    truth = [F.col(label).cast("int").alias("ground_truth")] if label else []
    return df.select(F.col(id_col).alias("row_id"), vector, *truth)


def synthetic_anomalies(
    spark: SparkSession, n: int, width: int = 5, contamination: float = 0.05, seed: int = 42
) -> DataFrame:
    """(row_id, feature_0.., is_anomaly): N(0, I) rows plus int(n * contamination) rows U(-6, 6).

    Which ids are anomalies is a hashed shuffle of the ids.
    """
    bad = int(n * contamination)
    ids = spark.range(n).withColumnRenamed("id", "row_id")
    from rowsift.functions.ranking import pick_smallest

    flagged = pick_smallest(
        ids, hash_key(seed, "synthetic", F.col("row_id").cast("string")), lambda _: {(): bad}, (), "_bad"
    )
    value = lambda j: F.when(F.col("_bad"), F.rand(seed + 1000 + j) * 12 - 6).otherwise(F.randn(seed + j))
    return flagged.select(
        "row_id", *[value(j).alias(f"feature_{j}") for j in range(width)], F.col("_bad").cast("int").alias("is_anomaly")
    )


def nan_to_null(df: DataFrame) -> DataFrame:
    """Replace NaN by null in every floating column."""
    cols = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in cols}) if cols else df


def item_features(items: DataFrame, title: str, flags: Sequence[str]) -> DataFrame:
    """Item table with the year taken from the end of the title and 0/1 flags kept."""
    from rowsift.functions.text import title_year

    keep: list[Column] = [F.col(c) for c in flags]
    return items.select(items.columns[0], title_year(F.col(title)).alias("year"), *keep)


def align_items(annotations: DataFrame, items: DataFrame, item_id: str) -> tuple[DataFrame, DataFrame]:
    """Keep annotations whose example has item features, and those items."""
    ids = items.select(F.col(item_id).alias("example_id"))
    labels = annotations.join(ids, "example_id", "left_semi")
    kept = items.join(labels.select(F.col("example_id").alias(item_id)).distinct(), item_id, "left_semi")
    return labels, kept
