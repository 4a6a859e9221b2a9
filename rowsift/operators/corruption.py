"""Planted errors, so a detector can be measured against known bad rows.

Each function returns the changed table with a ``was_corrupted`` flag.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowsift.functions.hashing import hash_below, hash_key, hash_normal, hash_uniform, hash_word
from rowsift.functions.ranking import pick_smallest
from rowsift.operators.sampling import classes_of

FLAG = "was_corrupted"


def _pick(df: DataFrame, frac: float, id_col: str, seed: int, tag: str, truncate: bool = False) -> DataFrame:
    if frac <= 0:
        return df.withColumn(FLAG, F.lit(False))
    size = int if truncate else round
    return pick_smallest(
        df, hash_key(seed, tag, id_col), lambda s: {(): size(frac * s[()])}, (), FLAG
    )


def _other_class(label: Column, classes: list, draw: Column) -> Column:
    """The ``draw``-th class that is not the present one."""
    known = F.array(*[F.lit(c) for c in classes])
    present = F.array_position(known, label) - 1
    return F.element_at(known, F.when(draw >= present, draw + 2).otherwise(draw + 1))


def flip_labels(
    df: DataFrame, label: str, frac: float, id_col: str = "row_id", seed: int = 42
) -> DataFrame:
    """Give ``round(frac * n)`` rows a different class. One class only: unchanged."""
    classes = classes_of(df, label) if frac > 0 else []
    if len(classes) < 2:
        return df.withColumn(FLAG, F.lit(False))
    out = _pick(df, frac, id_col, seed, "flip")
    draw = hash_below(len(classes) - 1, seed, "class", id_col)
    new = _other_class(F.col(label), classes, draw).cast(df.schema[label].dataType)
    return out.withColumn(label, F.when(F.col(FLAG), new).otherwise(F.col(label)))


def flip_bits(
    df: DataFrame, bits: str, n_bits: int, frac: float, id_col: str = "row_id", seed: int = 42
) -> DataFrame:
    """Invert one bit of ``round(frac * n)`` rows of a 0/1 array column."""
    out = _pick(df, frac, id_col, seed, "bitflip").withColumn(
        "_bit", hash_below(n_bits, seed, "bit", id_col)
    )
    flipped = F.transform(bits, lambda v, i: F.when(i == F.col("_bit"), 1 - v).otherwise(v))
    return out.withColumn(bits, F.when(F.col(FLAG), flipped).otherwise(F.col(bits))).drop("_bit")


def noise_target(
    df: DataFrame,
    target: str,
    frac: float,
    scale: float = 5.0,
    id_col: str = "row_id",
    seed: int = 42,
    floor: float = 1e-12,
) -> DataFrame:
    """Add N(0, scale * (population std + floor)) to ``round(frac * n)`` targets."""
    std = df.agg(F.stddev_pop(target).alias("s")).first()["s"] or 0.0
    noise = hash_normal(seed, "noise", id_col) * F.lit(scale * (std + floor))
    return _pick(df, frac, id_col, seed, "target").withColumn(
        target, F.when(F.col(FLAG), F.col(target) + noise).otherwise(F.col(target))
    )


def noise_tokens(
    df: DataFrame,
    tag: str,
    frac: float,
    keys: tuple[str, str] = ("sent_id", "tok_i"),
    seed: int = 42,
    classes: list | None = None,
) -> DataFrame:
    """Each token changes its tag with probability ``frac`` (independent draws)."""
    known = classes if classes is not None else classes_of(df, tag)
    if frac <= 0 or len(known) < 2:
        return df.withColumn(FLAG, F.lit(False))
    draw = hash_below(len(known) - 1, seed, "class", *keys)
    new = _other_class(F.col(tag), known, draw).cast(df.schema[tag].dataType)
    return df.withColumn(FLAG, hash_uniform(seed, "token", *keys) < frac).withColumn(
        tag, F.when(F.col(FLAG), new).otherwise(F.col(tag))
    )


def inject_outliers(
    df: DataFrame, column: str, frac: float, scale: float = 50.0, id_col: str = "row_id", seed: int = 42
) -> DataFrame:
    """Multiply the (first numeric) ``column`` by ``scale`` in ``round(frac * n)`` rows."""
    return _pick(df, frac, id_col, seed, "outlier").withColumn(
        column, F.when(F.col(FLAG), F.col(column) * scale).otherwise(F.col(column))
    )


def inject_anomalies(
    df: DataFrame,
    features: str,
    n_features: int,
    contamination: float,
    scale: float = 10.0,
    id_col: str = "row_id",
    seed: int = 42,
) -> DataFrame:
    """In ``int(n * contamination)`` rows scale 1..d//2 random entries by +-scale."""
    out = _pick(df, contamination, id_col, seed, "anomaly", truncate=True)
    many = hash_below(max(1, n_features // 2), seed, "howmany", id_col) + 1
    draws = [hash_word(seed, f"col{j}", id_col) for j in range(n_features)]
    out = out.withColumn("_many", many).withColumn(
        "_draws", F.when(F.col(FLAG), F.array(*draws))
    )
    bar = F.element_at(F.array_sort("_draws"), F.col("_many"))
    sign = lambda i: F.when(F.element_at("_draws", i + 1) % 2 == 0, 1.0).otherwise(-1.0)
    changed = F.transform(
        features,
        lambda v, i: F.when(
            F.element_at("_draws", i + 1) <= F.col("_bar"), v * sign(i) * scale
        ).otherwise(v),
    )
    return (
        out.withColumn("_bar", bar)
        .withColumn(features, F.when(F.col(FLAG), changed).otherwise(F.col(features)))
        .drop("_many", "_draws", "_bar")
    )
