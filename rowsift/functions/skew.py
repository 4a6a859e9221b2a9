"""Joining a long table to a one-row-per-key table when one key may be hot."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowsift.functions.runtime import checked_broadcast, materialize

#: A key with more rows than this is dealt to several tasks.
HOT_ROWS = 100_000


def skew_join(
    big: DataFrame,
    dim: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    hot_rows: int = HOT_ROWS,
    counts: DataFrame | None = None,
) -> DataFrame:
    """``big`` join ``dim`` (unique on ``keys``); every heavy key is salted by its row count.

    One aggregate over ``big`` finds the keys of ``hot_rows`` rows and more, unless
    ``counts`` (keys..., _n) already holds the rows per key. Their rows are dealt to one
    salt per ``hot_rows`` rows and their rows of ``dim`` copied once per salt, so no task
    gets more than about ``hot_rows`` rows of a key, however many keys are heavy. Null
    keys never match. Without heavy keys this is the plain join.
    """
    keys = list(keys)
    if counts is None:
        counts = big.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    heavy = counts.filter(F.col("_n") >= hot_rows)
    for k in keys:
        heavy = heavy.filter(F.col(k).isNotNull())
    heavy = heavy.select(*keys, F.ceil(F.col("_n") / F.lit(hot_rows)).cast("int").alias("_salts"))
    heavy = checked_broadcast(heavy)
    if heavy.isEmpty():
        return big.join(dim, keys, how)
    salt = F.floor(F.rand(11) * F.coalesce("_salts", F.lit(1))).cast("int")
    dealt = materialize(big.join(heavy, keys, "left").withColumn("_salt", salt).drop("_salts"))
    copies = dim.join(heavy, keys, "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1))
    )
    return dealt.join(copies.drop("_salts"), [*keys, "_salt"], how).drop("_salt")
