"""Row caps, train/test splits and cross-validation folds.

Counts are exact; which rows are picked depends only on (seed, row key).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowsift.functions.hashing import hash_key
from rowsift.functions.ranking import cut_column, cut_points, group_counts, join_cuts, pick_smallest, ranked_cuts
from rowsift.functions.runtime import materialize, row_count


def sample_cap(df: DataFrame, max_rows: int | None, id_col: str = "row_id", seed: int = 42) -> DataFrame:
    """At most ``max_rows`` rows; unchanged when the table is already that small."""
    if max_rows is None:
        return df
    return pick_smallest(df, hash_key(seed, "cap", id_col), lambda _: {(): max_rows}).filter("picked").drop("picked")


def _shares(sizes: dict[tuple, int], total: int) -> dict[tuple, int]:
    """Spread ``total`` over the groups in proportion, by largest remainder."""
    n = sum(sizes.values())
    exact = {g: total * s / n for g, s in sizes.items()}
    out = {g: math.floor(x + 1e-9) for g, x in exact.items()}
    order = sorted(sizes, key=lambda g: (-round(exact[g] - out[g], 9), tuple(str(v) for v in g)))
    for g in order[: total - sum(out.values())]:
        out[g] += 1
    return out


def stratified_split(
    df: DataFrame,
    label: str,
    test_size: float = 0.2,
    id_col: str = "row_id",
    seed: int = 42,
    flag: str = "is_test",
) -> DataFrame:
    """Adds a test flag: ceil(test_size * n) rows, each label in proportion."""

    few = "a stratified split needs at least 2 rows of every class"
    sizes = _group_table(df, label)
    if sizes is not None:
        return _split_many_classes(df, label, sizes, test_size, hash_key(seed, "split", id_col), flag, few)

    def quota(sizes: dict[tuple, int]) -> dict[tuple, int]:
        if min(sizes.values()) < 2:
            raise ValueError(few)
        return _shares(sizes, math.ceil(round(test_size * sum(sizes.values()), 9)))

    return pick_smallest(df, hash_key(seed, "split", id_col), quota, [label], flag)


#: Groups times cut points beyond which they stay a table instead of driver constants.
MANY_CUTS = 50_000


def _group_table(df: DataFrame, label: str, cuts: int = 1) -> DataFrame | None:
    """(label, _n) if there are many groups, else None."""
    sizes = materialize(df.groupBy(label).agg(F.count(F.lit(1)).alias("_n")))
    return sizes if row_count(sizes) * cuts > MANY_CUTS else None


def _split_many_classes(
    df: DataFrame, label: str, sizes: DataFrame, test_size: float, key: Column, flag: str, few: str
) -> DataFrame:
    """:func:`stratified_split` with the shares of :func:`_shares` worked out in tables of a row per class."""
    total = sizes.agg(F.sum("_n").alias("n"), F.min("_n").alias("least")).first()
    if total["least"] < 2:
        raise ValueError(few)
    rows = math.ceil(round(test_size * total["n"], 9))
    exact = F.lit(rows) * F.col("_n") / F.lit(total["n"])
    shared = sizes.withColumn("_x", exact).withColumn("_floor", F.floor(F.col("_x") + 1e-9))
    rest = rows - (shared.agg(F.sum("_floor").alias("f")).first()["f"] or 0)
    order = Window.orderBy(F.desc(F.round(F.col("_x") - F.col("_floor"), 9)), F.col(label).cast("string"))
    quota = shared.withColumn("_q", F.col("_floor") + (F.row_number().over(order) <= rest).cast("bigint"))
    cuts = ranked_cuts(df, key, F.array(F.col("_q").cast("bigint")), [label], materialize(quota.select(label, "_n", "_q")))
    hit = F.coalesce(key <= F.try_element_at("_cuts", F.lit(1)), F.lit(False))
    return join_cuts(df, cuts, [label]).withColumn(flag, hit).drop("_cuts")


def plain_split(
    df: DataFrame,
    test_size: float = 0.2,
    id_col: str = "row_id",
    seed: int = 42,
    flag: str = "is_test",
    floor_train: bool = False,
) -> DataFrame:
    """Adds a test flag without regard to labels.

    ``floor_train`` keeps int(n * (1 - test_size)) training rows (permutation
    split); otherwise the test side has ceil(test_size * n) rows.
    """

    def quota(sizes: dict[tuple, int]) -> dict[tuple, int]:
        n = sizes[()]
        if floor_train:
            return {(): n - int(n * (1 - test_size))}
        return {(): math.ceil(round(test_size * n, 9))}

    return pick_smallest(df, hash_key(seed, "split", id_col), quota, (), flag)


def _fold_ends(n: int, k: int) -> list[int]:
    """Rank of the last row of each fold but the last; sizes differ by at most one."""
    small, extra = divmod(n, k)
    ends, at = [], 0
    for f in range(k - 1):
        at += small + (1 if f < extra else 0)
        ends.append(at)
    return ends


def kfold(
    df: DataFrame,
    k: int = 5,
    label: str | None = None,
    id_col: str = "row_id",
    seed: int = 42,
    out: str = "fold",
) -> DataFrame:
    """Adds fold 0..k-1, balanced within each label when ``label`` is given."""
    groups = [label] if label else []
    key = hash_key(seed, "fold", id_col)
    sizes = _group_table(df, label, k - 1) if label else None
    if sizes is not None:
        n = F.col("_n")
        ends = [F.lit(f + 1) * F.floor(n / k) + F.least(F.lit(f + 1), n % k) for f in range(k - 1)]
        cuts = ranked_cuts(df, key, F.array(*[e.cast("bigint") for e in ends]), groups, sizes)
        return _fold_from_cuts(join_cuts(df, cuts, groups), key, k, out)
    cuts = cut_points(df, key, lambda sizes: {g: _fold_ends(n, k) for g, n in sizes.items()}, groups)
    return _fold_from_cuts(cut_column(df, cuts, groups), key, k, out)


def _fold_from_cuts(df: DataFrame, key: Column, k: int, out: str) -> DataFrame:
    """Number of cut keys below the row's key, as k - 1 plain comparisons."""
    row_key = "_fold_key"
    above = [
        F.coalesce((F.col(row_key) > F.try_element_at("_cuts", F.lit(i + 1))).cast("int"), F.lit(0))
        for i in range(k - 1)
    ]
    return (
        df.withColumn(row_key, key)
        .withColumn(out, sum(above, F.lit(0)))
        .drop(row_key, "_cuts")
    )


def kfold_group(
    df: DataFrame, group: str, k: int = 3, seed: int = 42, out: str = "fold"
) -> DataFrame:
    """Adds fold 0..k-1 so that all rows of one group share a fold.

    Folds are balanced in the number of groups. Only the distinct groups are
    shuffled; the fold of a row is an expression on its group key.
    """
    key = hash_key(seed, "fold", group)
    cuts = cut_points(df.select(group).distinct(), key, lambda s: {(): _fold_ends(s[()], k)})
    return _fold_from_cuts(cut_column(df, cuts, []), key, k, out)


def usable_folds(df: DataFrame, label: str, k: int) -> int:
    """``k`` reduced to the smallest class size; too few classes or rows is an error."""
    sizes = group_counts(df.filter(F.col(label).isNotNull()), [label])
    if len(sizes) < 2:
        raise ValueError("need at least 2 classes for cross-validation")
    folds = min(k, min(sizes.values()))
    if folds < 2:
        raise ValueError(f"need at least 2 rows of every class, smallest has {min(sizes.values())}")
    return folds


def classes_of(df: DataFrame, label: str) -> list:
    """Sorted distinct label values on the driver."""
    return sorted(g[0] for g in group_counts(df.filter(F.col(label).isNotNull()), [label]))


def drop_rows(df: DataFrame, ids: DataFrame, id_cols: Sequence[str] = ("row_id",)) -> DataFrame:
    """Rows whose key is not in ``ids``."""
    return df.join(ids.select(*id_cols).distinct(), list(id_cols), "left_anti")
