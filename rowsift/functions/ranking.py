"""Ranks, running totals, selections and percentiles that never put one group
(or the whole table) into one task.

* Selections ordered by a hash key need no shuffle of the rows: a histogram of
  key prefixes finds the few buckets that hold the wanted ranks, only those are
  sorted, and the selection becomes a filter on the key.
* Ranks in value order use one range shuffle on (group, order columns), which
  splits hot groups and hot values, plus one small table of partition offsets.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowsift.functions.runtime import (
    SMALL_ROWS,
    checked_broadcast,
    collect_small,
    materialize,
    row_count,
)

#: Digits kept of a double that is used as a sort key or is compared.
KEY_DIGITS = 9

_ROWS_PER_PREFIX = 4096
_LOCAL_ROWS = 1_000_000


def sort_key(x: Column) -> Column:
    """``x`` in units of 10**-KEY_DIGITS, for comparing; far cheaper than rounding a double."""
    return F.rint(x * F.lit(10.0**KEY_DIGITS))


def group_counts(df: DataFrame, groups: Sequence[str]) -> dict[tuple, int]:
    """Rows per group as a driver dict; groups are classes or strata, so few."""
    if not groups:
        return {(): row_count(df)}
    rows = collect_small(df.groupBy(*groups).agg(F.count(F.lit(1)).alias("_n")))
    return {tuple(r[g] for g in groups): r["_n"] for r in rows}


def cut_points(
    df: DataFrame,
    key: Column,
    ranks: Callable[[dict[tuple, int]], dict[tuple, list[int]]],
    groups: Sequence[str] = (),
) -> dict[tuple, list[str]]:
    """Hash keys that sit at the wanted 1-based ranks of each group.

    ``ranks`` maps the group sizes to ascending rank lists. Ranks above the
    group size or below 1 give no entry.
    """
    groups = list(groups)
    sizes = group_counts(df, groups)
    wanted = [
        (*g, r) for g, rs in ranks(sizes).items() for r in sorted(set(rs)) if 1 <= r <= sizes[g]
    ]
    if not wanted:
        return {g: [] for g in sizes}
    widest = max(sizes.values())
    digits = max(0, math.ceil(math.log(max(widest / _ROWS_PER_PREFIX, 1), 16)))
    keyed = df.select(*groups, key.alias("_key")).withColumn(
        "_prefix", F.substring("_key", 1, digits) if digits else F.lit("")
    )
    spark = df.sparkSession
    schema = ", ".join(f"`{g}` {df.schema[g].dataType.simpleString()}" for g in groups)
    targets = spark.createDataFrame(wanted, (schema + ", " if schema else "") + "_rank bigint")

    running = Window.partitionBy(*groups).orderBy("_prefix")
    histogram = (
        keyed.groupBy(*groups, "_prefix")
        .agg(F.count(F.lit(1)).alias("_c"))
        .withColumn("_upto", F.sum("_c").over(running))
    )
    if groups:
        same = [histogram[g].eqNullSafe(targets[g]) for g in groups]
        on = same[0]
        for c in same[1:]:
            on = on & c
    else:
        on = F.lit(True)
    inside = (targets["_rank"] <= histogram["_upto"]) & (
        targets["_rank"] > histogram["_upto"] - histogram["_c"]
    )
    located = histogram.join(F.broadcast(targets), on & inside).select(
        *[histogram[g].alias(g) for g in groups],
        "_prefix",
        "_rank",
        (F.col("_rank") - (F.col("_upto") - F.col("_c"))).alias("_need"),
    )
    hits = collect_small(located)
    if not hits:
        return {g: [] for g in sizes}
    located = spark.createDataFrame(hits, located.schema)
    buckets = located.groupBy(*groups, "_prefix").agg(F.collect_set("_need").alias("_needs"))
    cond = keyed["_prefix"] == buckets["_prefix"]
    for g in groups:
        cond = cond & keyed[g].eqNullSafe(buckets[g])
    in_bucket = keyed.join(F.broadcast(buckets), cond).select(
        *[keyed[g].alias(g) for g in groups], keyed["_prefix"].alias("_prefix"), "_key", "_needs"
    )
    numbered = in_bucket.withColumn(
        "_rn", F.row_number().over(Window.partitionBy(*groups, "_prefix").orderBy("_key"))
    ).filter(F.array_contains("_needs", F.col("_rn").cast("bigint")))
    out: dict[tuple, list[str]] = {g: [] for g in sizes}
    for r in collect_small(numbered.select(*groups, "_key")):
        out[tuple(r[g] for g in groups)].append(r["_key"])
    return {g: sorted(v) for g, v in out.items()}


def ranked_cuts(df: DataFrame, key: Column, wanted: Column, groups: Sequence[str], sizes: DataFrame) -> DataFrame:
    """(groups..., _cuts): :func:`cut_points` as a table, for any number of groups.

    ``wanted`` is the ascending array of ranks as an expression over a row of ``sizes``
    (groups..., _n, ...). One range shuffle of the keys finds them.
    """
    ranked = range_rank(df.select(*groups, key.alias("_key")), [F.col("_key")], groups, "_rank")
    both = _null_safe_join(ranked, checked_broadcast(sizes.withColumn("_wanted", wanted)), groups)
    hits = both.filter(F.array_contains("_wanted", F.col("_rank").cast("bigint")))
    return materialize(hits.groupBy(*groups).agg(F.sort_array(F.collect_list("_key")).alias("_cuts")))


def join_cuts(df: DataFrame, cuts: DataFrame, groups: Sequence[str]) -> DataFrame:
    """Attach ``_cuts`` from :func:`ranked_cuts`; null without a cut."""
    cond = None
    for g in groups:
        one = F.col(f"l.`{g}`").eqNullSafe(F.col(f"r.`{g}`"))
        cond = one if cond is None else cond & one
    joined = df.alias("l").join(checked_broadcast(cuts).alias("r"), cond, "left")
    return joined.select(*[F.col(f"l.`{c}`") for c in df.columns], F.col("r._cuts").alias("_cuts"))


def cut_column(df: DataFrame, cuts: dict[tuple, list[str]], groups: Sequence[str]) -> DataFrame:
    """Attach the cut keys of each row's group as ``_cuts ARRAY<STRING>``.

    ``cuts`` is a driver dict of at most SMALL_ROWS groups, hence the broadcast.
    """
    groups = list(groups)
    if not groups:
        lit = F.array(*[F.lit(c) for c in cuts[()]]).cast("array<string>")
        return df.withColumn("_cuts", lit)
    schema = ", ".join(f"`{g}` {df.schema[g].dataType.simpleString()}" for g in groups)
    table = df.sparkSession.createDataFrame(
        [(*g, c) for g, c in cuts.items()], schema + ", _cuts array<string>"
    ).alias("c")
    cond = None
    for g in groups:
        one = df[g].eqNullSafe(F.col(f"c.{g}"))
        cond = one if cond is None else cond & one
    return df.join(F.broadcast(table), cond, "left").select(*[df[c] for c in df.columns], "_cuts")


def pick_smallest(
    df: DataFrame,
    key: Column,
    quota: Callable[[dict[tuple, int]], dict[tuple, int]],
    groups: Sequence[str] = (),
    flag: str = "picked",
) -> DataFrame:
    """Flag, per group, the ``quota`` rows of smallest hash key. No row shuffle."""
    cuts = cut_points(
        df, key, lambda sizes: {g: [min(q, sizes[g])] for g, q in quota(sizes).items()}, groups
    )
    out = cut_column(df, cuts, groups)
    hit = F.coalesce(key <= F.try_element_at("_cuts", F.lit(1)), F.lit(False))
    return out.withColumn(flag, hit).drop("_cuts")


def range_rank(
    df: DataFrame,
    order: Sequence[Column],
    groups: Sequence[str] = (),
    out: str = "rank",
    rows: int | None = None,
) -> DataFrame:
    """Exact 1-based rank of every row inside its group, by ``order``.

    ``order`` must end in a unique column. One range shuffle and sort; the
    partition layout is frozen by a checkpoint and ranks are partition offset
    plus position, so no window ever holds a whole group. When the caller knows
    that there are at most SMALL_ROWS ``rows`` an ordinary window does.
    """
    groups = list(groups)
    if rows is not None and rows <= SMALL_ROWS:
        return df.withColumn(out, F.row_number().over(Window.partitionBy(*groups).orderBy(*order)))
    shift, mask = 33, (1 << 33) - 1
    laid = materialize(
        df.repartitionByRange(*[F.col(g) for g in groups], *order)
        .sortWithinPartitions(*[F.col(g) for g in groups], *order)
        .withColumn("_at", F.monotonically_increasing_id())
    )
    laid = laid.withColumn("_pid", F.shiftright("_at", shift)).withColumn(
        "_at", F.col("_at").bitwiseAND(F.lit(mask))
    )
    before = Window.partitionBy(*groups).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        laid.groupBy(*groups, "_pid")
        .agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
        .withColumn("_base", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .select(*groups, "_pid", "_first", "_base")
    )
    return _null_safe_join(laid, checked_broadcast(offsets), [*groups, "_pid"]).select(
        *df.columns, (F.col("_base") + F.col("_at") - F.col("_first") + 1).alias(out)
    )


def running_totals(
    df: DataFrame, order: Sequence[str], sums: Sequence[str], groups: Sequence[str] = ()
) -> DataFrame:
    """Adds ``<s>_upto``, the running total of each column in ``sums`` by ``order``.

    ``order`` must be unique within a group: aggregate by it first, so that a
    hot value is one row here.
    """
    groups = list(groups)
    laid = materialize(
        df.repartitionByRange(*groups, *order).withColumn("_pid", F.spark_partition_id())
    )
    before = Window.partitionBy(*groups).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    totals = laid.groupBy(*groups, "_pid").agg(*[F.sum(s).alias(f"_t_{s}") for s in sums])
    offsets = totals.select(
        *groups, "_pid", *[F.coalesce(F.sum(f"_t_{s}").over(before), F.lit(0)).alias(f"_b_{s}") for s in sums]
    )
    here = Window.partitionBy(*groups, "_pid").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    joined = _null_safe_join(laid, checked_broadcast(offsets), [*groups, "_pid"])
    return joined.select(
        *df.columns, *[(F.sum(s).over(here) + F.col(f"_b_{s}")).alias(f"{s}_upto") for s in sums]
    )


def _null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    cond = None
    for k in keys:
        one = F.col(f"l.`{k}`").eqNullSafe(F.col(f"r.`{k}`"))
        cond = one if cond is None else cond & one
    return left.alias("l").join(right.alias("r"), cond).select(
        *[F.col(f"l.`{c}`") for c in left.columns],
        *[F.col(f"r.`{c}`") for c in right.columns if c not in keys],
    )


def top_ranked(
    df: DataFrame,
    n: DataFrame | int,
    value: str,
    id_col: str,
    groups: Sequence[str] = (),
    descending: bool = False,
) -> DataFrame:
    """The first ``n`` rows of each group by (value, id).

    ``n`` is an int or a small table ``(groups..., _n)``. A sketch of the value
    distribution per group first drops rows that cannot be among the first
    ``n`` (with slack for the sketch error, so nothing wanted is lost); only the
    survivors take part in the range shuffle.
    """
    groups = list(groups)
    grid, slack = 400, 0.001
    signed = -F.col(value) if descending else F.col(value)
    base = df.withColumn("_v", signed)
    stats = base.groupBy(*groups).agg(
        F.count(F.lit(1)).alias("_total"),
        F.percentile_approx("_v", [i / grid for i in range(grid + 1)], 4000).alias("_grid"),
        F.max("_v").alias("_worst"),
    )
    def bar(total: Column, wanted: Column) -> Column:
        at = F.ceil((wanted / total + F.lit(slack)) * grid).cast("int")
        return F.when(at >= grid, F.col("_worst")).otherwise(
            F.element_at("_grid", F.least(at, F.lit(grid)) + 1)
        )

    if groups:
        if isinstance(n, int):
            stats = stats.withColumn("_n", F.lit(n))
        else:
            stats = _null_safe_join(stats, n, groups)
        stats = stats.filter("_n > 0").withColumn("_bar", bar(F.col("_total"), F.col("_n")))
        bars = materialize(stats.select(*groups, "_n", "_bar", "_total"))
        total = bars.agg(F.sum("_total").alias("t")).first()["t"]
        if not total:
            return df.limit(0)
        survivors = _null_safe_join(base, checked_broadcast(bars.drop("_total")), groups)
    else:
        found = stats.select("_total", bar(F.col("_total"), F.lit(n)).alias("_bar")).first()
        total = found["_total"]
        survivors = base.withColumns({"_n": F.lit(n), "_bar": F.lit(found["_bar"])})
    survivors = survivors.filter(F.col("_v") <= F.col("_bar")).drop("_bar")
    ranked = range_rank(survivors, [F.col("_v"), F.col(id_col)], groups, "_rank", rows=total)
    return ranked.filter(F.col("_rank") <= F.col("_n")).drop("_rank", "_v", "_n")


def exact_medians(df: DataFrame, columns: Sequence[str]) -> dict[str, float | None]:
    """Median of each column's non-null values; one pass for all of them while the table is of moderate size."""
    if row_count(df) > _LOCAL_ROWS:
        return {c: exact_percentile(df, c, 0.5) for c in columns}
    row = df.agg(*[F.percentile(F.col(c).cast("double"), F.lit(0.5)).alias(c) for c in columns]).first()
    return {c: row[c] for c in columns}


def exact_percentile(df: DataFrame, column: str, q: float) -> float | None:
    """Linear-interpolated percentile of the non-null values.

    Sketches narrow the interval that holds the two wanted ranks until few
    distinct values are left; ties collapse to one (value, count) row before
    the final running count.
    """
    values = df.select(F.col(column).cast("double").alias("v")).filter("v IS NOT NULL")
    n = row_count(values)
    if n == 0:
        return None
    if n <= _LOCAL_ROWS:
        return float(values.agg(F.percentile("v", F.lit(q)).alias("p")).first()["p"])
    at = (n - 1) * q
    lower, upper = math.floor(at), math.ceil(at)
    inside, below, count = values, 0, n
    while True:
        width = 2e-3
        while True:
            lo_q = max(0.0, (lower - below) / count - width)
            hi_q = min(1.0, (upper - below + 1) / count + width)
            lo, hi = inside.agg(F.percentile_approx("v", [lo_q, hi_q], 10_000).alias("b")).first()["b"]
            r = inside.agg(
                F.count_if(F.col("v") < lo).alias("under"),
                F.count_if(F.col("v").between(lo, hi)).alias("held"),
                F.count_if((F.col("v") > lo) & (F.col("v") < hi)).alias("strict"),
            ).first()
            if below + r["under"] <= lower and upper < below + r["under"] + r["held"]:
                break
            width *= 4
        inside = inside.filter(F.col("v").between(lo, hi))
        below, count = below + r["under"], r["held"]
        if r["strict"] <= _LOCAL_ROWS:
            break
    counted = inside.groupBy("v").agg(F.count(F.lit(1)).alias("c"))
    upto = counted.withColumn("upto", F.sum("c").over(Window.orderBy("v")) + F.lit(below))
    ends = upto.agg(
        F.min(F.when(F.col("upto") > lower, F.col("v"))).alias("a"),
        F.min(F.when(F.col("upto") > upper, F.col("v"))).alias("b"),
    ).first()
    return float(ends["a"] + (ends["b"] - ends["a"]) * (at - lower))
