"""Dataset audit over a nearest-neighbour graph: outliers, near duplicates, row order."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rowsift.functions.arrays import safe_divide
from rowsift.functions.ranking import KEY_DIGITS, exact_percentile, range_rank, running_totals
from rowsift.functions.runtime import checked_broadcast, materialize
from rowsift.functions.skew import skew_join

#: Mean neighbour distance above this many medians flags an outlier.
OUTLIER_MEDIANS = 2.5
#: Nearest distance at or below this share of the median flags a near duplicate.
DUPLICATE_SHARE = 0.1
#: Significance level of the row-order test.
NON_IID_LEVEL = 0.05


def mean_distance(edges: DataFrame) -> DataFrame:
    return edges.groupBy(F.col("i").alias("row_id")).agg(F.round(F.avg("dist"), KEY_DIGITS).alias("d"))


def inverted_min_max(df: DataFrame, raw: str, out: str = "score") -> DataFrame:
    """1 - (x - min) / (max - min); 0.5 everywhere when the column is constant."""
    r = df.agg(F.min(raw).alias("lo"), F.max(raw).alias("hi")).first()
    if r["lo"] is None or r["hi"] <= r["lo"]:
        return df.withColumn(out, F.lit(0.5))
    scaled = 1.0 - (F.col(raw) - F.lit(r["lo"])) / F.lit(r["hi"] - r["lo"])
    return df.withColumn(out, F.round(scaled, KEY_DIGITS))


def outlier_scores(edges: DataFrame) -> DataFrame:
    """(row_id, outlier_score, is_outlier_issue); low = far from its neighbours."""
    d = materialize(mean_distance(edges))
    bar = round(OUTLIER_MEDIANS * (exact_percentile(d, "d", 0.5) or 0.0), KEY_DIGITS)
    return inverted_min_max(d, "d", "outlier_score").select(
        "row_id", "outlier_score", (F.col("d") > F.lit(bar)).alias("is_outlier_issue")
    )


def near_duplicates(edges: DataFrame) -> DataFrame:
    """(row_id, near_duplicate_score, is_near_duplicate_issue); low = has a close twin."""
    m = materialize(edges.groupBy(F.col("i").alias("row_id")).agg(F.min("dist").alias("m")))
    median = exact_percentile(m, "m", 0.5) or 0.0
    total = F.col("m") + F.lit(median)
    return m.select(
        "row_id",
        F.round(safe_divide(F.col("m"), total), KEY_DIGITS).alias("near_duplicate_score"),
        (F.col("m") <= F.lit(round(DUPLICATE_SHARE * median, KEY_DIGITS))).alias("is_near_duplicate_issue"),
    )


def row_positions(df: DataFrame, order: Sequence[str], id_col: str = "row_id") -> DataFrame:
    """(row_id, pos): 0-based position of each row in the caller's order."""
    cols = list(dict.fromkeys([*order, id_col]))
    ranked = range_rank(df.select(*cols), [F.col(c) for c in cols], out="_nth")
    return ranked.select(F.col(id_col).alias("row_id"), (F.col("_nth") - 1).alias("pos"))


def _background(gap, n: int):
    """Share of row pairs at most ``gap`` apart when order carries no information."""
    return gap * (2 * n - gap - 1) / (n * (n - 1))


def neighbour_gaps(edges: DataFrame, positions: DataFrame) -> DataFrame:
    """(i, gap): distance in row order to each neighbour."""
    a = positions.select(F.col("row_id").alias("i"), F.col("pos").alias("_pi"))
    b = positions.select(F.col("row_id").alias("j"), F.col("pos").alias("_pj"))
    both = skew_join(skew_join(edges.select("i", "j"), b, ["j"]), a, ["i"])
    return both.select("i", F.abs(F.col("_pi") - F.col("_pj")).alias("gap"))


def non_iid_test(gaps: DataFrame, n: int) -> DataFrame:
    """(statistic, p_value, is_non_iid): largest distance between the distribution
    of neighbour gaps and the one expected when order does not matter."""
    counts = gaps.groupBy("gap").agg(F.count(F.lit(1)).alias("c"))
    run = running_totals(counts, ["gap"], ["c"])
    total = F.lit(gaps.count())
    after = F.abs(F.col("c_upto") / total - _background(F.col("gap"), n))
    before = F.abs((F.col("c_upto") - F.col("c")) / total - _background(F.col("gap") - 1, n))
    stat = run.agg(F.max(F.greatest(after, before)).alias("d")).first()["d"] or 0.0
    lam2 = stat * stat * n
    if lam2 < 0.04:
        p = 1.0  # the alternating series needs no summing this close to zero
    else:
        p = 2.0 * sum((-1) ** (q - 1) * math.exp(-2.0 * q * q * lam2) for q in range(1, 101))
    p = min(1.0, max(0.0, p))
    return gaps.sparkSession.createDataFrame(
        [(float(stat), float(p), p < NON_IID_LEVEL)], "statistic double, p_value double, is_non_iid boolean"
    )


def non_iid_scores(gaps: DataFrame, n: int, is_non_iid: bool) -> DataFrame:
    """(row_id, non_iid_score, is_non_iid_issue); low = neighbours sit close in row order.

    When the table as a whole fails the test, its lowest scored rows are flagged.
    """
    s = gaps.groupBy(F.col("i").alias("row_id")).agg(
        F.round(F.avg(_background(F.col("gap"), n)), KEY_DIGITS).alias("non_iid_score")
    )
    if not is_non_iid:
        return s.withColumn("is_non_iid_issue", F.lit(False))
    low = s.agg(F.min("non_iid_score").alias("m")).first()["m"]
    return s.withColumn("is_non_iid_issue", F.col("non_iid_score") <= F.lit(low))


def issue_table(base: DataFrame, checks: dict[str, DataFrame], id_col: str = "row_id") -> DataFrame:
    """One row per input row with is_<t>_issue and <t>_score of every check.

    Rows a check says nothing about count as not flagged with score 1.
    """
    out = base
    for name, frame in checks.items():
        flag, score = f"is_{name}_issue", f"{name}_score"
        extra = [c for c in frame.columns if c not in (id_col, flag, score)]
        out = (
            out.join(frame.select(id_col, flag, score, *extra), id_col, "left")
            .withColumn(flag, F.coalesce(flag, F.lit(False)))
            .withColumn(score, F.coalesce(score, F.lit(1.0)))
        )
    return out


def issue_types(table: DataFrame) -> list[str]:
    return [c[3:-6] for c in table.columns if c.startswith("is_") and c.endswith("_issue")]


def issue_summary(table: DataFrame) -> DataFrame:
    """(issue_type, score, num_issues) from one aggregate over the issue table."""
    names = issue_types(table)
    parts = []
    one = table.agg(
        *[F.avg(f"{t}_score").alias(f"{t}//s") for t in names],
        *[F.count_if(F.coalesce(f"is_{t}_issue", F.lit(False))).alias(f"{t}//n") for t in names],
    )
    for t in names:
        parts.append(
            F.struct(
                F.lit(t).alias("issue_type"),
                F.col(f"`{t}//s`").alias("score"),
                F.col(f"`{t}//n`").alias("num_issues"),
            )
        )
    return one.select(F.explode(F.array(*parts)).alias("s")).select("s.*")


def issue_examples(table: DataFrame, per_type: int = 20, id_col: str = "row_id", source: Sequence[str] = ()) -> DataFrame:
    """The ``per_type`` worst flagged rows of every issue type.

    (issue_type, rank, id, score, label, predicted_label, row); label columns
    appear when the table has them, ``row`` is a struct of the source columns.
    """
    names = issue_types(table)
    kept = [c for c in ("label", "predicted_label") if c in table.columns]
    parts = [
        F.struct(
            F.lit(t).alias("issue_type"),
            F.coalesce(F.col(f"is_{t}_issue"), F.lit(False)).alias("flag"),
            F.col(f"{t}_score").alias("score"),
        )
        for t in names
    ]
    long = (
        table.select(id_col, *kept, F.explode(F.array(*parts)).alias("s"))
        .filter("s.flag")
        .select("s.issue_type", id_col, "s.score", *kept)
    )
    w = Window.partitionBy("issue_type").orderBy("score", id_col)
    worst = long.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= per_type)
    if not source:
        return worst
    # per_type rows of each type meet the table; its columns take no part in the ranking
    rows = table.select(id_col, F.struct(*source).alias("row"))
    return rows.join(checked_broadcast(worst), id_col).select("issue_type", id_col, "score", *kept, "row", "rank")


def run_checks(checks: dict[str, Callable[[], DataFrame]]) -> tuple[dict[str, DataFrame], dict[str, str]]:
    """Run every check; one that fails becomes an error text and the rest go on."""
    done, errors = {}, {}
    for name, check in checks.items():
        try:
            done[name] = check()
        except Exception as e:  # noqa: BLE001 - reported, not hidden
            errors[name] = f"{type(e).__name__}: {e}".splitlines()[0]
    return done, errors
