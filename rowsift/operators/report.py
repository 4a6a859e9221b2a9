"""Rule-based report over run results."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed limits of the rules.
LOW_AUC = 0.7
MANY_ISSUES = 50


def report(
    metrics: DataFrame,
    n_issues: int | DataFrame,
    summary: DataFrame,
    task: str = "classification",
    primary: tuple[str, ...] | None = None,
) -> DataFrame:
    """(rule, fired, detail) rows.

    ``metrics`` is (variant, metric, value) with a ``baseline`` variant,
    ``summary`` is (issue_type, score, num_issues), ``n_issues`` the number of
    label issues or a frame of them. Only single-row aggregates are joined.
    """
    from rowsift.operators.models import primary_name

    order = primary or primary_name(task)
    by_variant = metrics.groupBy("variant").agg(
        F.coalesce(*[F.max(F.when(F.col("metric") == m, F.col("value"))) for m in order]).alias("primary"),
        F.max(F.when((F.col("variant") == "baseline") & (F.col("metric") == "roc_auc"), F.col("value"))).alias("auc"),
    )
    best = by_variant.agg(
        F.max_by("variant", F.struct("primary", F.col("variant"))).alias("best_variant"),
        F.max("auc").alias("auc"),
    ).first()
    counts = {r["issue_type"]: r["num_issues"] for r in summary.collect()}
    n = n_issues if isinstance(n_issues, int) else n_issues.count()
    auc = best["auc"] if best["auc"] is not None else 0.0
    outliers, twins = counts.get("outlier", 0), counts.get("near_duplicate", 0)
    rows = [
        ("label_issues", n > 0, str(n)),
        ("best_variant", best["best_variant"] is not None, str(best["best_variant"])),
        ("low_auc", auc < LOW_AUC, f"{auc:.4f}"),
        ("many_label_issues", n > MANY_ISSUES, str(n)),
        ("review_outliers", outliers > 0, str(outliers)),
        ("review_near_duplicates", twins > 0, str(twins)),
        ("start_with_outliers", task == "regression", task),
    ]
    return metrics.sparkSession.createDataFrame(rows, "rule string, fired boolean, detail string")
