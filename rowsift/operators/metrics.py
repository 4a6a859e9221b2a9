"""Quality metrics as (metric, value) rows, computed from counts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowsift.functions.arrays import prob_at, safe_divide
from rowsift.functions.ranking import KEY_DIGITS, running_totals

#: Smallest probability that enters a logarithm.
LOG_FLOOR = 1e-15


def _long(one_row: DataFrame) -> DataFrame:
    return one_row.unpivot([], one_row.columns, "metric", "value")


def confusion(df: DataFrame, truth: str, pred: str) -> DataFrame:
    """(truth, predicted, n)."""
    return df.groupBy(F.col(truth).alias("truth"), F.col(pred).alias("predicted")).agg(
        F.count(F.lit(1)).alias("n")
    )


def per_class(counts: DataFrame) -> DataFrame:
    """(cls, tp, support, guessed, f1, precision) over classes seen on either side."""
    hit = F.col("truth") == F.col("predicted")
    sides = F.array(
        F.struct(
            F.col("truth").alias("cls"),
            F.when(hit, F.col("n")).otherwise(0).alias("tp"),
            F.col("n").alias("support"),
            F.lit(0).cast("bigint").alias("guessed"),
        ),
        F.struct(
            F.col("predicted").alias("cls"),
            F.lit(0).cast("bigint").alias("tp"),
            F.lit(0).cast("bigint").alias("support"),
            F.col("n").alias("guessed"),
        ),
    )
    sums = (
        counts.select(F.explode(sides).alias("s"))
        .groupBy(F.col("s.cls").alias("cls"))
        .agg(
            F.sum("s.tp").alias("tp"), F.sum("s.support").alias("support"), F.sum("s.guessed").alias("guessed")
        )
    )
    return sums.withColumns(
        {
            "f1": safe_divide(2.0 * F.col("tp"), F.col("support") + F.col("guessed")),
            "precision": safe_divide(F.col("tp").cast("double"), F.col("guessed")),
        }
    )


def classification_metrics(df: DataFrame, truth: str, pred: str) -> DataFrame:
    """accuracy, f1_weighted, precision_weighted, f1_macro, f1_micro."""
    by_class = per_class(confusion(df, truth, pred))
    n = F.sum("support")
    return _long(
        by_class.agg(
            (F.sum("tp") / n).alias("accuracy"),
            (F.sum(F.col("f1") * F.col("support")) / n).alias("f1_weighted"),
            (F.sum(F.col("precision") * F.col("support")) / n).alias("precision_weighted"),
            F.avg("f1").alias("f1_macro"),
            safe_divide(2.0 * F.sum("tp"), F.sum("support") + F.sum("guessed")).alias("f1_micro"),
        )
    )


def roc_auc(df: DataFrame, truth: str, score: str, groups: tuple[str, ...] = ()) -> DataFrame:
    """(groups..., auc); null when only one class is present.

    Rows collapse to one per distinct score before the running count.
    """
    y = F.col(truth).cast("bigint")
    at = df.groupBy(*groups, F.round(score, KEY_DIGITS).alias("_s")).agg(
        F.sum(y).alias("pos"), F.sum(1 - y).alias("neg")
    )
    run = running_totals(at, ["_s"], ["neg"], groups)
    won = F.sum(F.col("pos") * (F.col("neg_upto") - F.col("neg") / 2.0))
    pairs = F.sum("pos") * F.sum("neg")
    return run.groupBy(*groups).agg(F.when(pairs > 0, won / pairs).alias("auc"))


def roc_auc_macro(df: DataFrame, label: str, probs: str) -> DataFrame:
    """Unweighted mean over classes of one-vs-rest AUC; null if any class has none."""
    long = df.select(label, F.posexplode(probs).alias("_k", "_p")).withColumn(
        "_y", (F.col(label) == F.col("_k")).cast("int")
    )
    each = roc_auc(long, "_y", "_p", ("_k",))
    return each.agg(F.when(F.count_if(F.col("auc").isNull()) == 0, F.avg("auc")).alias("auc"))


def primary_metric(metrics: DataFrame) -> DataFrame:
    """ROC AUC when present, else weighted F1."""
    pick = lambda m: F.max(F.when(F.col("metric") == m, F.col("value")))
    return metrics.agg(F.coalesce(pick("roc_auc"), pick("f1_weighted")).alias("primary"))


def log_loss(df: DataFrame, label: str, probs: str) -> DataFrame:
    p = F.greatest(prob_at(probs, label), F.lit(LOG_FLOOR))
    return df.agg(F.avg(-F.log(p)).alias("log_loss"))


def multilabel_metrics(df: DataFrame, truth: str, pred: str, n_bits: int) -> DataFrame:
    """subset_accuracy, hamming_loss, f1_micro, f1_macro."""
    t = [F.element_at(truth, i + 1) for i in range(n_bits)]
    p = [F.element_at(pred, i + 1) for i in range(n_bits)]
    sums = df.agg(
        F.avg((F.col(truth) == F.col(pred)).cast("double")).alias("subset_accuracy"),
        F.avg(sum((F.abs(a - b) for a, b in zip(t, p)), F.lit(0)) / n_bits).alias("hamming_loss"),
        *[F.sum(a * b).alias(f"tp{i}") for i, (a, b) in enumerate(zip(t, p))],
        *[F.sum(a + b).alias(f"all{i}") for i, (a, b) in enumerate(zip(t, p))],
    )
    tp = [F.col(f"tp{i}") for i in range(n_bits)]
    both = [F.col(f"all{i}") for i in range(n_bits)]
    add = lambda cs: reduce(lambda a, b: a + b, cs)
    return _long(
        sums.select(
            "subset_accuracy",
            "hamming_loss",
            safe_divide(2.0 * add(tp), add(both)).alias("f1_micro"),
            (add([safe_divide(2.0 * a, b) for a, b in zip(tp, both)]) / n_bits).alias("f1_macro"),
        )
    )


def regression_metrics(df: DataFrame, truth: str, pred: str) -> DataFrame:
    """mse, rmse, mae, r2 in one pass."""
    e = F.col(truth) - F.col(pred)
    mse, var = F.avg(e * e), F.var_pop(truth)
    return _long(
        df.agg(
            mse.alias("mse"),
            F.sqrt(mse).alias("rmse"),
            F.avg(F.abs(e)).alias("mae"),
            F.when(var > 0, 1 - mse / var).otherwise(0.0).alias("r2"),
        )
    )


def set_quality(found: DataFrame, true: DataFrame, keys: tuple[str, ...] = ("row_id",)) -> DataFrame:
    """Precision and recall of one id set against another; 0 when a side is empty."""
    a = found.select(*keys).distinct().withColumn("_f", F.lit(1))
    b = true.select(*keys).distinct().withColumn("_t", F.lit(1))
    both = a.join(b, list(keys), "full_outer")
    counts = both.agg(
        F.count("_f").alias("n_found"),
        F.count("_t").alias("n_true"),
        F.count_if(F.col("_f").isNotNull() & F.col("_t").isNotNull()).alias("n_hit"),
    )
    return counts.withColumns(
        {
            "precision": safe_divide(F.col("n_hit").cast("double"), F.col("n_found")),
            "recall": safe_divide(F.col("n_hit").cast("double"), F.col("n_true")),
        }
    )


def flag_quality(df: DataFrame, found: Column, true: Column) -> DataFrame:
    """:func:`set_quality` when both flags sit on the same rows: one aggregate, no join."""
    counts = df.agg(
        F.count_if(found).alias("n_found"),
        F.count_if(true).alias("n_true"),
        F.count_if(found & true).alias("n_hit"),
    )
    return counts.withColumns(
        {
            "precision": safe_divide(F.col("n_hit").cast("double"), F.col("n_found")),
            "recall": safe_divide(F.col("n_hit").cast("double"), F.col("n_true")),
        }
    )


def mean_metric(metrics: DataFrame, percent: bool = False) -> DataFrame:
    """Mean of the metric values, 0 when there are none."""
    mean = F.coalesce(F.avg("value"), F.lit(0.0))
    return metrics.agg((mean * 100 if percent else mean).alias("value"))
