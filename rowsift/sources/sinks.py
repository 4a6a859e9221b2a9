"""Writers for issue tables, run results and sweep rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _flat(df: DataFrame) -> DataFrame:
    nested = (T.ArrayType, T.MapType, T.StructType)
    cols = [f.name for f in df.schema.fields if isinstance(f.dataType, nested)]
    return df.withColumns({c: F.to_json(c) for c in cols}) if cols else df


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header; nested columns become JSON text."""
    _flat(df).write.mode("overwrite").option("header", True).csv(path)


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_json(result: DataFrame, path: str) -> None:
    """One JSON object per row, stamped with the time of writing."""
    result.withColumn("written_at", F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ssXXX")).write.mode(
        "overwrite"
    ).json(path)


def metrics_map(metrics: DataFrame) -> DataFrame:
    """(variant, metrics MAP<STRING, DOUBLE>) from (variant, metric, value) rows."""
    pairs = F.map_from_entries(F.array_sort(F.collect_list(F.struct("metric", "value"))))
    return metrics.groupBy("variant").agg(pairs.alias("metrics"))
