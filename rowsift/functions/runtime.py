"""Session-level helpers: lineage cuts and size-checked broadcasts."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Most rows a side may have before it is no longer broadcast or collected.
SMALL_ROWS = 100_000


_SHIPPED = "rowsift.zip"


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per Spark application.

    The archive is built beside the driver; Spark's own file service delivers it.
    """
    sc = spark.sparkContext
    if any(os.path.basename(f) == _SHIPPED for f in sc.listFiles):
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(prefix="rowsift-code-"), _SHIPPED)
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(package):
            for n in sorted(names):
                if n.endswith(".py"):
                    path = os.path.join(folder, n)
                    z.write(path, os.path.relpath(path, os.path.dirname(package)))
    sc.addPyFile(archive)


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; a temporary one only where it is unset on a local master."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        own = tempfile.mkdtemp(prefix="rowsift-shared-")
        spark.conf.set("spark.checkpoint.dir", own)
        return own
    raise RuntimeError(
        "set spark.checkpoint.dir to a folder every executor can reach before running on a cluster"
    )


def materialize(df: DataFrame, schema: StructType | None = None) -> DataFrame:
    """Write ``df`` once as Parquet to the shared folder and read it from there.

    Used where a result feeds several consumers, or where a partition number
    must not change on recomputation. Readers get column pruning and filter pushdown;
    the files of an application lie in one folder that bears its id, so that they can
    be removed when it has ended. ``schema`` reads the same columns as other types, such as a
    struct as the vector that is stored like it.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/rowsift-{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(schema or df.schema).parquet(path)


def collect_small(df: DataFrame, limit: int = SMALL_ROWS) -> list:
    """Collect a frame that must be small; more than ``limit`` rows is an error."""
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"more than {limit} rows where a small table is required")
    return rows


def checked_broadcast(df: DataFrame, limit: int = SMALL_ROWS) -> DataFrame:
    """Broadcast ``df`` only after its row count was seen to be within ``limit``.

    Beyond the limit the frame comes back without a hint, so Spark joins it by
    shuffle.
    """
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        return df
    return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema))


def row_count(df: DataFrame) -> int:
    return df.agg(F.count(F.lit(1)).alias("n")).first()["n"]


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Hash-repartition an input that arrives in fewer partitions than there are cores.

    A large table already comes in many splits and passes unchanged; a small
    file in one split would otherwise keep all but one core idle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, *keys) if df.rdd.getNumPartitions() < cores else df
