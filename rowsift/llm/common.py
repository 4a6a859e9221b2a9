"""What the operators of this subpackage share: work folder, written tables, text rules."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowsift.functions.runtime import shared_folder

#: The characters that part words: blank, tab, line feed, vertical tab, form feed, carriage return.
SPACES = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Rows in one Arrow batch; with long texts the default of 10,000 would fill a worker's memory.
BATCH_ROWS = 1000


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to a new folder of the shared folder and read it back.

    This cuts the lineage at files that outlive any executor.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/rowsift-{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fitted(df: DataFrame, rows: int, per_task: int) -> DataFrame:
    """``df`` in no more tasks than its rows fill.

    A small table would otherwise go through as many tasks as the shuffle setting says.
    """
    return df.coalesce(max(1, -(-rows // per_task)))


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Keep Arrow batches small, so that a batch of long texts fits a Python worker."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) > rows:
        spark.conf.set(key, str(rows))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row."""
    return F.transform(F.array(value), body)[0]


def text_or_empty(text: Column | str) -> Column:
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def words(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a non-null text, in order."""
    return let(
        F.btrim(text, F.lit(SPACES)),
        lambda t: F.when(F.length(t) == 0, F.array().cast("array<string>")).otherwise(
            F.split(t, "[\\x20\\x09-\\x0D]+")
        ),
    )


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z; every other character stays."""
    return F.translate(text, UPPER, LOWER)


def texts_of(batch, name: str = "text") -> Iterator[str]:
    """Texts of an Arrow batch, null as empty."""
    for x in batch.column(batch.schema.get_field_index(name)):
        yield x.as_py() or ""


def free_name(columns: list[str], wanted: str) -> str:
    """``wanted``, with underscores before it until no column has that name (case ignored)."""
    taken = {c.lower() for c in columns}
    while wanted.lower() in taken:
        wanted = "_" + wanted
    return wanted


def documents(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def plain_name(text: str) -> str:
    """Letters, digits and underscores of ``text`` only."""
    return re.sub(r"\W+", "_", text)
