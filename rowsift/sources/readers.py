"""File readers with the cleaning each format needs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_headerless_csv(spark: SparkSession, path: str, schema: str | T.StructType, missing: str = "?") -> DataFrame:
    """CSV without a header; ``missing`` marks nulls and strings are trimmed."""
    raw = spark.read.schema(schema).csv(
        path, nullValue=missing, ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True
    )
    text = [f.name for f in raw.schema.fields if isinstance(f.dataType, T.StringType)]
    return raw.withColumns({c: F.when(F.trim(c) != missing, F.trim(c)) for c in text}) if text else raw


def read_csv(
    spark: SparkSession, path: str, schema: str | T.StructType | None = None, drop: Sequence[str] = ()
) -> DataFrame:
    """CSV with a header, without the columns named in ``drop`` (absent names are fine)."""
    reader = spark.read.option("header", True)
    frame = reader.schema(schema).csv(path) if schema else reader.option("inferSchema", True).csv(path)
    return frame.drop(*drop)


def read_delimited(
    spark: SparkSession, path: str, schema: str | T.StructType, sep: str, encoding: str = "UTF-8"
) -> DataFrame:
    """Headerless delimited text with given names, e.g. '|' items or tab ratings."""
    return spark.read.schema(schema).csv(path, sep=sep, encoding=encoding)


def read_parquet(spark: SparkSession, path: str, columns: Sequence[str] = ()) -> DataFrame:
    frame = spark.read.parquet(path)
    return frame.select(*columns) if columns else frame


#: Column positions of the CoNLL-U format.
CONLLU_COLUMNS = {"id": 0, "form": 1, "lemma": 2, "upos": 3, "xpos": 4, "feats": 5, "head": 6, "deprel": 7, "deps": 8, "misc": 9}


def read_conllu(
    spark: SparkSession, path: str, token: str = "form", tag: str = "upos", max_sentences: int | None = None
) -> DataFrame:
    """(sent_id, tok_i, token, tag): one row per word of a CoNLL-U file.

    A line that is empty or holds white space only ends a sentence, and so does the end
    of a file; line ends may be of either kind. Comments, ids that are not plain numbers
    and lines without the wanted columns are skipped. Sentences are numbered in file
    order. Files are split by line: sentence numbers are running counts, so neither a
    long sentence nor a large file has to fit one task.
    """
    from rowsift.functions.ranking import range_rank, running_totals
    from rowsift.functions.runtime import materialize

    cells = F.split("_line", "\t")
    at = [CONLLU_COLUMNS[token] + 1, CONLLU_COLUMNS[tag] + 1]
    lines = materialize(
        spark.read.text(path).select(
            F.col("_metadata.file_path").alias("_file"),
            F.col("_metadata.file_block_start").alias("_block"),
            F.monotonically_increasing_id().alias("_at"),
            F.regexp_replace("value", "\r$", "").alias("_line"),
        )
    )
    wordy = F.coalesce(cells[0].rlike("^[0-9]+$"), F.lit(False)) & (F.size(cells) >= max(at))
    marked = lines.select(
        "_file",
        "_block",
        "_at",
        F.col("_line").rlike("^\\s*$").cast("bigint").alias("_break"),
        wordy.cast("bigint").alias("_word"),
        F.when(wordy, F.struct(cells[at[0] - 1].alias("token"), cells[at[1] - 1].alias("tag"))).alias("_w"),
    )
    counted = running_totals(marked, ["_file", "_block", "_at"], ["_break", "_word"]).filter("_w IS NOT NULL")
    words = materialize(counted.select("_file", F.col("_break_upto").alias("_s"), F.col("_word_upto").alias("_n"), "_w"))
    starts = words.groupBy("_file", "_s").agg(F.min("_n").alias("_head"))
    numbered = range_rank(starts, [F.col("_head")], out="_k")
    if max_sentences is not None:
        numbered = numbered.filter(F.col("_k") <= max_sentences)
    return words.join(numbered, ["_file", "_s"]).select(
        (F.col("_k") - 1).cast("bigint").alias("sent_id"),
        (F.col("_n") - F.col("_head")).cast("int").alias("tok_i"),
        "_w.token",
        "_w.tag",
    )
