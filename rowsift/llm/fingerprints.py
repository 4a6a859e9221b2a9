"""Document fingerprints by content-defined chunking.

A gear hash over the last 16 bytes of UTF-8 decides where a text is cut, so a cut
depends on the text around it only and comes back after an insertion. Chunk lengths
are normalised: up to the usual length a cut needs more zero bits, beyond it fewer.
The set of chunk digests, each with its length, is the fingerprint; the bytes of one
set that the other holds too, over all its bytes, measure containment.

Defined results. Null text: as empty. Empty text: no chunk, fingerprint ''; it is
contained in another empty text fully and in any other not at all. Equal texts have
equal fingerprints. Documents are ordered by doc_id, then text (null ids first), so ties
and repeated rows follow each other; a table of one row has itself as the next. Empty
table: no rows. A task works on one text at a time; texts are never collected.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rowsift.llm.common import free_name, small_batches

#: Least, usual and greatest bytes in a chunk; a length is written as two hex digits.
LEAST, USUAL, MOST = 16, 64, 256
#: Bits that must be zero for a cut: before and after the usual length.
HARD, EASY = np.uint32(0xFF << 24), np.uint32(0x1F << 27)
#: Bytes of text in one range of doc_id, about; a task gets one range.
RANGE_BYTES = 16 << 20

_rng = np.random.Generator(np.random.PCG64(5))
_GEAR = _rng.integers(0, 2**32, 256, dtype=np.uint32)
_BYTE = _rng.integers(0, 2**64, 256, dtype=np.uint64)
_BASE = int(_rng.integers(0, 2**63)) * 2 + 1
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> list[np.ndarray]:
    """Powers of the digest base and of its inverse, modulo 2**64."""
    while len(_POWERS[0]) < n:
        size = len(_POWERS[0])
        for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            _POWERS[k] = np.concatenate([_POWERS[k], _POWERS[k] * np.uint64(pow(base, size, 1 << 64))])
    return _POWERS


def gear(data: np.ndarray) -> np.ndarray:
    """Gear hash at every byte: each step shifts left by one and adds the byte's number, 16 bytes deep.

    The numbers are used in their high half, so 16 shifts leave nothing of an older byte
    in the bits that are tested.
    """
    h = _GEAR[data]
    for step in (1, 2, 4, 8):
        older = np.zeros_like(h)
        older[step:] = h[:-step] << np.uint32(step)
        h = h + older
    return h


def cuts(data: np.ndarray) -> list[int]:
    """Ends of the chunks of a text."""
    n = len(data)
    if n <= LEAST:
        return [n] if n else []
    h = gear(data)
    easy = np.flatnonzero((h & EASY) == 0)
    hard = easy[(h[easy] & HARD) == 0].tolist()
    easy = easy.tolist()
    out, start = [], 0
    while n - start > LEAST:
        # a cut after byte i leaves i + 1 - start bytes, all of them in the hash's reach
        i = bisect_left(hard, start + LEAST - 1)
        if i < len(hard) and hard[i] < start + USUAL:
            end = hard[i] + 1
        else:
            i = bisect_left(easy, start + USUAL)
            end = min(easy[i] + 1 if i < len(easy) else n, start + MOST, n)
        out.append(end)
        start = end
    if start < n:
        out.append(n)
    return out


def fingerprint(text: str) -> str:
    """The distinct chunks in order of their codes: ten hex digits of digest, two of length - 1."""
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    if not len(data):
        return ""
    up, down = _powers(len(data))
    ends = np.array(cuts(data))
    starts = np.r_[0, ends[:-1]]
    total = np.r_[np.uint64(0), np.cumsum(_BYTE[data] * up[: len(data)])]
    x = (total[ends] - total[starts]) * down[starts]
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    codes = np.unique(((x >> np.uint64(24)) << np.uint64(8)) | (ends - starts - 1).astype(np.uint64))
    return codes.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 2:].tobytes().hex()


def chunks(print_: str) -> set[str]:
    return {print_[i : i + 12] for i in range(0, len(print_), 12)}


def _weight(found: set[str]) -> int:
    return sum([int(c[10:], 16) + 1 for c in found])


def containment(own: set[str], other: set[str]) -> float:
    """Share of the bytes of the chunk set ``own`` that ``other`` holds."""
    if not own:
        return 1.0 if not other else 0.0
    return _weight(own & other) / _weight(own)


def with_fingerprint(docs: DataFrame, name: str = "fingerprint") -> DataFrame:
    """Add the fingerprint of ``text`` to every row, without shuffling; a clashing name gets underscores."""
    small_batches(docs.sparkSession)
    name = free_name(docs.columns, name)
    plain = docs.withColumn(name, F.lit(None).cast("string"))

    def run(batches):
        for b in batches:
            prints = [fingerprint(t.as_py() or "") for t in b.column(b.schema.get_field_index("text"))]
            columns = list(b.columns)
            columns[b.schema.get_field_index(name)] = pa.array(prints, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=b.schema.names)

    return plain.mapInArrow(run, plain.schema)


class _Doc:
    __slots__ = ("id", "text", "print", "parts")

    def __init__(self, doc_id, text: str | None):
        self.id, self.text = doc_id, text or ""
        self.print = fingerprint(self.text)
        self.parts = chunks(self.print)


def _compared(own: _Doc, after: _Doc) -> tuple:
    """The result row of a document and the next one."""
    n = len(own.text)
    tail = n // 4
    edited = own.text[: n - tail] + after.text[:tail]
    print_ = fingerprint(edited)
    return (
        own.id,
        n,
        hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(),
        own.print,
        print_,
        containment(own.parts, chunks(print_)),
        containment(own.parts, after.parts),
    )


_RESULT = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_chars", pa.int64()),
        ("edited_sha256", pa.string()),
        ("fingerprint", pa.string()),
        ("edited_fingerprint", pa.string()),
        ("near_edited", pa.float64()),
        ("near_next", pa.float64()),
    ]
)
_FIELDS = "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _rows(found: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in found], f.type) for i, f in enumerate(schema)], schema=schema)


def _ranged(rows: DataFrame, parts: int) -> DataFrame:
    """Add ``range``, the number of the interval of doc_id (null: the first) that a row falls in."""
    quantiles = [i / parts for i in range(1, parts)]
    found = rows.select(F.percentile_approx("doc_id", quantiles, max(10_000, 20 * parts)).alias("c")).first()["c"] if quantiles else None
    cuts = np.unique(np.array(found or [], np.int64))
    if not len(cuts):
        return rows.withColumn("range", F.lit(0).cast("long"))
    sent = rows.sparkSession.sparkContext.broadcast(cuts)  # one number per range

    @F.pandas_udf("long")
    def number(ids: pd.Series) -> pd.Series:
        known = ids.notna().to_numpy()
        out = np.zeros(len(ids), np.int64)
        out[known] = np.searchsorted(sent.value, ids[known].to_numpy(np.int64), side="right")
        return pd.Series(out)

    return rows.withColumn("range", number("doc_id"))


def compare_with_edit(docs: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Fingerprints of every document, of its edited text and their likeness to each other and the next.

    The edited text has the last quarter of the code points replaced by the first ones
    of the next document. One shuffle of the texts brings neighbours together, in ranges
    of doc_id; each range also gets the first text of the next one.
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    size = docs.select(F.sum(F.octet_length("text")).alias("b")).first()["b"] or 0
    parts = max(1, -(-size // range_bytes))
    ranged = _ranged(rows, parts)
    # the smallest doc_id of each range, and then the texts of these documents only
    heads = ranged.drop("text").groupBy("range").agg(F.min("doc_id").alias("head"), F.bool_or(F.col("doc_id").isNull()).alias("nulls"))
    heads = heads.select("range", F.when(~F.col("nulls"), F.col("head")).alias("head"))
    order = Window.orderBy("range")  # a row per range
    heads = heads.withColumn("before", F.coalesce(F.lag("range").over(order), F.max("range").over(Window.partitionBy(F.lit(0)))))
    guards = (
        rows.join(F.broadcast(heads), rows["doc_id"].eqNullSafe(F.col("head")))
        .groupBy("before")
        .agg(F.min(F.struct(F.col("text").isNotNull().alias("k"), "text")).alias("x"))
        .select(F.lit(None).cast("long").alias("doc_id"), F.col("x.text").alias("text"), F.col("before").alias("range"), F.lit(True).alias("guard"))
    )
    dealt = ranged.withColumn("guard", F.lit(False)).unionByName(guards).repartitionById(parts, F.col("range").cast("int"))
    ordered = dealt.sortWithinPartitions("range", "guard", F.col("doc_id").asc_nulls_first(), F.col("text").asc_nulls_first())

    def run(batches):
        before = None
        for b in batches:
            found = []
            for doc_id, text, guard in zip(b.column("doc_id").to_pylist(), b.column("text"), b.column("guard").to_pylist(), strict=True):
                doc = _Doc(doc_id, text.as_py())
                if before is not None:
                    found.append(_compared(before, doc))
                before = None if guard else doc
            yield _rows(found, _RESULT)

    return ordered.mapInArrow(run, _FIELDS)
