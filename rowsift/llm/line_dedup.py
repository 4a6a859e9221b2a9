"""Line dedup that can take documents back: sharded cuckoo filters before exact reference counts.

State, as tables: ``refs`` holds each (key, doc_id) once, ``counts`` the number of
documents and the largest doc_id of each key, ``filters`` one cuckoo filter per shard
with the keys found in enough documents. A key is the 128-bit digest of a line,
stripped and lower-cased (A-Z). A shard is a range of digests; their number follows
the number of frequent keys, so a filter never exceeds a fixed size. Adding documents
inserts references and those keys into the filters that newly reach the threshold;
removing them deletes references and takes back keys that fall below it, which cuckoo
filters allow. A filter never misses a key it holds; what it finds wrongly, the join
with the exact counts takes out again. Filters are broadcast while their size, summed
first, is within ``FILTER_BYTES``; beyond it every reference goes to the exact join.

Defined results. Null or empty text: one empty line, which stays. Null doc_id: such
rows lose no line and aren't counted. Rows that repeat a doc_id count as one document;
all are treated alike. Ties cannot occur, the largest doc_id of a key is one. Empty
table: no rows. Other columns pass through.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowsift.llm.common import SPACES, free_name, small_batches, written

MIN_CHARS = 40
MIN_DOCS = 5
#: Most keys in one shard's filter.
SHARD_KEYS = 50_000
#: Most bytes of all filters together that are broadcast.
FILTER_BYTES = 32 << 20
SLOTS = 4
KICKS = 500


def line_digest(line: str, min_chars: int) -> bytes | None:
    """Digest of the key of a line, or None if the key is too short."""
    key = line.strip(SPACES)
    if len(key) < min_chars:
        return None
    return hashlib.blake2b(key.encode("utf-8", "surrogatepass").lower(), digest_size=16).digest()


class CuckooFilter:
    """16-bit fingerprints in buckets of four; a fingerprint may be taken out again."""

    def __init__(self, table: np.ndarray):
        self.table = table  # buckets x SLOTS, 0: free
        self.mask = len(table) - 1

    @classmethod
    def sized(cls, n: int) -> CuckooFilter:
        buckets = 1
        while buckets * SLOTS * 0.8 < max(n, 1):
            buckets *= 2
        return cls(np.zeros((buckets, SLOTS), np.uint16))

    @staticmethod
    def _hashes(digests: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        raw = np.frombuffer(b"".join(digests), np.uint64).reshape(-1, 2)
        return (raw[:, 1] >> np.uint64(48)).astype(np.uint16) | np.uint16(1), raw[:, 1] & np.uint64(0xFFFFFFFF)

    def _other(self, at: int, mark: int) -> int:
        return (at ^ (mark * 0x5BD1E995)) & self.mask

    def insert(self, digest: bytes) -> bool:
        """False if no place was found; the filter is then to be built larger."""
        marks, spots = self._hashes([digest])
        mark, at = int(marks[0]), int(spots[0]) & self.mask
        for place in (at, self._other(at, mark)):
            free = np.flatnonzero(self.table[place] == 0)
            if len(free):
                self.table[place, free[0]] = mark
                return True
        trail = []
        for k in range(KICKS):
            slot = (k + mark) % SLOTS
            trail.append((at, slot, int(self.table[at, slot])))
            mark, self.table[at, slot] = int(self.table[at, slot]), mark
            at = self._other(at, mark)
            free = np.flatnonzero(self.table[at] == 0)
            if len(free):
                self.table[at, free[0]] = mark
                return True
        for place, slot, was in reversed(trail):
            self.table[place, slot] = was
        return False

    def delete(self, digest: bytes) -> bool:
        marks, spots = self._hashes([digest])
        mark, at = int(marks[0]), int(spots[0]) & self.mask
        for place in (at, self._other(at, mark)):
            found = np.flatnonzero(self.table[place] == mark)
            if len(found):
                self.table[place, found[0]] = 0
                return True
        return False

    def contains(self, digests: list[bytes]) -> np.ndarray:
        if not digests:
            return np.zeros(0, bool)
        marks, spots = self._hashes(digests)
        at = (spots & np.uint64(self.mask)).astype(np.int64)
        other = (at ^ (marks.astype(np.int64) * 0x5BD1E995)) & self.mask
        return ((self.table[at] == marks[:, None]) | (self.table[other] == marks[:, None])).any(axis=1)

    @classmethod
    def of(cls, digests: list[bytes]) -> CuckooFilter:
        size = len(digests)
        while True:
            out = cls.sized(size)
            if all(out.insert(d) for d in digests):
                return out
            size = max(2 * size, 8)


def shard_of(digest: bytes, shards: int) -> int:
    return int.from_bytes(digest[:4], "big") * shards >> 32


def _shard_column(shards: int):
    first = F.conv(F.hex(F.substring("key", 1, 4)), 16, 10).cast("long")
    return F.shiftright(first * shards, 32).cast("int")


@dataclass
class LineState:
    """The exact tables and the filters that stand before them."""

    refs: DataFrame  # key binary, doc_id bigint; each pair once
    counts: DataFrame  # key, n_docs, max_doc
    filters: DataFrame  # shard int, n_keys bigint, slots binary
    shards: int
    min_chars: int = MIN_CHARS
    min_docs: int = MIN_DOCS


def references(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(key, doc_id): the distinct long lines of each row."""
    small_batches(docs.sparkSession)

    def run(batches):
        for b in batches:
            keys, ids = [], []
            for doc, t in zip(b.column("doc_id").to_pylist(), b.column("text"), strict=True):
                found = {line_digest(x, min_chars) for x in (t.as_py() or "").split("\n")} - {None}
                keys += found
                ids += [doc] * len(found)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(ids, pa.int64())], names=["key", "doc_id"])

    rows = docs.filter("doc_id is not null and text is not null").select(F.col("doc_id").cast("long"), "text")
    return rows.mapInArrow(run, "key binary, doc_id bigint")


def _count(refs: DataFrame) -> DataFrame:
    return refs.groupBy("key").agg(F.count(F.lit(1)).alias("n_docs"), F.max("doc_id").alias("max_doc"))


def _filter_rows(keys: DataFrame, shards: int) -> DataFrame:
    """One filter per shard out of the frequent keys; a shard has a bounded number of them."""

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        made = CuckooFilter.of(sorted(pdf["key"]))
        return pd.DataFrame({"shard": [int(pdf["shard"].iloc[0])], "n_keys": [len(pdf)], "slots": [made.table.tobytes()]})

    return keys.select("key", _shard_column(shards).alias("shard")).groupBy("shard").applyInPandas(
        build, "shard int, n_keys bigint, slots binary"
    )


def build_state(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> LineState:
    """State of a first load of documents."""
    refs = written(references(docs, min_chars).distinct(), "line-refs")
    counts = written(_count(refs), "line-counts")
    frequent = counts.filter(F.col("n_docs") >= min_docs)
    shards = max(1, -(-frequent.count() // SHARD_KEYS) * 2)
    return LineState(refs, counts, written(_filter_rows(frequent, shards), "line-filters"), shards, min_chars, min_docs)


def _change(state: LineState, refs: DataFrame, touched: DataFrame) -> LineState:
    """State with new references; only the keys of ``touched`` are counted and filtered anew."""
    keys = touched.select("key").distinct()
    fresh = _count(refs.join(keys, "key", "left_semi"))
    counts = written(state.counts.join(keys, "key", "left_anti").unionByName(fresh), "line-counts")
    m = state.min_docs
    before = state.counts.filter(F.col("n_docs") >= m).select("key").join(keys, "key", "left_semi")
    after = fresh.filter(F.col("n_docs") >= m).select("key")
    moves = after.join(before, "key", "left_anti").withColumn("enters", F.lit(True)).unionByName(
        before.join(after, "key", "left_anti").withColumn("enters", F.lit(False))
    )
    shards = state.shards

    def apply(filters: pd.DataFrame, changes: pd.DataFrame) -> pd.DataFrame:
        shard = int((filters if len(filters) else changes)["shard"].iloc[0])
        n = int(filters["n_keys"].iloc[0]) if len(filters) else 0
        slots = filters["slots"].iloc[0] if len(filters) else b""
        table = np.frombuffer(slots, np.uint16).reshape(-1, SLOTS).copy() if slots else CuckooFilter.sized(len(changes)).table
        made, full = CuckooFilter(table), False
        for key, enters in zip(changes["key"], changes["enters"], strict=True):
            if enters:
                full = full or not made.insert(key)
            else:
                made.delete(key)
        n += int(changes["enters"].sum()) - int((~changes["enters"].astype(bool)).sum())
        # a full filter is marked, and its shard is built anew from the exact counts
        return pd.DataFrame({"shard": [shard], "n_keys": [-1 if full else n], "slots": [b"" if full else made.table.tobytes()]})

    filters = written(
        state.filters.groupBy("shard").cogroup(moves.withColumn("shard", _shard_column(shards)).groupBy("shard")).applyInPandas(
            apply, "shard int, n_keys bigint, slots binary"
        ),
        "line-filters",
    )
    if not filters.filter("n_keys < 0").isEmpty():
        frequent = counts.filter(F.col("n_docs") >= m)
        shards = max(1, -(-frequent.count() // SHARD_KEYS) * 2)
        filters = written(_filter_rows(frequent, shards), "line-filters")
    return LineState(refs, counts, filters, shards, state.min_chars, m)


def add_documents(state: LineState, docs: DataFrame) -> LineState:
    """State after more documents; references it already holds change nothing."""
    new = written(references(docs, state.min_chars).distinct().join(state.refs, ["key", "doc_id"], "left_anti"), "line-new")
    return _change(state, written(state.refs.unionByName(new), "line-refs"), new)


def remove_documents(state: LineState, doc_ids: DataFrame) -> LineState:
    """State as if the documents of these ids had never come."""
    ids = doc_ids.select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    gone = written(state.refs.join(ids, "doc_id", "left_semi").select("key", "doc_id"), "line-gone")
    return _change(state, written(state.refs.join(ids, "doc_id", "left_anti").select("key", "doc_id"), "line-refs"), gone)


def drops(state: LineState) -> DataFrame:
    """(doc_id, key) of all lines that go: frequent keys, but for the largest document of each."""
    frequent = state.counts.filter(F.col("n_docs") >= state.min_docs).select("key", "max_doc")
    candidates = state.refs
    if (state.filters.agg(F.sum(F.length("slots"))).first()[0] or 0) <= FILTER_BYTES:
        shards = state.shards
        tables = candidates.sparkSession.sparkContext.broadcast({r["shard"]: bytes(r["slots"]) for r in state.filters.collect()})

        def probe(batches: Iterator[pa.RecordBatch]):
            loaded = {k: CuckooFilter(np.frombuffer(v, np.uint16).reshape(-1, SLOTS)) for k, v in tables.value.items()}
            for b in batches:
                keys = b.column("key").to_pylist()
                groups: dict[int, list[int]] = {}
                for i, k in enumerate(keys):
                    groups.setdefault(shard_of(k, shards), []).append(i)
                hit = np.zeros(len(keys), bool)
                for s, at in groups.items():
                    if s in loaded:
                        hit[at] = loaded[s].contains([keys[i] for i in at])
                yield b.filter(pa.array(hit))

        candidates = candidates.mapInArrow(probe, candidates.schema)
    return candidates.join(frequent, "key").filter(F.col("doc_id") < F.col("max_doc")).select("doc_id", "key")


def _cut_rows(docs: DataFrame, state: LineState, out: T.StructType, row) -> DataFrame:
    """Rows of ``docs`` beside the keys they lose, handled by ``row(batch, kept, n_lines, n_dropped)``."""
    lost_name = free_name(docs.columns, "lost_keys")
    id_name = free_name(docs.columns, "lost_doc")
    lost = drops(state).groupBy(F.col("doc_id").alias(id_name)).agg(F.collect_list("key").alias(lost_name))
    rows = docs.join(lost, docs["doc_id"] == F.col(id_name), "left").drop(id_name)
    min_chars = state.min_chars

    def run(batches):
        for b in batches:
            texts, n_lines, n_dropped = [], [], []
            for t, lost in zip(b.column(b.schema.get_field_index("text")), b.column(b.schema.get_field_index(lost_name)), strict=True):
                text, gone = t.as_py(), set(lost.as_py() or ())
                lines = (text or "").split("\n")
                kept = [x for x in lines if line_digest(x, min_chars) not in gone] if gone else lines
                texts.append("\n".join(kept) if gone else text)
                n_lines.append(len(lines))
                n_dropped.append(len(lines) - len(kept))
            yield row(b.drop_columns([lost_name]), texts, n_lines, n_dropped)

    return rows.mapInArrow(run, out)


def line_report(docs: DataFrame, state: LineState) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept_sha256) of every row of ``docs``."""

    def row(b, texts, n_lines, n_dropped):
        hexes = [hashlib.sha256((t or "").encode()).hexdigest() for t in texts]
        return pa.RecordBatch.from_arrays(
            [b.column("doc_id"), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()), pa.array(hexes, pa.string())],
            names=["doc_id", "n_lines", "n_dropped", "kept_sha256"],
        )

    rows = docs.select("doc_id", "text")
    out = T.StructType(
        [
            rows.schema["doc_id"],
            T.StructField("n_lines", T.LongType()),
            T.StructField("n_dropped", T.LongType()),
            T.StructField("kept_sha256", T.StringType()),
        ]
    )
    return _cut_rows(rows, state, out, row)


def drop_lines(docs: DataFrame, state: LineState) -> DataFrame:
    """``docs`` with the frequent lines cut out of ``text``; a column n_chars is counted anew."""

    def row(b, texts, n_lines, n_dropped):
        columns = list(b.columns)
        columns[b.schema.get_field_index("text")] = pa.array(texts, pa.string())
        at = b.schema.get_field_index("n_chars")
        if at >= 0:
            columns[at] = pa.array([None if t is None else len(t) for t in texts], b.schema.field(at).type)
        return pa.RecordBatch.from_arrays(columns, names=b.schema.names)

    return _cut_rows(docs, state, docs.schema, row)
