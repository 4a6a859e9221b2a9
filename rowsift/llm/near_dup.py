"""Near duplicates by HyperMinHash.

Each document's set of five-word shingles becomes 256 registers: the first bits of a
shingle's hash choose the register, and of the smallest rest in it the number of
leading zeros (6 bits) and the next 10 bits are stored. Documents with equal sets share
one representative. Bands of four registers (empty ones borrow from others first, so
that short texts band as selectively as long ones) bring candidates together; the
Jaccard estimate from the registers, corrected for chance collisions and lowered by
five standard deviations, filters them; whole shingle sets, as strings, decide.

No group is compared all against all: every member of a band bucket first meets the
bucket's smallest document, and the links found give components. Buckets whose members
are then still apart are joined into families. In a family, documents outside its
largest component meet all others of the family, in blocks: a task compares registers,
confirms what they leave possible on whole sets, and returns no more links than it
joins components. A pair of similarity 0.75 shares no band with
probability (1 - 0.75**4)**32, about one in 200,000; nothing is capped.

Defined results. No words, null or empty text: n_shingles 0, linked with nothing, own
component. Fewer than five words: the whole sequence is the one shingle. Rows that
repeat a doc_id are one document, linked by any of its rows. Null doc_id: linked with
nothing, component null, kept. Ties: the smallest doc_id names a component. Empty table:
no rows. Other columns pass through :func:`keep_one`.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowsift.llm.common import fitted, free_name, small_batches, written
from rowsift.llm.graphs import components

SHINGLE = 5
PERCENT = 75
REGISTERS = 256
ROWS, BANDS = 4, 32
MANTISSA = 10
EMPTY = 0xFFFF
#: Standard deviations by which the estimate may fall short of the threshold.
SLACK = 5.0
#: Shingles, about, of the texts that meet one hub, or another block, in one task.
BLOCK_SHINGLES = 200_000
#: Rows in one task, about: of narrow tables, of tables with registers, of pairs to be confirmed.
NARROW_ROWS, WIDE_ROWS, PAIR_ROWS = 500_000, 20_000, 2_000
#: Ids up to so many are broadcast to pick their texts; more are joined by shuffle.
BROADCAST_IDS = 2_000_000
#: Bytes of text hashed at a time.
PIECE = 1 << 20

_U = np.uint64
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_rng = np.random.Generator(np.random.PCG64(20240607))
_BYTE = _rng.integers(0, 2**64, 256, dtype=np.uint64)
_BASE = int(_rng.integers(0, 2**63)) * 2 + 1
_PLACE = _rng.integers(0, 2**63, SHINGLE, dtype=np.uint64) * _U(2) + _U(1)
_POWERS: dict[str, np.ndarray] = {}


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    if len(_POWERS.get("up", ())) < n:
        size = 1 << max(n - 1, 1).bit_length()
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            out, step = np.ones(1, np.uint64), base
            while len(out) < size:
                out = np.concatenate([out, out * _U(step)])
                step = step * step % (1 << 64)
            _POWERS[name] = out
    return _POWERS["up"], _POWERS["down"]


def shingle_sets(texts: list[bytes]) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of each text's shingles."""
    buf = np.frombuffer(b"\n" + b"\n".join(texts) + b"\n", np.uint8)
    up, down = _powers(len(buf))
    word = ~_SPACE[buf]
    edge = np.flatnonzero(word[1:] != word[:-1]) + 1
    starts, ends = edge[0::2], edge[1::2]
    total = np.cumsum(_BYTE[_LOWER[buf]] * up[: len(buf)])
    hashes = _mix((total[ends - 1] - total[starts - 1]) * down[starts] + (ends - starts).astype(np.uint64))
    first = np.cumsum([1, *(len(t) + 1 for t in texts)])
    bounds = np.searchsorted(starts, first)
    n = len(hashes) - SHINGLE + 1
    windows = np.zeros(max(n, 0), np.uint64)
    for k in range(SHINGLE if n > 0 else 0):
        windows += hashes[k : k + n] * _PLACE[k]
    windows = _mix(windows)
    out = []
    for lo, hi in zip(bounds[:-1], bounds[1:], strict=True):
        if hi - lo >= SHINGLE:
            out.append(np.unique(windows[lo : hi - SHINGLE + 1]))
        elif hi > lo:
            few = (hashes[lo:hi] * _PLACE[: hi - lo]).sum(dtype=np.uint64) + _U(hi - lo)
            out.append(_mix(np.array([few])))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def digest(hashes: np.ndarray) -> bytes:
    """128 bits and the size of a set of hashes."""
    other = _mix(hashes ^ _U(0x9E3779B97F4A7C15))
    return np.array([other.sum(dtype=np.uint64), np.bitwise_xor.reduce(_mix(other)), len(hashes)], np.uint64).tobytes()


def registers(hashes: np.ndarray) -> np.ndarray:
    """HyperMinHash registers of a sorted set: leading zeros and mantissa of each bucket's minimum."""
    out = np.full(REGISTERS, EMPTY, np.uint16)
    bucket = (hashes >> _U(56)).astype(np.int64)
    at = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]) if len(hashes) else np.zeros(0, np.int64)
    rest = (hashes[at] & _U((1 << 56) - 1)).astype(np.float64) + 1.0
    mantissa, exponent = np.frexp(rest)  # rest = mantissa * 2**exponent, mantissa in [0.5, 1)
    zeros = np.clip(57 - exponent, 0, 62).astype(np.uint16)
    bits = np.minimum(((mantissa - 0.5) * (2 << MANTISSA)).astype(np.uint16), (1 << MANTISSA) - 1)
    out[bucket[at]] = (zeros << np.uint16(MANTISSA)) | bits
    return out


#: Chance that two unequal minima give one register value, for the bits above.
COLLISION = 2.0 ** -(MANTISSA + 1)


def estimate(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Collision-corrected Jaccard estimates of rows of registers, and how many registers they rest on."""
    used = (x != EMPTY) | (y != EMPTY)
    n = used.sum(axis=-1)
    share = ((x == y) & used).sum(axis=-1) / np.maximum(n, 1)
    return (share - COLLISION) / (1 - COLLISION), n


def plausible(x: np.ndarray, y: np.ndarray, percent: int) -> np.ndarray:
    """Whether the estimate leaves room for the threshold."""
    found, n = estimate(x, y)
    p = percent / 100
    return found >= p - SLACK * math.sqrt(p * (1 - p)) / np.sqrt(np.maximum(n, 1))


def _steps() -> np.ndarray:
    """Where an empty register looks, attempt by attempt; each row is a permutation of the registers."""
    g = np.random.Generator(np.random.PCG64(77))
    return np.array([g.permutation(REGISTERS) for _ in range(REGISTERS)])


def band_keys(regs: np.ndarray) -> list[np.ndarray]:
    """Keys of each row's bands, after empty registers have borrowed; distinct within a row."""
    full, steps = regs.copy(), _steps()
    rows, cols = np.nonzero(full == EMPTY)
    for k in range(REGISTERS):
        got = regs[rows, steps[cols, k]]
        ok = got != EMPTY
        full[rows[ok], cols[ok]] = got[ok]
        rows, cols = rows[~ok], cols[~ok]
        if not len(rows):
            break
    parts = full[:, : BANDS * ROWS].reshape(-1, BANDS, ROWS).astype(np.uint64)
    keys = np.broadcast_to(np.arange(BANDS, dtype=np.uint64) + _U(1), parts.shape[:2]).copy()
    for k in range(ROWS):
        keys = _mix(keys * _U(0x9E3779B97F4A7C15) + parts[:, :, k])
    return [np.unique(r).view(np.int64) for r in keys]


def word_shingles(text: str) -> set[bytes]:
    """The whole shingle set of a text, as strings."""
    w = text.encode("utf-8", "surrogatepass").lower().split()
    if len(w) < SHINGLE:
        return {b" ".join(w)} if w else set()
    return {b" ".join(w[i : i + SHINGLE]) for i in range(len(w) - SHINGLE + 1)}


def linked(x: set, y: set, percent: int) -> bool:
    if not x or not y or min(len(x), len(y)) * 100 < percent * max(len(x), len(y)):
        return False
    common = len(x & y)
    return 100 * common >= percent * (len(x) + len(y) - common)


def _pieces(texts: list[bytes]):
    """Consecutive texts of about PIECE bytes together."""
    held, size = [], 0
    for t in texts:
        held.append(t)
        size += len(t)
        if size >= PIECE:
            yield held
            held, size = [], 0
    if held:
        yield held


def signatures(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, digest, regs) of every row; digest and regs null without words."""
    small_batches(docs.sparkSession)

    def run(batches):
        for b in batches:
            texts = [(t.as_py() or "").encode("utf-8", "surrogatepass") for t in b.column("text")]
            sets = [s for p in _pieces(texts) for s in shingle_sets(p)]
            yield pa.RecordBatch.from_arrays(
                [
                    b.column("doc_id"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([digest(s) if len(s) else None for s in sets], pa.binary()),
                    pa.array([registers(s).tobytes() if len(s) else None for s in sets], pa.binary()),
                ],
                names=["doc_id", "n_shingles", "digest", "regs"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id bigint, n_shingles bigint, digest binary, regs binary"
    )


def _bands(reps: DataFrame) -> DataFrame:
    """(key, rep): the bands of each representative."""

    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            regs = np.frombuffer(b"".join(b.column("regs").to_pylist()), np.uint16).reshape(-1, REGISTERS)
            keys = band_keys(regs)
            reps = np.repeat(b.column("rep").to_numpy(zero_copy_only=False), [len(k) for k in keys])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys)), pa.array(reps)], names=["key", "rep"])

    return reps.select("rep", "regs").mapInArrow(run, "key bigint, rep bigint")


def _likely(pairs: DataFrame, reps: DataFrame, percent: int, rows: int, n_reps: int) -> DataFrame:
    """The pairs (a, b), ``rows`` at most, whose registers and sizes leave the threshold possible."""
    side = reps.select("rep", "n", "regs")
    both = pairs.join(side.toDF("b", "nb", "rb").hint("merge"), "b").join(side.toDF("a", "na", "ra").hint("merge"), "a")
    both = fitted(both, max(rows, n_reps // 4), WIDE_ROWS).filter(F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent)

    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            x, y = (np.frombuffer(b"".join(b.column(c).to_pylist()), np.uint16).reshape(-1, REGISTERS) for c in ("ra", "rb"))
            yield b.select(["a", "b", "nb"]).filter(pa.array(plausible(x, y, percent)))

    return both.select("a", "b", "nb", "ra", "rb").mapInArrow(run, "a bigint, b bigint, nb bigint")


def _confirm(pairs: DataFrame, texts: DataFrame, percent: int, n_texts: int) -> DataFrame:
    """The pairs (a, b) that their whole shingle sets link; nb is the size of b's set.

    A hub travels once for every block of its partners, so the texts of a large
    group are not repeated for each pair.
    """
    pairs = written(pairs.groupBy("a", "b").agg(F.max("nb").alias("nb")), "pairs")
    rows = pairs.count()
    sizes = pairs.groupBy("a").agg(F.ceil(F.sum("nb") / F.lit(BLOCK_SHINGLES)).cast("int").alias("blocks"))
    dealt = pairs.join(sizes, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.col("blocks")).cast("int").alias("block"))
    dealt = written(fitted(dealt, rows, NARROW_ROWS), "dealt")
    hubs = dealt.select("a", "block").distinct().join(texts.hint("merge"), F.col("a") == F.col("doc_id")).select("a", "block", F.lit(None).cast("long").alias("b"), "text")
    members = dealt.join(texts.hint("merge"), F.col("b") == F.col("doc_id")).select("a", "block", "b", "text")

    def decide(rows: pa.Table) -> pa.Table:
        partner = rows.column("b").to_pylist()
        text = rows.column("text")
        own = [word_shingles(text[i].as_py()) for i, b in enumerate(partner) if b is None]
        found = {b for i, b in enumerate(partner) if b is not None for s in [word_shingles(text[i].as_py())] if any(linked(x, s, percent) for x in own)}
        a = rows.column("a")[0].as_py()
        return pa.table({"a": pa.array([a] * len(found), pa.int64()), "b": pa.array(sorted(found), pa.int64())})

    # few pairs may still meet many texts
    held = max(rows, n_texts * PAIR_ROWS // WIDE_ROWS)
    both = fitted(hubs, held, PAIR_ROWS).unionByName(fitted(members, held, PAIR_ROWS))
    return fitted(both.groupBy("a", "block").applyInArrow(decide, "a bigint, b bigint"), rows, PAIR_ROWS)


def _texts(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(doc_id, text) of the documents with these ids (column rep), written: the only other pass over the texts."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter("doc_id is not null and text is not null")
    few = ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    ids = F.broadcast(ids) if few else ids.hint("merge")
    return written(rows.join(ids, F.col("doc_id") == F.col("rep"), "left_semi"), "candidate-texts")


def _families(shared: DataFrame, reps: DataFrame, parts: DataFrame, size: int, n_reps: int) -> DataFrame:
    """Of the ``size`` rows of ``shared``: (family, rep, n, part, major): documents of buckets whose members are in different components.

    Families join such buckets that share a document; ``major`` says whether the
    document is in the family's largest component.
    """
    rows = shared.join(parts.select(F.col("node").alias("rep"), F.col("component").alias("part")).hint("merge"), "rep", "left")
    rows = rows.withColumn("part", F.coalesce("part", "rep"))
    # of two members the first round has compared the only pair
    mixed = rows.groupBy("key").agg(F.count(F.lit(1)).alias("m"), F.min("part").alias("p"), F.max("part").alias("q")).filter("p <> q and m > 2")
    star = fitted(rows.join(mixed.select("key").hint("merge"), "key").select("rep", "a", "part"), size, NARROW_ROWS).distinct()
    star = written(fitted(star, size, NARROW_ROWS), "mixed")
    rows = star.count()
    family = components(star.filter("rep <> a").select("a", F.col("rep").alias("b")))
    own = star.select("rep", "part").distinct().join(family.select(F.col("node").alias("rep"), F.col("component").alias("family")).hint("merge"), "rep")
    own = written(fitted(own.join(reps.select("rep", "n").hint("merge"), "rep"), max(rows, n_reps * WIDE_ROWS // NARROW_ROWS), WIDE_ROWS), "families")
    largest = own.groupBy("family", "part").agg(F.count(F.lit(1)).alias("k")).groupBy("family").agg(F.max(F.struct("k", "part")).alias("x"))
    named = own.join(largest.hint("merge"), "family").select("family", "rep", "n", "part", (F.col("part") == F.col("x.part")).alias("major"))
    return fitted(named, rows, WIDE_ROWS)


def _sets(texts: DataFrame, family: DataFrame, size: int, n_texts: int) -> DataFrame:
    """The ``size`` family rows with registers and hashed shingle sets."""
    small_batches(texts.sparkSession)
    rows = family.join(texts.hint("merge"), F.col("rep") == F.col("doc_id")).select("family", "rep", "part", "major", "text")
    names = ["family", "rep", "part", "major", "n", "regs", "hashes"]

    def run(batches):
        for b in batches:
            sets = [s for p in _pieces([(t.as_py() or "").encode("utf-8", "surrogatepass") for t in b.column("text")]) for s in shingle_sets(p)]
            yield pa.RecordBatch.from_arrays(
                [
                    *(b.column(c) for c in names[:4]),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([registers(s).tobytes() for s in sets], pa.binary()),
                    pa.array([s.tobytes() for s in sets], pa.binary()),
                ],
                names=names,
            )

    return fitted(rows, max(size, n_texts * PAIR_ROWS // WIDE_ROWS), PAIR_ROWS).mapInArrow(run, "family bigint, rep bigint, part bigint, major boolean, n bigint, regs binary, hashes binary")


def links_across(rows: pa.Table, i: int, j: int, percent: int) -> list[tuple[int, int, int]]:
    """(a, b, size of the larger set) of links between blocks ``i`` and ``j``, no more than join different parts.

    Shingles are numbered once, so that a document meets all its partners by looking up theirs among its own.
    """
    own, part, rep, n = (rows.column(c).to_numpy().copy() for c in ("own", "part", "rep", "n"))
    regs = np.frombuffer(b"".join(rows.column("regs").to_pylist()), np.uint16).reshape(-1, REGISTERS)
    codes = np.unique(np.frombuffer(b"".join(rows.column("hashes").to_pylist()), np.uint64), return_inverse=True)[1]
    mine = np.zeros(len(codes), np.int32)
    codes = np.split(codes, np.cumsum(n)[:-1])
    left, right = np.flatnonzero((own == i) & (n > 0)), np.flatnonzero((own == j) & (n > 0))
    found = []
    for x in right:
        ys = left if i != j else left[left < x]
        ys = ys[(part[ys] != part[x]) & (np.minimum(n[ys], n[x]) * 100 >= percent * np.maximum(n[ys], n[x]))]
        ys = ys[plausible(regs[x][None, :], regs[ys], percent)] if len(ys) else ys
        if not len(ys):
            continue
        mine[codes[x]] = 1
        common = np.add.reduceat(mine[np.concatenate([codes[y] for y in ys])], np.cumsum(n[ys]) - n[ys])
        mine[codes[x]] = 0
        for y in ys[100 * common >= percent * (n[x] + n[ys] - common)].tolist():
            if part[y] != part[x]:
                found.append((int(min(rep[x], rep[y])), int(max(rep[x], rep[y])), int(max(n[x], n[y]))))
                part[part == part[y]] = part[x]
    return found


def _across(family: DataFrame, texts: DataFrame, percent: int, n_texts: int) -> DataFrame:
    """(a, b, nb): links between different components of a family.

    Documents are dealt to blocks by hash, those of the largest component apart from
    the rest, and every block of the rest meets every block.
    """
    width, size = F.lit(BLOCK_SHINGLES), family.count()
    blocks = family.groupBy("family").agg(
        F.ceil(F.sum(F.when(F.col("major"), F.col("n")).otherwise(0)) / width).cast("int").alias("big"),
        F.ceil(F.sum(F.when(F.col("major"), 0).otherwise(F.col("n"))) / width).cast("int").alias("small"),
    )
    own = F.when(F.col("major"), F.pmod(F.xxhash64("rep"), F.greatest("big", F.lit(1)))).otherwise(
        F.col("big") + F.pmod(F.xxhash64("rep"), F.greatest("small", F.lit(1)))
    )
    dealt = _sets(texts, family, size, n_texts).join(blocks.hint("merge"), "family").withColumn("own", own.cast("int"))
    met = F.when(F.col("major"), F.sequence(F.col("big"), F.col("big") + F.col("small") - 1)).otherwise(
        F.sequence(F.lit(0), F.col("big") + F.col("small") - 1)
    )
    dealt = dealt.withColumn("met", F.explode(met))
    dealt = dealt.select("family", F.least("own", "met").alias("i"), F.greatest("own", "met").alias("j"), "own", "rep", "part", "n", "regs", "hashes")

    def compare(rows: pa.Table) -> pa.Table:
        i, j = rows.column("i")[0].as_py(), rows.column("j")[0].as_py()
        found = links_across(rows, i, j, percent)
        return pa.table({k: pa.array([f[c] for f in found], pa.int64()) for c, k in enumerate(("a", "b", "nb"))})

    return fitted(dealt.groupBy("family", "i", "j").applyInArrow(compare, "a bigint, b bigint, nb bigint"), size, PAIR_ROWS)


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of ``docs`` (doc_id, text)."""
    signed = written(signatures(docs), "signatures")
    known = signed.filter("doc_id is not null and digest is not null")
    reps = written(
        known.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.any_value("n_shingles").alias("n"), F.any_value("regs").alias("regs")),
        "representatives",
    )
    n_docs, n_reps = signed.count(), reps.count()
    bands = _bands(reps)
    buckets = bands.groupBy("key").agg(F.min("rep").alias("a"), F.count(F.lit(1)).alias("m")).filter("m > 1")
    shared = bands.join(buckets.hint("merge"), "key").select("key", "rep", "a")
    shared = written(fitted(shared, n_reps * BANDS, NARROW_ROWS), "buckets")
    size = shared.count()
    first = fitted(shared.filter("rep <> a").select("a", F.col("rep").alias("b")).distinct(), size, NARROW_ROWS)
    likely = written(_likely(first, reps, percent, size, n_reps), "likely")
    texts = _texts(docs, shared.select("rep").distinct())
    n_texts = texts.count()
    links = _confirm(likely, texts, percent, n_texts)
    # a doc_id with several texts ties their representatives together
    several = known.groupBy("doc_id").agg(F.min("digest").alias("d"), F.max("digest").alias("e")).filter("d <> e").select("doc_id")
    tied = known.join(several, "doc_id").join(reps.select("digest", "rep"), "digest").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    links = written(links.unionByName(fitted(tied, n_docs, NARROW_ROWS)), "links")
    parts = written(components(links), "components")
    family = written(_families(shared, reps, parts, size, n_reps), "family")
    more = written(_confirm(_across(family, texts, percent, n_texts), texts, percent, n_texts), "across")
    if not more.isEmpty():
        parts = written(components(links.unionByName(more)), "components")
    named = reps.join(parts.hint("merge"), reps["rep"] == parts["node"], "left").select("digest", F.coalesce("component", "rep").alias("component"))
    named = fitted(named, n_reps, NARROW_ROWS)
    own = signed.filter("doc_id is null or digest is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    joined = known.select("doc_id", "n_shingles", "digest").join(named.hint("merge"), "digest").select("doc_id", "n_shingles", F.col("component").alias("component_id"))
    return joined.unionByName(own).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def keep_one(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One document of each group of near duplicates, the smallest doc_id; columns unchanged.

    Of rows that repeat a kept doc_id all stay.
    """
    lost = free_name(docs.columns, "lost_doc")
    gone = near_duplicates(docs.select("doc_id", "text"), percent).filter(~F.col("kept")).select(F.col("doc_id").alias(lost)).distinct()
    gone = written(gone, "near-dup-gone")
    few = gone.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    return docs.join(F.broadcast(gone) if few else gone, docs["doc_id"] == F.col(lost), "left_anti")
