"""Hidden Markov language model over words.

Latent states emit word classes, a class emits a word: the most frequent words are
classes of their own, the others share a fixed number of hashed classes, within which a
word has its corpus frequency. So the model the driver holds is of fixed size, while
word counts, which grow with the corpus, stay in tables. Baum-Welch runs over all
training documents: tasks sum expected counts, trees of tasks add them up. It starts from
states that the co-occurrence of frequent words in all training documents suggests. The
scaled forward recursion then gives the exact likelihood of every whole document,
end token included.

Documents are packed into blocks. A block's dictionary, not its tokens, meets the word
counts, so a frequent word is one row per block and no key is hot.

Defined results. Null text: as empty, the end token alone. Null doc_id: not held out.
Repeated rows and equal texts score alike. No training document: all counts 0, the
score equals that of one state over hashed classes. Empty table: no rows. Ties in word frequency fall
to the word. A document is never cut; a task holds one block, at least a document.
"""

from __future__ import annotations

import math
import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowsift.llm.common import small_batches, written

STATES = 6
#: Words with classes of their own, and hashed classes for the rest. Class 0 is the end.
OWN, HASHED = 4095, 4096
CLASSES = 1 + OWN + HASHED
ITERATIONS = 3
#: Frequent words whose co-occurrence the first states come from.
SEEDS = 256
#: Tokens in a block, and in a batch of the recursions, about.
BLOCK_TOKENS = 2_000_000
BATCH_TOKENS = 200_000
#: Pseudo-counts: of the corpus distribution in each state, of each transition.
PRIOR, STEP_PRIOR = 50.0, 1.0
FOLDS, HELD_FOLD = 5, 1


def is_held_out(doc_id: int | None) -> bool:
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % FOLDS == HELD_FOLD


def tokens(text: str | None) -> list[bytes]:
    """The lower-cased words of a text, without the end token."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


# -- the model on the driver -----------------------------------------------------


@dataclass(frozen=True)
class Hmm:
    start: np.ndarray  # states
    step: np.ndarray  # states x states
    emit: np.ndarray  # classes x states


def _normal(x: np.ndarray, axis: int) -> np.ndarray:
    return x / x.sum(axis=axis, keepdims=True)


def first_model(together: np.ndarray, share: np.ndarray, states: int = STATES) -> Hmm:
    """States from groups of frequent words that share documents.

    ``together``: sums over documents of products of the words' counts. ``share``: corpus
    share of every class. Each group's words are likelier in its state.
    """
    n = len(together)
    emit = np.repeat(share[:, None], states, axis=1)
    if n >= states > 1 and together.sum() > 0:
        # rounded, so that the order in which tasks are added up decides nothing
        together = np.round(together, 6)
        d = np.sqrt(np.maximum(np.diag(together), 1e-12))
        points = together / d[:, None] / d[None, :]
        points /= np.maximum(np.linalg.norm(points, axis=1, keepdims=True), 1e-12)
        # the most frequent word, then always the word farthest from the chosen ones
        chosen = [0]
        while len(chosen) < states:
            near = (points @ points[chosen].T).max(axis=1)
            chosen.append(int(np.argmin(np.round(near, 9))))
        centres = points[chosen]
        for _ in range(20):
            group = np.argmax(np.round(points @ centres.T, 9), axis=1)
            centres = np.array([points[group == k].mean(axis=0) if (group == k).any() else centres[k] for k in range(states)])
            centres /= np.maximum(np.linalg.norm(centres, axis=1, keepdims=True), 1e-12)
        for k in range(states):
            emit[1 : n + 1, k] *= np.where(group == k, 1.0, 0.05)
    else:
        # nothing to tell states apart by: tilt them a little
        for k in range(states):
            emit[k::states, k] *= 1.5
    step = np.full((states, states), 0.1 / max(states - 1, 1)) + np.eye(states) * (0.9 if states > 1 else 1.0)
    return Hmm(np.full(states, 1 / states), _normal(step, 1), _normal(emit, 0))


# -- recursions ------------------------------------------------------------------


def time_major(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the sequences, longest first, and how many are left at each time."""
    order = np.argsort(-lengths, kind="stable")
    active = np.searchsorted(-lengths[order], -np.arange(lengths.max(initial=0)), side="left") if len(lengths) else np.zeros(0, int)
    return order, active


def forward(model: Hmm, seen: np.ndarray, active: np.ndarray, keep: bool):
    """Log likelihood of each sequence; with ``keep`` also the scaled alphas and scales.

    ``seen`` holds the classes time by time, the longest sequence first; ``active`` the number
    of sequences at each time.
    """
    n = int(active[0]) if len(active) else 0
    total = np.zeros(n)
    alphas = np.empty((len(seen), len(model.start))) if keep else None
    scales = np.empty(len(seen))
    likely, step = model.emit, model.step
    at, now = 0, None
    for t, m in enumerate(active.tolist()):
        e = likely[seen[at : at + m]]
        now = e * model.start if t == 0 else (now[:m] @ step) * e
        s = now.sum(axis=1)
        now /= s[:, None]
        scales[at : at + m] = s
        if keep:
            alphas[at : at + m] = now
        at += m
    logs = np.log(scales)
    at = 0
    for m in active.tolist():
        total[:m] += logs[at : at + m]
        at += m
    return total, alphas, scales


def expected_counts(model: Hmm, seen: np.ndarray, active: np.ndarray):
    """Baum-Welch sums of a batch: starts, transitions, emissions (classes x states), log likelihood."""
    total, alphas, scales = forward(model, seen, active, True)
    ends = np.cumsum(active)
    posterior, weights = np.empty_like(alphas), np.empty_like(alphas)
    likely, turned = model.emit, model.step.T
    back = np.ones((0, len(model.start)))
    for t in range(len(active) - 1, -1, -1):
        lo, hi = int(ends[t] - active[t]), int(ends[t])
        if hi - lo > len(back):
            # sequences that end here
            back = np.concatenate([back, np.ones((hi - lo - len(back), back.shape[1]))])
        posterior[lo:hi] = alphas[lo:hi] * back
        weights[lo:hi] = w = likely[seen[lo:hi]] * back / scales[lo:hi, None]
        back = w @ turned
    emits = np.stack([np.bincount(seen, posterior[:, k], minlength=len(likely)) for k in range(posterior.shape[1])], axis=1)
    # a row of the next time belongs to the row of the same rank at this one
    after = np.arange(int(active[0]), len(seen))
    before = after - np.repeat(active[:-1], active[1:])
    steps = alphas[before].T @ weights[after] * model.step
    return posterior[: int(active[0])].sum(axis=0), steps, emits, float(total.sum())


def batches(classes: np.ndarray, lengths: np.ndarray, size: int = BATCH_TOKENS) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(positions, classes time by time, active) of sequences of similar length, about ``size`` tokens together."""
    starts = np.cumsum(lengths) - lengths
    order, _ = time_major(lengths)
    cut = np.cumsum(lengths[order]) // size
    for part in np.split(order, np.flatnonzero(np.diff(cut)) + 1):
        if not len(part):
            continue
        own = lengths[part]
        _, active = time_major(own)
        rank = np.concatenate([np.arange(m) for m in active.tolist()])
        at = np.repeat(np.arange(len(active)), active)
        yield part, classes[starts[part][rank] + at].astype(np.int64), active


# -- tables ----------------------------------------------------------------------


def blocks(docs: DataFrame, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Documents packed into blocks, each with a dictionary of its words.

    block; doc_ids, held and lengths (words, end included); ids, the dictionary numbers of
    all words (int32, end as -1); words, the dictionary joined by blanks; counts, each
    word's tokens in training documents (int64); these three are compressed.
    """
    small_batches(docs.sparkSession)
    parted = docs.select("doc_id", "text").withColumn("part", F.spark_partition_id())

    def run(source):
        words, serial = None, 0
        for b in source:
            for doc_id, text, part in zip(b.column("doc_id").to_pylist(), b.column("text"), b.column("part").to_pylist(), strict=True):
                if words is None:
                    words = defaultdict()
                    words.default_factory = words.__len__
                    docs_, held, lengths, ids = [], [], [], []
                    filled = 0
                own = np.fromiter(map(words.__getitem__, tokens(text.as_py())), np.int32)
                docs_.append(doc_id)
                held.append(is_held_out(doc_id))
                lengths.append(len(own) + 1)
                ids += [own, _END]
                filled += len(own) + 1
                if filled >= block_tokens:
                    yield _block((part << 32) + serial, docs_, held, lengths, ids, words)
                    words, serial = None, serial + 1
        if words is not None:
            yield _block((part << 32) + serial, docs_, held, lengths, ids, words)

    out = "block bigint, doc_ids array<bigint>, held array<boolean>, lengths array<int>, ids binary, words binary, counts binary"
    return parted.mapInArrow(run, out)


_END = np.array([-1], np.int32)


def _packed(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(data)


def _plain(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """The rows one by one; a row is a block, so a batch of them is never unpacked at once."""
    for b in batches:
        for i in range(b.num_rows):
            yield b.slice(i, 1).to_pylist()[0]


def _block(block: int, docs_: list, held: list, lengths: list, ids: list, words: dict) -> pa.RecordBatch:
    flat = np.concatenate(ids)
    trained = np.repeat(~np.array(held), lengths) & (flat >= 0)
    counts = np.bincount(flat[trained], minlength=len(words)).astype(np.int64)
    columns = [
        pa.array([block], pa.int64()),
        pa.array([docs_], pa.list_(pa.int64())),
        pa.array([held], pa.list_(pa.bool_())),
        pa.array([lengths], pa.list_(pa.int32())),
        pa.array([_packed(flat.tobytes())], pa.binary()),
        pa.array([_packed(b" ".join(words))], pa.binary()),
        pa.array([_packed(counts.tobytes())], pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(columns, names=["block", "doc_ids", "held", "lengths", "ids", "words", "counts"])


def _dictionaries(packed: DataFrame) -> DataFrame:
    """(block, local, word, n): a row for each word of each block."""

    def run(source):
        for r in _rows(source):
            all_words = [w for w in _plain(r["words"]).split(b" ") if w]
            n = np.frombuffer(_plain(r["counts"]), np.int64)
            for lo in range(0, len(all_words), 50_000):
                some = all_words[lo : lo + 50_000]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(some), r["block"])),
                        pa.array(np.arange(lo, lo + len(some), dtype=np.int32)),
                        pa.array(some, pa.binary()),
                        pa.array(n[lo : lo + len(some)]),
                    ],
                    names=["block", "local", "word", "n"],
                )

    return packed.select("block", "words", "counts").mapInArrow(run, "block bigint, local int, word binary, n bigint")


@dataclass(frozen=True)
class Lexicon:
    """Word counts, as a table, and the sums over it that scores need."""

    table: DataFrame  # word, c, cls
    total: int  # training tokens, ends included
    distinct: int  # distinct ones
    ends: int
    class_total: np.ndarray
    class_distinct: np.ndarray

    def base_bound(self) -> float:
        return math.log10(self.total + 0.5 * (self.distinct + 1))

    def class_bound(self) -> np.ndarray:
        """log10 of the divisor inside each class; a class of one word has none."""
        out = np.log10(self.class_total + 0.5 * (self.class_distinct + 1))
        return out

    def share(self) -> np.ndarray:
        """Corpus share of every class, never 0."""
        x = self.class_total + 0.5 * np.maximum(self.class_distinct, 1)
        return x / x.sum()


def lexicon(dictionary: DataFrame, ends: int) -> Lexicon:
    """Count all words and deal them to classes."""
    counted = written(dictionary.groupBy("word").agg(F.sum("n").alias("c")), "words")
    top = counted.filter("c > 0").orderBy(F.desc("c"), "word").limit(OWN).collect()
    own = dictionary.sparkSession.createDataFrame([(bytes(r["word"]), i + 1) for i, r in enumerate(top)], "word binary, own int")
    hashed = (F.pmod(F.xxhash64("word"), F.lit(HASHED)) + (1 + OWN)).cast("int")
    table = written(
        counted.join(F.broadcast(own), "word", "left").select("word", "c", F.coalesce("own", hashed).alias("cls")), "lexicon"
    )
    sums = table.groupBy("cls").agg(F.sum("c").alias("n"), F.count_if(F.col("c") > 0).alias("v")).collect()
    n, v = np.zeros(CLASSES), np.zeros(CLASSES)
    for r in sums:
        n[r["cls"]], v[r["cls"]] = r["n"], r["v"]
    n[0], v[0] = ends, int(ends > 0)
    return Lexicon(table, int(n.sum()), int(v.sum()), ends, n, v)


def encoded(packed: DataFrame, dictionary: DataFrame, lex: Lexicon) -> DataFrame:
    """Blocks with class numbers for words, and the sums over words that no state changes.

    block, doc_ids, held, lengths, classes (uint16, compressed), known (training words and ends),
    log_count (sum of log10(c + 0.5)) and within (sum of log10 of the words' shares of
    their classes), all as arrays by document.
    """
    spelled = dictionary.select("block", "local", "word").join(lex.table, "word").select("block", "local", "c", "cls")
    bound, ends = lex.class_bound(), lex.ends

    def run(block: pa.Table, entries: pa.Table) -> pa.Table:
        size = entries.num_rows
        local = entries.column("local").to_numpy()
        c, cls = np.empty(size + 1, np.int64), np.empty(size + 1, np.int64)
        c[local], cls[local] = entries.column("c").to_numpy(), entries.column("cls").to_numpy()
        c[size], cls[size] = ends, 0
        log_count = np.log10(c + 0.5)
        within = np.where(cls > OWN, log_count - bound[cls], 0.0)
        out = []
        for r in _rows(block.to_batches()):
            ids = np.frombuffer(_plain(r["ids"]), np.int32)
            starts = np.cumsum([0, *r["lengths"][:-1]])
            out.append(
                {
                    "block": r["block"],
                    "doc_ids": r["doc_ids"],
                    "held": r["held"],
                    "lengths": r["lengths"],
                    "classes": _packed(cls[ids].astype(np.uint16).tobytes()),
                    "known": np.add.reduceat((c[ids] > 0).astype(np.int64), starts).tolist(),
                    "log_count": np.add.reduceat(log_count[ids], starts).tolist(),
                    "within": np.add.reduceat(within[ids], starts).tolist(),
                }
            )
        return pa.Table.from_pylist(out, schema=_ENCODED)

    kept = packed.select("block", "doc_ids", "held", "lengths", "ids")
    fields = "block bigint, doc_ids array<bigint>, held array<boolean>, lengths array<int>, classes binary, known array<bigint>, log_count array<double>, within array<double>"
    return kept.groupBy("block").cogroup(spelled.groupBy("block")).applyInArrow(run, fields)


_ENCODED = pa.schema(
    [
        ("block", pa.int64()),
        ("doc_ids", pa.list_(pa.int64())),
        ("held", pa.list_(pa.bool_())),
        ("lengths", pa.list_(pa.int32())),
        ("classes", pa.binary()),
        ("known", pa.list_(pa.int64())),
        ("log_count", pa.list_(pa.float64())),
        ("within", pa.list_(pa.float64())),
    ]
)


def _added(parts: DataFrame, width: int) -> dict[str, np.ndarray]:
    """Sum the vectors (name, part, v: float64 bytes) of all tasks by name, in two levels."""

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        total = sum((np.frombuffer(v, np.float64) for v in pdf["v"]), np.zeros(len(pdf["v"].iloc[0]) // 8))
        return pd.DataFrame({"name": [pdf["name"].iloc[0]], "part": [0], "v": [total.tobytes()]})

    fields = "name string, part int, v binary"
    salted = parts.withColumn("part", F.pmod("part", F.lit(width)).cast("int")).groupBy("name", "part").applyInPandas(add, fields)
    rows = salted.groupBy("name").applyInPandas(add, fields).collect()
    return {r["name"]: np.frombuffer(r["v"], np.float64).copy() for r in rows}


def _training(r: dict) -> tuple[np.ndarray, np.ndarray]:
    """Classes and lengths of a block's training documents."""
    lengths = np.array(r["lengths"], np.int64)
    learned = ~np.array(r["held"], bool)
    classes = np.frombuffer(_plain(r["classes"]), np.uint16)
    return classes[np.repeat(learned, lengths)], lengths[learned]


def _vectors(found: dict[str, np.ndarray], part: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array(list(found)),
            pa.array([part] * len(found), pa.int32()),
            pa.array([np.ascontiguousarray(v, np.float64).tobytes() for v in found.values()], pa.binary()),
        ],
        names=["name", "part", "v"],
    )


def _per_task(coded: DataFrame, add, width: int) -> dict[str, np.ndarray]:
    """Sum ``add(classes, lengths)`` over the training documents of all blocks."""
    rows = coded.select("held", "lengths", "classes").withColumn("part", F.spark_partition_id())

    def run(source):
        total, part = {}, 0
        for r in _rows(source):
            part = r["part"]
            classes, lengths = _training(r)
            if len(lengths):
                for name, v in add(classes, lengths).items():
                    total[name] = total[name] + v if name in total else v
        if total:
            yield _vectors(total, part)

    return _added(rows.mapInArrow(run, "name string, part int, v binary"), width)


def _together(classes: np.ndarray, lengths: np.ndarray) -> dict[str, np.ndarray]:
    """Co-occurrence of the most frequent words within documents, each document weighing one."""
    doc = np.repeat(np.arange(len(lengths)), lengths)
    mine = (classes >= 1) & (classes <= SEEDS)
    out = np.zeros((SEEDS, SEEDS))
    table = np.bincount(doc[mine] * SEEDS + classes[mine].astype(np.int64) - 1, minlength=len(lengths) * SEEDS).reshape(-1, SEEDS).astype(np.float64)
    table /= np.maximum(table.sum(axis=1, keepdims=True), 1)
    out += table.T @ table
    return {"together": out.ravel()}


def train(coded: DataFrame, lex: Lexicon, states: int = STATES, iterations: int = ITERATIONS) -> Hmm:
    """Baum-Welch over all training documents of the encoded blocks."""
    width = max(1, math.isqrt(coded.rdd.getNumPartitions()))
    share = lex.share()
    pairs = _per_task(coded, _together, width).get("together")
    model = first_model(np.zeros((0, 0)) if pairs is None else pairs.reshape(SEEDS, SEEDS), share, states)
    for _ in range(iterations):
        sent = coded.sparkSession.sparkContext.broadcast(model)  # states x classes numbers

        def add(classes, lengths, sent=sent):
            out: dict[str, np.ndarray] = {}
            for _, seen, active in batches(classes, lengths):
                starts, steps, emits, log = expected_counts(sent.value, seen, active)
                found = {"start": starts, "step": steps.ravel(), "log": np.array([log])}
                found |= {f"emit{k}": emits[:, k] for k in range(emits.shape[1])}
                for name, v in found.items():
                    out[name] = out[name] + v if name in out else v
            return out

        sums = _per_task(coded, add, width)
        if not sums:
            break
        emit = np.stack([sums[f"emit{k}"] for k in range(states)], axis=1) + PRIOR * share[:, None]
        model = Hmm(
            _normal(sums["start"] + STEP_PRIOR, 0), _normal(sums["step"].reshape(states, states) + STEP_PRIOR, 1), _normal(emit, 0)
        )
    return model


def scored(coded: DataFrame, lex: Lexicon, model: Hmm) -> DataFrame:
    """One row per document: its counts, base score and exact log10 likelihood."""
    sent = coded.sparkSession.sparkContext.broadcast(model)
    base, total = lex.base_bound() if lex.total else math.log10(0.5), lex.total

    def run(source):
        for r in _rows(source):
            lengths = np.array(r["lengths"], np.int64)
            classes = np.frombuffer(_plain(r["classes"]), np.uint16)
            logs = np.empty(len(lengths))
            for part, seen, active in batches(classes, lengths):
                logs[part], _, _ = forward(sent.value, seen, active, False)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(r["doc_ids"], pa.int64()),
                    pa.array(r["held"], pa.bool_()),
                    pa.array(lengths),
                    pa.array(r["known"], pa.int64()),
                    pa.array([total] * len(lengths), pa.int64()),
                    pa.array(np.array(r["log_count"]) - lengths * base),
                    pa.array(np.array(r["within"]) + logs / math.log(10)),
                ],
                names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
            )

    return coded.mapInArrow(
        run, "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    )


def language_scores(docs: DataFrame, states: int = STATES, iterations: int = ITERATIONS, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Train on the documents that aren't held out and score all of them."""
    packed = written(blocks(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), block_tokens), "blocks")
    ends = packed.select(F.sum(F.aggregate(F.transform("held", lambda h: (~h).cast("long")), F.lit(0).cast("long"), lambda a, x: a + x)).alias("n")).first()["n"] or 0
    dictionary = _dictionaries(packed)
    lex = lexicon(dictionary, int(ends))
    coded = written(encoded(packed, dictionary, lex), "encoded")
    return scored(coded, lex, train(coded, lex, states, iterations))
