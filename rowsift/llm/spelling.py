"""Spelling variants: words one edit apart, found by composing acceptors with a one-edit transducer.

The vocabulary is counted over all texts. Its near pairs are the strings accepted by
A . E . A, where A is the minimal acceptor of the vocabulary and E the transducer that
passes letters on and replaces or inserts exactly one. The composition falls apart by what
its initial state has read: of two near words, the shorter of m letters, either the first
m/2 letters agree or the last m - m/2 do. So every word goes to the part of its first and of
its last letters, once as the shorter and once as the longer word, and each part composes
the acceptors of what its words don't share. A part whose words have more than
``PART_CHARS`` letters to compose, or more than ``MOST_OPEN`` letters each, is split in the
same way again: the open stretch is halved, and one half agrees. At one open letter a part
is bounded by the alphabet. No part is cut and no pair is lost.

Inside a part the acceptors are minimal (equal right languages are one state), so what
remains after the edit, the strings that two states both accept, is found once per pair of
states and shared by all paths that lead there.

Defined results. Null text: no words. A null doc_id counts as the text ``null`` in the hash
that picks misspelt runs. Very long texts are read as a stream of runs; very long words are
split until little is open. Ties between near words of equal count go to the smaller in code
points. Repeated rows count as often as they occur. Empty table: no rows. Other columns are
ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowsift.functions.runtime import checked_broadcast
from rowsift.functions.skew import skew_join
from rowsift.llm.common import small_batches, written

MIN_CHARS = 5
MIN_COUNT = 3
#: One run in so many loses a letter before it is counted.
MISSPELT = 97
#: Most letters that one part composes, unless a single letter is open.
PART_CHARS = 200_000
#: Most letters of a word that are open in a part with several words.
MOST_OPEN = 200

_RUN = re.compile("[A-Za-zÀ-ÿ]+")
#: Texts beyond this are read run by run instead of as one list.
_LONG = 1 << 20
_PART = ["m", "a", "b", "shared"]


# -- the vocabulary ----------------------------------------------------------------------


def _runs(text: str) -> Counter:
    """Runs of letters with their numbers, A-Z lowered."""
    lowered = text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")  # bytes: A-Z only
    if len(lowered) < _LONG:
        return Counter(_RUN.findall(lowered))
    return Counter(m.group() for m in _RUN.finditer(lowered))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: Counter = Counter()
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            start = zlib.crc32(b"null:" if doc_id is None else b"%d:" % doc_id)
            for run, n in _runs(text.as_py() or "").items():
                h = zlib.crc32(run.encode(), start)
                if h % MISSPELT == 0:
                    at = h % len(run)
                    run = run[:at] + run[at + 1 :]
                if len(run) >= MIN_CHARS:
                    out[run] += n
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(out), pa.string()), pa.array(list(out.values()), pa.int64())], ["word", "n"]
        )


def vocabulary(docs: DataFrame) -> DataFrame:
    """(word, n): words of ``MIN_CHARS`` letters and ``MIN_COUNT`` occurrences at least."""
    small_batches(docs.sparkSession)
    counted = docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(_counted, "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= MIN_COUNT)


# -- the acceptors and their composition -------------------------------------------------


class Acceptor:
    """Minimal acceptor of a finite language, built from its sorted strings.

    ``arcs[s]`` maps a letter to a state, ``final[s]`` says whether ``s`` accepts.
    """

    def __init__(self, strings: list[str]):
        self.arcs: list[dict[str, int]] = []
        self.final: list[bool] = []
        known: dict[tuple, int] = {}

        def settle(final: bool, arcs: dict[str, int]) -> int:
            mark = (final, tuple(arcs.items()))
            if mark not in known:
                known[mark] = len(self.arcs)
                self.arcs.append(arcs)
                self.final.append(final)
            return known[mark]

        # open states along the last string: [final, arcs], and the letter that leads to the next
        path: list[list] = [[False, {}]]
        last = ""
        for s in strings:
            shared = 0
            while shared < min(len(s), len(last)) and s[shared] == last[shared]:
                shared += 1
            while len(path) > shared + 1:
                state = settle(*path.pop())
                path[-1][1][last[len(path) - 1]] = state
            path.extend([False, {}] for _ in s[shared:])
            path[-1][0] = True
            last = s
        while len(path) > 1:
            state = settle(*path.pop())
            path[-1][1][last[len(path) - 1]] = state
        self.start = settle(*path[0])


class Composition:
    """Pairs that ``left`` . one edit . ``right`` accepts; ``left`` and ``right`` may be one acceptor."""

    def __init__(self, left: Acceptor, right: Acceptor):
        self.left, self.right = left, right
        self._rest: dict[tuple[int, int], list[str]] = {}

    def rest(self, p: int, q: int) -> list[str]:
        """Strings that both states accept, found once for each pair of states."""
        if (p, q) not in self._rest:
            out = [""] if self.left.final[p] and self.right.final[q] else []
            there = self.right.arcs[q]
            for c, to in self.left.arcs[p].items():
                if c in there:
                    out.extend(c + s for s in self.rest(to, there[c]))
            self._rest[p, q] = out
        return self._rest[p, q]

    def _before(self) -> Iterator[tuple[str, int, int]]:
        """States before the edit: what was read, and the state of either side."""
        stack = [("", self.left.start, self.right.start)]
        while stack:
            read, p, q = stack.pop()
            yield read, p, q
            there = self.right.arcs[q]
            stack.extend((read + c, to, there[c]) for c, to in self.left.arcs[p].items() if c in there)

    def replaced(self) -> Iterator[tuple[str, str]]:
        """Pairs that differ in one letter, the smaller first."""
        for read, p, q in self._before():
            there = self.right.arcs[q]
            for c, to in self.left.arcs[p].items():
                for d, other in there.items():
                    if c < d:
                        for s in self.rest(to, other):
                            yield read + c + s, read + d + s

    def inserted(self) -> Iterator[tuple[str, str]]:
        """Pairs whose right string has one letter more; one in a run of equal letters comes several times."""
        for read, p, q in self._before():
            for d, other in self.right.arcs[q].items():
                for s in self.rest(p, other):
                    yield read + s, read + d + s


def near_in_part(words: list[str], m: int, a: int, b: int) -> set[tuple[str, str]]:
    """Near pairs of words of m and m + 1 letters that share their first a and last b, not both of m + 1."""
    head, tail = words[0][:a], words[0][len(words[0]) - b :]
    open_of = lambda length: Acceptor(sorted(w[a : length - b] for w in words if len(w) == length))
    short, long = open_of(m), open_of(m + 1)
    found = {(head + u + tail, head + v + tail) for u, v in Composition(short, short).replaced()}
    return found | {(head + u + tail, head + v + tail) for u, v in Composition(short, long).inserted()}


# -- parts on Spark ----------------------------------------------------------------------


def _dealt(words: DataFrame) -> DataFrame:
    """(word, m, a, b, shared): every word in its parts, first by halves."""
    size = F.length("word")
    m = F.explode(F.array_distinct(F.array(size, F.greatest(size - 1, F.lit(1)))))
    return _halved(words.select("word", m.alias("m")).select("word", "m", F.lit(0).alias("a"), F.lit(0).alias("b")))


def _halved(rows: DataFrame) -> DataFrame:
    """Each row twice: the first half of the open letters agrees as well, or the second."""
    open_letters = F.col("m") - F.col("a") - F.col("b")
    first = F.floor(open_letters / 2).cast("int")
    ends = F.explode(
        F.array(
            F.struct((F.col("a") + first).alias("a"), F.col("b").alias("b")),
            F.struct(F.col("a").alias("a"), (F.col("b") + open_letters - first).alias("b")),
        )
    )
    split = rows.select("word", "m", ends.alias("e")).select("word", "m", "e.a", "e.b")
    tail = F.when(F.col("b") > 0, F.right("word", F.col("b"))).otherwise("")
    # lengths a and b are part of the key, so the two ends can't run into each other
    return split.withColumn("shared", F.concat(F.left("word", F.col("a")), tail))


def _parts(words: DataFrame) -> DataFrame:
    """Rows of :func:`_dealt`, with parts that are too large split further."""
    open_letters = F.col("m") - F.col("a") - F.col("b")
    done, rows = None, written(_dealt(words), "spelling-parts")
    while True:
        sizes = rows.groupBy(*_PART).agg(F.count(F.lit(1)).alias("words"), F.sum(F.length("word") - F.col("a") - F.col("b")).alias("chars"))
        too_large = (F.col("chars") > PART_CHARS) | (open_letters > MOST_OPEN)
        large = written(sizes.filter((F.col("words") > 1) & too_large & (open_letters > 1)).select(*_PART), "spelling-large")
        if large.isEmpty():
            return rows if done is None else done.unionByName(rows)
        hint = checked_broadcast(large)
        kept = rows.join(hint, _PART, "left_anti")
        done = kept if done is None else done.unionByName(kept)
        rows = written(_halved(rows.join(hint, _PART)), "spelling-parts")


def _compose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Near pairs of each part; rows come ordered by part, so one part is held at a time."""

    def flush(part: tuple, words: list[str]) -> set[tuple[str, str]]:
        m, a, b = part[:3]
        return near_in_part(words, m, a, b) if len(words) > 1 and any(len(w) == m for w in words) else set()

    part, words, out = None, [], []
    for batch in batches:
        names = batch.schema.names
        columns = [batch.column(names.index(c)).to_pylist() for c in (*_PART, "word")]
        for *key, word in zip(*columns):
            if tuple(key) != part:
                if words:
                    out.extend(flush(part, words))
                part, words = tuple(key), []
            words.append(word)
        if out:
            yield _pairs_batch(out)
            out = []
    if words:
        out.extend(flush(part, words))
    yield _pairs_batch(out)


def _pairs_batch(pairs: list[tuple[str, str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([p[0] for p in pairs], pa.string()), pa.array([p[1] for p in pairs], pa.string())], ["u", "v"]
    )


def near_pairs(words: DataFrame) -> DataFrame:
    """(word, near): both directions of every pair that differs by one letter inserted, deleted or replaced."""
    dealt = _parts(words.select("word")).repartition(*_PART).sortWithinPartitions(*_PART)
    once = dealt.mapInArrow(_compose, "u string, v string").distinct()
    return once.select(F.explode(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))).alias("p")).select(
        F.col("p.u").alias("word"), F.col("p.v").alias("near")
    )


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root): follow (word, form) to the end by doubling; counts double with each step, so chains are short."""
    hops = written(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        ahead = hops.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = written(
            skew_join(hops, ahead, ["root"], "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("went")),
            "spelling-roots",
        )
        hops = moved.select("word", "root")
        if moved.filter("went").isEmpty():
            return hops


def variants(docs: DataFrame) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of the vocabulary."""
    words = written(vocabulary(docs), "spelling-words")
    counts = words.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    best = (
        near_pairs(words)
        .join(counts, "near")
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    )
    grown = -F.col("best.less") >= 2 * F.col("n")
    table = written(
        words.join(best, "word", "left").select(
            "word",
            F.when(grown, F.col("best.near")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
            F.when(grown, -F.col("best.less")).alias("form_n"),
        ),
        "spelling-forms",
    )
    roots = _roots(table.filter("form IS NOT NULL"))
    return table.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
