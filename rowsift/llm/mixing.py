"""Mixing sources to target weights by min-cost flow.

A document may belong to several sources. Documents are first aggregated by membership
pattern, the sorted set of their sources, so the flow network has one node per
pattern, whatever the number of documents. Capacity runs from the start through a
pattern to its sources and on to their quotas. A pattern's words may be used again
and again, each time at a higher cost (convex), so the cheapest flow repeats text
only where nothing fresh is left. What each pattern gives is then drawn from its
documents in a seeded order of hashes: everyone gets the whole repetitions, and those
below a hash cut get one more. The cut is found by histograms of hash digits, so a
pattern may hold any share of the rows. A document that is too much for what is still
wanted is skipped, and the draw goes on behind it with those that fit.

Defined results. Null text: size 0, taken 0. Null sources: a source of its own, named
None, last in order. An empty set of sources: never taken. Rows that repeat a doc_id
are decided alike, as a whole. No words at all: all targets 0. Empty table: no
rows. Other columns never matter.
"""

from __future__ import annotations

import heapq
from collections import deque
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowsift.functions.ranking import range_rank
from rowsift.functions.runtime import SMALL_ROWS
from rowsift.functions.skew import skew_join
from rowsift.llm.common import text_or_empty, words, written

#: Most patterns that may come to the driver for the flow; beyond it the plan is refused. With quotas
#: by weight, patterns of one source that no other pattern shares need no flow and are not counted.
MAX_PATTERNS = 20_000
#: Weights dealt to the sources in order, again and again.
WEIGHTS = (3.0, 1.0, 2.0)
#: All targets together, as a multiple of all sizes.
SHARE = 1.5
#: A source may be taken so many times at most.
MOST = 2
#: Cost of the first, second, ... use of the same words.
COSTS = (0, 1)
SEED = 20240611
DIGIT_BITS = 12
#: The draw ends when a pattern lacks no more than this part of what it is to give, or no document fits.
TOLERANCE = 0.002
#: Beyond all hashes; beyond all sizes.
END, _ANY = 1 << 60, (1 << 63) - 1


def targets(sizes: Sequence[int], weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST) -> list[float]:
    """Target of each source: its weight's part of ``share`` times all sizes, at most ``most`` times its size.

    What a source cannot take is shared again by weight among the others, until none
    is above its bound.
    """
    total = share * sum(sizes)
    weight = [weights[i % len(weights)] for i in range(len(sizes))]
    out, open_ = [0.0] * len(sizes), set(range(len(sizes)))
    while open_ and total > 0:
        scale = total / sum(weight[i] for i in sorted(open_))
        full = [i for i in sorted(open_) if scale * weight[i] >= most * sizes[i]]
        if not full:
            for i in open_:
                out[i] = scale * weight[i]
            break
        for i in full:
            out[i] = float(most * sizes[i])
            total -= out[i]
            open_.remove(i)
    return out


@dataclass
class Edge:
    to: int
    room: int
    back: int


class Flow:
    """Largest flow of least cost, where only edges out of the start have a cost.

    Paths then never pass a costly edge backwards, so opening the edges in the order
    of their costs and augmenting along shortest paths in between is optimal.
    """

    def __init__(self, nodes: int):
        self.out: list[list[Edge]] = [[] for _ in range(nodes)]

    def add(self, a: int, b: int, room: int) -> Edge:
        there, back = Edge(b, room, len(self.out[b])), Edge(a, 0, len(self.out[a]))
        self.out[a].append(there)
        self.out[b].append(back)
        return there

    def _levels(self, s: int, t: int) -> list[int] | None:
        level, queue = [-1] * len(self.out), deque([s])
        level[s] = 0
        while queue:
            a = queue.popleft()
            for e in self.out[a]:
                if e.room > 0 and level[e.to] < 0:
                    level[e.to] = level[a] + 1
                    queue.append(e.to)
        return level if level[t] >= 0 else None

    def augment(self, s: int, t: int) -> int:
        """Push what fits, by blocking flows over the levels."""
        pushed = 0
        while (level := self._levels(s, t)) is not None:
            at = [0] * len(self.out)
            while True:
                path, a = [], s
                while a != t:
                    while at[a] < len(self.out[a]):
                        e = self.out[a][at[a]]
                        if e.room > 0 and level[e.to] == level[a] + 1:
                            break
                        at[a] += 1
                    if at[a] < len(self.out[a]):
                        path.append((a, at[a]))
                        a = self.out[a][at[a]].to
                    elif path:
                        a = path.pop()[0]
                        at[a] += 1
                    else:
                        break
                if a != t:
                    break
                amount = min(self.out[x][i].room for x, i in path)
                for x, i in path:
                    e = self.out[x][i]
                    e.room -= amount
                    self.out[e.to][e.back].room += amount
                pushed += amount
        return pushed


def route(
    patterns: Sequence[tuple[frozenset, int]], quotas: dict, costs: Sequence[int] = COSTS
) -> dict[tuple[int, object], int]:
    """Words that each pattern gives to each source: (index of pattern, source) to amount.

    ``patterns``: sources and size. ``quotas``: words wanted by source. ``costs``:
    cost of each repetition, not falling; their number bounds the repetitions.
    """
    if list(costs) != sorted(costs):
        raise ValueError("repetition costs must not fall")
    names = list(quotas)
    number = {s: 2 + len(patterns) + i for i, s in enumerate(names)}
    flow = Flow(2 + len(patterns) + len(names))
    ties: dict[tuple[int, object], Edge] = {}
    for i, (sources, size) in enumerate(patterns):
        for s in names:
            if s in sources:
                ties[i, s] = flow.add(2 + i, number[s], size * len(costs))
    for s in names:
        flow.add(number[s], 1, quotas[s])
    waiting = [(c, k) for k, c in enumerate(costs)]
    heapq.heapify(waiting)
    while waiting:
        heapq.heappop(waiting)
        for i, (_, size) in enumerate(patterns):
            flow.add(0, 2 + i, size)
        flow.augment(0, 1)
    return {k: amount for k, e in ties.items() if (amount := flow.out[e.to][e.back].room) > 0}


def _hash(seed: int, key: Column) -> Column:
    """A position in [0, 2**60), a function of seed and key."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), key), 4)


def _digit(level: int) -> Column:
    return F.shiftright(F.col("h"), 60 - DIGIT_BITS * (level + 1)).bitwiseAND(F.lit((1 << DIGIT_BITS) - 1)).cast("int")


@dataclass(frozen=True)
class Near:
    """Joins with tables of a row per pattern: broadcast, or by shuffle where ``counts`` (pattern, _n) is given."""

    counts: DataFrame | None = None

    def rows(self, rows: DataFrame, table: DataFrame) -> DataFrame:
        if self.counts is None:
            return rows.join(F.broadcast(table), "pattern")
        return skew_join(rows, table, ["pattern"], counts=self.counts)

    def added(self, table: DataFrame, more: DataFrame) -> DataFrame:
        return table.join(F.broadcast(more) if self.counts is None else more, "pattern", "left")


def _cut_round(rows: DataFrame, wanted: DataFrame, near: Near, levels: int = 2) -> DataFrame:
    """(pattern, cut, lack): how far the rows that fit reach into the need, in hash order.

    ``rows``: pattern, h, size, weight. ``wanted``: pattern, need, lo, most; rows count from
    the hash lo on that weigh no more than most. The row at the cut is the first that is
    too much. Where all rows fit, the cut is END; where there are none, the pattern is left out.
    Each level sums the sizes by the next digit of the hash and goes into the one bucket
    where the need is met; what is then left, about a 2**24th of a pattern, is summed row
    by row.
    """
    from pyspark.sql import Window

    state = wanted.select("pattern", "need", "lo", "most", F.lit(0).cast("long").alias("prefix"))  # all hashes are below 2**60
    full = None
    fits = (F.col("h") >= F.col("lo")) & (F.col("weight") <= F.col("most"))
    order = Window.partitionBy("pattern").orderBy("d")
    for level in range(levels):
        shift = 60 - DIGIT_BITS * level
        inside = near.rows(rows, state).filter(fits & (F.shiftright("h", shift) == F.col("prefix")))
        sums = inside.groupBy("pattern", "need", "lo", "most", "prefix", _digit(level).alias("d")).agg(F.sum("size").alias("s"))
        before = F.coalesce(F.sum("s").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        met = sums.withColumn("b", before).withColumn("last", F.lead("d").over(order).isNull())
        met = met.filter("(b <= need and need < b + s) or (last and b + s <= need)").withColumn("all", F.col("b") + F.col("s") <= F.col("need"))
        prefix = (F.shiftleft("prefix", DIGIT_BITS) + F.col("d")).alias("prefix")
        lack = F.col("need") - F.col("b")
        found = written(met.select("pattern", F.when(F.col("all"), lack - F.col("s")).otherwise(lack).alias("need"), "lo", "most", prefix, "all"), "mix-cut")
        if full is None:
            full = found.filter("all").select("pattern", F.lit(END).cast("long").alias("cut"), F.col("need").alias("lack"))
        state = found.filter("not all").drop("all")
    shift = 60 - DIGIT_BITS * levels
    left = near.rows(rows, state).filter(fits & (F.shiftright("h", shift) == F.col("prefix")))
    tied = left.groupBy("pattern", "need", "h").agg(F.sum("size").alias("s"))
    upto = F.sum("s").over(Window.partitionBy("pattern").orderBy("h"))
    over = tied.withColumn("u", upto).filter("u > need")
    ends = over.groupBy("pattern").agg(F.min("h").alias("cut"), F.min_by(F.col("need") - F.col("u") + F.col("s"), "h").alias("lack"))
    return ends.unionByName(full)


def _taken(weight: Column) -> Column:
    """Whether a row is in one of the stretches, or picked, from its hash h and its pattern's rule."""
    drawn = F.exists("stretches", lambda x: (F.col("h") >= x["lo"]) & (F.col("h") < x["cut"]) & (x["most"].isNull() | (weight <= x["most"])))
    return drawn | F.array_contains("picks", F.col("h"))


def _draw(rows: DataFrame, wanted: DataFrame, near: Near = Near()) -> DataFrame:
    """(pattern, stretches, picks): the rows of these hashes hold about the words wanted.

    ``rows``: pattern, h, size, weight. ``wanted``: pattern, need. Rows are taken in hash
    order up to the first that is too much; that one is skipped and the draw goes on
    behind it with those that still fit, until the lack is within the tolerance or no
    row fits. So what is lacking then is less than any row left out; one more is
    picked if that comes closer. A stretch (lo, cut, most) holds the rows from lo to below
    cut that weigh no more than most, null for any.
    """
    state = wanted.select(
        "pattern",
        "need",
        F.col("need").alias("lack"),
        F.lit(0).cast("long").alias("lo"),
        F.array().cast("array<struct<lo:bigint,cut:bigint,most:bigint>>").alias("stretches"),
    )
    lacking = F.col("lack") > F.col("need") * TOLERANCE
    first = True
    while first or not state.filter(lacking & (F.col("lo") < END)).isEmpty():
        # a row per pattern
        most = F.lit(_ANY).cast("long") if first else F.col("lack")
        open_ = state.filter(lacking & (F.col("lo") < END)).select("pattern", F.col("lack").alias("need"), "lo", most.alias("most"))
        found = _cut_round(rows, open_, near).select("pattern", "cut", F.col("lack").alias("left"))
        bound = F.lit(None).cast("long") if first else F.col("lack")
        more = F.array(F.struct("lo", "cut", bound.alias("most")))
        state = written(
            near.added(state, found).select(
                "pattern",
                "need",
                F.coalesce("left", "lack").alias("lack"),
                # no row was found: none fits any more
                F.when(F.col("cut").isNotNull(), F.col("cut")).otherwise(F.lit(END)).cast("long").alias("lo"),
                F.when(F.col("cut").isNotNull(), F.concat("stretches", more)).otherwise(F.col("stretches")).alias("stretches"),
            ),
            "mix-state",
        )
        first = False
    open_ = state.filter(lacking).withColumn("picks", F.array().cast("array<bigint>"))
    miss = F.abs(F.col("weight") - F.col("lack"))
    fill = (
        near.rows(rows, open_)
        .filter(~_taken(F.col("weight")) & (miss < F.col("lack")))
        .groupBy("pattern")
        .agg(F.min(F.struct(miss.alias("m"), F.col("h").alias("h"))).alias("x"))
    )
    picks = F.when(F.col("x").isNull(), F.array().cast("array<bigint>")).otherwise(F.array("x.h"))
    return written(near.added(state, fill).select("pattern", "stretches", picks.alias("picks")), "mix-ends")


def _repeats(rows: DataFrame) -> DataFrame:
    """(pattern, h, together): the words of rows that repeat a doc_id, together, as they are taken or left as a whole."""
    units = rows.groupBy("pattern", "h").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("together"))
    return written(units.filter("n > 1").drop("n"), "mix-repeats")


def mix(
    docs: DataFrame,
    sources: Column,
    quotas,
    costs: Sequence[int] = COSTS,
    seed: int = SEED,
    max_patterns: int = MAX_PATTERNS,
) -> tuple[DataFrame, DataFrame, list[dict]]:
    """Decide how often each document is taken.

    ``docs``: doc_id, size (long). ``sources``: array of the row's sources, as strings; a
    null source inside is one of its own. ``quotas``: :class:`ByWeight`, or a function from
    the list of (sources, size) patterns to a dict of words by source. Returns (doc_id, pattern,
    size, copies), the rule (pattern, whole, stretches, picks) that gave the copies and, for
    each pattern of the flow, its sources, size and flows. With a function all patterns are in
    the flow, else those whose sources overlap with others.
    """
    return _decided(docs, sources, quotas, costs, seed, max_patterns)[:3]


def _decided(docs: DataFrame, sources: Column, quotas, costs: Sequence[int], seed: int, max_patterns: int):
    """What :func:`mix` returns, the words of repeated rows, targets by source and how to join with patterns."""
    # a null source and one of any name can't be mixed up: names get a letter in front
    marked = F.array_sort(F.array_distinct(F.transform(sources, lambda s: F.coalesce(F.concat(F.lit("="), s), F.lit("~")))))
    rows = written(
        docs.select("doc_id", F.col("size").cast("long").alias("size"), marked.alias("members")).select(
            "*", F.xxhash64("members").alias("pattern"), _hash(seed, F.col("doc_id").cast("string")).alias("h")
        ),
        "mix-rows",
    )
    repeats = _repeats(rows)
    patterns = written(
        rows.groupBy("pattern", "members").agg(F.coalesce(F.sum("size"), F.lit(0)).alias("size"), F.count(F.lit(1)).alias("_n")), "mix-patterns"
    )
    near = Near(patterns.select("pattern", "_n") if patterns.count() > SMALL_ROWS else None)
    rows = rows.join(repeats, ["pattern", "h"], "left").withColumn("weight", F.coalesce("together", "size"))
    apart, flowing, aims = None, patterns, None
    if isinstance(quotas, ByWeight):
        one = F.size("members") == 1
        by_source = patterns.select(F.explode("members").alias("member"), "size").groupBy("member").agg(F.sum("size").alias("source_size"))
        aims = written(quotas.table(by_source), "mix-targets")
        shared = written(patterns.filter(F.size("members") > 1).select(F.explode("members").alias("member")).distinct(), "mix-shared")
        singles = patterns.filter(one).withColumn("member", F.col("members")[0])
        alone = singles.join(shared, "member", "left_anti").join(aims.select("member", "quota"), "member")
        apart = alone.select("pattern", "size", F.least("quota", F.col("size") * len(costs)).alias("given"))
        apart = apart.unionByName(patterns.filter(F.coalesce(F.size("members") < 1, F.lit(True))).select("pattern", "size", F.lit(0).cast("long").alias("given")))
        flowing = patterns.filter(F.size("members") > 1).unionByName(singles.join(shared, "member", "left_semi").select(*patterns.columns))
    found = flowing.select("pattern", "members", "size").orderBy("members").limit(max_patterns + 1).collect()
    if len(found) > max_patterns:
        raise ValueError(f"more than {max_patterns} membership patterns of overlapping sources; raise max_patterns or merge sources")
    plan = [{"pattern": r["pattern"], "sources": frozenset(map(_named, r["members"] or ())), "size": r["size"]} for r in found]
    if aims is None:
        quota = quotas([(p["sources"], p["size"]) for p in plan])
    else:
        quota = {_named(r["member"]): r["quota"] for r in aims.join(shared, "member", "left_semi").orderBy("member").collect()} if plan else {}
    flows = route([(p["sources"], p["size"]) for p in plan], quota, costs)
    for p in plan:
        p["flows"] = {}
    for (k, s), a in flows.items():
        plan[k]["flows"][s] = a
    for p in plan:
        p["given"] = sum(p["flows"].values())
    given = docs.sparkSession.createDataFrame([(p["pattern"], p["size"], p["given"]) for p in plan], "pattern long, size long, given long")
    if apart is not None:
        given = given.unionByName(apart)
    some = F.col("size") > 0
    base = written(
        given.select(
            "pattern",
            F.when(some, F.expr("given div size")).otherwise(F.lit(0)).cast("long").alias("whole"),
            F.when(some, F.expr("given % size")).otherwise(F.lit(0)).cast("long").alias("need"),
        ),
        "mix-given",
    )
    drawn = _draw(rows.select("pattern", "h", "size", "weight"), base.filter("need > 0").select("pattern", "need"), near)
    empty = [F.coalesce(c, F.array().cast(drawn.schema[c].dataType)).alias(c) for c in ("stretches", "picks")]
    rule = written(near.added(base, drawn).select("pattern", "whole", *empty), "mix-rule")
    chosen = near.rows(rows, rule)
    return chosen.select("doc_id", "pattern", "size", _copies(F.col("weight")).alias("copies")), rule, plan, repeats, (patterns, aims), near


def _named(member: str) -> str | None:
    return None if member == "~" else member[1:]


def _copies(weight: Column) -> Column:
    """How often a row is taken, from its hash h, its weight and its pattern's rule."""
    return F.col("whole") + _taken(weight).cast("long")


@dataclass(frozen=True)
class ByWeight:
    """Quotas of all sources after :func:`targets`; a source's size is what its patterns hold together."""

    weights: Sequence[float] = WEIGHTS
    share: float = SHARE
    most: float = MOST

    def table(self, sizes: DataFrame) -> DataFrame:
        """(member, source_size, target, quota) from (member, source_size), for any number of sources.

        Members are in the order of their weights: by code point, the null one last. The
        scale only rises from round to round, so the full sources are those it has reached.
        """
        ranked = range_rank(written(sizes, "mix-sizes"), [F.col("member")], (), "at")
        weight = F.element_at(F.array(*[F.lit(float(w)) for w in self.weights]), (F.pmod(F.col("at") - 1, F.lit(len(self.weights))) + 1).cast("int"))
        bound = F.col("source_size") * F.lit(float(self.most))
        rows = written(ranked.select("member", "source_size", weight.alias("weight"), bound.alias("bound")), "mix-weights")
        total = self.share * (rows.agg(F.sum("source_size").alias("n")).first()["n"] or 0)
        scale, full = 0.0, -1
        while total > 0:
            reached = F.lit(scale) * F.col("weight") >= F.col("bound") if full >= 0 else F.lit(False)
            r = rows.agg(F.count_if(reached).alias("n"), F.sum(F.when(reached, F.col("bound"))).alias("b"), F.sum(F.when(~reached, F.col("weight"))).alias("w")).first()
            if r["n"] == full or not r["w"]:
                break
            full, scale = r["n"], max(0.0, total - (r["b"] or 0.0)) / r["w"]
        target = F.least(F.lit(scale) * F.col("weight"), F.col("bound")) if total > 0 else F.lit(0.0)
        return rows.select("member", "source_size", target.alias("target")).withColumn("quota", F.bround("target").cast("long"))


def quotas_by_weight(weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST) -> ByWeight:
    return ByWeight(weights, share, most)


def sized(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size): the number of words of every document."""
    return docs.select("doc_id", "source", F.size(words(text_or_empty("text"))).cast("long").alias("size"))


def mix_by_source(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """(doc_id, size, source_size, target, taken) of every row of documents."""
    chosen, _, _, _, (patterns, aims), near = _decided(sized(docs), F.array("source"), quotas_by_weight(), COSTS, seed, MAX_PATTERNS)
    table = patterns.select("pattern", F.col("members")[0].alias("member")).join(aims, "member").select("pattern", "source_size", "target")
    return near.rows(chosen, table).select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def take(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """The mix itself: rows of ``docs`` as often as they are taken, columns unchanged.

    The rule decides a row where it stands; no text is shuffled, unless there are more than
    SMALL_ROWS sources or very many rows repeat a doc_id. Words are counted again behind the first document skipped only.
    """
    _, rule, _, repeats, _, near = _decided(sized(docs), F.array("source"), quotas_by_weight(), COSTS, seed, MAX_PATTERNS)
    marked = F.array(F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("~")))
    rows = near.rows(
        docs.select(F.struct(*docs.columns).alias("row"), F.xxhash64(marked).alias("pattern"), _hash(seed, F.col("doc_id").cast("string")).alias("h")), rule
    )
    weight = F.coalesce(F.col("together"), F.size(words(text_or_empty(F.col("row.text")))).cast("long"))
    kept = rows.join(repeats, ["pattern", "h"], "left").withColumn("copies", _copies(weight).cast("int")).filter("copies > 0")
    return kept.select("row", F.explode(F.array_repeat(F.lit(0), F.col("copies")))).select("row.*")
