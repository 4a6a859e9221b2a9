"""Random forests of any depth: the top of a tree from histograms, the rest inside tasks.

A node with more rows than a task takes is split by a pass over the table that sums a histogram of
each feature drawn for it; one pass serves all such nodes of all trees of a wave. As soon as a
node fits a task, its rows are sent to the group (tree, node), and the task grows everything below it
on exact values (a table that fits a task goes once to each of a few tasks, which grow whole trees), until leaves are pure, cannot be split or are ``max_depth`` splits deep. So depth costs no passes, and only the
top of the trees, about rows / TASK_ROWS nodes per tree, is known to the driver; what lies below stays a table.

Draws are functions of (seed, tree, row key) and (seed, tree, node), so reruns agree. A split sends
values up to its threshold to the left; nulls and NaN count as larger than any number.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowsift.functions.arrays import argmax
from rowsift.functions.runtime import checked_broadcast, materialize, spread

#: Most rows, and most bytes of their features, of a node that is finished inside one task.
TASK_ROWS = 50_000
TASK_BYTES = 128 << 20
#: Trees grown at once: a wave sends its share of the table once per tree.
WAVE = 16
#: Most nodes of a forest that goes to every task for scoring (about 40 bytes each); above, rows go to the subtrees.
SENT_NODES = 2_000_000
#: Bytes of histograms that a task holds; more open nodes are dealt to several jobs.
HISTOGRAM_BYTES = 128 << 20
#: Relative rank error of the quantiles that bound the bins is one over this.
_ACCURACY = 10_000
#: Distribution function of the number of times that a bootstrap draws a row.
_POISSON = np.cumsum(np.exp(-1.0) / np.cumprod(np.maximum(np.arange(20.0), 1)))

_SUBTREE = (
    "tree int, node int, feature array<int>, threshold array<double>, child array<int>, "
    "start array<int>, class array<int>, share array<double>"
)
_ROUTED = "tree int, node int, key bigint, y double, w double, x binary"


@dataclass(frozen=True)
class ForestParams:
    """``tried``: share of the features drawn per node, None for the root of their number (classes) or a third.

    ``max_depth``: most splits above a leaf, None for any number.
    """

    trees: int = 100
    tried: float | None = None
    min_leaf: int = 1
    bootstrap: bool = True
    bins: int = 64
    seed: int = 42
    max_depth: int | None = None

    def drawn(self, width: int, numeric: bool) -> int:
        share = self.tried * width if self.tried is not None else width / 3 if numeric else width**0.5
        return min(width, max(1, int(np.ceil(share - 1e-9))))


class Nodes:
    """A growing tree: feature and threshold of split nodes, first of two adjacent children, class shares of leaves."""

    def __init__(self):
        self.feature, self.threshold, self.child, self.depth = [0], [0.0], [-1], [0]
        self.leaf: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def split(self, node: int, feature: int, threshold: float) -> int:
        at = len(self.child)
        self.feature[node], self.threshold[node], self.child[node] = feature, threshold, at
        self.feature += [0, 0]
        self.threshold += [0.0, 0.0]
        self.child += [-1, -1]
        self.depth += [self.depth[node] + 1] * 2
        return at

    def packed(self) -> Packed:
        none = (np.zeros(0, np.int32), np.zeros(0))
        leaves = [self.leaf.get(n, none) for n in range(len(self.child))]
        start = np.cumsum([0, *(len(c) for c, _ in leaves)])
        both = [np.concatenate([x[i] for x in leaves]) for i in (0, 1)]
        return Packed(np.array(self.feature), np.array(self.threshold), np.array(self.child), start, *both)


@dataclass
class Packed:
    feature: np.ndarray
    threshold: np.ndarray
    child: np.ndarray
    start: np.ndarray
    cls: np.ndarray
    share: np.ndarray

    def route(self, x: np.ndarray) -> np.ndarray:
        """The node at which each row of features ends."""
        at = np.zeros(len(x), np.int64)
        moving = np.flatnonzero(self.child[at] >= 0)
        while len(moving):
            here = at[moving]
            right = ~(x[moving, self.feature[here]] <= self.threshold[here])
            at[moving] = self.child[here] + right
            moving = moving[self.child[at[moving]] >= 0]
        return at

    def add(self, out: np.ndarray, rows: np.ndarray, at: np.ndarray) -> None:
        """Adds the shares of leaves ``at`` to ``rows`` of ``out``."""
        size = self.start[at + 1] - self.start[at]
        entry = np.repeat(self.start[at] - np.cumsum(size) + size, size) + np.arange(size.sum())
        np.add.at(out, (np.repeat(rows, size), self.cls[entry]), self.share[entry])

    @staticmethod
    def of(row) -> Packed:
        names = ("feature", "threshold", "child", "start", "class", "share")
        return Packed(*(np.asarray(row[c]) for c in names))


@dataclass
class Forest:
    """``tops[tree]`` and the subtrees below their open ends; shares of a leaf are class shares or one mean."""

    tops: list[Packed]
    open_ends: list[np.ndarray]
    subtrees: DataFrame | None
    prior: np.ndarray
    width: int
    waves: list[DataFrame] = field(default_factory=list)

    def raw(self, df: DataFrame) -> DataFrame:
        """Adds ``raw``: the mean of the leaves that a row meets, the prior where no tree has one."""
        if self.subtrees is None:
            return df.withColumn("raw", F.lit([float(v) for v in self.prior]))
        nodes = self.subtrees.agg(F.sum(F.size("child"))).first()[0] or 0
        return self._sent(df) if nodes <= SENT_NODES else self._met(df)

    def _sent(self, df: DataFrame) -> DataFrame:
        below = {(r["tree"], r["node"]): Packed.of(r) for r in self.subtrees.toLocalIterator()}  # SENT_NODES at most
        model = df.sparkSession.sparkContext.broadcast((self.tops, self.open_ends, below))
        prior = self.prior

        @F.pandas_udf("array<double>")
        def mean(features: pd.Series) -> pd.Series:
            x = _dense(features)
            out, met = np.zeros((len(x), len(prior))), np.zeros(len(x))
            tops, open_ends, below = model.value
            for t, top in enumerate(tops):
                at = top.route(x)
                for node in np.unique(at):
                    rows = np.flatnonzero(at == node)
                    if not open_ends[t][node]:
                        top.add(out, rows, at[rows])
                        met[rows] += 1
                    elif (t, node) in below:
                        sub = below[t, node]
                        sub.add(out, rows, sub.route(x[rows]))
                        met[rows] += 1
            return pd.Series(list(np.where(met[:, None] > 0, out / np.maximum(met, 1)[:, None], prior)))

        return df.withColumn("raw", mean("features"))

    def _met(self, df: DataFrame) -> DataFrame:
        """Every row goes to its subtrees by (tree, node); ends with many rows are dealt to several tasks."""
        tops, ends, prior = self.tops, self.open_ends, self.prior
        rows = materialize(df.withColumn("_at", F.monotonically_increasing_id()))

        def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                x = _dense(batch["features"])
                for t, top in enumerate(tops):
                    at = top.route(x)
                    done = np.zeros((len(x), len(prior)))
                    closed = np.flatnonzero(~ends[t][at])
                    top.add(done, closed, at[closed])
                    shares = [done[i] if not ends[t][n] else None for i, n in enumerate(at)]
                    blobs = [r.tobytes() if ends[t][n] else None for r, n in zip(x, at)]
                    yield pd.DataFrame({"tree": t, "node": at, "_at": batch["_at"], "x": blobs, "raw": shares})

        routed = materialize(
            rows.select("_at", "features").mapInPandas(route, "tree int, node int, _at bigint, x binary, raw array<double>")
        )
        sizes = routed.filter("raw IS NULL").groupBy("tree", "node").count().filter(F.col("count") > TASK_ROWS)
        salts = checked_broadcast(sizes.select("tree", "node", F.ceil(F.col("count") / TASK_ROWS).cast("int").alias("salts")))
        n = F.coalesce("salts", F.lit(1))
        left = routed.filter("raw IS NULL").join(salts, ["tree", "node"], "left")
        left = left.select("tree", "node", "_at", "x", F.pmod(F.xxhash64("_at"), n).cast("int").alias("salt"))
        right = self.subtrees.join(salts, ["tree", "node"], "left").withColumn("salt", F.explode(F.sequence(F.lit(0), n - 1)))
        width = self.width

        def finish(some: pd.DataFrame, sub: pd.DataFrame) -> pd.DataFrame:
            if some.empty or sub.empty:
                return pd.DataFrame({"_at": [], "raw": []})
            tree, x = Packed.of(sub.iloc[0]), _unpacked(some["x"], width)
            out = np.zeros((len(x), len(prior)))
            tree.add(out, np.arange(len(x)), tree.route(x))
            return pd.DataFrame({"_at": some["_at"], "raw": list(out)})

        keys = ("tree", "node", "salt")
        below = left.groupBy(*keys).cogroup(right.drop("salts").groupBy(*keys)).applyInPandas(finish, "_at bigint, raw array<double>")
        all_of = routed.filter("raw IS NOT NULL").select("_at", "raw").unionByName(below)
        means = all_of.groupBy("_at").agg(F.array(*[F.avg(F.col("raw")[k]) for k in range(len(prior))]).alias("raw"))
        raw = F.coalesce("raw", F.lit([float(v) for v in prior]))
        return rows.join(means, "_at", "left").withColumn("raw", raw).drop("_at")

    def classify(self, df: DataFrame) -> DataFrame:
        """Adds ``probs`` and ``predicted``."""
        out = self.raw(df).withColumnRenamed("raw", "probs")
        return out.withColumn("predicted", argmax("probs"))

    def predict(self, df: DataFrame) -> DataFrame:
        """Adds ``predicted``, a number."""
        return self.raw(df).withColumn("predicted", F.col("raw")[0]).drop("raw")


def _dense(features: pd.Series) -> np.ndarray:
    return np.stack(features.to_numpy()).astype(float) if len(features) else np.zeros((0, 1))


def _unpacked(blobs: pd.Series, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(blobs)).reshape(len(blobs), width)


def _times(key: np.ndarray, tree: int, p: ForestParams) -> np.ndarray:
    """How often each row is in the bootstrap of a tree: Poisson(1) of a mixed key."""
    if not p.bootstrap:
        return np.ones(len(key))
    z = key.astype(np.int64).view(np.uint64) + np.uint64((tree + 1) * 0x9E3779B97F4A7C15 % 2**64)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    z ^= z >> np.uint64(31)
    return np.searchsorted(_POISSON, (z >> np.uint64(11)) / 2.0**53, side="right").astype(float)


def _leaf(y: np.ndarray, w: np.ndarray, n_classes: int) -> tuple[np.ndarray, np.ndarray]:
    if not n_classes:
        return np.zeros(1, np.int32), np.array([np.average(y, weights=w)])
    counts = np.bincount(y.astype(int), w)
    seen = np.flatnonzero(counts)
    return seen.astype(np.int32), counts[seen] / counts.sum()


def _summed_leaf(total: np.ndarray, n_classes: int) -> tuple[np.ndarray, np.ndarray]:
    """A leaf from its weight by class, or from its weight and its weighted sum."""
    seen = np.flatnonzero(total) if n_classes else np.zeros(1, int)
    share = total[seen] / total.sum() if n_classes else np.array([total[1] / total[0]])
    return seen.astype(np.int32), share


def _same_class_pairs(y: np.ndarray, w: np.ndarray, total: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of squared class weights left and right of every place, per column of classes in value order."""
    by_class = np.argsort(y, axis=0, kind="stable")
    sorted_y, sorted_w = np.take_along_axis(y, by_class, 0), np.take_along_axis(w, by_class, 0)
    before = np.cumsum(sorted_w, axis=0) - sorted_w - (np.cumsum(total) - total)[sorted_y]
    grown = np.empty_like(w)
    np.put_along_axis(grown, by_class, sorted_w * (2 * before + sorted_w), 0)
    left = np.cumsum(grown, axis=0)
    return left, (total**2).sum() - 2 * np.cumsum(w * total[y], axis=0) + left


def _exact_split(x: np.ndarray, y: np.ndarray, w: np.ndarray, n_classes: int, least: int) -> tuple[int, float] | None:
    """(column, threshold) of the purest split on exact values, None where every column is constant or sides are too small."""
    order = np.argsort(x, axis=0, kind="stable")
    v, ys, ws = np.take_along_axis(x, order, 0), y[order], w[order]
    nl = np.cumsum(ws, axis=0)[:-1]
    nr = w.sum() - nl
    fits = (v[:-1] < v[1:]) & (nl >= least) & (nr >= least)
    if not fits.any():
        return None
    with np.errstate(divide="ignore", invalid="ignore"):
        if n_classes:
            left, right = _same_class_pairs(ys, ws, np.bincount(y, w, n_classes))
            score = left[:-1] / nl + right[:-1] / nr
        else:
            sums = np.cumsum(ws * (ys - np.average(y, weights=w)), axis=0)[:-1]
            score = sums**2 * (nl + nr) / (nl * nr)
    at, column = np.unravel_index(np.where(fits, score, -np.inf).argmax(), score.shape)
    low, high = v[at, column], v[at + 1, column]
    middle = low / 2 + high / 2
    return int(column), float(middle if np.isfinite(middle) and low <= middle < high else low)


def _grown(x: np.ndarray, y: np.ndarray, w: np.ndarray, n_classes: int, p: ForestParams, rng, depth: int = 0) -> Nodes:
    """A whole tree on some rows, ``depth`` splits below the root; node by node, without recursion, so any depth goes."""
    deepest = np.inf if p.max_depth is None else p.max_depth - depth
    tree, x = Nodes(), np.where(np.isnan(x), np.inf, x)
    width, codes, values = x.shape[1], y, None
    if n_classes:
        values, codes = np.unique(y, return_inverse=True)
    drawn = p.drawn(width, not n_classes)
    todo = [(0, np.arange(len(y)))]
    while todo:
        node, rows = todo.pop()
        found, mine = None, codes[rows]
        if tree.depth[node] < deepest and len(rows) > 1 and (mine != mine[0]).any():
            order = rng.permutation(width)
            for i in range(0, width, drawn):  # further features only where those drawn cannot be split
                some = order[i : i + drawn]
                found = _exact_split(x[np.ix_(rows, some)], mine, w[rows], len(values) if n_classes else 0, p.min_leaf)
                if found:
                    break
        if found is None:
            tree.leaf[node] = _leaf(y[rows], w[rows], n_classes)
            continue
        feature, threshold = int(some[found[0]]), found[1]
        low, at = x[rows, feature] <= threshold, tree.split(node, feature, threshold)
        todo += [(at + 1, rows[~low]), (at, rows[low])]
    return tree


def fit_forest(df: DataFrame, n_classes: int, params: ForestParams = ForestParams(), weight: Column | None = None) -> Forest:
    """Fit on (label, features[, row_id]); ``n_classes`` 0 predicts numbers. Rows without a label or weight do not count.

    Without rows the forest answers equal class shares, or 0. Equal rows with different labels share a leaf.
    Rows are drawn by ``row_id`` where there is one.
    """
    w = (F.lit(1.0) if weight is None else weight).cast("double")
    key = F.xxhash64(F.lit(params.seed), "row_id") if "row_id" in df.columns else F.monotonically_increasing_id()
    rows = df.select(key.alias("key"), F.col("label").cast("double").alias("y"), w.alias("w"), "features")
    rows = spread(rows.filter("y IS NOT NULL AND w > 0"))
    pack = F.pandas_udf(lambda x: pd.Series([r.tobytes() for r in _dense(x)]), "binary")
    held = materialize(rows.select("key", "y", "w", F.size("features").alias("d"), pack("features").alias("x")))
    stats = held.agg(F.max("d").alias("d"), F.avg("y").alias("mean"), F.count("y").alias("n"), F.min("w").alias("w")).first()
    prior = np.full(n_classes, 1 / n_classes) if n_classes else np.array([stats["mean"] or 0.0])
    if not stats["n"]:
        return Forest([], [], None, prior, 0)
    width = stats["d"]
    limit = max(1, min(TASK_ROWS, TASK_BYTES // (8 * width)))
    light = min(1.0, stats["w"])  # a node of some weight has at most weight / light rows
    held = held.drop("d")
    forest = Forest([], [], None, prior, width)
    if stats["n"] <= limit:
        _whole(forest, held, n_classes, params)
        return forest
    edges = _edges(held, width, params.bins)
    for first in range(0, params.trees, WAVE):
        _wave(forest, held, range(first, min(first + WAVE, params.trees)), edges, limit, light, n_classes, params)
    forest.subtrees = forest.waves[0]
    for more in forest.waves[1:]:
        forest.subtrees = forest.subtrees.unionByName(more)
    return forest


def _subtree(rows: pd.DataFrame, w: np.ndarray, t: int, node: int, depth: int, width: int, n_classes: int, p: ForestParams) -> dict:
    """What grows below a node of a tree, from its rows in the order of their keys, so reruns agree."""
    y = rows["y"].to_numpy().astype(int) if n_classes else rows["y"].to_numpy()
    rng = np.random.default_rng([p.seed, t, node, 1])
    tree = _grown(_unpacked(rows["x"], width), y, w, n_classes, p, rng, depth).packed()
    names = ("feature", "threshold", "child", "start", "class", "share")
    fields = (tree.feature, tree.threshold, tree.child, tree.start, tree.cls, tree.share)
    return {"tree": t, "node": node, **dict(zip(names, fields))}


def _whole(forest: Forest, held: DataFrame, n_classes: int, p: ForestParams) -> None:
    """Grows whole trees of a table that fits a task: it is copied once per task, not once per tree."""
    spark, width = held.sparkSession, forest.width
    n = max(1, min(p.trees, spark.sparkContext.defaultParallelism))
    # numbers that fall into partitions of their own
    homes = spark.range(64 * n).select("id", F.pmod(F.hash("id"), F.lit(n)).alias("home")).groupBy("home").agg(F.min("id").alias("id"))
    ids = sorted(r["id"] for r in homes.collect())

    def grow(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("key")
        w, out = rows["w"].to_numpy(), []
        for t in range(ids.index(int(rows["task"].iloc[0])), p.trees, len(ids)):
            times = _times(rows["key"].to_numpy(), t, p) * w
            if (use := times > 0).any():
                out.append(_subtree(rows[use], times[use], t, 0, 0, width, n_classes, p))
        return pd.DataFrame(out, columns=["tree", "node", "feature", "threshold", "child", "start", "class", "share"])

    copies = held.withColumn("task", F.explode(F.lit(ids).cast("array<bigint>"))).repartition(n, "task")
    forest.subtrees = materialize(copies.groupBy("task").applyInPandas(grow, _SUBTREE))
    forest.tops = [Nodes().packed() for _ in range(p.trees)]
    forest.open_ends = [np.ones(1, bool) for _ in range(p.trees)]


def _wave(forest: Forest, held: DataFrame, trees: range, edges: list, limit: int, light: float, n_classes: int, p: ForestParams) -> None:
    """Grows the tops of some trees by passes over the table, then everything below them in tasks."""
    width, tops = forest.width, {t: Nodes() for t in trees}
    ends: dict[int, set[int]] = {t: set() for t in trees}
    # an open node: features tried so far, the bounds of its bins, whether these come from its very rows
    fresh = {(t, 0): (0, edges, False) for t in trees}
    drawn = p.drawn(width, not n_classes)
    while fresh:
        slots = []
        for (t, node), (tried, bounds, own) in sorted(fresh.items()):
            order = np.random.default_rng([p.seed, t, node]).permutation(width)
            slots.append((t, node, order[tried : tried + drawn], bounds, own, tried))
        fresh, stuck = {}, []
        for slot, r in _passes(held, slots, tops, n_classes, p):
            t, node, some, bounds, own, tried = slot
            total = np.array(r["total"])
            if n_classes and (total > 0).sum() == 1:
                tops[t].leaf[node] = (np.flatnonzero(total).astype(np.int32), np.ones(1))
            elif tops[t].depth[node] == p.max_depth:
                tops[t].leaf[node] = _summed_leaf(total, n_classes)
            elif r["pos"] >= 0:
                f = int(some[r["pos"]])
                at = tops[t].split(node, f, float(bounds[f][r["cut"]]))
                for i, heavy in enumerate((r["nl"], r["nr"])):
                    if heavy / light > limit:
                        fresh[t, at + i] = (0, bounds, False)
                    else:
                        ends[t].add(at + i)
            elif tried + drawn < width:
                fresh[t, node] = (tried + drawn, bounds, own)
            elif not own:
                stuck.append((t, node))
            else:  # every feature is constant, or no cut leaves enough rows on both sides
                tops[t].leaf[node] = _summed_leaf(total, n_classes)
        for t, node in stuck:  # many rows inside one bin of every feature: bins of their own
            mine = _at_node(held, tops[t].packed(), node, width)
            fresh[t, node] = (0, _edges(mine, width, p.bins), True)
    packed = {t: tops[t].packed() for t in trees}
    masks = {t: np.isin(np.arange(len(packed[t].child)), list(ends[t])) for t in trees}
    depths = {t: np.array(tops[t].depth) for t in trees}

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x, key = _unpacked(batch["x"], width), batch["key"].to_numpy()
            for t in trees:
                at, times = packed[t].route(x), _times(key, t, p) * batch["w"].to_numpy()
                use = masks[t][at] & (times > 0)
                yield batch[use].assign(tree=t, node=at[use], w=times[use])

    def grow(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("key")
        t, node = int(rows["tree"].iloc[0]), int(rows["node"].iloc[0])
        return pd.DataFrame([_subtree(rows, rows["w"].to_numpy(), t, node, int(depths[t][node]), width, n_classes, p)])

    dealt = held.mapInPandas(deal, _ROUTED)
    forest.waves.append(materialize(dealt.groupBy("tree", "node").applyInPandas(grow, _SUBTREE)))
    forest.tops += [packed[t] for t in trees]
    forest.open_ends += [masks[t] for t in trees]


def _at_node(held: DataFrame, top: Packed, node: int, width: int) -> DataFrame:
    def keep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch[top.route(_unpacked(batch["x"], width)) == node]

    return held.mapInPandas(keep, held.schema)


def _edges(held: DataFrame, width: int, bins: int) -> list[np.ndarray]:
    """Ascending distinct quantiles of each feature, without its largest value."""

    def long(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = _unpacked(batch["x"], width)
            yield pd.DataFrame({"pos": np.tile(np.arange(width), len(x)), "v": x.ravel()})

    values = held.mapInPandas(long, "pos int, v double").filter("NOT isnan(v)")
    shares = F.array(*[F.lit(i / bins) for i in range(1, bins)])
    found = values.groupBy("pos").agg(F.percentile_approx("v", shares, _ACCURACY).alias("q"), F.max("v").alias("top"))
    out = [np.zeros(0)] * width
    for r in found.toLocalIterator():  # one row of bins numbers per feature
        q = np.unique(np.array(r["q"]))
        out[r["pos"]] = q[q < r["top"]]
    return out


def _passes(held: DataFrame, slots: list, tops: dict[int, Nodes], n_classes: int, p: ForestParams) -> Iterator[tuple]:
    """(slot, its best split among the drawn features) of every open node."""
    sums = n_classes or 2
    drawn = max(len(s[2]) for s in slots)
    at_once = max(1, HISTOGRAM_BYTES // (8 * p.bins * drawn * sums))
    width, least = len(slots[0][3]), p.min_leaf
    packed = {t: tops[t].packed() for t in {s[0] for s in slots}}
    for s in range(0, len(slots), at_once):
        some = slots[s : s + at_once]

        def partial(batches, some=some):
            hist = np.zeros((len(some), drawn, p.bins, sums))
            for batch in batches:
                x, key, y = _unpacked(batch["x"], width), batch["key"].to_numpy(), batch["y"].to_numpy()
                places = {}
                for i, (t, node, features, bounds, _, _) in enumerate(some):
                    if t not in places:
                        places[t] = packed[t].route(x), _times(key, t, p) * batch["w"].to_numpy()
                    at, times = places[t]
                    here = np.flatnonzero((at == node) & (times > 0))
                    w, mine = times[here], y[here]
                    for j, f in enumerate(features):
                        b = np.searchsorted(bounds[f], x[here, f])
                        if n_classes:
                            cells = np.bincount(b * sums + mine.astype(int), w, p.bins * sums).reshape(p.bins, sums)
                        else:
                            cells = np.stack([np.bincount(b, v, p.bins) for v in (w, w * mine)], axis=1)
                        hist[i, j] += cells
            for i in np.flatnonzero(hist[:, 0].any(axis=(1, 2))):
                yield pd.DataFrame({"slot": [i], "part": [TaskContext.get().partitionId()], "sums": [hist[i].tobytes()]})

        def reduce(parts: pd.DataFrame) -> pd.DataFrame:
            total = 0.0
            for blob in parts.sort_values("part")["sums"]:
                total = total + np.frombuffer(blob).reshape(drawn, p.bins, sums)
            left, all_of = total.cumsum(axis=1), total[0].sum(axis=0)
            right = all_of - left
            nl, nr = (left.sum(axis=2), right.sum(axis=2)) if n_classes else (left[:, :, 0], right[:, :, 0])
            fits = (nl >= max(least, 1e-9)) & (nr >= max(least, 1e-9)) & (total.any(axis=(1, 2))[:, None])
            with np.errstate(divide="ignore", invalid="ignore"):
                if n_classes:
                    score = (left**2).sum(axis=2) / nl + (right**2).sum(axis=2) / nr
                else:
                    score = left[:, :, 1] ** 2 / nl + right[:, :, 1] ** 2 / nr
            pos, cut = np.unravel_index(np.where(fits, score, -np.inf).argmax(), score.shape)
            row = {"slot": parts["slot"].iloc[0], "pos": pos if fits.any() else -1, "cut": cut, "total": all_of}
            return pd.DataFrame([row | {"nl": nl[pos, cut], "nr": nr[pos, cut]}])

        table = held.mapInPandas(partial, "slot int, part int, sums binary")
        best = table.groupBy("slot").applyInPandas(reduce, "slot int, pos int, cut int, total array<double>, nl double, nr double")
        for r in best.toLocalIterator():  # a row per open node
            yield some[r["slot"]], r
