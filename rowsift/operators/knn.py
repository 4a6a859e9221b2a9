"""Exact k-nearest-neighbour join by pivots.

Rows are gathered into cells around pivots sampled from the data (the Voronoi
partitioning of Lu et al. 2012, "Efficient processing of k nearest neighbor
joins using MapReduce"), and cells with more rows than a block into cells around
pivots of their own, level by level. Each query row first searches one block of
its own cell, which bounds the distance of its k-th neighbour, and then goes down
the tree into the cells whose distance bounds do not rule them out. So cells stay
as small however many rows there are. Three things keep tasks bounded whatever the data:

* equal vectors are searched once and carry their k+1 smallest ids, so a group
  of copies costs one row;
* pivots below the root are tables met cell by cell, never broadcast as a whole;
* a cell or block with many visitors is salted, visitors being spread over the salts.

Where bounds rule little out (high dimension, all distances alike), a few queries show
it: then all rows are read past every stripe of queries, so that a vector is shuffled and
written once, whatever the number of rows. The arithmetic stays quadratic there.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rowsift.functions.hashing import hash_key, hash_uniform
from rowsift.functions.ranking import KEY_DIGITS, cut_points
from rowsift.functions.runtime import checked_broadcast, collect_small, materialize
from rowsift.functions.skew import skew_join

_SLACK = 1e-7
#: Twice the relative error of one term of a product in single precision.
_SINGLE = 2.0**-23
#: Queries, and rows, of one matrix product.
_TILE, _CHUNK = 512, 4096


def _distinct_vectors(df: DataFrame, keep: int) -> DataFrame:
    """(vec, vid, members, more): one row per vector with its ``keep`` smallest ids.

    The row_number limit is applied before the shuffle, so copies do not pile up. Both
    windows are alike, so the vectors are shuffled and sorted once.
    """
    w = Window.partitionBy("vec").orderBy("id")
    few = df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= keep + 1)
    ids = few.withColumn("ids", F.collect_list("id").over(w.rowsBetween(0, keep))).filter("_rn = 1")
    return ids.select(
        "vec",
        F.element_at("ids", 1).alias("vid"),
        F.slice("ids", 1, keep).alias("members"),
        (F.size("ids") > keep).alias("more"),
    )


def _squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    d = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2.0 * (a @ b.T)
    return np.maximum(d, 0.0)


def _stack(vectors: pd.Series) -> np.ndarray:
    return np.stack(vectors.to_numpy()).astype(np.float64, copy=False)


def _matrix(vectors: pa.ChunkedArray) -> np.ndarray:
    return vectors.combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(vectors), -1)


def _nearest_rows(q_all: np.ndarray, bound_all: np.ndarray, c_all: np.ndarray, bid: np.ndarray, keep: int):
    """(rows of ``q_all``, rows of ``c_all``, dist): up to ``keep`` nearest within the bound of every query.

    A matrix product finds the candidates, with a margin for its rounding; the
    distances given out are computed by direct subtraction. The product is made in single
    precision where its margin is small beside the bounds. Of a large ``c_all`` a chunk
    is seen at a time, and what it gives lowers the bound for the next.
    """
    out = []
    c_square = (c_all * c_all).sum(1)
    c_norm = float(c_square.max())
    # a row of [q, 1] times one of these is half of (|q|^2 - squared distance)
    wide = {np.float64: np.concatenate([c_all, c_square[:, None] / -2.0], axis=1)}
    for s in range(0, len(q_all), _TILE):
        q, bound = q_all[s : s + _TILE], bound_all[s : s + _TILE]
        q_square = (q * q).sum(1)
        margin = 1e-8 * (1.0 + q_square + c_norm)
        limit = (bound + _SLACK * (1.0 + np.minimum(bound, 1e150))) ** 2
        kind = np.float64
        rough = _SINGLE * (q.shape[1] + 8) * (q_square + 2.0 * c_norm)
        if np.isfinite(limit).all() and max(c_norm, q_square.max()) < 1e30 and np.median(limit) > 1e3 * np.median(rough):
            kind, margin = np.float32, margin + rough
            if kind not in wide:
                wide[kind] = wide[np.float64].astype(kind)
        q_wide = np.concatenate([q, np.ones((len(q), 1))], axis=1).astype(kind)
        r, k, dist = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        for at in range(0, len(c_all), _CHUNK):
            near = q_wide @ wide[kind][at : at + _CHUNK].T
            within = near >= ((q_square - limit - margin) / 2.0).astype(kind)[:, None]
            if near.shape[1] > keep and np.count_nonzero(within) > 4 * keep * len(q):
                np.negative(near, out=near)
                limit = np.minimum(limit, q_square + 2.0 * np.partition(near, keep - 1, axis=1)[:, keep - 1])
                within = near <= ((limit + margin - q_square) / 2.0).astype(kind)[:, None]
            new_r, new_k = np.nonzero(within)
            if not len(new_r):
                continue
            new_k += at
            new = np.empty(len(new_r))
            for t in range(0, len(new_r), 1 << 16):
                diff = q[new_r[t : t + (1 << 16)]] - c_all[new_k[t : t + (1 << 16)]]
                new[t : t + (1 << 16)] = np.sqrt((diff * diff).sum(1))
            r, k, dist = np.concatenate([r, new_r]), np.concatenate([k, new_k]), np.concatenate([dist, np.round(new, KEY_DIGITS)])
            order = np.lexsort((bid[k], dist, r))
            r, k, dist = r[order], k[order], dist[order]
            place = np.arange(len(r)) - np.searchsorted(r, np.arange(len(q)))[r]
            last = place == keep - 1
            far = dist[last]
            limit[r[last]] = np.minimum(limit[r[last]], (far + _SLACK * (1.0 + far)) ** 2)
            kept = place < keep
            r, k, dist = r[kept], k[kept], dist[kept]
        out.append((s + r, k, dist))
    return [np.concatenate(part) for part in zip(*out, strict=True)]


def _nearest_in_block(keep: int):
    """Per-group function: up to ``keep`` nearest block rows of every visitor."""

    def search(visitors: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        if not len(visitors) or not len(block):
            return pd.DataFrame(
                {
                    "qid": pd.Series(dtype="int64"),
                    "members": pd.Series(dtype="object"),
                    "dist": pd.Series(dtype="float64"),
                }
            )
        r, k, dist = _nearest_rows(
            _stack(visitors["qvec"]), visitors["bound"].to_numpy(), _stack(block["vec"]), block["vid"].to_numpy(), keep
        )
        return pd.DataFrame({"qid": visitors["qid"].to_numpy()[r], "members": block["members"].to_numpy()[k], "dist": dist})

    return search


#: Children of one node of the pivot tree at most; cell codes have ten bits per level.
_FAN = 1024
#: Levels below the root.
_LEVELS = 5
#: Rows in one task that looks for the nearest pivots of a cell.
_PLACE_ROWS = 50_000


def _near_bound(d2: np.ndarray, pivots: np.ndarray, radius: np.ndarray, bound: np.ndarray, probes: int | None) -> np.ndarray:
    """Which cells may hold a row within ``bound``, by their radius and by the border to the nearest pivot's cell.

    Holds for any query: a row of cell c is nearer to c than to the pivot h nearest to the query.
    """
    home = d2.argmin(axis=1)
    by_radius = np.sqrt(d2) - radius[None, :]
    apart = np.sqrt(_squared(pivots, pivots))[home]
    with np.errstate(divide="ignore", invalid="ignore"):
        by_border = (d2 - d2[np.arange(len(d2)), home][:, None]) / (2.0 * apart)
    by_border = np.where(apart > 0, by_border, -np.inf)
    may = np.maximum(by_radius, by_border) <= bound[:, None] + _SLACK * (1.0 + np.sqrt(d2))
    may &= radius[None, :] >= 0
    if probes is not None and probes < len(pivots):
        near = np.argpartition(d2, probes - 1, axis=1)[:, :probes]
        allowed = np.zeros_like(may)
        allowed[np.arange(len(d2))[:, None], near] = True
        may &= allowed
    return may


def _nearest_pivot(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """The nearest pivot of every row; a tile of rows meets the pivots at a time, so memory does not grow with the batch."""
    return np.concatenate([_squared(x[s : s + _TILE], pivots).argmin(axis=1) for s in range(0, len(x), _TILE)])


def _cells_in_reach(x: np.ndarray, pivots: np.ndarray, radius: np.ndarray, bound: np.ndarray, probes: int | None) -> list[np.ndarray]:
    """For every row the cells that may hold a neighbour, tile by tile."""
    out = []
    for s in range(0, len(x), _TILE):
        may = _near_bound(_squared(x[s : s + _TILE], pivots), pivots, radius, bound[s : s + _TILE], probes)
        out.extend(np.nonzero(m)[0].astype("int32") for m in may)
    return out


def _meet(left: DataFrame, right: DataFrame, keys: list[str], per_task: int, search, schema: str) -> DataFrame:
    """Cogroup by ``keys``; a key with more than ``per_task`` rows of ``left`` is dealt to several tasks.

    ``left`` has an id ``lid``; rows of ``right`` are copied once per task.
    """
    busy = left.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > per_task)
    busy = checked_broadcast(busy.select(*keys, F.ceil(F.col("n") / F.lit(per_task)).cast("int").alias("_tasks")))
    tasks = F.coalesce("_tasks", F.lit(1))
    l = left.join(busy, keys, "left").withColumn("_salt", F.pmod(F.xxhash64("lid", F.lit(1)), tasks.cast("bigint")).cast("int"))
    r = right.join(busy, keys, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), tasks - 1)))
    # the two sides may come from one frame, so the left keys get names of their own
    l = l.drop("_tasks").withColumnsRenamed({c: f"_to_{c}" for c in [*keys, "_salt"]})
    to = l.groupBy(*[f"_to_{c}" for c in [*keys, "_salt"]])
    return to.cogroup(r.drop("_tasks").groupBy(*keys, "_salt")).applyInPandas(search, schema)


def _child_of(points: pd.DataFrame, pivots: pd.DataFrame) -> pd.DataFrame:
    """(lid, cell, pd): the nearest pivot of the cell every point is in."""
    if not len(points) or not len(pivots):
        return pd.DataFrame({"lid": pd.Series(dtype="int64"), "cell": pd.Series(dtype="int64"), "pd": pd.Series(dtype="float64")})
    x, p = _stack(points["vec"]), _stack(pivots["pivot"])
    child = _nearest_pivot(x, p)
    exact = np.sqrt(((x - p[child]) ** 2).sum(1))
    codes = pivots["child"].to_numpy()[child]
    return pd.DataFrame({"lid": points["lid"].to_numpy(), "cell": codes, "pd": exact})


_VISIT = "qid bigint, vec array<double>, bound double, own_cell bigint, own_block int, cell bigint, blocks int"


def _children_in_reach(probes: int | None):
    def descend(visitors: pd.DataFrame, children: pd.DataFrame) -> pd.DataFrame:
        cols = ["qid", "vec", "bound", "own_cell", "own_block"]
        out = []
        if len(children):
            pivots, radius = _stack(children["pivot"]), children["radius"].to_numpy()
            codes, blocks = children["child"].to_numpy(), children["blocks"].to_numpy()
            for s in range(0, len(visitors), _TILE):
                some = visitors.iloc[s : s + _TILE]
                may = _near_bound(_squared(_stack(some["vec"]), pivots), pivots, radius, some["bound"].to_numpy(), probes)
                r, k = np.nonzero(may)
                out.append(some[cols].iloc[r].assign(cell=codes[k], blocks=blocks[k]))
        return pd.concat(out) if out else visitors[cols].iloc[:0].assign(cell=np.int64(0), blocks=np.int32(0))

    return descend


class _Tree:
    """Pivots within cells within cells.

    The root's pivots are a driver-side table of at most ``_FAN`` rows. A cell with more rows
    than a block gets pivots of its own, sampled from its rows by a hash, and so on below;
    these stay tables (cell, child, pivot, radius, blocks), one per level, which points and
    visitors meet cell by cell. ``blocks`` is 0 for a cell that has children. A cell's code
    is its parent's, ten bits on.
    """

    def __init__(self, pivots: np.ndarray, block_rows: int, rows_per_cell: int, fan: int, probes: int | None):
        self.pivots, self.probes = pivots, probes
        self.radius = np.full(len(pivots), -1.0)
        self.blocks = [0] * len(pivots)
        self.block_rows, self.rows_per_cell, self.fan = block_rows, rows_per_cell, fan
        self.levels: list[DataFrame] = []

    def _from_root(self, points: DataFrame) -> DataFrame:
        """Adds ``cell`` (the nearest of the root's) and ``pd``, the distance to its pivot."""
        pivots = self.pivots

        @F.pandas_udf("cell bigint, pd double")
        def nearest(vec: pd.Series) -> pd.DataFrame:
            x = _stack(vec)
            cell = _nearest_pivot(x, pivots)
            return pd.DataFrame({"cell": cell + _FAN, "pd": np.sqrt(((x - pivots[cell]) ** 2).sum(1))})

        return points.withColumn("_p", nearest("vec")).select(*points.columns, "_p.cell", "_p.pd")

    @staticmethod
    def _one_level(rows: DataFrame, nodes: DataFrame) -> DataFrame:
        """``rows`` of cells with children, moved to the nearest child."""
        points = rows.select(F.col("vid").alias("lid"), "vec", "cell")
        found = _meet(points, nodes.select("cell", "child", "pivot"), ["cell"], _PLACE_ROWS, _child_of, "lid bigint, cell bigint, pd double")
        return rows.drop("cell", "pd").join(found.withColumnRenamed("lid", "vid"), "vid")

    def build(self, points: DataFrame, n: int) -> DataFrame:
        """Grow the tree over ``points`` (vid, vec, ...) and return them with ``cell`` and ``block``."""
        if len(self.pivots) == 1:
            self.radius[0], self.blocks[0] = np.inf, math.ceil(n / self.block_rows)
            return self._with_blocks(points.withColumn("cell", F.lit(_FAN).cast("bigint")))
        rows = materialize(self._from_root(points))
        sizes = {}
        for r in rows.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("pd").alias("r")).collect():
            self.radius[r["cell"] - _FAN], sizes[r["cell"]] = r["r"], r["n"]
            self.blocks[r["cell"] - _FAN] = math.ceil(r["n"] / self.block_rows)
        spark = points.sparkSession
        large = spark.createDataFrame([(c, k) for c, k in sizes.items() if k > self.block_rows], "cell bigint, n bigint")
        settled = None
        for level in range(_LEVELS):
            if large.isEmpty():
                break
            inner = rows.join(checked_broadcast(large), "cell")
            nodes = self._sampled(inner, level)
            split = nodes.select("cell").distinct()
            if level == 0:
                for r in split.collect():  # at most one row per pivot of the root
                    self.blocks[r["cell"] - _FAN] = 0
            still = rows.join(checked_broadcast(split), "cell", "left_anti")
            settled = still if settled is None else settled.unionByName(still)
            rows = materialize(self._one_level(rows.join(checked_broadcast(split), "cell"), nodes).select(*rows.columns))
            stats = rows.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("pd").alias("radius"))
            stats = materialize(stats.withColumnRenamed("cell", "child"))
            if self.levels:  # cells that have got children are no longer visited as blocks
                was = self.levels[-1].join(checked_broadcast(split.select(F.col("cell").alias("child"), F.lit(0).alias("_none"))), "child", "left")
                self.levels[-1] = materialize(was.withColumn("blocks", F.coalesce("_none", "blocks")).drop("_none"))
            blocks = F.ceil(F.col("n") / F.lit(self.block_rows)).cast("int").alias("blocks")
            self.levels.append(materialize(nodes.join(stats, "child").select("cell", "child", "pivot", "radius", blocks)))
            large = stats.filter(F.col("n") > self.block_rows).select(F.col("child").alias("cell"), "n")
        return self._with_blocks(rows if settled is None else settled.unionByName(rows))

    def _sampled(self, inner: DataFrame, level: int) -> DataFrame:
        """(cell, child, pivot): pivots of every cell, sampled from its rows by a hash; a cell with one stays whole."""
        wanted = F.least(F.lit(self.fan), F.ceil(F.col("n") / F.lit(self.rows_per_cell)) + 1)
        taken = inner.filter(hash_uniform(7, f"pivot{level}", F.col("vid").cast("string")) < wanted / F.col("n"))
        order = Window.partitionBy("cell").orderBy("vid")  # over the few sampled rows
        numbered = taken.select(
            "cell", F.row_number().over(order).alias("k"), F.col("vec").alias("pivot"), F.count(F.lit(1)).over(Window.partitionBy("cell")).alias("of")
        )
        kept = numbered.filter((F.col("of") > 1) & (F.col("k") <= _FAN))
        return materialize(kept.select("cell", (F.col("cell") * _FAN + F.col("k") - 1).alias("child"), "pivot"))

    def _with_blocks(self, rows: DataFrame) -> DataFrame:
        """Adds ``block``; only cells that could not be split have more than one."""
        spark = rows.sparkSession
        many = spark.createDataFrame([(_FAN + i, b) for i, b in enumerate(self.blocks) if b > 1], "cell bigint, blocks int")
        for nodes in self.levels:
            many = many.unionByName(nodes.filter("blocks > 1").select(F.col("child").alias("cell"), "blocks"))
        many = checked_broadcast(many)
        block = F.pmod(F.xxhash64("vid"), F.coalesce("blocks", F.lit(1)).cast("bigint")).cast("int")
        return rows.join(many, "cell", "left").withColumn("block", block).drop("blocks")

    def place(self, points: DataFrame) -> DataFrame:
        """``points`` (vid, vec, ...) with the ``cell`` and ``block`` they would be in."""
        if len(self.pivots) == 1:
            return self._with_blocks(points.withColumn("cell", F.lit(_FAN).cast("bigint")))
        rows, settled = materialize(self._from_root(points)), None
        for nodes in self.levels:
            split = checked_broadcast(nodes.select("cell").distinct())
            still = rows.join(split, "cell", "left_anti")
            settled = still if settled is None else settled.unionByName(still)
            rows = materialize(self._one_level(rows.join(split, "cell"), nodes).select(*rows.columns))
        return self._with_blocks(rows if settled is None else settled.unionByName(rows))

    def visits(self, known: DataFrame, visit_rows: int) -> DataFrame:
        """(qid, vec, bound, cell, block): blocks besides a row's own that may hold one of its neighbours.

        ``known`` has qid, vec, bound, cell and block.
        """
        pivots, radius, probes = self.pivots, self.radius, self.probes

        @F.pandas_udf("array<int>")
        def reach(vec: pd.Series, bound: pd.Series) -> pd.Series:
            return pd.Series(_cells_in_reach(_stack(vec), pivots, radius, bound.to_numpy(), probes))

        columns = [c.split()[0] for c in _VISIT.split(", ")]
        front = known.select(
            "qid", "vec", "bound", F.col("cell").alias("own_cell"), F.col("block").alias("own_block"), F.explode(reach("vec", "bound")).alias("to")
        )
        front = front.withColumns({"cell": (F.col("to") + _FAN).cast("bigint"), "blocks": F.element_at(F.lit(self.blocks), F.col("to") + 1)})
        front = front.select(*columns)
        fronts = [front]
        for nodes in self.levels:
            fronts[-1] = materialize(fronts[-1])
            down = fronts[-1].filter("blocks = 0").withColumn("lid", F.col("qid"))
            fronts.append(_meet(down, nodes, ["cell"], visit_rows, _children_in_reach(probes), _VISIT))
        found = fronts[0]
        for f in fronts[1:]:
            found = found.unionByName(f)
        found = found.filter("blocks > 0")
        return (
            found.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .filter(~((F.col("cell") == F.col("own_cell")) & (F.col("block") == F.col("own_block"))))
            .select("qid", "vec", "bound", "cell", "block")
        )


def _choose_pivots(base: DataFrame, n: int, rows_per_cell: int, max_pivots: int) -> np.ndarray:
    many = min(max_pivots, max(1, math.ceil(n / rows_per_cell)))
    key = hash_key(7, "pivot", F.col("vid").cast("string"))
    cut = cut_points(base, key, lambda s: {(): [min(many, s[()])]})[()]
    rows = collect_small(base.filter(key <= cut[0]).select("vid", "vec"), max_pivots)
    rows.sort(key=lambda r: r["vid"])
    return np.array([r["vec"] for r in rows], dtype=np.float64)


def _visit(visits: DataFrame, base: DataFrame, keep: int, visit_rows: int) -> DataFrame:
    """Search the block each visit names; blocks with many visitors are dealt to several tasks."""
    asked = visits.select("qid", F.col("qid").alias("lid"), F.col("vec").alias("qvec"), "bound", "cell", "block")
    rows = base.select("vid", "vec", "members", "cell", "block")
    schema = "qid bigint, members array<bigint>, dist double"
    return _meet(asked, rows, ["cell", "block"], visit_rows, _nearest_in_block(keep), schema)


def _visit_own(rows: DataFrame, keep: int) -> DataFrame:
    """(qid, vec, cell, block, bound, near): what every row finds in its own block, and the distance of the ``keep``-th of it.

    Visitors and block are the same rows, so a vector is shuffled once, and its bound is
    beside it without a join.
    """
    search = _nearest_in_block(keep)

    def own(block: pa.Table) -> pa.Table:
        seen = block.select(["vid", "vec", "members"]).to_pandas()
        visitors = pd.DataFrame({"qid": np.arange(len(seen)), "qvec": seen["vec"], "bound": np.inf})
        found = search(visitors, seen)  # by query and distance
        dist = found["dist"].to_numpy()
        ends = np.searchsorted(found["qid"].to_numpy(), np.arange(len(seen) + 1))
        bound, last = np.full(len(seen), np.inf), ends[1:][np.diff(ends) >= keep] - 1
        bound[np.diff(ends) >= keep] = dist[last]
        pairs = pa.StructArray.from_arrays([pa.array(found["members"], pa.list_(pa.int64())), pa.array(dist)], ["members", "dist"])
        near = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pairs)
        columns = {"qid": block["vid"], "vec": block["vec"], "cell": block["cell"], "block": block["block"], "bound": pa.array(bound), "near": near}
        return pa.table(columns)

    schema = "qid bigint, vec array<double>, cell bigint, block int, bound double, near array<struct<members: array<bigint>, dist: double>>"
    return rows.select("vid", "vec", "members", "cell", "block").groupBy("cell", "block").applyInArrow(own, schema)


#: Queries are cut into so many stripes where bounds rule little out, and into more beyond so many bytes a stripe.
_STRIPES, _STRIPE_BYTES = 12, 32 << 20
#: Tasks, about, of that search, as long as stripes are few; its rows are packed by so many bytes.
_TASKS, _PACK_BYTES = 36, 8 << 20
#: Shares of the rows that a stripe meets at most. Each gives out neighbours of every query, so they must not grow with the rows.
_SHARES = 3
#: Queries, about, that tell how many blocks one visits.
_TRIED = 256


def _stripes(n: int, width: int, block_rows: int) -> int:
    """Stripes of ``n`` rows: as many at any size, until a stripe has ``_STRIPE_BYTES``."""
    return max(min(_STRIPES, math.ceil(n / block_rows)), math.ceil(8 * n * max(1, width) / _STRIPE_BYTES))


def _mean_visits(tree: _Tree, known: DataFrame, visit_rows: int, n: int) -> float:
    """Blocks that one query (with its bound) visits besides its own, by a few queries picked by a hash."""
    tried = materialize(known.filter(hash_uniform(7, "visits", F.col("qid").cast("string")) < _TRIED / max(1, n)))
    rows = tried.count()
    return tree.visits(tried, visit_rows).count() / rows if rows else 0.0


def _packed(df: DataFrame, parts: int | None, per_pack: int | None, columns: dict[str, str]) -> DataFrame:
    """``df`` (id, vec and ``columns``) in ``parts`` files, ``per_pack`` rows (all of a file) to one: numbers as bytes, lists as lists.

    ``parts`` None leaves the rows in the partitions they are in.
    """
    lists = [c for c, kind in columns.items() if kind.startswith("array")]
    flat = [c for c in columns if c not in lists]

    def as_bytes(column: pa.ChunkedArray) -> bytes:
        return (_matrix(column) if pa.types.is_list(column.type) else column.to_numpy()).tobytes()

    def pack(batches):
        held: list[pa.RecordBatch] = []

        def flush():
            table = pa.Table.from_batches(held)
            held.clear()
            out = [pa.array([as_bytes(table.column(c))], pa.binary()) for c in flat]
            for c in lists:
                values = table.column(c).combine_chunks()
                out.append(pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values))
            return pa.RecordBatch.from_arrays(out, [*flat, *lists])

        for batch in batches:
            while batch.num_rows:
                room = batch.num_rows if per_pack is None else per_pack - sum(b.num_rows for b in held)
                held.append(batch.slice(0, room))
                batch = batch.slice(room)
                if per_pack is not None and sum(b.num_rows for b in held) >= per_pack:
                    yield flush()
        if held:
            yield flush()

    schema = ", ".join([*[f"{c} binary" for c in flat], *[f"{c} array<{columns[c]}>" for c in lists]])
    dealt = df.select(*columns)
    return materialize((dealt if parts is None else dealt.repartition(parts)).mapInArrow(pack, schema))


_Found = tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]


def _with_nearer(kept: _Found, new: _Found, bound: np.ndarray, keep: int) -> _Found:
    """The ``keep`` nearest of ``kept`` and ``new`` (query, id, dist, members); lowers ``bound`` of the queries in ``new``."""
    again = np.zeros(len(bound), bool)
    again[new[0]] = True
    old, stay = np.flatnonzero(again[kept[0]]), np.flatnonzero(~again[kept[0]])
    row, vid, dist = (np.concatenate([a, b]) for a, b in zip(kept[:3], new[:3], strict=True))
    mixed = np.concatenate([old, len(kept[0]) + np.arange(len(new[0]))])
    mixed = mixed[np.lexsort((vid[mixed], dist[mixed], row[mixed]))]
    place = np.arange(len(mixed)) - np.searchsorted(row[mixed], np.arange(len(bound)))[row[mixed]]
    last = mixed[place == keep - 1]
    bound[row[last]] = np.minimum(bound[row[last]], dist[last])
    taken = np.concatenate([stay, mixed[place < keep]])
    return row[taken], vid[taken], dist[taken], pa.concat_arrays([kept[3], new[3]]).take(pa.array(taken))


def _in_stripes(asked: DataFrame, base: DataFrame, keep: int, n_asked: int, n_base: int, width: int) -> DataFrame:
    """Search all rows for every query (qid, vec, bound): ``n_asked`` stripes of queries, past which the rows are read.

    A stripe is a row of a written table, so are some thousand rows of ``base``. Their
    Cartesian product shuffles neither: a task holds a few stripes and streams a share of the
    rows, of which it keeps the nearest so far, so the output does not depend on the number of rows.
    """

    def search(batches):
        kept: dict[int, tuple[np.ndarray, np.ndarray, _Found]] = {}
        for batch in batches:
            for i in range(batch.num_rows):
                at = {c: batch.column(batch.schema.get_field_index(c))[i] for c in ("qid", "qvec", "bound", "vid", "vec", "members")}
                numbers = {c: np.frombuffer(at[c].as_buffer(), np.float64 if c in ("qvec", "vec", "bound") else np.int64) for c in ("qid", "qvec", "bound", "vid", "vec")}
                stripe = int(numbers["qid"][0])
                if stripe not in kept:
                    none = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), pa.array([], pa.list_(pa.int64())))
                    kept[stripe] = (numbers["qid"].copy(), numbers["bound"].copy(), none)
                ids, bound, found = kept[stripe]
                c = numbers["vec"].reshape(len(numbers["vid"]), -1)
                r, k, dist = _nearest_rows(numbers["qvec"].reshape(len(ids), -1), bound, c, numbers["vid"], keep)
                if len(r):
                    members = at["members"].values.take(pa.array(k)).cast(pa.list_(pa.int64()))
                    kept[stripe] = (ids, bound, _with_nearer(found, (r, numbers["vid"][k], dist, members), bound, keep))
        for ids, _, (r, _, dist, members) in kept.values():
            for s in range(0, len(r), 1 << 16):
                part = slice(s, s + (1 << 16))
                yield pa.RecordBatch.from_arrays([pa.array(ids[r[part]]), members[part], pa.array(dist[part])], ["qid", "members", "dist"])

    queries = _packed(asked, n_asked, None, {"qid": "bigint", "vec": "double", "bound": "double"}).withColumnRenamed("vec", "qvec")
    rows = max(256, min(4 * _CHUNK, _PACK_BYTES // (8 * max(1, width))))
    shares = min(_SHARES, -(-_TASKS // n_asked))
    spread_out = base.rdd.getNumPartitions() >= 2 * shares  # rows come by a hash, so their partitions are even
    packs = _packed(base, None if spread_out else n_base, rows, {"vid": "bigint", "vec": "double", "members": "array<bigint>"})
    pairs = packs.coalesce(shares).crossJoin(queries.hint("shuffle_replicate_nl"))
    return pairs.mapInArrow(search, "qid bigint, members array<bigint>, dist double")


def _pivot_tree(distinct: DataFrame, n: int, width: int, block_rows: int, rows_per_cell: int, max_pivots: int, probes: int | None) -> _Tree:
    fan = min(max_pivots, _FAN, max(1, (16 << 20) // (8 * max(1, width))))
    if n <= min(block_rows, 4 * rows_per_cell):
        pivots = np.zeros((1, width))
    else:
        pivots = _choose_pivots(distinct, n, rows_per_cell, fan)
    return _Tree(pivots, block_rows, rows_per_cell, fan, probes)


def _bounded(asked: DataFrame, found: DataFrame, keep: int) -> DataFrame:
    """``asked`` with ``bound``, the distance of the ``keep``-th neighbour found so far."""
    bounds = found.groupBy("qid").agg(F.count(F.lit(1)).alias("c"), F.max("dist").alias("far"))
    far = F.when(F.col("c") >= keep, F.col("far")).otherwise(F.lit(float("inf")))
    return asked.join(bounds, "qid", "left").withColumn("bound", far)


def knn_edges(
    base: DataFrame,
    k: int,
    queries: DataFrame | None = None,
    id_col: str = "row_id",
    features: str = "features",
    block_rows: int = 4096,
    visit_rows: int = 8192,
    rows_per_cell: int = 1024,
    max_pivots: int = 1024,
    probes: int | None = None,
) -> DataFrame:
    """(i, j, rank, dist): the k nearest ``base`` rows j of every row i.

    Without ``queries`` the table is joined to itself and a row is never its own
    neighbour (k is capped at n-1). The search is exact; with ``probes`` a row only
    visits the cells of that many nearest pivots on each level, which bounds the work on data
    without structure and may miss neighbours. Order is (dist, j) with dist rounded to nine
    places. Ids are BIGINT and unique, features ARRAY<DOUBLE> without nulls.
    """
    self_join = queries is None
    keep = k + 1 if self_join else k
    as_points = lambda d: d.select(
        F.col(id_col).cast("bigint").alias("id"), F.col(features).cast("array<double>").alias("vec")
    )
    points = as_points(base)
    distinct = materialize(_distinct_vectors(points, keep))
    size = distinct.agg(
        F.count(F.lit(1)).alias("n"), F.max(F.size("vec")).alias("d"), F.max("more").alias("more")
    ).first()
    if not size["n"]:
        return base.sparkSession.createDataFrame([], "i bigint, j bigint, rank int, dist double")
    tree = _pivot_tree(distinct, size["n"], size["d"], block_rows, rows_per_cell, max_pivots, probes)
    blocked = tree.build(distinct, size["n"])

    asked_points, more, n_asked = points, size["more"], size["n"]
    if self_join:
        asked = blocked
    else:
        asked_points = as_points(queries)
        own = materialize(_distinct_vectors(asked_points, keep))
        own_size = own.agg(F.max("more").alias("m"), F.count(F.lit(1)).alias("n")).first()
        more, n_asked = own_size["m"], own_size["n"]
        asked = tree.place(own)
    asked = asked.withColumn("qid", F.col("vid"))

    more_blocks = len(tree.pivots) > 1 or tree.blocks[0] > 1
    if self_join:
        known = _visit_own(blocked, keep)
        if more_blocks:
            known = materialize(known)
        found = known.select("qid", F.inline("near"))
    else:
        first = asked.select("qid", "vec", "cell", "block", F.lit(float("inf")).alias("bound"))
        found = _visit(first, blocked, keep, visit_rows)
        if more_blocks:
            found = materialize(found)
            known = materialize(_bounded(asked, found, keep))
    if more_blocks:
        parts = [_stripes(n, size["d"], block_rows) for n in (n_asked, size["n"])]
        in_stripes = n_asked * parts[1] + size["n"] * parts[0]
        if probes is None and n_asked * _mean_visits(tree, known, visit_rows, n_asked) > in_stripes:
            found = _in_stripes(known, blocked, keep, *parts, size["d"])
        else:
            rest = materialize(tree.visits(known, visit_rows))
            found = found.unionByName(_visit(rest, blocked, keep, visit_rows))

    nearest = Window.partitionBy("qid").orderBy("dist", "j")
    lists = (
        found.select("qid", F.explode("members").alias("j"), "dist")
        .withColumn("_rn", F.row_number().over(nearest))
        .filter(F.col("_rn") <= keep)
        .groupBy("qid")
        .agg(F.sort_array(F.collect_list(F.struct("dist", "j"))).alias("near"))
    )
    if more:  # needed twice
        lists = materialize(lists)
    per_row = asked.select("qid", "members").join(lists, "qid").select(
        F.explode("members").alias("i"), "near"
    )
    if more:
        crowded = asked.filter("more").select("qid", "vec", "members").join(lists, "qid")
        late = skew_join(asked_points, crowded.select("vec", "near", "members"), ["vec"])
        per_row = per_row.unionByName(
            late.filter(~F.array_contains("members", F.col("id"))).select(F.col("id").alias("i"), "near")
        )
    others = F.filter("near", lambda e: e["j"] != F.col("i")) if self_join else F.col("near")
    # written once: whatever the caller does with the edges, the search runs a single time
    return materialize(
        per_row.select("i", F.posexplode(F.slice(others, 1, k)).alias("at", "e")).select(
            "i", F.col("e.j").alias("j"), (F.col("at") + 1).alias("rank"), F.col("e.dist").alias("dist")
        )
    )


def class_votes(edges: DataFrame, labels: DataFrame, n_classes: int, id_col: str = "row_id", label: str = "label") -> DataFrame:
    """(i, votes ARRAY<BIGINT>, k): neighbour labels counted per class."""
    named = skew_join(edges, labels.select(F.col(id_col).alias("j"), F.col(label).alias("_y")), ["j"])
    counts = [F.count_if(F.col("_y") == c) for c in range(n_classes)]
    return named.groupBy("i").agg(F.array(*counts).alias("votes"), F.count(F.lit(1)).alias("k"))


def knn_vote(edges: DataFrame, labels: DataFrame, n_classes: int, **names: str) -> DataFrame:
    """Uniform vote: (i, predicted, probs); the smaller class wins a tie."""
    votes = class_votes(edges, labels, n_classes, **names)
    return votes.select(
        "i",
        (F.array_position("votes", F.array_max("votes")) - 1).cast("int").alias("predicted"),
        F.transform("votes", lambda v: v / F.col("k")).alias("probs"),
    )


def knn_regress(edges: DataFrame, targets: DataFrame, id_col: str = "row_id", target: str = "y") -> DataFrame:
    """(i, predicted): mean of neighbour targets weighted by 1/distance.

    Neighbours at distance zero take all the weight.
    """
    named = skew_join(edges, targets.select(F.col(id_col).alias("j"), F.col(target).alias("_y")), ["j"])
    zero = F.col("dist") <= 0
    w = F.when(zero, 0.0).otherwise(1.0 / F.when(zero, 1.0).otherwise(F.col("dist")))
    agg = named.groupBy("i").agg(
        F.avg(F.when(zero, F.col("_y"))).alias("at_zero"),
        (F.sum(w * F.col("_y")) / F.sum(w)).alias("weighted"),
    )
    return agg.select("i", F.coalesce("at_zero", "weighted").alias("predicted"))


def leave_one_out_probs(
    edges: DataFrame, labels: DataFrame, n_classes: int, id_col: str = "row_id", label: str = "label"
) -> DataFrame:
    """(row_id, label, probs): smoothed neighbour shares (votes + 1/K) / (k + 1)."""
    votes = class_votes(edges, labels, n_classes, id_col, label)
    smooth = F.transform(
        "votes", lambda v: F.round((v + F.lit(1.0 / n_classes)) / (F.col("k") + 1), KEY_DIGITS)
    )
    return (
        labels.select(F.col(id_col).alias("i"), F.col(label).alias("label"))
        .join(votes.select("i", smooth.alias("probs")), "i")
        .select(F.col("i").alias("row_id"), "label", "probs")
    )
