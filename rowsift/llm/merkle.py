"""Merkle manifest of a table: a nested-struct rollup whose proofs come out of a transform and an explode.

The leaves of a part (a source) are ranked in order; the digits of a rank in base
``ARITY`` say where its leaf hangs. Leaves of one part and block, ``ARITY ** BLOCK_LEVELS``
ranks at most, are brought together by one shuffle. There the digit columns are grouped
away one after the other, last digit first: each aggregate turns the nodes that agree in
the digits left into one struct (digest, kids), so a block ends as one nested struct. As
the shuffle is by (part, block), no aggregate shuffles again. A transform walks down the
struct and gives every leaf the digests left and right of its path; an explode makes them
rows. No leaf is joined with anything: what lies above a block, the same rollup over the
digests of the blocks, meets whole blocks on (part, block), each there once, so a part of
any size is spread over its blocks.

A digest is lowercase hex sha256 of the concatenated inputs, digests as hex text. Nodes of
a part are hashed in runs of ``ARITY`` while there are several; a run of one is hashed as
well, a part of one leaf is that leaf. Subroots of the parts, null first, then by UTF-8
bytes, are hashed likewise into the root.

Defined results. A null field counts as ``-``, so it differs from an empty text. Texts are
hashed whole, however long; only digests go through shuffles. Rows of equal order are
ordered by their leaf; repeated rows are leaves of their own. A null order value comes
first, a null part is a part. Empty table: no rows. Other columns are ignored, whatever
their names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowsift.functions.ranking import range_rank
from rowsift.functions.runtime import SMALL_ROWS
from rowsift.functions.skew import skew_join
from rowsift.llm.common import let, written

ARITY = 3
#: Levels inside one block: 3 ** 7 leaves are one nested struct at most.
BLOCK_LEVELS = 7
#: Fields of a leaf of ``documents``, in the order they are hashed.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

_STEPS = "array<struct<left:string,right:string>>"


def encoded(value: Column) -> Column:
    """``-`` for null, else the value's UTF-8 bytes counted, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(fields: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*[encoded(f) for f in fields]), 256)


def folded(leaf: Column, steps: Column) -> Column:
    """The root that ``leaf`` leads to with the siblings in ``steps``."""
    return F.aggregate(steps, leaf, lambda acc, s: F.sha2(F.concat(s["left"], acc, s["right"]), 256))


def proof_digest(steps: Column) -> Column:
    """One digest of all siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(steps, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def _depth(n: Column) -> Column:
    """Levels over ``n`` nodes: the least d with ARITY ** d >= n."""
    powers, p = [], 1
    while p < 1 << 62:
        powers.append(F.when(n > F.lit(p), 1).otherwise(0))
        p *= ARITY
    return sum(powers[1:], powers[0])


def _levels(n: int) -> int:
    d = 0
    while ARITY**d < n:
        d += 1
    return d


def _rolled(nodes: DataFrame, groups: list[str], levels: int) -> DataFrame:
    """(groups..., block, n, node): one nested struct per block.

    ``nodes`` has groups..., at (rank from 0), n (nodes of the group), digest and load.
    """
    digits = [f"d{k}" for k in range(levels)]
    split = nodes.select(
        *groups,
        "n",
        F.floor(F.col("at") / F.lit(ARITY**levels)).alias("block"),
        *[F.pmod(F.floor(F.col("at") / F.lit(ARITY**k)), F.lit(ARITY)).cast("int").alias(d) for k, d in enumerate(digits)],
        F.struct("digest", "load").alias("node"),
    )
    df = split.repartition(*groups, "block")
    for level in range(1, levels + 1):
        kids = F.sort_array(F.collect_list(F.struct(F.col(digits[level - 1]).alias("d"), "node")))
        df = df.groupBy(*groups, "n", "block", *digits[level:]).agg(kids.alias("kids"))
        hashed = F.sha2(F.array_join(F.transform("kids", lambda k: k["node"]["digest"]), ""), 256)
        # above its own depth a group has one node, which goes up unchanged
        digest = F.when(_depth(F.col("n")) < level, F.col("kids")[0]["node"]["digest"]).otherwise(hashed)
        df = df.withColumn(
            "node", F.struct(digest.alias("digest"), F.transform("kids", lambda k: k["node"]).alias("kids"))
        ).drop("kids")
    return df


def _walk(node: Column, level: int, depth: Column) -> Column:
    """Leaves below ``node`` as structs (digest, load, steps), steps from the leaf upward."""
    if level == 0:
        return F.array(F.struct(node["digest"], node["load"], F.array().cast(_STEPS).alias("steps")))
    digests = F.transform(node["kids"], lambda k: k["digest"])

    def below(kid: Column, i: Column) -> Column:
        step = F.struct(
            F.array_join(F.slice(digests, F.lit(1), i), "").alias("left"),
            F.array_join(F.slice(digests, i + 2, F.lit(ARITY)), "").alias("right"),
        )
        own = F.when(depth >= level, F.array(step)).otherwise(F.array().cast(_STEPS))
        return let(
            own,
            lambda s: F.transform(
                _walk(kid, level - 1, depth),
                lambda x: F.struct(x["digest"].alias("digest"), x["load"].alias("load"), F.concat(x["steps"], s).alias("steps")),
            ),
        )

    return F.flatten(F.transform(node["kids"], below))


def _blocks(nodes: DataFrame, groups: list[str], most: int) -> tuple[DataFrame, int, DataFrame]:
    """Blocks with their nested structs, the levels in them, and (groups..., block, up, top) for each.

    ``most`` is the size of the largest group, ``up`` holds the steps above a block,
    ``top`` the digest of its group.
    """
    levels = min(BLOCK_LEVELS, _levels(most))
    blocks = written(_rolled(nodes, groups, levels), "merkle-blocks")
    above = -(-most // ARITY**levels)
    if above == 1:
        crowns = blocks.select(*groups, "block", F.array().cast(_STEPS).alias("up"), F.col("node.digest").alias("top"))
    else:
        higher = blocks.select(
            *groups,
            F.col("block").alias("at"),
            F.ceil(F.col("n") / F.lit(ARITY**levels)).alias("n"),
            F.col("node.digest").alias("digest"),
            F.struct("block").alias("load"),
        )
        crowns = _paths(*_blocks(higher, groups, above), groups).select(
            *groups, F.col("load.block").alias("block"), F.col("steps").alias("up"), "top"
        )
    return blocks, levels, written(crowns, "merkle-crowns")


def _paths(blocks: DataFrame, levels: int, crowns: DataFrame, groups: list[str]) -> DataFrame:
    """(groups..., digest, load, steps, top and what else ``crowns`` has), one row per node that was rolled up."""
    more = [c for c in crowns.columns if c not in (*groups, "block", "up")]
    return (
        blocks.join(crowns, [*groups, "block"])
        .select(*groups, "up", *more, F.explode(_walk(F.col("node"), levels, _depth(F.col("n")))).alias("leaf"))
        .select(*groups, "leaf.digest", "leaf.load", F.concat("leaf.steps", "up").alias("steps"), *more)
    )


def _attached(big: DataFrame, dim: DataFrame, key: str, sizes: DataFrame) -> DataFrame:
    """``big`` join ``dim``, one row per ``key``: broadcast when counted small, else by a salted shuffle."""
    if dim.limit(SMALL_ROWS + 1).count() <= SMALL_ROWS:
        return big.join(F.broadcast(dim), key)
    return skew_join(big, dim, [key], counts=sizes)


def manifest(rows: DataFrame, leaf: Column, part: Column, order: Column, load: Column) -> DataFrame:
    """(load, leaf, subroot, root, steps): every row's leaf with its proof.

    ``steps`` are the siblings from leaf to root, (left, right) for each level, so that
    :func:`folded` of leaf and steps is ``root``. ``load`` is a struct that is carried along.
    """
    named = rows.select(
        F.coalesce(F.concat(F.lit("v"), part), F.lit("")).alias("part"),  # sorts as asked: null first, then by bytes
        order.alias("key"),
        leaf.alias("digest"),
        load.alias("load"),
    )
    ranked = range_rank(named, [F.col("key"), F.col("digest")], ["part"], "at")
    sizes = written(ranked.groupBy("part").agg(F.count(F.lit(1)).alias("_n")), "merkle-sizes")
    most = sizes.agg(F.max("_n").alias("n"), F.count(F.lit(1)).alias("parts")).first()
    if not most["parts"]:
        empty = named.select("load", F.col("digest").alias("leaf"), F.col("digest").alias("subroot"), F.col("digest").alias("root"))
        return empty.withColumn("steps", F.array().cast(_STEPS))
    nodes = _attached(ranked, sizes.select("part", F.col("_n").alias("n")), "part", sizes).select(
        "part", (F.col("at") - 1).alias("at"), "n", "digest", "load"
    )
    blocks, levels, crowns = _blocks(nodes, ["part"], most["n"])
    subroots = crowns.groupBy("part").agg(F.first("top").alias("digest"))
    tops = range_rank(subroots, [F.col("part")], [], "at").select(
        (F.col("at") - 1).alias("at"), F.lit(most["parts"]).cast("bigint").alias("n"), "digest", F.struct("part").alias("load")
    )
    roots = _paths(*_blocks(tops, [], most["parts"]), []).select(
        F.col("load.part").alias("part"), F.col("steps").alias("last"), F.col("top").alias("root")
    )
    held = crowns.groupBy("part").agg(F.count(F.lit(1)).alias("_n"))
    full = _attached(crowns, written(roots, "merkle-roots"), "part", held)
    full = full.select("part", "block", F.concat("up", "last").alias("up"), "top", "root")
    return _paths(blocks, levels, full, ["part"]).select(
        "load", F.col("digest").alias("leaf"), F.col("top").alias("subroot"), "root", "steps"
    )


def tamper_report(docs: DataFrame) -> DataFrame:
    """The manifest of ``documents``, and which leaves still verify after line feeds went out of half of the texts.

    A row with a null doc_id is never tampered with.
    """
    fields = [F.col(f) for f in FIELDS]
    hit = (F.crc32(F.col("doc_id").cast("string")) % 2 == 0) & F.contains("text", F.lit("\n"))
    changed = leaf_digest([*fields[:-1], F.replace("text", F.lit("\n"), F.lit(""))])
    load = F.struct("doc_id", F.when(hit, changed).alias("changed"))
    proofs = manifest(docs.select(*FIELDS), leaf_digest(fields), F.col("source"), F.col("doc_id"), load)
    out = proofs.select(
        F.col("load.doc_id").alias("doc_id"),
        "leaf",
        "subroot",
        "root",
        proof_digest(F.col("steps")).alias("proof_sha256"),
        folded(F.coalesce("load.changed", "leaf"), F.col("steps")).alias("folded_root"),
    )
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
