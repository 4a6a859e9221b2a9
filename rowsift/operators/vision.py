"""Boxes and pixel masks checked against predictions that arrive as tables.

boxes: (image_id, box_id, class_id, [score], x1, y1, x2, y2)
pixels: (image_id, y, x, label, p)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowsift.functions.hashing import hash_below, hash_key, hash_uniform
from rowsift.functions.ranking import KEY_DIGITS
from rowsift.functions.runtime import checked_broadcast, materialize
from rowsift.functions.skew import skew_join

CORNERS = ("x1", "y1", "x2", "y2")
#: IoU limits: below LOW there is no match, at or above HIGH the match is good.
IOU_LOW, IOU_HIGH = 0.1, 0.5
#: Score from which an unmatched prediction counts as a missed object.
SURE = 0.5


def keep_predictions(pred: DataFrame, class_id: int | None = None, min_score: float = 0.3) -> DataFrame:
    kept = pred.filter(F.col("score") >= min_score)
    return kept if class_id is None else kept.filter(F.col("class_id") == class_id)


def clip_boxes(boxes: DataFrame, width: Column, height: Column) -> DataFrame:
    """Corners inside the image, in order, and at least one pixel apart."""
    inside = lambda c, size: F.least(F.greatest(F.col(c), F.lit(0.0)), F.greatest(size - 1, F.lit(0.0)))
    b = boxes.withColumns({c: inside(c, width if c[0] == "x" else height).cast("double") for c in CORNERS})
    b = b.withColumns(
        {
            "x1": F.least("x1", "x2"),
            "x2": F.greatest("x1", "x2"),
            "y1": F.least("y1", "y2"),
            "y2": F.greatest("y1", "y2"),
        }
    )
    return b.withColumns(
        {"x2": F.greatest(F.col("x2"), F.col("x1") + 1.0), "y2": F.greatest(F.col("y2"), F.col("y1") + 1.0)}
    )


def corrupt_boxes(
    boxes: DataFrame, images: DataFrame, seed: int = 42, reach: int = 25
) -> DataFrame:
    """Damage every image in ``images`` (image_id, width, height): half lose one
    box, the others have all boxes moved by up to ``reach`` pixels and clipped.

    The box that goes is the one of smallest hash, found by a max/min aggregate
    per image; images without boxes stay as they are.
    """
    box_key = hash_key(seed, "dropbox", "image_id", "box_id")
    lost = boxes.groupBy("image_id").agg(F.min(box_key).alias("_lost"))
    plan = images.select(
        "image_id",
        F.col("width").alias("_w"),
        F.col("height").alias("_h"),
        (hash_uniform(seed, "drop", "image_id") < 0.5).alias("_drop"),
        (hash_below(2 * reach + 1, seed, "dx", "image_id") - reach).alias("_dx"),
        (hash_below(2 * reach + 1, seed, "dy", "image_id") - reach).alias("_dy"),
    ).join(lost, "image_id")
    joined = skew_join(boxes, plan, ["image_id"], "left").filter(
        ~F.coalesce(F.col("_drop") & (box_key == F.col("_lost")), F.lit(False))
    )
    moved = F.coalesce(~F.col("_drop"), F.lit(False))
    shifted = joined.withColumns(
        {
            c: F.col(c) + F.when(moved, F.col("_dx" if c[0] == "x" else "_dy")).otherwise(0)
            for c in CORNERS
        }
    ).withColumn("_moved", moved)
    clipped = clip_boxes(shifted, F.col("_w"), F.col("_h"))
    parts = shifted.filter(~F.col("_moved")).unionByName(clipped.filter("_moved"))
    return parts.select(*boxes.columns)


def corrupt_mask(pixels: DataFrame, images: DataFrame, seed: int = 42) -> DataFrame:
    """Zero one random rectangle of every image in ``images`` (image_id, width, height).

    Adds ``was_corrupted``; an image whose mask is empty is left alone. The
    rectangle table holds one row per image and is joined on image_id.
    """
    h, w = F.col("height"), F.col("width")

    def side(size: Column, tag: str) -> Column:
        low = F.greatest(F.lit(1), F.floor(size / 10))
        high = F.greatest(F.lit(2), F.floor(size / 4))
        return low + hash_below(F.greatest(high - low, F.lit(1)), seed, tag, "image_id")

    rect = images.select("image_id", h, w, side(h, "rh").alias("_rh"), side(w, "rw").alias("_rw")).select(
        "image_id",
        "_rh",
        "_rw",
        hash_below(F.greatest(h - F.col("_rh"), F.lit(1)), seed, "y0", "image_id").alias("_y0"),
        hash_below(F.greatest(w - F.col("_rw"), F.lit(1)), seed, "x0", "image_id").alias("_x0"),
    )
    filled = pixels.groupBy("image_id").agg(F.max("label").alias("_any")).filter(F.col("_any") > 0)
    rect = rect.join(filled.select("image_id"), "image_id", "left_semi")
    joined = skew_join(pixels, rect, ["image_id"], "left")
    hit = (
        F.col("y").between(F.col("_y0"), F.col("_y0") + F.col("_rh") - 1)
        & F.col("x").between(F.col("_x0"), F.col("_x0") + F.col("_rw") - 1)
    )
    return joined.withColumn("label", F.when(F.coalesce(hit, F.lit(False)), 0).otherwise(F.col("label"))).select(
        *pixels.columns, F.col("_rh").isNotNull().alias("was_corrupted")
    )


def mask_boxes(mask: DataFrame) -> DataFrame:
    """(image_id, obj, x1, y1, x2, y2) of every object in an id mask; id 0 is background."""
    return (
        mask.filter(F.col("obj") != 0)
        .groupBy("image_id", "obj")
        .agg(F.min("x").alias("x1"), F.min("y").alias("y1"), F.max("x").alias("x2"), F.max("y").alias("y2"))
    )


#: Ratio of cell sides between neighbouring levels of the grid.
GRID_BASE = 4
#: Truth boxes of one cell beyond which the cell is dealt to several tasks.
BUSY_CELL = 2000
_GRID_KEY = ["image_id", "_kind", "_level", "_tx", "_ty"]


def _leveled(boxes: DataFrame) -> DataFrame:
    """Adds ``_level``: the least level whose cells are twice as long as the longer side of the box."""
    side = F.greatest(F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1"), F.lit(1e-9))
    return boxes.withColumn("_level", F.ceil(F.log(float(GRID_BASE), side * 2)).cast("int"))


def _cell(x: Column) -> Column:
    """Number of the cell of level ``_level`` that holds ``x``."""
    return F.floor(x / F.pow(F.lit(float(GRID_BASE)), F.col("_level")))


def _on_grid(boxes: DataFrame, others: list[int], side: str) -> DataFrame:
    """Copies of the boxes on the grid: in the cells of their own level, at most two in a row, and in the
    ancestors of these on every level above that boxes of the other side have.

    ``_kind`` says which copies may meet: truth boxes of a level ("own") meet predictions of
    the same level and ancestors of smaller predictions; ancestors of smaller truth boxes
    ("up") meet predictions of the level. So two small boxes never meet in a large cell.
    """
    level = F.col("_level")
    kind = lambda name, at: F.struct(F.lit(name).alias("_kind"), at.alias("_level"))
    larger = F.filter(F.array(*[F.lit(x) for x in others]), lambda x: x > level)
    smaller = F.lit(min(others)) < level
    if side == "t":
        copies = F.concat(F.array(kind("own", level)), F.transform(larger, lambda x: kind("up", x)))
    else:
        ancestors = F.transform(larger, lambda x: kind("own", x))
        copies = F.concat(F.array(kind("own", level)), F.when(smaller, F.array(kind("up", level))).otherwise(F.array()), ancestors)
    kept = [c for c in boxes.columns if c not in ("image_id", "_level")]
    spread = boxes.withColumn("_copy", F.explode(copies)).drop("_level").select("*", "_copy._kind", "_copy._level")
    return (
        spread.withColumn("_tx", F.explode(F.sequence(_cell(F.col("x1")), _cell(F.col("x2")))))
        .withColumn("_ty", F.explode(F.sequence(_cell(F.col("y1")), _cell(F.col("y2")))))
        .select(*_GRID_KEY, *[F.col(c).alias(f"{side}_{c}") for c in kept])
    )


def _levels_of(boxes: DataFrame) -> list[int]:
    """The levels that occur; a double has a few hundred at most."""
    return sorted(boxes.agg(F.collect_set("_level").alias("s")).first()["s"])


def box_iou(truth: DataFrame, pred: DataFrame) -> DataFrame:
    """Overlapping (truth, prediction) pairs of an image with their IoU.

    A hierarchical grid brings them together: a box lies in cells about as large as itself
    and meets boxes of other sizes in the ancestors of those cells, so it has few copies
    whatever its size and boxes that are far apart never meet. A pair is reported only by
    the cell of the corner of its intersection; busy cells are dealt to several tasks.
    Columns t_* and p_* hold the two boxes.
    """
    # read several times: for the levels, for crowded images and for the join
    truth, pred = materialize(_leveled(truth)), materialize(_leveled(pred))
    t_levels, p_levels = _levels_of(truth) or [0], _levels_of(pred) or [0]
    crowded = truth.groupBy("image_id").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= BUSY_CELL)
    crowded = checked_broadcast(crowded.select("image_id"))  # only their cells can be busy
    busy = _on_grid(truth.join(crowded, "image_id", "left_semi"), p_levels, "t")
    pairs = skew_join(
        _on_grid(truth, p_levels, "t"),
        _on_grid(pred, t_levels, "p"),
        _GRID_KEY,
        hot_rows=BUSY_CELL,
        counts=busy.groupBy(*_GRID_KEY).agg(F.count(F.lit(1)).alias("_n")),
    )
    left, top = F.greatest("t_x1", "p_x1"), F.greatest("t_y1", "p_y1")
    right, bottom = F.least("t_x2", "p_x2"), F.least("t_y2", "p_y2")
    area = lambda s: (F.col(f"{s}_x2") - F.col(f"{s}_x1")) * (F.col(f"{s}_y2") - F.col(f"{s}_y1"))
    inter = (right - left) * (bottom - top)
    return (
        pairs.filter((right > left) & (bottom > top))
        .filter((_cell(left) == F.col("_tx")) & (_cell(top) == F.col("_ty")))
        .withColumn("iou", F.round(inter / (area("t") + area("p") - inter), KEY_DIGITS))
        .drop("_kind", "_level", "_tx", "_ty")
    )


_SAME_BOX = ["image_id", "class_id", *CORNERS]


def _grouped(boxes: DataFrame, *scores: str) -> DataFrame:
    """One row per different box of an image: its number ``gid``, ``n`` copies, and id and scores of one of them."""
    groups = boxes.groupBy(*_SAME_BOX).agg(
        F.count(F.lit(1)).alias("_n"), *[F.max(c).alias(c) for c in ("box_id", *scores)]
    )
    return materialize(groups.withColumn("gid", F.monotonically_increasing_id()))


def _per_box(boxes: DataFrame, groups: DataFrame, found: DataFrame, *scores: str) -> DataFrame:
    """(image_id, box_id, scores..., columns of ``found``) of every box; copies take what their group got."""
    known = groups.join(found, "gid", "left").drop("gid")
    out = ["image_id", "box_id", *scores, *[c for c in found.columns if c != "gid"]]
    copied = known.filter("_n > 1").drop("box_id", *scores)
    counts = copied.select(*_SAME_BOX, "_n")
    return known.filter("_n = 1").select(*out).unionByName(
        skew_join(boxes, copied.drop("_n"), _SAME_BOX, counts=counts).select(*out)
    )


def box_issues(truth: DataFrame, pred: DataFrame) -> DataFrame:
    """(image_id, box_id, side, issue) for boxes that disagree.

    Truth boxes: ``missing``, ``badly_located`` or ``swapped``; predictions:
    ``overlooked``. Equal boxes of an image are matched once.
    """
    t_groups, p_groups = _grouped(truth), _grouped(pred, "score")
    slim = lambda g: g.select("image_id", "class_id", *CORNERS, "gid")
    pairs = materialize(box_iou(slim(t_groups), slim(p_groups)).select("t_gid", "p_gid", "t_class_id", "p_class_id", "iou"))
    same = F.col("t_class_id") == F.col("p_class_id")
    best = pairs.groupBy(F.col("t_gid").alias("gid")).agg(
        F.max("iou").alias("best"),
        F.max(F.when(same, F.col("iou"))).alias("best_same"),
        F.max(F.when(~same, F.col("iou"))).alias("best_other"),
    )
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    t = _per_box(truth, t_groups, best).withColumns({c: zero(c) for c in ("best", "best_same", "best_other")})
    t_issue = (
        F.when(F.col("best") < IOU_LOW, "missing")
        .when((F.col("best_other") >= IOU_HIGH) & (F.col("best_same") < IOU_HIGH), "swapped")
        .when((F.col("best_same") >= IOU_LOW) & (F.col("best_same") < IOU_HIGH), "badly_located")
    )
    seen = pairs.groupBy(F.col("p_gid").alias("gid")).agg(F.max("iou").alias("best"))
    p = _per_box(pred, p_groups, seen, "score")
    p_issue = F.when((zero("best") < IOU_LOW) & (F.col("score") >= SURE), "overlooked")
    out = t.select("image_id", "box_id", F.lit("truth").alias("side"), t_issue.alias("issue")).unionByName(
        p.select("image_id", "box_id", F.lit("prediction").alias("side"), p_issue.alias("issue"))
    )
    return out.filter("issue IS NOT NULL")


def flagged_images(issues: DataFrame) -> DataFrame:
    return issues.select("image_id").distinct()


def pixel_probs(pixels: DataFrame, masks: DataFrame, class_id: int | None = None, min_score: float = 0.3) -> DataFrame:
    """Adds ``p``: largest kept instance-mask value at the pixel, within [0, 1], else 0.

    masks: (image_id, y, x, class_id, score, m).
    """
    best = keep_predictions(masks, class_id, min_score).groupBy("image_id", "y", "x").agg(F.max("m").alias("p"))
    clip = F.least(F.greatest(F.coalesce("p", F.lit(0.0)), F.lit(0.0)), F.lit(1.0))
    return pixels.join(best, ["image_id", "y", "x"], "left").withColumn("p", clip)


def softmin_quality(
    pixels: DataFrame, temperature: float = 0.1, padded: tuple[int, int] | None = None
) -> DataFrame:
    """(image_id, quality): soft minimum of the probability of each pixel's label.

    ``padded`` = (height, width) adds the pixels missing to that size in closed
    form, as background of probability 1.
    """
    q = F.when(F.col("label") == 1, F.col("p")).otherwise(1 - F.col("p"))
    e = F.exp(-q / temperature)
    sums = pixels.groupBy("image_id").agg(
        F.sum(q * e).alias("qe"), F.sum(e).alias("e"), F.count(F.lit(1)).alias("n")
    )
    if padded:
        extra = (F.lit(padded[0] * padded[1]) - F.col("n")) * F.exp(F.lit(-1.0 / temperature))
        sums = sums.withColumns({"qe": F.col("qe") + extra, "e": F.col("e") + extra})
    return sums.select("image_id", F.round(F.col("qe") / F.col("e"), KEY_DIGITS).alias("quality"))


def worst_images(quality: DataFrame, n_corrupted: int) -> DataFrame:
    """The max(1, n_corrupted) images of lowest quality."""
    from rowsift.operators.labels import worst_rows

    return worst_rows(quality, "quality", max(1, n_corrupted), "image_id")


def image_grid(df: DataFrame, values: str, id_col: str, width: int) -> DataFrame:
    """(image_id, y, x, v): a flat array of pixel values as one row per pixel."""
    return df.select(F.col(id_col).alias("image_id"), F.posexplode(values).alias("_at", "v")).select(
        "image_id", F.floor(F.col("_at") / width).cast("int").alias("y"), F.pmod("_at", F.lit(width)).cast("int").alias("x"), "v"
    )

