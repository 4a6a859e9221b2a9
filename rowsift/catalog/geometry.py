"""Queries on boxes (from lineitem) and pixel masks (embeddings as 8 x 8 images)."""

from __future__ import annotations

from pyspark.sql import functions as F

from rowsift.catalog.tables import read, sql_key, sql_pick, sql_uniform, sql_word
from rowsift.functions.hashing import hash_below, hash_key, hash_uniform
from rowsift.functions.ranking import pick_smallest
from rowsift.functions.runtime import materialize, spread
from rowsift.operators import metrics, vision

WIDTH, HEIGHT = 640, 480
FRAC = 0.2


def _truth(spark, sf_dir):
    line = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity")
    line = spread(line, "l_orderkey")
    x1 = (F.col("l_partkey") * 37 % 560).cast("double")
    y1 = (F.col("l_suppkey") * 53 % 400).cast("double")
    return line.select(
        F.col("l_orderkey").alias("image_id"),
        (F.col("l_partkey") * 1_000_000 + F.col("l_suppkey") * 10 + F.col("l_linenumber")).alias("box_id"),
        (F.col("l_linenumber") % 3).cast("int").alias("class_id"),
        x1.alias("x1"),
        y1.alias("y1"),
        (x1 + 20 + F.col("l_quantity")).alias("x2"),
        (y1 + 20 + F.col("l_linenumber") * 5).alias("y2"),
    )


_SQL_TRUTH = (
    "tb AS (SELECT l_orderkey AS image_id, l_partkey * 1000000 + l_suppkey * 10 + l_linenumber AS box_id, "
    "CAST(l_linenumber % 3 AS INTEGER) AS class_id, (l_partkey * 37 % 560)::DOUBLE AS x1, (l_suppkey * 53 % 400)::DOUBLE AS y1, "
    "(l_partkey * 37 % 560)::DOUBLE + 20 + l_quantity AS x2, (l_suppkey * 53 % 400)::DOUBLE + 20 + l_linenumber * 5 AS y2 FROM lineitem)"
)
_ID = ("image_id", "box_id")


def _predictions(truth):
    """Truth boxes moved a little; one in ten lost, one in ten of another class."""
    u = hash_uniform(5, "fate", *_ID)
    dx, dy = hash_below(21, 5, "dx", *_ID) - 10, hash_below(21, 5, "dy", *_ID) - 10
    return truth.filter(u >= 0.1).select(
        "image_id",
        "box_id",
        F.when(u >= 0.9, (F.col("class_id") + 1) % 3).otherwise(F.col("class_id")).cast("int").alias("class_id"),
        F.round(hash_uniform(5, "score", *_ID), 6).alias("score"),
        (F.col("x1") + dx).alias("x1"),
        (F.col("y1") + dy).alias("y1"),
        (F.col("x2") + dx).alias("x2"),
        (F.col("y2") + dy).alias("y2"),
    )


_U = sql_uniform(5, "fate", *_ID)
_DX = f"({sql_word(5, 'dx', *_ID)} % 21 - 10)"
_DY = f"({sql_word(5, 'dy', *_ID)} % 21 - 10)"
_SQL_PRED = (
    f"pb AS (SELECT image_id, box_id, CAST(CASE WHEN {_U} >= 0.9 THEN (class_id + 1) % 3 ELSE class_id END AS INTEGER) AS class_id, "
    f"round({sql_uniform(5, 'score', *_ID)}, 6) AS score, x1 + {_DX} AS x1, y1 + {_DY} AS y1, x2 + {_DX} AS x2, y2 + {_DY} AS y2 "
    f"FROM tb WHERE {_U} >= 0.1)"
)


def _kept(spark, sf_dir):
    truth = _truth(spark, sf_dir)
    return truth, vision.keep_predictions(_predictions(truth), None, 0.3)


def clip_boxes(spark, sf_dir):
    shift = hash_below(401, 9, "shift", *_ID) - 200
    moved = _truth(spark, sf_dir).withColumns({c: F.col(c) + shift for c in vision.CORNERS})
    return vision.clip_boxes(moved, F.lit(WIDTH), F.lit(HEIGHT))


def _images(truth):
    """Every image, a fifth of them chosen for damage."""
    ids = truth.select("image_id").distinct()
    chosen = pick_smallest(ids, hash_key(42, "image", "image_id"), lambda s: {(): round(FRAC * s[()])})
    return chosen.withColumns({"width": F.lit(WIDTH), "height": F.lit(HEIGHT)})


def _damaged(truth):
    images = materialize(_images(truth))
    return vision.corrupt_boxes(truth, images.filter("picked").drop("picked")), images


def corrupt_boxes(spark, sf_dir):
    return _damaged(_truth(spark, sf_dir))[0]


def box_iou(spark, sf_dir):
    truth, pred = _kept(spark, sf_dir)
    out = vision.box_iou(truth, pred)
    return out.select("image_id", "t_box_id", "p_box_id", F.round("iou", 6).alias("iou"))


def box_issues(spark, sf_dir):
    truth, pred = _kept(spark, sf_dir)
    return vision.box_issues(truth, pred)


def box_quality(spark, sf_dir):
    truth, pred = _kept(spark, sf_dir)
    damaged, images = _damaged(truth)
    flagged = vision.flagged_images(vision.box_issues(damaged, pred))
    q = metrics.set_quality(flagged, images.filter("picked"), ("image_id",))
    return q.withColumns({c: F.round(c, 6) for c in ("precision", "recall")})


_SQL_IMAGES = (
    "im0 AS (SELECT DISTINCT image_id FROM tb), im AS ("
    + sql_pick("im0", sql_key(42, "image", "image_id"), f"CAST(round_even({FRAC} * {{n}}, 0) AS BIGINT)", "picked")
    + ")"
)


def _sql_clip(corner: str, size: int, value: str) -> str:
    return f"least(greatest({value}, 0.0), {size - 1}.0) AS {corner}"


def _sql_ordered(table: str) -> str:
    """Corner order and one-pixel minimum over a table with clipped corners."""
    return (
        f"SELECT * REPLACE (greatest(x2, x1 + 1.0) AS x2, greatest(y2, y1 + 1.0) AS y2) FROM (SELECT * REPLACE "
        f"(least(x1, x2) AS x1, greatest(x1, x2) AS x2, least(y1, y2) AS y1, greatest(y1, y2) AS y2) FROM {table})"
    )


_SQL_DAMAGED = (
    _SQL_IMAGES
    + f", lost AS (SELECT image_id, min({sql_key(42, 'dropbox', *_ID)}) AS lost FROM tb GROUP BY image_id), "
    f"plan AS (SELECT image_id, {sql_uniform(42, 'drop', 'image_id')} < 0.5 AS dropit, {sql_word(42, 'dx', 'image_id')} % 51 - 25 AS dx, "
    f"{sql_word(42, 'dy', 'image_id')} % 51 - 25 AS dy, lost FROM im JOIN lost USING (image_id) WHERE picked), "
    f"jn AS (SELECT tb.*, dropit, dx, dy FROM tb LEFT JOIN plan USING (image_id) WHERE NOT coalesce(dropit AND {sql_key(42, 'dropbox', *_ID)} = lost, false)), "
    "mv AS (SELECT image_id, box_id, class_id, "
    + ", ".join(
        _sql_clip(c, WIDTH if c[0] == "x" else HEIGHT, f"{c} + {'dx' if c[0] == 'x' else 'dy'}") for c in vision.CORNERS
    )
    + " FROM jn WHERE NOT coalesce(dropit, true)), "
    "db AS (SELECT image_id, box_id, class_id, x1, y1, x2, y2 FROM jn WHERE coalesce(dropit, true) UNION ALL "
    + _sql_ordered("mv")
    + ")"
)


def _sql_pairs(truth: str) -> str:
    return (
        f"kp AS (SELECT * FROM pb WHERE score >= 0.3), pr AS (SELECT *, round(w * h / ((tx2 - tx1) * (ty2 - ty1) + (px2 - px1) * (py2 - py1) - w * h), 9) AS iou FROM ("
        "SELECT t.image_id, t.box_id AS t_box_id, p.box_id AS p_box_id, t.class_id AS tc, p.class_id AS pc, "
        "t.x1 AS tx1, t.y1 AS ty1, t.x2 AS tx2, t.y2 AS ty2, p.x1 AS px1, p.y1 AS py1, p.x2 AS px2, p.y2 AS py2, "
        "least(t.x2, p.x2) - greatest(t.x1, p.x1) AS w, least(t.y2, p.y2) - greatest(t.y1, p.y1) AS h "
        f"FROM {truth} t JOIN kp p USING (image_id)) WHERE w > 0 AND h > 0)"
    )


def _sql_issues(truth: str) -> str:
    return (
        _sql_pairs(truth)
        + ", bt AS (SELECT image_id, t_box_id, max(iou) AS b, max(iou) FILTER (WHERE tc = pc) AS bs, max(iou) FILTER (WHERE tc <> pc) AS bo FROM pr GROUP BY ALL), "
        "bp AS (SELECT image_id, p_box_id, max(iou) AS b FROM pr GROUP BY ALL), "
        "iss AS (SELECT image_id, box_id, 'truth' AS side, CASE WHEN coalesce(b, 0) < 0.1 THEN 'missing' "
        "WHEN coalesce(bo, 0) >= 0.5 AND coalesce(bs, 0) < 0.5 THEN 'swapped' "
        "WHEN coalesce(bs, 0) >= 0.1 AND coalesce(bs, 0) < 0.5 THEN 'badly_located' END AS issue "
        f"FROM {truth} t LEFT JOIN bt ON bt.image_id = t.image_id AND bt.t_box_id = t.box_id UNION ALL "
        "SELECT kp.image_id, box_id, 'prediction', CASE WHEN coalesce(b, 0) < 0.1 AND score >= 0.5 THEN 'overlooked' END "
        "FROM kp LEFT JOIN bp ON bp.image_id = kp.image_id AND bp.p_box_id = kp.box_id)"
    ).replace("SELECT image_id, box_id, 'truth'", "SELECT t.image_id, t.box_id, 'truth'")


# -- pixels ------------------------------------------------------------------

SIDE = 8


def _grid(spark, sf_dir):
    return vision.image_grid(read(spark, sf_dir, "embeddings").withColumn("e", F.col("embedding").cast("array<double>")), "e", "vec_id", SIDE)


def _pixels(spark, sf_dir):
    return _grid(spark, sf_dir).select(
        "image_id", "y", "x", (F.col("v") > 0).cast("int").alias("label"), F.round(1 / (1 + F.exp(-20 * F.col("v"))), 9).alias("p")
    )


_SQL_PIXELS = (
    "g0 AS (SELECT vec_id AS image_id, unnest(range(64)) AS slot, unnest(CAST(embedding AS DOUBLE[])) AS v FROM embeddings), "
    "grid AS (SELECT image_id, CAST(slot // 8 AS INTEGER) AS y, CAST(slot % 8 AS INTEGER) AS x, v FROM g0), "
    "px AS (SELECT image_id, y, x, CAST(v > 0 AS INTEGER) AS label, round(1 / (1 + exp(-20 * v)), 9) AS p FROM grid)"
)


def _damaged_pixels(spark, sf_dir):
    pixels = _pixels(spark, sf_dir)
    ids = read(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("image_id"))
    chosen = pick_smallest(ids, hash_key(42, "mask", "image_id"), lambda s: {(): round(FRAC * s[()])}).filter("picked")
    images = chosen.select("image_id", F.lit(SIDE).alias("width"), F.lit(SIDE).alias("height"))
    return vision.corrupt_mask(pixels, images)


_SQL_DAMAGED_PIXELS = (
    _SQL_PIXELS
    + ", mi0 AS (SELECT vec_id AS image_id FROM embeddings), mi AS ("
    + sql_pick("mi0", sql_key(42, "mask", "image_id"), f"CAST(round_even({FRAC} * {{n}}, 0) AS BIGINT)", "picked")
    + f"), sz AS (SELECT image_id, 1 + {sql_word(42, 'rh', 'image_id')} % 1 AS rh, 1 + {sql_word(42, 'rw', 'image_id')} % 1 AS rw FROM mi "
    "WHERE picked AND image_id IN (SELECT image_id FROM px WHERE label > 0)), "
    f"rc AS (SELECT *, {sql_word(42, 'y0', 'image_id')} % (8 - rh) AS y0, {sql_word(42, 'x0', 'image_id')} % (8 - rw) AS x0 FROM sz), "
    "dp AS (SELECT px.image_id, y, x, CASE WHEN y BETWEEN y0 AND y0 + rh - 1 AND x BETWEEN x0 AND x0 + rw - 1 THEN 0 ELSE label END AS label, p, "
    "rh IS NOT NULL AS was_corrupted FROM px LEFT JOIN rc USING (image_id)), "
    "sm AS (SELECT image_id, bool_or(was_corrupted) AS was_corrupted, round(sum(q * exp(-q / 0.1)) / sum(exp(-q / 0.1)), 9) AS quality FROM "
    "(SELECT *, CASE WHEN label = 1 THEN p ELSE 1 - p END AS q FROM dp) GROUP BY image_id)"
)


def mask_boxes(spark, sf_dir):
    obj = F.when(F.col("v") > 0.1, 1).when(F.col("v") < -0.1, 2).otherwise(0)
    return vision.mask_boxes(_grid(spark, sf_dir).select("image_id", "y", "x", obj.alias("obj")))


def corrupt_mask(spark, sf_dir):
    return _damaged_pixels(spark, sf_dir)


def pixel_probs(spark, sf_dir):
    """Two instance masks per image, from the positive and the negative values."""
    grid = _grid(spark, sf_dir)
    masks = None
    for name, sign in (("a", 1.0), ("b", -1.0)):
        one = grid.filter(F.col("v") * sign > 0).select(
            "image_id",
            "y",
            "x",
            F.when(hash_uniform(3, f"class{name}", "image_id") < 0.8, 1).otherwise(2).alias("class_id"),
            hash_uniform(3, f"score{name}", "image_id").alias("score"),
            (F.col("v") * (sign * 5)).alias("m"),
        )
        masks = one if masks is None else masks.unionByName(one)
    out = vision.pixel_probs(grid.select("image_id", "y", "x"), masks, class_id=1, min_score=0.3)
    return out.withColumn("p", F.round("p", 6))


def softmin_quality(spark, sf_dir):
    out = vision.softmin_quality(_damaged_pixels(spark, sf_dir))
    return out.withColumn("quality", F.round("quality", 6))


def softmin_padded(spark, sf_dir):
    """Quality of the 8 x 8 masks padded to 10 x 10."""
    out = vision.softmin_quality(_damaged_pixels(spark, sf_dir), padded=(10, 10))
    return out.withColumn("quality", F.round("quality", 6))


def softmin_topk(spark, sf_dir):
    pixels = materialize(_damaged_pixels(spark, sf_dir))
    bad = pixels.filter("was_corrupted").select("image_id").distinct()
    worst = vision.worst_images(vision.softmin_quality(pixels), bad.count())
    q = metrics.set_quality(worst, bad, ("image_id",))
    return q.withColumns({c: F.round(c, 6) for c in ("precision", "recall")})


def _sql_sets(found: str, true: str) -> str:
    return (
        f"c AS (SELECT (SELECT count(*) FROM {found}) AS n_found, (SELECT count(*) FROM {true}) AS n_true, "
        f"(SELECT count(*) FROM {found} WHERE image_id IN (SELECT image_id FROM {true})) AS n_hit) "
        "SELECT *, round(CASE WHEN n_found > 0 THEN n_hit / n_found::DOUBLE ELSE 0 END, 6) AS precision, "
        "round(CASE WHEN n_true > 0 THEN n_hit / n_true::DOUBLE ELSE 0 END, 6) AS recall FROM c"
    )


QUERIES = {
    "clip_boxes": clip_boxes,
    "corrupt_boxes": corrupt_boxes,
    "box_iou": box_iou,
    "box_issues": box_issues,
    "box_quality": box_quality,
    "mask_boxes": mask_boxes,
    "corrupt_mask": corrupt_mask,
    "pixel_probs": pixel_probs,
    "softmin_quality": softmin_quality,
    "softmin_padded": softmin_padded,
    "softmin_topk": softmin_topk,
}

_SHIFT = f"({sql_word(9, 'shift', *_ID)} % 401 - 200)"

ORACLE = {
    "clip_boxes": (
        f"WITH {_SQL_TRUTH}, cl AS (SELECT image_id, box_id, class_id, "
        + ", ".join(_sql_clip(c, WIDTH if c[0] == "x" else HEIGHT, f"{c} + {_SHIFT}") for c in vision.CORNERS)
        + f" FROM tb) {_sql_ordered('cl')}"
    ),
    "corrupt_boxes": f"WITH {_SQL_TRUTH}, {_SQL_DAMAGED} SELECT * FROM db",
    "box_iou": f"WITH {_SQL_TRUTH}, {_SQL_PRED}, {_sql_pairs('tb')} SELECT image_id, t_box_id, p_box_id, round(iou, 6) AS iou FROM pr",
    "box_issues": f"WITH {_SQL_TRUTH}, {_SQL_PRED}, {_sql_issues('tb')} SELECT * FROM iss WHERE issue IS NOT NULL",
    "box_quality": (
        f"WITH {_SQL_TRUTH}, {_SQL_PRED}, {_SQL_DAMAGED}, {_sql_issues('db')}, "
        "fo AS (SELECT DISTINCT image_id FROM iss WHERE issue IS NOT NULL), tr AS (SELECT image_id FROM im WHERE picked), "
        + _sql_sets("fo", "tr")
    ),
    "mask_boxes": (
        f"WITH {_SQL_PIXELS} SELECT image_id, CAST(obj AS INTEGER) AS obj, min(x) AS x1, min(y) AS y1, max(x) AS x2, max(y) AS y2 FROM "
        "(SELECT *, CASE WHEN v > 0.1 THEN 1 WHEN v < -0.1 THEN 2 ELSE 0 END AS obj FROM grid) WHERE obj <> 0 GROUP BY image_id, obj"
    ),
    "corrupt_mask": f"WITH {_SQL_DAMAGED_PIXELS} SELECT image_id, y, x, CAST(label AS INTEGER) AS label, p, was_corrupted FROM dp",
    "pixel_probs": (
        f"WITH {_SQL_PIXELS}, mk AS ("
        + " UNION ALL ".join(
            f"SELECT image_id, y, x, {sql_uniform(3, 'class' + n, 'image_id')} < 0.8 AS keep, {sql_uniform(3, 'score' + n, 'image_id')} AS score, "
            f"v * {5 * s} AS m FROM grid WHERE v * {s} > 0"
            for n, s in (("a", 1), ("b", -1))
        )
        + "), bs AS (SELECT image_id, y, x, max(m) AS m FROM mk WHERE keep AND score >= 0.3 GROUP BY ALL) "
        "SELECT image_id, y, x, round(least(greatest(coalesce(m, 0.0), 0.0), 1.0), 6) AS p FROM grid LEFT JOIN bs USING (image_id, y, x)"
    ),
    "softmin_quality": f"WITH {_SQL_DAMAGED_PIXELS} SELECT image_id, round(quality, 6) AS quality FROM sm",
    "softmin_padded": (
        f"WITH {_SQL_DAMAGED_PIXELS} SELECT image_id, round((sum(q * exp(-q / 0.1)) + (100 - count(*)) * exp(-10.0)) / "
        "(sum(exp(-q / 0.1)) + (100 - count(*)) * exp(-10.0)), 6) AS quality FROM "
        "(SELECT image_id, CASE WHEN label = 1 THEN p ELSE 1 - p END AS q FROM dp) GROUP BY image_id"
    ),
    "softmin_topk": (
        f"WITH {_SQL_DAMAGED_PIXELS}, tr AS (SELECT image_id FROM sm WHERE was_corrupted), "
        "fo AS (SELECT image_id FROM sm QUALIFY row_number() OVER (ORDER BY quality, image_id) <= greatest(1, (SELECT count(*) FROM tr))), "
        + _sql_sets("fo", "tr")
    ),
}
