"""Queries that fit models; most are iterative, so without SQL counterpart, and checked in tests."""

from __future__ import annotations

from pyspark.sql import functions as F

from rowsift.catalog import annotation, geometry, rows, tagging
from rowsift.catalog.tables import labelled_points, noisy_points, points, read, sql_key, sql_uniform
from rowsift.functions.hashing import hash_uniform
from rowsift.functions.runtime import materialize
from rowsift.operators import features, labels, models
from rowsift.operators.sampling import stratified_split
from rowsift.plans import general, tasks
from rowsift.plans.configs import (
    AnomalyConfig,
    AuditConfig,
    IssueConfig,
    MulticlassConfig,
    MultiannotatorConfig,
    MultilabelConfig,
    NoiseConfig,
    OutlierConfig,
    RegressionConfig,
    TokenConfig,
    VisionConfig,
)


def _spec(name="logistic_regression", **params):
    return models.model_spec("classification", name, **params)


def _parts(spark, sf_dir):
    """part with numeric and categorical features and the price as label."""
    p = read(spark, sf_dir, "part")
    return p.select(F.col("p_partkey").alias("row_id"), "p_size", "p_brand", "p_type", F.col("p_retailprice").alias("label"))


def _part_vectors(spark, sf_dir):
    df = _parts(spark, sf_dir)
    return features.fit_preprocessor(df, ["p_size"], ["p_brand", "p_type"]).transform(df)


def preprocess(spark, sf_dir):
    out = _part_vectors(spark, sf_dir)
    return out.select("row_id", F.posexplode("features").alias("pos", "v")).withColumn("v", F.round("v", 6))


def reduce_dimensions(spark, sf_dir):
    p = points(spark, sf_dir).select("row_id", "features")
    out = features.reduce_dimensions(p, "features", 64)
    return out.select("row_id", F.posexplode("features").alias("pos", "v")).withColumn("v", F.round("v", 6))


def oof_probs(spark, sf_dir):
    p = noisy_points(spark, sf_dir).select("row_id", "label", "features")
    out = models.out_of_fold_probs(p, _spec(), 3)
    return out.select("row_id", "label", "predicted", F.posexplode("probs").alias("k", "p"))


def oof_forest(spark, sf_dir):
    p = noisy_points(spark, sf_dir).select("row_id", "label", "features")
    out = models.out_of_fold_probs(p, _spec("random_forest"), 3)
    return out.select("row_id", "label", "predicted", F.posexplode("probs").alias("k", "p"))


def oof_deep_forest(spark, sf_dir):
    """Trees without a depth limit, grown until their leaves are pure."""
    p = noisy_points(spark, sf_dir).select("row_id", "label", "features")
    out = models.out_of_fold_probs(p, _spec("random_forest", trees=20, max_depth=None), 3, 3)
    return out.select("row_id", "label", "predicted", F.posexplode("probs").alias("k", "p"))


def oof_softmax_boosting(spark, sf_dir):
    """All classes and folds from the same passes; few, longer steps, as each pass reads the whole table."""
    p = noisy_points(spark, sf_dir).select("row_id", "label", "features")
    out = models.out_of_fold_probs(p, _spec("softmax_boosting", rounds=10, step=0.3, max_leaves=15, bins=64), 3, 3)
    return out.select("row_id", "label", "predicted", F.posexplode("probs").alias("k", "p"))


def oof_regression(spark, sf_dir):
    out = models.out_of_fold_predictions(_part_vectors(spark, sf_dir), models.model_spec("regression", "ridge"))
    return out.select("row_id", "label", "predicted")


def oof_bits(spark, sf_dir):
    df = rows._bits(spark, sf_dir)
    prep = features.fit_preprocessor(df, [], ["source"])
    ready = prep.transform(df.select("row_id", "y", "source"))
    out = models.out_of_fold_bits(ready, 3)
    return out.select("row_id", F.posexplode("p").alias("bit", "p"))


def bootstrap_quality(spark, sf_dir):
    """Numeric label quality with out-of-fold predictions and bootstrap spread."""
    out = models.out_of_fold_with_spread(_part_vectors(spark, sf_dir), models.model_spec("regression", "ridge"))
    return labels.regression_quality(out.withColumnRenamed("label", "y"))


def _two_features(spark, sf_dir):
    """part with its size and the length of its name, scaled to about one, and its price in thousands."""
    return read(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("row_id"),
        F.array(F.col("p_size") / 50.0, F.length("p_name") / 30.0).alias("features"),
        (F.col("p_retailprice") / 1000.0).alias("label"),
    )


def ridge_folds(spark, sf_dir):
    out = models.out_of_fold_predictions(_two_features(spark, sf_dir), models.model_spec("regression", "ridge"))
    return out.select("row_id", F.round("predicted", 6).alias("predicted"))


def ridge_bootstrap(spark, sf_dir):
    out = models.out_of_fold_with_spread(_two_features(spark, sf_dir), models.model_spec("regression", "ridge"), rounds=3)
    return out.select("row_id", F.round("predicted", 6).alias("predicted"), F.round("spread", 6).alias("spread"))


#: Moments of the two features and the target, and the closed form of the penalised fit on them.
_MOMENTS = ("n", "sa", "sb", "sy", "saa", "sab", "sbb", "say", "sby")
_RIDGE_SUMS = "sum({w}) AS n, sum({w} * a) AS sa, sum({w} * b) AS sb, sum({w} * y) AS sy, sum({w} * a * a) AS saa, sum({w} * a * b) AS sab, sum({w} * b * b) AS sbb, sum({w} * a * y) AS say, sum({w} * b * y) AS sby"
_RIDGE_FIT = (
    "SELECT *, my - (caa_inv * cay + cab_inv * cby) * ma - (cab_inv * cay + cbb_inv * cby) * mb AS c0, "
    "caa_inv * cay + cab_inv * cby AS ca, cab_inv * cay + cbb_inv * cby AS cb FROM (SELECT *, caa2 / det AS cbb_inv, cbb2 / det AS caa_inv, -cab / det AS cab_inv "
    "FROM (SELECT *, caa2 * cbb2 - cab * cab AS det FROM (SELECT *, sa / n AS ma, sb / n AS mb, sy / n AS my, saa - sa * sa / n + 1 AS caa2, sbb - sb * sb / n + 1 AS cbb2, "
    "sab - sa * sb / n AS cab, say - sa * sy / n AS cay, sby - sb * sy / n AS cby FROM {sums})))"
)
_SQL_TWO = (
    "two AS (SELECT p_partkey AS row_id, p_size / 50.0::DOUBLE AS a, length(p_name) / 30.0::DOUBLE AS b, p_retailprice / 1000.0::DOUBLE AS y FROM part), "
    f"fd AS (SELECT *, ntile(5) OVER (ORDER BY {sql_key(42, 'fold', 'row_id')}) - 1 AS fold FROM two), "
    f"per AS (SELECT fold, {_RIDGE_SUMS.format(w='1')} FROM fd GROUP BY fold), "
    f"left_out AS (SELECT p.fold, {', '.join(f'any_value(t.{m}) - any_value(p.{m}) AS {m}' for m in _MOMENTS)} FROM per p, "
    f"(SELECT {', '.join(f'sum({m}) AS {m}' for m in _MOMENTS)} FROM per) t GROUP BY p.fold), "
    f"fits AS ({_RIDGE_FIT.format(sums='left_out')}), "
    "oof AS (SELECT row_id, a, b, c0 + ca * a + cb * b AS predicted FROM fd JOIN fits USING (fold))"
)


def _sql_poisson1(seed: int) -> str:
    """Poisson(1) by inverting its distribution on a hashed uniform."""
    u, steps, term, total = sql_uniform(seed, "bootstrap", "row_id"), [], 0.36787944117144233, 0.0
    for k in range(12):
        total += term
        steps.append(f"CAST({u} >= {total!r}::DOUBLE AS INTEGER)")
        term /= k + 1
    return "(" + " + ".join(steps) + ")"


def variants(spark, sf_dir):
    """Baseline against pruned and clean-learned training sets."""
    df = stratified_split(noisy_points(spark, sf_dir), "label")
    df = materialize(df.select("row_id", "features", "label", "is_test"))
    train, test = df.filter("NOT is_test").drop("is_test"), df.filter("is_test").drop("is_test")
    spec = _spec("knn")
    base = models.fit_and_score("baseline", spec, train, test, 3)
    oof = materialize(models.out_of_fold_probs(train, spec, 3).select("row_id", "label", "probs"))
    bad = labels.worst_rows(labels.flag_label_issues(oof, 3), "score", labels.prune_size(train.count(), 0.1))
    pruned = models.fit_and_score("pruned_retrain", spec, labels.prune(train, materialize(bad)), test, 3)
    return models.variant_delta(base.unionByName(pruned))


def clean_learning(spark, sf_dir):
    df = stratified_split(noisy_points(spark, sf_dir), "label").select("row_id", "features", "label", "is_test")
    df = materialize(df)
    m, _ = models.clean_learning(df.filter("NOT is_test").drop("is_test"), df.filter("is_test").drop("is_test"), _spec(), 3)
    return m


def model_sweep(spark, sf_dir):
    df = materialize(stratified_split(labelled_points(spark, sf_dir), "label"))
    specs = [
        _spec(),
        _spec("random_forest"),
        _spec("hist_gradient_boosting"),
        _spec("knn"),
    ]
    m, errors = models.sweep(specs, df.filter("NOT is_test").drop("is_test"), df.filter("is_test").drop("is_test"), 3)
    if errors:  # rows of the other models alone would look like the whole sweep
        raise RuntimeError(f"models failed: {errors}")
    return m


def audit_run(spark, sf_dir):
    """The general run on documents: language from source and size, with planted label noise."""
    docs = read(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("row_id"), "source", "n_chars",
        F.size(F.split("text", r"\s+")).alias("n_words"),
        (F.size(F.split("text", "[èéêàùç]")) - 1).alias("n_grave"),
        (F.size(F.split("text", "[äöüß]")) - 1).alias("n_umlaut"),
        (F.size(F.split("text", "[ñóíá¿]")) - 1).alias("n_acute"),
        "lang",
    )
    config = AuditConfig(
        model="logistic_regression",
        issues=IssueConfig(prune_fraction=0.05),
        noise=NoiseConfig(label_noise_fraction=0.05),
    )
    return general.run_audit(docs, "lang", config).summary_rows(spark)


def multiclass_run(spark, sf_dir):
    out = tasks.run_multiclass(labelled_points(spark, sf_dir), MulticlassConfig(noise_frac=0.1, prune_frac=0.1))
    return out.summary_rows(spark)


#: Labels of the multi-label run: the signs of so many sums that cover the whole vector.
BITS = 6


def multilabel_run(spark, sf_dir):
    p = labelled_points(spark, sf_dir)
    ends = [round(64 * (i + 1) / BITS) for i in range(BITS)]
    parts = [F.slice("features", a + 1, b - a) for a, b in zip([0, *ends], ends, strict=False)]
    y = F.array(*[(F.aggregate(x, F.lit(0.0), lambda a, v: a + v) > 0).cast("int") for x in parts])
    out = tasks.run_multilabel(p.select("row_id", "features", y.alias("y")), BITS, MultilabelConfig(noise_frac=0.1))
    return out.summary_rows(spark)


def token_run(spark, sf_dir):
    """Half of the documents train the tagger, the other half score it; whole texts."""
    t = tagging.tokens(spark, sf_dir)
    half = hash_uniform(1, "half", "sent_id") < 0.5
    config = TokenConfig(max_train_sentences=None, noise_frac=0.05)
    return tasks.run_token(t.filter(half), t.filter(~half), config).summary_rows(spark)


def regression_run(spark, sf_dir):
    config = RegressionConfig(model="ridge", noise_frac=0.05, prune_frac=0.05)
    return tasks.run_regression(_part_vectors(spark, sf_dir), config).summary_rows(spark)


def outlier_run(spark, sf_dir):
    p = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("row_id"), "c_acctbal", F.col("c_nationkey").cast("double").alias("nation"))
    return tasks.run_outlier(p, ["c_acctbal", "nation"], OutlierConfig(outlier_frac=0.02)).summary_rows(spark)


def multiannotator_run(spark, sf_dir):
    ann = annotation._raw(spark, sf_dir).withColumn("label", F.regexp_replace("label", "big_", ""))
    stats = read(spark, sf_dir, "events").groupBy(F.get_json_object("props", "$.k").cast("bigint").alias("example_id")).agg(
        F.avg("value").alias("m"), F.stddev_pop("value").alias("s"), F.max("value").alias("x")
    )
    feats = stats.select("example_id", F.array("m", "s", "x").alias("features"))
    return tasks.run_multiannotator(ann, feats, MultiannotatorConfig()).summary_rows(spark)


def vision_run(spark, sf_dir):
    """Boxes and 8 x 8 masks of the embeddings; every image is used."""
    pixels = geometry._pixels(spark, sf_dir)
    images = read(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("image_id"), F.lit(8).alias("width"), F.lit(8).alias("height"))
    boxes = geometry.mask_boxes(spark, sf_dir).select(
        "image_id", F.col("obj").cast("bigint").alias("box_id"), F.lit(0).alias("class_id"),
        *[F.col(c).cast("double").alias(c) for c in ("x1", "y1", "x2", "y2")],
    )
    pred = boxes.withColumn("score", hash_uniform(2, "score", "image_id", "box_id"))
    masks = pixels.select("image_id", "y", "x", F.lit(0).alias("class_id"), F.lit(0.9).alias("score"), F.col("p").alias("m"))
    config = VisionConfig(corrupt_frac=0.2)
    return tasks.run_vision(images, boxes, pred, pixels.drop("p"), masks, 0, config).summary_rows(spark)


def anomaly_run(spark, sf_dir):
    from rowsift.catalog.graph import _injected

    df = _injected(spark, sf_dir).select("row_id", "features", F.col("was_corrupted").cast("int").alias("ground_truth"))
    return tasks.run_anomaly(df, AnomalyConfig(strategy="ensemble", contamination=0.05)).summary_rows(spark)


QUERIES = {
    "preprocess": preprocess,
    "reduce_dimensions": reduce_dimensions,
    "oof_probs": oof_probs,
    "oof_forest": oof_forest,
    "oof_deep_forest": oof_deep_forest,
    "oof_softmax_boosting": oof_softmax_boosting,
    "oof_regression": oof_regression,
    "oof_bits": oof_bits,
    "bootstrap_quality": bootstrap_quality,
    "ridge_folds": ridge_folds,
    "ridge_bootstrap": ridge_bootstrap,
    "variants": variants,
    "clean_learning": clean_learning,
    "model_sweep": model_sweep,
    "audit_run": audit_run,
    "multiclass_run": multiclass_run,
    "multilabel_run": multilabel_run,
    "token_run": token_run,
    "regression_run": regression_run,
    "outlier_run": outlier_run,
    "multiannotator_run": multiannotator_run,
    "vision_run": vision_run,
    "anomaly_run": anomaly_run,
}
ORACLE: dict[str, str] = {
    "ridge_folds": f"WITH {_SQL_TWO} SELECT row_id, round(predicted, 6) AS predicted FROM oof",
    "ridge_bootstrap": (
        f"WITH {_SQL_TWO}, "
        + ", ".join(f"w{i} AS (SELECT *, {_sql_poisson1(42 + i)} AS w FROM two), s{i} AS (SELECT {_RIDGE_SUMS.format(w='w')} FROM w{i}), f{i} AS ({_RIDGE_FIT.format(sums=f's{i}')})" for i in range(3))
        + ", each AS (SELECT row_id, predicted, unnest(["
        + ", ".join(f"(SELECT c0 FROM f{i}) + (SELECT ca FROM f{i}) * a + (SELECT cb FROM f{i}) * b" for i in range(3))
        + "]) AS v FROM oof) SELECT row_id, round(any_value(predicted), 6) AS predicted, round(stddev_pop(v), 6) AS spread FROM each GROUP BY row_id"
    ),
    "preprocess": (
        "WITH m AS (SELECT avg(p_size) AS a, stddev_pop(p_size) AS s FROM part), "
        "b AS (SELECT p_brand AS v, row_number() OVER (ORDER BY p_brand) AS k FROM (SELECT DISTINCT p_brand FROM part)), "
        "t AS (SELECT p_type AS v, row_number() OVER (ORDER BY count(*) DESC, p_type) AS r, count(*) OVER () AS total FROM part GROUP BY p_type), "
        "kept AS (SELECT v, row_number() OVER (ORDER BY v) AS k FROM t WHERE total <= 100 OR r <= 99), "
        "n AS (SELECT (SELECT count(*) FROM b) AS nb, (SELECT count(*) FROM kept) AS nt, (SELECT max(total) > 100 FROM t) AS pooled), "
        "slot AS (SELECT unnest(range(1 + nb + nt + CAST(pooled AS INTEGER))) AS pos FROM n) "
        "SELECT p_partkey AS row_id, CAST(pos AS INTEGER) AS pos, round(CAST(CASE WHEN pos = 0 THEN (p_size - a) / s "
        "WHEN pos <= nb THEN CAST(b.k = pos AS INTEGER) WHEN pos <= nb + nt THEN CAST(coalesce(kept.k = pos - nb, FALSE) AS INTEGER) "
        "ELSE CAST(kept.k IS NULL AS INTEGER) END AS DOUBLE), 6) AS v "
        "FROM part CROSS JOIN m CROSS JOIN n CROSS JOIN slot JOIN b ON b.v = p_brand LEFT JOIN kept ON kept.v = p_type"
    ),
}
