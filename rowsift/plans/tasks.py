"""The task flows: plant noise, find it, prune, refit, compare.

Inputs are operator-shaped frames (see each function). Results carry scalars in
``summary``, scores of both models in ``metrics`` and row lists in ``frames``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowsift.functions.hashing import hash_key
from rowsift.functions.ranking import exact_percentile, pick_smallest
from rowsift.functions.runtime import materialize, row_count
from rowsift.operators import annotators, anomaly, audit, corruption, labels, metrics, models, vision
from rowsift.operators.features import (
    fit_array_scaler,
    hashed_token_vector,
    label_codes,
    encode,
    standardize_array,
    token_features,
)
from rowsift.operators.knn import knn_edges
from rowsift.operators.sampling import (
    drop_rows,
    kfold,
    kfold_group,
    plain_split,
    sample_cap,
    stratified_split,
    usable_folds,
)
from rowsift.operators.vocabulary import fit_token_dictionary
from rowsift.plans.configs import (
    AnomalyConfig,
    MulticlassConfig,
    MultiannotatorConfig,
    MultilabelConfig,
    OutlierConfig,
    RegressionConfig,
    TokenConfig,
    VisionConfig,
)
from rowsift.plans.results import RunOutput


def _width(df: DataFrame, features: str = "features") -> int:
    return df.select(F.size(features).alias("d")).first()["d"]


def _scaler(df: DataFrame) -> models.Featurizer:
    width = _width(df)
    return lambda train: fit_array_scaler(train, "features", width)


def _halves(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    split = materialize(df)
    return split.filter("NOT is_test").drop("is_test"), split.filter("is_test").drop("is_test")


def _against_planted(bad: DataFrame, train: DataFrame, keys=("row_id",)) -> dict[str, object]:
    q = metrics.set_quality(bad, train.filter(corruption.FLAG), keys).first()
    return {
        "n_pruned": q["n_found"],
        "n_planted": q["n_true"],
        "precision_at_prune": q["precision"],
        "recall_at_prune": q["recall"],
    }


def run_multiclass(df: DataFrame, config: MulticlassConfig = MulticlassConfig()) -> RunOutput:
    """df: (row_id, features, label); labels of any type are coded first."""
    codes = label_codes(df, "label")
    n_classes = codes.count()
    coded = encode(df, "label", codes).withColumn("label", F.col("code")).drop("code")
    train, test = _halves(stratified_split(coded, "label", config.test_size, seed=config.seed))
    train = materialize(corruption.flip_labels(train, "label", config.noise_frac, seed=config.seed))
    rows = train.select("row_id", "features", "label")
    spec = models.model_spec("classification", "logistic_regression", config.seed, max_iter=config.max_iter)
    scale = _scaler(rows)
    scores = models.fit_and_score("baseline", spec, rows, test, n_classes, scale)
    oof = models.out_of_fold_probs(rows, spec, n_classes, config.cv_folds, config.seed, scale)
    issues = materialize(labels.flag_label_issues(materialize(oof.select("row_id", "label", "probs")), n_classes))
    n_train, n_issues = row_count(rows), row_count(issues)
    bad = labels.worst_rows(issues, "score", min(n_issues, labels.prune_size(n_train, config.prune_frac)))
    bad = materialize(bad)
    scores = scores.unionByName(
        models.fit_and_score("pruned_retrain", spec, labels.prune(rows, bad), test, n_classes, scale)
    )
    summary = {
        "n_train": n_train,
        "n_test": row_count(test),
        "n_classes": n_classes,
        "n_issues_found": n_issues,
        **_against_planted(bad, train),
    }
    return RunOutput(summary, materialize(scores), {"issues": issues, "pruned": bad})


def run_multilabel(df: DataFrame, n_bits: int, config: MultilabelConfig = MultilabelConfig()) -> RunOutput:
    """df: (row_id, features, y ARRAY<INT>)."""
    train, test = _halves(plain_split(df, config.test_size, seed=config.seed))
    train = materialize(corruption.flip_bits(train, "y", n_bits, config.noise_frac, seed=config.seed))
    rows = train.select("row_id", "features", "y")
    scale = _scaler(rows)

    def scored(variant: str, part: DataFrame) -> DataFrame:
        ready = scale(part)
        out = materialize(models.fit_binary_relevance(ready(part), n_bits)(ready(test)))
        return metrics.multilabel_metrics(out, "y", "yhat", n_bits).select(F.lit(variant).alias("variant"), "metric", "value")

    base = scored("baseline", rows)
    oof = models.out_of_fold_bits(rows, n_bits, config.cv_folds, config.seed, scale)
    issues = materialize(labels.multilabel_issues(materialize(oof.select("row_id", "y", "p")), n_bits))
    n_train, n_issues = row_count(rows), row_count(issues)
    bad = materialize(
        labels.worst_rows(issues, "score", min(n_issues, labels.prune_size(n_train, config.prune_frac)))
    )
    scores = materialize(base.unionByName(scored("pruned_retrain", labels.prune(rows, bad))))
    summary = {
        "n_train": n_train,
        "n_test": row_count(test),
        "n_labels": n_bits,
        "n_issues_found": n_issues,
        **_against_planted(bad, train),
    }
    return RunOutput(summary, scores, {"issues": issues, "pruned": bad})


def run_token(train: DataFrame, dev: DataFrame, config: TokenConfig = TokenConfig(), vector_size: int | None = 1 << 18) -> RunOutput:
    """train, dev: (sent_id, tok_i, token, tag); the sentence caps are sampling settings.

    Features are hashed to ``vector_size`` columns, or, if it is None, get a column each by a
    dictionary of the training tokens; features that only dev has are then left out.
    """
    keys = ("sent_id", "tok_i")

    def capped(df: DataFrame, limit: int | None) -> DataFrame:
        if limit is None:
            return df
        kept = sample_cap(df.select("sent_id").distinct(), limit, "sent_id", config.seed)
        return df.join(kept, "sent_id", "left_semi")

    train, dev = capped(train, config.max_train_sentences), capped(dev, config.max_dev_sentences)
    codes = label_codes(train.select("tag").unionByName(dev.select("tag")), "tag")
    n_classes = codes.count()

    dictionary = None if vector_size else fit_token_dictionary(materialize(token_features(train.select(*keys, "token"))))

    def coded(df: DataFrame) -> DataFrame:
        out = token_features(encode(df, "tag", codes, "label").select(*keys, "token", "label"))
        out = dictionary.vectors(out) if dictionary else hashed_token_vector(out, size=vector_size)
        return out.select(*keys, "label", "features")

    noisy = corruption.noise_tokens(coded(train), "label", config.noise_frac, keys, config.seed, list(range(n_classes)))
    noisy = materialize(kfold_group(noisy, "sent_id", config.cv_folds, config.seed))
    held_dev = materialize(coded(dev))

    def scored(variant: str, part: DataFrame) -> DataFrame:
        out = materialize(models.fit_token_tagger(part, n_classes, config.max_iter)(held_dev).select("label", "predicted"))
        m = metrics.classification_metrics(out, "label", "predicted").filter("metric IN ('accuracy', 'f1_macro')")
        return m.select(F.lit(variant).alias("variant"), "metric", "value")

    rows = noisy.drop(corruption.FLAG)
    base = scored("baseline", rows.drop("fold"))
    oof = materialize(
        models.out_of_fold_tags(rows, n_classes, config.cv_folds, config.seed, config.max_iter).select(*keys, "label", "probs")
    )
    issues = materialize(labels.token_issues(oof, n_classes))
    n_tokens, n_issues = row_count(rows), row_count(issues)
    n_prune = min(n_issues, labels.prune_size(n_tokens, config.prune_frac))
    named = issues.withColumn("row_id", F.struct(*keys))
    bad = materialize(labels.worst_rows(named, "score", n_prune).select("row_id.*"))
    scores = materialize(base.unionByName(scored("pruned_retrain", drop_rows(rows.drop("fold"), bad, keys))))
    summary = {
        "n_train_tokens": n_tokens,
        "n_classes": n_classes,
        "n_issues_found": n_issues,
        **_against_planted(bad, noisy, keys),
    }
    frames = {"issues": issues, "pruned": bad, "sentences": labels.sentence_scores(oof)}
    return RunOutput(summary, scores, frames)


def run_regression(df: DataFrame, config: RegressionConfig = RegressionConfig()) -> RunOutput:
    """df: (row_id, features, label DOUBLE). Prunes the worst rows, flagged or not."""
    train, test = _halves(plain_split(df, config.test_size, seed=config.seed))
    noisy = corruption.noise_target(train, "label", config.noise_frac, config.noise_scale, seed=config.seed)
    noisy = materialize(noisy)
    rows = noisy.select("row_id", "features", "label")
    spec = models.model_spec("regression", config.model, config.seed, **config.model_params)
    base = models.fit_and_score("baseline", spec, rows, test)
    oof = models.out_of_fold_with_spread(rows, spec, config.cv_folds, config.seed)
    both = oof.select("row_id", F.col("label").alias("y"), "predicted", "spread")
    quality = materialize(labels.regression_quality(materialize(both)))
    n_train = row_count(rows)
    bad = materialize(labels.worst_rows(quality, "label_score", labels.prune_size(n_train, config.prune_frac)))
    scores = materialize(base.unionByName(models.fit_and_score("pruned_retrain", spec, labels.prune(rows, bad), test)))
    summary = {
        "n_train": n_train,
        "n_test": row_count(test),
        "n_issues_found": row_count(quality.filter("is_label_issue")),
        **_against_planted(bad, noisy),
    }
    return RunOutput(summary, scores, {"quality": quality, "pruned": bad})


def run_outlier(
    df: DataFrame, columns: list[str], config: OutlierConfig = OutlierConfig(), order: list[str] | None = None
) -> RunOutput:
    """df: (row_id, numeric columns...); outliers are planted in the first column."""
    from rowsift.operators.features import standardize

    noisy = materialize(
        corruption.inject_outliers(
            df.withColumns({c: F.col(c).cast("double") for c in columns}),
            columns[0],
            config.outlier_frac,
            config.outlier_scale,
            seed=config.seed,
        )
    )
    ready = standardize(noisy, columns).select("row_id", F.array(*columns).alias("features"))
    edges = knn_edges(ready, config.neighbours)
    n = row_count(noisy)

    def order_check() -> DataFrame:
        gaps = materialize(audit.neighbour_gaps(edges, audit.row_positions(noisy, order or ["row_id"])))
        return audit.non_iid_scores(gaps, n, audit.non_iid_test(gaps, n).first()["is_non_iid"])

    done, errors = audit.run_checks(
        {
            "outlier": lambda: audit.outlier_scores(edges),
            "near_duplicate": lambda: audit.near_duplicates(edges),
            "non_iid": order_check,
        }
    )
    table = materialize(audit.issue_table(noisy, done))
    q = metrics.flag_quality(table, F.col("is_outlier_issue"), F.col(corruption.FLAG)).first()
    summary = {
        "n_rows": n,
        "n_injected": q["n_true"],
        "n_flagged": q["n_found"],
        "precision_vs_injected": q["precision"],
        "recall_vs_injected": q["recall"],
    }
    top = table.orderBy("outlier_score", "row_id").limit(config.top_k).select("row_id", "outlier_score", "is_outlier_issue")
    return RunOutput(summary, None, {"issue_table": table, "issue_summary": audit.issue_summary(table), "top_outliers": top}, errors)


def run_multiannotator(
    annotations: DataFrame, features: DataFrame, config: MultiannotatorConfig = MultiannotatorConfig()
) -> RunOutput:
    """annotations: (example_id, annotator_id, label); features: (example_id, features)."""
    coded, n_classes = annotators.annotation_codes(annotations)
    coded = materialize(coded)
    cover = annotators.coverage(coded).first()
    agreed = materialize(annotators.consensus(coded))
    folds = usable_folds(agreed, "label", config.cv_folds)
    rows = features.join(agreed.select("example_id", "label"), "example_id").withColumnRenamed("example_id", "row_id")
    rows = kfold(rows, folds, "label", seed=config.seed)
    spec = models.model_spec("classification", "logistic_regression", config.seed, max_iter=config.max_iter)
    oof = models.out_of_fold_probs(rows, spec, n_classes, folds, config.seed, _scaler(features))
    probs = materialize(oof.select(F.col("row_id").alias("example_id"), "probs"))
    quality = annotators.consensus_quality(agreed, probs)
    by_annotator = annotators.annotator_quality(coded, probs)
    codes = annotations.sparkSession.range(n_classes).select(F.col("id").cast("int").alias("code"))
    absent = annotators.missing_classes(codes, agreed)
    summary = {
        "n_examples": cover["n_examples"],
        "n_annotators": cover["n_annotators"],
        "n_classes": n_classes,
        "coverage": cover["coverage"],
        "mean_labels_per_example": cover["mean_labels_per_example"],
        "cv_folds": folds,
        "n_missing_classes": row_count(absent),
    }
    frames = {
        "consensus": agreed,
        "missing_classes": absent,
        "annotators": by_annotator,
        "weighted": annotators.weighted_vote(coded, by_annotator),
        "worst_quality": annotators.worst_examples(quality, "quality", config.top_k),
        "label_next": annotators.worst_examples(
            annotators.active_learning(coded, probs, n_classes), "al_score", config.top_k
        ),
    }
    return RunOutput(summary, None, frames)


def run_vision(
    images: DataFrame,
    truth_boxes: DataFrame,
    pred_boxes: DataFrame,
    pixels: DataFrame,
    pred_masks: DataFrame,
    class_id: int | None = None,
    config: VisionConfig = VisionConfig(),
) -> RunOutput:
    """images: (image_id, width, height); pixels: (image_id, y, x, label);
    pred_masks: (image_id, y, x, class_id, score, m)."""
    chosen = sample_cap(images, config.max_images, "image_id", config.seed)
    chosen = materialize(chosen)
    only = lambda df: df.join(chosen.select("image_id"), "image_id", "left_semi")
    n = row_count(chosen)
    size = round(config.corrupt_frac * n)

    def picked(tag: str) -> DataFrame:
        hit = pick_smallest(chosen, hash_key(config.seed, tag, "image_id"), lambda _: {(): size})
        return materialize(hit.filter("picked").drop("picked"))

    boxes = only(truth_boxes)
    kept = vision.keep_predictions(only(pred_boxes), class_id, config.score_threshold)
    hurt = picked("boxes").join(boxes.select("image_id").distinct(), "image_id", "left_semi")
    found = vision.flagged_images(vision.box_issues(vision.corrupt_boxes(boxes, hurt, config.seed), kept))
    od = metrics.set_quality(found, hurt, ("image_id",)).first()

    probs = vision.pixel_probs(only(pixels), only(pred_masks), class_id, config.score_threshold)
    masked = materialize(vision.corrupt_mask(probs, picked("masks"), config.seed + 10_000))
    bad = materialize(masked.filter("was_corrupted").select("image_id").distinct())
    frame = chosen.agg(F.max("height").alias("h"), F.max("width").alias("w")).first()
    quality = materialize(vision.softmin_quality(masked, padded=(frame["h"], frame["w"])))
    n_bad = row_count(bad)
    worst = vision.worst_images(quality, n_bad)
    seg = metrics.set_quality(worst, bad, ("image_id",)).first()
    summary = {
        "n_images": n,
        "n_corrupted_box_images": od["n_true"],
        "n_flagged_images": od["n_found"],
        "box_precision": od["precision"],
        "box_recall": od["recall"],
        "n_corrupted_mask_images": n_bad,
        "k_flagged": max(1, n_bad),
        "mask_precision_at_k": seg["precision"],
        "mask_recall_at_k": seg["recall"],
    }
    return RunOutput(summary, None, {"flagged_images": found, "mask_quality": quality, "worst_images": worst})


def run_anomaly(df: DataFrame, config: AnomalyConfig = AnomalyConfig(), strategy: anomaly.Strategy | None = None) -> RunOutput:
    """df: (row_id, features, [ground_truth]); ``strategy`` replaces the named one."""
    held = materialize(df)
    ready = standardize_array(held, "features", _width(held)) if config.scale_features else held
    ready = materialize(ready)
    vectors = ready.select("row_id", "features")
    scores = materialize((strategy or anomaly.get_strategy(config.strategy))(vectors, None, config))
    has_truth = config.use_ground_truth and "ground_truth" in held.columns
    flagged = anomaly.flag_lowest(scores, config.contamination)
    if has_truth:
        flagged = flagged.join(held.select("row_id", "ground_truth"), "row_id")
    flagged = materialize(flagged)
    summary = anomaly.anomaly_summary(flagged, F.col("ground_truth") if has_truth else None).first().asDict()
    summary |= {"strategy": config.strategy, "threshold": exact_percentile(scores, "score", config.contamination)}
    return RunOutput(summary, None, {"scores": flagged, "top": anomaly.top_anomalies(flagged, config.top_k)})
