"""The general tabular run: split, noise, out-of-fold scores, audit, prune, refit."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowsift.functions.arrays import argmax, prob_at
from rowsift.functions.ranking import KEY_DIGITS
from rowsift.functions.runtime import materialize, row_count
from rowsift.operators import audit, labels, models
from rowsift.operators.corruption import flip_labels
from rowsift.operators.features import (
    class_share,
    column_roles,
    encode,
    fit_preprocessor,
    label_codes,
    null_profile,
    reduce_dimensions,
)
from rowsift.operators.knn import knn_edges
from rowsift.operators.sampling import plain_split, sample_cap, stratified_split
from rowsift.plans.configs import AuditConfig, FeatureConfig
from rowsift.plans.results import RunOutput


def featurizer(columns: Sequence[str], df: DataFrame, cfg: FeatureConfig) -> models.Featurizer:
    """Preprocessing of the named columns, learnt on whatever training rows it is given."""
    numeric, categorical = column_roles(df.select(*columns))

    def learn(train: DataFrame):
        return fit_preprocessor(
            train, numeric, categorical, cfg.impute_numeric, cfg.scale_numeric, cfg.one_hot_max_categories
        ).transform

    return learn


def run_audit(
    df: DataFrame,
    target: str,
    config: AuditConfig = AuditConfig(),
    id_col: str = "row_id",
    order: Sequence[str] | None = None,
) -> RunOutput:
    """Audit one table and compare a model trained on it before and after pruning.

    ``id_col`` is a unique BIGINT; ``order`` names the columns that give the row
    order (default: the id). Frames: label_issues, issue_table, issue_summary,
    issue_examples, pruned.
    """
    if target not in df.columns:
        raise ValueError(f"target column {target} is not in the table")
    task, seed = config.task, config.split.seed
    classify = task == "classification"
    spec = models.model_spec(task, config.model_name, seed, **config.model_params)
    capped = sample_cap(df, config.noise.max_rows, id_col, seed).withColumnRenamed(id_col, "row_id")
    columns = [c for c in capped.columns if c not in ("row_id", target)]
    n_classes = 0
    codes = None
    if classify:
        codes = label_codes(capped, target)
        n_classes = codes.count()
        rows = encode(capped, target, codes, "label").drop(target)
    else:
        rows = capped.withColumn("label", F.col(target).cast("double")).drop(*([target] if target != "label" else []))
    split = (
        stratified_split(rows, "label", config.split.test_size, seed=seed)
        if classify and config.split.stratify
        else plain_split(rows, config.split.test_size, seed=seed)
    )
    split = materialize(split)
    test = split.filter("is_test").drop("is_test")
    train = split.filter("NOT is_test").drop("is_test")
    if classify:
        train = flip_labels(train, "label", config.noise.label_noise_fraction, seed=config.noise.seed)
    train = materialize(train.drop("was_corrupted"))
    n_train, n_test = row_count(train), row_count(test)
    featurize = featurizer(columns, train, config.features)

    frames: dict[str, DataFrame] = {}
    if config.issues.enabled and config.issues.audit and config.issues.full_audit:
        frames["null_profile"] = null_profile(train, columns)
        if classify:
            frames["class_share"] = class_share(train, "label").withColumnRenamed("label", "code")
    errors: dict[str, str] = {}
    probs = issues = None
    if classify and config.issues.enabled:

        def find() -> DataFrame:
            nonlocal probs
            oof = models.out_of_fold_probs(train, spec, n_classes, config.issues.cv_folds, seed, featurize)
            probs = materialize(oof.select("row_id", "label", "probs"))
            found = labels.flag_label_issues(probs, n_classes)
            return materialize(labels.rank_issues(found, None, config.issues.issue_score_threshold))

        done, failed = audit.run_checks({"label_issues": find})
        errors |= failed
        issues = done.get("label_issues")

    metrics = models.fit_and_score("baseline", spec, train, test, n_classes, featurize)

    table = None
    if config.issues.enabled and config.issues.audit:
        table, failed = _audit_table(train, columns, featurize, spec, probs, n_classes, config, order)
        errors |= failed
        if table is not None:
            table = materialize(table)
            frames["issue_table"] = table
            frames["issue_summary"] = audit.issue_summary(table)
            frames["issue_examples"] = audit.issue_examples(table, 20, source=columns)
            if not classify and "label_score" in table.columns:
                found = labels.regression_issues(table)
                issues = found.select(
                    "row_id", "label", F.col("predicted_label").alias("suggested_label"), F.col("label_score").alias("score")
                )
    if issues is not None:
        # only the list that is shown is cut; counting and pruning take all issues
        frames["label_issues"] = _decoded(labels.rank_issues(issues, config.issues.max_issues), codes)
    n_issues = issues.count() if issues is not None else 0

    n_prune = labels.prune_size(n_train, config.issues.prune_fraction, config.issues.prune_max_samples)
    if config.issues.enabled and config.issues.prune_and_retrain and n_prune > 0:
        sources = [(issues, "score")] if issues is not None else []
        if table is not None and "label_score" in table.columns:
            sources.append((table.filter("is_label_issue"), "label_score"))
        if table is not None and "outlier_score" in table.columns:
            sources.append((table.filter("is_outlier_issue"), "outlier_score"))
        bad = materialize(labels.choose_prune(sources, n_prune)) if sources else None
        if bad is not None and not bad.isEmpty():
            frames["pruned"] = bad
            kept = labels.prune(train, bad)
            metrics = metrics.unionByName(
                models.fit_and_score("pruned_retrain", spec, kept, test, n_classes, featurize)
            )
    if classify and config.issues.enabled and config.issues.train_clean_learning:

        def learn() -> DataFrame:
            m, _ = models.clean_learning(train, test, spec, n_classes, config.issues.cv_folds, featurize)
            return materialize(m)

        done, failed = audit.run_checks({"clean_learning": learn})
        errors |= failed
        if done:
            metrics = metrics.unionByName(done["clean_learning"])
    metrics = materialize(metrics)
    summary = {
        "task": task,
        "model": spec.name,
        "n_train": n_train,
        "n_test": n_test,
        "n_label_issues": n_issues,
        "n_pruned": frames["pruned"].count() if "pruned" in frames else 0,
    }
    frames["variants"] = models.variant_delta(metrics, task)
    return RunOutput(summary, metrics, frames, errors)


def _decoded(issues: DataFrame, codes: DataFrame | None) -> DataFrame:
    """Issue rows with class codes replaced by the class names."""
    if codes is None:
        return issues
    for c in ("label", "suggested_label"):
        names = codes.select(F.col("code").alias(c), F.col("label").alias("_name"))
        issues = issues.join(F.broadcast(names), c, "left").withColumn(c, F.col("_name")).drop("_name")
    return issues


def _audit_table(train, columns, featurize, spec, probs, n_classes, config, order):
    """Issue table of the training rows, and the errors of checks that failed."""
    state: dict[str, DataFrame] = {}

    def edges() -> DataFrame:
        if "edges" not in state:
            ready = featurize(train)(train).select("row_id", "features")
            first = ready.select(F.size("features").alias("d")).first()
            vectors = reduce_dimensions(ready, "features", first["d"])
            state["edges"] = knn_edges(vectors, config.issues.neighbours)
        return state["edges"]

    def label_check() -> DataFrame:
        if spec.task == "regression":
            ready = featurize(train)(train)
            oof = models.out_of_fold_predictions(train, spec, config.issues.cv_folds, spec.seed, featurize)
            spread = models.bootstrap_spread(ready.select("row_id", "label", "features"), spec, seed=spec.seed)
            both = oof.select("row_id", F.col("label").alias("y"), "predicted").join(spread.select("row_id", "spread"), "row_id")
            return labels.regression_quality(materialize(both)).drop("label")
        found = labels.flag_label_issues(probs, n_classes).select("row_id", F.lit(True).alias("is_label_issue"))
        own = probs.select(
            "row_id",
            F.round(prob_at("probs", "label"), KEY_DIGITS).alias("label_score"),
            argmax("probs").alias("predicted_label"),
        )
        return own.join(found, "row_id", "left").withColumn("is_label_issue", F.coalesce("is_label_issue", F.lit(False)))

    def order_check() -> DataFrame:
        positions = audit.row_positions(train, list(order or ["row_id"]))
        gaps = materialize(audit.neighbour_gaps(edges(), positions))
        n = row_count(train)
        verdict = audit.non_iid_test(gaps, n).first()
        return audit.non_iid_scores(gaps, n, verdict["is_non_iid"])

    checks = {
        "outlier": lambda: audit.outlier_scores(edges()),
        "near_duplicate": lambda: audit.near_duplicates(edges()),
        "non_iid": order_check,
    }
    if probs is not None or spec.task == "regression":
        checks = {"label": label_check, **checks}
    done, errors = audit.run_checks(checks)
    return (audit.issue_table(train, done) if done else None), errors


def run_sweep(
    df: DataFrame, target: str, model_names: Sequence[str], config: AuditConfig = AuditConfig(), id_col: str = "row_id"
) -> tuple[DataFrame, dict[str, str]]:
    """(model, n_label_issues, metric, value) of one run per model; failing models are skipped."""
    from dataclasses import replace

    parts, errors = [], {}
    for name in model_names:
        try:
            out = run_audit(df, target, replace(config, model=name, model_params={}), id_col)
            parts.append(
                out.metrics.filter("variant = 'baseline'").select(
                    F.lit(name).alias("model"),
                    F.lit(out.summary["n_label_issues"]).cast("bigint").alias("n_label_issues"),
                    "metric",
                    "value",
                )
            )
        except Exception as e:  # noqa: BLE001 - the other models go on
            errors[name] = f"{type(e).__name__}: {e}".splitlines()[0]
    if not parts:
        raise RuntimeError(f"every model failed: {errors}")
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    return rows, errors
