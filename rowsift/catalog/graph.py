"""Queries on vectors: neighbour graph, label issues, audit, anomalies, metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from rowsift.catalog.tables import (
    K_CLASSES,
    SQL_LOO,
    SQL_NOISY_LOO,
    SQL_NOISY_POINTS,
    SQL_POINTS,
    graph,
    loo,
    noisy_loo,
    noisy_points,
    points,
    read,
    sql_edges,
    sql_issues,
    sql_joint,
    sql_key,
    sql_pick,
    sql_word,
)
from rowsift.functions.arrays import argmax, prob_at
from rowsift.functions.runtime import materialize
from rowsift.operators import anomaly, audit, corruption, labels, metrics
from rowsift.operators.features import standardize_array
from rowsift.operators.knn import knn_edges, knn_regress, knn_vote, leave_one_out_probs
from rowsift.operators.models import variant_delta
from rowsift.operators.report import report

WIDTH = 64


def _long(df, array, *keys):
    return df.select(*keys, F.posexplode(array).alias("pos", "v")).withColumn("v", F.round("v", 6))


# -- neighbours --------------------------------------------------------------


def knn_graph(spark, sf_dir):
    return graph(spark, sf_dir).withColumn("dist", F.round("dist", 6))


def vote(spark, sf_dir):
    p = points(spark, sf_dir)
    out = knn_vote(knn_edges(p, 15), p, K_CLASSES)
    return out.select(F.col("i").alias("row_id"), "predicted", F.round(F.array_max("probs"), 6).alias("share"))


def _parts(spark, sf_dir):
    return read(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("row_id"),
        F.array(F.col("p_size").cast("double"), F.length("p_name").cast("double")).alias("features"),
        F.col("p_retailprice").alias("y"),
    )


def regress(spark, sf_dir):
    p = _parts(spark, sf_dir)
    out = knn_regress(knn_edges(p, 25), p)
    return out.select(F.col("i").alias("row_id"), F.round("predicted", 9).alias("predicted"))


def loo_probs(spark, sf_dir):
    return _long(loo(spark, sf_dir), "probs", "row_id", "label")


# -- label issues ------------------------------------------------------------


def flip_labels(spark, sf_dir):
    return noisy_points(spark, sf_dir).select("row_id", "label", "was_corrupted")


def self_confidence(spark, sf_dir):
    return labels.self_confidence(loo(spark, sf_dir)).select("row_id", F.round("self_confidence", 6).alias("self_confidence"))


def class_thresholds(spark, sf_dir):
    return labels.class_thresholds(loo(spark, sf_dir)).withColumn("threshold", F.round("threshold", 6))


def confident_joint(spark, sf_dir):
    return labels.confident_joint(loo(spark, sf_dir), K_CLASSES)


def noise_rates(spark, sf_dir):
    _, pr = noisy_loo(spark, sf_dir)
    r = labels.noise_rates(labels.confident_joint(pr, 3), labels.class_sizes(pr))
    return r.select("label", "confident", *[F.round(c, 6).alias(c) for c in ("joint", "given_if_true", "true_if_given")])


def label_issues(spark, sf_dir):
    found = labels.flag_label_issues(loo(spark, sf_dir), K_CLASSES)
    return labels.rank_issues(found).withColumn("score", F.round("score", 6))


def label_issues_top(spark, sf_dir):
    """The 200 worst rows of the list."""
    found = labels.flag_label_issues(loo(spark, sf_dir), K_CLASSES)
    return labels.rank_issues(found, max_issues=200).withColumn("score", F.round("score", 6))


#: Highest score in the list of sure issues.
SURE_SCORE = 0.25


def label_issues_sure(spark, sf_dir):
    found = labels.flag_label_issues(loo(spark, sf_dir), K_CLASSES)
    return labels.rank_issues(found, score_threshold=SURE_SCORE).withColumn("score", F.round("score", 6))


def _noisy_issues(spark, sf_dir):
    p, pr = noisy_loo(spark, sf_dir)
    return p, pr, labels.flag_label_issues(pr, 3)


def noisy_label_issues(spark, sf_dir):
    _, _, found = _noisy_issues(spark, sf_dir)
    return found.withColumn("score", F.round("score", 6))


def _pruned_ids(p, found):
    found = materialize(found)
    size = min(found.count(), labels.prune_size(p.count(), 0.05))
    return labels.choose_prune([(found, "score")], size)


def prune(spark, sf_dir):
    p, _, found = _noisy_issues(spark, sf_dir)
    return labels.prune(p, _pruned_ids(p, found)).select("row_id", "label")


def prune_fallback(spark, sf_dir):
    """Rows left when no label issue was found and flagged outliers are pruned instead."""
    p = points(spark, sf_dir)
    found = materialize(audit.outlier_scores(graph(spark, sf_dir)))
    none = found.select("row_id", F.col("outlier_score").alias("score")).limit(0)
    flagged = found.filter("is_outlier_issue OR outlier_score <= 0.5")
    bad = labels.choose_prune([(none, "score"), (flagged, "outlier_score")], labels.prune_size(p.count(), 0.1))
    return labels.prune(p, bad).select("row_id", "label")


def prune_quality(spark, sf_dir):
    p, _, found = _noisy_issues(spark, sf_dir)
    q = metrics.set_quality(_pruned_ids(p, found), p.filter("was_corrupted"))
    return q.withColumns({c: F.round(c, 6) for c in ("precision", "recall")})


_SQL_PRUNED = (
    SQL_NOISY_LOO
    + ", "
    + sql_issues()
    + ", lim AS (SELECT least((SELECT count(*) FROM issues), CAST(round_even(0.05 * count(*), 0) AS BIGINT)) AS n FROM noisy), "
    "pruned AS (SELECT row_id FROM issues QUALIFY row_number() OVER (ORDER BY score, row_id) <= (SELECT n FROM lim))"
)

# -- audit -------------------------------------------------------------------


def outlier_scores(spark, sf_dir):
    return audit.outlier_scores(graph(spark, sf_dir)).withColumn("outlier_score", F.round("outlier_score", 6))


def _with_twins(spark, sf_dir):
    """Embeddings plus a slightly moved copy of about one row in twenty."""
    p = points(spark, sf_dir).select("row_id", "features")
    twins = p.filter(F.pmod(F.conv(F.substring(F.md5(F.concat(F.lit("42:twin:"), "row_id")), 1, 8), 16, 10).cast("bigint"), F.lit(20)) == 0)
    moved = twins.select(
        (F.col("row_id") + 1_000_000).alias("row_id"), F.transform("features", lambda v: v + 0.0001).alias("features")
    )
    return p.unionByName(moved)


def near_duplicates(spark, sf_dir):
    out = audit.near_duplicates(knn_edges(_with_twins(spark, sf_dir), 10))
    return out.withColumn("near_duplicate_score", F.round("near_duplicate_score", 6))


def _gaps(spark, sf_dir, p, edges):
    return audit.neighbour_gaps(edges, audit.row_positions(p, ["row_id"]))


def non_iid(spark, sf_dir):
    p = points(spark, sf_dir)
    gaps = materialize(_gaps(spark, sf_dir, p, graph(spark, sf_dir)))
    out = audit.non_iid_test(gaps, p.count())
    return out.withColumns({c: F.round(c, 6) for c in ("statistic", "p_value")})


def non_iid_scores(spark, sf_dir):
    p = points(spark, sf_dir)
    gaps = materialize(_gaps(spark, sf_dir, p, graph(spark, sf_dir)))
    n = p.count()
    out = audit.non_iid_scores(gaps, n, audit.non_iid_test(gaps, n).first()["is_non_iid"])
    return out.withColumn("non_iid_score", F.round("non_iid_score", 6))


def _audit_table(spark, sf_dir):
    """Issue table of the noisy low-dimensional points with all four checks."""
    p = materialize(noisy_points(spark, sf_dir))
    edges = knn_edges(p, 10)
    pr = materialize(leave_one_out_probs(edges, p, 3))

    def label_check():
        found = labels.flag_label_issues(pr, 3).select("row_id", F.lit(True).alias("is_label_issue"))
        own = pr.select(
            "row_id", F.round(prob_at("probs", "label"), 9).alias("label_score"), argmax("probs").alias("predicted_label")
        )
        return own.join(found, "row_id", "left").withColumn("is_label_issue", F.coalesce("is_label_issue", F.lit(False)))

    def order_check():
        gaps = materialize(_gaps(spark, sf_dir, p, edges))
        n = p.count()
        return audit.non_iid_scores(gaps, n, audit.non_iid_test(gaps, n).first()["is_non_iid"])

    done, errors = audit.run_checks(
        {
            "label": label_check,
            "outlier": lambda: audit.outlier_scores(edges),
            "near_duplicate": lambda: audit.near_duplicates(edges),
            "non_iid": order_check,
        }
    )
    if errors:
        raise RuntimeError(str(errors))
    return audit.issue_table(p, done)


def issue_summary(spark, sf_dir):
    return audit.issue_summary(_audit_table(spark, sf_dir)).withColumn("score", F.round("score", 6))


def issue_examples(spark, sf_dir):
    out = audit.issue_examples(_audit_table(spark, sf_dir), 20)
    return out.withColumn("score", F.round("score", 6))


def _sql_outlier(edges: str = "edges", name: str = "outl") -> str:
    return (
        f"{name}_d AS (SELECT i AS row_id, round(avg(dist), 9) AS d FROM {edges} GROUP BY i), "
        f"{name}_r AS (SELECT min(d) AS lo, max(d) AS hi, round(2.5::DOUBLE * quantile_cont(d, 0.5), 9) AS bar FROM {name}_d), "
        f"{name} AS (SELECT row_id, round(1.0::DOUBLE - (d - lo) / (hi - lo), 9) AS outlier_score, d > bar AS is_outlier_issue "
        f"FROM {name}_d, {name}_r)"
    )


def _sql_twins(edges: str = "edges", name: str = "dup") -> str:
    return (
        f"{name}_m AS (SELECT i AS row_id, min(dist) AS m FROM {edges} GROUP BY i), "
        f"{name}_r AS (SELECT quantile_cont(m, 0.5) AS med FROM {name}_m), "
        f"{name} AS (SELECT row_id, round(m / (m + med), 9) AS near_duplicate_score, "
        f"m <= round(0.1::DOUBLE * med, 9) AS is_near_duplicate_issue FROM {name}_m, {name}_r)"
    )


def _sql_order(table: str, edges: str = "edges") -> str:
    back = lambda g: f"(({g}) * (2 * n - ({g}) - 1) / (n * (n - 1))::DOUBLE)"
    return (
        f"posn AS (SELECT row_id, row_number() OVER (ORDER BY row_id) - 1 AS pos, count(*) OVER () AS n FROM {table}), "
        f"gaps AS (SELECT e.i, abs(a.pos - b.pos) AS gap, a.n FROM {edges} e JOIN posn a ON a.row_id = e.i "
        "JOIN posn b ON b.row_id = e.j), "
        "gc AS (SELECT gap, n, count(*) AS c FROM gaps GROUP BY gap, n), "
        "gr AS (SELECT gap, n, c, sum(c) OVER (ORDER BY gap) AS upto, sum(c) OVER () AS total FROM gc), "
        f"dd AS (SELECT max(greatest(abs(upto / total - {back('gap')}), abs((upto - c) / total - {back('gap - 1')}))) AS d, "
        "any_value(n) AS n FROM gr), "
        "pv AS (SELECT d, CASE WHEN d * d * n < 0.04 THEN 1.0 ELSE (SELECT greatest(0.0, least(1.0, 2.0 * sum(CASE WHEN k % 2 = 1 THEN 1 ELSE -1 END "
        "* exp(-2.0 * k * k * d * d * n)))) FROM (SELECT unnest(range(1, 101)) AS k)) END AS p FROM dd), "
        f"ord0 AS (SELECT i AS row_id, round(avg({back('gap')}), 9) AS non_iid_score FROM gaps GROUP BY i), "
        "ord AS (SELECT row_id, non_iid_score, (SELECT p < 0.05 FROM pv) AND non_iid_score <= (SELECT min(non_iid_score) FROM ord0) "
        "AS is_non_iid_issue FROM ord0)"
    )


_SQL_AUDIT = (
    SQL_NOISY_LOO
    + ", "
    + ", ".join([sql_issues(), _sql_outlier(), _sql_twins(), _sql_order("noisy")])
    + ", tab AS (SELECT noisy.row_id, noisy.label, CAST(list_position(pr.probs, list_max(pr.probs)) - 1 AS INTEGER) AS predicted_label, "
    "round(pr.probs[pr.label + 1], 9) AS label_score, noisy.row_id IN (SELECT row_id FROM issues) AS is_label_issue, "
    "outlier_score, is_outlier_issue, near_duplicate_score, is_near_duplicate_issue, non_iid_score, is_non_iid_issue "
    "FROM noisy JOIN pr USING (row_id) JOIN outl USING (row_id) JOIN dup USING (row_id) JOIN ord USING (row_id)), "
    "typ AS ("
    + " UNION ALL ".join(
        f"SELECT '{t}' AS issue_type, row_id, label, predicted_label, {t}_score AS score, is_{t}_issue AS flag FROM tab"
        for t in ("label", "outlier", "near_duplicate", "non_iid")
    )
    + ")"
)
_SQL_SUMMARY = "summ AS (SELECT issue_type, avg(score) AS score, count(*) FILTER (WHERE flag) AS num_issues FROM typ GROUP BY issue_type)"

# -- anomalies ---------------------------------------------------------------


def _injected(spark, sf_dir):
    p = points(spark, sf_dir).select("row_id", "features")
    return corruption.inject_anomalies(p, "features", WIDTH, 0.05)


def inject_anomalies(spark, sf_dir):
    return _long(_injected(spark, sf_dir), "features", "row_id", "was_corrupted")


def inject_outliers(spark, sf_dir):
    lines = read(spark, sf_dir, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("row_id"), "l_quantity"
    )
    return corruption.inject_outliers(lines, "l_quantity", 0.02)


def outlier_quality(spark, sf_dir):
    p = materialize(_injected(spark, sf_dir))
    scored = audit.outlier_scores(knn_edges(p, 10)).join(p.select("row_id", "was_corrupted"), "row_id")
    q = metrics.flag_quality(scored, F.col("is_outlier_issue"), F.col("was_corrupted"))
    return q.withColumns({c: F.round(c, 6) for c in ("precision", "recall")})


def _scaled(spark, sf_dir):
    return materialize(standardize_array(_injected(spark, sf_dir), "features", WIDTH))


def _strategy_scores(spark, sf_dir, score, contamination=0.05):
    """Scores of one strategy with flags and the planted truth."""
    p = _scaled(spark, sf_dir)
    scored = anomaly.flag_lowest(materialize(score(p)), contamination)
    return scored.join(p.select("row_id", F.col("was_corrupted").cast("int").alias("ground_truth")), "row_id")


def _knn20(p):
    return anomaly.knn_scores(knn_edges(p, 20))


def anomaly_knn(spark, sf_dir):
    return _strategy_scores(spark, sf_dir, _knn20).withColumn("score", F.round("score", 6))


def anomaly_lof(spark, sf_dir):
    found = _strategy_scores(spark, sf_dir, lambda p: anomaly.lof_scores(knn_edges(p, 20)))
    return found.select("row_id", F.round("score", 6).alias("score"), F.round("lof", 6).alias("lof"), "is_anomaly", "ground_truth")


def _knn_lof(p):
    edges = knn_edges(p, 20)
    return anomaly.ensemble_scores([anomaly.knn_scores(edges), anomaly.lof_scores(edges)])


def anomaly_ensemble(spark, sf_dir):
    return _strategy_scores(spark, sf_dir, _knn_lof).withColumn("score", F.round("score", 6))


def anomaly_iforest(spark, sf_dir):
    found = _strategy_scores(spark, sf_dir, lambda p: anomaly.forest_scores(p, trees=100))
    return found.withColumn("score", F.round("score", 6))


def anomaly_summary(spark, sf_dir):
    out = anomaly.anomaly_summary(_strategy_scores(spark, sf_dir, _knn20), F.col("ground_truth"))
    return out.withColumns({c: F.round(c, 6) for c in ("contamination_rate", "precision", "recall", "f1_score")})


def anomaly_topk(spark, sf_dir):
    return anomaly.top_anomalies(_strategy_scores(spark, sf_dir, _knn20), 20).withColumn("score", F.round("score", 6))


def anomaly_compare(spark, sf_dir):
    """One summary row per strategy over the same rows and the same graph."""
    p = _scaled(spark, sf_dir)
    edges = knn_edges(p, 20)
    members = {
        "knn": anomaly.knn_scores(edges),
        "lof": anomaly.lof_scores(edges).select("row_id", "score"),
        "isolation_forest": anomaly.forest_scores(p, trees=100),
    }
    members = {k: materialize(v) for k, v in members.items()}
    members["ensemble"] = materialize(anomaly.ensemble_scores(list(members.values())))
    truth = p.select("row_id", "was_corrupted")
    rows = None
    for name, scores in members.items():
        one = anomaly.anomaly_summary(anomaly.flag_lowest(scores, 0.05).join(truth, "row_id"), F.col("was_corrupted"))
        one = one.select(F.lit(name).alias("strategy"), "*")
        rows = one if rows is None else rows.unionByName(one)
    return rows


def confusion(spark, sf_dir):
    return anomaly.confusion_counts(_strategy_scores(spark, sf_dir, _knn20))


def score_histogram(spark, sf_dir):
    scored = materialize(_strategy_scores(spark, sf_dir, _knn20))
    return anomaly.score_histogram(scored, 50, "ground_truth")


_SQL_INJECTED = (
    SQL_POINTS
    + ", pk AS ("
    + sql_pick("pts", sql_key(42, "anomaly", "row_id"), "CAST(floor(0.05 * {n}) AS BIGINT)")
    + "), dr AS (SELECT row_id, features, was_corrupted, "
    + f"{sql_word(42, 'howmany', 'row_id')} % {WIDTH // 2} + 1 AS many, "
    + f"list_transform(range({WIDTH}), lambda c: CAST(('0x' || substr(md5(concat_ws(':', '42', 'col' || c, CAST(row_id AS VARCHAR))), 1, 8)) AS BIGINT)) AS draws "
    "FROM pk), inj AS (SELECT row_id, was_corrupted, CASE WHEN was_corrupted THEN list_transform(features, lambda v, c: "
    "CASE WHEN draws[c] <= list_sort(draws)[many] THEN v * (CASE WHEN draws[c] % 2 = 0 THEN 1 ELSE -1 END) * 10 ELSE v END) "
    "ELSE features END AS features FROM dr)"
)
_SQL_SCALED = (
    _SQL_INJECTED
    + f", cell AS (SELECT row_id, was_corrupted, unnest(range({WIDTH})) AS c, unnest(features) AS v FROM inj), "
    "st AS (SELECT c, avg(v) AS m, stddev_pop(v) AS s FROM cell GROUP BY c), "
    "scaled AS (SELECT row_id, was_corrupted, list((v - m) / s ORDER BY c) AS features FROM cell JOIN st USING (c) GROUP BY row_id, was_corrupted)"
)
_SQL_KNN_SCORE = (
    _SQL_SCALED
    + ", "
    + sql_edges("scaled", 20)
    + ", kd AS (SELECT i AS row_id, round(avg(dist), 9) AS d FROM edges GROUP BY i), "
    "ks AS (SELECT row_id, round(1.0::DOUBLE - (d - (SELECT min(d) FROM kd)) / ((SELECT max(d) FROM kd) - (SELECT min(d) FROM kd)), 9) AS score FROM kd)"
)
_SQL_LOF_SCORE = (
    "kdist AS (SELECT i, max(dist) AS kd FROM edges GROUP BY i), "
    "lrd AS (SELECT e.i, 1.0::DOUBLE / greatest(avg(greatest(k.kd, e.dist)), 1e-10) AS lrd FROM edges e JOIN kdist k ON k.i = e.j GROUP BY e.i), "
    "lf AS (SELECT e.i AS row_id, round(avg(b.lrd) / any_value(a.lrd), 9) AS lof FROM edges e JOIN lrd a ON a.i = e.i JOIN lrd b ON b.i = e.j GROUP BY e.i), "
    "ls AS (SELECT row_id, lof, round(1.0::DOUBLE - (lof - (SELECT min(lof) FROM lf)) / ((SELECT max(lof) FROM lf) - (SELECT min(lof) FROM lf)), 9) AS score FROM lf)"
)


def _sql_flagged(scores: str) -> str:
    return (
        f"fl AS (SELECT s.*, score < (SELECT quantile_cont(score, 0.05) FROM {scores}) AS is_anomaly, "
        f"CAST(was_corrupted AS INTEGER) AS ground_truth FROM {scores} s JOIN scaled USING (row_id))"
    )


_SQL_FLAGGED = f"{_SQL_KNN_SCORE}, {_sql_flagged('ks')}"

# -- metrics -----------------------------------------------------------------


def _predicted(spark, sf_dir, k):
    """Noisy points with a leave-one-out vote of k neighbours."""
    p = noisy_points(spark, sf_dir)
    votes = knn_vote(knn_edges(p, k), p, 3)
    return p.select("row_id", "label").join(votes.withColumnRenamed("i", "row_id"), "row_id")


def clf_metrics(spark, sf_dir):
    m = metrics.classification_metrics(_predicted(spark, sf_dir, 10), "label", "predicted")
    return m.withColumn("value", F.round("value", 6))


def auc(spark, sf_dir):
    _, pr = noisy_loo(spark, sf_dir)
    df = pr.select((F.col("label") == 0).cast("int").alias("t"), F.element_at("probs", 1).alias("s"))
    return metrics.roc_auc(df, "t", "s").withColumn("auc", F.round("auc", 6))


def auc_macro(spark, sf_dir):
    _, pr = noisy_loo(spark, sf_dir)
    return metrics.roc_auc_macro(pr, "label", "probs").withColumn("auc", F.round("auc", 6))


def log_loss(spark, sf_dir):
    _, pr = noisy_loo(spark, sf_dir)
    return metrics.log_loss(pr, "label", "probs").withColumn("log_loss", F.round("log_loss", 6))


_VARIANTS = {"baseline": 10, "k5": 5, "k15": 15}


def _variant_metrics(spark, sf_dir):
    p = materialize(noisy_points(spark, sf_dir))
    edges = materialize(knn_edges(p, max(_VARIANTS.values())))
    out = None
    for name, k in _VARIANTS.items():
        votes = knn_vote(edges.filter(F.col("rank") <= k), p, 3).withColumnRenamed("i", "row_id")
        m = metrics.classification_metrics(p.select("row_id", "label").join(votes, "row_id"), "label", "predicted")
        m = m.select(F.lit(name).alias("variant"), "metric", "value")
        out = m if out is None else out.unionByName(m)
    return out


def variants(spark, sf_dir):
    out = variant_delta(_variant_metrics(spark, sf_dir))
    return out.withColumns({c: F.round(c, 6) for c in ("primary", "delta")})


def report_rules(spark, sf_dir):
    table = materialize(_audit_table(spark, sf_dir))
    found = table.filter("is_label_issue")
    return report(_variant_metrics(spark, sf_dir), found, audit.issue_summary(table))


def _sql_votes(k: int, name: str) -> str:
    shares = ", ".join(f"count(*) FILTER (WHERE b.label = {c})" for c in range(3))
    return (
        f"{name} AS (SELECT t.row_id, t.label, CAST(list_position(v, list_max(v)) - 1 AS INTEGER) AS predicted FROM "
        f"(SELECT e.i, [{shares}] AS v FROM edges15 e JOIN noisy b ON b.row_id = e.j WHERE e.rank <= {k} GROUP BY e.i) x "
        f"JOIN noisy t ON t.row_id = x.i)"
    )


def _sql_clf(name: str) -> str:
    return (
        f"{name}_c AS (SELECT cls, sum(tp) AS tp, sum(sup) AS sup, sum(gue) AS gue FROM ("
        f"SELECT label AS cls, CAST(label = predicted AS INTEGER) AS tp, 1 AS sup, 0 AS gue FROM {name} UNION ALL "
        f"SELECT predicted, 0, 0, 1 FROM {name}) GROUP BY cls), "
        f"{name}_f AS (SELECT *, CASE WHEN sup + gue > 0 THEN 2.0::DOUBLE * tp / (sup + gue) ELSE 0 END AS f1, "
        f"CASE WHEN gue > 0 THEN tp / gue::DOUBLE ELSE 0 END AS pre FROM {name}_c), "
        f"{name}_m AS (SELECT CAST(sum(tp) / sum(sup) AS DOUBLE) AS accuracy, CAST(sum(f1 * sup) / sum(sup) AS DOUBLE) AS f1_weighted, "
        f"CAST(sum(pre * sup) / sum(sup) AS DOUBLE) AS precision_weighted, avg(f1) AS f1_macro, "
        f"2.0::DOUBLE * sum(tp) / (sum(sup) + sum(gue)) AS f1_micro FROM {name}_f)"
    )


_SQL_VARIANTS = (
    SQL_NOISY_POINTS
    + ", "
    + sql_edges("noisy", 15, "edges15")
    + ", "
    + ", ".join(f"{_sql_votes(k, n)}, {_sql_clf(n)}" for n, k in _VARIANTS.items())
    + ", vt AS ("
    + " UNION ALL ".join(f"SELECT '{n}' AS variant, f1_weighted AS prim FROM {n}_m" for n in _VARIANTS)
    + ")"
)


def _sql_auc(classes: str) -> str:
    return (
        f"WITH {SQL_NOISY_LOO}, cs AS (SELECT unnest({classes}) AS k), "
        "sc AS (SELECT k, CAST(label = k AS INTEGER) AS t, round(probs[k + 1], 9) AS s FROM pr, cs), "
        "rk AS (SELECT k, t, rank() OVER (PARTITION BY k ORDER BY s) + (count(*) OVER (PARTITION BY k, s) - 1) / 2.0::DOUBLE AS r FROM sc), "
        "a AS (SELECT k, (sum(r) FILTER (WHERE t = 1) - sum(t) * (sum(t) + 1) / 2.0::DOUBLE) / (sum(t) * sum(1 - t)) AS auc FROM rk GROUP BY k) "
        "SELECT round(avg(auc), 6) AS auc FROM a"
    )


QUERIES = {
    "label_issues": label_issues,
    "label_issues_top": label_issues_top,
    "label_issues_sure": label_issues_sure,
    "prune_fallback": prune_fallback,
    "knn_graph": knn_graph,
    "knn_vote": vote,
    "knn_regress": regress,
    "loo_probs": loo_probs,
    "flip_labels": flip_labels,
    "self_confidence": self_confidence,
    "class_thresholds": class_thresholds,
    "confident_joint": confident_joint,
    "noise_rates": noise_rates,
    "noisy_label_issues": noisy_label_issues,
    "prune": prune,
    "prune_quality": prune_quality,
    "outlier_scores": outlier_scores,
    "near_duplicates": near_duplicates,
    "non_iid": non_iid,
    "non_iid_scores": non_iid_scores,
    "issue_summary": issue_summary,
    "issue_examples": issue_examples,
    "inject_anomalies": inject_anomalies,
    "inject_outliers": inject_outliers,
    "outlier_quality": outlier_quality,
    "anomaly_knn": anomaly_knn,
    "anomaly_lof": anomaly_lof,
    "anomaly_ensemble": anomaly_ensemble,
    "anomaly_iforest": anomaly_iforest,
    "anomaly_summary": anomaly_summary,
    "anomaly_topk": anomaly_topk,
    "anomaly_compare": anomaly_compare,
    "confusion": confusion,
    "score_histogram": score_histogram,
    "clf_metrics": clf_metrics,
    "auc": auc,
    "auc_macro": auc_macro,
    "log_loss": log_loss,
    "variant_delta": variants,
    "report_rules": report_rules,
}

ORACLE = {
    "label_issues": f"WITH {SQL_LOO}, {sql_issues()} SELECT row_id, label, suggested_label, round(score, 6) AS score FROM issues",
    "label_issues_sure": (
        f"WITH {SQL_LOO}, {sql_issues()} SELECT row_id, label, suggested_label, round(score, 6) AS score FROM issues "
        f"WHERE score <= {SURE_SCORE}"
    ),
    "prune_fallback": (
        f"WITH {SQL_POINTS}, {sql_edges('pts', 10)}, {_sql_outlier()}, bad AS (SELECT row_id FROM outl "
        "WHERE is_outlier_issue OR outlier_score <= 0.5 QUALIFY row_number() OVER (ORDER BY outlier_score, row_id) "
        "<= (SELECT CAST(round_even(0.1 * count(*), 0) AS BIGINT) FROM pts)) "
        "SELECT row_id, label FROM pts WHERE row_id NOT IN (SELECT row_id FROM bad)"
    ),
    "label_issues_top": (
        f"WITH {SQL_LOO}, {sql_issues()} SELECT row_id, label, suggested_label, round(score, 6) AS score "
        "FROM (SELECT * FROM issues ORDER BY score, row_id LIMIT 200)"
    ),
    "knn_graph": f"WITH {SQL_POINTS}, {sql_edges('pts', 10)} SELECT i, j, CAST(rank AS INTEGER) AS rank, round(dist, 6) AS dist FROM edges",
    "knn_vote": (
        f"WITH {SQL_POINTS}, {sql_edges('pts', 15)}, v AS (SELECT e.i, ["
        + ", ".join(f"count(*) FILTER (WHERE b.label = {c})" for c in range(K_CLASSES))
        + "] AS v FROM edges e JOIN pts b ON b.row_id = e.j GROUP BY e.i) SELECT i AS row_id, "
        "CAST(list_position(v, list_max(v)) - 1 AS INTEGER) AS predicted, round(list_max(v) / 15.0::DOUBLE, 6) AS share FROM v"
    ),
    "knn_regress": (
        "WITH p AS (SELECT p_partkey AS row_id, [p_size::DOUBLE, length(p_name)::DOUBLE] AS features, p_retailprice AS y FROM part), "
        + sql_edges("p", 25)
        + ", n AS (SELECT e.i, e.dist, b.y FROM edges e JOIN p b ON b.row_id = e.j) SELECT i AS row_id, round(CASE WHEN min(dist) <= 0 "
        "THEN avg(y) FILTER (WHERE dist <= 0) ELSE sum(y / dist) FILTER (WHERE dist > 0) / sum(1 / dist) FILTER (WHERE dist > 0) END, 9) "
        "AS predicted FROM n GROUP BY i"
    ),
    "loo_probs": (
        f"WITH {SQL_LOO} SELECT row_id, label, CAST(unnest(range({K_CLASSES})) AS INTEGER) AS pos, round(unnest(probs), 6) AS v FROM pr"
    ),
    "flip_labels": f"WITH {SQL_NOISY_POINTS} SELECT row_id, CAST(label AS INTEGER) AS label, was_corrupted FROM noisy",
    "self_confidence": f"WITH {SQL_LOO} SELECT row_id, round(probs[label + 1], 6) AS self_confidence FROM pr",
    "class_thresholds": f"WITH {SQL_LOO} SELECT label, round(avg(probs[label + 1]), 6) AS threshold FROM pr GROUP BY label",
    "confident_joint": f"WITH {SQL_LOO}, {sql_joint()} SELECT label, CAST(confident AS INTEGER) AS confident, n FROM joint",
    "noise_rates": (
        f"WITH {SQL_NOISY_LOO}, {sql_joint()} SELECT CAST(label AS INTEGER) AS label, CAST(confident AS INTEGER) AS confident, round(j, 6) AS joint, "
        "round(j / sum(j) OVER (PARTITION BY confident), 6) AS given_if_true, round(j / sum(j) OVER (PARTITION BY label), 6) AS true_if_given FROM q"
    ),
    "noisy_label_issues": (
        f"WITH {SQL_NOISY_LOO}, {sql_issues()} SELECT row_id, label, suggested_label, round(score, 6) AS score FROM issues"
    ),
    "prune": f"WITH {_SQL_PRUNED} SELECT row_id, CAST(label AS INTEGER) AS label FROM noisy WHERE row_id NOT IN (SELECT row_id FROM pruned)",
    "prune_quality": (
        f"WITH {_SQL_PRUNED}, c AS (SELECT (SELECT count(*) FROM pruned) AS n_found, (SELECT count(*) FROM noisy WHERE was_corrupted) AS n_true, "
        "(SELECT count(*) FROM noisy WHERE was_corrupted AND row_id IN (SELECT row_id FROM pruned)) AS n_hit) "
        "SELECT *, round(CASE WHEN n_found > 0 THEN n_hit / n_found::DOUBLE ELSE 0 END, 6) AS precision, "
        "round(CASE WHEN n_true > 0 THEN n_hit / n_true::DOUBLE ELSE 0 END, 6) AS recall FROM c"
    ),
    "outlier_scores": (
        f"WITH {SQL_POINTS}, {sql_edges('pts', 10)}, {_sql_outlier()} SELECT row_id, round(outlier_score, 6) AS outlier_score, is_outlier_issue FROM outl"
    ),
    "near_duplicates": (
        f"WITH {SQL_POINTS}, tw AS (SELECT row_id, features FROM pts UNION ALL SELECT row_id + 1000000, list_transform(features, lambda v: v + 0.0001::DOUBLE) "
        f"FROM pts WHERE {sql_word(42, 'twin', 'row_id')} % 20 = 0), {sql_edges('tw', 10)}, {_sql_twins()} "
        "SELECT row_id, round(near_duplicate_score, 6) AS near_duplicate_score, is_near_duplicate_issue FROM dup"
    ),
    "non_iid": (
        f"WITH {SQL_POINTS}, {sql_edges('pts', 10)}, {_sql_order('pts')} SELECT round(d, 6) AS statistic, round(p, 6) AS p_value, p < 0.05 AS is_non_iid FROM pv"
    ),
    "non_iid_scores": (
        f"WITH {SQL_POINTS}, {sql_edges('pts', 10)}, {_sql_order('pts')} SELECT row_id, round(non_iid_score, 6) AS non_iid_score, is_non_iid_issue FROM ord"
    ),
    "issue_summary": f"WITH {_SQL_AUDIT}, {_SQL_SUMMARY} SELECT issue_type, round(score, 6) AS score, num_issues FROM summ",
    "issue_examples": (
        f"WITH {_SQL_AUDIT} SELECT issue_type, row_id, label, predicted_label, round(score, 6) AS score, CAST(rn AS INTEGER) AS rank FROM "
        "(SELECT *, row_number() OVER (PARTITION BY issue_type ORDER BY score, row_id) AS rn FROM typ WHERE flag) WHERE rn <= 20"
    ),
    "inject_anomalies": (
        f"WITH {_SQL_INJECTED} SELECT row_id, was_corrupted, CAST(unnest(range({WIDTH})) AS INTEGER) AS pos, round(unnest(features), 6) AS v FROM inj"
    ),
    "inject_outliers": (
        "WITH lines AS (SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS row_id, l_quantity FROM lineitem), picked AS ("
        + sql_pick("lines", sql_key(42, "outlier", "row_id"), "CAST(round_even(0.02 * {n}, 0) AS BIGINT)")
        + ") SELECT row_id, CASE WHEN was_corrupted THEN l_quantity * 50 ELSE l_quantity END AS l_quantity, was_corrupted FROM picked"
    ),
    "outlier_quality": (
        f"WITH {_SQL_INJECTED}, {sql_edges('inj', 10)}, {_sql_outlier()}, c AS (SELECT count(*) FILTER (WHERE is_outlier_issue) AS n_found, "
        "count(*) FILTER (WHERE was_corrupted) AS n_true, count(*) FILTER (WHERE is_outlier_issue AND was_corrupted) AS n_hit "
        "FROM outl JOIN inj USING (row_id)) SELECT *, round(CASE WHEN n_found > 0 THEN n_hit / n_found::DOUBLE ELSE 0 END, 6) AS precision, "
        "round(CASE WHEN n_true > 0 THEN n_hit / n_true::DOUBLE ELSE 0 END, 6) AS recall FROM c"
    ),
    "anomaly_knn": f"WITH {_SQL_FLAGGED} SELECT row_id, round(score, 6) AS score, is_anomaly, ground_truth FROM fl",
    "anomaly_lof": (
        f"WITH {_SQL_KNN_SCORE}, {_SQL_LOF_SCORE}, {_sql_flagged('ls')} "
        "SELECT row_id, round(score, 6) AS score, round(lof, 6) AS lof, is_anomaly, ground_truth FROM fl"
    ),
    "anomaly_ensemble": (
        f"WITH {_SQL_KNN_SCORE}, {_SQL_LOF_SCORE}, en AS (SELECT row_id, round((ks.score + ls.score) / 2, 9) AS score FROM ks JOIN ls USING (row_id)), "
        f"{_sql_flagged('en')} SELECT row_id, round(score, 6) AS score, is_anomaly, ground_truth FROM fl"
    ),
    "anomaly_summary": (
        f"WITH {_SQL_FLAGGED}, c AS (SELECT count(*) AS n_total, count(*) FILTER (WHERE is_anomaly) AS n_anomalies_detected, "
        "sum(ground_truth)::BIGINT AS n_actual_anomalies, count(*) FILTER (WHERE is_anomaly AND ground_truth = 1) AS true_positives, "
        "count(*) FILTER (WHERE is_anomaly AND ground_truth = 0) AS false_positives, "
        "count(*) FILTER (WHERE NOT is_anomaly AND ground_truth = 1) AS false_negatives FROM fl) "
        "SELECT *, round(n_anomalies_detected / n_total::DOUBLE, 6) AS contamination_rate, "
        "round(CASE WHEN n_anomalies_detected > 0 THEN true_positives / n_anomalies_detected::DOUBLE ELSE 0 END, 6) AS precision, "
        "round(CASE WHEN n_actual_anomalies > 0 THEN true_positives / n_actual_anomalies::DOUBLE ELSE 0 END, 6) AS recall, "
        "round(2.0::DOUBLE * true_positives / (2 * true_positives + false_positives + false_negatives), 6) AS f1_score FROM c"
    ),
    "anomaly_topk": (
        f"WITH {_SQL_FLAGGED} SELECT row_id, round(score, 6) AS score, is_anomaly, ground_truth FROM "
        "(SELECT * FROM fl ORDER BY score, row_id LIMIT 20)"
    ),
    "confusion": (
        f"WITH {_SQL_FLAGGED} SELECT ground_truth AS truth, CAST(is_anomaly AS INTEGER) AS predicted, count(*) AS n FROM fl GROUP BY ALL"
    ),
    "score_histogram": (
        f"WITH {_SQL_FLAGGED}, r AS (SELECT min(score) AS lo, max(score) AS hi FROM fl) "
        "SELECT CAST(least(floor((score - lo) / (hi - lo) * 50) + 1, 50) AS INTEGER) AS bin, ground_truth AS truth, count(*) AS n FROM fl, r GROUP BY ALL"
    ),
    "clf_metrics": (
        f"WITH {SQL_NOISY_POINTS}, {sql_edges('noisy', 15, 'edges15')}, {_sql_votes(10, 'b')}, {_sql_clf('b')} "
        "SELECT metric, round(value, 6) AS value FROM b_m UNPIVOT (value FOR metric IN (accuracy, f1_weighted, precision_weighted, f1_macro, f1_micro))"
    ),
    "auc": _sql_auc("[0]"),
    "auc_macro": _sql_auc("[0, 1, 2]"),
    "log_loss": f"WITH {SQL_NOISY_LOO} SELECT round(avg(-ln(greatest(probs[label + 1], 1e-15))), 6) AS log_loss FROM pr",
    "variant_delta": (
        f"WITH {_SQL_VARIANTS} SELECT variant, round(prim, 6) AS primary, "
        "round(prim - (SELECT prim FROM vt WHERE variant = 'baseline'), 6) AS delta FROM vt"
    ),
    "report_rules": (
        f"WITH {_SQL_VARIANTS}, {sql_edges('noisy', 10)}, "
        + _SQL_AUDIT[len(SQL_NOISY_POINTS) + 2 + len(sql_edges("noisy", 10)) + 2 :]
        + f", {_SQL_SUMMARY}, ni AS (SELECT count(*) AS n FROM issues), "
        "bv AS (SELECT variant FROM vt ORDER BY prim DESC, variant DESC LIMIT 1), "
        "oc AS (SELECT num_issues AS n FROM summ WHERE issue_type = 'outlier'), dc AS (SELECT num_issues AS n FROM summ WHERE issue_type = 'near_duplicate') "
        "SELECT 'label_issues' AS rule, n > 0 AS fired, CAST(n AS VARCHAR) AS detail FROM ni "
        "UNION ALL SELECT 'best_variant', true, variant FROM bv "
        "UNION ALL SELECT 'low_auc', true, '0.0000' "
        "UNION ALL SELECT 'many_label_issues', n > 50, CAST(n AS VARCHAR) FROM ni "
        "UNION ALL SELECT 'review_outliers', n > 0, CAST(n AS VARCHAR) FROM oc "
        "UNION ALL SELECT 'review_near_duplicates', n > 0, CAST(n AS VARCHAR) FROM dc "
        "UNION ALL SELECT 'start_with_outliers', false, 'classification'"
    ),
}
