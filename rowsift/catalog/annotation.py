"""Queries on several annotators per example, built from the events table.

Example = props.k, annotator = user_id, label = event type, with the prefix
``big_`` for large values; the latest event of a pair counts.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from rowsift.catalog.tables import read
from rowsift.operators import annotators

K = 10


def _raw(spark, sf_dir):
    e = read(spark, sf_dir, "events")
    text = F.when(F.col("value") > 150, F.concat(F.lit("big_"), "event_type")).otherwise(F.col("event_type"))
    pairs = e.select(
        F.get_json_object("props", "$.k").cast("bigint").alias("example_id"),
        F.col("user_id").alias("annotator_id"),
        text.alias("label"),
        F.struct("ts", "event_id").alias("at"),
    )
    return pairs.groupBy("example_id", "annotator_id").agg(F.max_by("label", "at").alias("label"))


def _coded(spark, sf_dir):
    return annotators.annotation_codes(_raw(spark, sf_dir))[0]


def _model(coded):
    """Smoothed label shares of the other examples with the same example_id mod 7."""
    counts = coded.groupBy("example_id").agg(
        F.count(F.lit(1)).alias("n"), *[F.count_if(F.col("label") == c).alias(f"c{c}") for c in range(K)]
    )
    group = F.pmod("example_id", F.lit(7))
    by_group = counts.groupBy(group.alias("g")).agg(
        F.sum("n").alias("gn"), *[F.sum(f"c{c}").alias(f"g{c}") for c in range(K)]
    )
    joined = counts.withColumn("g", group).join(F.broadcast(by_group), "g")  # seven rows
    share = lambda c: F.round((F.col(f"g{c}") - F.col(f"c{c}") + 1.0 / K) / (F.col("gn") - F.col("n") + 1), 9)
    return joined.select("example_id", F.array(*[share(c) for c in range(K)]).alias("probs"))


_SQL = (
    "raw AS (SELECT example_id, annotator_id, arg_max(label, stamp) AS label FROM (SELECT "
    "CAST(json_extract_string(props, '$.k') AS BIGINT) AS example_id, user_id AS annotator_id, "
    "CASE WHEN value > 150 THEN 'big_' || event_type ELSE event_type END AS label, "
    "{'ts': ts, 'id': event_id} AS stamp FROM events) GROUP BY example_id, annotator_id), "
    "codes AS (SELECT label AS text, CAST(row_number() OVER (ORDER BY label) - 1 AS INTEGER) AS code FROM (SELECT DISTINCT label FROM raw)), "
    "ann AS (SELECT example_id, annotator_id, code AS label FROM raw JOIN codes ON codes.text = raw.label), "
    "vc AS (SELECT example_id, label, count(*) AS votes FROM ann GROUP BY ALL), "
    "ov AS (SELECT label, sum(votes) AS overall FROM vc GROUP BY label), "
    "cons AS (SELECT example_id, label, votes, sum(votes) OVER (PARTITION BY example_id) AS n_labels FROM vc JOIN ov USING (label) "
    "QUALIFY row_number() OVER (PARTITION BY example_id ORDER BY votes DESC, overall DESC, label) = 1), "
    "ex AS (SELECT example_id, count(*) AS n, "
    + ", ".join(f"count(*) FILTER (WHERE label = {c}) AS c{c}" for c in range(K))
    + " FROM ann GROUP BY example_id), gr AS (SELECT example_id % 7 AS g, sum(n) AS gn, "
    + ", ".join(f"sum(c{c}) AS g{c}" for c in range(K))
    + " FROM ex GROUP BY g), mo AS (SELECT example_id, ["
    + ", ".join(f"round((g{c} - c{c} + 1.0::DOUBLE / {K}) / (gn - n + 1), 9)" for c in range(K))
    + f"] AS probs FROM ex JOIN gr ON gr.g = ex.example_id % 7), "
    "ql AS (SELECT annotator_id, count(*) AS n_labels, round(avg(CAST(ann.label = list_position(probs, list_max(probs)) - 1 AS INTEGER)), 9) "
    "AS quality FROM ann JOIN mo USING (example_id) GROUP BY annotator_id)"
)


def annot_codes(spark, sf_dir):
    return _coded(spark, sf_dir)


def annot_coverage(spark, sf_dir):
    out = annotators.coverage(_coded(spark, sf_dir))
    return out.withColumns({c: F.round(c, 6) for c in ("coverage", "mean_labels_per_example")})


def majority_vote(spark, sf_dir):
    return annotators.consensus(_coded(spark, sf_dir)).select("example_id", "label")


def agreement(spark, sf_dir):
    out = annotators.consensus(_coded(spark, sf_dir))
    return out.select("example_id", "n_labels", F.round("agreement", 6).alias("agreement"))


def annotator_quality(spark, sf_dir):
    coded = _coded(spark, sf_dir)
    return annotators.annotator_quality(coded, _model(coded)).withColumn("quality", F.round("quality", 6))


def weighted_vote(spark, sf_dir):
    coded = _coded(spark, sf_dir)
    return annotators.weighted_vote(coded, annotators.annotator_quality(coded, _model(coded)))


def consensus_quality(spark, sf_dir):
    coded = _coded(spark, sf_dir)
    return annotators.consensus_quality(annotators.consensus(coded), _model(coded)).select("example_id", "label", F.round("quality", 6).alias("quality"))


def consensus_worst(spark, sf_dir):
    coded = _coded(spark, sf_dir)
    out = annotators.consensus_quality(annotators.consensus(coded), _model(coded))
    return annotators.worst_examples(out, "quality", 20).withColumn("quality", F.round("quality", 6))


def active_learning(spark, sf_dir):
    coded = _coded(spark, sf_dir)
    return annotators.active_learning(coded, _model(coded), K).withColumn("al_score", F.round("al_score", 6))


def missing_classes(spark, sf_dir):
    from rowsift.operators.features import label_codes

    raw = _raw(spark, sf_dir)
    return annotators.missing_classes(label_codes(raw, "label"), annotators.consensus(annotators.annotation_codes(raw)[0]))


_DENSE = {"max_annotators": 60, "min_per_example": 10, "max_examples": 50, "min_per_annotator": 15}


def dense_annotations(spark, sf_dir):
    return annotators.dense_annotations(_coded(spark, sf_dir), **_DENSE)


QUERIES = {
    "annot_codes": annot_codes,
    "annot_coverage": annot_coverage,
    "majority_vote": majority_vote,
    "agreement": agreement,
    "annotator_quality": annotator_quality,
    "weighted_vote": weighted_vote,
    "consensus_quality": consensus_quality,
    "consensus_worst": consensus_worst,
    "active_learning": active_learning,
    "missing_classes": missing_classes,
    "dense_annotations": dense_annotations,
}

ORACLE = {
    "annot_codes": f"WITH {_SQL} SELECT example_id, annotator_id, label FROM ann",
    "annot_coverage": (
        f"WITH {_SQL} SELECT count(DISTINCT example_id) AS n_examples, count(DISTINCT annotator_id) AS n_annotators, "
        "round(count(*) / (count(DISTINCT example_id) * count(DISTINCT annotator_id))::DOUBLE, 6) AS coverage, "
        "round(count(*) / count(DISTINCT example_id)::DOUBLE, 6) AS mean_labels_per_example FROM ann"
    ),
    "majority_vote": f"WITH {_SQL} SELECT example_id, label FROM cons",
    "agreement": f"WITH {_SQL} SELECT example_id, CAST(n_labels AS BIGINT) AS n_labels, round(votes / n_labels::DOUBLE, 6) AS agreement FROM cons",
    "annotator_quality": f"WITH {_SQL} SELECT annotator_id, n_labels, round(quality, 6) AS quality FROM ql",
    "weighted_vote": (
        f"WITH {_SQL}, w AS (SELECT example_id, label, round(sum(quality), 6) AS w FROM ann JOIN ql USING (annotator_id) GROUP BY ALL) "
        "SELECT example_id, label, w AS weight FROM w QUALIFY row_number() OVER (PARTITION BY example_id ORDER BY w DESC, label) = 1"
    ),
    "consensus_quality": (
        f"WITH {_SQL}, cq AS (SELECT example_id, label, round((votes / n_labels::DOUBLE + probs[label + 1]) / 2, 9) AS quality FROM cons JOIN mo USING (example_id)) "
        "SELECT example_id, label, round(quality, 6) AS quality FROM cq"
    ),
    "consensus_worst": (
        f"WITH {_SQL}, cq AS (SELECT example_id, label, round((votes / n_labels::DOUBLE + probs[label + 1]) / 2, 9) AS quality FROM cons JOIN mo USING (example_id)) "
        "SELECT example_id, label, round(quality, 6) AS quality FROM (SELECT * FROM cq ORDER BY quality, example_id LIMIT 20)"
    ),
    "active_learning": (
        f"WITH {_SQL}, h AS (SELECT example_id, sum(votes) AS n, sum(votes * ln(votes)) AS clogc FROM vc GROUP BY example_id) "
        f"SELECT example_id, round(1 - ((1 - list_max(probs)) + (ln(n) - clogc / n) / ln({K})) / 2, 6) AS al_score FROM h JOIN mo USING (example_id)"
    ),
    "missing_classes": f"WITH {_SQL} SELECT code FROM codes WHERE code NOT IN (SELECT label FROM cons)",
    "dense_annotations": (
        f"WITH {_SQL}, a1 AS (SELECT annotator_id FROM ann GROUP BY 1 ORDER BY count(*) DESC, annotator_id LIMIT 60), "
        "r1 AS (SELECT * FROM ann WHERE annotator_id IN (SELECT annotator_id FROM a1)), "
        "e1 AS (SELECT example_id FROM r1 GROUP BY 1 HAVING count(*) >= 10 ORDER BY count(*) DESC, example_id LIMIT 50), "
        "r2 AS (SELECT * FROM r1 WHERE example_id IN (SELECT example_id FROM e1)), "
        "a2 AS (SELECT annotator_id FROM r2 GROUP BY 1 HAVING count(*) >= 15) "
        "SELECT example_id, annotator_id, label FROM r2 WHERE annotator_id IN (SELECT annotator_id FROM a2)"
    ),
}
