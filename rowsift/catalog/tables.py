"""Operator inputs derived from the driver tables, as DataFrames and as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowsift.functions.runtime import materialize
from rowsift.operators.corruption import flip_labels
from rowsift.operators.knn import knn_edges, leave_one_out_probs

K_CLASSES = 10


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# -- SQL fragments -----------------------------------------------------------


def sql_key(seed: int, tag: str, *keys: str) -> str:
    cols = ", ".join(f"CAST({k} AS VARCHAR)" for k in keys)
    return f"md5(concat_ws(':', '{seed}', '{tag}', {cols}))"


def sql_word(seed: int, tag: str, *keys: str) -> str:
    return f"CAST(('0x' || substr({sql_key(seed, tag, *keys)}, 1, 8)) AS BIGINT)"


def sql_uniform(seed: int, tag: str, *keys: str) -> str:
    return f"({sql_word(seed, tag, *keys)} / 4294967296.0::DOUBLE)"


def sql_pick(table: str, key: str, count: str, flag: str = "was_corrupted") -> str:
    """SELECT adding a flag on the rows of smallest key; ``count`` is SQL over n rows."""
    return (
        f"SELECT * EXCLUDE (_rn, _total), _rn <= {count.format(n='_total')} AS {flag} FROM ("
        f"SELECT *, row_number() OVER (ORDER BY {key}) AS _rn, count(*) OVER () AS _total FROM {table})"
    )


# -- vectors -----------------------------------------------------------------


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(row_id, features, label) of the embeddings table."""
    e = read(spark, sf_dir, "embeddings")
    return e.select(
        F.col("vec_id").alias("row_id"), F.col("embedding").cast("array<double>").alias("features"), "label"
    )


SQL_POINTS = "pts AS (SELECT vec_id AS row_id, CAST(embedding AS DOUBLE[]) AS features, label FROM embeddings)"


#: Where the thirds of an embedding end.
_THIRDS = (21, 42, 64)


def labelled_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole embeddings with a label that follows them: which third of the vector has the largest sum."""
    p = points(spark, sf_dir)
    start, sums = 0, []
    for end in _THIRDS:
        part = F.slice("features", start + 1, end - start)
        sums.append(F.round(F.aggregate(part, F.lit(0.0), lambda a, x: a + x), 9))
        start = end
    thirds = F.array(*sums)
    return p.withColumn("label", (F.array_position(thirds, F.array_max(thirds)) - 1).cast("int"))


SQL_LABELLED_POINTS = (
    "thirds AS (SELECT vec_id AS row_id, CAST(embedding AS DOUBLE[]) AS features FROM embeddings), "
    "summed AS (SELECT row_id, features, ["
    + ", ".join(
        f"round(list_sum(features[{a + 1}:{b}]), 9)" for a, b in zip((0, *_THIRDS), _THIRDS, strict=False)
    )
    + "] AS s FROM thirds), "
    "low AS (SELECT row_id, features, CAST(list_position(s, list_max(s)) - 1 AS INTEGER) AS label FROM summed)"
)


def noisy_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """:func:`labelled_points` with a tenth of the labels flipped."""
    return flip_labels(labelled_points(spark, sf_dir), "label", 0.1)


SQL_NOISY_POINTS = (
    SQL_LABELLED_POINTS
    + ", picked AS ("
    + sql_pick("low", sql_key(42, "flip", "row_id"), "CAST(round_even(0.1 * {n}, 0) AS BIGINT)")
    + "), noisy AS (SELECT row_id, features, was_corrupted, label AS clean_label, "
    f"CASE WHEN was_corrupted THEN list_filter([0, 1, 2], lambda x: x <> label)[{sql_word(42, 'class', 'row_id')} % 2 + 1] "
    "ELSE label END AS label FROM picked)"
)


def sql_edges(table: str, k: int, name: str = "edges") -> str:
    return (
        f"{name} AS (SELECT i, j, rank, dist FROM (SELECT i, j, dist, row_number() OVER "
        f"(PARTITION BY i ORDER BY dist, j) AS rank FROM (SELECT a.row_id AS i, b.row_id AS j, "
        f"round(list_distance(a.features, b.features), 9) AS dist "
        f"FROM {table} a JOIN {table} b ON a.row_id <> b.row_id)) WHERE rank <= {k})"
    )


def sql_loo(table: str, edges: str, k_classes: int, name: str = "pr") -> str:
    """CTE (bit, row_id, label, probs) of smoothed neighbour shares."""
    votes = ", ".join(f"count(*) FILTER (WHERE b.label = {c})" for c in range(k_classes))
    return (
        f"{name}_votes AS (SELECT e.i, count(*) AS k, [{votes}] AS v FROM {edges} e "
        f"JOIN {table} b ON b.row_id = e.j GROUP BY e.i), "
        f"{name} AS (SELECT 0 AS bit, t.row_id, t.label, list_transform(v, lambda x: "
        f"round((x + 1.0::DOUBLE / {k_classes}) / (k + 1), 9)) AS probs "
        f"FROM {name}_votes JOIN {table} t ON t.row_id = {name}_votes.i)"
    )


def graph(spark: SparkSession, sf_dir: str, k: int = 10) -> DataFrame:
    return knn_edges(points(spark, sf_dir), k)


def loo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(row_id, label, probs) of the embeddings with their own labels."""
    p = points(spark, sf_dir)
    return materialize(leave_one_out_probs(knn_edges(p, 10), p, K_CLASSES))


def noisy_loo(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(noisy points, probabilities)."""
    p = materialize(noisy_points(spark, sf_dir))
    return p, materialize(leave_one_out_probs(knn_edges(p, 10), p, 3))


def with_ctes(*parts: str, select: str) -> str:
    return "WITH " + ", ".join(parts) + " " + select


SQL_LOO = ", ".join([SQL_POINTS, sql_edges("pts", 10), sql_loo("pts", "edges", K_CLASSES)])
SQL_NOISY_LOO = ", ".join([SQL_NOISY_POINTS, sql_edges("noisy", 10), sql_loo("noisy", "edges", 3)])


def sql_joint(pr: str = "pr") -> str:
    """CTEs thr, lng, conf, joint, sz, q over a table (bit, row_id, label, probs)."""
    return (
        f"thr AS (SELECT bit, label, round(avg(probs[label + 1]), 9) AS t FROM {pr} GROUP BY bit, label), "
        f"lng AS (SELECT bit, row_id, label, probs, unnest(range(len(probs))) AS k, unnest(probs) AS p FROM {pr}), "
        "conf AS (SELECT l.bit, l.row_id, l.label, l.k FROM lng l JOIN thr ON thr.bit = l.bit AND thr.label = l.k "
        "WHERE round(l.p, 9) >= thr.t QUALIFY row_number() OVER "
        "(PARTITION BY l.bit, l.row_id ORDER BY round(l.p, 9) DESC, l.k) = 1), "
        "joint AS (SELECT bit, label, k AS confident, count(*) AS n FROM conf GROUP BY bit, label, k), "
        f"sz AS (SELECT bit, label, count(*) AS class_n FROM {pr} GROUP BY bit, label), "
        "scaled AS (SELECT bit, label, confident, n / sum(n) OVER (PARTITION BY bit, label) * class_n AS s "
        "FROM joint JOIN sz USING (bit, label)), "
        "q AS (SELECT bit, label, confident, s / sum(s) OVER (PARTITION BY bit) AS j FROM scaled)"
    )


def sql_issues(pr: str = "pr") -> str:
    """CTE issues (bit, row_id, label, suggested_label, score) on top of :func:`sql_joint`."""
    return (
        sql_joint(pr)
        + f", tot AS (SELECT bit, count(*) AS all_n FROM {pr} GROUP BY bit), "
        "cells AS (SELECT bit, label, confident, CAST(round_even(round(j * all_n, 6), 0) AS BIGINT) AS n "
        "FROM q JOIN tot USING (bit) WHERE label <> confident), "
        "marg AS (SELECT l.bit, l.row_id, l.label, l.k, l.probs, row_number() OVER (PARTITION BY l.bit, l.label, l.k "
        "ORDER BY round(l.p - l.probs[l.label + 1], 9) DESC, l.row_id) AS rn FROM lng l WHERE l.k <> l.label), "
        "issues AS (SELECT DISTINCT m.bit, m.row_id, CAST(m.label AS INTEGER) AS label, "
        "CAST(list_position(m.probs, list_max(m.probs)) - 1 AS INTEGER) AS suggested_label, "
        "round(m.probs[m.label + 1], 9) AS score FROM marg m JOIN cells c ON c.bit = m.bit AND c.label = m.label "
        "AND c.confident = m.k AND m.rn <= c.n WHERE list_position(m.probs, list_max(m.probs)) - 1 <> m.label)"
    )
