"""Queries on plain table rows: sampling, corruption, features, numeric targets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowsift.catalog.tables import read, sql_key, sql_pick, sql_uniform, sql_word
from rowsift.functions.arrays import active_codes, multi_hot
from rowsift.functions.runtime import materialize, spread
from rowsift.functions.skew import skew_join
from rowsift.functions.text import title_year
from rowsift.operators import corruption, features, labels, metrics, sampling
from rowsift.operators.labels import multilabel_issues
from rowsift.sources import shaping

LINE_KEY = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem columns with a text row_id made of its key."""
    lines = read(spark, sf_dir, "lineitem").select(
        *LINE_KEY, "l_returnflag", "l_quantity", "l_extendedprice", "l_discount"
    )
    return spread(lines, "l_orderkey").withColumn("row_id", F.concat_ws("-", *LINE_KEY)).drop(*LINE_KEY)


_SQL_LINES = (
    "lines AS (SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS row_id, "
    "l_returnflag, l_quantity, l_extendedprice, l_discount FROM lineitem)"
)


def _text(bits):
    return F.array_join(F.transform(bits, lambda v: v.cast("string")), "")


# -- sampling ----------------------------------------------------------------


def sample_cap(spark, sf_dir):
    return sampling.sample_cap(_lines(spark, sf_dir), 5000).select("row_id", "l_quantity")


def prepare_capped(spark, sf_dir):
    orders = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("row_id"), "o_totalprice", "o_custkey")
    return shaping.prepare(orders, max_rows=2000, target_offset=1)


def stratified_split(spark, sf_dir):
    return sampling.stratified_split(_lines(spark, sf_dir), "l_returnflag").select("row_id", "l_returnflag", "is_test")


def plain_split(spark, sf_dir):
    return sampling.plain_split(_lines(spark, sf_dir), floor_train=True).select("row_id", "is_test")


def kfold(spark, sf_dir):
    return sampling.kfold(_lines(spark, sf_dir), 5, "l_returnflag").select("row_id", "l_returnflag", "fold")


# -- classes and flags -------------------------------------------------------


def rare_class_flag(spark, sf_dir):
    parts = read(spark, sf_dir, "part").select("p_partkey", "p_brand")
    return shaping.rare_class_flag(parts, "p_brand", below=0.04)


def attack_flag(spark, sf_dir):
    events = read(spark, sf_dir, "events").select("event_id", "user_id", "value", "event_type")
    return shaping.not_normal_flag(events, "event_type", ["view", "click"])


def class_share(spark, sf_dir):
    s = features.class_share(read(spark, sf_dir, "events"), "event_type")
    return s.withColumn("percent", F.round("percent", 6))


def label_codes(spark, sf_dir):
    return features.label_codes(read(spark, sf_dir, "orders"), "o_orderpriority")


def title_years(spark, sf_dir):
    key = F.col("p_partkey")
    title = F.when(key % 3 == 0, F.col("p_name")).otherwise(
        F.concat("p_name", F.lit(" ("), (key % 120 + 1900).cast("string"), F.lit(")"))
    )
    return read(spark, sf_dir, "part").select("p_partkey", title_year(title).alias("year"))


# -- nulls and preprocessing -------------------------------------------------


def _reviewed(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    both = docs.join(read(spark, sf_dir, "labels"), "doc_id", "left")
    return both.withColumn("verdict", F.when(F.col("toxic") == 1, "toxic").when(F.col("toxic") == 0, "fine"))


_SQL_REVIEWED = (
    "rev AS (SELECT d.doc_id, lang, source, n_chars, quality, toxic, CASE WHEN toxic = 1 THEN 'toxic' "
    "WHEN toxic = 0 THEN 'fine' END AS verdict FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"
)


def null_profile(spark, sf_dir):
    columns = ["n_chars", "quality", "toxic", "verdict"]
    p = features.null_profile(_reviewed(spark, sf_dir), columns)
    return p.withColumn("null_percent", F.round("null_percent", 6))


def impute(spark, sf_dir):
    df = _reviewed(spark, sf_dir)
    prep = features.fit_preprocessor(df, ["n_chars", "quality"], ["verdict"], scale=False)
    return prep.impute(df).select("doc_id", "n_chars", "quality", "verdict")


def standardize(spark, sf_dir):
    cols = ["l_quantity", "l_extendedprice", "l_discount"]
    return features.rounded(features.standardize(_lines(spark, sf_dir), cols), cols, 6).select("row_id", *cols)


def one_hot(spark, sf_dir):
    parts = read(spark, sf_dir, "part").select("p_partkey", "p_brand")
    prep = features.fit_preprocessor(parts, [], ["p_brand"], max_categories=10)
    hot = F.transform("hot", lambda v: v.cast("int"))
    return prep.one_hot(parts, "p_brand", "hot").select("p_partkey", _text(hot).alias("slots"))


# -- corruption of rows ------------------------------------------------------


def noise_target(spark, sf_dir):
    out = corruption.noise_target(_lines(spark, sf_dir), "l_extendedprice", 0.05)
    return out.select("row_id", F.round("l_extendedprice", 3).alias("l_extendedprice"), "was_corrupted")


# -- multi-label -------------------------------------------------------------

_N_BITS = 3


def _bits(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    both = docs.join(read(spark, sf_dir, "labels"), "doc_id")
    y = multi_hot(F.col("quality") == 1, F.col("toxic") == 1, F.col("lang") == "en")
    return both.select(F.col("doc_id").alias("row_id"), "source", y.alias("y"))


_SQL_BITS = (
    "bits AS (SELECT d.doc_id AS row_id, source, [CAST(quality = 1 AS INTEGER), CAST(toxic = 1 AS INTEGER), "
    "CAST(lang = 'en' AS INTEGER)] AS y FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"
)


def multihot(spark, sf_dir):
    return _bits(spark, sf_dir).select("row_id", _text(F.col("y")).alias("bits"), _text(active_codes("y")).alias("codes"))


def flip_bits(spark, sf_dir):
    out = corruption.flip_bits(_bits(spark, sf_dir), "y", _N_BITS, 0.2)
    return out.select("row_id", _text(F.col("y")).alias("bits"), "was_corrupted")


def _bit_probs(spark, sf_dir):
    """Out-of-fold share of each bit per source, smoothed; folds are plain."""
    df = sampling.kfold(_bits(spark, sf_dir), 5)
    per = df.groupBy("source", "fold").agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(F.element_at("y", i + 1)).alias(f"s{i}") for i in range(_N_BITS)]
    )
    sums = per.groupBy("source").agg(F.sum("n").alias("tn"), *[F.sum(f"s{i}").alias(f"t{i}") for i in range(_N_BITS)])
    rates = per.join(sums, "source").select(
        "source",
        "fold",
        F.array(
            *[
                F.round((F.col(f"t{i}") - F.col(f"s{i}") + 1) / (F.col("tn") - F.col("n") + 2), 9)
                for i in range(_N_BITS)
            ]
        ).alias("p"),
    )
    return skew_join(df, rates, ["source", "fold"]).select("row_id", "y", "p")


_SQL_BIT_PROBS = (
    _SQL_BITS
    + f", f AS (SELECT *, ntile(5) OVER (ORDER BY {sql_key(42, 'fold', 'row_id')}) - 1 AS fold FROM bits), "
    "per AS (SELECT source, fold, count(*) AS n, sum(y[1]) AS s0, sum(y[2]) AS s1, sum(y[3]) AS s2 FROM f GROUP BY ALL), "
    "tots AS (SELECT source, sum(n) AS tn, sum(s0) AS t0, sum(s1) AS t1, sum(s2) AS t2 FROM per GROUP BY source), "
    "rate AS (SELECT source, fold, [round((t0 - s0 + 1) / (tn - n + 2), 9), round((t1 - s1 + 1) / (tn - n + 2), 9), "
    "round((t2 - s2 + 1) / (tn - n + 2), 9)] AS p FROM per JOIN tots USING (source)), "
    "ml AS (SELECT row_id, y, p FROM f JOIN rate USING (source, fold))"
)


def multilabel_flags(spark, sf_dir):
    out = multilabel_issues(_bit_probs(spark, sf_dir), _N_BITS)
    return out.select("row_id", F.round("score", 6).alias("score"), "n_bits_flagged")


def multilabel_scores(spark, sf_dir):
    df = _bit_probs(spark, sf_dir).withColumn("yhat", F.transform("p", lambda x: F.when(x > 0.5, 1).otherwise(0)))
    m = metrics.multilabel_metrics(df, "y", "yhat", _N_BITS)
    return m.withColumn("value", F.round("value", 6))


def _sql_multilabel() -> str:
    from rowsift.catalog.tables import sql_issues

    return (
        f"WITH {_SQL_BIT_PROBS}, lab AS (SELECT row_id, unnest(range(3)) AS bit, unnest(y) AS label, unnest(p) AS p1, "
        "list_min([CASE WHEN y[1] = 1 THEN p[1] ELSE 1 - p[1] END, CASE WHEN y[2] = 1 THEN p[2] ELSE 1 - p[2] END, "
        "CASE WHEN y[3] = 1 THEN p[3] ELSE 1 - p[3] END]) AS sc FROM ml), "
        "pr AS (SELECT bit, row_id, label, [1 - p1, p1] AS probs FROM lab), "
        + sql_issues()
        + " SELECT i.row_id, round(any_value(s.sc), 6) AS score, count(*) AS n_bits_flagged FROM issues i JOIN "
        "(SELECT DISTINCT row_id, sc FROM lab) s ON s.row_id = i.row_id GROUP BY i.row_id"
    )


# -- numeric targets ---------------------------------------------------------


def _fold_means(spark, sf_dir):
    """Target, out-of-fold mean price of the same quantity, and its spread over folds."""
    df = sampling.kfold(_lines(spark, sf_dir), 5)
    df = materialize(df.select("row_id", "l_quantity", "fold", F.col("l_extendedprice").alias("y")))
    per = df.groupBy("l_quantity", "fold").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("y"), 2).alias("s"))
    tot = per.groupBy("l_quantity").agg(F.sum("n").alias("tn"), F.round(F.sum("s"), 2).alias("ts"))
    left_out = per.join(tot, "l_quantity").withColumn(
        "predicted", F.round((F.col("ts") - F.col("s")) / (F.col("tn") - F.col("n")), 6)
    )
    spread = left_out.groupBy("l_quantity").agg(F.round(F.stddev_pop("predicted"), 6).alias("spread"))
    table = left_out.join(spread, "l_quantity").select("l_quantity", "fold", "predicted", "spread")
    counts = per.select("l_quantity", "fold", F.col("n").alias("_n"))
    return skew_join(df, table, ["l_quantity", "fold"], counts=counts).select("row_id", "y", "predicted", "spread")


_SQL_FOLD_MEANS = (
    _SQL_LINES
    + f", f AS (SELECT row_id, l_quantity, l_extendedprice AS y, ntile(5) OVER (ORDER BY {sql_key(42, 'fold', 'row_id')}) - 1 "
    "AS fold FROM lines), per AS (SELECT l_quantity, fold, count(*) AS n, round(sum(y), 2) AS s FROM f GROUP BY ALL), "
    "tot AS (SELECT l_quantity, sum(n) AS tn, round(sum(s), 2) AS ts FROM per GROUP BY ALL), "
    "lo AS (SELECT l_quantity, fold, round((ts - s) / (tn - n), 6) AS predicted FROM per JOIN tot USING (l_quantity)), "
    "sp AS (SELECT l_quantity, round(stddev_pop(predicted), 6) AS spread FROM lo GROUP BY ALL), "
    "reg AS (SELECT row_id, y, predicted, spread FROM f JOIN lo USING (l_quantity, fold) JOIN sp USING (l_quantity)), "
    "sc AS (SELECT row_id, y AS label, predicted AS predicted_label, "
    "round(1 / (1 + abs(y - predicted) / greatest(spread, 1e-12)), 9) AS label_score FROM reg), "
    "fl AS (SELECT *, label_score < (SELECT quantile_cont(label_score, 0.05) FROM sc) AS is_label_issue FROM sc)"
)


def regression_quality(spark, sf_dir):
    q = labels.regression_quality(_fold_means(spark, sf_dir))
    return features.rounded(q, ["predicted_label", "label_score"], 5)


def regression_issues(spark, sf_dir):
    q = labels.regression_quality(_fold_means(spark, sf_dir))
    return features.rounded(labels.regression_issues(q), ["predicted_label", "label_score"], 5)


def regression_issues_top(spark, sf_dir):
    q = labels.regression_quality(_fold_means(spark, sf_dir))
    return features.rounded(labels.regression_issues(q, 200), ["predicted_label", "label_score"], 5)


def reg_metrics(spark, sf_dir):
    m = metrics.regression_metrics(_fold_means(spark, sf_dir), "y", "predicted")
    return m.withColumn("value", F.round("value", 4))


QUERIES = {
    "sample_cap": sample_cap,
    "prepare_capped": prepare_capped,
    "stratified_split": stratified_split,
    "plain_split": plain_split,
    "kfold": kfold,
    "rare_class_flag": rare_class_flag,
    "attack_flag": attack_flag,
    "class_share": class_share,
    "label_codes": label_codes,
    "title_year": title_years,
    "null_profile": null_profile,
    "impute": impute,
    "standardize": standardize,
    "one_hot": one_hot,
    "noise_target": noise_target,
    "multihot": multihot,
    "flip_bits": flip_bits,
    "multilabel_issues": multilabel_flags,
    "multilabel_metrics": multilabel_scores,
    "regression_quality": regression_quality,
    "regression_issues": regression_issues,
    "regression_issues_top": regression_issues_top,
    "reg_metrics": reg_metrics,
}

_Z = lambda c: f"(l_{c} - avg(l_{c}) OVER ()) / stddev_pop(l_{c}) OVER ()"

ORACLE = {
    "sample_cap": f"WITH {_SQL_LINES} SELECT row_id, l_quantity FROM lines ORDER BY {sql_key(42, 'cap', 'row_id')} LIMIT 5000",
    "prepare_capped": (
        "SELECT o_orderkey AS row_id, o_totalprice, o_custkey + 1 AS label FROM orders "
        f"ORDER BY {sql_key(42, 'cap', 'o_orderkey')} LIMIT 2000"
    ),
    "stratified_split": (
        f"WITH {_SQL_LINES}, c AS (SELECT l_returnflag, count(*) AS n FROM lines GROUP BY ALL), "
        "t AS (SELECT sum(n) AS al, ceil(round(0.2 * sum(n), 9)) AS want FROM c), "
        "q AS (SELECT l_returnflag, want, floor(want * n / al + 1e-9) AS f, "
        "round(want * n / al - floor(want * n / al + 1e-9), 9) AS rem FROM c, t), "
        "q2 AS (SELECT l_returnflag, f + CASE WHEN row_number() OVER (ORDER BY rem DESC, l_returnflag) <= "
        "want - sum(f) OVER () THEN 1 ELSE 0 END AS quota FROM q) "
        "SELECT row_id, l_returnflag, row_number() OVER (PARTITION BY l_returnflag ORDER BY "
        f"{sql_key(42, 'split', 'row_id')}) <= quota AS is_test FROM lines JOIN q2 USING (l_returnflag)"
    ),
    "plain_split": (
        f"WITH {_SQL_LINES} SELECT row_id, row_number() OVER (ORDER BY {sql_key(42, 'split', 'row_id')}) <= "
        "count(*) OVER () - floor(count(*) OVER () * 0.8::DOUBLE) AS is_test FROM lines"
    ),
    "kfold": (
        f"WITH {_SQL_LINES} SELECT row_id, l_returnflag, CAST(ntile(5) OVER (PARTITION BY l_returnflag ORDER BY "
        f"{sql_key(42, 'fold', 'row_id')}) - 1 AS INTEGER) AS fold FROM lines"
    ),
    "rare_class_flag": (
        "SELECT p_partkey, p_brand, CAST(count(*) OVER (PARTITION BY p_brand) / count(*) OVER () < 0.04 AS INTEGER) "
        "AS is_anomaly FROM part"
    ),
    "attack_flag": (
        "SELECT event_id, user_id, value, CAST(event_type NOT IN ('view', 'click') AS INTEGER) AS is_anomaly FROM events"
    ),
    "class_share": (
        "SELECT event_type AS label, count(*) AS n, round(count(*) * 100.0::DOUBLE / sum(count(*)) OVER (), 6) AS percent "
        "FROM events GROUP BY event_type"
    ),
    "label_codes": (
        "SELECT label, CAST(row_number() OVER (ORDER BY label) - 1 AS INTEGER) AS code FROM "
        "(SELECT DISTINCT o_orderpriority AS label FROM orders)"
    ),
    "title_year": (
        "SELECT p_partkey, TRY_CAST(regexp_extract(CASE WHEN p_partkey % 3 = 0 THEN p_name ELSE p_name || ' (' || "
        "(p_partkey % 120 + 1900) || ')' END, '\\((\\d{4})\\)\\s*$', 1) AS INTEGER) AS year FROM part"
    ),
    "null_profile": (
        f"WITH {_SQL_REVIEWED} SELECT column_name, round(null_percent, 6) AS null_percent FROM (SELECT "
        + ", ".join(
            f"avg(CAST({c} IS NULL AS INTEGER)) * 100 AS {c}" for c in ("n_chars", "quality", "toxic", "verdict")
        )
        + " FROM rev) UNPIVOT (null_percent FOR column_name IN (n_chars, quality, toxic, verdict))"
    ),
    "impute": (
        f"WITH {_SQL_REVIEWED}, m AS (SELECT verdict AS v FROM rev WHERE verdict IS NOT NULL GROUP BY verdict "
        "ORDER BY count(*) DESC, verdict LIMIT 1) SELECT doc_id, "
        "coalesce(CAST(n_chars AS DOUBLE), (SELECT quantile_cont(n_chars, 0.5) FROM rev)) AS n_chars, "
        "coalesce(CAST(quality AS DOUBLE), (SELECT quantile_cont(quality, 0.5) FROM rev)) AS quality, "
        "coalesce(verdict, (SELECT v FROM m)) AS verdict FROM rev"
    ),
    "standardize": (
        f"WITH {_SQL_LINES} SELECT row_id, "
        + ", ".join(f"round({_Z(c)}, 6) AS l_{c}" for c in ("quantity", "extendedprice", "discount"))
        + " FROM lines"
    ),
    "one_hot": (
        "WITH c AS (SELECT p_brand, row_number() OVER (ORDER BY count(*) DESC, p_brand) AS rn FROM part GROUP BY p_brand), "
        "lv AS (SELECT list(p_brand ORDER BY p_brand) AS l FROM c WHERE rn <= 9) "
        "SELECT p_partkey, array_to_string(list_transform(l, lambda v: CAST(v = p_brand AS INTEGER)), '') || "
        "CAST(CAST(NOT list_contains(l, p_brand) AS INTEGER) AS VARCHAR) AS slots FROM part, lv"
    ),
    "noise_target": (
        f"WITH {_SQL_LINES}, s AS (SELECT 5.0::DOUBLE * (stddev_pop(l_extendedprice) + 1e-12) AS sc FROM lines), picked AS ("
        + sql_pick("lines", sql_key(42, "target", "row_id"), "CAST(round_even(0.05 * {n}, 0) AS BIGINT)")
        + ") SELECT row_id, round(l_extendedprice + CASE WHEN was_corrupted THEN sc * sqrt(-2.0::DOUBLE * ln(("
        + sql_word(42, "noise/r", "row_id")
        + " + 1) / 4294967296.0::DOUBLE)) * cos(6.283185307179586::DOUBLE * "
        + sql_uniform(42, "noise/a", "row_id")
        + ") ELSE 0 END, 3) AS l_extendedprice, was_corrupted FROM picked, s"
    ),
    "multihot": (
        f"WITH {_SQL_BITS} SELECT row_id, array_to_string(y, '') AS bits, "
        "array_to_string(list_filter([0, 1, 2], lambda i: y[i + 1] = 1), '') AS codes FROM bits"
    ),
    "flip_bits": (
        f"WITH {_SQL_BITS}, picked AS ("
        + sql_pick("bits", sql_key(42, "bitflip", "row_id"), "CAST(round_even(0.2 * {n}, 0) AS BIGINT)")
        + f"), b AS (SELECT *, {sql_word(42, 'bit', 'row_id')} % 3 AS bit FROM picked) SELECT row_id, "
        "array_to_string(list_transform([0, 1, 2], lambda i: CASE WHEN was_corrupted AND i = bit THEN 1 - y[i + 1] "
        "ELSE y[i + 1] END), '') AS bits, was_corrupted FROM b"
    ),
    "multilabel_issues": _sql_multilabel(),
    "multilabel_metrics": (
        f"WITH {_SQL_BIT_PROBS}, g AS (SELECT y, list_transform(p, lambda x: CASE WHEN x > 0.5 THEN 1 ELSE 0 END) AS h FROM ml), "
        "a AS (SELECT avg(CAST(y = h AS INTEGER)) AS subset_accuracy, "
        "avg((abs(y[1] - h[1]) + abs(y[2] - h[2]) + abs(y[3] - h[3])) / 3) AS hamming_loss, "
        + ", ".join(f"sum(y[{i}] * h[{i}]) AS tp{i}, sum(y[{i}] + h[{i}]) AS al{i}" for i in (1, 2, 3))
        + " FROM g) SELECT metric, round(value, 6) AS value FROM (SELECT subset_accuracy, hamming_loss, "
        "CAST(2.0 * (tp1 + tp2 + tp3) / (al1 + al2 + al3) AS DOUBLE) AS f1_micro, CAST(("
        + " + ".join(f"CASE WHEN al{i} > 0 THEN 2.0::DOUBLE * tp{i} / al{i} ELSE 0 END" for i in (1, 2, 3))
        + ") / 3 AS DOUBLE) AS f1_macro FROM a) UNPIVOT (value FOR metric IN (subset_accuracy, hamming_loss, f1_micro, f1_macro))"
    ),
    "regression_quality": (
        f"WITH {_SQL_FOLD_MEANS} SELECT row_id, label, round(predicted_label, 5) AS predicted_label, "
        "round(label_score, 5) AS label_score, is_label_issue FROM fl"
    ),
    "regression_issues": (
        f"WITH {_SQL_FOLD_MEANS} SELECT row_id, label, round(predicted_label, 5) AS predicted_label, "
        "round(label_score, 5) AS label_score, is_label_issue FROM fl WHERE is_label_issue"
    ),
    "regression_issues_top": (
        f"WITH {_SQL_FOLD_MEANS}, w AS (SELECT * FROM fl ORDER BY label_score, row_id LIMIT 200) "
        "SELECT row_id, label, round(predicted_label, 5) AS predicted_label, round(label_score, 5) AS label_score, "
        "is_label_issue FROM w WHERE is_label_issue"
    ),
    "reg_metrics": (
        f"WITH {_SQL_FOLD_MEANS}, a AS (SELECT avg((y - predicted) * (y - predicted)) AS mse, avg(abs(y - predicted)) AS mae, "
        "1 - avg((y - predicted) * (y - predicted)) / var_pop(y) AS r2 FROM reg) "
        "SELECT metric, round(value, 4) AS value FROM (SELECT mse, sqrt(mse) AS rmse, mae, r2 FROM a) "
        "UNPIVOT (value FOR metric IN (mse, rmse, mae, r2))"
    ),
}
