from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from rowsift.functions import ranking
from rowsift.functions.arrays import active_codes, argmax, multi_hot, safe_divide, spread_probs
from rowsift.functions.hashing import hash_key, hash_normal, hash_poisson1, hash_uniform
from rowsift.functions.runtime import checked_broadcast, collect_small
from rowsift.functions.skew import skew_join
from rowsift.functions.text import is_digit, is_title, is_upper, title_year


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows share one group and one value."""
    rng = np.random.default_rng(3)
    n = 3000
    g = np.where(rng.random(n) < 0.34, 0, rng.integers(1, 6, n))
    v = np.where(rng.random(n) < 0.34, 0.5, rng.random(n).round(3))
    pdf = pd.DataFrame({"row_id": rng.permutation(n).astype("int64"), "g": g.astype("int32"), "v": v})
    return pdf, spark.createDataFrame(pdf)


def test_range_rank(skewed):
    pdf, df = skewed
    want = pdf.sort_values(["v", "row_id"]).groupby("g").cumcount() + 1
    got = ranking.range_rank(df, [F.col("v"), F.col("row_id")], ["g"]).toPandas().set_index("row_id")["rank"]
    assert (got.loc[pdf["row_id"]].to_numpy() == want.sort_index().to_numpy()).all()


def test_range_rank_without_groups(skewed):
    pdf, df = skewed
    got = ranking.range_rank(df, [F.desc("v"), F.col("row_id")]).orderBy("rank").toPandas()
    want = pdf.sort_values(["v", "row_id"], ascending=[False, True])
    assert got["row_id"].tolist() == want["row_id"].tolist()
    assert got["rank"].tolist() == list(range(1, len(pdf) + 1))


def test_running_totals(skewed):
    pdf, df = skewed
    per = df.groupBy("g", "v").agg(F.count(F.lit(1)).alias("c"))
    got = ranking.running_totals(per, ["v"], ["c"], ["g"]).toPandas().sort_values(["g", "v"])
    want = got.groupby("g")["c"].cumsum()
    assert (got["c_upto"] == want).all()


def test_top_ranked_with_table_of_limits(spark, skewed):
    pdf, df = skewed
    limits = {0: 700, 1: 3, 2: 0, 3: 10_000}
    table = spark.createDataFrame(list(limits.items()), "g int, _n bigint")
    got = ranking.top_ranked(df, table, "v", "row_id", ["g"], descending=True).toPandas()
    for g, n in limits.items():
        want = pdf[pdf["g"] == g].sort_values(["v", "row_id"], ascending=[False, True]).head(n)
        assert set(got[got["g"] == g]["row_id"]) == set(want["row_id"])
    assert not (got["g"] > 3).any()


def test_top_ranked_whole_table(skewed):
    pdf, df = skewed
    got = ranking.top_ranked(df, 1200, "v", "row_id").toPandas()
    assert set(got["row_id"]) == set(pdf.sort_values(["v", "row_id"]).head(1200)["row_id"])


@pytest.mark.parametrize("q", [0.0, 0.01, 0.333, 0.5, 0.9, 1.0])
@pytest.mark.parametrize("local_rows", [1_000_000, 20])
def test_exact_percentile(monkeypatch, skewed, q, local_rows):
    pdf, df = skewed
    monkeypatch.setattr(ranking, "_LOCAL_ROWS", local_rows)
    assert ranking.exact_percentile(df, "v", q) == pytest.approx(float(np.percentile(pdf["v"], q * 100)))


def test_exact_percentile_of_nothing(spark):
    assert ranking.exact_percentile(spark.createDataFrame([(None,)], "v double"), "v", 0.5) is None


@pytest.mark.parametrize("per_prefix", [4096, 2])
def test_pick_smallest(monkeypatch, skewed, per_prefix):
    """Narrow prefixes exercise the histogram of key prefixes."""
    monkeypatch.setattr(ranking, "_ROWS_PER_PREFIX", per_prefix)
    pdf, df = skewed
    out = ranking.pick_smallest(
        df, hash_key(1, "t", "row_id"), lambda s: {g: n // 3 for g, n in s.items()}, ["g"]
    )
    got = out.withColumn("k", hash_key(1, "t", "row_id")).toPandas()
    assert len(got) == len(pdf)
    for _, part in got.groupby("g"):
        part = part.sort_values("k")
        assert part["picked"].tolist() == [i < len(part) // 3 for i in range(len(part))]


@pytest.mark.parametrize("hot_rows", [100, 100_000])
@pytest.mark.parametrize("how", ["inner", "left"])
def test_skew_join(spark, skewed, hot_rows, how):
    pdf, df = skewed
    dim = pd.DataFrame({"g": np.array([0, 1, 2], dtype="int32"), "name": ["a", "b", "c"]})
    got = skew_join(df, spark.createDataFrame(dim), ["g"], how, hot_rows=hot_rows).toPandas()
    want = pdf.merge(dim, on="g", how=how)
    order = ["row_id"]
    a = got.sort_values(order)["name"].fillna("").tolist()
    assert a == want.sort_values(order)["name"].fillna("").tolist()


def test_hash_draws(spark):
    df = spark.range(20_000).select(
        hash_uniform(1, "a", "id").alias("u"), hash_normal(1, "b", "id").alias("z"), hash_poisson1(1, "c", "id").alias("p")
    )
    pdf = df.toPandas()
    assert abs(pdf["u"].mean() - 0.5) < 0.01 and pdf["u"].between(0, 1).all()
    assert abs(pdf["z"].mean()) < 0.03 and abs(pdf["z"].std() - 1) < 0.03
    assert abs(pdf["p"].mean() - 1) < 0.03 and abs(pdf["p"].var() - 1) < 0.05


def test_size_checks(spark):
    with pytest.raises(ValueError):
        collect_small(spark.range(11), 10)
    assert checked_broadcast(spark.range(11), 10).count() == 11
    assert checked_broadcast(spark.range(5), 10).count() == 5


def test_arrays(spark):
    df = spark.createDataFrame([([0.2, 0.4, 0.4], [1, 0, 1], "true", "FALSE", None)], "p array<double>, y array<int>, a string, b string, c string")
    r = df.select(
        argmax("p").alias("arg"),
        active_codes("y").alias("on"),
        multi_hot(F.col("a"), F.col("b"), F.col("c")).alias("hot"),
        spread_probs(F.col("p"), [0, 2, 3], 5).alias("wide"),
        safe_divide(F.lit(1.0), F.lit(0.0), 7.0).alias("div"),
    ).first()
    assert r["arg"] == 1 and r["on"] == [0, 2] and r["hot"] == [1, 0, 0]
    assert r["wide"] == [0.2, 0.0, 0.4, 0.4, 0.0] and r["div"] == 7.0


def test_word_shapes(spark):
    words = ["Hello", "HELLO", "hello", "McDonald", "A1", "123", "1st", "X", "é", "É", "O'Neil", "don't", "-", "A-B", "2Go", "Ab-Cd"]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    got = df.select("w", is_upper(F.col("w")).alias("u"), is_title(F.col("w")).alias("t"), is_digit(F.col("w")).alias("d")).collect()
    for r in got:
        w = r["w"]
        assert (r["u"], r["t"], r["d"]) == (w.isupper(), w.istitle(), w.isdigit()), w


def test_title_year(spark):
    df = spark.createDataFrame([("Toy Story (1995)",), ("No year",), ("Two (1990) (2001) ",), (None,)], "t string")
    assert [r[0] for r in df.select(title_year(F.col("t"))).collect()] == [1995, None, 2001, None]
