from __future__ import annotations

import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from rowsift.plans import configs
from rowsift.sources import readers, shaping, sinks
from rowsift.sources.registry import DatasetRegistry


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


def put(folder, name, text, encoding="utf-8"):
    path = os.path.join(folder, name)
    with open(path, "w", encoding=encoding, newline="") as f:
        f.write(text)
    return path


def test_headerless_csv(spark, folder):
    path = put(folder, "a.csv", "39, State-gov , ?, <=50K\n?,Private,x,>50K\n")
    rows = readers.read_headerless_csv(spark, path, "age int, work string, occ string, income string").collect()
    assert [tuple(r) for r in rows] == [(39, "State-gov", None, "<=50K"), (None, "Private", "x", ">50K")]


def test_csv_with_header_drops_leakage(spark, folder):
    path = put(folder, "b.csv", "dteday,casual,cnt\n2011-01-01,3,16\n")
    df = readers.read_csv(spark, path, drop=["casual", "dteday", "registered"])
    assert df.columns == ["cnt"] and df.first()["cnt"] == 16


def test_delimited_latin1(spark, folder):
    path = put(folder, "u.item", "1|Café (1995)|1\n2|X|0\n", "ISO-8859-1")
    items = readers.read_delimited(spark, path, "id int, title string, drama int", "|", "ISO-8859-1")
    out = shaping.item_features(items, "title", ["drama"]).collect()
    assert items.first()["title"] == "Café (1995)"
    assert [tuple(r) for r in out] == [(1, 1995, 1), (2, None, 0)]
    path = put(folder, "u.data", "7\t1\t5\t88\n8\t9\t3\t88\n")
    ratings = readers.read_delimited(spark, path, "annotator_id bigint, example_id bigint, label int, ts bigint", "\t")
    labels, kept = shaping.align_items(ratings, items, "id")
    assert [r["annotator_id"] for r in labels.collect()] == [7] and [r["id"] for r in kept.collect()] == [1]


CONLLU = (
    "# sent_id = a\n# text = The dogs\n1\tThe\tthe\tDET\n2-3\tdogsn't\t_\t_\n2\tdogs\tdog\tNOUN\n\n"
    "# only a comment\n\n"
    "1\tRun\trun\tVERB\n1.1\tghost\t_\t_\n2\t!\t!\tPUNCT\n\n"
    "1\tEnd\tend\tNOUN\n"
)


def test_conllu(spark, folder):
    path = put(folder, "x.conllu", CONLLU)
    got = [tuple(r) for r in readers.read_conllu(spark, path).orderBy("sent_id", "tok_i").collect()]
    assert got == [
        (0, 0, "The", "DET"),
        (0, 1, "dogs", "NOUN"),
        (1, 0, "Run", "VERB"),
        (1, 1, "!", "PUNCT"),
        (2, 0, "End", "NOUN"),
    ]
    capped = readers.read_conllu(spark, path, token="lemma", max_sentences=2)
    assert {r["sent_id"] for r in capped.collect()} == {0, 1}
    assert {r["token"] for r in capped.collect()} == {"the", "dog", "run", "!"}


def test_conllu_line_ends_blanks_and_short_lines(spark, folder):
    lines = ["# one", "1\tA\ta\tX", "2\tB\tb\tY", "", "1\tC\tc\tX", "3\tshort", " \t", "1-2\tno\tno\tX", "1\tD\td\tZ", "", "", "1\tE\te\tX"]
    want = [(0, 0, "A", "X"), (0, 1, "B", "Y"), (1, 0, "C", "X"), (2, 0, "D", "Z"), (3, 0, "E", "X")]
    for k, end in enumerate(("\n", "\r\n")):
        path = put(folder, f"ends{k}.conllu", end.join(lines))
        got = readers.read_conllu(spark, path).orderBy("sent_id", "tok_i")
        assert [tuple(r) for r in got.collect()] == want
    # the end of a file ends a sentence
    both = readers.read_conllu(spark, f"{folder}/ends*.conllu")
    assert sorted({r["sent_id"] for r in both.collect()}) == list(range(8))


def test_conllu_in_many_splits(spark, folder):
    path = put(folder, "long.conllu", "\n".join(f"{k % 7 + 1}\tw{k}\tl\tX" if k % 10 else "" for k in range(4000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        got = readers.read_conllu(spark, path).orderBy("sent_id", "tok_i").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [r["token"] for r in got] == [f"w{k}" for k in range(4000) if k % 10]
    assert [(r["sent_id"], r["tok_i"]) for r in got] == [(k // 10, k % 10 - 1) for k in range(4000) if k % 10]


def test_registry(spark):
    reg = DatasetRegistry()
    reg.register("toy", lambda s: s.createDataFrame([(1, "a")], "x int, y string"), "classification", "y")
    data = reg.load(spark, "toy")
    assert data.features_df.columns == ["x"] and data.target_df.columns == ["y"] and reg.names() == ["toy"]
    with pytest.raises(ValueError):
        reg.load(spark, "other")
    reg.register("bad", lambda s: s.range(1), "regression", "y")
    with pytest.raises(ValueError):
        reg.load(spark, "bad")


def test_sinks(spark, folder):
    df = spark.createDataFrame([(1, [0.5], "b"), (2, [1.0], "c")], "row_id bigint, p array<double>, variant string")
    sinks.write_csv(df, f"{folder}/csv")
    assert spark.read.option("header", True).csv(f"{folder}/csv").count() == 2
    sinks.write_json(df, f"{folder}/json")
    back = [json.loads(r["value"]) for r in spark.read.text(f"{folder}/json").collect()]
    assert {b["row_id"] for b in back} == {1, 2} and all("written_at" in b for b in back)
    m = spark.createDataFrame([("a", "x", 1.0), ("a", "y", 2.0)], "variant string, metric string, value double")
    assert sinks.metrics_map(m).first()["metrics"] == {"x": 1.0, "y": 2.0}


def test_shaping(spark):
    df = spark.createDataFrame([(1, 2.0, "x", 3)], "row_id bigint, a double, s string, t int")
    assert shaping.prepare(df, target_offset=-1).first()["label"] == 2
    with pytest.raises(ValueError):
        shaping.split_target(df, "nope")
    with pytest.raises(ValueError):
        shaping.feature_array(df.select("row_id", "s"))
    assert shaping.feature_array(df, label="t").first().asDict() == {"row_id": 1, "features": [2.0], "ground_truth": 3}
    assert shaping.zero_based(df, "t").first()["t"] == 2
    nan = spark.createDataFrame([(float("nan"),)], "v double")
    assert shaping.nan_to_null(nan).first()["v"] is None


def test_synthetic_anomalies(spark):
    df = shaping.synthetic_anomalies(spark, 400, 4, 0.05)
    assert df.count() == 400 and df.filter("is_anomaly = 1").count() == 20
    assert df.filter(F.abs("feature_0") > 6.0).count() == 0


@pytest.mark.parametrize(
    "make",
    [
        lambda: configs.SplitConfig(test_size=0.9),
        lambda: configs.FeatureConfig(impute_numeric="mode"),
        lambda: configs.IssueConfig(cv_folds=1),
        lambda: configs.NoiseConfig(max_rows=5),
        lambda: configs.AnomalyConfig(strategy="other"),
        lambda: configs.AnomalyConfig(contamination=0.9),
        lambda: configs.MulticlassConfig(noise_frac=None),
        lambda: configs.AuditConfig(task="ranking"),
    ],
)
def test_config_limits(make):
    with pytest.raises(ValueError):
        make()


def test_config_defaults():
    c = configs.AuditConfig()
    assert (c.model_name, c.split.test_size, c.issues.cv_folds, c.issues.max_issues) == ("logistic_regression", 0.2, 5, None)
    assert configs.AuditConfig(task="regression").model_name == "ridge"
    with pytest.raises(TypeError):
        configs.SplitConfig(unknown=1)
    with pytest.raises(Exception):
        c.task = "regression"
