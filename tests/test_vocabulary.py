"""The exact token dictionary against a dictionary on the driver."""

from __future__ import annotations

from collections import Counter

import pytest

from rowsift.functions import skew
from rowsift.operators import vocabulary
from rowsift.operators.features import TOKEN_FEATURES, token_features
from rowsift.operators.models import fit_token_tagger
from rowsift.operators.vocabulary import fit_token_dictionary


def names(row):
    return [c if c.startswith("is_") else f"{c}={row[c]}" for c in TOKEN_FEATURES if row[c] not in (None, False)]


@pytest.fixture(scope="module")
def tokens(spark):
    words = "The cat of Zoë and the CAT saw 12 cats = is_upper prev_w=of".split()
    rows = [(s, i, words[(s * 7 + i * 3) % len(words)], i % 3) for s in range(6) for i in range(8 + s)]
    return token_features(spark.createDataFrame(rows, "sent_id int, tok_i int, token string, label int"))


@pytest.mark.parametrize("hot", [100_000, 5])
def test_equals_driver_dictionary(spark, tokens, monkeypatch, hot):
    monkeypatch.setattr(skew.skew_join, "__defaults__", ("inner", hot, None))
    rows = tokens.collect()
    counts = Counter(n for r in rows for n in names(r))
    ids = {n: i for i, n in enumerate(sorted(counts, key=lambda n: n.encode()))}
    d = fit_token_dictionary(tokens)
    assert {(r["name"], r["id"], r["n"]) for r in d.table.collect()} == {(n, i, counts[n]) for n, i in ids.items()}
    assert d.size == len(ids)
    want = {(r["sent_id"], r["tok_i"]): sorted(ids[n] for n in names(r)) for r in rows}
    got = d.vectors(tokens).collect()
    assert len(got) == len(rows)
    for r in got:
        assert list(r["features"].indices) == want[r["sent_id"], r["tok_i"]]
        assert r["features"].size == d.size and set(r["features"].values) == {1.0}


def test_unseen_features_and_nulls(spark, tokens):
    d = fit_token_dictionary(tokens)
    odd = spark.createDataFrame([(90, 0, "qqqqqq"), (91, 0, None), (92, 0, "")], "sent_id int, tok_i int, token string")
    got = {r["sent_id"]: r["ids"] for r in d.ids(token_features(odd)).collect()}
    known = {r["name"]: r["id"] for r in d.table.collect()}
    for s in (90, 91, 92):
        assert got[s] == sorted(known[n] for n in ("prev_w=<BOS>", "next_w=<EOS>") if n in known)
    empty = fit_token_dictionary(tokens.limit(0))
    assert empty.size == 0 and all(r["ids"] == [] for r in empty.ids(tokens).collect())


def test_tagger_reads_the_vectors(tokens):
    ready = fit_token_dictionary(tokens).vectors(tokens)
    out = fit_token_tagger(ready, 3, 20)(ready).collect()
    assert all(abs(sum(r["probs"]) - 1) < 1e-6 for r in out)


@pytest.mark.parametrize("held, joins", [(100_000, 1), (2, 4)])
def test_frequent_words_are_not_shuffled(tokens, monkeypatch, held, joins):
    """All rows used to go through a shuffle for each of their three words."""
    d = fit_token_dictionary(tokens)
    ids = {r["name"]: r["id"] for r in d.table.collect()}
    sent = []

    def seen(big, *rest, **named):
        sent.append(big.count())
        return skew.skew_join(big, *rest, **named)

    monkeypatch.setattr(vocabulary, "skew_join", seen)
    monkeypatch.setattr(vocabulary, "_HELD_WORDS", held)
    got = d.ids(tokens).collect()
    assert len(got) == tokens.count() and len(sent) == joins
    for r in got:
        assert r["ids"] == sorted(ids[n] for n in names(r))
    assert max(sent[1:], default=0) <= len(got)


def test_documents_are_dealt_out_not_tokens(spark, tmp_path):
    """Tokens with their keys used to be shuffled for their neighbours, and written with all features."""
    from rowsift.catalog import tagging

    rows = [(i, "The cat saw 12 cats  of Zoë " * (1 + i % 3)) for i in range(40)]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    near = token_features(tagging.tokens(spark, str(tmp_path), together=True)).select("sent_id", "tok_i", "token", "prev_w", "next_w")
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(sent_id") == plan.count("Exchange") == 1
    assert plan.index("Window") < plan.index("Generate") < plan.index("Exchange")
    plain = token_features(tagging.tokens(spark, str(tmp_path))).select(*near.columns)
    assert sorted(near.collect()) == sorted(plain.collect())


def test_words_are_numbered_in_each_column_apart(spark):
    """A word may be a token, a neighbour on one side only, or both; names of a column lie together."""
    rows = [(0, "b", "<BOS>", "a"), (0, "A", "b", "z"), (1, "a", "q", None), (1, None, "é", "b")]
    d = fit_token_dictionary(spark.createDataFrame(rows, "sent_id int, token string, prev_w string, next_w string"))
    got = {r["name"]: (r["id"], r["n"]) for r in d.table.collect()}
    assert [n for n in sorted(got, key=lambda n: n.encode())] == sorted(got, key=got.get) and d.size == len(got)
    assert {n: got[n][1] for n in got if n.split("=")[0] in ("w", "prev_w", "next_w")} == {
        "w=a": 2, "w=b": 1, "prev_w=<BOS>": 1, "prev_w=b": 1, "prev_w=q": 1, "prev_w=é": 1, "next_w=a": 1, "next_w=b": 1, "next_w=z": 1
    }


@pytest.mark.parametrize("same", [True, False])
def test_only_words_not_yet_found_are_shuffled(tokens, monkeypatch, same):
    """A row with one rare word used to be shuffled for all of its words, the most frequent ones too."""
    d = fit_token_dictionary(tokens)
    ids = {r["name"]: r["id"] for r in d.table.collect()}
    met = {}

    def seen(big, dim, keys, how, counts=None):
        met[keys[0]] = {r[0] for r in big.select(keys[0]).distinct().collect()}
        assert (counts is not None) == (same and keys[0] != "w")
        return skew.skew_join(big, dim, keys, how, counts=counts)

    monkeypatch.setattr(vocabulary, "skew_join", seen)
    monkeypatch.setattr(vocabulary, "_HELD_WORDS", 3)
    rows = tokens.collect()
    got = d.joined_ids(tokens if same else tokens.select("*")).collect()
    for c in ("token", "prev_w", "next_w"):
        counts = Counter(r[c] for r in rows)
        assert met[c] == {*counts} - set(sorted(counts, key=lambda w: (-counts[w], w.encode()))[:3])
    want = sorted((r["sent_id"], r["tok_i"], " ".join(map(str, sorted(ids[n] for n in names(r))))) for r in rows)
    assert sorted((r["sent_id"], r["tok_i"], r["ids"]) for r in got) == want
