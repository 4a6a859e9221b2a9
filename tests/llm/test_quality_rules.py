from __future__ import annotations

import random
import re

import pytest

from rowsift.llm import quality_rules as q


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    hit = set()
    for i, w in enumerate(windows):
        if windows.count(w) > 1:
            hit |= set(range(i, i + 5))
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_dup_lines": dup,
        "n_repeat_words": len(hit),
    }


def test_counts_against_brute_force(spark, docs_of):
    rng = random.Random(4)
    texts = ["", None, "a", "a b c d", "x x x x x x x", "a\nb\n a\na \n\n  \na", "é# $%\x0b|<\x0c>\x85 \xa0b"]
    texts += [" ".join(rng.choice("abc") + rng.choice(["", "\n", "#"]) for _ in range(rng.randint(1, 60))) for _ in range(60)]
    got = q.stats_table(docs_of(list(enumerate(texts)))).collect()
    assert len(got) == len(texts)
    for r in got:
        want = brute(texts[r.doc_id])
        assert {k: r.stats[k] for k in want} == want
        assert q.MIN_WORDS == 10


def labelled(spark, n=900, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        bad = i % 5 == 0
        noisy = bad and i % 10 == 0
        rows.append(
            (
                i,
                float(rng.randint(20, 400)),
                rng.uniform(4, 6),
                rng.uniform(0.4, 3) if noisy else rng.uniform(0, 0.1),
                0.0,
                rng.uniform(0.5, 1) if bad and not noisy else rng.uniform(0, 0.2),
                bad,
            )
        )
    return spark.createDataFrame(rows, "doc_id long, n_words double, mean_word_chars double, symbols_per_word double, dup_line_share double, repeat_share double, bad boolean")


def test_learned_list_on_held_out_rows(spark):
    rules = q.learn_decision_list(labelled(spark))
    assert {r.conditions[0].feature for r in rules.rules} == {"symbols_per_word", "repeat_share"}
    held = labelled(spark, seed=2).withColumn("hit", rules.rejects())
    wrong = held.filter("hit <> bad").count()
    assert wrong < 0.02 * held.count()
    assert held.filter("hit and not bad").count() <= 0.02 * held.filter("hit").count()


def test_no_labels_and_one_class_reject_nothing(spark):
    assert q.learn_decision_list(labelled(spark).limit(0)).rules == ()
    assert q.learn_decision_list(labelled(spark).filter("not bad")).rules == ()


def test_awkward_rows(spark, awkward, nothing):
    labels = spark.createDataFrame([(3, None, 0), (4, 1, 0), (4, 0, 0), (None, 0, 0)], "doc_id long, quality int, toxic int")
    rows = q.quality_table(awkward, labels).collect()
    assert len(rows) == 11
    by_id = {r.doc_id: r for r in rows}
    assert by_id[1].n_words == 0 and by_id[1].base_failed and not by_id[1].kept
    assert by_id[5].n_words == 60_000 and by_id[5].base_failed
    assert by_id[3].kept
    kept = q.keep_good(awkward, labels)
    assert kept.columns == awkward.columns
    assert sorted((r.doc_id or 0) for r in kept.collect()) == sorted((r.doc_id or 0) for r in rows if r.kept)
    assert q.quality_table(nothing, labels).count() == 0


@pytest.mark.parametrize("side", [True, False])
def test_condition_is_false_on_null(spark, side):
    c = q.Condition("n_words", side, 3.0)
    got = spark.createDataFrame([(None,), (2.0,), (3.0,)], "n_words double").select(c.column().alias("c")).collect()
    assert [r.c for r in got] == [False, not side, side]
