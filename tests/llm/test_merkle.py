from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from rowsift.llm import merkle as m


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def enc(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def tree(digests):
    """Root, and for each leaf the siblings (left, right) level by level."""
    at, paths = list(range(len(digests))), [[] for _ in digests]
    while len(digests) > 1:
        runs = [digests[i : i + 3] for i in range(0, len(digests), 3)]
        for i, p in enumerate(at):
            run, k = runs[p // 3], p % 3
            paths[i].append(("".join(run[:k]), "".join(run[k + 1 :])))
        at = [p // 3 for p in at]
        digests = [sha("".join(r)) for r in runs]
    return digests[0], paths


def brute(rows):
    parts = defaultdict(list)
    for r in rows:
        leaf = sha("".join(enc(r[f]) for f in m.FIELDS))
        text = r["text"]
        if r["doc_id"] is not None and text is not None and zlib.crc32(str(r["doc_id"]).encode()) % 2 == 0:
            text = text.replace("\n", "")
        other = sha("".join(enc(text if f == "text" else r[f]) for f in m.FIELDS))
        parts[r["source"]].append((r["doc_id"], leaf, other))
    names = sorted(parts, key=lambda s: (s is not None, (s or "").encode()))
    for s in names:
        parts[s].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    trees = {s: tree([x[1] for x in parts[s]]) for s in names}
    root, upper = tree([trees[s][0] for s in names])
    out = []
    for s, up in zip(names, upper):
        for (doc_id, leaf, other), path in zip(parts[s], trees[s][1]):
            value = other
            for left, right in path + up:
                value = sha(left + value + right)
            proof = sha("".join(a + b for a, b in path + up))
            out.append((doc_id, leaf, trees[s][0], root, proof, value, value == root))
    return sorted(out, key=str)


def rows_of(df):
    cols = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=str)


def some_rows(n):
    sizes = [("a", n), ("ä", 1), (None, 5), ("b", 27), ("", 3), ("Z", 2)]
    out = []
    for s, k in sizes:
        out += [(len(out) + i, f"line {i}\nline two of {s}" if i % 3 else None if i % 2 else "plain", s) for i in range(k)]
    return out


@pytest.mark.parametrize("levels", [1, 2, 7])
def test_against_brute_force(docs_of, monkeypatch, levels):
    monkeypatch.setattr(m, "BLOCK_LEVELS", levels)
    docs = docs_of(some_rows(40))
    assert rows_of(m.tamper_report(docs)) == brute(docs.collect())


def test_many_parts(docs_of, monkeypatch):
    monkeypatch.setattr(m, "BLOCK_LEVELS", 2)
    docs = docs_of([(i, f"t\n{i}", f"s{i}") for i in range(31)])
    assert rows_of(m.tamper_report(docs)) == brute(docs.collect())


def test_awkward_single_and_empty(awkward, docs_of, nothing):
    assert rows_of(m.tamper_report(awkward)) == brute(awkward.collect())
    one = docs_of([(7, "a\nb")])
    got = rows_of(m.tamper_report(one))
    assert got == brute(one.collect()) and got[0][1] == got[0][2] == got[0][3]
    assert m.tamper_report(nothing).count() == 0


def test_proofs_verify_and_catch_any_change(docs_of):
    docs = docs_of([(i, f"text {i}", "st"[i % 2]) for i in range(20)])
    leaf = m.leaf_digest([F.col("doc_id"), F.col("text")])
    proofs = m.manifest(docs, leaf, F.col("source"), F.col("doc_id"), F.struct("doc_id", "text"))
    changed = m.leaf_digest([F.col("load.doc_id"), F.concat("load.text", F.lit("!"))])
    row = proofs.agg(
        F.count_if(m.folded(F.col("leaf"), F.col("steps")) == F.col("root")).alias("good"),
        F.count_if(m.folded(changed, F.col("steps")) == F.col("root")).alias("bad"),
        F.count_distinct("root").alias("roots"),
    ).first()
    assert tuple(row) == (20, 0, 1)


def test_no_shuffle_between_the_levels_of_a_block(docs_of):
    nodes = docs_of([(i, "x") for i in range(50)]).select(
        F.col("source").alias("part"), F.col("doc_id").alias("at"), F.length("text").cast("bigint").alias("n"), F.sha2("text", 256).alias("digest"), F.struct("doc_id").alias("load")
    )
    plan = m._rolled(nodes, ["part"], 4)._jdf.queryExecution().explainString(
        nodes.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple")
    )
    assert plan.count("Exchange hashpartitioning") == 1, plan
