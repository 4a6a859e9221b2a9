"""DuckDB SQL for the manifest and the spelling variants."""

from __future__ import annotations

from rowsift.llm.common import LOWER, UPPER
from rowsift.llm.merkle import ARITY, FIELDS
from rowsift.llm.spelling import MIN_CHARS, MIN_COUNT, MISSPELT

#: Levels of a tree that the SQL has room for.
LEVELS = 14

#: crc32 as a macro-like pair of expressions: the table by its rule, and the fold over bytes.
_CRC_TABLE = (
    "crc AS (SELECT list(v ORDER BY i) AS t FROM (SELECT i, list_reduce(range(8), "
    "lambda acc, k: CASE WHEN acc & 1 = 1 THEN xor(acc >> 1, 3988292384) ELSE acc >> 1 END, i) AS v FROM range(256) r(i)))"
)


def _crc(string: str) -> str:
    """Unsigned crc32 of a string of code points below 256, with table ``crc`` in scope."""
    points = f"list_transform(string_split({string}, ''), lambda c: unicode(c)::BIGINT)"
    utf8 = f"flatten(list_transform({points}, lambda c: CASE WHEN c < 128 THEN [c] ELSE [192 + (c >> 6), 128 + (c & 63)] END))"
    return f"xor(list_reduce({utf8}, lambda acc, x: xor(acc >> 8, crc.t[(xor(acc, x) & 255) + 1]), 4294967295::BIGINT), 4294967295)"


def _leaf(text: str) -> str:
    parts = []
    for f in FIELDS:
        value = text if f == "text" else f"CAST({f} AS VARCHAR)"
        parts.append(f"coalesce(strlen({value}) || ':' || {value}, '-')")
    return f"sha256({' || '.join(parts)})"


def _tree(name: str, base: str, key: str, order: str) -> list[str]:
    """CTEs of a tree over ``base`` (key, id, h): ``name_top`` (key, h) and ``name_path`` (key, id, fold, proof).

    ``fold`` is the top recomputed from ``f``, ``proof`` all siblings.
    """
    out = [
        f"{name}0 AS (SELECT {key}, h, row_number() OVER (PARTITION BY {key} ORDER BY {order}) - 1 AS pos, "
        f"count(*) OVER (PARTITION BY {key}) AS n FROM {base})",
        f"{name}p0 AS (SELECT {key}, id, f AS fold, '' AS proof, "
        f"row_number() OVER (PARTITION BY {key} ORDER BY {order}) - 1 AS pos FROM {base})",
    ]
    kids = ", ".join(f"coalesce(max(h) FILTER (pos % {ARITY} = {i}), '') AS h{i}" for i in range(ARITY))
    joined = " || ".join(f"h{i}" for i in range(ARITY))
    before = " ".join(f"WHEN {i} THEN {' || '.join(f'h{j}' for j in range(i)) or repr('')}" for i in range(ARITY))
    after = " ".join(f"WHEN {i} THEN {' || '.join(f'h{j}' for j in range(i + 1, ARITY)) or repr('')}" for i in range(ARITY))
    for k in range(LEVELS):
        out += [
            f"{name}k{k} AS MATERIALIZED (SELECT {key}, pos // {ARITY} AS up, any_value(n) AS n, {kids} FROM {name}{k} GROUP BY {key}, pos // {ARITY})",
            f"{name}{k + 1} AS (SELECT {key}, up AS pos, (n + {ARITY - 1}) // {ARITY} AS n, "
            f"CASE WHEN n = 1 THEN h0 ELSE sha256({joined}) END AS h FROM {name}k{k})",
            f"{name}s{k} AS (SELECT p.{key}, id, up AS pos, fold, proof, n, CASE pos % {ARITY} {before} END AS l, "
            f"CASE pos % {ARITY} {after} END AS r FROM {name}p{k} p JOIN {name}k{k} k ON p.{key} = k.{key} AND p.pos // {ARITY} = k.up)",
            f"{name}p{k + 1} AS MATERIALIZED (SELECT {key}, id, pos, CASE WHEN n = 1 THEN fold ELSE sha256(l || fold || r) END AS fold, "
            f"CASE WHEN n = 1 THEN proof ELSE proof || l || r END AS proof FROM {name}s{k})",
        ]
    return [*out, f"{name}_top AS (SELECT {key}, h FROM {name}{LEVELS})", f"{name}_path AS (SELECT {key}, id, fold, proof FROM {name}p{LEVELS})"]


_TAMPERED = f"CASE WHEN {_crc('CAST(doc_id AS VARCHAR)')} % 2 = 0 THEN replace(text, chr(10), '') ELSE text END"

MERKLE = "WITH " + ",\n".join(
    [
        _CRC_TABLE,
        f"leaves AS MATERIALIZED (SELECT row_number() OVER () AS id, coalesce('v' || source, '') AS part, doc_id, {_leaf('text')} AS h, "
        f"{_leaf('(' + _TAMPERED + ')')} AS f FROM documents, crc)",
        *_tree("a", "leaves", "part", "doc_id NULLS FIRST, h"),
        "subroots AS (SELECT 1 AS one, part AS id, h, h AS f FROM a_top)",
        *_tree("b", "subroots", "one", "id"),
        # the way up from a tampered subroot: siblings of its path, folded level by level from the tampered value
        "changed AS (SELECT d.id, p.part, p.fold, p.proof FROM leaves d JOIN a_path p ON p.id = d.id)",
        *[
            f"c{k} AS (SELECT c.id, c.part, c.proof, s.at0, CASE WHEN s.n = 1 THEN c.fold ELSE sha256(s.l || c.fold || s.r) END AS fold "
            f"FROM {'changed' if k == 0 else f'c{k - 1}'} c JOIN (SELECT id AS part_, pos AS at0, n, l, r FROM bs{k}) s ON s.part_ = c.part)"
            for k in range(LEVELS)
        ],
        "root AS (SELECT h AS root FROM b_top)",
    ]
) + f"""
SELECT d.doc_id, d.h AS leaf, t.h AS subroot, root.root, sha256(c.proof || b.proof) AS proof_sha256,
       c.fold AS folded_root, c.fold = root.root AS verified
FROM leaves d JOIN c{LEVELS - 1} c ON c.id = d.id JOIN a_top t ON t.part = d.part JOIN b_path b ON b.id = d.part, root
"""

SPELLING = f"""
WITH RECURSIVE {_CRC_TABLE},
runs AS (SELECT doc_id, w, count(*) AS c FROM (
    SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')), '{UPPER}', '{LOWER}') AS w FROM documents
  ) GROUP BY doc_id, w),
hashed AS (SELECT w, c, {_crc("coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || w")} AS h FROM runs, crc),
words AS MATERIALIZED (SELECT word, sum(c)::BIGINT AS n FROM (
    SELECT CASE WHEN h % {MISSPELT} = 0 THEN substr(w, 1, h % length(w)) || substr(w, h % length(w) + 2) ELSE w END AS word, c FROM hashed
  ) WHERE length(word) >= {MIN_CHARS} GROUP BY word HAVING sum(c) >= {MIN_COUNT}),
dels AS MATERIALIZED (SELECT word, i, substr(word, 1, i) || substr(word, i + 2) AS d FROM (SELECT word, unnest(range(length(word))) AS i FROM words)),
longer AS (SELECT d.word AS a, w.word AS b FROM dels d JOIN words w ON w.word = d.d),
pairs AS (SELECT a, b FROM longer UNION SELECT b, a FROM longer
  UNION SELECT x.word, y.word FROM dels x JOIN dels y ON x.d = y.d AND x.i = y.i AND x.word <> y.word),
near AS (SELECT a AS word, count(*) AS n_near, max(w.n) AS most, arg_min(b, (-w.n, b)) AS best FROM pairs JOIN words w ON w.word = b GROUP BY a),
forms AS MATERIALIZED (SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN most >= 2 * w.n THEN best END AS form,
    CASE WHEN most >= 2 * w.n THEN most END AS form_n FROM words w LEFT JOIN near ON near.word = w.word),
chain AS (SELECT word, word AS root FROM forms UNION ALL SELECT c.word, f.form FROM chain c JOIN forms f ON f.word = c.root WHERE f.form IS NOT NULL)
SELECT f.word, f.form, c.root, f.n, f.n_near, f.form_n::BIGINT AS form_n
FROM forms f JOIN chain c ON c.word = f.word JOIN forms e ON e.word = c.root AND e.form IS NULL
"""
