from __future__ import annotations

import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from rowsift.llm import bpe

PATH = bpe.default_path()
OWN = bpe.WordBpe(PATH)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


ODD = [
    "",
    " ",
    "<|endoftext|>",
    "a<|endoftext|>b <|startoftext|>",
    "<|endof<|endoftext|>",
    "<|EndOfText|>",
    "ΟΔΟΣ ΣΑΣ",
    "I'M it's ''s they'RE",
    "ａ é ́ x ́",
    "İI ǅ",
    "\x1c a\x1db",
    "a\u0085b c　d",
    "12 3½ ²",
    "!!!..\x00\x01",
    "😀😀 a😀",
    "中文字 한국어 日本語 ไทย",
    "a" * 3000,
]


def check(library, text):
    ids = library.encode(text, add_special_tokens=False).ids
    mine = OWN.encode(text)
    assert mine == ids
    assert OWN.decode(mine) == library.decode(ids, skip_special_tokens=False)


@pytest.mark.parametrize("text", ODD)
def test_odd_texts(library, text):
    check(library, text)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.characters(blacklist_categories=["Cs"]), max_size=40))
def test_any_text(library, text):
    check(library, text)


def test_every_character(library):
    for cp in range(0, 0x30000, 7):
        if not 0xD800 <= cp < 0xE000:
            check(library, f"a{chr(cp)}b")


def test_small_memo_changes_nothing(library):
    texts = [f"word{i % 50}ness et {i}" for i in range(300)]
    small = bpe.WordBpe(PATH, memo=8)
    for t in texts:
        assert small.encode(t) == library.encode(t, add_special_tokens=False).ids


def test_cuts_are_pairs_of_no_token():
    own = OWN
    assert own.cut(["t", "h", "e</w>"]) == [["t", "h", "e</w>"]]
    parts = own.cut(list("qzx") + ["q</w>"])
    assert len(parts) > 1 and sum(parts, []) == ["q", "z", "x", "q</w>"]


def test_documents_against_the_library(spark, library):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in bpe.encode_table(spark, docs).collect():
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        decoded = library.decode(ids, skip_special_tokens=False)
        assert r.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()


def test_awkward_rows(spark, awkward, nothing):
    rows = bpe.encode_table(spark, awkward).collect()
    assert len(rows) == 11
    empty = hashlib.sha256(b"").hexdigest()
    assert all(r.n_tokens == 0 and r.ids_sha256 == empty for r in rows if r.doc_id in (1, 2, 6))
    assert len({r.ids_sha256 for r in rows if r.doc_id in (None, 3, 4)}) == 1
    assert bpe.encode_table(spark, nothing).count() == 0
    from pyspark.sql import functions as F

    wide = bpe.encode_decode(awkward.withColumn("ids", F.lit(1)), PATH)
    assert wide.columns[-2:] == ["_ids", "decoded"] and wide.count() == 11
