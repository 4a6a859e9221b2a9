from __future__ import annotations

import hashlib
import random

from pyspark.sql import functions as F

from rowsift.llm import chat as c

TEXTS = ["", "plain", "\\", "\\b", "\\l", "<turn user>", "</turn>\n", "\\</turn>", "<|image|>", "a < b > c", "\\### Assistant: </turn> ok", "</tur</turn>n>", "é😀\n\n", "\\\\l<", "<turn \\b>\n</turn>"]


def turns(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    return df.select("conv_id", "turn", "role", c.text_part(F.col("text")).alias("parts"))


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def check(spark, rows):
    out = c.format_conversations(turns(spark, rows))
    got = {r.conv_id: r for r in c.digests(out).collect()}
    formatted = {r.conv_id: r.formatted for r in out.select("conv_id", "formatted").collect()}
    convs = {}
    for r in rows:
        convs.setdefault(r[0], []).append(r)
    assert set(got) == set(convs)
    for conv, own in convs.items():
        own = sorted(own, key=lambda r: tuple((x is not None, x) for x in r[1:3]) + (r[3] or "",))
        texts = [(r[2] or "", r[3] or "") for r in own]
        loss = "".join(t for role, t in texts if role == "assistant")
        g = got[conv]
        assert g.n_turns == len(own)
        assert g.turns_sha256 == sha("".join(f"{role}\n{t}\n" for role, t in texts))
        assert (g.loss_chars, g.loss_sha256) == (len(loss), sha(loss))
        assert g.formatted_chars == len(formatted[conv])
    return formatted


def test_round_trip_of_control_strings(spark):
    rows = [(0, i, "assistant" if i % 2 else "user", t) for i, t in enumerate(TEXTS)]
    rows += [(1, i, "assistant", t) for i, t in enumerate(TEXTS)]
    rows += [(2, i, t, "x") for i, t in enumerate(TEXTS)]
    formatted = check(spark, rows)
    assert formatted[0].count("</turn>\n") == len(TEXTS)


def test_generated_texts(spark):
    rng = random.Random(3)

    def some():
        return "".join(rng.choice("\\bl<>/turn|\né ") for _ in range(rng.randint(0, 25)))

    rows = [(i // 5, i % 5, "assistant" if i % 3 else some(), some()) for i in range(200)]
    check(spark, rows)


def test_awkward_rows(spark):
    rows = [(1, 0, "user", None), (1, 0, None, "x"), (1, None, "user", "first"), (None, 0, "assistant", "y"), (2, 3, "user", "a"), (2, 3, "user", "a"), (2, 1, "assistant", "z " * 40_000)]
    check(spark, rows)
    assert c.digests(c.format_conversations(turns(spark, []))).count() == 0


def test_parts_become_placeholders(spark):
    parts = f"""array(
      named_struct('type','text','text','see ','ref',null,'width',null,'height',null,'seconds',null,'pages',null),
      named_struct('type','image','text',null,'ref','a.png','width',56L,'height',29L,'seconds',null,'pages',null),
      named_struct('type','text','text',' <|image|> ','ref',null,'width',null,'height',null,'seconds',null,'pages',null),
      named_struct('type','audio','text',null,'ref','b.wav','width',null,'height',null,'seconds',1.5D,'pages',null),
      named_struct('type','document','text',null,'ref','c.pdf','width',null,'height',null,'seconds',null,'pages',3L),
      named_struct('type','odd|>','text',null,'ref','d','width',null,'height',null,'seconds',null,'pages',null))"""
    df = spark.sql(f"select 1L conv_id, 0L turn, 'user' role, cast({parts} as array<{c.PART}>) parts union all select 1L, 1L, 'assistant', cast(null as array<{c.PART}>)")
    r = c.format_conversations(df).collect()[0]
    assert r.formatted == "<turn user>see <|image|> \\l|image|> <|audio|><|document|><|odd__|></turn>\n<turn assistant></turn>\n"
    assert [(a.type, a.ref, a.tokens) for a in r.attachments] == [("image", "a.png", 4), ("audio", "b.wav", 38), ("document", "c.pdf", 3600), ("odd__", "d", 0)]
    assert r.attachment_tokens == 4 + 38 + 3600
