"""Chat formatting of typed content parts, in DataFrame expressions only.

A visitor, one expression per part type, flattens the parts of a turn into text: text
parts are escaped and stand as they are, images, audio and documents become
placeholders, in order, while their references and the tokens that they expand to are
recorded. Turns are wrapped in markers, and a loss mask holds the spans of the
assistant's text.

Template: ``<turn ROLE>TEXT</turn>`` and a line feed, per turn. Inside texts a backslash
becomes ``\\b`` and the ``<`` of anything that looks like a control string (``<turn``,
``</turn``, ``<|``) becomes ``\\l``; in roles every ``<``, ``>`` and line feed is
escaped as well. After that no backslash stands for itself, so unescaping by plain
replacement is exact, and every marker in the output is the template's own.

Defined results. Null text: empty. Null role: empty. Null or missing parts: no parts.
Unknown part types: a placeholder of their own name, no tokens. Rows of one conversation are
ordered by turn, then role, then text, nulls first; repeated rows are turns of their own.
Null conv_id: one conversation of its own. Empty table: no rows. Other columns never
matter. A conversation is one output text, so its turns meet in one row by nature.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowsift.llm.common import let

OPEN, SHUT, CLOSE = "<turn ", ">", "</turn>\n"
#: What a part holds: text for text parts; ref, width and height, seconds or pages for the others.
PART = "struct<type: string, text: string, ref: string, width: bigint, height: bigint, seconds: double, pages: bigint>"
#: Tokens of a placeholder: one per patch of so many pixels, per second and per page.
PATCH, AUDIO_RATE, PAGE_TOKENS = 28, 25, 1200

Visit = Callable[[Column], Column]


def escape(text: Column) -> Column:
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\b")), r"<(?=/?turn|\|)", r"\\l")


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\l"), F.lit("<")), F.lit("\\b"), F.lit("\\"))


def escape_role(role: Column) -> Column:
    out = F.replace(F.coalesce(role, F.lit("")), F.lit("\\"), F.lit("\\b"))
    for plain, code in (("<", "\\l"), (">", "\\g"), ("\n", "\\n")):
        out = F.replace(out, F.lit(plain), F.lit(code))
    return out


def unescape_role(role: Column) -> Column:
    out = role
    for plain, code in (("<", "\\l"), (">", "\\g"), ("\n", "\\n"), ("\\", "\\b")):
        out = F.replace(out, F.lit(code), F.lit(plain))
    return out


def _ceil(x: Column, by: float) -> Column:
    return F.ceil(F.coalesce(x, F.lit(0)) / F.lit(by)).cast("long")


#: Expanded tokens of one attachment, by type.
TOKENS: dict[str, Visit] = {
    "image": lambda p: _ceil(p["width"], PATCH) * _ceil(p["height"], PATCH),
    "audio": lambda p: F.ceil(F.coalesce(p["seconds"], F.lit(0.0)) * AUDIO_RATE).cast("long"),
    "document": lambda p: F.coalesce(p["pages"], F.lit(0)) * PAGE_TOKENS,
}


def _safe_type(part: Column) -> Column:
    return F.regexp_replace(F.coalesce(part["type"], F.lit("unknown")), r"[^A-Za-z0-9_]", "_")


def visit_text(part: Column) -> Column:
    """What a part becomes in the output."""
    return F.when(part["type"] == "text", escape(F.coalesce(part["text"], F.lit("")))).otherwise(
        F.concat(F.lit("<|"), _safe_type(part), F.lit("|>"))
    )


def visit_tokens(part: Column, tokens: dict[str, Visit] | None = None) -> Column:
    out = F.lit(0).cast("long")
    for kind, count in (tokens or TOKENS).items():
        out = F.when(part["type"] == kind, count(part).cast("long")).otherwise(out)
    return out


def flatten(parts: Column) -> Column:
    """Struct of a turn: text, attachments (type, ref, tokens; in order) and their tokens together."""
    held = F.coalesce(parts, F.array().cast(f"array<{PART}>"))

    def make(p: Column) -> Column:
        attached = F.transform(
            F.filter(p, lambda x: ~F.coalesce(x["type"] == "text", F.lit(False))),
            lambda x: F.struct(_safe_type(x).alias("type"), x["ref"].alias("ref"), visit_tokens(x).alias("tokens")),
        )
        return F.struct(
            F.array_join(F.transform(p, visit_text), "").alias("text"),
            attached.alias("attachments"),
            F.aggregate(attached, F.lit(0).cast("long"), lambda a, x: a + x["tokens"]).alias("attachment_tokens"),
        )

    return let(held, make)


def text_part(text: Column) -> Column:
    """The parts of a turn that has text only."""
    return F.array(F.struct(F.lit("text").alias("type"), F.coalesce(text, F.lit("")).alias("text"), *(F.lit(None).cast(t).alias(n) for n, t in (("ref", "string"), ("width", "bigint"), ("height", "bigint"), ("seconds", "double"), ("pages", "bigint")))))


def format_conversations(turns: DataFrame, assistant: Sequence[str] = ("assistant",)) -> DataFrame:
    """One row per conversation out of (conv_id, turn, role, parts).

    Returns conv_id, formatted, mask (array of start, length in code points; the
    assistant's text), attachments and attachment_tokens.
    """
    rows = turns.select(
        "conv_id",
        F.struct("turn", F.col("role").alias("role"), flatten(F.col("parts")).alias("flat")).alias("t"),
    )
    rows = rows.select("conv_id", F.struct("t.turn", "t.role", F.col("t.flat.text").alias("text"), F.col("t.flat.attachments").alias("attachments"), F.col("t.flat.attachment_tokens").alias("tokens")).alias("t"))
    grouped = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    head = F.transform("turns", lambda t: F.concat(F.lit(OPEN), escape_role(t["role"]), F.lit(SHUT)))
    pieces = grouped.select("conv_id", "turns", head.alias("heads"))
    body = F.zip_with("heads", "turns", lambda h, t: F.concat(h, t["text"], F.lit(CLOSE)))
    step = F.zip_with(
        "heads",
        "turns",
        lambda h, t: F.struct(
            F.length(h).cast("long").alias("head"),
            F.length(t["text"]).cast("long").alias("body"),
            F.coalesce(t["role"].isin(*assistant), F.lit(False)).alias("learned"),
        ),
    )
    spans = F.aggregate(
        step,
        F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start: bigint, length: bigint>>").alias("mask")),
        lambda a, s: F.struct(
            (a["at"] + s["head"] + s["body"] + F.lit(len(CLOSE))).cast("long").alias("at"),
            F.when(s["learned"], F.concat(a["mask"], F.array(F.struct((a["at"] + s["head"]).alias("start"), s["body"].alias("length")))))
            .otherwise(a["mask"])
            .alias("mask"),
        ),
    )
    return pieces.select(
        "conv_id",
        F.array_join(body, "").alias("formatted"),
        spans["mask"].alias("mask"),
        F.flatten(F.transform("turns", lambda t: t["attachments"])).alias("attachments"),
        F.aggregate(F.transform("turns", lambda t: t["tokens"]), F.lit(0).cast("long"), lambda a, x: a + x).alias("attachment_tokens"),
    )


def read_back(formatted: Column) -> Column:
    """Array of (role, text) out of a formatted conversation; placeholders stay as they stand."""
    parts = F.split(formatted, F.lit("</turn>\n"))
    return F.transform(
        F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0))),
        lambda p: let(
            F.locate(SHUT, p),
            lambda at: F.struct(
                unescape_role(F.substring(p, F.lit(len(OPEN) + 1), at - F.lit(len(OPEN) + 1))).alias("role"),
                unescape(F.substring(p, at + 1, F.length(p))).alias("text"),
            ),
        ),
    )


def masked_text(formatted: Column, mask: Column) -> Column:
    """All text under the mask, unescaped, in order and with nothing between."""
    return F.array_join(F.transform(mask, lambda m: unescape(F.substring(formatted, (m["start"] + 1).cast("int"), m["length"].cast("int")))), "")


def digests(formatted: DataFrame) -> DataFrame:
    """What the output of :func:`format_conversations` gives when it is read back."""
    back = formatted.select("conv_id", "formatted", "attachment_tokens", read_back(F.col("formatted")).alias("turns"), masked_text(F.col("formatted"), F.col("mask")).alias("loss"))
    plain = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(plain, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "attachment_tokens",
    )
