"""Probability and indicator arrays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def argmax(probs: Column | str) -> Column:
    """0-based position of the first largest entry."""
    p = F.col(probs) if isinstance(probs, str) else probs
    return (F.array_position(p, F.array_max(p)) - 1).cast("int")


def prob_at(probs: Column | str, code: Column | str) -> Column:
    """Entry of ``probs`` at a 0-based class code."""
    p = F.col(probs) if isinstance(probs, str) else probs
    c = F.col(code) if isinstance(code, str) else code
    return F.element_at(p, c.cast("int") + 1)


def multi_hot(*flags: Column) -> Column:
    """Boolean columns, or text 'TRUE' in any case, as an ARRAY<INT> of 0/1."""
    return F.array(
        *[F.coalesce((F.upper(f.cast("string")) == "TRUE").cast("int"), F.lit(0)) for f in flags]
    )


def active_codes(bits: Column | str) -> Column:
    """Positions of the ones in a 0/1 array."""
    b = F.col(bits) if isinstance(bits, str) else bits
    return F.filter(
        F.transform(b, lambda v, i: F.when(v == 1, i).otherwise(F.lit(-1))), lambda x: x >= 0
    )


def spread_probs(probs: Column, present: list[int], n_classes: int) -> Column:
    """Probabilities of the ``present`` classes laid out over all classes, zero elsewhere."""
    at = {c: i + 1 for i, c in enumerate(present)}
    return F.array(
        *[F.element_at(probs, at[c]) if c in at else F.lit(0.0) for c in range(n_classes)]
    )


def safe_divide(num: Column, den: Column, default: float = 0.0) -> Column:
    """num / den, or ``default`` when the denominator is not positive."""
    return F.when(den > 0, num / den).otherwise(F.lit(default))
