"""Randomness as a pure function of a seed, a purpose tag and the row key."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_TWO_32 = 4294967296.0


def hash_key(seed: int, tag: str, *keys: Column | str) -> Column:
    """32 hex digits; ordering by it is a reproducible shuffle of the rows."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), F.lit(tag), *keys))


def hash_word(seed: int, tag: str, *keys: Column | str) -> Column:
    """First 32 bits of :func:`hash_key` as a non-negative BIGINT."""
    return F.conv(F.substring(hash_key(seed, tag, *keys), 1, 8), 16, 10).cast("bigint")


def hash_uniform(seed: int, tag: str, *keys: Column | str) -> Column:
    """Uniform double in [0, 1)."""
    return hash_word(seed, tag, *keys) / F.lit(_TWO_32)


def hash_below(m: int | Column, seed: int, tag: str, *keys: Column | str) -> Column:
    """Integer in [0, m)."""
    bound = m if isinstance(m, Column) else F.lit(m)
    return F.pmod(hash_word(seed, tag, *keys), bound.cast("bigint")).cast("int")


def hash_normal(seed: int, tag: str, *keys: Column | str) -> Column:
    """Standard normal draw (Box-Muller on two hashed uniforms)."""
    u1 = (hash_word(seed, tag + "/r", *keys) + F.lit(1)) / F.lit(_TWO_32)
    u2 = hash_uniform(seed, tag + "/a", *keys)
    return F.sqrt(F.lit(-2.0) * F.log(u1)) * F.cos(F.lit(6.283185307179586) * u2)


def hash_poisson1(seed: int, tag: str, *keys: Column | str) -> Column:
    """Poisson(1) draw by inverting its distribution on a hashed uniform."""
    u = hash_uniform(seed, tag, *keys)
    steps, term, total = [], 0.36787944117144233, 0.0
    for k in range(12):
        total += term
        steps.append(total)
        term /= k + 1
    return sum((F.when(u >= F.lit(s), 1).otherwise(0) for s in steps), F.lit(0)).cast("double")
