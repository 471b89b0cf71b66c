"""Exact ratios and a portable hash, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def int_div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def round_ratio(numerator: Column, denominator: Column, digits: int) -> Column:
    """``numerator / denominator`` rounded half away from zero, once, as a double.

    Both are whole numbers and the denominator is not negative; a zero
    denominator gives null.  Working on integers avoids the second rounding of
    a decimal average (0.6 / 11 to four digits is 0.0545, not 0.0546).
    """
    scale = 10**digits
    n = numerator.cast("bigint")
    d = F.nullif(denominator.cast("bigint"), F.lit(0).cast("bigint"))
    size = int_div(F.abs(n) * (2 * scale) + d, d * 2)
    return F.when(n < 0, -size).otherwise(size) / F.lit(float(scale))


def percent_of(part: Column, whole: Column) -> Column:
    """Share in percent with two digits."""
    return round_ratio(part.cast("bigint") * 100, whole, 2)


def bucket_1000(key: Column, seed: int) -> Column:
    """A bucket 0..999 for a whole-number key: two rounds of a linear
    congruential step in 64-bit arithmetic, the same in any SQL engine."""
    # Multiplier, increment and modulus of the step.
    multiplier, increment, modulus = 1103515245, 12345, 2147483648
    state = F.pmod(key.cast("bigint"), F.lit(modulus)) * multiplier + increment
    state = ((state % modulus) + seed) % modulus * multiplier + increment
    return (int_div(state % modulus, F.lit(65536)) % 1000).cast("int")


def portable_hash(seed: int, *keys: Column | str) -> Column:
    """A number below 2**60 from the text of the keys, the same in any SQL engine
    with md5.  A null key counts as an empty text."""
    text = F.concat_ws(":", F.lit(str(seed)), *[F.coalesce((F.col(k) if isinstance(k, str) else k).cast("string"), F.lit("")) for k in keys])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")
