"""Column expressions: missing values, time units and repeatable random draws."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def finite(value: Column) -> Column:
    """NaN and both infinities become NULL; everything downstream then has a single kind of missing value."""
    bad = F.isnan(value) | (F.abs(value) == F.lit(float("inf")))
    return F.when(bad, F.lit(None).cast("double")).otherwise(value)


def epoch_ns(timestamp: Column) -> Column:
    """Microsecond timestamp to epoch nanoseconds (the session time zone must be UTC for zone-less columns)."""
    return F.unix_micros(timestamp.cast("timestamp")) * F.lit(1000)


def floor_div(a: Column, b: Column | int) -> Column:
    """Integer division that stays in BIGINT (operands must not be negative)."""
    b = b if isinstance(b, Column) else F.lit(b)
    return F.call_function("div", a, b)


def whole_floor_div(a: Column, b: int) -> Column:
    """Integer division rounding towards minus infinity, for times before 1970."""
    return F.call_function("div", a - F.pmod(a, F.lit(b)), F.lit(b))


def draw(*parts: Column, digits_from: int = 1) -> Column:
    """A number in [0, 1) read off eight hex digits of the MD5 of the parts: the same on any engine and any layout."""
    digest = F.md5(F.concat_ws("|", *[p.cast("string") for p in parts]))
    return F.conv(F.substring(digest, digits_from, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def gaussian(*parts: Column) -> Column:
    """Standard normal draw by the Box-Muller transform over two independent draws."""
    u1 = draw(*parts, digits_from=1) + F.lit(1.0 / 4294967296.0)
    u2 = draw(*parts, digits_from=9)
    return F.sqrt(F.lit(-2.0) * F.ln(u1)) * F.cos(F.lit(2.0) * F.pi() * u2)
