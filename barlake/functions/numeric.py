"""Null, rounding and coercion rules shared by all operators.

Every value that may be missing is turned into SQL NULL once, at ingest.  NaN
and infinities never reach an operator: Spark orders NaN above every number, so
a leftover NaN would pass a ``>`` filter.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spellings that count as "no value".
MISSING_WORDS = ("", "nan", "none", "null")
MISSING_LABELS = ("", "nan", "nat", "none", "null", "<na>")


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def num(c: Column | str) -> Column:
    """Text or number to DOUBLE; anything unusable becomes NULL."""
    return finite(col(c).try_cast("double"))


def finite(c: Column | str) -> Column:
    """NaN and +-Infinity to NULL."""
    x = col(c).cast("double")
    return F.when(F.isnan(x) | (F.abs(x) == F.lit(float("inf"))), F.lit(None)).otherwise(x)


def null0(c: Column | str) -> Column:
    x = col(c)
    return F.when(x != 0, x)


def safe_div(a: Column | str, b: Column | str) -> Column:
    return col(a) / null0(b)


def dec(c: Column | str, precision: int = 18, scale: int = 4) -> Column:
    return col(c).cast(f"decimal({precision},{scale})")


def dbl(c: Column | str) -> Column:
    return col(c).cast("double")


def round_dec(c: Column | str, digits: int) -> Column:
    """Half-up rounding through DECIMAL.

    Rounding a binary double directly differs between engines on values such as
    1.005; the decimal detour gives one answer everywhere.
    """
    return col(c).cast("decimal(28,10)").cast(f"decimal(28,{digits})").cast("double")


def tick_floor(c: Column | str, tick: float = 0.01) -> Column:
    """Largest multiple of ``tick`` not above the value, in decimal arithmetic."""
    units = F.floor(col(c).cast("decimal(28,10)") / F.lit(str(tick)).cast("decimal(10,6)"))
    return (units.cast("decimal(20,0)") * F.lit(str(tick)).cast("decimal(10,6)")).cast("double")


def tick_ceil(c: Column | str, tick: float = 0.01) -> Column:
    units = F.ceil(col(c).cast("decimal(28,10)") / F.lit(str(tick)).cast("decimal(10,6)"))
    return (units.cast("decimal(20,0)") * F.lit(str(tick)).cast("decimal(10,6)")).cast("double")


def present(c: Column | str) -> Column:
    """True when a value is neither NULL nor a spelled-out missing marker."""
    text = F.lower(F.trim(col(c).cast("string")))
    return F.coalesce(~text.isin(*MISSING_WORDS), F.lit(False))


def blank_to_null(c: Column | str) -> Column:
    """Trimmed text, with every missing spelling turned into NULL."""
    text = F.trim(col(c).cast("string"))
    return F.when(~F.lower(text).isin(*MISSING_LABELS), text)


def count_if(c: Column) -> Column:
    return F.count(F.when(c, F.lit(1)))


def flag_list(*pairs: tuple[Column, Column | str]) -> Column:
    """Array of the names whose condition is true, in the given order."""
    items = [F.when(cond, F.lit(name) if isinstance(name, str) else name) for cond, name in pairs]
    return F.array_compact(F.array(*[i.cast("string") for i in items]))


def points(*pairs: tuple[Column, int]) -> Column:
    """Sum of the points whose condition is true (NULL counts as false)."""
    return reduce(
        lambda a, b: a + b,
        [F.when(cond, F.lit(n)).otherwise(F.lit(0)) for cond, n in pairs],
    )
