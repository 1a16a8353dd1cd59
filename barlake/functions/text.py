"""Security codes, markets, boards, labels and neutral wording."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barlake.functions.numeric import MISSING_LABELS, blank_to_null, col

# Label separators, market order, code patterns, board names.
LABEL_SEPARATORS = r"\s*[,，、;；|]\s*"
CODE_PATTERN = r"^[0-9]{6}$"
SECOND_MARKET_PATTERN = r"^(4|8|9)[0-9]{5}$"
MARKETS = ("sh", "sz", "bj")
BOARD_BSE, BOARD_STAR, BOARD_CHINEXT, BOARD_SME, BOARD_MAIN = "北交所", "科创板", "创业板", "中小板", "主板"

# Characters removed at both ends of a message.
WHITESPACE = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u2028\u2029\u3000"

# Wording that must not appear in neutral messages.
FORBIDDEN_TERMS = (
    "candidate|recommend|buy|sell|signal|score|rank|probability|"
    "候选|推荐|买入|卖出|信号|评分|排名|概率"
)


def pad_code(c: Column | str) -> Column:
    """Short all-digit text is zero-padded to six places; other text is kept."""
    text = F.trim(col(c).cast("string"))
    return F.when(text.rlike("^[0-9]{1,6}$"), F.lpad(text, 6, "0")).otherwise(text)


def normalize_code(c: Column | str) -> Column:
    """Strip, drop a trailing ``.0``, keep digits only, pad to six, keep last six."""
    text = F.trim(F.coalesce(col(c).cast("string"), F.lit("")))
    text = F.when(F.lower(text).isin(*MISSING_LABELS), F.lit("")).otherwise(text)
    text = F.regexp_replace(text, r"^([0-9]+)\.0$", "$1")
    digits = F.regexp_replace(text, "[^0-9]", "")
    padded = F.when(F.length(digits) >= 6, F.right(digits, F.lit(6))).otherwise(F.lpad(digits, 6, "0"))
    return F.when(F.length(digits) > 0, padded).otherwise(text)


def normalize_live_code(c: Column | str) -> Column:
    """As :func:`normalize_code`, but text that is not all digits is left alone."""
    text = F.regexp_replace(F.trim(F.coalesce(col(c).cast("string"), F.lit(""))), r"\.0$", "")
    padded = F.when(F.length(text) >= 6, F.right(text, F.lit(6))).otherwise(F.lpad(text, 6, "0"))
    return F.when(text.rlike("^[0-9]+$"), padded).otherwise(text)


def starts_with_any(c: Column | str, *prefixes: str) -> Column:
    cond = F.lit(False)
    for p in prefixes:
        cond = cond | col(c).startswith(p)
    return cond


def market_of(c: Column | str) -> Column:
    """sh / sz / bj by leading digit, NULL when the code is not mapped."""
    return (
        F.when(starts_with_any(c, "6"), "sh")
        .when(starts_with_any(c, "0", "3"), "sz")
        .when(starts_with_any(c, "4", "8", "9"), "bj")
    )


def market_symbol(c: Column | str) -> Column:
    padded = pad_code(c)
    return F.concat(F.coalesce(market_of(padded), F.lit("")), padded)


def vendor_symbol(c: Column | str, style: str) -> Column:
    """Code in a vendor notation: ``suffix`` 600000.SH, ``dot`` sh.600000, ``prefix`` sh600000.

    Codes starting with 9 belong to the first market here unless they start
    with 920.  ``dot`` has no second market and yields NULL for it.
    """
    padded = pad_code(c)
    second = starts_with_any(padded, "4", "8", "920")
    first = starts_with_any(padded, "6", "9", "5")
    if style == "suffix":
        tail = F.when(second, ".BJ").when(first, ".SH").otherwise(".SZ")
        return F.concat(padded, tail)
    if style == "dot":
        return F.when(~second, F.concat(F.when(first, "sh.").otherwise("sz."), padded))
    if style == "prefix":
        return F.concat(F.when(second, "bj").when(first, "sh").otherwise("sz"), padded)
    raise ValueError(f"unknown symbol style {style!r}")


def index_symbol(c: Column | str) -> Column:
    padded = pad_code(c)
    return F.concat(F.when(padded.startswith("399"), "sz").otherwise("sh"), padded)


def board_of(c: Column | str) -> Column:
    padded = pad_code(c)
    return (
        F.when(starts_with_any(padded, "4", "8", "9"), BOARD_BSE)
        .when(padded.startswith("688"), BOARD_STAR)
        .when(starts_with_any(padded, "300", "301"), BOARD_CHINEXT)
        .when(padded.startswith("002"), BOARD_SME)
        .otherwise(BOARD_MAIN)
    )


def market_order(c: Column | str) -> Column:
    return F.when(col(c) == "sh", 0).when(col(c) == "sz", 1).when(col(c) == "bj", 2).otherwise(3)


def label_text(c: Column | str) -> Column:
    """Labels joined by a plain comma; missing spellings become empty text."""
    text = F.coalesce(blank_to_null(c), F.lit(""))
    return F.regexp_replace(text, LABEL_SEPARATORS, ",")


def list_text(c: Column | str) -> Column:
    """An array of labels as one ``", "`` separated text, blanks dropped."""
    cleaned = F.filter(F.transform(col(c), lambda x: F.trim(x)), lambda x: x.isNotNull() & (x != ""))
    return F.array_join(cleaned, ", ")


def plain_text(c: Column | str) -> Column:
    return F.coalesce(blank_to_null(c), F.lit(""))


def neutral_text(c: Column | str, replacement: str = "data") -> Column:
    """Trimmed text with every advice-like term replaced, ignoring case."""
    text = F.btrim(col(c), F.lit(WHITESPACE))
    return F.regexp_replace(text, "(?iu)" + FORBIDDEN_TERMS, replacement)


def neutral_columns(df: DataFrame, replacement: str = "data") -> DataFrame:
    """Rename columns to neutral words (clashes get ``_2``, ``_3``…) and clean text columns."""
    import re

    pattern = re.compile(FORBIDDEN_TERMS, re.IGNORECASE)
    taken: set[str] = set()
    out = []
    for field in df.schema.fields:
        base = pattern.sub(replacement, field.name.strip())
        name, n = base, 2
        while name in taken:
            name, n = f"{base}_{n}", n + 1
        taken.add(name)
        value = F.col(f"`{field.name}`")
        if field.dataType.simpleString() == "string":
            value = neutral_text(value, replacement)
        out.append(value.alias(name))
    return df.select(*out)
