"""Personal data: patterns propose spans, checksums confirm them, context words adjust a score.

Every kind is one pattern.  Matches are leftmost and do not overlap within a
kind; only account numbers are looked for at every start, as one that fails its
check may reach into the next.  ``regexp_extract_all`` gives the matches and ``split`` the gaps between
them, so start positions are prefix sums of lengths; they are summed in blocks,
so that a text with very many matches costs no quadratic copying.

The base kinds (email, ip, card, phone) stand once their checks hold, whatever
their context.  The added kinds (iban by mod-97, ssn) need a score of
``THRESHOLD``: a start value by kind, plus ``CONTEXT_BONUS`` when a word of the
kind's list stands within ``CONTEXT`` characters before the span.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barlake.llm.common import text_of

CONTEXT = 48
CONTEXT_BONUS = 0.4
THRESHOLD = 0.6
#: Matches summed at a time when positions are built.
SPAN_BLOCK = 256


@dataclass(frozen=True)
class Kind:
    """``must``: a pattern that any text with a match contains; it is cheap to look for."""

    name: str
    pattern: str
    must: str
    score: float
    words: str
    base: bool
    #: The pattern takes one character and looks ahead for the value, its first group.
    ahead: bool = False


# Possessive quantifiers and the look-behinds only forbid attempts that cannot
# change the matches; they keep the time linear and the regex stack flat.
_LOCAL = "[A-Za-z0-9._%+-]"
#: Length of an account number by country (ISO 13616 registry).
_IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
    29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}
_IBAN = "|".join(rf"(?:{c.replace(' ', '|')})[0-9]{{2}}(?:\x20?[A-Z0-9]){{{n - 4}}}" for n, c in _IBAN_LENGTHS.items())
# first the length of the country, then, as far as the text allows, any other
_IBAN = rf"(?<![A-Za-z0-9])(?=((?:{_IBAN}|[A-Z]{{2}}[0-9]{{2}}(?:\x20?[A-Z0-9]){{11,30}})(?![A-Za-z0-9])))[A-Z]"
KINDS = (
    Kind("email", rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@[A-Za-z0-9-]", 0.9, "mail|contact", True),
    Kind("ip", r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}", r"[0-9]\.[0-9]", 0.6, r"\bip\b|address|host|server", True),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", r"[0-9][\x20-]?[0-9]", 0.8, "card|visa|master|credit|karte|carte|tarjeta", True),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9]", 0.6, "phone|call|tel|mobil|fax", True),
    Kind("iban", _IBAN, "[A-Z]{2}[0-9]{2}", 0.7, "iban|account|konto|compte|cuenta", False, ahead=True),
    Kind("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", "[0-9]{3}-[0-9]", 0.3, "ssn|social security", False),
)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check; the last digit is not doubled."""
    n = F.length(digits)
    total = F.aggregate(
        F.sequence(F.lit(1), n),
        F.lit(0),
        lambda acc, i: acc
        + F.element_at(
            F.when((n - i) % 2 == 0, F.array(*map(F.lit, range(10)))).otherwise(
                F.array(*map(F.lit, (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)))
            ),
            F.substring(digits, i, F.lit(1)).cast("int") + 1,
        ),
    )
    return total % 10 == 0


def mod97(value: Column) -> Column:
    """Whether an account number, spaces removed, leaves 1 by ISO 7064 mod 97-10."""
    moved = F.concat(F.substring(value, F.lit(5), F.length(value)), F.substring(value, F.lit(1), F.lit(4)))
    codes = F.transform(F.split(moved, ""), lambda c: F.when(c.between("0", "9"), F.ascii(c) - 48).otherwise(F.ascii(c) - 55))
    return F.aggregate(codes, F.lit(0), lambda acc, v: (acc * F.when(v > 9, 100).otherwise(10) + v) % 97) == 1


def _valid(kind: str, m: Column) -> Column:
    d = _digits(m)
    if kind == "card":
        return F.when(F.length(d).between(14, 19), luhn(d)).otherwise(False)
    if kind == "phone":
        return F.length(d).between(10, 15)
    if kind == "ip":
        part = lambda x: F.regexp_replace(x, "^0+(?=[0-9])", "")
        return F.forall(F.split(m, r"\."), lambda x: (F.length(part(x)) <= 3) & (part(x).try_cast("int") <= 255))
    if kind == "iban":
        plain = F.replace(m, F.lit(" "), F.lit(""))
        return F.when(F.length(plain).between(15, 34), mod97(plain)).otherwise(False)
    if kind == "ssn":
        return ~m.rlike("^(?:000|666|9)|-00-|-0000$")
    return F.lit(True)


def _valid_for(kind: str, field: str | None = None) -> Callable[[Column], Column]:
    return lambda m: _valid(kind, m[field] if field else m)


def _scored(k: Kind, order: int) -> Callable[[Column], Column]:
    def span(s: Column) -> Column:
        before = F.substring(F.col("_text"), F.greatest(F.lit(1), s["start"] + 1 - CONTEXT), F.least(F.lit(CONTEXT), s["start"]))
        score = F.lit(k.score) + F.when(F.lower(before).rlike(k.words), CONTEXT_BONUS).otherwise(0.0)
        return F.struct(
            s["start"].alias("start"),
            F.lit(order).alias("rank"),
            F.lit(k.name).alias("kind"),
            (s["start"] + F.length(s["value"])).alias("end"),
            s["value"].alias("value"),
            F.least(F.lit(1.0), score).alias("score"),
            F.lit(k.base).alias("base"),
        )

    return span


def _positions(matches: Column, gaps: Column, ahead: bool) -> Column:
    """array<(start, value)>: prefix sums of gap and match lengths (one each if ``ahead``), in blocks of SPAN_BLOCK."""
    n = F.size(matches)
    longs = F.zip_with(F.slice(gaps, F.lit(1), n), matches, lambda g, m: F.struct(F.length(g).alias("g"), m.alias("m")))
    blocks = F.transform(
        F.sequence(F.lit(0), F.floor((n - 1) / SPAN_BLOCK).cast("int")),
        lambda b: F.slice(longs, b * SPAN_BLOCK + F.lit(1), F.lit(SPAN_BLOCK)),
    )

    def grow(acc: Column, x: Column) -> Column:
        start = acc["at"] + x["g"]
        item = F.struct(start.alias("start"), x["m"].alias("value"))
        return F.struct((start + (F.lit(1) if ahead else F.length(x["m"]))).alias("at"), F.concat(acc["out"], F.array(item)).alias("out"))

    none = F.array().cast("array<struct<start:int,value:string>>")

    def block(acc: Column, x: Column) -> Column:
        inner = F.aggregate(x, F.struct(acc["at"].alias("at"), none.alias("out")), grow)
        return F.struct(inner["at"].alias("at"), F.concat(acc["out"], F.array(inner["out"])).alias("out"))

    nested = F.array().cast("array<array<struct<start:int,value:string>>>")
    total = F.aggregate(blocks, F.struct(F.lit(0).alias("at"), nested.alias("out")), block)
    return F.when(n > 0, F.flatten(total["out"])).otherwise(none)


def find_pii(docs: DataFrame) -> DataFrame:
    """(doc_id, spans): spans are array<(start, rank, kind, end, value, score, base)> by start, then kind.

    Positions are code points, ends exclusive.  NULL texts count as empty, an
    empty text has no spans, repeated rows are judged alike, an empty table
    gives no rows; other columns are ignored.
    """
    return _found(docs.select("doc_id", text_of().alias("_text")), ["doc_id"])


def _found(rows: DataFrame, keep: list[str]) -> DataFrame:
    # most texts have neither a digit nor an @ and end here
    rows = rows.withColumn("_digit", F.col("_text").rlike("[0-9]"))
    for k in KINDS:
        gate = F.contains("_text", F.lit("@")) if k.name == "email" else F.col("_digit")
        may = gate & F.col("_text").rlike(k.must)
        rows = rows.withColumn(f"_m_{k.name}", F.when(may, F.regexp_extract_all("_text", F.lit(k.pattern), F.lit(int(k.ahead)))))
    for k in KINDS:
        some = F.size(f"_m_{k.name}") > 0
        if k.name not in ("email", "phone"):
            some = some & F.exists(f"_m_{k.name}", _valid_for(k.name))
        rows = rows.withColumn(
            f"_s_{k.name}", F.when(some, _positions(F.col(f"_m_{k.name}"), F.split("_text", k.pattern, -1), k.ahead))
        )
    found = []
    for order, k in enumerate(KINDS):

        valid = F.filter(F.col(f"_s_{k.name}"), _valid_for(k.name, "value"))
        spans = F.transform(valid, _scored(k, order))
        if not k.base:
            spans = F.filter(spans, lambda s: s["score"] >= THRESHOLD)
        found.append(F.coalesce(spans, F.array().cast("array<struct<start:int,rank:int,kind:string,end:int,value:string,score:double,base:boolean>>")))
    return rows.select(*keep, F.array_sort(F.concat(*found)).alias("spans"))


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets; of overlapping spans the first one stands."""
    rows = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("_row"), text_of().alias("_text"))
    text = F.col("_row.text")
    cut = F.aggregate(
        "spans",
        F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        lambda acc, s: F.when(
            s["start"] >= acc["at"],
            F.struct(
                s["end"].alias("at"),
                F.concat(acc["out"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.lit("["), s["kind"], F.lit("]")).alias("out"),
            ),
        ).otherwise(acc),
    )
    done = _found(rows, ["_row"]).withColumn("_cut", cut)
    clean = F.concat(F.col("_cut.out"), F.substring(text, F.col("_cut.at") + 1, F.length(text)))
    return done.select(
        *[(F.when(F.size("spans") > 0, clean).otherwise(text) if c == "text" else F.col(f"_row.`{c}`")).alias(c) for c in docs.columns]
    )


def digest(found: DataFrame) -> DataFrame:
    """Counts per base kind, digest of the base spans and the text form of all spans."""

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    def joined(spans: Column) -> Column:
        text = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
        return F.array_join(text, ",")

    return found.select(
        "doc_id",
        *[count(k.name) for k in KINDS],
        F.sha2(joined(F.filter("spans", lambda s: s["base"])).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )
