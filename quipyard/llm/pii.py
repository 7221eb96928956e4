"""Personal data in texts: expressions propose, checksums confirm, words nearby adjust the score.

Everything is Spark SQL. Each kind has a pattern that proposes leftmost spans, a check that drops
false ones, and a score: a plain value, raised by a context word of the kind in the CONTEXT code
points before the span. Email, ip, card and phone are always kept once their check holds (`base`),
and their context ends at the span of the same kind before them; the further kinds need a score of
THRESHOLD or more.

| kind | check | score, with a context word |
| --- | --- | --- |
| email | labels | 0.9, 1 |
| ip | parts at most 255 | 0.6, 0.95 |
| card | 14 to 19 digits and Luhn | 0.8, 1 |
| phone | 10 to 15 digits | 0.7, 0.95 |
| iban | 15 to 34 characters and mod-97, not inside a base span | 0.8, 1 |
| local_phone | 7 to 15 digits in groups, not inside a base span | 0.3, 0.8 |
| id_number | 3-2-4 digits, first group not 000, 666 or 9xx, not inside a base span | 0.4, 0.9 |

A null text counts as empty and has no spans. Positions are code points, the end is exclusive. Rows are
judged alone, so repeated ones have equal spans and an empty table gives an empty result; spans that
start together stand in the order of the table above.
Long runs without a match cost one pass: the patterns cannot start again inside a run that they have
given up, and repeat without backtracking.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quipyard.llm.rows import wrapped

CONTEXT = 40
THRESHOLD = 0.5
BASE_KINDS = ("email", "ip", "card", "phone")
MORE_KINDS = ("iban", "local_phone", "id_number")

# A match starts at the head of a run of its characters, or right after the last match.
_LOCAL = "A-Za-z0-9._%+-"
PATTERNS = {
    "email": rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "local_phone": r"(?<![+A-Za-z0-9.@/(-])(?:\([0-9]{2,5}\)\x20?|[0-9]{2,5}[\x20./-])[0-9]{2,5}(?:[\x20./-][0-9]{2,5}){0,3}(?![A-Za-z0-9@-])",
    "id_number": r"(?<![A-Za-z0-9.-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![A-Za-z0-9-])",
}
_PHONE_WORDS = r"(?i)\b(?:phone|telephone|tel|call|mobile|fax|telefon|teléfono|téléphone|whatsapp)\b"
#: Cheap conditions without which a pattern cannot match.
HINTS = {
    "email": lambda t: F.contains(t, F.lit("@")),
    "ip": lambda t: t.rlike(r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]"),
    "card": lambda t: t.rlike(r"[0-9](?:[\x20-]?[0-9]){13}"),
    "phone": lambda t: F.contains(t, F.lit("+")),
    "iban": lambda t: t.rlike(r"[A-Z]{2}[0-9]{2}\x20?[A-Z0-9]{4}"),
    "local_phone": lambda t: t.rlike(_PHONE_WORDS),
    "id_number": lambda t: t.rlike(r"[0-9]{3}-[0-9]{2}-[0-9]{4}"),
}
#: Without and with a context word.
SCORES = {
    "email": (0.9, 1.0),
    "ip": (0.6, 0.95),
    "card": (0.8, 1.0),
    "phone": (0.7, 0.95),
    "iban": (0.8, 1.0),
    "local_phone": (0.3, 0.8),
    "id_number": (0.4, 0.9),
}
#: Words that speak for a kind when they stand before a span.
CONTEXT_WORDS = {
    "email": r"(?i)\b(?:e-?mail|mail|mailto|contact|write|address|correo)\b",
    "ip": r"(?i)\b(?:ip|ipv4|address|server|host|login|visitor)\b",
    "card": r"(?i)\b(?:card|credit|debit|visa|mastercard|amex|payment|karte|tarjeta|carte)\b",
    "phone": _PHONE_WORDS,
    "local_phone": _PHONE_WORDS,
    "id_number": r"(?i)\b(?:ssn|social security|tax|passport|id|identity)\b",
    "iban": r"(?i)\b(?:iban|account|konto|cuenta|compte)\b",
}


_FOUND = "array<struct<start:int,value:string,before:string>>"
#: Matches whose places are summed up at once: an array that grows by one is copied each time.
_BLOCK = 64


def _proposed(text: Column, kind: str) -> Column:
    """Array of (start, value, before) of the leftmost non-overlapping matches.

    `before` is the end of the text between a match and the one before it.
    """
    values = F.regexp_extract_all(text, F.lit(PATTERNS[kind]), F.lit(0))
    # the last gap has no match behind it
    pairs = F.arrays_zip(F.split(text, PATTERNS[kind], -1).alias("gap"), values.alias("value"))
    return F.transform(F.array(pairs), _placed)[0]  # so that the pairs are found once


def _placed(pairs: Column) -> Column:
    """Starts of the values among (gap, value) pairs."""
    width = lambda p: F.length(p["gap"]) + F.coalesce(F.length(p["value"]), F.lit(0))
    empty = F.array().cast(_FOUND)

    def found(at: Column, p: Column) -> Column:
        before = F.substring(p["gap"], -CONTEXT, CONTEXT)
        return F.struct((at + F.length(p["gap"])).alias("start"), p["value"].alias("value"), before.alias("before"))

    def block(at: Column, some: Column) -> Column:
        return F.aggregate(
            some,
            F.struct(at.alias("at"), empty.alias("spans")),
            lambda s, p: F.struct(
                (s["at"] + width(p)).alias("at"),
                F.concat(s["spans"], F.array(found(s["at"], p))).alias("spans"),
            ),
        )["spans"]

    def one_more(s: Column, i: Column) -> Column:
        some = F.slice(pairs, i * _BLOCK + 1, _BLOCK)
        return F.struct(
            F.aggregate(some, s["at"], lambda at, p: at + width(p)).alias("at"),
            F.concat(s["blocks"], F.array(block(s["at"], some))).alias("blocks"),
        )

    blocks = F.aggregate(
        F.sequence(F.lit(0), F.floor((F.size(pairs) - 1) / _BLOCK).cast("int")),
        F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{_FOUND}>").alias("blocks")),
        one_more,
    )["blocks"]
    return F.filter(F.flatten(blocks), lambda p: p["value"].isNotNull())


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a text of digits has a valid check digit."""
    backwards = F.split(F.reverse(digits), "")
    total = F.aggregate(
        F.transform(
            backwards,
            lambda d, i: F.when(i % 2 == 0, d.cast("int"))
            .when(d.cast("int") > 4, d.cast("int") * 2 - 9)
            .otherwise(d.cast("int") * 2),
        ),
        F.lit(0),
        lambda total, d: total + d,
    )
    return total % 10 == 0


def mod97(iban: Column) -> Column:
    """Whether an account number without blanks has valid check digits."""
    turned = F.concat(F.substring(iban, 5, 64), F.substring(iban, 1, 4))
    value = F.aggregate(
        F.split(turned, ""),
        F.lit(0),
        lambda rest, c: F.when(c.rlike("[0-9]"), (rest * 10 + c.cast("int")) % 97).otherwise(
            (rest * 100 + F.ascii(c) - 55) % 97
        ),
    )
    return value == 1


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        small = lambda part: F.length(F.ltrim(part, F.lit("0"))) <= 3
        return F.forall(F.split(value, r"\."), lambda p: F.when(small(p), p.cast("decimal(38,0)") <= 255).otherwise(False))
    if kind == "card":
        count = F.length(_digits(value))
        return F.when(count.between(14, 19), luhn(_digits(value))).otherwise(False)
    if kind == "phone":
        return F.length(_digits(value)).between(10, 15)
    if kind == "iban":
        packed = F.replace(value, F.lit(" "), F.lit(""))
        return F.when(F.length(packed).between(15, 34), mod97(packed)).otherwise(False)
    if kind == "local_phone":
        return F.length(_digits(value)).between(7, 15)
    if kind == "id_number":
        return ~value.rlike("^(?:000|666|9)")
    return F.lit(True)


_SPAN = "array<struct<start:int,end:int,kind:string,score:double,place:int>>"


def _spans(text: Column, kind: str) -> Column:
    """Confirmed spans of one kind."""
    place = (BASE_KINDS + MORE_KINDS).index(kind)
    plain, near = SCORES[kind]

    def span(p: Column) -> Column:
        before = p["before"]  # base spans can be very many, and a substring of the text is counted from its start
        if kind in MORE_KINDS:
            before = F.substring(text, F.greatest(p["start"] - CONTEXT, F.lit(0)) + 1, F.least(p["start"], F.lit(CONTEXT)))
        score = F.when(before.rlike(CONTEXT_WORDS[kind]), near).otherwise(plain)
        return F.struct(
            p["start"].alias("start"),
            (p["start"] + F.length(p["value"])).alias("end"),
            F.lit(kind).alias("kind"),
            score.alias("score"),
            F.lit(place).alias("place"),
        )

    found = F.transform(F.filter(_proposed(text, kind), lambda p: _valid(kind, p["value"])), span)
    return F.when(HINTS[kind](text), found.cast(_SPAN)).otherwise(F.array().cast(_SPAN))


def find_personal_data(docs: DataFrame, text: str = "text") -> DataFrame:
    """`docs` with `base_spans` and `all_spans`, arrays of (start, end, kind, score) in order.

    Columns of these names are replaced.
    """
    added = ["base_spans", "all_spans"]
    rows = wrapped(docs.drop(*added), text=F.coalesce(F.col(text), F.lit("")))
    kinds = BASE_KINDS + MORE_KINDS
    rows = rows.select("row", *[_spans(F.col("text"), kind).alias(kind) for kind in kinds])
    rows = rows.withColumn("base", F.concat(*BASE_KINDS))
    more = F.filter(
        F.concat(*MORE_KINDS),
        lambda s: (s["score"] >= THRESHOLD)
        & ~F.exists("base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])),
    )
    spans = [_ordered(F.col("base")), _ordered(F.concat("base", more))]
    return rows.select("row.*", *[c.alias(n) for c, n in zip(spans, added)])


def _ordered(spans: Column) -> Column:
    keyed = F.transform(spans, lambda s: F.struct(s["start"], s["place"], s["end"], s["kind"], s["score"]))
    return F.transform(
        F.array_sort(keyed), lambda s: F.struct(s["start"], s["end"], s["kind"], s["score"])
    )


def spans_text(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def count_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def scores_text(spans: Column) -> Column:
    """Score of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: s["score"].cast("string")), ",")
