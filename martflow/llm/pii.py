"""Personal data: patterns propose spans, checksums confirm them, context rescores.

Everything is built from column functions. Offsets are code points, the end is
exclusive. Null text counts as empty; a text without personal data has no spans.
Repeated rows are treated alike, since each row is judged on its own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

# Kinds in the order in which they are listed at one start.
KINDS = ("email", "ip", "card", "phone", "iban", "ssn")
BASE_KINDS = KINDS[:4]

# A run of name characters is tried from its start only, or from where the last
# match ended. Later starts in one run would meet the same "@", so the result is
# that of the plain pattern, without a quadratic search through long runs.
EMAIL = (
    r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@"
    r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]++)++"
)
IP = r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}"
OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
VALID_IP = rf"^{OCTET}(?:\.{OCTET}){{3}}$"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
IBAN = (
    r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?"
    r"(?![A-Za-z0-9])"
)
SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"

# Single separators between digits become this mark, so that a number of any
# length is one run of a character class and needs no recursion to match.
MARK = "\u0001"
NUMBER = rf"[0-9{MARK}]{{14,}}+"
MAYBE_NUMBER = r"[0-9](?:[\x20-]?[0-9]){13}"

# Score without context, and the words nearby that raise it by ``CONTEXT_GAIN``.
SCORES = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.9, "ssn": 0.3}
CONTEXT = {
    "email": r"\b(?:e-?mail|contact|write)",
    "ip": r"\b(?:ip|host|server|address)\b",
    "card": r"\b(?:card|visa|credit|payment)",
    "phone": r"\b(?:phone|call|tel|mobile|fax)",
    "iban": r"\b(?:iban|account|bank)",
    "ssn": r"\b(?:ssn|social security)",
}
CONTEXT_GAIN = 0.3
CONTEXT_CHARS = 40
MIN_SCORE = 0.5


def _located(text: Column, pattern: str) -> Column:
    """Start, end and text of each match, from the lengths of matches and gaps."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    pairs = F.filter(
        F.zip_with(gaps, found, lambda gap, hit: F.struct(gap.alias("gap"), hit.alias("hit"))),
        lambda pair: pair["hit"].isNotNull(),
    )
    empty = F.array().cast("array<struct<start:int,stop:int,hit:string>>")

    def add(done: Column, pair: Column) -> Column:
        start = done["at"] + F.length(pair["gap"])
        stop = start + F.length(pair["hit"])
        span = F.struct(start.alias("start"), stop.alias("stop"), pair["hit"].alias("hit"))
        return F.struct(stop.alias("at"), F.concat(done["spans"], F.array(span)).alias("spans"))

    first = F.struct(F.lit(0).alias("at"), empty.alias("spans"))
    return F.aggregate(pairs, first, add, lambda done: done["spans"])


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, r"[^0-9]", "")


def _mod97(hit: Column) -> Column:
    """Remainder of an account number, its letters read as 10 to 35."""
    plain = F.replace(hit, F.lit(" "), F.lit(""))
    turned = F.concat(F.substring(plain, 5, 64), F.substring(plain, 1, 4))

    def step(rest: Column, char: Column) -> Column:
        code = F.ascii(char)
        return F.when(code < 58, (rest * 10 + code - 48) % 97).otherwise(
            (rest * 100 + code - 55) % 97
        )

    return F.aggregate(F.filter(F.split(turned, ""), lambda c: c != ""), F.lit(0), step)


def _confirmed(kind: str, hit: Column) -> Column:
    """Whether the checksum or range of a proposed span holds."""
    if kind == "ip":
        return hit.rlike(VALID_IP)
    if kind == "card":
        digits = _digits(hit)
        right_length = F.length(digits).between(14, 19)
        return right_length & F.call_function("luhn_check", digits)
    if kind == "phone":
        return F.length(_digits(hit)).between(10, 15)
    if kind == "iban":
        return _mod97(hit) == 1
    return F.lit(True)


def _kind_spans(text: Column, kind: str) -> Column:
    """Confirmed and scored spans of one kind."""
    searched = text
    if kind == "email":
        pattern, maybe = EMAIL, F.contains(text, F.lit("@"))
    elif kind == "ip":
        pattern, maybe = IP, text.rlike(r"[0-9]\.[0-9]")
    elif kind == "card":
        pattern, maybe = NUMBER, text.rlike(MAYBE_NUMBER)
        searched = F.regexp_replace(
            F.translate(text, MARK, "x"), r"(?<=[0-9])[\x20-](?=[0-9])", MARK
        )
    elif kind == "phone":
        pattern, maybe = PHONE, text.rlike(r"\+[0-9]")
    elif kind == "iban":
        pattern, maybe = IBAN, text.rlike(r"[A-Z]{2}[0-9]{2}")
    else:
        pattern, maybe = SSN, text.rlike(r"[0-9]-[0-9]{2}-[0-9]")

    def scored(span: Column) -> Column:
        first = F.greatest(span["start"] - CONTEXT_CHARS, F.lit(0))
        nearby = F.lower(
            F.substring(text, first + 1, span["stop"] - first + CONTEXT_CHARS)
        )
        gain = F.when(nearby.rlike(CONTEXT[kind]), CONTEXT_GAIN).otherwise(0.0)
        return F.struct(
            span["start"].alias("start"),
            F.lit(KINDS.index(kind)).alias("rank"),
            span["stop"].alias("stop"),
            F.lit(kind).alias("kind"),
            F.least(F.lit(SCORES[kind]) + gain, F.lit(1.0)).alias("score"),
        )

    spans = F.transform(
        F.filter(_located(searched, pattern), lambda span: _confirmed(kind, span["hit"])),
        scored,
    )
    spans = F.filter(spans, lambda span: span["score"] >= MIN_SCORE)
    return F.when(maybe, spans).otherwise(
        F.array().cast(
            "array<struct<start:int,rank:int,stop:int,kind:string,score:double>>"
        )
    )


def pii_spans(text: Column, kinds: Sequence[str] = KINDS) -> Column:
    """All spans of a text, ordered by start, then by kind as listed."""
    whole = F.coalesce(text, F.lit(""))
    return F.array_sort(F.concat(*[_kind_spans(whole, kind) for kind in kinds]))


def masked(text: Column, spans: Column) -> Column:
    """The text with each span replaced by its kind in brackets.

    Where spans overlap, the earlier one names the replacement, which then
    covers both. Null text stays null.
    """

    def add(done: Column, span: Column) -> Column:
        ahead = span["start"] >= done["at"]
        gap = F.substring(text, done["at"] + 1, span["start"] - done["at"])
        piece = F.concat(gap, F.lit("["), F.upper(span["kind"]), F.lit("]"))
        return F.struct(
            F.greatest(done["at"], span["stop"]).alias("at"),
            F.when(ahead, F.concat(done["parts"], F.array(piece)))
            .otherwise(done["parts"])
            .alias("parts"),
        )

    def close(done: Column) -> Column:
        rest = F.substring(text, done["at"] + 1, F.length(text))
        return F.concat(F.array_join(done["parts"], ""), rest)

    first = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))
    return F.when(F.size(spans) == 0, text).otherwise(F.aggregate(spans, first, add, close))


def find_pii(
    df: DataFrame, text: str = "text", out: str = "pii", kinds: Sequence[str] = KINDS
) -> DataFrame:
    """Add the spans of ``text`` as an array column named ``out``."""
    return df.withColumn(out, pii_spans(df[text], kinds))


def mask_pii(df: DataFrame, text: str = "text", kinds: Sequence[str] = KINDS) -> DataFrame:
    """Replace the spans of ``text``; other columns and rows stay."""
    return df.withColumn(text, masked(df[text], pii_spans(df[text], kinds)))


def pii_digest(spans: Column) -> dict[str, Column]:
    """Counts of the base kinds, their hash, and all spans as text."""

    def joined(items: Column) -> Column:
        return F.array_join(
            F.transform(
                items,
                lambda s: F.concat_ws(
                    ":", s["kind"], s["start"].cast("string"), s["stop"].cast("string")
                ),
            ),
            ",",
        )

    def count(kind: str) -> Column:
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")

    counts = {f"n_{kind}": count(kind) for kind in BASE_KINDS}
    base = F.filter(spans, lambda s: s["rank"] < len(BASE_KINDS))
    return {**counts, "base_sha256": F.sha2(joined(base), 256), "spans": joined(spans)}
