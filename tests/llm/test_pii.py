"""Personal data against a plain search with Python's regular expressions."""

import hashlib
import re

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st

from martflow.llm import pii

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def holds(kind, hit):
    digits = re.sub("[^0-9]", "", hit)
    if kind == "ip":
        return all(int(x) <= 255 for x in hit.split("."))
    if kind == "card":
        return 14 <= len(digits) <= 19 and luhn(digits)
    if kind == "phone":
        return 10 <= len(digits) <= 15
    return True


def plain(text):
    spans = [
        (m.start(), rank, kind, m.end())
        for rank, (kind, pattern) in enumerate(BASE.items())
        for m in re.finditer(pattern, text or "")
        if holds(kind, m.group(0))
    ]
    return [f"{kind}:{start}:{end}" for start, _, kind, end in sorted(spans)]


def digests(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = pii.find_pii(df, "text", "found")
    columns = pii.pii_digest(found["found"])
    rows = found.select("doc_id", *[c.alias(n) for n, c in columns.items()]).collect()
    return [r.asDict() for r in sorted(rows, key=lambda r: r["doc_id"])]


CASES = [
    None,
    "",
    "no data here",
    "a@b.com_x@y.z and a@b then c%d+e@f-g.h.i.",
    "a@b.com@c.de x@@y.z .@-.-",
    "1.2.3.4.5.6.7.8 256.1.1.1 001.002.003.0004 1.2.3",
    "0000000000000000255.0.0.1 99999999999999999999999.1.1.1",
    "4111 1111 1111 1111 and 4111-1111-1111-1111 and 4111111111111112",
    "4111  1111 1111 1111 \u0001 411111111111111 1",
    "+1 (017) 555-7713 or +49 30 1234567890 12 34 or +1)2 or +1 234 567 89(",
    "\U0001f600 café x@y.zz +1 (017) 555-7713 ٣٤",
    "7" * 50_000,
    "1 " * 20_000,
    "a" * 50_000,
    "x@y.zz " * 300,
]


def test_cases(spark):
    for text, row in zip(CASES, digests(spark, CASES), strict=True):
        want = plain(text)
        assert row["base_sha256"] == hashlib.sha256(",".join(want).encode()).hexdigest(), text
        for kind in BASE:
            assert row[f"n_{kind}"] == sum(x.startswith(kind + ":") for x in want)
        kept = [x for x in row["spans"].split(",") if x.split(":")[0] in BASE]
        assert kept == want


PIECES = st.lists(
    st.sampled_from(list("a1@.+- ()") + ["4111111111111111", "x@y.z", "1.2.3.4", "+1 555 "]),
    max_size=40,
).map("".join)


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(texts=st.lists(PIECES, min_size=60, max_size=60))
def test_random_texts(spark, texts):
    for text, row in zip(texts, digests(spark, texts), strict=True):
        joined = ",".join(plain(text))
        assert row["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest(), text


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("IBAN DE89 3704 0044 0532 0130 00.", "iban:5:32"),
        ("GB82WEST12345698765432", "iban:0:22"),
        ("GB82WEST12345698765433", ""),
        ("my ssn is 123-45-6789", "ssn:10:21"),
        ("part 123-45-6789", ""),
    ],
)
def test_checksums_and_context(spark, text, want):
    assert digests(spark, [text])[0]["spans"].split(",")[-1] == want


def test_mask_keeps_rows_and_extra_columns(spark):
    df = spark.createDataFrame(
        [(1, "x@y.zz at 1.2.3.4!", "en", 5), (1, "x@y.zz at 1.2.3.4!", "en", 5), (2, None, "e", 6)],
        "doc_id long, text string, kind string, start long",
    )
    rows = pii.mask_pii(df).orderBy("doc_id").collect()
    assert [r["text"] for r in rows] == ["[EMAIL] at [IP]!", "[EMAIL] at [IP]!", None]
    assert rows[0]["kind"] == "en" and rows[0]["start"] == 5
    assert pii.mask_pii(df.limit(0)).count() == 0
