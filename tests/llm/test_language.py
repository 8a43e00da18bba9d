"""Language identification: exact costs on a small case, accuracy on held-out rows."""

import math
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from martflow.llm import bytes as raw, language
from martflow.llm.queries import QUERIES

DATA = "/root/testdata/sf0.01"


def plain_bits(train, text):
    """Cost of a text, context by context, without tables."""
    low = lambda t: bytes(c + 32 if 65 <= c <= 90 else c for c in t)
    counts = defaultdict(Counter)
    for t in map(low, train):
        t = [-1] * 3 + list(t)
        for i in range(3, len(t)):
            for depth in range(4):
                counts[tuple(t[i - depth : i])][t[i]] += 1
    t, bits = [-1] * 3 + list(low(text)), 0.0
    for i in range(3, len(t)):
        for depth in range(3, -2, -1):
            if depth < 0:
                bits += 8
                break
            seen = counts.get(tuple(t[i - depth : i]))
            if not seen:
                continue
            total, kinds = sum(seen.values()), len(seen)
            if t[i] in seen:
                bits -= math.log2(seen[t[i]] / (total + kinds))
                break
            bits -= math.log2(kinds / (total + kinds))
    return bits


def test_costs_equal_a_plain_search():
    train = {
        "a": [b"abracadabra", b"banana band", b"a"],
        "b": ["señor el niño".encode(), b"la casa", b"zz"],
        "c": [b"q"],
    }
    trees = language.fit_trees(train)
    texts = [b"", b"abra", b"Banana casa", "niño 日本".encode(), b"xyzzy q", b"la band", b"\x00\x01"]
    data, offsets = raw.utf8(pa.array(texts, pa.binary()))
    got = trees.bits(data, offsets)
    want = [[plain_bits(train[k], t) for k in sorted(train)] for t in texts]
    np.testing.assert_allclose(got, want, rtol=1e-4, atol=1e-4)


def test_cases(spark):
    df = spark.createDataFrame(
        [(i, "the cat and the dog " * 3, "en", 1.5) for i in range(6)]
        + [(10 + i, "el gato y la casa " * 3, "es", 1.5) for i in range(6)]
        + [
            (20, None, "en", 0.0),
            (21, "", None, 0.0),
            (22, "12 - 34", "es", 0.0),
            (23, "the dog", None, 0.0),
            (23, "the dog", None, 0.0),
            (24, "la casa " * 200_000, None, 0.0),
        ],
        "doc_id long, text string, lang string, score double",
    )
    trees = language.learn_languages(df)
    out = language.predict_language(df, trees, keep=[df["doc_id"], df["score"].alias("own")])
    pred = {r["doc_id"]: r["lang_pred"] for r in out.collect()}
    assert out.count() == df.count()
    assert [pred[k] for k in (0, 10, 20, 21, 22, 23, 24)] == [
        "en", "es", "und", "und", "und", "en", "es",
    ]
    empty = df.limit(0)
    assert language.learn_languages(empty) is None
    assert language.predict_language(empty, None).count() == 0
    assert {r["lang_pred"] for r in language.predict_language(df, None, keep=[]).collect()} == {
        "und"
    }
    with pytest.raises(ValueError):
        language.learn_languages(df, max_languages=1)


def test_accuracy_on_held_out_rows(spark):
    out = QUERIES["op6_language"](spark, DATA)
    truth = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "lang")
    rows = out.where("held_out").join(truth.where("lang is not null"), "doc_id")
    right = rows.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right > 0.97
    scores = out.agg(F.min("score"), F.max("score")).first()
    assert 0 <= scores[0] and scores[1] <= 1
