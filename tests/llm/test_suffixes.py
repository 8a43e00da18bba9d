"""Suffix deduplication against a search through all strings."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from martflow.llm import passages, suffixes
from martflow.llm.queries import QUERIES

DATA = "/root/testdata/sf0.01"


def plain(texts, length):
    """Removed bytes, spans and digest of each text."""
    data = [(t or "").encode() for t in texts]
    count = Counter(t[i : i + length] for t in data for i in range(len(t) - length + 1))
    out = []
    for t in data:
        gone = bytearray(len(t))
        end = 0
        for i in range(len(t) - length + 1):
            if count[t[i : i + length]] > 1:
                for k in range(max(end, i), i + length):
                    gone[k] = 1
                end = i + length
        kept = bytes(c for c, g in zip(t, gone, strict=True) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def digests(spark, texts, **options):
    df = spark.createDataFrame(
        [(i, t, "x", 3) for i, t in enumerate(texts)],
        "doc_id long, text string, uid string, first int",
    ).repartition(3)
    rows = suffixes.remove_repeats(df, **options).orderBy("doc_id").collect()
    return [(r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in rows]


def shared_texts(seed, count):
    rng = random.Random(seed)
    draw = lambda n: "".join(rng.choice("abcé ") for _ in range(n))
    pool = [draw(rng.randint(30, 150)) for _ in range(8)] + ["ab" * 60, "a" * 90]
    return [
        "".join(rng.choice([draw(rng.randint(0, 60)), rng.choice(pool)]) for _ in range(5))
        for _ in range(count)
    ]


@pytest.mark.parametrize("options", [{}, {"hot_runs": 1}])
def test_random_texts(spark, options):
    for seed in range(2):
        texts = shared_texts(seed, 60)
        got = digests(spark, texts, length=40, gram=12, **options)
        assert got == plain(texts, 40)
        assert sum(x[1] for x in got) > 500


def test_cover_reaches_all_residues():
    assert suffixes.SHIFT.max() < suffixes.MODULUS
    for length in (32, 40, 57, 200, 333):
        words = np.zeros(1000, np.uint64)
        compared = suffixes.cover_ranks(words, length - suffixes.MODULUS + 1)[1]
        assert length - 16 <= compared <= length - suffixes.MODULUS + 1


@pytest.mark.parametrize("length", [32, 45, 200])
def test_block_sort(length):
    rng = np.random.default_rng(length)
    data = rng.integers(97, 99, 6000).astype(np.uint8)
    data[3000:3500] = data[1000:1500]
    data[4000:4400] = 97
    data[5000 : 5000 + length] = data[100 : 100 + length]
    starts = np.sort(rng.choice(len(data) - length, 4000, replace=False))
    whole = data.tobytes()
    count = Counter(whole[s : s + length] for s in starts)
    want = [count[whole[s : s + length]] > 1 for s in starts]
    assert suffixes.repeated_suffixes(data, starts, length).tolist() == want
    assert any(want)


def test_cases(spark):
    passage = "".join(chr(97 + i * i % 23) for i in range(230))
    texts = [
        None,
        "",
        "short",
        passage,
        "x" + passage + "y",
        passage[:199],
        "z" * 1000,
        "é" * 99 + passage[:2],
        "é" * 99 + passage[:2] + "!",
        "same text " * 30,
        "same text " * 30,
    ]
    assert digests(spark, texts) == plain(texts, 200)


def test_long_text_is_taken_in_chunks(spark, monkeypatch):
    sums, begin, _, _ = passages.unit_hashes(
        np.frombuffer(b"abcdefghij" * 500, np.uint8), np.array([0, 5000]), passages.Shape(50, 10)
    )
    whole = passages.anchored_runs(sums, begin, passages.Shape(50, 10))
    monkeypatch.setattr(passages, "CHUNK_UNITS", 700)
    parts = passages.anchored_runs(sums, begin, passages.Shape(50, 10))
    starts = lambda runs: np.concatenate([np.arange(a, b + 1) for a, b, _ in runs.T])
    assert starts(whole).tolist() == starts(parts).tolist() == list(range(4951))


def test_repeated_rows_nulls_and_empty_table(spark):
    text = "".join(chr(97 + i * 7 % 25) for i in range(300))
    df = spark.createDataFrame(
        [(1, text), (1, text), (None, "q" * 250), (None, None)], "doc_id long, text string"
    )
    rows = suffixes.remove_repeats(df, with_kept=True).collect()
    assert sorted((r["n_removed"], len(r["kept"])) for r in rows) == [
        (0, 0),
        (250, 0),
        (300, 0),
        (300, 0),
    ]
    assert suffixes.remove_repeats(df.limit(0)).count() == 0


def test_query(spark):
    rows = QUERIES["op1_suffixes"](spark, DATA).collect()
    docs = spark.read.parquet(f"{DATA}/documents.parquet").orderBy("doc_id").collect()
    want = plain([d["text"] for d in docs], 200)
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in rows}
    assert got == {d["doc_id"]: w for d, w in zip(docs, want, strict=True)}
