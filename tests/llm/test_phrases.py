"""Phrase deduplication against a search through all windows."""

import hashlib
import random

import pytest

from martflow.llm import phrases
from martflow.llm.queries import QUERIES

DATA = "/root/testdata/sf0.01"


def plain(rows, length):
    first = {}
    split = [((t or "").encode().split(), d) for d, t in rows]
    for words, d in split:
        for i in range(len(words) - length + 1):
            if d is not None:
                w = tuple(words[i : i + length])
                first[w] = min(first.get(w, d), d)
    out = []
    for words, d in split:
        gone = [False] * len(words)
        for i in range(len(words) - length + 1):
            if d is not None and first[tuple(words[i : i + length])] < d:
                gone[i : i + length] = [True] * length
        kept = b" ".join(w for w, g in zip(words, gone, strict=True) if not g)
        out.append((d, len(words), sum(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def digests(spark, rows, **options):
    df = spark.createDataFrame(
        [(d, t, "x", 3) for d, t in rows], "doc_id long, text string, uid string, first int"
    ).repartition(3)
    out = phrases.remove_phrases(df, **options).collect()
    return sorted(
        ((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in out), key=str
    )


def shared_rows(seed, count):
    rng = random.Random(seed)
    draw = lambda n: [rng.choice("a bb ccc é".split()) for _ in range(n)]
    pool = [draw(rng.randint(8, 40)) for _ in range(8)] + [["a", "bb"] * 20, ["x"] * 30]
    rows = []
    for d in range(count):
        words = []
        for _ in range(5):
            words += rng.choice([draw(rng.randint(0, 15)), rng.choice(pool)])
        if rng.random() < 0.3:
            words = words + words
        rows.append((rng.randrange(count), rng.choice([" ", "\n", "\t "]).join(words)))
    return rows


@pytest.mark.parametrize("options", [{}, {"hot_runs": 1}])
def test_random_texts(spark, options):
    for seed in range(2):
        rows = shared_rows(seed, 60)
        got = digests(spark, rows, length=10, gram=3, **options)
        assert got == plain(rows, 10)
        assert sum(x[2] for x in got) > 300


def test_small_automata(spark, monkeypatch):
    monkeypatch.setattr(phrases, "SHARD_CHARACTERS", 30)
    rows = shared_rows(5, 40)
    table = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    out = phrases.remove_phrases(table, length=10, gram=3).collect()
    assert sum(r["n_removed"] for r in out) == sum(x[2] for x in plain(rows, 10))


def test_cases(spark):
    passage = " ".join(f"w{i}" for i in range(60))
    rows = [
        (1, None),
        (2, ""),
        (3, " \t\n"),
        (9, passage),
        (4, "start " + passage + " end"),
        (5, " ".join(f"w{i}" for i in range(49))),
        (6, passage),
        (6, passage),
        (None, passage),
        (7, "tick " * 200),
        (8, "tick " * 300),
        (10, passage + " " + passage),
    ]
    got = digests(spark, rows)
    assert got == plain(rows, 50)
    empty = spark.createDataFrame(rows, "doc_id long, text string").limit(0)
    assert phrases.remove_phrases(empty, with_kept=True).count() == 0


def test_query(spark):
    got = sorted(
        (r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"])
        for r in QUERIES["op8_phrases"](spark, DATA).collect()
    )
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()
    assert got == sorted(plain([tuple(d) for d in docs], 50))
