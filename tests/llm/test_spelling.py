"""Spelling variants against a comparison of all words."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from martflow.llm import spelling
from martflow.llm.queries import QUERIES

LOWER = str.maketrans(spelling.UPPER, spelling.UPPER.lower())


def is_near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain(counts, factor=10):
    by_shape = {}
    for w in counts:
        for i in range(len(w)):
            by_shape.setdefault(w[:i] + w[i + 1 :], set()).add(w)
        by_shape.setdefault(w, set()).add(w)
    near = {w: set() for w in counts}
    for group in by_shape.values():
        for a in group:
            near[a] |= {b for b in group if a != b and is_near(a, b)}
    form = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= factor * n else None
    out = []
    for w, n in counts.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), counts[form[w]] if form[w] else None))
    return sorted(out, key=str)


def grouped(spark, counts, **options):
    df = spark.createDataFrame([(n, w, "x") for w, n in counts.items()], "n int, word string, near string")
    return sorted(map(tuple, spelling.spelling_groups(df.repartition(3), **options).collect()), key=str)


def varied(seed, count, alphabet="abcé", least=6, most=16):
    """Words, and variants of them by up to three edits."""
    rng = random.Random(seed)
    words = set()
    while len(words) < count:
        w = "".join(rng.choice(alphabet) for _ in range(rng.randint(least, most)))
        words.add(w)
        for _ in range(rng.randrange(4)):
            i, c = rng.randrange(len(w) + 1), rng.choice(alphabet)
            w = rng.choice([w[:i] + w[i + 1 :], w[:i] + c + w[i + 1 :], w[:i] + c + w[i:]])
            if len(w) >= least:
                words.add(w)
    return {w: rng.choice([1, 2, 10, 20, 100, 1000]) for w in sorted(words)}


@pytest.mark.parametrize("options", [{}, {"least_list": 1}, {"hot_list": 5, "least_list": 1}, {"size": 20}])
def test_random_words(spark, options):
    for alphabet in ("ab", "abcé"):
        counts = varied(1, 500, alphabet)
        assert grouped(spark, counts, **options) == plain(counts)


def test_very_long_words_and_few_letters(spark):
    rng = random.Random(3)
    base = "".join(rng.choice("ab") for _ in range(3000))
    words = {base: 100, base[:70] + base[71:]: 10, base + "a": 1, "a" * 40: 50, "a" * 41: 5, "a" * 42: 5}
    words |= {"aaaaaaz": 3, "zaaaaaa": 30, "aaaaaa": 3, "aaaaaaa": 300}
    assert grouped(spark, words, least_list=1) == plain(words)
    assert grouped(spark, {}) == []
    assert grouped(spark, {"alonely": 4}) == [("alonely", None, "alonely", 4, 0, None)]


def test_an_edit_leaves_a_word_one_of_its_lists():
    """The bound itself: the lists of near words meet, whatever the dictionary."""
    rng = random.Random(5)
    counts = varied(7, 300, "abcd", 6, 14)
    words = list(counts)
    own = spelling.Words(pa.array(words))
    for share in (0.0, 0.3, 1.0):
        every = set()
        for kind, grams in enumerate(spelling.CLASSES):
            row, at = own.places(spelling._members(own, grams), grams)
            for length in range(grams.shortest, grams.longest + 1):
                fits = at + length <= own.end[row]
                every |= set(spelling._packed(own, at[fits], length, kind).tolist())
        held = np.array(sorted(g for g in every if rng.random() < share), np.int64)
        known = spelling.Dictionary(held, np.arange(1, len(held) + 1))
        lists = {w: set() for w in words}
        for kind, grams in enumerate(spelling.CLASSES):
            row, gram, _ = spelling.decomposed(own, spelling._members(own, grams), grams, kind, known)
            for r, g in zip(row, gram, strict=True):
                lists[words[r]].add(g)
        for i, a in enumerate(words):
            for b in words[:i]:
                if is_near(a, b):
                    assert lists[a] & lists[b]


def test_counts_of_grams(spark):
    words = {"abababab": 2, "bababab": 1, "abcdefghijkl": 1}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    total = sum(r["n"] for r in spelling.gram_counts(df).collect())
    expected = 0
    for w in words:
        for grams in spelling.CLASSES:
            if grams.least <= len(w) <= grams.most:
                expected += sum(len(w) + 2 - q for q in range(grams.shortest, grams.longest + 1))
    assert total == expected
    full = spelling.gram_dictionary(df, size=30, least_list=0)
    assert 0 < len(full.grams) <= 30


def test_words_of_texts(spark):
    df = spark.createDataFrame(
        [(1, "Écoutez ÉCOUTEZ écoutez abcdefg-ABCDEFG short", 3), (2, None, 4), (3, "", 5)],
        "doc_id long, text string, word int",
    )
    out = {r["word"]: r["n"] for r in spelling.spelling_variants(df, min_count=1).collect()}
    assert out == {"Écoutez": 2, "écoutez": 1, "abcdefg": 2}
    with pytest.raises(ValueError):
        spelling.spelling_variants(df, min_chars=4)


def test_digest(spark):
    folder = "/root/testdata/sf0.001"
    counts = Counter()
    for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect():
        for run in re.findall("[A-Za-zÀ-ÿ]+", r["text"] or ""):
            w = run.translate(LOWER)
            h = zlib.crc32(f"{r['doc_id']}:{w}".encode())
            if h % 31 == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            if len(w) >= 7:
                counts[w] += 1
    expected = plain({w: n for w, n in counts.items() if n >= 2})
    out = QUERIES["op13_spelling"](spark, folder)
    assert out.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert sorted(map(tuple, out.collect()), key=str) == expected
    assert any(r[1] for r in expected)
