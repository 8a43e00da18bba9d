"""Packing: ids as the tokenizer gives them, every id in one place, little padding."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from martflow.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [
    None,
    "",
    " \n\t ",
    "Hello, World! it's don't 'sab x'save ''s 12.5% a1b2",
    "İstanbul ﬁn é. é a̸< ≮  x y \x1c z​w ΑΣ Σ",
    "a<|endoftext|>b <|startoftext|> <|ENDOFTEXT|> <|",
    "ciónñgaco, ñll. \U0001f600\U0001f600 日本語テキスト。 …'s 'LL we'Re",
    "word " * 9000,
    "x" * 30000,
    "tail.\r\nline\x0bvt\x0cff",
] + [f"copy {'lorem ipsum ' * (i % 97)}" for i in range(300)]


def check(rows, texts, capacity=4096):
    tokenizer = Tokenizer.from_file(PATH)
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    assert set(by_doc) == set(range(len(texts)))
    for i, text in enumerate(texts):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        pieces = sorted(by_doc[i], key=lambda r: r["start"])
        assert sum(p["length"] for p in pieces) == len(ids), (i, text)
        at = 0
        for p in pieces:
            assert p["start"] == at and p["doc_tokens"] == len(ids)
            own = np.array(ids[at : at + p["length"]], "<u4").tobytes()
            assert p["ids_crc32"] == zlib.crc32(own), (i, text)
            at += p["length"]
    for pieces in by_sequence.values():
        at = 0
        for p in sorted(pieces, key=lambda r: r["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= capacity
    return sum(r["length"] for r in rows), len(by_sequence)


def test_every_id_in_one_place(spark):
    df = spark.createDataFrame(
        [(i, t, 7) for i, t in enumerate(TEXTS)], "doc_id long, text string, start int"
    ).repartition(3)
    check(packing.pack_documents(df, PATH).collect(), TEXTS)


def test_little_padding(spark):
    rng = np.random.default_rng(1)
    texts = ["hello " * int(n) for n in rng.lognormal(6, 1, 900)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    used, sequences = check(packing.pack_documents(df, PATH).collect(), texts)
    assert used / (sequences * 4096) > 0.97


def test_repeated_rows_and_empty_table(spark):
    df = spark.createDataFrame([(1, "a b"), (1, "a b")], "doc_id long, text string")
    assert packing.pack_documents(df, PATH).count() == 2
    assert packing.pack_documents(df.limit(0), PATH).count() == 0


def test_ids_are_returned_on_request(spark):
    df = spark.createDataFrame([(1, "hello world")], "doc_id long, text string")
    row = packing.pack_documents(df, PATH, with_ids=True).first()
    want = Tokenizer.from_file(PATH).encode("hello world", add_special_tokens=False).ids
    assert list(row["ids"]) == [*want, 2]


@pytest.mark.parametrize("seed", range(4))
def test_patterns_cover_the_demand(seed):
    rng = np.random.default_rng(seed)
    sizes = np.sort(rng.choice(np.arange(1, 513), 120, replace=False))
    demand = rng.integers(1, 500, 120)
    plan = packing.solve_patterns(sizes, demand, 512)
    assert all(sizes @ pattern <= 512 for pattern, _ in plan)
    assert (sum(pattern * n for pattern, n in plan) >= demand).all()


@pytest.mark.parametrize("seed", range(4))
def test_patterns_are_near_the_best(seed):
    """Orders cut from full sequences: as many sequences are enough."""
    rng = np.random.default_rng(seed)
    demand, sequences = np.zeros(513, int), 0
    for _ in range(60):
        cuts = np.sort(rng.choice(np.arange(1, 512), rng.integers(1, 6), replace=False))
        uses = int(rng.integers(20, 400))
        for size in np.diff([0, *cuts, 512]):
            demand[size] += uses
        sequences += uses
    sizes = np.flatnonzero(demand)
    plan = packing.solve_patterns(sizes, demand[sizes], 512)
    assert sum(n for _, n in plan) <= sequences * 1.001 + len(sizes) / 4
