"""Regular words that sums of weighted codes cannot tell apart, in all that hashes words."""

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from martflow.llm import bytes as raw, decontaminate, jaccard, lm, packing, quality


def regular_words(size=1024):
    """A Thue-Morse word of two letters, and the one with the letters exchanged."""
    word = [bin(i).count("1") % 2 for i in range(size)]
    return "".join("ab"[b] for b in word), "".join("ba"[b] for b in word)


def hashes(texts):
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    ends = np.cumsum([len(t.encode()) for t in texts])
    return raw.word_hashes(data, ends - [len(t.encode()) for t in texts], ends)


@pytest.mark.parametrize("size", [64, 128, 512, 1024, 4096])
def test_regular_words_differ(size):
    one, other = hashes(regular_words(size))
    assert one != other


def test_equal_words_are_equal_wherever_they_stand():
    words = ["", "a", "\0", "a\0", "12345678", "123456789", "12345678" * 3, "x" * 513, "é" * 300]
    found = hashes(words)
    assert len(set(found.tolist())) == len(words)
    again = hashes(["zz", *words, "y"])
    assert again[1:-1].tolist() == found.tolist()


def test_operators_tell_regular_words_apart(spark):
    one, other = regular_words()
    df = spark.createDataFrame([(1, one), (2, other), (3, one)], "doc_id long, text string")
    parts = {r["doc_id"]: r["component_id"] for r in jaccard.jaccard_components(df).collect()}
    assert parts == {1: 1, 2: 2, 3: 1}
    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    pieces = packing.token_pieces(df, path, with_ids=True)
    for r in pieces.where("start = 0").collect():
        ids = tokenizer.encode({1: one, 2: other, 3: one}[r["doc_id"]], add_special_tokens=False).ids
        assert r["ids"] == [*ids, 2]
    items = spark.createDataFrame([(9, other)], "item_id long, text string")
    found = decontaminate.mark_leaks(df, items, short_items=True).where("size(leaks) > 0")
    assert [r["doc_id"] for r in found.collect()] == [2]
    data = np.frombuffer(f"{one} {other}".encode(), np.uint8)
    offsets = np.array([0, len(data)])
    assert len(quality.distinct_words(data, offsets)[0]) == 2
    assert len(set(lm.word_hashes(data, offsets)[0].tolist())) == 3
