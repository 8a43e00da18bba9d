"""Decontamination: masks that miss nothing, and leaks as a plain search finds them."""

import random
import re
from itertools import combinations

import numpy as np
import pytest

from martflow.llm import decontaminate as dc
from martflow.llm.queries import QUERIES

DATA = "/root/testdata/sf0.01"


@pytest.mark.parametrize("width", range(dc.SHORTEST, dc.WINDOW + 1))
def test_masks_hit_every_tolerated_window(width):
    for wrong in combinations(range(width), int(width * dc.TOLERATED + 1e-9)):
        assert any(
            not any(start + place in wrong for place in mask)
            for mask in dc.MASKS
            for start in range(width - mask[-1])
        )


def split(text):
    low = re.sub("[A-Z]", lambda m: m.group(0).lower(), text or "")
    return re.findall(r"(?:[0-9a-z]|[^\x00-\x7f])+", low)


def plain(documents, items):
    out = set()
    for d, text in documents:
        words = split(text)
        for i, item in items:
            own = split(item)
            if i is None or len(own) < dc.SHORTEST:
                continue
            width = min(len(own), dc.WINDOW)
            need = width - int(width * dc.TOLERATED + 1e-9)
            for q in range(len(own) - width + 1):
                for p in range(-width + need, len(words) - need + 1):
                    same = sum(
                        0 <= p + k < len(words) and words[p + k] == own[q + k]
                        for k in range(width)
                    )
                    if same >= need:
                        out.add((d, i, same))
    best = {}
    for d, i, same in out:
        best[d, i] = max(best.get((d, i), 0), same)
    return best


def found(spark, documents, items, **options):
    docs = spark.createDataFrame(
        [(d, t, "x") for d, t in documents], "doc_id long, text string, item string"
    )
    bench = spark.createDataFrame(
        [(i, t, 1) for i, t in items], "item_id long, text string, doc_id int"
    )
    rows = dc.mark_leaks(docs, bench, **options).collect()
    assert len(rows) == len(documents)
    return {(r["doc_id"], x["item"]): x["matched"] for r in rows for x in r["leaks"]}


@pytest.mark.parametrize("options", [{}, {"block_bytes": 300}])
def test_random_texts_with_substitutions(spark, options):
    rng = random.Random(3)
    vocabulary = ["a", "the", "of"] + [f"w{i}" for i in range(40)]
    draw = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [(i, " ".join(draw(rng.choice([1, 7, 8, 9, 11, 13, 14, 30])))) for i in range(25)]
    documents = []
    for d in range(150):
        words = draw(rng.randint(0, 40))
        if d % 2:
            own = items[d % 25][1].split()
            for _ in range(rng.randint(0, 4)):
                own[rng.randrange(len(own))] = "zzz"
            at = rng.randint(0, len(words))
            words[at:at] = own
        documents.append((d, ", ".join(words).title() if d % 3 else " ".join(words)))
    want = plain(documents, items)
    assert found(spark, documents, items, **options) == want
    assert len(want) > 15


def test_cases(spark):
    item = "one two three four five six seven eight nine ten"
    items = [(1, item), (1, item), (2, None), (3, ""), (None, item), (4, "one two")]
    documents = [
        (1, None),
        (2, ""),
        (3, item),
        (3, item),
        (4, "ONE two, three-four five six seven eight nine TEN!"),
        (5, "x " * 300_000 + item),
        (6, "one two three four five"),
    ]
    assert found(spark, documents, items) == {(3, 1): 10, (4, 1): 10, (5, 1): 10}
    assert found(spark, documents, items[:0]) == {}
    assert found(spark, documents[:0], items) == {}
    docs = spark.createDataFrame(documents, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    left = dc.without_leaks(docs, bench)
    assert sorted(r["doc_id"] for r in left.collect()) == [1, 2, 6] and left.columns == docs.columns


def test_hot_seed_is_taken_in_parts(spark, monkeypatch):
    monkeypatch.setattr(dc, "PAIRS_AT_ONCE", 50)
    block = dc.ItemBlock(["a b c d e f g h"] * 9)
    text = "a b c d e f g h " * 40
    hashes, begin = dc.tokens(np.frombuffer(text.encode(), np.uint8), np.array([0, len(text)]))
    row, item, same, first = block.leaks(hashes, begin)
    assert item.tolist() == list(range(9)) and set(same) == {8} and set(first) == {0}


def test_query_finds_whole_items(spark):
    rows = QUERIES["op2_decontamination"](spark, DATA).collect()
    got = {(r["doc_id"], r["item_id"]) for r in rows}
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()
    items = spark.read.parquet(f"{DATA}/benchmark.parquet").select("item_id", "text").collect()
    joined = [(d["doc_id"], f" {' '.join(split(d['text']))} ") for d in docs]
    for i in items:
        own = split(i["text"])
        if len(own) >= dc.SHORTEST:
            needle = f" {' '.join(own)} "
            assert {(d, i["item_id"]) for d, t in joined if needle in t} <= got
    assert len({d for d, _ in got}) < len(docs) * 0.1


def test_short_items_are_found_word_for_word(spark):
    items = [(1, "Who wrote Faust?"), (2, "who wrote faust"), (3, "wrote"), (4, "one two"), (5, "?")]
    documents = [
        (1, "So: who wrote Faust, and who wrote Faust again?"),
        (2, "who wrote the Faust"),
        (3, "one"),
        (4, "two one"),
        (5, "one-two"),
        (6, None),
    ]
    want = {(1, 1): 3, (1, 2): 3, (1, 3): 1, (2, 3): 1, (5, 4): 2}
    assert found(spark, documents, items, short_items=True) == want
    assert found(spark, documents, items, short_items=True, block_bytes=10) == want
    assert found(spark, documents, items) == {}


def test_characters_of_scripts_without_spaces_are_tokens(spark):
    chinese, thai = "中华人民共和国的首都是哪里？", "เมืองหลวงของไทย"
    items = [(1, chinese), (2, thai), (3, "首都")]
    documents = [
        (1, f"请问，{chinese}答案很简单。"),
        (2, f"ABC{thai}xyz"),
        (3, "法国的首都在哪里"),
        (4, "Ärger über Größe — l’été"),
    ]
    want = {(1, 1): 13, (1, 3): 2, (2, 2): 13, (3, 3): 2}
    assert found(spark, documents, items, short_items=True) == want

    def parts(text):
        data = np.frombuffer(text.encode(), np.uint8)
        return len(dc.tokens(data, np.array([0, len(data)]))[0])

    assert parts("") == 0 and parts("、。") == 0 and parts("a中b国𠀀") == 5
    assert parts("カタ・カナ ２０２６年") == 6 and parts("Größe—été") == 1


def test_columns_of_any_name_stay(spark):
    df = spark.createDataFrame([(1, "a b c d e f g h i j k l m n o p", 5), (2, "q", 6)], "item int, text string, _found int")
    items = spark.createDataFrame([(3, "a b c d e f g h i j k l m n o p")], "item_id int, text string")
    left = dc.without_leaks(df, items)
    assert left.columns == df.columns and [tuple(r) for r in left.collect()] == [(2, "q", 6)]
    with pytest.raises(ValueError):
        dc.mark_leaks(df, items, out="_found")
