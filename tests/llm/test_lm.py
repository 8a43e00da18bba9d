"""Language-model scores: exact counts, normalised probabilities, held-out gain."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from martflow.llm import lm
from martflow.llm.queries import QUERIES

DATA = "/root/testdata/sf0.01"


def tokens(text):
    low = re.sub("[A-Z]", lambda m: m.group(0).lower(), text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", low), None]


def plain(rows, held):
    """Per row: tokens, known tokens, training tokens, base score."""
    counts = Counter()
    for (_, t), h in zip(rows, held, strict=True):
        if not h:
            counts.update(tokens(t))
    total, kinds = sum(counts.values()), len(counts)
    mass = total + 0.5 * (kinds + 1)
    out = []
    for (d, t), h in zip(rows, held, strict=True):
        own = tokens(t)
        base = sum(math.log10((counts[w] + 0.5) / mass) for w in own)
        out.append((d, h, len(own), sum(counts[w] > 0 for w in own), total, base))
    return sorted(out, key=str)


def check(got, want):
    assert len(got) == len(want)
    for g, w in zip(sorted(got, key=str), want, strict=True):
        assert g[:5] == w[:5]
        assert g[5] == pytest.approx(w[5], rel=1e-9, abs=1e-9)
        assert np.isfinite(g[6]) and g[6] <= 1e-6


@pytest.mark.parametrize("table_words", [5, 1000])
def test_cases(spark, table_words):
    rows = [(i, f"the cat {i % 7} sat on the mat {'x' * (i % 5)}") for i in range(40)]
    rows += [(50, None), (51, ""), (52, "The\tCAT\n unseen"), (53, "new words " * 30_000)]
    rows += [(54, "same"), (54, "same"), (None, "the dog")]
    held = [d is not None and d % 5 == 2 for d, _ in rows]
    df = spark.createDataFrame(
        [(d, t, "x") for d, t in rows], "doc_id long, text string, word string"
    ).repartition(3)
    out = lm.score_texts(df, F.col("doc_id") % 5 == 2, table_words=table_words, model_words=6)
    check([tuple(r) for r in out.collect()], plain(rows, held))
    assert lm.score_texts(df.limit(0), F.lit(False)).count() == 0
    unseen = lm.score_texts(df, F.lit(True)).select("n_known", "base_score", "train_tokens")
    assert {tuple(r) for r in unseen.collect()} == {(0, 0.0, 0)}


def test_rare_words_do_not_depend_on_the_table(spark):
    rows = [(i, f"alpha beta w{i} w{i // 2} gamma") for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    score = lambda **o: {
        r["doc_id"]: r["score"]
        for r in lm.score_texts(df, F.lit(False), model_words=3, **o).collect()
    }
    some, every = score(table_words=4), score(table_words=1000)
    assert some == pytest.approx(every, rel=1e-6)


def test_outputs_do_not_depend_on_the_sample(spark):
    # the commonest word stands only in a text that is too long for the sample
    rows = [(i, f"alpha beta w{i} w{i // 2} gamma") for i in range(30)] + [(30, "omega " * 200)]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    score = lambda **o: {
        r["doc_id"]: r["score"]
        for r in lm.score_texts(df, F.lit(False), model_words=3, **o).collect()
    }
    every = score()
    assert score(sample_bytes=100) == pytest.approx(every, rel=1e-6)
    assert score(sample_bytes=1) == pytest.approx(every, rel=1e-6)
    assert score(table_words=1) == pytest.approx(every, rel=1e-6)


def test_probabilities_add_up_to_one():
    rng = np.random.default_rng(0)
    size = 9
    model = lm.first_model(np.full(size, 1 / size))
    model.target[:] = rng.normal(0, 1, model.target.shape)
    totals = lm.log_totals(model)
    for near in range(size):
        for far in range(size):
            # text: far, near, word; an end before "near" hides "far"
            logs = [
                lm.log_probabilities(model, totals, np.array([far, near, w]))[2]
                for w in range(size)
            ]
            assert np.exp(logs).sum() == pytest.approx(1, abs=1e-5)


def test_training_learns_what_follows():
    sequence = np.tile([1, 2, 3, 4, 1, 2, 3, 0], 4000)
    share = (np.bincount(sequence, minlength=6) + 0.5) / (len(sequence) + 3)
    trainer = lm.Trainer(lm.first_model(share), share, 0)
    before = lm.log_probabilities(trainer.model, lm.log_totals(trainer.model), sequence).mean()
    for _ in range(6):
        trainer.learn(sequence)
    after = lm.log_probabilities(trainer.model, lm.log_totals(trainer.model), sequence).mean()
    assert before < -1.2 and after > -0.5


def test_contexts_stay_within_a_text():
    near, far = lm.contexts(np.array([5, 6, 7, 0, 8, 9, 0, 0, 4]))
    assert near.tolist() == [0, 5, 6, 7, 0, 8, 9, 0, 0]
    assert far.tolist() == [0, 0, 5, 6, 0, 0, 8, 0, 0]


def test_query(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()
    rows = [tuple(d) for d in docs]
    held = [zlib.crc32(str(d).encode()) % 5 == 1 for d, _ in rows]
    out = [tuple(r) for r in QUERIES["op10_lm"](spark, DATA).collect()]
    check(out, plain(rows, held))
    apart = [r for r in out if r[1]]
    assert sum(r[6] for r in apart) > sum(r[5] for r in apart)


def test_slopes_are_summed_by_row_with_one_sort_of_short_numbers():
    rng = np.random.default_rng(5)
    place, slope = rng.integers(0, 300, 4000), rng.normal(size=(4000, 3)).astype(np.float32)
    by_row = lm._ByRow(place, 300)
    want = np.zeros((300, 3))
    np.add.at(want, place, slope)
    assert by_row.row.dtype == place.dtype and (np.diff(by_row.row) > 0).all()
    got = np.zeros((300, 3))
    got[by_row.row] = by_row.total(slope)
    np.testing.assert_allclose(got, want, atol=1e-4)
    # the sums of two arrays, of one and of two dimensions, share the sort
    np.testing.assert_allclose(by_row.total(slope[:, 0]), want[by_row.row, 0], atol=1e-4)
