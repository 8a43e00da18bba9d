"""The pipeline against plain versions of its stages, and with odd rows."""

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from martflow.llm import bytes as raw, quality
from tests.llm import test_decontaminate, test_jaccard, test_packing, test_pii

DATA = "/root/testdata/sf0.001"


def read(spark, name):
    return spark.read.parquet(f"{DATA}/{name}.parquet")


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = read(spark, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = stage(spark, before, DATA)
        out.append((name, before.collect(), docs.collect()))
        docs = spark.createDataFrame(out[-1][2], docs.schema)
    return out


def test_quality_keeps_what_the_model_accepts(spark, stages):
    _, before, after = stages[0]
    labels = read(spark, "labels")
    learned = labels.where(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3)) != 1)
    model = quality.learn_quality(read(spark, "documents"), learned)
    data, offsets = raw.utf8(pa.array([r["text"] for r in before], pa.string()))
    good = model.scores(data, offsets) >= 0.5
    assert [r["doc_id"] for r in after] == [
        r["doc_id"] for r, g in zip(before, good, strict=True) if g
    ]
    assert 0 < len(after) < len(before)
    assert list(after[0].asDict()) == list(before[0].asDict())


def test_one_of_each_group_stays(stages):
    _, before, after = stages[1]
    plain = test_jaccard.plain([(r["doc_id"], r["text"]) for r in before], 5, 80)
    assert {r["doc_id"] for r in after} == {d for d, _, c in plain if d == c}
    assert len(after) < len(before)


def test_leaks_go(spark, stages):
    _, before, after = stages[2]
    items = [(r["item_id"], r["text"]) for r in read(spark, "benchmark").collect()]
    texts = [(r["doc_id"], r["text"]) for r in before if len(r["text"]) < 4000]
    gone = {d for d, _ in test_decontaminate.plain(texts[:40], items)}
    kept = {r["doc_id"] for r in after}
    assert all((d in kept) == (d not in gone) for d, _ in texts[:40])


def test_personal_data_is_masked(stages):
    _, before, after = stages[3]
    old = {r["doc_id"]: r["text"] for r in before}
    assert {r["doc_id"] for r in after} == set(old)
    for r in after:
        spans = test_pii.plain(old[r["doc_id"]])
        assert not test_pii.plain(r["text"])
        assert (r["text"] == old[r["doc_id"]]) or spans
        assert r["n_chars"] == len(r["text"])


def test_all_that_is_left_is_packed(stages):
    _, before, after = stages[4]
    texts = [r["text"] for r in before]
    number = {r["doc_id"]: i for i, r in enumerate(before)}
    rows = [{**r.asDict(), "doc_id": number[r["doc_id"]]} for r in after]
    used, sequences = test_packing.check(rows, texts)
    assert used / (sequences * 4096) > 0.9


def test_run_equals_the_stages(spark, stages):
    rows = corpus_pipeline.run(spark, DATA).collect()
    key = lambda r: (r["doc_id"], r["start"], r["ids_crc32"])
    assert sorted(map(key, rows)) == sorted(map(key, stages[-1][2]))


def test_odd_rows_and_empty_tables(spark, tmp_path):
    rows = [
        (1, None, "en", "s", None, 1.0),
        (2, "", None, None, 0, None),
        (3, "same words here and there again", "en", "s", 5, 1.0),
        (3, "same words here and there again", "en", "s", 5, 1.0),
        (None, "no key at all", "en", "s", 5, 1.0),
        (4, "tick tock " * 200_000, "en", "s", 5, 1.0),
    ]
    schema = "doc_id long, text string, lang string, source string, n_chars long, score double"
    for name, some in (("full", rows), ("empty", [])):
        folder = f"{tmp_path}/{name}"
        spark.createDataFrame(some, schema).write.parquet(f"{folder}/documents.parquet")
        spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(
            f"{folder}/labels.parquet"
        )
        spark.createDataFrame([], "item_id long, text string").write.parquet(
            f"{folder}/benchmark.parquet"
        )
        out = corpus_pipeline.run(spark, folder)
        ids = {r["doc_id"] for r in out.select("doc_id").collect()}
        assert ids == ({1, 2, 3, 4, None} if some else set())
