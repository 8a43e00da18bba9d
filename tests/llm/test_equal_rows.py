"""Rows equal in key and text: each text and each range is brought together once."""

from pyspark.sql import functions as F

from martflow.llm import jaccard, passages, phrases, suffixes

COPIES = 3000


def equal_rows(spark, key=7):
    text = " ".join(f"word{i}" for i in range(60))
    rows = [(key, text)] * COPIES + [(8, f"before {text} after"), (9, "alone")]
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(3)


def test_a_run_gets_its_text_once(spark):
    rows = passages.numbered(equal_rows(spark), "doc_id", "text")
    runs = rows.where("doc = 7").select("uid").distinct()
    runs = runs.select("uid", F.lit(5).alias("at"), F.lit(6).alias("size"))
    out = passages.with_text(runs, rows).collect()
    assert [bytes(r["bytes"]) for r in out] == [b" word1"]


def test_ranges_of_equal_rows_are_listed_once(spark):
    rows = passages.numbered(equal_rows(spark), "doc_id", "text")
    ranges = rows.where("doc = 7").select("uid", F.lit(3).alias("first"), F.lit(4).alias("last"))
    out = passages.with_ranges(rows, ranges).groupBy("doc", "firsts", "lasts").count()
    found = sorted((r["doc"], r["firsts"], r["lasts"], r["count"]) for r in out.collect())
    assert found == [(7, [3], [4], COPIES), (8, [], [], 1), (9, [], [], 1)]


def test_a_class_has_one_text(spark):
    rows = passages.numbered(equal_rows(spark), "doc_id", "text")
    example = rows.where("doc = 7").select("uid").distinct()
    example = example.select("uid", F.lit(1).alias("class"), F.lit(58).alias("n_grams"))
    assert [(r["class"], len(r["text"])) for r in jaccard.class_texts(rows, example).collect()] == [(1, 409)]


def test_results_of_equal_rows(spark):
    df = equal_rows(spark, key=None)
    size = len(" ".join(f"word{i}" for i in range(60)))
    out = suffixes.remove_repeats(df).groupBy("doc_id", "n_removed").count().collect()
    assert {tuple(r) for r in out} == {(None, size, COPIES), (8, size, 1), (9, 0, 1)}
    df = equal_rows(spark)
    out = phrases.remove_phrases(df).groupBy("doc_id", "n_removed").count().collect()
    assert {tuple(r) for r in out} == {(7, 0, COPIES), (8, 60, 1), (9, 0, 1)}
    out = jaccard.jaccard_components(df).groupBy("doc_id", "component_id").count().collect()
    assert {tuple(r) for r in out} == {(7, 7, COPIES), (8, 7, 1), (9, 9, 1)}
