"""Registered queries of the training-data operators, with SQL where it fits."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from martflow.llm import (
    decontaminate,
    jaccard,
    language,
    lattice,
    lines,
    lm,
    packing,
    phrases,
    pii,
    quality,
    spelling,
    suffixes,
    tries,
)
from martflow.llm.samples import remainder
from martflow.llm.shipping import ship_package
from martflow.llm.stored import stored
from martflow.sources.tables import read_parquet

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str):
    """Register a query under a name; its workers can import this package."""

    def keep(function):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            ship_package(spark)
            return function(spark, folder)

        QUERIES[name] = run
        return run

    return keep


@query("op7_pii")
def personal_data(spark: SparkSession, folder: str) -> DataFrame:
    documents = read_parquet(spark, folder, "documents").select("doc_id", "text")
    found = pii.find_pii(documents, "text", "found").select("doc_id", "found")
    return found.select(
        "doc_id", *[c.alias(name) for name, c in pii.pii_digest(F.col("found")).items()]
    )


@query("op5_packing")
def packing_by_patterns(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(
        read_parquet(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json")
    )


@query("op6_language")
def language_of_documents(spark: SparkSession, folder: str) -> DataFrame:
    documents = read_parquet(spark, folder, "documents")
    held_out = remainder(documents["doc_id"], 3) == 1
    trees = language.learn_languages(documents.where(~held_out))
    return language.predict_language(
        documents, trees, keep=[documents["doc_id"], held_out.alias("held_out")]
    )


@query("op9_quality")
def quality_of_documents(spark: SparkSession, folder: str) -> DataFrame:
    documents = read_parquet(spark, folder, "documents")
    labels = read_parquet(spark, folder, "labels")
    model = quality.learn_quality(
        documents, labels.where(remainder(labels["doc_id"], 3) != 1)
    )
    held_out = (remainder(documents["doc_id"], 3) == 1).alias("held_out")
    scored = quality.score_quality(documents, model, keep=[documents["doc_id"], held_out])
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


@query("op2_decontamination")
def leaked_items(spark: SparkSession, folder: str) -> DataFrame:
    documents = read_parquet(spark, folder, "documents").select("doc_id", "text")
    benchmark = read_parquet(spark, folder, "benchmark")
    marked = decontaminate.mark_leaks(documents, benchmark, short_items=True)
    return marked.select("doc_id", F.inline("leaks")).select(
        "doc_id",
        F.col("item").alias("item_id"),
        F.col("matched").alias("n_matched"),
        F.col("first").alias("first_token"),
    )


@query("op1_suffixes")
def repeated_strings(spark: SparkSession, folder: str) -> DataFrame:
    return suffixes.remove_repeats(read_parquet(spark, folder, "documents"))


@query("op8_phrases")
def repeated_passages(spark: SparkSession, folder: str) -> DataFrame:
    return phrases.remove_phrases(read_parquet(spark, folder, "documents"))


@query("op3_jaccard")
def similar_documents(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.jaccard_components(read_parquet(spark, folder, "documents"))


@query("op4_lattice")
def similar_embeddings(spark: SparkSession, folder: str) -> DataFrame:
    return lattice.near_duplicates(read_parquet(spark, folder, "embeddings"))


@query("op10_lm")
def language_model_scores(spark: SparkSession, folder: str) -> DataFrame:
    documents = read_parquet(spark, folder, "documents")
    return lm.score_texts(documents, remainder(documents["doc_id"], 5) == 1)


@query("op12_lines")
def repeated_lines(spark: SparkSession, folder: str) -> DataFrame:
    documents = read_parquet(spark, folder, "documents").select("doc_id", "text")
    left = lines.apply_bitmaps(documents, lines.keep_bitmaps(documents))
    text, kept = F.coalesce("row.text", F.lit("")), F.coalesce("kept", F.lit(""))
    ends = F.char_length(text) - F.char_length(F.replace(text, F.lit("\n"), F.lit("")))
    return left.select(
        "row.doc_id",
        (ends + 1).cast("long").alias("n_lines"),
        "n_dropped",
        F.sha2(kept.cast("binary"), 256).alias("kept_sha256"),
    )


@query("op13_spelling")
def spelling_of_words(spark: SparkSession, folder: str) -> DataFrame:
    documents = read_parquet(spark, folder, "documents")
    runs = documents.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"),
        F.explode(spelling.words_of(F.col("text"), spelling.MIN_CHARS)).alias("run"),
    )
    # One letter of every 31st run of a document is lost.
    mark = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    place = F.pmod(mark, F.char_length("run")).cast("int")
    rest = F.concat(F.left("run", place), F.substr("run", place + 2))
    word = F.when(F.pmod(mark, F.lit(31)) == 0, rest).otherwise(F.col("run")).alias("word")
    return spelling.spelling_groups(spelling.word_counts(runs.select(word), spelling.MIN_CHARS, 2))


@query("op11_trie")
def trie_of_conversations(spark: SparkSession, folder: str) -> DataFrame:
    turns = stored(tries.numbered_turns(read_parquet(spark, folder, "conversations")))
    sizes = stored(turns.groupBy("conv").agg(F.count("*").alias("size")))
    # The first turns of a conversation, 0 to 5, are those of its hundred's first one.
    taken = F.pmod(F.crc32(F.col("conv").cast("string").cast("binary")), F.lit(6))
    base = F.col("conv") - F.pmod("conv", F.lit(100))
    firsts = sizes.select(F.col("conv").alias("base"), F.col("size").alias("there"))
    convs = sizes.select("conv", base.alias("base"), taken.alias("taken")).join(firsts, "base", "left")
    head = turns.where("at < 5").withColumnRenamed("conv", "base")
    heads = convs.join(head, "base").where("at < taken").select("conv", "at", "name", "chars")
    moved = F.least("taken", F.coalesce("there", F.lit(0))) - F.col("taken")
    tails = turns.join(convs.select("conv", "taken", moved.alias("moved")), "conv").where("at >= taken")
    tails = tails.select("conv", (F.col("at") + F.col("moved")).alias("at"), "name", "chars")
    return tries.prefix_trie(heads.unionByName(tails), sizes.select("conv"))


# 3-word shingles, all pairs with a common shingle, and components by recursion.
ORACLES["op3_jaccard"] = r"""
WITH RECURSIVE lists AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct([w[i] || ' ' || w[i+1] || ' ' || w[i+2] for i in range(1, len(w) - 1)])
    END AS s FROM lists),
classes AS (SELECT list_sort(s) AS s, len(s) AS n, min(doc_id) AS rep FROM sets GROUP BY ALL),
items AS (SELECT rep, n, unnest(s) AS g FROM classes),
pairs AS (
  SELECT a.rep AS x, b.rep AS y FROM items a JOIN items b
    ON a.g = b.g AND a.rep < b.rep AND 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n)
  GROUP BY a.rep, b.rep, a.n, b.n
  HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
edges AS (SELECT x, y FROM pairs UNION SELECT y, x FROM pairs),
reach AS (SELECT x, y FROM edges UNION SELECT r.x, e.y FROM reach r JOIN edges e ON r.y = e.x),
roots AS (SELECT x, least(x, min(y)) AS root FROM reach GROUP BY x)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles,
  CASE WHEN len(s.s) = 0 THEN s.doc_id ELSE coalesce(r.root, c.rep) END AS component_id
FROM sets s LEFT JOIN classes c ON list_sort(s.s) = c.s LEFT JOIN roots r ON r.x = c.rep
"""

ORACLES["op12_lines"] = r"""
WITH lists AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
lines AS (SELECT doc_id, unnest(l) AS line, unnest(range(len(l))) AS pos FROM lists),
named AS (
  SELECT doc_id, line, pos, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS name FROM lines),
common AS (
  SELECT name, max(doc_id) AS keeper FROM named WHERE length(name) >= 40
  GROUP BY name HAVING count(DISTINCT doc_id) >= 5),
judged AS (
  SELECT n.*, c.name IS NOT NULL AND n.doc_id <> keeper AS gone FROM named n LEFT JOIN common c USING (name))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""

# crc32 of short ASCII texts; all prefixes as lists of turns, and all pairs above and below.
ORACLES["op11_trie"] = r"""
WITH crc AS (
  SELECT [list_reduce(range(8), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END,
    n) FOR n IN range(256)] AS t),
numbered AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
  SELECT conv_id, conv_id - conv_id % 100 AS base, xor(list_reduce(
      [CAST(ascii(x) AS BIGINT) FOR x IN string_split(CAST(conv_id AS VARCHAR), '')],
      lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) % 6 AS h
  FROM (SELECT DISTINCT conv_id FROM numbered), crc),
rebuilt AS (
  SELECT c.conv_id, pos, role, text FROM convs c JOIN numbered n ON n.conv_id = base AND pos <= h
  UNION ALL
  SELECT c.conv_id, pos + 10, role, text FROM convs c JOIN numbered n ON n.conv_id = c.conv_id AND pos > h),
seqs AS (
  SELECT c.conv_id, coalesce(list({'role': role, 'text': text} ORDER BY pos) FILTER (pos IS NOT NULL), []) AS s
  FROM convs c LEFT JOIN rebuilt r USING (conv_id) GROUP BY c.conv_id),
prefixes AS (SELECT conv_id, len(s) AS size, unnest([s[1:d] FOR d IN range(len(s) + 1)]) AS p FROM seqs),
nodes AS (
  SELECT p, len(p) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
    (count(*) - 1) * coalesce(length(p[len(p)].text), 0) AS own,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (size = len(p)), '')) AS ends
  FROM prefixes GROUP BY p),
families AS (
  SELECT n.*, m.conv_id AS parent FROM nodes n LEFT JOIN nodes m ON n.depth > 0 AND m.p = n.p[1:n.depth - 1]),
children AS (SELECT p[1:depth - 1] AS p, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY ALL),
below AS (
  SELECT unnest([f.p[1:d] FOR d IN range(f.depth + 1)]) AS p, own, CASE WHEN c.n IS NULL THEN 1 ELSE 0 END AS leaf
  FROM families f LEFT JOIN children c ON f.p = c.p),
totals AS (SELECT p, sum(own) AS saved, sum(leaf) AS leaves FROM below GROUP BY p)
SELECT conv_id, CAST(depth AS BIGINT) AS depth, parent AS parent_conv_id, n_convs,
  CAST(coalesce(c.n, 0) AS BIGINT) AS n_children, CAST(leaves AS BIGINT) AS n_leaves,
  CAST(saved AS BIGINT) AS saved_tokens, ends AS ends_sha256
FROM families f JOIN totals t ON f.p = t.p LEFT JOIN children c ON c.p = f.p
"""
