"""Quality classification with supervised subword embeddings.

A document is the average of learned vectors: one for each word and for each
run of three to five bytes of a word, its edges marked, all hashed into a table.
Pairs of one word and itself share a vector too, which counts as often as all
others of the word, so that repetition can be learned whatever the word is.
A softmax layer on the average separates the labels. Vectors and layer are
trained by stochastic gradient descent in numpy on a bounded sample.

Since the average and the layer are linear, the trained model is one number for
each table entry, and a text is scored by summing the numbers of its distinct
words. Every text is scored whole. Null and empty texts get the score of the
layer's offset alone. Repeated rows are scored alike. Rows without a label, or
with labels but without text, are not learned from. An empty table gives an
empty result. With fewer than two kinds of labels all scores are their share.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from martflow.llm import bytes as raw

SHORTEST, LONGEST = 3, 5
_EDGE = np.uint64(0x9E3779B97F4A7C15)
_LAST_EDGE = np.uint64(0x3C6EF372FE94F82A)
# The entry of a word that follows itself.
_TWICE = 0


def subwords(
    data: np.ndarray, starts: np.ndarray, ends: np.ndarray, buckets: int
) -> tuple[np.ndarray, np.ndarray]:
    """Table entries of words, and the number of the word of each."""
    sums = raw.byte_hashes(data)
    entries = [raw.range_hashes(sums, starts, ends)]
    owners = [np.arange(len(starts))]
    for size in range(SHORTEST, LONGEST + 1):
        per_word = np.maximum(ends - starts - size + 1, 0)
        owner = np.repeat(np.arange(len(starts)), per_word)
        first = np.concatenate([[0], np.cumsum(per_word)])[:-1]
        begin = np.arange(len(owner)) + np.repeat(starts - first, per_word)
        code = raw.range_hashes(sums, begin, begin + size) + np.uint64(size)
        # a run at an edge of the word is another entry than one inside
        code += (begin == starts[owner]) * _EDGE
        code += (begin + size == ends[owner]) * _LAST_EDGE
        entries.append(raw.mix(code))
        owners.append(owner)
    entry = (np.concatenate(entries) % np.uint64(buckets)).astype(np.int64)
    return entry, np.concatenate(owners)


def distinct_words(data: np.ndarray, offsets: np.ndarray):
    """First places of the distinct words, and word number and row of each word."""
    starts, ends, begin = raw.words(data, offsets)
    hashes = raw.word_hashes(data, starts, ends)
    _, first, place = np.unique(hashes, return_index=True, return_inverse=True)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(begin))
    return starts[first], ends[first], place, row


def repeats(place: np.ndarray, row: np.ndarray, size: np.ndarray, rows: int) -> np.ndarray:
    """For each row, the entries of the words that follow themselves."""
    again = (place[1:] == place[:-1]) & (row[1:] == row[:-1])
    return np.bincount(row[1:][again], size[place[1:][again]], rows)


@dataclass
class QualityModel:
    """A number for each table entry, and the layer's offset."""

    worth: np.ndarray
    offset: float

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row of a block."""
        rows = len(offsets) - 1
        data = raw.lower_ascii(data)
        starts, ends, place, row = distinct_words(data, offsets)
        entry, owner = subwords(data, starts, ends, len(self.worth))
        worth = np.bincount(owner, self.worth[entry], len(starts))
        size = np.bincount(owner, minlength=len(starts))
        twice = repeats(place, row, size, rows)
        total = np.bincount(row, worth[place], rows) + twice * self.worth[_TWICE]
        count = np.bincount(row, size[place], rows) + twice
        logit = total / np.maximum(count, 1) + self.offset
        return 1 / (1 + np.exp(-np.clip(logit, -500, 500)))


def train_quality(
    texts: list[bytes],
    labels: np.ndarray,
    buckets: int = 1 << 18,
    width: int = 8,
    epochs: int = 6,
    rate: float = 1.0,
    seed: int = 5,
) -> QualityModel:
    """Train vectors and softmax layer, one document at a time."""
    labels = np.asarray(labels, int)
    if len(set(labels.tolist())) < 2:
        share = (labels.sum() + 0.5) / (len(labels) + 1)
        return QualityModel(np.zeros(buckets, np.float32), float(np.log(share / (1 - share))))
    bags = []
    for text in texts:
        data, offsets = raw.utf8(pa.array([text], pa.large_binary()))
        data = raw.lower_ascii(data)
        starts, ends, place, row = distinct_words(data, offsets)
        entry, owner = subwords(data, starts, ends, buckets)
        times = np.bincount(place, minlength=len(starts))[owner]
        twice = repeats(place, row, np.bincount(owner, minlength=len(starts)), 1)
        entry, times = np.append(entry, _TWICE), np.append(times, twice)
        distinct, at = np.unique(entry, return_inverse=True)
        weight = np.bincount(at, times, len(distinct))
        bags.append((distinct.astype(np.int32), (weight / max(weight.sum(), 1)).astype(np.float32)))
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / width, 1 / width, (buckets, width)).astype(np.float32)
    layer = np.zeros((width, 2), np.float32)
    offset = np.zeros(2, np.float32)
    steps = epochs * len(bags)
    order = np.concatenate([rng.permutation(len(bags)) for _ in range(epochs)])
    for step, i in enumerate(order):
        entry, weight = bags[i]
        pace = np.float32(rate * (1 - step / steps))
        mean = weight @ vectors[entry]
        logit = mean @ layer + offset
        error = np.exp(logit - logit.max())
        error /= error.sum()
        error[labels[i]] -= 1
        back = layer @ error
        layer -= pace * np.outer(mean, error)
        offset -= pace * np.float32(0.1) * error
        # shares of a whole document are tiny, so entries step by their relative weight
        vectors[entry] -= pace * (weight / max(weight.max(initial=0), 1e-9))[:, None] * back
    return QualityModel(
        (vectors @ (layer[:, 1] - layer[:, 0])).astype(np.float32), float(offset[1] - offset[0])
    )


def learn_quality(
    documents: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    sample_rows: int = 6000,
    max_bytes: int = 32_768,
) -> QualityModel:
    """Train on at most ``sample_rows`` labelled whole texts of ``max_bytes`` at most.

    The sample is the labelled keys of smallest hash. Of several labels of one
    key the lowest counts, of several texts the first in byte order. Texts are
    found by a join with that short list, and one task trains on them: neither
    texts nor vectors reach the driver, only the number of each table entry.
    """
    usable = labels.where(labels[label].isin(0, 1) & labels[key].isNotNull())
    listed = usable.groupBy(labels[key].alias("_key")).agg(F.min(label).cast("int").alias("_label"))
    picked = listed.orderBy(F.xxhash64("_key"), "_key").limit(sample_rows).collect()
    spark = documents.sparkSession
    kind = labels.schema[key].dataType.simpleString()
    chosen = spark.createDataFrame([tuple(r) for r in picked], f"_key {kind}, _label int")
    rows = documents.where(F.octet_length(documents[text]).between(1, max_bytes)).select(
        documents[key].alias("_key"), documents[text].alias("_text")
    )
    sample = rows.join(F.broadcast(chosen), "_key").groupBy("_key").agg(
        F.min("_text").cast("binary").alias("_text"), F.min("_label").alias("_label")
    )

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts: list[bytes] = []
        marks: list[int] = []
        for batch in batches:
            texts += batch.column("_text").to_pylist()
            marks += batch.column("_label").to_pylist()
        model = train_quality(texts, np.array(marks, int))
        yield pa.RecordBatch.from_arrays(
            [pa.array([model.worth.tobytes()]), pa.array([model.offset])], ["worth", "offset"]
        )

    fitted = sample.coalesce(1).sortWithinPartitions("_key").select("_text", "_label")
    found = fitted.mapInArrow(fit, "worth binary, offset double").first()
    if found is None:
        return train_quality([], np.zeros(0, int))
    return QualityModel(np.frombuffer(found["worth"], np.float32), found["offset"])


def score_quality(
    df: DataFrame, model: QualityModel, text: str = "text", keep: list[Column] | None = None
) -> DataFrame:
    """Add ``score`` to the columns ``keep`` (default: all)."""
    kept = df.select(*(keep if keep is not None else [df[c] for c in df.columns]))
    names = [f"_{i}" for i in range(len(kept.columns))]
    if keep is None:
        whole, source = kept.toDF(*names), names[df.columns.index(text)]
    else:
        whole, source = df.select(*keep, df[text].alias("_text")).toDF(*names, "_text"), "_text"

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in raw.blocks(batches, source):
            arrays = [batch.column(n) for n in names]
            arrays.append(pa.array(model.scores(data, offsets)))
            yield pa.RecordBatch.from_arrays(arrays, [*names, "_score"])

    fields = [
        f"{n} {f.dataType.simpleString()}" for n, f in zip(names, kept.schema.fields, strict=True)
    ]
    scored = whole.mapInArrow(score, ", ".join([*fields, "_score double"]))
    return scored.toDF(*kept.columns, "score")
