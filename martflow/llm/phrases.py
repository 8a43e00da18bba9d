"""Substring deduplication with automata of repeated phrases.

Removes every word that lies in a window of ``length`` words whose words also
start in a document with a smaller key. Windows are judged on the input. Words
are runs of non-space bytes, unchanged.

Runs of windows that several documents share are found and counted by
:mod:`martflow.llm.passages`. Where runs differ, recurring passages are
confirmed: the longest stretches of windows with the same first document and
the same places of occurrence. Shards of whole anchors compile their passages
into an Aho-Corasick automaton, over words numbered as characters, and all runs
of the shard are streamed through it to locate every occurrence.

Keys are integers. Null texts have no words; rows with a null key come before or
after no other, so they lose nothing and take nothing from others. Rows with the
same key don't remove each other's words. Empty tables give empty results.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from martflow.llm import bytes as raw, passages

# Words are written as characters from here on, beyond the surrogates.
FIRST_CHARACTER = 0x10000
# Characters of passages in one automaton.
SHARD_CHARACTERS = 1 << 20


def _confirmed(doc: np.ndarray, run: np.ndarray, window: np.ndarray):
    """Passages of repeated windows: run, first and last window place.

    ``doc``, ``run`` and ``window`` have a row for each window, in the order of
    runs and places. A passage lies in the run of smallest key among those that
    have its windows; all of them occur in the same runs.
    """
    _, kind = np.unique(window, return_inverse=True)
    count = int(kind.max(initial=-1)) + 1
    least = np.full(count, np.iinfo(np.int64).max)
    most = np.full(count, np.iinfo(np.int64).min)
    np.minimum.at(least, kind, doc)
    np.maximum.at(most, kind, doc)
    places = np.zeros(count, np.uint64)
    np.add.at(places, kind, raw.mix(run.astype(np.uint64) + np.uint64(1)))
    # The first run with a window, among those of the smallest key, owns it.
    owner = np.full(count, len(run))
    mine = np.flatnonzero(doc == least[kind])
    np.minimum.at(owner, kind[mine], mine)
    own = (owner[kind] == np.arange(len(run))) & (most[kind] > least[kind])
    place = np.flatnonzero(own)
    new = np.ones(len(place), bool)
    new[1:] = (
        (place[1:] != place[:-1] + 1)
        | (run[place][1:] != run[place][:-1])
        | (places[kind[place]][1:] != places[kind[place]][:-1])
    )
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(place)) - 1 if len(place) else first
    return place[first], place[last]


def _located(table: pa.Table, length: int) -> pa.RecordBatch:
    """Occurrences of the block's passages in its runs of larger keys."""
    data, offsets = raw.utf8(table.column("bytes").combine_chunks())
    shape = passages.Shape(length, 1, words=True)
    sums, begin, starts, ends = passages.unit_hashes(data, offsets, shape)
    doc = table.column("doc").to_numpy()
    count = np.diff(begin) - length + 1
    run = np.repeat(np.arange(len(count)), count)
    step = np.arange(len(run)) - np.repeat(np.cumsum(count) - count, count)
    start = begin[run] + step
    window = raw.range_hashes(sums, start, start + length)
    low, high = _confirmed(doc[run], run, window)

    hashes = raw.range_hashes(raw.byte_hashes(data), starts, ends)
    _, number = np.unique(hashes, return_inverse=True)
    text = (number + FIRST_CHARACTER).astype("<u4").tobytes().decode("utf-32-le")
    bounds = begin.tolist()
    found: list[tuple[int, int, int]] = []
    passage = list(
        zip(start[low].tolist(), (start[high] + length).tolist(), doc[run[low]].tolist(), strict=True)
    )
    at = 0
    while at < len(passage):
        automaton = ahocorasick.Automaton()
        weight = 0
        while at < len(passage) and weight < SHARD_CHARACTERS:
            first, stop, first_doc = passage[at]
            automaton.add_word(text[first:stop], (stop - first, first_doc))
            weight += stop - first
            at += 1
        automaton.make_automaton()
        for i, key in enumerate(doc.tolist()):
            for end, (size, first_doc) in automaton.iter(text, bounds[i], bounds[i + 1]):
                if key > first_doc:
                    begun = end - size + 1 - bounds[i]
                    found.append((i, begun, begun + size - length))
    i, first, last = (np.array(x, np.int64) for x in (zip(*found, strict=True) if found else ((),) * 3))
    taken = pa.array(i)
    return pa.RecordBatch.from_arrays(
        [
            table.column("anchor").combine_chunks().take(taken),
            table.column("run").combine_chunks().take(taken),
            pa.array(first.astype(np.int32)),
            pa.array(last.astype(np.int32)),
        ],
        ["anchor", "run", "low", "high"],
    )


def repeated_ranges(
    rows: DataFrame, length: int = 50, gram: int = 12, hot_runs: int = 100_000
) -> DataFrame:
    """Ranges of window starts that occur in an earlier document."""
    shape = passages.Shape(length, gram, words=True)
    found = passages.candidates(rows, shape, across=True, hot_runs=hot_runs)
    first_doc = found.kinds.select("anchor", "run", F.col("doc").alias("first_doc"))
    owned = found.kept.join(first_doc, ["anchor", "run"])
    whole = owned.where("doc > first_doc").select("uid", "first", "last")
    close = passages.by_anchor(
        passages.with_text(found.close, rows).drop("n", "lead", "at", "size"),
        lambda table: _located(table, length),
        "anchor long, run long, low int, high int",
    )
    single = passages.single_windows(passages.with_text(found.hot, rows), shape)
    first_of_window = single.groupBy("anchor", "window").agg(F.min("doc").alias("_first"))
    hot = (
        single.join(first_of_window, ["anchor", "window"])
        .where("doc > _first")
        .select("anchor", "run", F.col("step").alias("low"), F.col("step").alias("high"))
    )
    # A run may occur several times in its first document.
    inner = (
        close.unionByName(hot)
        .distinct()
        .join(owned.where("doc = first_doc"), ["anchor", "run"])
        .select(
            "uid",
            (F.col("first") + F.col("low")).alias("first"),
            (F.col("first") + F.col("high")).alias("last"),
        )
    )
    return whole.unionByName(inner)


def remove_phrases(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    length: int = 50,
    gram: int = 12,
    hot_runs: int = 100_000,
    with_kept: bool = False,
) -> DataFrame:
    """Per row: key, ``n_words``, ``n_removed``, ``kept_sha256``.

    ``with_kept`` adds the kept words, joined by single spaces.
    """
    rows = passages.numbered(df, key, text)
    marked = passages.with_ranges(rows, repeated_ranges(rows, length, gram, hot_runs))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in raw.blocks(batches, "text"):
            firsts, lasts = batch.column("firsts"), batch.column("lasts")
            total, removed, digest, kept = [], [], [], []
            for i in range(batch.num_rows):
                words = data[offsets[i] : offsets[i + 1]].tobytes().split()
                total.append(len(words))
                first = firsts[i].values.to_numpy()
                if len(first):
                    gone = passages.covered(first, lasts[i].values.to_numpy(), length, len(words))
                    removed.append(int(gone.sum()))
                    words = list(compress(words, ~gone))
                else:
                    removed.append(0)
                joined = b" ".join(words)
                digest.append(hashlib.sha256(joined).hexdigest())
                if with_kept:
                    kept.append(joined)
            columns = [
                batch.column("doc"),
                pa.array(total, pa.int64()),
                pa.array(removed, pa.int64()),
                pa.array(digest, pa.string()),
            ]
            names = ["doc", "n_words", "n_removed", "kept_sha256"]
            if with_kept:
                columns.append(pa.array(kept, pa.binary()).cast(pa.string()))
                names.append("kept")
            yield pa.RecordBatch.from_arrays(columns, names)

    kind = df.schema[key].dataType.simpleString()
    schema = f"doc {kind}, n_words long, n_removed long, kept_sha256 string"
    if with_kept:
        schema += ", kept string"
    return marked.mapInArrow(cut, schema).withColumnRenamed("doc", key)
