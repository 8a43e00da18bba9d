"""Suffix-array deduplication, built blockwise with a difference cover.

Removes every byte that lies in a string of ``length`` bytes which also starts
elsewhere, in another text or in the same one. Strings never cross texts and are
judged on the input.

Suffixes are compared by their first ``length`` bytes. They are brought together
in buckets by their anchor (:mod:`martflow.llm.passages`), and one block of
buckets is sorted at a time. Positions whose residue modulo 7 is in the cover
{0, 1, 3} are sampled; their ranks are found first, by doubling the compared
length in steps of 7. For any two suffixes some shift below 7 takes both to
sampled positions. So suffixes that tie in their first and last bytes are
resolved by the ranks at that shift, without comparing them byte by byte, and
memory is bounded by the block.

Null texts count as empty and have nothing to remove. Rows equal in key and text
remove each other's bytes, like any repeated text. Empty tables give empty
results.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from martflow.llm import bytes as raw, passages

MODULUS = 7
COVER = (0, 1, 3)
# Smallest shift that takes both residues into the cover.
SHIFT = np.array(
    [
        [
            next(s for s in range(MODULUS) if {(a + s) % MODULUS, (b + s) % MODULUS} <= set(COVER))
            for b in range(MODULUS)
        ]
        for a in range(MODULUS)
    ]
)


def _words(data: np.ndarray) -> np.ndarray:
    """The eight bytes at each position as one number; zeros follow the end."""
    longer = np.concatenate([data, np.zeros(8, np.uint8)])
    out = np.zeros(len(data), np.uint64)
    for place in range(8):
        out <<= np.uint64(8)
        out |= longer[place : place + len(data)]
    return out


def _ranks(values: np.ndarray) -> np.ndarray:
    return np.unique(values, return_inverse=True)[1].astype(np.int64)


def _pair_ranks(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Ranks of pairs of ranks."""
    return _ranks(one * (int(other.max(initial=0)) + 1) + other)


def cover_ranks(words: np.ndarray, length: int) -> tuple[np.ndarray, int]:
    """Ranks of the sampled positions by a prefix of just under ``length`` bytes.

    Returns an array over all positions, filled at sampled ones, and the length
    compared, at least ``length`` - 6.
    """
    count = len(words)
    place = np.flatnonzero(np.isin(np.arange(count) % MODULUS, COVER))
    rank = np.zeros(count + 2 * length, np.int64)
    rank[place] = _ranks(words[place])
    compared, step = 8, MODULUS
    while compared < length - MODULUS + 1:
        step = min(compared, length - compared) // MODULUS * MODULUS
        rank[place] = _pair_ranks(rank[place], rank[place + step])
        compared += step
    return rank, compared


def repeated_suffixes(data: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """Which of the suffixes at ``starts`` agree with another in ``length`` bytes.

    All starts must have ``length`` bytes left; bytes after a text's end don't
    matter. ``length`` must be at least 32.
    """
    again = np.zeros(len(starts), bool)
    if len(starts) < 2:
        return again
    words = _words(data)
    rank8 = _ranks(words)
    tie = _pair_ranks(rank8[starts], rank8[starts + length - 8])
    tie = _pair_ranks(tie, rank8[starts + length - 16])
    # Only ties of the first and last bytes go on.
    size = np.bincount(tie)
    left = np.flatnonzero(size[tie] > 1)
    if not len(left):
        return again
    rank, compared = cover_ranks(words, length - MODULUS + 1)
    assert compared + 16 >= length
    base = int(rank.max()) + 1
    tie = _ranks(tie[left])
    place = starts[left]
    residue = place % MODULUS
    members = [np.flatnonzero(residue == r) for r in range(MODULUS)]
    found = np.zeros(len(left), bool)
    for a in range(MODULUS):
        for b in range(a, MODULUS):
            both = members[a] if a == b else np.concatenate([members[a], members[b]])
            if len(both) < 2:
                continue
            key = tie[both] * base + rank[place[both] + SHIFT[a, b]]
            order = np.argsort(key, kind="stable")
            same = np.flatnonzero(key[order][1:] == key[order][:-1])
            found[both[order[same]]] = True
            found[both[order[same + 1]]] = True
    again[left] = found
    return again


def _sorted_block(table: pa.Table, length: int) -> pa.RecordBatch:
    """Repeated window starts of the runs in a block, as ranges within their rows."""
    data, offsets = raw.utf8(table.column("bytes").combine_chunks())
    count = np.diff(offsets) - length + 1
    run = np.repeat(np.arange(len(count)), count)
    step = np.arange(len(run)) - np.repeat(np.cumsum(count) - count, count)
    again = repeated_suffixes(data, offsets[run] + step, length)
    # Runs that occur twice as a whole are known already.
    again &= table.column("n").to_numpy()[run] == 1
    place = np.flatnonzero(again)
    new = np.ones(len(place), bool)
    new[1:] = (run[place][1:] != run[place][:-1]) | (step[place][1:] != step[place][:-1] + 1)
    low = place[new]
    high = place[np.append(np.flatnonzero(new)[1:], len(place)) - 1] if len(place) else place
    first = table.column("first").to_numpy()[run[low]]
    return pa.RecordBatch.from_arrays(
        [
            table.column("uid").combine_chunks().take(pa.array(run[low])),
            pa.array((first + step[low]).astype(np.int32)),
            pa.array((first + step[high]).astype(np.int32)),
        ],
        ["uid", "first", "last"],
    )


def repeated_ranges(
    rows: DataFrame, length: int = 200, gram: int = 64, hot_runs: int = 100_000
) -> DataFrame:
    """Ranges of repeated string starts: ``uid``, ``first``, ``last``."""
    shape = passages.Shape(length, gram)
    found = passages.candidates(rows, shape, across=False, hot_runs=hot_runs)
    twice = found.kinds.where("n > 1").select("anchor", "run")
    whole = found.kept.join(twice, ["anchor", "run"], "left_semi").select("uid", "first", "last")
    close = passages.by_anchor(
        passages.with_text(found.close, rows),
        lambda table: _sorted_block(table, length),
        "uid long, first int, last int",
    )
    single = passages.single_windows(passages.with_text(found.hot, rows), shape)
    several = (
        single.select("anchor", "run", "step", "window", "n")
        .groupBy("anchor", "window")
        .agg(F.count("*").alias("_count"))
        .where("_count > 1")
        .select("anchor", "window")
    )
    hot = (
        single.where("n = 1")
        .join(several, ["anchor", "window"], "left_semi")
        .select("uid", F.col("start").alias("first"), F.col("start").alias("last"))
    )
    return whole.unionByName(close).unionByName(hot)


def remove_repeats(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    length: int = 200,
    gram: int = 64,
    hot_runs: int = 100_000,
    with_kept: bool = False,
) -> DataFrame:
    """Per row: key, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256``.

    ``with_kept`` adds the remaining bytes, which need not be valid UTF-8.
    """
    rows = passages.numbered(df, key, text)
    marked = passages.with_ranges(rows, repeated_ranges(rows, length, gram, hot_runs))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in raw.blocks(batches, "text"):
            firsts, lasts = batch.column("firsts"), batch.column("lasts")
            removed, spans, digest, kept = [], [], [], []
            for i in range(batch.num_rows):
                own = data[offsets[i] : offsets[i + 1]]
                first = firsts[i].values.to_numpy()
                if len(first):
                    gone = passages.covered(first, lasts[i].values.to_numpy(), length, len(own))
                    spans.append(int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()))
                    removed.append(int(gone.sum()))
                    own = own[~gone]
                else:
                    spans.append(0)
                    removed.append(0)
                digest.append(hashlib.sha256(own.tobytes()).hexdigest())
                if with_kept:
                    kept.append(own.tobytes())
            columns = [
                batch.column("doc"),
                pa.array(np.diff(offsets)),
                pa.array(removed, pa.int64()),
                pa.array(spans, pa.int64()),
                pa.array(digest, pa.string()),
            ]
            names = ["doc", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            if with_kept:
                columns.append(pa.array(kept, pa.binary()))
                names.append("kept")
            yield pa.RecordBatch.from_arrays(columns, names)

    kind = df.schema[key].dataType.simpleString()
    schema = f"doc {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    if with_kept:
        schema += ", kept binary"
    return marked.mapInArrow(cut, schema).withColumnRenamed("doc", key)
