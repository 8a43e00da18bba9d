"""Passages that occur more than once: what byte and word deduplication share.

A window is a run of a fixed number of units, bytes or words. In each window the
run of ``gram`` units with the least hash is its anchor, so equal windows have
equal anchors wherever they stand. Successive windows of one anchor form a run,
the unit of all shuffles: about one row for each ``(window - gram) / 2`` units.

* Runs whose anchor stands alone have no equal window and are dropped.
* Equal runs are counted as a whole, with partial counts in every task.
* Only different runs of one anchor need a closer look, each of them once. Their
  text is cut out and brought together by anchor, in blocks of whole anchors.
* An anchor with more than ``hot_runs`` different runs would not fit into a block.
  Its windows are compared one by one as rows keyed by anchor and window hash,
  which spreads them over all tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from martflow.llm import bytes as raw
from martflow.llm.stored import stored

POSITION_BITS = 24
CHUNK_UNITS = 4 << 20
BLOCK_BYTES = 2 << 20


@dataclass(frozen=True)
class Shape:
    """Length of a window and of its anchor, in bytes or in words."""

    window: int
    gram: int
    words: bool = False


def unit_hashes(data: np.ndarray, offsets: np.ndarray, shape: Shape):
    """Prefix hashes of the units, begins of rows, and byte bounds of units."""
    if not shape.words:
        place = np.arange(len(data) + 1)
        return raw.byte_hashes(data), offsets, place[:-1], place[1:]
    starts, ends, begin = raw.words(data, offsets)
    hashes = raw.range_hashes(raw.byte_hashes(data), starts, ends)
    return raw.prefix_hashes(hashes), begin, starts, ends


def anchored_runs(sums: np.ndarray, begin: np.ndarray, shape: Shape):
    """First and last window start of each run, and the place of its anchor."""
    total = len(sums) - 1
    row_end = np.repeat(begin[1:], np.diff(begin))
    out = [np.zeros((3, 0), np.int64)]
    low = np.uint64((1 << POSITION_BITS) - 1)
    for at in range(0, total, CHUNK_UNITS):
        stop = min(total, at + CHUNK_UNITS + shape.window - 1)
        if stop - at < shape.window:
            break
        place = np.arange(at, stop - shape.gram + 1)
        value = raw.range_hashes(sums, place, place + shape.gram)
        value = (value & ~low) | (place - at).astype(np.uint64)
        least = raw.windowed_min(value, shape.window - shape.gram + 1)
        anchor = (least & low).astype(np.int64)
        start = np.flatnonzero(row_end[at : at + len(least)] >= at + np.arange(len(least)) + shape.window)
        if not len(start):
            continue
        own = anchor[start]
        new = np.ones(len(start), bool)
        new[1:] = (own[1:] != own[:-1]) | (start[1:] != start[:-1] + 1)
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(start)) - 1
        out.append(np.stack([start[first], start[last], own[first]]) + at)
    return np.concatenate(out, axis=1)


RUN_SCHEMA = (
    "anchor long, run long, uid long, doc long, first int, last int, lead int, at int, size int"
)


def numbered(df: DataFrame, key: str, text: str) -> DataFrame:
    """Key, text and a hash of both, by which rows are told apart.

    Rows that are equal in both share it, and have equal results.
    """
    return df.select(
        df[key].alias("doc"),
        F.coalesce(df[text], F.lit("")).alias("text"),
        F.xxhash64(df[key], df[text]).alias("uid"),
    )


def runs_of(rows: DataFrame, shape: Shape) -> DataFrame:
    """All runs of :func:`numbered` rows; offsets are within the row."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in raw.blocks(batches, "text"):
            sums, begin, starts, ends = unit_hashes(data, offsets, shape)
            first, last, anchor = anchored_runs(sums, begin, shape)
            row = np.searchsorted(begin, first, "right") - 1
            taken = pa.array(row)
            at, stop = starts[first], ends[last + shape.window - 1]
            numbers = [
                first - begin[row],
                last - begin[row],
                anchor - first,
                at - offsets[row],
                stop - at,
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(raw.range_hashes(sums, anchor, anchor + shape.gram).view(np.int64)),
                    pa.array(raw.range_hashes(sums, first, last + shape.window).view(np.int64)),
                    batch.column("uid").take(taken),
                    batch.column("doc").cast(pa.int64()).take(taken),
                    *[pa.array(n.astype(np.int32)) for n in numbers],
                ],
                ["anchor", "run", "uid", "doc", "first", "last", "lead", "at", "size"],
            )

    return rows.mapInArrow(scan, RUN_SCHEMA)


@dataclass
class Candidates:
    """Runs with a repeated anchor, their kinds, and the kinds to look at closely."""

    kept: DataFrame
    kinds: DataFrame
    close: DataFrame
    hot: DataFrame


def candidates(rows: DataFrame, shape: Shape, across: bool, hot_runs: int) -> Candidates:
    """Split the runs. With ``across`` only repeats in several keys count."""
    runs = runs_of(rows, shape)
    if across:
        runs = runs.where(F.col("doc").isNotNull())
        several = runs.groupBy("anchor").agg(F.min("doc").alias("low"), F.max("doc").alias("high"))
        several = several.where("low < high")
    else:
        several = runs.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1")
    # Joined as stored tables, so that Spark can split the runs of a hot anchor.
    several = stored(several.select("anchor"))
    kept = stored(runs.join(several, "anchor", "left_semi"))
    example = F.struct("doc", "uid", "first", "last", "lead", "at", "size")
    kinds = stored(
        kept.groupBy("anchor", "run")
        .agg(F.min(example).alias("own"), F.count("*").alias("n"))
        .select("anchor", "run", "n", "own.*")
    )
    per_anchor = kinds.groupBy("anchor").agg(F.count("*").alias("variety")).where("variety > 1")
    varied = kinds.join(stored(per_anchor), "anchor")
    return Candidates(
        kept,
        kinds,
        varied.where(F.col("variety") <= hot_runs).drop("variety"),
        varied.where(F.col("variety") > hot_runs).drop("variety"),
    )


def distinct_texts(rows: DataFrame) -> DataFrame:
    """``uid`` and ``text``, one row for all equal ones; every task reduces its own."""
    return rows.groupBy("uid").agg(F.first("text").alias("text"))


def with_text(runs: DataFrame, rows: DataFrame) -> DataFrame:
    """Add the bytes of each run, cut out of its row."""
    fields = [c for c in runs.columns if c != "uid"]
    listed = runs.groupBy("uid").agg(F.collect_list(F.struct(*fields)).alias("runs"))
    # Equal rows share a uid; one of them is enough.
    texts = distinct_texts(rows).join(listed, "uid")
    binary = F.col("text").cast("binary")
    cut = F.transform(
        "runs",
        lambda r: F.struct(
            *[r[c].alias(c) for c in fields],
            F.substr(binary, r["at"] + 1, r["size"]).alias("bytes"),
        ),
    )
    return texts.select("uid", F.inline(cut))


def anchor_blocks(
    batches: Iterator[pa.RecordBatch], size: int = BLOCK_BYTES
) -> Iterator[pa.Table]:
    """Tables of whole anchors, of about ``size`` bytes, from batches sorted by anchor."""
    held: list[pa.RecordBatch] = []
    weight = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        weight += batch.nbytes
        if weight < size:
            continue
        table = pa.Table.from_batches(held)
        anchors = table.column("anchor").to_numpy()
        cut = int(np.searchsorted(anchors, anchors[-1], "left"))
        if cut:
            yield from _pieces(table.slice(0, cut), anchors[:cut], size)
        rest = table.slice(cut).combine_chunks()
        held = rest.to_batches()
        weight = rest.nbytes if cut else 0
    if held:
        table = pa.Table.from_batches(held)
        yield from _pieces(table, table.column("anchor").to_numpy(), size)


def _pieces(table: pa.Table, anchors: np.ndarray, size: int) -> Iterator[pa.Table]:
    """Slices of whole anchors."""
    step = max(1, int(len(anchors) * size / max(table.nbytes, 1)))
    at = 0
    while at < len(anchors):
        last = min(at + step, len(anchors)) - 1
        stop = int(np.searchsorted(anchors, anchors[last], "right"))
        yield table.slice(at, stop - at)
        at = stop


def by_anchor(
    runs: DataFrame, look: Callable[[pa.Table], pa.RecordBatch], schema: str
) -> DataFrame:
    """Apply ``look`` to blocks of whole anchors."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in anchor_blocks(batches):
            yield look(table)

    return runs.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(scan, schema)


def single_windows(runs: DataFrame, shape: Shape) -> DataFrame:
    """Each window of some runs as a row: anchor, window hash, and its place."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in raw.blocks(batches, "bytes"):
            sums, begin, _, _ = unit_hashes(data, offsets, shape)
            count = np.maximum(np.diff(begin) - shape.window + 1, 0)
            row = np.repeat(np.arange(batch.num_rows), count)
            step = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
            start = begin[row] + step
            taken = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(c).take(taken) for c in ("anchor", "run", "uid", "doc", "n")],
                    pa.array(raw.range_hashes(sums, start, start + shape.window).view(np.int64)),
                    pa.array(step.astype(np.int32)),
                    pc_add(batch.column("first").take(taken), step),
                ],
                ["anchor", "run", "uid", "doc", "n", "window", "step", "start"],
            )

    schema = (
        "anchor long, run long, uid long, doc long, n long, window long, step int, start int"
    )
    return runs.mapInArrow(scan, schema)


def pc_add(column: pa.Array, more: np.ndarray) -> pa.Array:
    return pa.array((column.to_numpy() + more).astype(np.int32))


def covered(first: np.ndarray, last: np.ndarray, window: int, total: int) -> np.ndarray:
    """Which of ``total`` units lie in the windows of some ranges of starts."""
    change = np.zeros(total + 1, np.int64)
    np.add.at(change, first, 1)
    np.add.at(change, last + window, -1)
    return np.cumsum(change[:-1]) > 0


def with_ranges(rows: DataFrame, ranges: DataFrame) -> DataFrame:
    """Add the ranges of window starts of each row: lists ``firsts`` and ``lasts``.

    A list is bounded by the length of its own text: equal rows, which share a uid,
    have the same ranges, and every task keeps each of them once.
    """
    listed = ranges.groupBy("uid").agg(
        F.collect_set(F.struct("first", "last")).alias("ranges")
    )
    # Joined as a stored table, so that Spark can split many equal rows.
    joined = rows.join(stored(listed), "uid", "left")
    return joined.select(
        "doc",
        "text",
        F.coalesce("ranges.first", F.array().cast("array<int>")).alias("firsts"),
        F.coalesce("ranges.last", F.array().cast("array<int>")).alias("lasts"),
    )
