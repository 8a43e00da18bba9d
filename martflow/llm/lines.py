"""Line deduplication by range partitions of hashes.

Each line that is long enough is a row of a hash, its document and its position.
The rows are dealt into ranges by (hash, document, position), so that a line with a
third of all rows is spread over many ranges, and each range is sorted. A task then
streams its range: the first document of a hash, the one of largest key, keeps its
lines; from the fifth document on all others are known to lose theirs. Only the
first hash of a range, and the last one if it is still below the limit, depend on
the neighbours. Their rows stay open, and two short rows for each range settle them.

The outcome is a compressed bitmap of the kept lines for each document that loses
any. Texts take no part until :func:`apply_bitmaps` cuts them.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from martflow.llm.stored import stored

MIN_CHARS = 40
MIN_DOCS = 5

# The white space around a line, and the letters that change case.
SPACES = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

DROPPED, OPEN, EDGE = 0, 1, 2
DECIDED = "kind byte, hash binary, doc long, uid long, at int, docs long, high long, low long"
NAMES = [field.split()[0] for field in DECIDED.split(", ")]
TYPES = [pa.int8(), pa.binary(), pa.int64(), pa.int64(), pa.int32(), *[pa.int64()] * 3]


def line_keys(line: Column) -> Column:
    """What is compared of a line: no white space around it, A to Z in lower case."""
    return F.translate(F.btrim(line, F.lit(SPACES)), UPPER, UPPER.lower())


def line_rows(docs: DataFrame, key: str, text: str, min_chars: int) -> DataFrame:
    """``hash, doc, uid, at`` of all lines that can be dropped; texts stay behind.

    Rows without a key take no part. Rows equal in key and text share a ``uid``.
    """
    own = docs.where(docs[key].isNotNull()).select(
        docs[key].cast("long").alias("doc"),
        F.xxhash64(docs[text]).alias("uid"),
        F.coalesce(docs[text], F.lit("")).alias("text"),
    )
    lines = own.select("doc", "uid", F.posexplode(F.split("text", "\n", -1)).alias("at", "line"))
    named = lines.select("doc", "uid", "at", line_keys(F.col("line")).alias("name"))
    long_enough = named.where(F.char_length("name") >= min_chars)
    return long_enough.select(F.unhex(F.md5("name")).alias("hash"), "doc", "uid", "at")


class _Range:
    """The stream of one sorted range: what is decided, and what stays open."""

    def __init__(self, least: int):
        self.least = least
        self.first: bytes | None = None  # the hash the range begins with
        self.hash: bytes | None = None  # the hash the rows so far end with
        self.docs = 0  # its documents among rows that were passed on
        self.high = self.low = 0  # its first and last document
        self.held: list[pa.Table] = []  # its rows, as long as they are below the limit

    def take(self, table: pa.Table) -> Iterator[pa.RecordBatch]:
        if not table.num_rows:
            return
        table = pa.concat_tables([*self.held, table]).combine_chunks()
        names = np.frombuffer(b"".join(table.column("hash").to_pylist()), np.uint8).reshape(-1, 16)
        doc = table.column("doc").to_numpy()
        begins = np.ones(len(doc), bool)
        begins[1:] = (names[1:] != names[:-1]).any(axis=1)
        fresh = begins.copy()
        fresh[1:] |= doc[1:] != doc[:-1]
        starts = np.flatnonzero(begins)
        group = np.cumsum(begins) - 1
        counted = np.cumsum(fresh)
        rank = counted - counted[starts][group] + 1

        top, bottom = names[0].tobytes(), names[-1].tobytes()
        self.first = self.first or top
        goes_on = self.docs > 0 and top == self.hash
        if goes_on:
            rank[group == 0] += self.docs - int(doc[0] == self.low)
        elif self.docs > 0 and self.hash == self.first:
            yield self._edge()
        count = rank[np.append(starts[1:], len(doc)) - 1]
        is_first = (group == 0) & (top == self.first)
        known = (count >= self.least)[group] & ~is_first
        waits = (group == len(starts) - 1) & ~known & ~is_first

        for rows, kind in ((known & (rank > 1), DROPPED), (is_first, OPEN)):
            if rows.any():
                yield _rows(table.filter(pa.array(rows)), kind)
        if is_first[0]:
            self.high = self.high if goes_on else int(doc[0])
            last = np.flatnonzero(is_first)[-1]
            self.hash, self.docs, self.low = top, int(count[0]), int(doc[last])
            if len(starts) > 1:
                yield self._edge()
        if bottom != self.first:
            same = goes_on and len(starts) == 1
            self.high = self.high if same else int(doc[starts[-1]])
            self.hash, self.low = bottom, int(doc[-1])
            self.docs = 0 if waits.any() else int(count[-1])
        self.held = [table.filter(pa.array(waits))] if waits.any() else []

    def end(self) -> Iterator[pa.RecordBatch]:
        """The last hash may go on in the next range."""
        for table in self.held:
            doc = table.column("doc").to_numpy()
            self.docs, self.high, self.low = len(np.unique(doc)), int(doc[0]), int(doc[-1])
            yield _rows(table, OPEN)
        if self.hash is not None:
            yield self._edge()

    def _edge(self) -> pa.RecordBatch:
        values = [EDGE, self.hash, None, None, None, self.docs, self.high, self.low]
        arrays = [pa.array([v], t) for v, t in zip(values, TYPES, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, NAMES)


def _rows(table: pa.Table, kind: int) -> pa.RecordBatch:
    none = pa.nulls(table.num_rows, pa.int64())
    columns = [table.column(c).combine_chunks() for c in ("hash", "doc", "uid", "at")]
    kinds = pa.array(np.full(table.num_rows, kind, np.int8))
    return pa.RecordBatch.from_arrays([kinds, *columns, none, none, none], NAMES)


def streamed(rows: DataFrame, min_docs: int) -> DataFrame:
    """Dropped and open rows of all ranges, and a summary of the hashes at their edges."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = _Range(min_docs)
        for batch in batches:
            yield from state.take(pa.Table.from_batches([batch]))
        yield from state.end()

    order = [F.col("hash"), F.col("doc").desc(), F.col("uid"), F.col("at")]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return dealt.mapInArrow(scan, DECIDED)


def dropped_lines(docs: DataFrame, key: str, text: str, min_chars: int, min_docs: int) -> DataFrame:
    """``doc, uid, at`` of each line that goes."""
    decided = stored(streamed(line_rows(docs, key, text, min_chars), min_docs))
    # A document whose lines reach over a border is counted on both sides of it.
    order = Window.partitionBy("hash").orderBy(F.col("high").desc(), F.col("low").desc())
    shared = F.coalesce((F.lag("low").over(order) == F.col("high")).cast("long"), F.lit(0))
    edges = (
        decided.where(F.col("kind") == EDGE)
        .select("hash", "high", (F.col("docs") - shared).alias("docs"))
        .groupBy("hash")
        .agg(F.max("high").alias("keeper"), F.sum("docs").alias("docs"))
        .where(F.col("docs") >= min_docs)
    )
    # At most two rows for each range, and there are as many ranges as tasks.
    settled = (
        decided.where(F.col("kind") == OPEN)
        .join(F.broadcast(edges.drop("docs")), "hash")
        .where("doc < keeper")
    )
    own = ["doc", "uid", "at"]
    return decided.where(F.col("kind") == DROPPED).select(*own).unionByName(settled.select(*own))


def packed_bitmap(gone: np.ndarray) -> bytes:
    """Compressed bits of the lines up to the last dropped one: 1 for a kept line."""
    bits = np.ones(-(-(int(gone.max()) + 1) // 8) * 8, np.uint8)
    bits[gone] = 0
    return zlib.compress(np.packbits(bits).tobytes())


def kept_lines(bitmap: bytes | None, count: int) -> np.ndarray:
    """Which of ``count`` lines a bitmap keeps; those beyond its end are kept."""
    kept = np.ones(count, bool)
    if bitmap is not None:
        bits = np.unpackbits(np.frombuffer(zlib.decompress(bitmap), np.uint8))[:count]
        kept[: len(bits)] = bits
    return kept


def keep_bitmaps(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    min_chars: int = MIN_CHARS,
    min_docs: int = MIN_DOCS,
) -> DataFrame:
    """``doc, uid, n_dropped, keep``: a bitmap for each document that loses lines.

    A line goes if at least ``min_docs`` documents hold it, equal but for white space
    around it and the case of A to Z, and it has ``min_chars`` code points or more.
    The document of largest key keeps it, wherever and however often it stands there.

    Rows of one key are one document. Rows without a key take no part: they neither
    count nor lose a line. A null text is an empty one, that is one empty line. Equal
    rows share a ``uid``, a hash of the text, and so a bitmap. Memory is bounded by
    the lines of one text; an empty table gives an empty one. Other columns, of
    whatever name, are ignored.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            gone = [np.asarray(v.values) for v in batch.column("gone")]
            count = pa.array([len(g) for g in gone], pa.int64())
            maps = pa.array([packed_bitmap(g) for g in gone], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), batch.column("uid"), count, maps],
                ["doc", "uid", "n_dropped", "keep"],
            )

    lines = dropped_lines(docs, key, text, min_chars, min_docs)
    # The list is bounded by the lines of its own text: equal rows have equal lines.
    listed = lines.groupBy("doc", "uid").agg(F.collect_set("at").alias("gone"))
    return listed.mapInArrow(scan, "doc long, uid long, n_dropped long, keep binary")


def _cut(text: str, bitmap: bytes | None) -> str:
    if bitmap is None:
        return text
    lines = text.split("\n")
    kept = kept_lines(bitmap, len(lines))
    return "\n".join(line for line, stays in zip(lines, kept, strict=True) if stays)


def apply_bitmaps(
    docs: DataFrame, bitmaps: DataFrame, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``row``, the columns of ``docs`` as a struct, ``n_dropped``, and ``kept``, the text left.

    A document all of whose lines go is left with an empty text, and a null text
    stays null.
    """

    @F.pandas_udf("string")
    def cut(texts: pd.Series, maps: pd.Series) -> pd.Series:
        return pd.Series([_cut(t, m) for t, m in zip(texts, maps, strict=True)], dtype=object)

    rows = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("row"),
        docs[key].cast("long").alias("doc"),
        F.xxhash64(docs[text]).alias("uid"),
    )
    # Joined as a stored table, so that Spark can split many equal rows.
    joined = rows.join(stored(bitmaps), ["doc", "uid"], "left")
    whole = F.col("row")[text]
    return joined.select(
        "row",
        F.coalesce("n_dropped", F.lit(0)).alias("n_dropped"),
        F.when(F.col("keep").isNull(), whole).otherwise(cut(whole, "keep")).alias("kept"),
    )


def drop_lines(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    min_chars: int = MIN_CHARS,
    min_docs: int = MIN_DOCS,
) -> DataFrame:
    """The documents without the lines that :func:`keep_bitmaps` drops, in all columns."""
    bitmaps = keep_bitmaps(docs, key, text, min_chars, min_docs)
    left = apply_bitmaps(docs, bitmaps, key, text)
    return left.select(
        *[F.col("kept" if c == text else f"row.`{c}`").alias(c) for c in docs.columns]
    )
