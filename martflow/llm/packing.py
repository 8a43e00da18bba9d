"""Packing of tokenized documents into sequences by cutting stock.

Documents become pieces of at most one sequence: full ones, and a rest. Piece
lengths, in units of ``step`` tokens, are the orders of a cutting-stock problem.
Its linear program is solved by column generation: a knapsack over the dual
prices finds each new pattern. Only the histogram of lengths, whose size is
bounded by ``capacity / step``, reaches the driver. Rounded patterns are then
handed to the pieces by their rank within a length, as joins and windows.

Null texts count as empty and give one piece with the closing id. Repeated rows
are packed each. An empty table gives an empty result.
"""

from __future__ import annotations

import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from martflow.llm import bytes as raw
from martflow.llm.stored import stored

# Entries of a task's word cache; beyond it the cache starts anew.
CACHE_UNITS = 1_000_000

_CODES = np.arange(128)
_ALNUM = np.zeros(256, bool)
_ALNUM[[c for c in _CODES if chr(c).isalnum()]] = True
_PUNCT = np.zeros(256, bool)
_PUNCT[[c for c in range(33, 127) if not chr(c).isalnum()]] = True
_QUOTE = ord("'")


def _with(places: np.ndarray, cuts: np.ndarray, size: int) -> np.ndarray:
    """The places, and those after a cut, in order and each once."""
    member = np.zeros(size + 1, bool)
    member[places] = True
    member[1 : len(cuts) + 1] |= cuts
    return np.flatnonzero(member)


class UnitTokenizer:
    """Token ids of many texts, each distinct unit of text encoded once.

    The tokenizer drops white space, ignores case and never joins ASCII letters
    or digits with ASCII marks, so a text's ids are those of its units in order.
    A quote may join what follows. Texts with a special token are encoded whole.
    Units are told apart by 64-bit hashes.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.closes = np.zeros(max(vocabulary.values()) + 1, bool)
        self.closes[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.special = [token.content.encode() for token in added]
        self.clear()

    def clear(self) -> None:
        self.known: dict[int, int] = {}
        self.ids = np.zeros(0, np.uint32)
        self.ends = np.zeros(1, np.int64)

    def _encoded(self, units: list[str]) -> list[np.ndarray]:
        """Ids of each unit; one-word units are encoded together."""
        out: list = [None] * len(units)
        simple = [
            i
            for i, unit in enumerate(units)
            if unit.isalpha()
            and (unit.isascii() or unicodedata.normalize("NFC", unit).lower().isalpha())
        ]
        for at in range(0, len(simple), 1000):
            some = simple[at : at + 1000]
            text = " ".join(units[i] for i in some)
            ids = np.array(self._encode([text])[0].ids, np.uint32)
            ends = np.flatnonzero(self.closes[ids]) + 1
            if len(ends) == len(some):
                begins = [0, *ends.tolist()]
                for i, begin, end in zip(some, begins, begins[1:], strict=False):
                    out[i] = ids[begin:end]
        rest = [i for i, own in enumerate(out) if own is None]
        for i, found in zip(rest, self._encode([units[i] for i in rest]), strict=True):
            out[i] = np.array(found.ids, np.uint32)
        return out

    def _encode(self, texts: list[str]):
        return self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)

    def _learn(self, hashes: np.ndarray, units: list[str]) -> None:
        found = self._encoded(units)
        first = len(self.ends) - 1
        self.known.update(zip(hashes.tolist(), range(first, first + len(units)), strict=True))
        self.ids = np.concatenate([self.ids, *found])
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(sizes)])

    def block(self, data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
        """Ids of each row of a block."""
        rows = len(offsets) - 1
        whole = set()
        text = data.tobytes()
        for token in self.special:
            at = text.find(token)
            while at >= 0:
                whole.add(int(np.searchsorted(offsets, at, "right")) - 1)
                at = text.find(token, at + 1)
        data = raw.lower_ascii(data)
        starts, ends, _ = raw.words(data, offsets)
        alnum, punct, free = _ALNUM[data], _PUNCT[data], data != _QUOTE
        cuts = (alnum[:-1] & punct[1:]) | (punct[:-1] & free[:-1] & alnum[1:])
        starts, ends = _with(starts, cuts, len(data)), _with(ends, cuts, len(data))
        hashes = raw.word_hashes(data, starts, ends)
        distinct, first, place = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.known) + len(distinct) > CACHE_UNITS:
            self.clear()
        index = np.array([self.known.get(h, -1) for h in distinct.tolist()], np.int64)
        new = np.flatnonzero(index < 0)
        if len(new):
            low = data.tobytes()
            bounds = zip(starts[first[new]].tolist(), ends[first[new]].tolist(), strict=True)
            units = [low[s:e].decode("utf-8", "replace") for s, e in bounds]
            index[new] = len(self.ends) - 1 + np.arange(len(new))
            self._learn(distinct[new], units)
        unit = index[place]
        sizes = self.ends[unit + 1] - self.ends[unit]
        stops = np.cumsum(sizes)
        total = int(stops[-1]) if len(stops) else 0
        where = np.arange(total) + np.repeat(self.ends[unit] - (stops - sizes), sizes)
        ids = self.ids[where]
        # tokens before each document's first unit
        before = np.concatenate([[0], stops])[np.searchsorted(starts, offsets)]
        out = [ids[before[i] : before[i + 1]] for i in range(rows)]
        for i in whole:
            own = text[offsets[i] : offsets[i + 1]].decode("utf-8", "replace")
            out[i] = np.array(self._encode([own])[0].ids, np.uint32)
        return out


_tokenizers: dict[str, UnitTokenizer] = {}


def _tokenizer(path: str) -> UnitTokenizer:
    """One tokenizer for each worker process, kept between tasks."""
    if path not in _tokenizers:
        _tokenizers[path] = UnitTokenizer(path)
    return _tokenizers[path]


def token_pieces(
    df: DataFrame,
    tokenizer: str,
    key: str = "doc_id",
    text: str = "text",
    capacity: int = 4096,
    end_id: int = 2,
    with_ids: bool = False,
) -> DataFrame:
    """Pieces of at most ``capacity`` ids: ``start``, ``length``, ``ids_crc32``.

    ``doc_tokens`` counts the ids of the whole document, the closing id included.
    ``with_ids`` adds the ids themselves.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = _tokenizer(tokenizer)
        for batch, data, offsets in raw.blocks(batches, "_text"):
            row, start, length, crc, total, held = [], [], [], [], [], []
            for i, ids in enumerate(tokens.block(data, offsets)):
                ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                for at in range(0, len(ids), capacity):
                    piece = ids[at : at + capacity]
                    row.append(i)
                    start.append(at)
                    length.append(len(piece))
                    crc.append(zlib.crc32(piece.tobytes()))
                    total.append(len(ids))
                    if with_ids:
                        held.append(piece.astype(np.int32))
            columns = [batch.column("_key").take(pa.array(row))]
            columns += [pa.array(x, pa.int64()) for x in (start, length, crc, total)]
            names = ["_key", "start", "length", "ids_crc32", "doc_tokens"]
            if with_ids:
                columns.append(pa.array(held, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)

    kind = df.schema[key].dataType.simpleString()
    schema = f"_key {kind}, start long, length long, ids_crc32 long, doc_tokens long"
    if with_ids:
        schema += ", ids array<int>"
    taken = df.select(df[key].alias("_key"), df[text].alias("_text"))
    return taken.mapInArrow(cut, schema).withColumnRenamed("_key", key)


def _best_pattern(prices: np.ndarray, sizes: np.ndarray, capacity: int) -> np.ndarray:
    """The pattern of highest total price that fits (an unbounded knapsack)."""
    best = np.zeros(capacity + 1)
    choice = np.full(capacity + 1, -1)
    for room in range(1, capacity + 1):
        best[room] = best[room - 1]
        fits = np.searchsorted(sizes, room, "right")
        if fits:
            values = prices[:fits] + best[room - sizes[:fits]]
            i = int(np.argmax(values))
            if values[i] > best[room] + 1e-12:
                best[room], choice[room] = values[i], i
    pattern = np.zeros(len(sizes))
    room = capacity
    while room > 0:
        if choice[room] < 0:
            room -= 1
        else:
            pattern[choice[room]] += 1
            room -= sizes[choice[room]]
    return pattern


def solve_patterns(
    sizes: np.ndarray, demand: np.ndarray, capacity: int, gap: float = 1e-4, rounds: int = 4000
) -> list[tuple[np.ndarray, int]]:
    """Patterns and how often each is used, covering the demand of every size.

    The simplex method keeps one pattern for each size. It stops when the
    knapsack bound proves the plan within ``gap`` of the best, or after
    ``rounds`` patterns; a plan is valid at any time, only less tight.
    """
    order = np.argsort(sizes)
    sizes, demand = np.asarray(sizes)[order], np.asarray(demand)[order]
    count = len(sizes)
    if not count:
        return []
    patterns = np.diag((capacity // sizes).astype(float))
    inverse = np.diag(1.0 / np.diag(patterns))
    used = inverse @ demand
    for _ in range(rounds):
        prices = np.maximum(inverse.sum(axis=0), 0)
        pattern = _best_pattern(prices, sizes, capacity)
        worth = float(prices @ pattern)
        if worth <= 1 + 1e-9 or used.sum() <= (prices @ demand) / worth * (1 + gap):
            break
        step = inverse @ pattern
        ratio = np.where(step > 1e-9, used / np.where(step > 1e-9, step, 1), np.inf)
        leaving = int(np.argmin(ratio))
        if not np.isfinite(ratio[leaving]):
            break
        patterns[:, leaving] = pattern
        amount = ratio[leaving]
        used = np.maximum(used - amount * step, 0)
        used[leaving] = amount
        inverse[leaving] /= step[leaving]
        others = np.arange(count) != leaving
        inverse[others] -= np.outer(step[others], inverse[leaving])
    whole = np.floor(used + 1e-9).astype(int)
    plan = [(patterns[:, j].astype(int), int(n)) for j, n in enumerate(whole) if n]
    covered = patterns.astype(int) @ whole
    rest = np.maximum(np.asarray(demand) - covered, 0).astype(int)
    plan += [(pattern, 1) for pattern in _first_fit(sizes, rest, capacity)]
    back = np.argsort(order)
    return [(pattern[back], n) for pattern, n in plan]


def _first_fit(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> list[np.ndarray]:
    """Patterns for what rounding down left over, longest sizes first."""
    left, room = demand.copy(), 0
    out: list[np.ndarray] = []
    while left.any():
        pattern, room = np.zeros(len(sizes), int), capacity
        for i in range(len(sizes) - 1, -1, -1):
            take = min(left[i], room // sizes[i])
            pattern[i] = take
            room -= take * sizes[i]
        left -= pattern
        out.append(pattern)
    return out


def assign_sequences(
    pieces: DataFrame, key: str = "doc_id", capacity: int = 4096, step: int = 8
) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to stored pieces.

    ``pieces`` is read several times, so it should be a stored table. Ranks
    within a length are counted within slices of it, whose sizes are added up
    first; no task holds a whole length.
    """
    spark = pieces.sparkSession
    slices = max(64, int(spark.conf.get("spark.sql.shuffle.partitions")))
    sized = pieces.withColumn("_size", F.ceil(F.col("length") / step).cast("int")).withColumn(
        "_slice", F.pmod(F.xxhash64(key, "start"), F.lit(slices)).cast("int")
    )
    counts = stored(sized.groupBy("_size", "_slice").agg(F.count("*").alias("_n")))
    histogram = counts.groupBy("_size").agg(F.sum("_n").alias("n")).collect()
    sizes = np.array([r["_size"] for r in histogram], int)
    demand = np.array([r["n"] for r in histogram], int)
    plan = solve_patterns(sizes, demand, capacity // step)

    slots, first_sequence = [], 0
    taken = np.zeros(len(sizes), int)
    for pattern, uses in plan:
        for i in np.flatnonzero(pattern):
            per = int(pattern[i])
            low, high = int(taken[i]), int(taken[i]) + per * uses
            slots.append((int(sizes[i]), low, high, per, first_sequence))
            taken[i] = high
        first_sequence += uses
    # At most one row for each size and pattern, whatever the input: a bounded table.
    places = spark.createDataFrame(
        slots, "_size int, _low long, _high long, _per long, _first long"
    )
    earlier = Window.partitionBy("_size").orderBy("_slice").rowsBetween(
        Window.unboundedPreceding, -1
    )
    bases = counts.select(
        "_size", "_slice", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_base")
    )
    within = Window.partitionBy("_size", "_slice").orderBy(key, "start")
    ranked = (
        sized.withColumn("_rank", F.row_number().over(within) - 1)
        .join(bases, ["_size", "_slice"])
        .withColumn("_rank", F.col("_rank") + F.col("_base"))
    )
    inside = (F.col("_rank") >= F.col("_low")) & (F.col("_rank") < F.col("_high"))
    placed = ranked.join(
        F.broadcast(places.withColumnRenamed("_size", "_its")),
        (F.col("_size") == F.col("_its")) & inside,
    ).withColumn(
        "sequence_id",
        F.col("_first") + F.floor((F.col("_rank") - F.col("_low")) / F.col("_per")),
    )
    # A sequence holds at most ``capacity`` pieces.
    ahead = (
        Window.partitionBy("sequence_id")
        .orderBy(F.desc("length"), key, "start")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offset = F.coalesce(F.sum("length").over(ahead), F.lit(0)).alias("offset")
    return placed.select(*pieces.columns, "sequence_id", offset)


def pack_documents(
    df: DataFrame,
    tokenizer: str,
    key: str = "doc_id",
    text: str = "text",
    capacity: int = 4096,
    end_id: int = 2,
    with_ids: bool = False,
) -> DataFrame:
    """Pieces of all documents with their sequence and place in it."""
    pieces = stored(token_pieces(df, tokenizer, key, text, capacity, end_id, with_ids))
    return assign_sequences(pieces, key, capacity)
