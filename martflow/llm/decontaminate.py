"""Benchmark decontamination with spaced-seed hashes.

Tokens are runs of letters, digits and bytes beyond ASCII, A to Z in lower case.
In scripts without spaces, such as Chinese, Japanese and Thai, each character is
a token, and their punctuation parts tokens.
A document leaks an item if some window of ``WINDOW`` successive item tokens
(the whole item, if it is shorter) lies in it with at most a fifth of the tokens
substituted. Items of fewer than ``SHORTEST`` tokens are not reported, unless
``short_items`` is set: then a document leaks them if it holds them word for word.

A seed hashes the tokens that a mask selects and ignores those in its gaps. The
two masks hit every window that may be reported, wherever its substitutions are
(a test tries them all), so no leak is lost. Seeds of documents are matched with
those of the items, and each hit is verified token by token around it.

The items are taken in blocks of at most ``block_bytes`` of text, whose number
follows from their total size: each block is a broadcast of bounded size and one
more pass over the documents. Null texts count as empty and leak nothing.
Repeated documents are judged each; repeated items are reported once. Empty
tables, of documents or items, give no leaks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from martflow.llm import bytes as raw

# Positions that each mask reads.
MASKS = ((0, 2, 3, 4), (0, 1, 4, 7))
WINDOW = 13
SHORTEST = 8
TOLERATED = 0.2
FILTER_BITS = 22
PAIRS_AT_ONCE = 200_000

_MEMBER = np.array([chr(c).isalnum() if c < 128 else True for c in range(256)])
# Code points whose characters are tokens each: first ones and those after the last.
_SPACELESS = (
    (0x0E00, 0x0F00),  # Thai, Lao
    (0x1000, 0x10A0),  # Burmese
    (0x1780, 0x1800),  # Khmer
    (0x3005, 0x3008),
    (0x3021, 0x302A),
    (0x3040, 0x30FB),  # kana
    (0x30FC, 0x3100),
    (0x31F0, 0x3200),
    (0x3400, 0x4DC0),  # ideographs
    (0x4E00, 0xA000),
    (0xF900, 0xFB00),
    (0xFF66, 0xFFA0),
    (0x20000, 0x40000),
)
# Their punctuation, once letters and digits of full width are left out.
_PARTING = (
    (0x104A, 0x1050),
    (0x17D4, 0x17D7),
    (0x3000, 0x3005),
    (0x3008, 0x3021),
    (0x3030, 0x3031),
    (0x30FB, 0x30FC),
    (0xFE30, 0xFE50),
    (0xFF01, 0xFF10),
    (0xFF1A, 0xFF21),
    (0xFF3B, 0xFF41),
    (0xFF5B, 0xFF66),
)


def _within(codes: np.ndarray, ranges: tuple[tuple[int, int], ...]) -> np.ndarray:
    return np.searchsorted(np.array(ranges).ravel(), codes, "right") % 2 == 1


def _characters(data: np.ndarray):
    """Starts, lengths and code points of characters of three bytes and more."""
    start = np.flatnonzero(data >= 0xE0)
    longer = np.concatenate([data, np.zeros(3, np.uint8)])
    lead, *rest = (longer[start + i].astype(np.int64) for i in range(4))
    one, two, three = (r & 63 for r in rest)
    wide = lead >= 0xF0
    code = np.where(
        wide,
        (lead & 7) << 18 | one << 12 | two << 6 | three,
        (lead & 15) << 12 | one << 6 | two,
    )
    return start, np.where(wide, 4, 3), code


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens, and where those of each row begin."""
    data = raw.lower_ascii(data)
    member = _MEMBER[data]
    place, length, code = _characters(data)
    parting, alone = _within(code, _PARTING), _within(code, _SPACELESS)
    for step in range(4):
        at = place[parting & (length > step)] + step
        member[at[at < len(member)]] = False
    starts, ends = raw.runs(member, offsets)
    if alone.any() and len(starts):
        cuts = np.unique(np.concatenate([place[alone], (place + length)[alone]]))
        own = np.searchsorted(starts, cuts, "left") - 1
        cuts = cuts[(own >= 0) & (cuts < ends[own])]
        starts, ends = np.union1d(starts, cuts), np.union1d(ends, cuts)
    hashes = raw.word_hashes(data, starts, ends)
    return hashes, np.searchsorted(starts, offsets)


def seeds(hashes: np.ndarray, begin: np.ndarray, number: int) -> tuple[np.ndarray, np.ndarray]:
    """Seeds of one mask at every token where it fits into the row."""
    mask = MASKS[number]
    count = len(hashes) - mask[-1]
    if count <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    out = np.full(count, number + 1, np.uint64)
    for place in mask:
        out = out * np.uint64(0xD6E8FEB86659FD93) + hashes[place : place + count]
    row_end = np.repeat(begin[1:], np.diff(begin))[:count]
    fits = np.flatnonzero(np.arange(count) + mask[-1] < row_end)
    return raw.mix(out[fits]), fits


def sequences(hashes: np.ndarray, begin: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` tokens within a row, and where they start."""
    count = max(len(hashes) - size + 1, 0)
    out = np.full(count, size, np.uint64)
    for place in range(size):
        out = out * np.uint64(0xD6E8FEB86659FD93) + hashes[place : place + count]
    row_end = np.repeat(begin[1:], np.diff(begin))[:count]
    fits = np.flatnonzero(np.arange(count) + size <= row_end)
    return raw.mix(out[fits]), fits


class ItemBlock:
    """Tokens and sorted seeds of some items."""

    def __init__(self, texts: list[str], short_items: bool = False):
        data, offsets = raw.utf8(pa.array(texts, pa.large_string()))
        self.hashes, self.begin = tokens(data, offsets)
        size = np.diff(self.begin)
        owner = np.repeat(np.arange(len(texts)), size)
        self.window = np.minimum(size, WINDOW)
        self.needed = self.window - (self.window * TOLERATED + 1e-9).astype(int)
        found, places, masks = [], [], []
        for number in range(len(MASKS)):
            seed, place = seeds(self.hashes, self.begin, number)
            long = size[owner[place]] >= SHORTEST
            found.append(seed[long])
            places.append(place[long])
            masks.append(np.full(long.sum(), number))
        seed = np.concatenate(found)
        order = np.argsort(seed, kind="stable")
        self.seeds = seed[order]
        self.places = np.concatenate(places)[order]
        self.masks = np.concatenate(masks)[order]
        self.owner = owner
        # Hashes of short items by number of tokens, and the items.
        self.short: list[tuple[int, np.ndarray, np.ndarray]] = []
        for tokens_ in range(1, SHORTEST) if short_items else ():
            items = np.flatnonzero(size == tokens_)
            if len(items):
                code, place = sequences(self.hashes, self.begin, tokens_)
                code = code[np.searchsorted(place, self.begin[items])]
                by_code = np.argsort(code, kind="stable")
                self.short.append((tokens_, code[by_code], items[by_code]))
        self.filter = np.zeros(1 << FILTER_BITS, bool)
        self.filter[self.seeds >> np.uint64(64 - FILTER_BITS)] = True

    def leaks(self, hashes: np.ndarray, begin: np.ndarray):
        """Rows, items, matching tokens, and first document token of each leak."""
        rows = [np.zeros((4, 0), np.int64)]
        row_of = np.repeat(np.arange(len(begin) - 1), np.diff(begin))
        for number in range(len(MASKS)):
            seed, place = seeds(hashes, begin, number)
            maybe = np.flatnonzero(self.filter[seed >> np.uint64(64 - FILTER_BITS)])
            seed, place = seed[maybe], place[maybe]
            low = np.searchsorted(self.seeds, seed, "left")
            size = np.searchsorted(self.seeds, seed, "right") - low
            ends = np.cumsum(size)
            total = int(ends[-1]) if len(ends) else 0
            for at in range(0, total, PAIRS_AT_ONCE):
                pair = np.arange(at, min(at + PAIRS_AT_ONCE, total))
                hit = np.searchsorted(ends, pair, "right")
                entry = low[hit] + pair - (ends[hit] - size[hit])
                rows.append(self._verified(hashes, begin, row_of, place[hit], entry))
        for size, codes, items in self.short:
            rows.append(self._whole(hashes, begin, row_of, size, codes, items))
        row, item, same, first = np.concatenate(rows, axis=1)
        order = np.lexsort((first, -same, item, row))
        row, item, same, first = row[order], item[order], same[order], first[order]
        new = np.ones(len(row), bool)
        new[1:] = (row[1:] != row[:-1]) | (item[1:] != item[:-1])
        return row[new], item[new], same[new], first[new]

    def _whole(self, hashes, begin, row_of, size, codes, items):
        """The first occurrence of each short item in each row."""
        code, place = sequences(hashes, begin, size)
        low = np.searchsorted(codes, code, "left")
        known = np.flatnonzero(codes[np.minimum(low, len(codes) - 1)] == code)
        low, place = low[known], place[known]
        # by row and text of an item, the first place
        _, first = np.unique(row_of[place] * len(codes) + low, return_index=True)
        low, place = low[first], place[first]
        count = np.searchsorted(codes, codes[low], "right") - low
        hit = np.repeat(np.arange(len(low)), count)
        step = np.arange(len(hit)) - np.repeat(np.cumsum(count) - count, count)
        row = row_of[place[hit]]
        return np.stack([row, items[low[hit] + step], np.full(len(hit), size), place[hit] - begin[row]])

    def _verified(self, hashes, begin, row_of, place, entry):
        """The best window around each hit, if it is good enough."""
        spot = self.places[entry]
        item = self.owner[spot]
        row = row_of[place]
        span = np.array([m[-1] + 1 for m in MASKS])[self.masks[entry]]
        width = self.window[item]
        shift = np.arange(-WINDOW + 1, 2 * WINDOW)
        theirs = spot[:, None] + shift
        ours = place[:, None] + shift
        inside = (theirs >= self.begin[item][:, None]) & (theirs < self.begin[item + 1][:, None])
        here = (ours >= begin[row][:, None]) & (ours < begin[row + 1][:, None])
        theirs = np.clip(theirs, 0, max(len(self.hashes) - 1, 0))
        ours = np.clip(ours, 0, max(len(hashes) - 1, 0))
        equal = inside & here & (self.hashes[theirs] == hashes[ours])
        sums = np.zeros((len(place), len(shift) + 1), np.int64)
        np.cumsum(equal, axis=1, out=sums[:, 1:])
        # windows that hold the whole seed and stay within the item
        begins = np.arange(WINDOW)
        low, high = np.maximum(0, WINDOW - 1 + span - width), np.full(len(place), WINDOW - 1)
        low = np.maximum(low, self.begin[item] - spot + WINDOW - 1)
        high = np.minimum(high, self.begin[item + 1] - width - spot + WINDOW - 1)
        allowed = (begins >= low[:, None]) & (begins <= high[:, None])
        stops = np.minimum(begins + width[:, None], len(shift))
        same = np.take_along_axis(sums, stops, axis=1) - sums[:, :WINDOW]
        same = np.where(allowed, same, -1)
        best = same.argmax(axis=1)
        most = np.take_along_axis(same, best[:, None], axis=1)[:, 0]
        good = most >= self.needed[item]
        first = place + best - (WINDOW - 1) - begin[row]
        return np.stack([row, item, most, first])[:, good]


def mark_leaks(
    df: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    out: str = "leaks",
    item_key: str = "item_id",
    item_text: str = "text",
    block_bytes: int = 16 << 20,
    short_items: bool = False,
) -> DataFrame:
    """Add an array of leaked items: key, matching tokens, first document token.

    Columns of any name are kept; one named ``out`` is an error.
    """
    if out in df.columns:
        raise ValueError(f"there is a column {out!r} already")
    spark = df.sparkSession
    items = benchmark.where(
        benchmark[item_key].isNotNull() & benchmark[item_text].isNotNull()
    ).select(benchmark[item_key].alias("item"), benchmark[item_text].alias("own"))
    total = items.agg(F.sum(F.octet_length("own"))).first()[0] or 0
    count = max(1, -(-total // block_bytes))
    key_type = benchmark.schema[item_key].dataType.simpleString()
    kind = f"array<struct<item:{key_type},matched:long,first:long>>"
    item_type = to_arrow_type(benchmark.schema[item_key].dataType)
    listed_type = pa.list_(
        pa.struct([("item", item_type), ("matched", pa.int64()), ("first", pa.int64())])
    )
    names = [f"_{i}" for i in range(len(df.columns))]
    plain = df.select(*[df[c].alias(n) for c, n in zip(df.columns, names, strict=True)])
    position = names[df.columns.index(text)]
    fields = ", ".join(
        f"{n} {f.dataType.simpleString()}" for n, f in zip(names, df.schema.fields, strict=True)
    )
    found = []
    for number in range(count):
        part = items.where(F.pmod(F.xxhash64("item"), F.lit(count)) == number).collect()
        held = spark.sparkContext.broadcast(
            ([r["item"] for r in part], ItemBlock([r["own"] for r in part], short_items))
        )
        column = f"_leaks{number}"

        def mark(batches: Iterator[pa.RecordBatch], held=held, column=column):
            keys, block = held.value
            for batch, data, offsets in raw.blocks(batches, position):
                hashes, begin = tokens(data, offsets)
                row, item, same, first = block.leaks(hashes, begin)
                seen: list[dict] = [{} for _ in range(batch.num_rows)]
                for r, i, n, at in zip(*(x.tolist() for x in (row, item, same, first)), strict=True):
                    old = seen[r].get(keys[i])
                    if old is None or n > old["matched"]:
                        seen[r][keys[i]] = {"item": keys[i], "matched": n, "first": at}
                listed = pa.array([list(x.values()) for x in seen], listed_type)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, listed], [*batch.schema.names, column]
                )

        fields = f"{fields}, {column} {kind}"
        plain = plain.mapInArrow(mark, fields)
        found.append(column)
    return plain.select(
        *[F.col(n).alias(c) for n, c in zip(names, df.columns, strict=True)],
        F.concat(*found).alias(out),
    )


def without_leaks(df: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """The rows of ``df`` that leak no item, with its columns of whatever name."""
    found = "_found"
    while found in df.columns:
        found += "_"
    marked = mark_leaks(df, benchmark, text, found, **options)
    return marked.where(F.size(found) == 0).drop(found)
