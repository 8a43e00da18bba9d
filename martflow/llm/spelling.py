"""Spelling variants of frequent words, by an index of variable-length grams.

Words are near if one inserted, deleted or replaced letter makes one of the other.

* The gram dictionary holds the grams that more than ``F`` places share. It is cut to
  a bounded size by raising ``F``, which changes the speed but no result.
* A word, with an end mark, is decomposed into one gram for each position: from the
  shortest length on, a gram is lengthened as long as it is in the dictionary. Which
  gram stands at a position depends on its own letters only.
* So an edit at a letter affects only the grams over it. The most grams over one
  letter bound what an edit can change in that word, and a near word shares all its
  other grams. Of two near words, in any common order of grams, the first
  ``bound + 1`` grams of one and of the other then meet: only these lists are merged.
  Grams outside the dictionary, whose lists are short, come first in that order.
* In a merged list, near words agree in a word less one letter. Hits are verified
  letter by letter.

Grams of letters A to Z and À to ÿ fit into one 64-bit number without loss.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from martflow.llm import bytes as raw
from martflow.llm.passages import by_anchor
from martflow.llm.stored import stored

# The letters of a word, once A to Z are in lower case.
LETTERS = "[a-z\\u00C0-\\u00FF]"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

MIN_CHARS = 7
SHORTEST_WORD = 6  # shorter words could lose all grams by one edit
DICTIONARY = 1 << 18
LEAST_LIST = 32
HOT_LIST = 50_000
BITS = 7
END = 91


@dataclass(frozen=True)
class Lengths:
    """Words of a length class and its grams. Near words share at least one class."""

    least: int
    most: int
    shortest: int
    longest: int


# In each class a word has more grams than one edit can affect.
CLASSES = (Lengths(0, 11, 2, 5), Lengths(11, 1 << 30, 3, 8))


def _codes() -> np.ndarray:
    """7-bit codes of Latin-1 letters; 0 for all others."""
    codes = np.zeros(256, np.int64)
    codes[ord("a") : ord("z") + 1] = np.arange(1, 27)
    codes[0xC0:0x100] = np.arange(27, 91)
    codes[ord("$")] = END
    return codes


class Words:
    """The letters of some words, each closed by an end mark, in one array."""

    def __init__(self, column: pa.Array):
        texts = column.to_pylist()
        self.data = np.frombuffer("$".join([*texts, ""]).encode("latin-1"), np.uint8)
        self.size = np.fromiter(map(len, texts), np.int64, len(texts))
        self.end = np.cumsum(self.size + 1)  # after the end mark
        self.start = self.end - self.size - 1

    def places(self, rows: np.ndarray, grams: Lengths) -> tuple[np.ndarray, np.ndarray]:
        """The row and the begin of each gram of some rows."""
        count = self.size[rows] + 2 - grams.shortest
        row = np.repeat(rows, count)
        step = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
        return row, self.start[row] + step


def _members(words: Words, grams: Lengths) -> np.ndarray:
    return np.flatnonzero((words.size >= grams.least) & (words.size <= grams.most))


def _packed(words: Words, at: np.ndarray, length: int, kind: int) -> np.ndarray:
    """The grams of one length at some places as numbers, marked by their class."""
    codes = _codes()
    value = np.full(len(at), kind << (8 * BITS), np.int64)
    for i in range(length):
        value |= codes[words.data[at + i]] << (BITS * (7 - i))
    return value


def gram_counts(words: DataFrame) -> DataFrame:
    """``gram, n``: in how many places of all words each possible gram stands."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = Words(batch.column("word"))
            found = [np.zeros(0, np.int64)]
            for kind, grams in enumerate(CLASSES):
                row, at = own.places(_members(own, grams), grams)
                for length in range(grams.shortest, grams.longest + 1):
                    fits = at + length <= own.end[row]
                    found.append(_packed(own, at[fits], length, kind))
            gram, n = np.unique(np.concatenate(found), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(gram), pa.array(n)], ["gram", "n"])

    partial = words.select("word").mapInArrow(scan, "gram long, n long")
    return partial.groupBy("gram").agg(F.sum("n").alias("n"))


@dataclass(frozen=True)
class Dictionary:
    """Frequent grams, sorted, and their counts."""

    grams: np.ndarray
    counts: np.ndarray

    def count(self, grams: np.ndarray) -> np.ndarray:
        """How often grams occur; 0 for those outside the dictionary."""
        if not len(self.grams):
            return np.zeros(len(grams), np.int64)
        at = np.minimum(np.searchsorted(self.grams, grams), len(self.grams) - 1)
        return np.where(self.grams[at] == grams, self.counts[at], 0)


def gram_dictionary(
    words: DataFrame, size: int = DICTIONARY, least_list: int = LEAST_LIST
) -> Dictionary:
    """The grams of more than ``F`` places, where ``F`` admits at most ``size`` of them.

    All counts add up to some total, so fewer than ``total / F`` grams exceed ``F``.
    """
    counts = stored(gram_counts(words))
    total = counts.agg(F.sum("n")).first()[0] or 0
    limit = max(least_list, total // size)
    held = counts.where(F.col("n") > limit).orderBy("gram").toPandas()
    return Dictionary(held["gram"].to_numpy(np.int64), held["n"].to_numpy(np.int64))


def decomposed(words: Words, rows: np.ndarray, grams: Lengths, kind: int, known: Dictionary):
    """Row, gram and its count, for the grams of the lists to merge."""
    row, at = words.places(rows, grams)
    size = np.full(len(at), grams.shortest, np.int64)
    value = _packed(words, at, grams.shortest, kind)
    count = known.count(value)
    codes = _codes()
    open_ = np.arange(len(at))
    for length in range(grams.shortest, grams.longest):
        longer = (count[open_] > 0) & (at[open_] + length < words.end[row[open_]])
        open_ = open_[longer]
        value[open_] |= codes[words.data[at[open_] + length]] << (BITS * (7 - length))
        size[open_] += 1
        count[open_] = known.count(value[open_])
    # The most grams over one letter bound the grams that an edit affects.
    over = np.zeros(len(words.data) + 1, np.int64)
    np.add.at(over, at, 1)
    np.add.at(over, at + size, -1)
    affected = np.maximum.reduceat(np.cumsum(over), words.start) if len(rows) else over[:0]
    # Rare grams first, in an order of their own, then the others by their counts.
    spread = raw.mix(value.view(np.uint64))
    low, high = np.uint64(1), np.uint64(1) << np.uint64(63)
    rare = spread >> low
    frequent = high | (count.astype(np.uint64) << np.uint64(22)) | (spread >> np.uint64(42))
    rank = np.where(count == 0, rare, frequent)
    order = np.lexsort((value, rank, row))
    begin = np.searchsorted(row[order], row[order], "left")
    taken = order[np.arange(len(order)) - begin <= affected[row[order]]]
    row, value, count = row[taken], value[taken], count[taken]
    once = np.ones(len(row), bool)
    once[1:] = (row[1:] != row[:-1]) | (value[1:] != value[:-1])
    return row[once], value[once], count[once]


def _less_one(words: Words, sums: np.ndarray, row: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Hashes of words without the letter at a place, or of whole words (place -1)."""
    start, stop = words.start[row], words.start[row] + words.size[row]
    inverse = raw._power_table(raw._INVERSE, len(sums) + 1)
    cut = np.where(at < 0, stop, at)
    after = np.where(at < 0, stop, at + 1)
    head = (sums[cut] - sums[start]) * inverse[start]
    return head + (sums[stop] - sums[after]) * inverse[start + 1]


def _letters(words: Words, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    size = words.size[rows]
    row = np.repeat(rows, size)
    step = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
    return row, words.start[row] + step


def list_rows(words: DataFrame, known: Dictionary, hot_list: int = HOT_LIST) -> DataFrame:
    """``anchor, word, n``: each word in each of its lists.

    A list of very many words is split by hashes of the words and of the words less one
    letter: near words share one of them, so they meet in one of the parts.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = Words(batch.column("word"))
            sums = raw.byte_hashes(own.data)
            for kind, grams in enumerate(CLASSES):
                row, gram, count = decomposed(own, _members(own, grams), grams, kind, known)
                hot = count > hot_list
                rows, lists = [row[~hot]], [raw.mix(gram[~hot].view(np.uint64))]
                for r, g, c in zip(row[hot], gram[hot], count[hot], strict=True):
                    at = np.arange(own.start[r] - 1, own.start[r] + own.size[r])
                    at[0] = -1
                    part = raw.mix(_less_one(own, sums, np.full(len(at), r), at))
                    part = np.unique(part % np.uint64(-(-c // hot_list)))
                    rows.append(np.full(len(part), r))
                    lists.append(raw.mix(raw.mix(np.full(len(part), g).view(np.uint64)) + part))
                taken = pa.array(np.concatenate(rows))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate(lists).view(np.int64)),
                        batch.column("word").take(taken),
                        batch.column("n").take(taken),
                    ],
                    ["anchor", "word", "n"],
                )

    return words.select("word", "n").mapInArrow(scan, "anchor long, word string, n long")


def _same_less_one(words: Words, a, at_a, b, at_b) -> np.ndarray:
    """Whether words without a letter (none: place -1) are equal, letter by letter."""
    length = words.size[a] - (at_a >= 0)
    same = np.zeros(len(a), bool)
    for size in np.unique(length):
        group = np.flatnonzero((length == size) & (words.size[b] - (at_b >= 0) == size))
        step = np.arange(size)
        for first in range(0, len(group), max(1, (1 << 22) // max(1, size))):
            part = group[first : first + max(1, (1 << 22) // max(1, size))]

            def letters(row, at):
                place = words.start[row][:, None] + step
                return words.data[place + ((at >= 0)[:, None] & (place >= at[:, None]))]

            same[part] = (letters(a[part], at_a[part]) == letters(b[part], at_b[part])).all(axis=1)
    return same


def near_in_lists(table: pa.Table) -> pa.RecordBatch:
    """All near words of some whole lists, each pair in both directions."""
    own = Words(table.column("word"))
    cell = raw.mix(table.column("anchor").to_numpy().view(np.uint64))
    sums = raw.byte_hashes(own.data)
    every = np.arange(len(own.size))
    row, at = _letters(own, every)
    less = _less_one(own, sums, row, at)
    place = (at - own.start[row] + (own.size[row] << 32)).astype(np.uint64)
    pairs = []

    # Replaced: equal without the letter at one place. At most one word for each letter.
    key = raw.mix(less + raw.mix(place ^ cell[row]))
    order = np.argsort(key, kind="stable")
    key = key[order]
    ahead = np.arange(len(key))
    for step in range(1, len(key)):
        ahead = ahead[ahead + step < len(key)]
        ahead = ahead[key[ahead] == key[ahead + step]]
        if not len(ahead):
            break
        pairs.append(np.stack([x[order[y]] for y in (ahead, ahead + step) for x in (row, at)]))

    # Deleted: a word less one letter is another word.
    whole = _less_one(own, sums, every, np.full(len(every), -1)) + cell
    order = np.argsort(whole, kind="stable")
    whole = whole[order]
    low = np.searchsorted(whole, less + cell[row], "left")
    count = np.searchsorted(whole, less + cell[row], "right") - low
    while (hit := np.flatnonzero(count > 0)).size:
        shorter = order[low[hit]]
        pairs.append(np.stack([row[hit], at[hit], shorter, np.full(len(hit), -1)]))
        low[hit] += 1
        count[hit] -= 1

    a, at_a, b, at_b = np.concatenate([np.zeros((4, 0), np.int64), *pairs], axis=1)
    fits = (cell[a] == cell[b]) & _same_less_one(own, a, at_a, b, at_b)
    a, b = np.minimum(a, b)[fits], np.maximum(a, b)[fits]
    a, b = np.divmod(np.unique(a * len(every) + b), max(1, len(every)))
    word, n = table.column("word").combine_chunks(), table.column("n").combine_chunks()
    one, other = pa.array(np.concatenate([a, b])), pa.array(np.concatenate([b, a]))
    return pa.RecordBatch.from_arrays(
        [word.take(one), word.take(other), n.take(other)], ["word", "near", "near_n"]
    )


def near_words(words: DataFrame, hot_list: int = HOT_LIST, **options) -> DataFrame:
    """``word, near, near_n`` for all near words of ``word, n``, in both directions.

    A pair that meets in several lists comes several times.
    """
    known = gram_dictionary(words, **options)
    return by_anchor(
        list_rows(words, known, hot_list), near_in_lists, "word string, near string, near_n long"
    )


def words_of(text: Column, min_chars: int) -> Column:
    """The maximal runs of letters of at least a length, with A to Z in lower case."""
    lower = F.translate(F.coalesce(text, F.lit("")), UPPER, UPPER.lower())
    return F.regexp_extract_all(lower, F.lit(f"{LETTERS}{{{min_chars},}}"), F.lit(0))


def word_counts(words: DataFrame, min_chars: int, min_count: int) -> DataFrame:
    """``word, n`` of the words that are long and frequent enough."""
    long_enough = words.where(F.char_length("word") >= min_chars)
    counted = long_enough.groupBy("word").agg(F.count("*").alias("n"))
    return counted.where(F.col("n") >= min_count)


def roots(links: DataFrame) -> DataFrame:
    """``word, root`` of links ``word, form``: the end of the chain of each word.

    Each round doubles how far a word sees. A form is more frequent than its word by a
    factor, so chains are short and have no circles.
    """
    seen = stored(links.select("word", F.col("form").alias("root")))
    while True:
        ahead = seen.select(F.col("word").alias("root"), F.col("root").alias("further"))
        longer = seen.join(ahead, "root", "left")
        further = stored(longer.select("word", F.coalesce("further", "root").alias("root"), "further"))
        moved = further.where(F.col("further").isNotNull()).limit(1).count()
        seen = further.drop("further")
        if not moved:
            return seen


def spelling_groups(words: DataFrame, factor: int = 10, **options) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for words and their counts ``word, n``.

    The form of a word is its near word of largest ``n``, if that is at least ``factor``
    times its own; of equally frequent ones the first in code-point order. The root is
    where the chain of forms ends, and the word itself where there is none. A null
    word is left out, and an empty table gives an empty one.

    Words need six letters at least, all of them letters a to z or À to ÿ, and
    ``factor`` must exceed 1.
    """
    if factor <= 1:
        raise ValueError("a form must be more frequent than its word")
    words = stored(words.where(F.col("word").isNotNull()).select("word", F.col("n").cast("long").alias("n")))
    near = near_words(words, **options)
    # A word has at most some hundred near words for each of its letters.
    best = near.groupBy("word").agg(
        F.size(F.collect_set("near")).cast("long").alias("n_near"),
        F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"),
    )
    fits = -F.col("best.less") >= factor * F.col("n")
    judged = stored(
        words.join(best, "word", "left").select(
            "word",
            F.when(fits, F.col("best.near")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(fits, -F.col("best.less")).alias("form_n"),
        )
    )
    ends = roots(judged.where(F.col("form").isNotNull()))
    return judged.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def spelling_variants(
    docs: DataFrame, text: str = "text", min_chars: int = MIN_CHARS, min_count: int = 2, **options
) -> DataFrame:
    """:func:`spelling_groups` of all words of the documents.

    Words are maximal runs of the letters A to Z and À to ÿ, compared with A to Z in
    lower case. Null and empty texts have none; other columns are ignored, whatever
    their names, and texts of any length are read whole.
    """
    if min_chars < SHORTEST_WORD:
        raise ValueError(f"words need {SHORTEST_WORD} letters")
    runs = docs.select(F.explode(words_of(docs[text], min_chars)).alias("word"))
    return spelling_groups(word_counts(runs, min_chars, min_count), **options)
