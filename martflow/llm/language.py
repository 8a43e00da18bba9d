"""Language identification by prediction by partial matching.

Each language has a tree of byte contexts up to three bytes deep. A byte costs
-log2 of its share in the longest context known, or the escape share of that
context and then the cost in the next shorter one; the last resort is a uniform
byte. Statistics are frozen after fitting, so the cost of every byte that may
follow a known context is worked out once and a text is scored by table lookups.

The fit uses at most ``rows_per_language`` whole texts of each language, of at
most ``max_bytes`` bytes each. Every text is scored whole. Null texts and texts
without letters get ``und`` and the score 0. Repeated rows are scored alike. An
empty table gives an empty result; without learned languages all rows are ``und``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from martflow.llm import bytes as raw
from martflow.llm.samples import chosen

DEPTH = 3
UNKNOWN = "und"


@dataclass
class ContextTrees:
    """Frozen costs in bits; the last axis is the language."""

    languages: list[str]
    classes: np.ndarray  # byte -> class; 0 is a pad, 1 a byte never seen
    triples: np.ndarray  # class triple -> its number, -1 if unknown
    fours: np.ndarray  # triple number and class -> row of cost4, -1 if unknown
    cost4: np.ndarray
    escape3: np.ndarray  # by triple number; the last row is zero
    cost3: np.ndarray  # by triple number
    escape2: np.ndarray  # by class pair
    cost2: np.ndarray  # by class pair, with all shorter contexts worked in

    def bits(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Code length of each row in each language."""
        rows = len(offsets) - 1
        count = int(self.cost2.shape[0] ** 0.5)
        codes, first = padded(self.classes[raw.lower_ascii(data)], offsets)
        codes = codes.astype(np.int64)
        pairs = codes[:-1] * count + codes[1:]
        triple = self.triples[pairs[:-1] * count + codes[2:]]
        before, after = triple[:-1], triple[1:]
        place = np.where(before >= 0, self.fours[before * count + codes[3:]], -1)
        cost = self.cost4[place]
        miss = np.flatnonzero(place < 0)
        known = after[miss] >= 0
        last = pairs[2:][miss]
        lower = np.where(
            known[:, None],
            self.cost3[after[miss]],
            self.escape2[pairs[1:-1][miss]] + self.cost2[last],
        )
        cost[miss] = self.escape3[before[miss]] + lower
        total = np.zeros((len(cost) + 1, len(self.languages)))
        np.cumsum(cost, axis=0, dtype=np.float64, out=total[1:])
        # The cost at i is that of code i + DEPTH; those of pads belong to no row.
        begin = first - DEPTH
        return (total[begin + np.diff(offsets)] - total[begin]).reshape(rows, -1)


def padded(codes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes with ``DEPTH`` zeros before each row, and where each row begins."""
    rows = len(offsets) - 1
    out = np.zeros(len(codes) + DEPTH * rows, codes.dtype)
    first = offsets[:-1] + DEPTH * np.arange(1, rows + 1)
    own = np.arange(len(codes)) + np.repeat(DEPTH * np.arange(1, rows + 1), np.diff(offsets))
    out[own] = codes
    return out, first


def _level(grams: np.ndarray, counts: np.ndarray, count: int, lower, contexts: np.ndarray):
    """Costs of one depth: seen bytes by their share, others by escape.

    ``grams`` and ``counts`` have, per language, the context-and-byte codes.
    ``contexts`` lists the codes to give escapes for. Returns the costs of all
    grams of any language, in code order, and the escapes.
    """
    union = np.unique(np.concatenate(grams)) if grams else np.zeros(0, np.int64)
    cost = np.zeros((len(union), len(grams)), np.float32)
    escape = np.zeros((len(contexts), len(grams)), np.float32)
    for j, (own, n) in enumerate(zip(grams, counts, strict=True)):
        parents, at = np.unique(own // count, return_inverse=True)
        total = np.bincount(at, n, len(parents))
        kinds = np.bincount(at, minlength=len(parents))
        # bits of an escape from each known context; unknown contexts cost none
        out = np.zeros(len(parents) + 1)
        out[:-1] = -np.log2(kinds / (total + kinds))

        def find(codes, parents=parents):
            place = np.searchsorted(parents, codes)
            place[place == len(parents)] = 0
            known = parents[place] == codes if len(parents) else np.zeros(len(codes), bool)
            return np.where(known, place, len(parents))

        escape[:, j] = out[find(contexts)]
        cost[:, j] = out[find(union // count)] + lower(union, j)
        seen = np.searchsorted(union, own)
        cost[seen, j] = -np.log2(n / (total + kinds)[at])
    return union, cost, escape


def fit_trees(texts: dict[str, list[bytes]]) -> ContextTrees:
    """Context trees of the texts of each language."""
    languages = sorted(texts)
    joined = []
    for language in languages:
        column = pa.array(texts[language], pa.large_binary())
        data, offsets = raw.utf8(column)
        joined.append((raw.lower_ascii(data), offsets))
    present = np.zeros(256, bool)
    for data, _ in joined:
        present[data] = True
    classes = np.ones(256, np.uint16)
    classes[present] = np.arange(2, present.sum() + 2)
    count = int(present.sum()) + 2
    levels: list[tuple[list, list]] = [([], []) for _ in range(DEPTH + 1)]
    for data, offsets in joined:
        codes, first = padded(classes[data], offsets)
        codes = codes.astype(np.int64)
        real = np.ones(len(codes), bool)
        for shift in range(1, DEPTH + 1):
            real[first - shift] = False
        where = np.flatnonzero(real)
        gram = codes[where]
        for depth in range(DEPTH + 1):
            if depth:
                gram = gram + codes[where - depth] * count**depth
            values, n = np.unique(gram, return_counts=True)
            levels[depth][0].append(values)
            levels[depth][1].append(n)

    uniform = lambda codes, j: np.full(len(codes), 8.0)
    none = np.zeros(1, np.int64)
    codes0, seen0, escape0 = _level(*levels[0], count, uniform, none)
    cost1 = np.repeat(escape0, count, axis=0) + 8
    cost1[codes0] = seen0
    pairs = np.arange(count * count)
    codes1, seen1, escape1 = _level(
        *levels[1], count, lambda codes, j: cost1[codes % count, j], np.arange(count)
    )
    cost2 = escape1[pairs // count] + cost1[pairs % count]
    cost2[codes1] = seen1
    codes2, cost3, escape2 = _level(
        *levels[2], count, lambda codes, j: cost2[codes % count**2, j], pairs
    )

    def after_triple(codes, j):
        tail = codes % count**3
        place = np.minimum(np.searchsorted(codes2, tail), max(len(codes2) - 1, 0))
        known = codes2[place] == tail
        other = escape2[tail // count, j] + cost2[tail % count**2, j]
        return np.where(known, cost3[place, j], other)

    # Every context of the deepest level, the ones with pads included.
    contexts = np.unique(np.concatenate([codes2, *(g // count for g in levels[3][0])]))
    codes3, cost4, escape3 = _level(*levels[3], count, after_triple, contexts)
    triples = np.full(count**3, -1, np.int32)
    triples[contexts] = np.arange(len(contexts))
    full3 = np.stack(
        [after_triple(contexts, j) for j in range(len(languages))], axis=1
    ).astype(np.float32)
    fours = np.full((len(contexts) + 1) * count, -1, np.int32)
    fours[triples[codes3 // count].astype(np.int64) * count + codes3 % count] = np.arange(
        len(codes3)
    )
    zero = np.zeros((1, len(languages)), np.float32)
    return ContextTrees(
        languages,
        classes,
        triples,
        fours,
        np.concatenate([cost4, zero]),
        np.concatenate([escape3, zero]),
        full3,
        escape2.astype(np.float32),
        cost2.astype(np.float32),
    )


def learn_languages(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    language: str = "lang",
    rows_per_language: int = 1000,
    max_bytes: int = 16_384,
    max_languages: int = 100,
) -> ContextTrees | None:
    """Fit on a bounded sample of each language.

    Only keys are ranked; texts of the chosen keys are then read by a join with
    the small list. More than ``max_languages`` languages raise an error.
    """
    usable = (
        df[language].isNotNull()
        & df[key].isNotNull()
        & F.octet_length(df[text]).between(1, max_bytes)
    )
    rows = df.where(usable).select(
        df[key].alias("_key"), df[language].alias("_language"), df[text].alias("_text")
    )
    picked = chosen(rows.drop("_text"), "_key", ["_language"], rows_per_language)
    found = picked.collect()
    texts: dict[str, list[bytes]] = {r["_language"]: [] for r in found}
    if not texts:
        return None
    if len(texts) > max_languages:
        raise ValueError(f"{len(texts)} languages; at most {max_languages} can be learned")
    keys = df.sparkSession.createDataFrame(
        sorted({(r["_key"],) for r in found}), f"_key {df.schema[key].dataType.simpleString()}"
    )
    for row in rows.join(F.broadcast(keys), "_key").toLocalIterator():
        own = texts[row["_language"]]
        if len(own) < rows_per_language:
            own.append(row["_text"].encode())
    return fit_trees(texts)


def predict_language(
    df: DataFrame, trees: ContextTrees | None, text: str = "text", keep: list[Column] | None = None
) -> DataFrame:
    """Add ``lang_pred`` and ``score`` to the columns ``keep`` (default: all)."""
    kept = df.select(*(keep if keep is not None else [df[c] for c in df.columns]))
    names = [f"_{i}" for i in range(len(kept.columns))]
    spoken = F.coalesce(df[text].rlike(r"\p{L}"), F.lit(False))
    whole = df.select(
        *(keep if keep is not None else [df[c] for c in df.columns]),
        df[text].alias("_text"),
        spoken.alias("_spoken"),
    ).toDF(*names, "_text", "_spoken")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in raw.blocks(batches, "_text"):
            said = batch.column("_spoken").to_numpy(zero_copy_only=False)
            if trees is None:
                best, share = np.zeros(len(said), int), np.zeros(len(said))
                labels, said = [UNKNOWN], np.zeros(len(said), bool)
            else:
                bits = trees.bits(data, offsets)
                best = bits.argmin(axis=1)
                share = 1 / np.exp2(bits.min(axis=1, keepdims=True) - bits).sum(axis=1)
                labels = trees.languages
            pred = [labels[b] if s else UNKNOWN for b, s in zip(best, said, strict=True)]
            columns = [batch.column(n) for n in names]
            columns += [pa.array(pred, pa.string()), pa.array(np.where(said, share, 0.0))]
            yield pa.RecordBatch.from_arrays(columns, [*names, "_pred", "_score"])

    fields = ", ".join(
        f"{n} {f.dataType.simpleString()}" for n, f in zip(names, kept.schema.fields, strict=True)
    )
    schema = f"{fields}{', ' if fields else ''}_pred string, _score double"
    return whole.mapInArrow(score, schema).toDF(*kept.columns, "lang_pred", "score")
