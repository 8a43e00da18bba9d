"""Language-model scores of a log-bilinear model, trained by noise contrast.

Tokens are words (runs of non-space bytes, A to Z in lower case) and one end for
each text. The model predicts a token from the two before it: the context is the
sum of their vectors, each turned by a matrix of its place, and a token's score
is the product with its own vector plus an offset. Its outputs are the end, the
most frequent words, and one class for all other words, within which a word has
its smoothed share of the training counts. Scores of all outputs for all
contexts are normalised with batched matrix products, so probabilities add up to
one over all known words and one unknown word.

Counts are exact and taken from every training text. Training sees every
training text too: tasks train copies of the model on their texts by noise-
contrastive estimation, and their weighted mean starts the next round.

The words with outputs are chosen by the exact counts of all training texts.
They and ``table_words`` others are scored without a shuffle. The others are
chosen from a bounded sample and counted without a shuffle too; which words they
are changes the speed but no result. All words beyond these are matched with
their counts by a join. Words are told apart by 64-bit hashes.

Null texts count as empty: a lone end. Rows that repeat a key are scored alike.
Empty tables give empty results; without training texts every token is unknown.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from martflow.llm import bytes as raw
from martflow.llm.stored import stored

# Hash that stands for the end of a text, and the output numbers of the model.
END_HASH = np.uint64(0x51A7E0F1D5C3B297)
END = 0
WIDTH = 32
BATCH = 4096
NOISE_DRAWN = 64
NOISE_RATIO = 16.0
RATE = 0.05


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens, an end after each row, and where rows begin."""
    data = raw.lower_ascii(data)
    starts, ends, begin = raw.words(data, offsets)
    hashes = raw.word_hashes(data, starts, ends)
    rows = len(offsets) - 1
    begin = begin + np.arange(rows + 1)
    out = np.full(len(hashes) + rows, END_HASH, np.uint64)
    word = np.ones(len(out), bool)
    word[begin[1:] - 1] = False
    out[word] = hashes
    return out, begin


@dataclass
class Table:
    """The words held by every task, by hash, with counts and output numbers."""

    hashes: np.ndarray
    counts: np.ndarray
    outputs: np.ndarray
    tokens: int
    kinds: int

    def places(self, hashes: np.ndarray) -> np.ndarray:
        """Entries of tokens, -1 for those that the table lacks."""
        if not len(self.hashes):
            return np.full(len(hashes), -1)
        place = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[place] == hashes, place, -1)

    @property
    def rest(self) -> int:
        """Output number of all words without their own."""
        return int(self.outputs.max(initial=0)) + 1

    def output_counts(self) -> np.ndarray:
        own = np.bincount(
            np.maximum(self.outputs, 0), self.counts * (self.outputs >= 0), self.rest + 1
        )
        own[self.rest] = self.tokens - own.sum()
        return own

    def rest_mass(self) -> float:
        """Smoothed counts of all words of the last output, an unknown one included."""
        named = self.outputs >= 0
        kinds = self.kinds - int((named & (self.counts > 0)).sum())
        return float(self.tokens - self.counts[named].sum() + 0.5 * (kinds + 1))


@dataclass
class Model:
    """Vectors of context words, matrices of their places, vectors of outputs."""

    context: np.ndarray
    near: np.ndarray
    far: np.ndarray
    target: np.ndarray
    offset: np.ndarray

    def rows(self) -> np.ndarray:
        """All parameters as rows of one more than ``WIDTH`` numbers."""
        plain = np.concatenate([self.context, self.near, self.far])
        plain = np.concatenate([plain, np.zeros((len(plain), 1), np.float32)], axis=1)
        return np.concatenate([plain, np.concatenate([self.target, self.offset[:, None]], axis=1)])

    @staticmethod
    def of_rows(rows: np.ndarray) -> Model:
        size = (len(rows) - 2 * WIDTH) // 2
        rows = rows.astype(np.float32)
        context, near, far, target = np.split(
            rows, [size, size + WIDTH, size + 2 * WIDTH]
        )
        cut = slice(0, WIDTH)
        return Model(
            context[:, cut].copy(),
            near[:, cut].copy(),
            far[:, cut].copy(),
            target[:, cut].copy(),
            target[:, WIDTH].copy(),
        )


def first_model(share: np.ndarray, seed: int = 3) -> Model:
    """A model that predicts each output's share whatever the context."""
    rng = np.random.default_rng(seed)
    size = len(share)
    draw = lambda *shape: rng.normal(0, 0.1, shape).astype(np.float32)
    eye = np.eye(WIDTH, dtype=np.float32)
    return Model(draw(size, WIDTH), eye.copy(), eye.copy(), draw(size, WIDTH), np.log(share).astype(np.float32))


def contexts(outputs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The token before each token and the one before that, within its text."""
    near = np.concatenate([[END], outputs[:-1]])
    far = np.concatenate([[END, END], outputs[:-2]])[: len(outputs)]
    return near, np.where(near == END, END, far)


class _ByRow:
    """Sums of slopes by the row they move; a stable sort keeps their order."""

    def __init__(self, place: np.ndarray, rows: int):
        # short numbers are sorted by radix
        self.order = np.argsort(place.astype(np.min_scalar_type(rows)), kind="stable")
        place = place[self.order]
        self.first = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
        self.row = place[self.first]

    def total(self, slope: np.ndarray) -> np.ndarray:
        return np.add.reduceat(np.take(slope, self.order, axis=0), self.first, axis=0)


class _Steps:
    """Adagrad steps of one array."""

    def __init__(self, values: np.ndarray):
        self.values = values
        self.squares = np.full(values.shape, 1e-4, np.float32)

    def all(self, slope: np.ndarray) -> None:
        self.squares += slope * slope
        self.values -= RATE * slope / np.sqrt(self.squares)

    def rows(self, by_row: _ByRow, slope: np.ndarray) -> None:
        row, total = by_row.row, by_row.total(slope)
        self.squares[row] += total * total
        self.values[row] -= RATE * total / np.sqrt(self.squares[row])


class Trainer:
    """Noise-contrastive training of a copy of a model."""

    def __init__(self, model: Model, share: np.ndarray, seed: int):
        self.model = Model.of_rows(model.rows())
        m = self.model
        self.steps = {
            name: _Steps(getattr(m, name)) for name in ("context", "near", "far", "target", "offset")
        }
        self.share = share
        self.log_noise = np.log(NOISE_RATIO * share).astype(np.float32)
        self.rng = np.random.default_rng(seed)

    def learn(self, outputs: np.ndarray) -> None:
        near, far = contexts(outputs)
        for at in range(0, len(outputs), BATCH):
            cut = slice(at, at + BATCH)
            self._batch(outputs[cut], near[cut], far[cut])

    def _batch(self, word: np.ndarray, near: np.ndarray, far: np.ndarray) -> None:
        m, step = self.model, self.steps
        one, two = np.take(m.context, near, axis=0), np.take(m.context, far, axis=0)
        mean = one @ m.near + two @ m.far
        drawn = self.rng.choice(len(self.share), NOISE_DRAWN, p=self.share)
        right = np.take(m.target, word, axis=0)
        real = (mean * right).sum(axis=1) + m.offset[word] - self.log_noise[word]
        noise = mean @ m.target[drawn].T
        noise += m.offset[drawn]
        noise -= self.log_noise[drawn]
        scale = np.float32(1 / len(word))
        real = (1 / (1 + np.exp(-real)) - 1) * scale
        np.exp(np.negative(noise, out=noise), out=noise)
        noise += 1
        np.divide(1, noise, out=noise)
        noise *= scale * np.float32(NOISE_RATIO / NOISE_DRAWN)
        back = real[:, None] * right + noise @ m.target[drawn]
        places = np.concatenate([word, drawn])
        slope = np.concatenate([real[:, None] * mean, noise.T @ mean])
        own = np.concatenate([real, noise.sum(axis=0)])
        to_one, to_two = back @ m.near.T, back @ m.far.T
        to_near, to_far = one.T @ back, two.T @ back
        by_output = _ByRow(places, len(self.share))
        by_context = _ByRow(np.concatenate([near, far]), len(self.share))
        step["target"].rows(by_output, slope)
        step["offset"].rows(by_output, own)
        step["context"].rows(by_context, np.concatenate([to_one, to_two]))
        step["near"].all(to_near)
        step["far"].all(to_far)


def log_totals(model: Model) -> np.ndarray:
    """Log of the sum over all outputs, by the token before and the one before it."""
    one, two = model.context @ model.near, model.context @ model.far
    out = np.zeros((len(one), len(one)), np.float32)
    for far in range(len(one)):
        score = (one + two[far]) @ model.target.T + model.offset
        most = score.max(axis=1)
        np.exp(score - most[:, None], out=score)
        out[:, far] = most + np.log(score.sum(axis=1))
    return out


def log_probabilities(model: Model, totals: np.ndarray, outputs: np.ndarray) -> np.ndarray:
    """Normalised natural log probability of each output of a token sequence."""
    near, far = contexts(outputs)
    one, two = model.context @ model.near, model.context @ model.far
    out = np.zeros(len(outputs))
    for at in range(0, len(outputs), 1 << 16):
        cut = slice(at, at + (1 << 16))
        n, f, w = near[cut], far[cut], outputs[cut]
        score = ((one[n] + two[f]) * model.target[w]).sum(axis=1) + model.offset[w]
        out[cut] = score - totals[n, f]
    return out


def count_words(df: DataFrame, text: str, held: np.ndarray) -> DataFrame:
    """Exact counts of all tokens: ``word`` and ``n``, one row for each word.

    Tasks count the words in ``held`` as a whole and all others by block.
    """
    held = np.sort(np.append(held, END_HASH))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(held), np.int64)

        def batch_of(words: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(words.view(np.int64)), pa.array(counts)], ["word", "n"]
            )

        for _, data, offsets in raw.blocks(batches, "_text"):
            hashes, _ = word_hashes(data, offsets)
            place = np.minimum(np.searchsorted(held, hashes), len(held) - 1)
            known = held[place] == hashes
            total += np.bincount(place[known], minlength=len(held))
            yield batch_of(*np.unique(hashes[~known], return_counts=True))
        seen = total > 0
        yield batch_of(held[seen], total[seen])

    found = df.select(df[text].alias("_text")).mapInArrow(scan, "word long, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n"))


def frequent_words(
    df: DataFrame, key: str, text: str, sample_rows: int, table_words: int, max_bytes: int
) -> np.ndarray:
    """The most frequent words of a sample of at most ``sample_rows`` texts."""
    short = df.where(F.octet_length(df[text]) <= max_bytes)
    keys = short.select(df[key].alias("_key")).where("_key is not null").distinct()
    keys = keys.orderBy(F.xxhash64("_key"), "_key").limit(sample_rows).collect()
    kind = df.schema[key].dataType.simpleString()
    keys = df.sparkSession.createDataFrame([tuple(r) for r in keys], f"_key {kind}")
    some = short.select(df[key].alias("_key"), df[text].alias("_text")).join(
        F.broadcast(keys), "_key", "left_semi"
    )
    counts = count_words(some, "_text", np.zeros(0, np.uint64))
    rows = counts.orderBy(F.desc("n"), "word").limit(table_words).collect()
    return np.array([r["word"] for r in rows], np.int64).view(np.uint64)


def train(df: DataFrame, text: str, table: Table, rounds: int) -> Model:
    """Rounds of training on all texts, each the mean of what the tasks learned."""
    counts = table.output_counts() + 0.5
    share = counts / counts.sum()
    model = first_model(share)
    spark = df.sparkSession
    texts = df.select(df[text].alias("_text"))
    for number in range(rounds):
        held = spark.sparkContext.broadcast((table, model))

        def scan(batches: Iterator[pa.RecordBatch], held=held, number=number):
            words, start = held.value
            learner, seen = Trainer(start, share, number), 0
            for _, data, offsets in raw.blocks(batches, "_text"):
                hashes, _ = word_hashes(data, offsets)
                outputs = output_numbers(words, words.places(hashes))
                learner.learn(outputs)
                seen += len(outputs)
            if seen:
                rows = learner.model.rows()
                flat = pa.array(rows.ravel().astype(np.float64) * seen)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.arange(len(rows), dtype=np.int32)),
                        pa.array(np.full(len(rows), seen)),
                        pa.FixedSizeListArray.from_arrays(flat, rows.shape[1]).cast(
                            pa.list_(pa.float64())
                        ),
                    ],
                    ["row", "weight", "values"],
                )

        learned = texts.mapInArrow(scan, "row int, weight long, values array<double>")
        sums = [F.sum(F.col("values")[i]).alias(f"v{i}") for i in range(WIDTH + 1)]
        found = learned.groupBy("row").agg(F.sum("weight").alias("weight"), *sums).collect()
        if not found:
            break
        rows = np.zeros((len(found), WIDTH + 1))
        for r in found:
            rows[r["row"]] = np.array(r[2:]) / r["weight"]
        model = Model.of_rows(rows)
    return model


def output_numbers(table: Table, places: np.ndarray) -> np.ndarray:
    """Output numbers of table entries; words without their own get the last one."""
    own = np.append(np.where(table.outputs < 0, table.rest, table.outputs), table.rest)
    return own[places]


def score_texts(
    df: DataFrame,
    held_out: Column,
    key: str = "doc_id",
    text: str = "text",
    model_words: int = 1022,
    table_words: int = 1 << 16,
    sample_rows: int = 4000,
    sample_bytes: int = 32_768,
    rounds: int = 2,
) -> DataFrame:
    """Per row: key, ``held_out``, token counts, ``base_score`` and ``score``.

    Rows where ``held_out`` is true are not learned from. Scores are sums of
    log10 probabilities; ``base_score`` is that of the smoothed word counts.
    """
    spark = df.sparkSession
    apart = F.coalesce(held_out, F.lit(False))
    training = df.where(~apart)
    held = frequent_words(training, key, text, sample_rows, table_words, sample_bytes)
    counts = stored(count_words(training, text, held))
    totals = counts.agg(F.sum("n"), F.count("*")).first()
    named = counts.where(F.col("word") != int(END_HASH.view(np.int64)))
    named = named.orderBy(F.desc("n"), "word").limit(model_words).collect()
    named = np.array([r["word"] for r in named], np.int64).view(np.uint64)
    hashes = np.unique(np.concatenate([held, named, [END_HASH]]))
    wanted = spark.createDataFrame([(int(h),) for h in hashes.view(np.int64)], "word long")
    found = {r["word"]: r["n"] for r in counts.join(F.broadcast(wanted), "word").collect()}
    own = np.array([found.get(int(h), 0) for h in hashes.view(np.int64)], np.int64)
    outputs = np.full(len(hashes), -1)
    outputs[np.searchsorted(hashes, named)] = np.arange(1, len(named) + 1)
    outputs[np.searchsorted(hashes, END_HASH)] = END
    table = Table(hashes, own, outputs, int(totals[0] or 0), int(totals[1]))
    model = train(training, text, table, rounds)
    shared = spark.sparkContext.broadcast((table, model, log_totals(model)))
    # log10 of the smoothed share of a word: of all tokens, and of the last output
    all_mass = table.tokens + 0.5 * (table.kinds + 1)
    rest_mass = table.rest_mass()

    rows = df.select(
        F.monotonically_increasing_id().alias("_row"),
        df[key].alias("_key"),
        apart.alias("_apart"),
        df[text].alias("_text"),
    )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, fitted, log_sums = shared.value
        base_of = np.append(np.log10((words.counts + 0.5) / all_mass), 0.0)
        rest_of = np.append(
            np.where(words.outputs < 0, np.log10((words.counts + 0.5) / rest_mass), 0.0), 0.0
        )
        known_of = np.append(words.counts > 0, False)
        for batch, data, offsets in raw.blocks(batches, "_text"):
            tokens, begin = word_hashes(data, offsets)
            place = words.places(tokens)
            named = output_numbers(words, place)
            log10 = log_probabilities(fitted, log_sums, named) / np.log(10) + rest_of[place]
            add = lambda values, begin=begin: np.add.reduceat(values, begin[:-1])
            rare = np.flatnonzero(place < 0)
            row = np.repeat(np.arange(batch.num_rows), np.diff(begin))[rare]
            # rare words of each row, each once
            order = np.lexsort((tokens[rare], row))
            row, word = row[order], tokens[rare][order]
            new = np.ones(len(row), bool)
            new[1:] = (row[1:] != row[:-1]) | (word[1:] != word[:-1])
            first = np.flatnonzero(new)
            times = np.diff(np.append(first, len(row)))
            bounds = np.searchsorted(row[first], np.arange(batch.num_rows + 1)).astype(np.int32)
            entries = pa.StructArray.from_arrays(
                [pa.array(word[first].view(np.int64)), pa.array(times.astype(np.int32))],
                ["word", "n"],
            )
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(c) for c in ("_row", "_key", "_apart")],
                    pa.array(np.diff(begin)),
                    pa.array(add(known_of[place].astype(np.int64))),
                    pa.array(add(base_of[place])),
                    pa.array(add(log10)),
                    pa.ListArray.from_arrays(pa.array(bounds), entries),
                ],
                ["_row", "_key", "_apart", "n_tokens", "known", "base", "model", "rare"],
            )

    kind = df.schema[key].dataType.simpleString()
    scored = stored(
        rows.mapInArrow(
            scan,
            f"_row long, _key {kind}, _apart boolean, n_tokens long, known long, base double, "
            "model double, rare array<struct<word:long,n:int>>",
        )
    )
    rare = scored.select("_row", F.inline("rare")).withColumnRenamed("n", "times")
    matched = rare.join(counts, "word", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    share = F.col("times") * F.log10(F.col("n") + 0.5)
    more = matched.groupBy("_row").agg(
        F.sum("times").alias("times"),
        F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("more_known"),
        F.sum(share).alias("logs"),
    )
    joined = scored.drop("rare").join(more, "_row", "left")
    zero = lambda c: F.coalesce(c, F.lit(0))

    def with_rare(part: str, mass: float) -> Column:
        return F.col(part) + zero("logs") - zero("times") * float(np.log10(mass))

    return joined.select(
        F.col("_key").alias(key),
        F.col("_apart").alias("held_out"),
        "n_tokens",
        (F.col("known") + zero("more_known")).cast("long").alias("n_known"),
        F.lit(table.tokens).cast("long").alias("train_tokens"),
        with_rare("base", all_mass).alias("base_score"),
        with_rare("model", rest_mass).alias("score"),
    )
