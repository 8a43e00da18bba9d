"""Near-duplicate texts by the Jaccard similarity of word n-gram sets.

Two texts link when ``100 * intersection >= percent * union``. The result is
exact: no link between different sets is lost, and components follow from the
links alone. Equal sets form one class and are compared as one.

Candidates. Sizes are cut into bands. Linked sets of a band differ in a bounded
number of n-grams, so of more parts than that, cut by hash value, at least one is
equal in both. A key is made of each part, and only sets with a common key are
compared. A set of a size that links into the next band has that band's keys too.
Parts without n-grams give no key; some spare parts make up for them, and a set
with more empty parts than spare ones adds its prefix, the n-grams of least hash,
one of which any two linked sets share.

Verification. Every class is first compared with one hub, the least class of any
of its groups, which settles most groups of true copies with a pair for each
class. Groups that still span several components are compared in tiles of
bitmaps only, sorted by size and limited to the band of sizes that can link: the
bitmaps bound each overlap from above by their bit counts. Of the pairs that
pass, as many as would connect a tile are intersected exactly; members that
could link and are not connected then are brought together with their texts and
compared in full. Large groups are split into pairs of tiles for many tasks.

Words are runs of non-space bytes, A to Z in lower case. With fewer words than
``n`` the whole sequence is the only n-gram. Texts that are null, empty or blank
have an empty set and link with nothing. Rows with a null key link with nothing
and have a null component. Rows that repeat a key are compared each; the
component of a row is the least key of the rows it reaches. Empty tables give
empty results. N-grams and sets are told apart by 64-bit hashes. Other columns, of
whatever name, are ignored, and texts of any length are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from martflow.llm import bytes as raw
from martflow.llm.components import connected
from martflow.llm.passages import anchor_blocks, numbered
from martflow.llm.stored import stored

BAND_RATIO = 1.5
BITMAP_BITS = 2048
# N-grams that are compared with a hub, or with each other, at once.
TILE_GRAMS = 1 << 20

_HALF = np.uint64(32)
_LOW = np.uint64(0xFFFFFFFF)


def word_sets(data: np.ndarray, offsets: np.ndarray, n: int) -> list[np.ndarray]:
    """The sorted distinct n-gram hashes of each row."""
    data = raw.lower_ascii(data)
    starts, ends, begin = raw.words(data, offsets)
    codes = raw.word_hashes(data, starts, ends)
    grams = raw.gram_hashes(codes, np.arange(max(len(codes) - n + 1, 0)), n)
    out = []
    for first, last in zip(begin[:-1].tolist(), begin[1:].tolist(), strict=True):
        if last - first >= n:
            own = np.sort(grams[first : last - n + 1])
            out.append(own[np.append(True, own[1:] != own[:-1])])
        elif last > first:
            out.append(raw.gram_hashes(codes, np.array([first]), last - first))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def class_of(grams: np.ndarray) -> int:
    """A hash of a set, as a signed number."""
    total = raw.mix(grams).sum(dtype=np.uint64) + np.uint64(len(grams))
    return int(raw.mix(total[None]).view(np.int64)[0])


class Bands:
    """Bands of sizes, and the parts that sets of a band are cut into."""

    def __init__(self, percent: int):
        self.percent = percent
        self.lows = [1]

    def low(self, band: int) -> int:
        """The least size of a band; bands reach as far as sizes need."""
        while len(self.lows) <= band:
            last = self.lows[-1]
            self.lows.append(max(last + 1, int(np.ceil(last * BAND_RATIO))))
        return self.lows[band]

    def of(self, size: int) -> int:
        while self.lows[-1] <= size:
            self.low(len(self.lows))
        return int(np.searchsorted(self.lows, size, "right")) - 1

    def parts(self, band: int) -> tuple[int, int]:
        """How many n-grams linked sets of a band may differ in, and spare parts."""
        most = self.low(band + 1) - 1
        apart = (100 - self.percent) * 2 * most // (100 + self.percent)
        # somewhat more spare parts than the smallest sets of the band leave empty
        share = np.exp(-self.low(band) / (apart + 1))
        return apart, 2 + int(np.ceil(share * (apart + 1) * 1.5))

    def keys(self, grams: np.ndarray) -> np.ndarray:
        """The keys of a set: linked but different sets have one in common."""
        size = len(grams)
        if not size:
            return grams
        own = self.of(size)
        found = [self._band_keys(grams, own)]
        if 100 * size >= self.percent * self.low(own + 1):
            found.append(self._band_keys(grams, own + 1))
        return np.concatenate(found)

    def _band_keys(self, grams: np.ndarray, band: int) -> np.ndarray:
        apart, spare = self.parts(band)
        if not apart:
            return grams[:0]
        count = apart + 1 + spare
        part = ((grams >> _HALF) * np.uint64(count)) >> _HALF
        number, first = np.unique(part, return_index=True)
        sums = np.add.reduceat(raw.mix(grams), first)
        tag = np.uint64((band + 1) * 0x9E3779B97F4A7C15 & raw.MASK)
        keys = raw.mix(sums + raw.mix(number + tag))
        if count - len(number) > spare:
            prefix = len(grams) - -(-len(grams) * self.percent // 100) + 1
            keys = np.append(keys, raw.mix(grams[:prefix] ^ tag))
        return keys


def set_table(rows: DataFrame, n: int) -> DataFrame:
    """``uid``, ``doc``, ``n_grams`` and ``class`` of :func:`numbered` rows."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in raw.blocks(batches, "text"):
            sets = word_sets(data, offsets, n)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("uid"),
                    batch.column("doc").cast(pa.int64()),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([class_of(s) for s in sets], pa.int64()),
                ],
                ["uid", "doc", "n_grams", "class"],
            )

    return rows.mapInArrow(scan, "uid long, doc long, n_grams long, class long")


def key_table(rows: DataFrame, n: int, percent: int) -> DataFrame:
    """``key`` and ``class`` of the sets that may link with others."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands = Bands(percent)
        for _, data, offsets in raw.blocks(batches, "text"):
            keys, classes = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
            for grams in word_sets(data, offsets, n):
                own = bands.keys(grams)
                if len(own):
                    keys.append(own)
                    classes.append(np.full(len(own), class_of(grams)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.concatenate(classes))],
                ["key", "class"],
            )

    return rows.select("text").mapInArrow(scan, "key long, class long")


def bitmap(grams: np.ndarray) -> np.ndarray:
    """A hashed bitmap of a set, as words of 64 bits.

    It has two bits at least for each n-gram, a power of two in all.
    """
    bits = max(BITMAP_BITS, 1 << int(2 * len(grams) - 1).bit_length()) if len(grams) else BITMAP_BITS
    held = np.zeros(bits, bool)
    held[(grams & np.uint64(bits - 1)).astype(np.int64)] = True
    return np.packbits(held, bitorder="little").view(np.uint64)


def folded(bits: np.ndarray, words: int) -> np.ndarray:
    """The bitmap of the same set with fewer words."""
    return np.bitwise_or.reduce(bits.reshape(-1, words), axis=0)


def overlap_bounds(
    size: int, bits: np.ndarray, sizes: np.ndarray, bitmaps: np.ndarray
) -> np.ndarray:
    """No overlap of a set with others is larger than these numbers.

    Each bit set in one bitmap only stands for at least one n-gram of one set only.
    """
    only = np.bitwise_count(bits & ~bitmaps).sum(axis=1, dtype=np.int64)
    other = np.bitwise_count(bitmaps & ~bits).sum(axis=1, dtype=np.int64)
    return np.minimum(size - only, sizes - other)


def links(one: np.ndarray, other: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets are similar enough."""
    if len(one) > len(other):
        one, other = other, one
    place = np.minimum(np.searchsorted(other, one), max(len(other) - 1, 0))
    same = int((other[place] == one).sum()) if len(other) else 0
    return same > 0 and 100 * same >= percent * (len(one) + len(other) - same)


def _sets_of(table: pa.Table, n: int) -> list[np.ndarray]:
    """The sets of a table's texts, made a small block at a time."""
    out: list[np.ndarray] = []
    for _, data, offsets in raw.blocks(iter(table.select(["text"]).to_batches()), "text"):
        out += word_sets(data, offsets, n)
    return out


def _hub_links(table: pa.Table, n: int, percent: int) -> pa.RecordBatch:
    """Links of members with the hub of their group, whose row is marked."""
    group = table.column("anchor").to_numpy()
    lead = table.column("lead").to_numpy()
    classes = table.column("class").to_numpy()
    grams = _sets_of(table, n)
    found = []
    hub = {g: (grams[i], bitmap(grams[i]), i) for i, g in enumerate(group.tolist()) if lead[i]}
    for i, g in enumerate(group.tolist()):
        if lead[i] or g not in hub:
            continue
        own, bits, h = hub[g]
        sizes, other = np.array([len(grams[i])]), bitmap(grams[i])
        words = min(len(bits), len(other))
        bound = overlap_bounds(len(own), folded(bits, words), sizes, folded(other, words)[None])[0]
        enough = 100 * bound >= percent * (len(own) + len(grams[i]) - bound)
        if enough and links(own, grams[i], percent):
            found.append((classes[h], classes[i]))
    a, b = np.array(found, np.int64).reshape(-1, 2).T
    return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])


class Tile:
    """Members of a tile by size, with bitmaps that bound their overlaps.

    With two tiles, only pairs of one member of each are compared; pairs within one of
    the components known so far, ``parts``, are passed over.
    """

    def __init__(self, sizes, parts, tiles, maps: list[np.ndarray], percent: int):
        self.order = np.argsort(sizes, kind="stable")
        self.sizes, self.parts = sizes[self.order], parts[self.order].copy()
        self.tiles, self.percent = tiles[self.order], percent
        self.across = len(set(tiles.tolist())) > 1
        self.maps = [maps[i] for i in self.order]
        self.words = np.array([len(m) for m in self.maps])
        self._folded: dict[int, np.ndarray] = {}

    def _of_width(self, words: int) -> np.ndarray:
        """The bitmaps of all members that are as wide, or that can be folded to it."""
        if words not in self._folded:
            table = np.zeros((len(self.maps), words), np.uint64)
            for i in np.flatnonzero(self.words >= words).tolist():
                table[i] = folded(self.maps[i], words)
            self._folded[words] = table
        return self._folded[words]

    def partners(self, i: int, parts: np.ndarray) -> np.ndarray:
        """Members after ``i``, of other parts, that may link with it, likeliest first."""
        size = int(self.sizes[i])
        last = np.searchsorted(self.sizes, size * 100 // self.percent, "right")
        rest = np.arange(i + 1, last)
        rest = rest[parts[rest] != parts[i]]
        if self.across:
            rest = rest[self.tiles[rest] != self.tiles[i]]
        if not len(rest):
            return rest
        maps = self._of_width(int(self.words[i]))
        bound = overlap_bounds(size, maps[i], self.sizes[rest], maps[rest])
        good = 100 * bound >= self.percent * (size + self.sizes[rest] - bound)
        return rest[good][np.argsort(-bound[good], kind="stable")]


def likely_links(tile: Tile) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Which members may link with some other, and likely links that would join them all.

    There are fewer likely links than members: a pair that the links so far would
    connect is left out, as it needs no link of its own if they hold.
    """
    open_ = np.zeros(len(tile.order), bool)
    joined, pairs = tile.parts.copy(), []
    for i in range(len(tile.order)):
        partners = tile.partners(i, tile.parts)
        if len(partners):
            open_[tile.order[i]] = True
            open_[tile.order[partners]] = True
        for j in partners.tolist():
            if joined[j] != joined[i]:
                pairs.append((int(tile.order[i]), int(tile.order[j])))
                joined[joined == joined[j]] = joined[i]
    return open_, pairs


def tile_links(tile: Tile, grams: list[np.ndarray]) -> list[tuple[int, int]]:
    """Links that join the parts of a tile: one settles a whole part."""
    parts, pairs = tile.parts, []
    for i in range(len(tile.order)):
        one = tile.order[i]
        for j in tile.partners(i, parts).tolist():
            other = tile.order[j]
            if parts[j] != parts[i] and links(grams[one], grams[other], tile.percent):
                pairs.append((int(one), int(other)))
                parts[parts == parts[j]] = parts[i]
    return pairs


def _groups(table: pa.Table) -> Iterator[slice]:
    """The rows of each anchor of a sorted block."""
    group = table.column("anchor").to_numpy()
    bounds = np.flatnonzero(np.append(True, group[1:] != group[:-1])).tolist() + [len(group)]
    for low, high in zip(bounds[:-1], bounds[1:], strict=True):
        yield slice(low, high)


LIKELY = "anchor long, tile int, class long, a long, b long"


def _likely(table: pa.Table, percent: int) -> pa.RecordBatch:
    """Members of tiles that may still link, and the links to try first."""
    anchor, tiles = table.column("anchor").to_numpy(), table.column("tile").to_numpy()
    classes, parts = table.column("class").to_numpy(), table.column("part").to_numpy()
    sizes = table.column("n_grams").to_numpy()
    maps = [np.frombuffer(m, np.uint64) for m in table.column("bits").to_pylist()]
    rows, pairs = [np.zeros(0, np.int64)], []
    for own in _groups(table):
        tile = Tile(sizes[own], parts[own], tiles[own], maps[own], percent)
        open_, found = likely_links(tile)
        rows.append(np.flatnonzero(open_) + own.start)
        pairs += [(classes[own.start + i], classes[own.start + j]) for i, j in found]
    row = np.concatenate(rows)
    a, b = np.array(pairs, np.int64).reshape(-1, 2).T
    none, more = pa.nulls(len(row), pa.int64()), pa.nulls(len(a), pa.int64())
    return pa.RecordBatch.from_arrays(
        [
            pa.concat_arrays([pa.array(anchor[row]), more]),
            pa.concat_arrays([pa.array(tiles[row]), more.cast(pa.int32())]),
            pa.concat_arrays([pa.array(classes[row]), more]),
            pa.concat_arrays([none, pa.array(a)]),
            pa.concat_arrays([none, pa.array(b)]),
        ],
        ["anchor", "tile", "class", "a", "b"],
    )


def _tiled(table: pa.Table, n: int, percent: int) -> pa.RecordBatch:
    """Links within the tiles, or pairs of tiles, of a block."""
    classes, parts = table.column("class").to_numpy(), table.column("part").to_numpy()
    tiles = table.column("tile").to_numpy()
    grams = _sets_of(table, n)
    found: list[tuple[int, int]] = []
    for own in _groups(table):
        sets = grams[own]
        sizes = np.array([len(g) for g in sets], np.int64)
        tile = Tile(sizes, parts[own], tiles[own], [bitmap(g) for g in sets], percent)
        found += [(classes[own.start + i], classes[own.start + j]) for i, j in tile_links(tile, sets)]
    a, b = np.array(found, np.int64).reshape(-1, 2).T
    return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])


def _in_blocks(df: DataFrame, look, schema: str = "a long, b long") -> DataFrame:
    """Bring the rows of each anchor together and apply ``look`` to blocks of them."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in anchor_blocks(batches):
            yield look(table)

    return df.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(scan, schema)


def class_texts(rows: DataFrame, example: DataFrame) -> DataFrame:
    """``class``, ``n_grams`` and one text of each class, by the uid of an example.

    Texts are smaller than their sets, which the tasks make again.
    """
    named = rows.select("uid", "text").join(example, "uid")
    one = named.groupBy("class").agg(F.first("n_grams").alias("n_grams"), F.first("text").alias("text"))
    return stored(one)


def class_bitmaps(texts: DataFrame, n: int) -> DataFrame:
    """``class``, ``n_grams`` and ``bits``, the bitmap of each class."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in raw.blocks(batches, "text"):
            maps = [bitmap(g).tobytes() for g in word_sets(data, offsets, n)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("class"), batch.column("n_grams"), pa.array(maps, pa.binary())],
                ["class", "n_grams", "bits"],
            )

    return stored(texts.mapInArrow(scan, "class long, n_grams long, bits binary"))


def compared_links(pairs: DataFrame, texts: DataFrame, n: int, percent: int) -> DataFrame:
    """Those of the pairs ``hub``, ``class`` that link, as ``a``, ``b``.

    The members of a hub are dealt to as many blocks as their size asks for, and each
    gets the text of the hub.
    """
    sizes = texts.select("class", "n_grams")
    weights = pairs.join(sizes, "class").groupBy("hub")
    salts = weights.agg(F.ceil(F.sum("n_grams") / TILE_GRAMS).cast("int").alias("salts"))
    hubs = salts.select(
        F.col("hub").alias("class"),
        "hub",
        F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"),
        F.lit(True).alias("lead"),
    )
    members = pairs.join(salts, "hub").select(
        "class",
        "hub",
        F.pmod(F.xxhash64("class"), F.col("salts")).cast("int").alias("salt"),
        F.lit(False).alias("lead"),
    )
    teams = hubs.unionByName(members).select(
        "class", F.xxhash64("hub", "salt").alias("anchor"), "lead"
    )
    brought = teams.join(texts.select("class", "text"), "class")
    return stored(_in_blocks(brought, lambda table: _hub_links(table, n, percent)).distinct())


def shared_keys(rows: DataFrame, n: int, percent: int, rounds: int) -> DataFrame:
    """Keys that several classes have, with these classes.

    Keys are taken in ``rounds`` slices of their values, one after the other, so
    that only one slice of them is on disk at a time.
    """
    out = None
    for number in range(rounds):
        keys = key_table(rows, n, percent).where(F.pmod("key", F.lit(rounds)) == number)
        several = keys.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
        # Joined as stored tables, so that Spark can split the rows of a hot key.
        part = stored(keys.join(stored(several), "key", "left_semi"))
        part = stored(part.distinct())
        out = part if out is None else out.unionByName(part)
    return out


def class_links(rows: DataFrame, sets: DataFrame, n: int, percent: int, rounds: int) -> DataFrame:
    """Links ``a``, ``b`` of classes from which all components follow."""
    shared = shared_keys(rows, n, percent, rounds)
    groups = shared.groupBy("key").agg(
        F.min("class").alias("hub"), F.max("class").alias("last"), F.count("*").alias("members")
    )
    groups = stored(groups.where("hub < last"))
    joined = shared.join(groups, "key")
    pairs = joined.where("class <> hub").groupBy("class").agg(F.min("hub").alias("hub"))
    pairs = stored(pairs.select("hub", "class"))

    wanted = joined.select("class").distinct()
    example = sets.groupBy("class").agg(
        F.min("uid").alias("uid"), F.first("n_grams").alias("n_grams")
    )
    texts = class_texts(rows, example.join(wanted, "class"))
    near = compared_links(pairs, texts, n, percent)

    # What is left: groups that still span several components.
    parts = connected(near)
    placed = joined.join(texts.select("class", "n_grams"), "class").join(
        parts.withColumnRenamed("node", "class"), "class", "left"
    )
    part = F.coalesce("component", "class").alias("part")
    placed = placed.select("key", "hub", "last", "class", "members", "n_grams", part)
    settled = pairs.select(F.col("class").alias("last"), F.col("hub").alias("compared"))
    open_groups = (
        placed.groupBy("key", "hub", "last", "members")
        .agg(
            F.min("part").alias("low"),
            F.max("part").alias("high"),
            F.sum("n_grams").alias("weight"),
            F.bit_xor(F.xxhash64("class")).alias("one"),
            F.sum(F.xxhash64("class").cast("decimal(38,0)")).alias("other"),
        )
        .where("low < high")
        # a group of two is settled if they have been compared
        .join(settled, "last", "left")
        .where("members > 2 or compared is null or compared <> hub")
    )
    # Groups of the same members need to be compared once.
    open_groups = open_groups.groupBy("members", "one", "other").agg(
        F.min("key").alias("key"), F.first("weight").alias("weight")
    )
    open_groups = open_groups.select(
        "key", F.ceil(F.col("weight") / TILE_GRAMS).cast("int").alias("tiles")
    )
    tiled = placed.join(open_groups, "key").withColumn(
        "own", F.pmod(F.xxhash64("class", F.lit(1)), F.col("tiles")).cast("int")
    )
    tiled = tiled.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    tiled = tiled.select(
        F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other")).alias("anchor"),
        F.when(F.col("own") > F.col("other"), 1).otherwise(0).alias("tile"),
        "class",
        "part",
    ).join(class_bitmaps(texts, n), "class")
    likely = stored(_in_blocks(tiled, lambda table: _likely(table, percent), LIKELY))

    # Texts go to the likely links first, and then to what these have not joined.
    first = likely.where("a IS NOT NULL").select(F.col("a").alias("hub"), F.col("b").alias("class"))
    near = near.unionByName(compared_links(stored(first.distinct()), texts, n, percent))
    rest = likely.where("class IS NOT NULL").select("anchor", "tile", "class")
    rest = rest.join(connected(near).withColumnRenamed("node", "class"), "class", "left")
    rest = stored(rest.select("anchor", "tile", "class", F.coalesce("component", "class").alias("part")))
    apart = rest.groupBy("anchor").agg(F.min("part").alias("low"), F.max("part").alias("high"))
    rest = stored(rest.join(apart.where("low < high").select("anchor"), "anchor", "left_semi"))
    brought = gathered_tiles(rest, texts).join(texts.select("class", "text"), "class")
    last = _in_blocks(brought, lambda table: _tiled(table, n, percent))
    return near.unionByName(stored(last.distinct()))


def gathered_tiles(tiles: DataFrame, texts: DataFrame) -> DataFrame:
    """The tiles ``anchor, tile, class, part`` with as few repetitions of a class as fit.

    The same members meet in tile after tile. Tiles that share members are put together
    to one, if their members fit into it: then each class comes once. Of others, tiles
    of the same members are kept once. No pair of members that met is parted.
    """
    hubs = tiles.groupBy("anchor").agg(F.min("class").alias("hub"))
    met = tiles.join(hubs, "anchor").select(F.col("class").alias("a"), F.col("hub").alias("b"))
    groups = connected(met.distinct()).withColumnRenamed("node", "class")
    weights = groups.join(texts.select("class", "n_grams"), "class").groupBy("component")
    weights = weights.agg(F.sum("n_grams").alias("weight"))
    placed = tiles.join(groups, "class").join(weights, "component")
    placed = stored(placed.withColumn("fits", F.col("weight") <= TILE_GRAMS // 4))
    whole = placed.where("fits").select(
        F.xxhash64("component").alias("anchor"), F.lit(0).alias("tile"), "class", "part"
    )
    large = placed.where("NOT fits").select("anchor", "tile", "class", "part")
    marks = [F.xxhash64("class", "tile"), F.xxhash64(F.lit(1), "class", "tile").cast("decimal(38,0)")]
    kinds = large.groupBy("anchor").agg(
        F.count("*").alias("n"), F.bit_xor(marks[0]).alias("one"), F.sum(marks[1]).alias("other")
    )
    once = kinds.groupBy("n", "one", "other").agg(F.min("anchor").alias("anchor"))
    return whole.distinct().unionByName(large.join(once.select("anchor"), "anchor", "left_semi"))


def jaccard_components(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    n: int = 3,
    percent: int = 90,
    rounds: int = 2,
) -> DataFrame:
    """Per row: key, ``n_shingles`` and ``component_id``."""
    rows = numbered(df, key, text)
    sets = stored(set_table(rows, n))
    linkable = sets.where("doc is not null and n_grams > 0")
    known = rows.where(F.col("doc").isNotNull())
    parts = connected(class_links(known, linkable, n, percent, rounds))
    placed = linkable.groupBy("class").agg(F.min("doc").alias("first")).join(
        parts.withColumnRenamed("node", "class"), "class", "left"
    )
    placed = placed.withColumn("component", F.coalesce("component", "class"))
    least = placed.groupBy("component").agg(F.min("first").alias("component_id"))
    named = stored(placed.join(least, "component").select("class", "component_id"))
    return sets.join(named, "class", "left").select(
        F.col("doc").cast(df.schema[key].dataType).alias(key),
        F.col("n_grams").alias("n_shingles"),
        F.when(F.col("doc").isNull() | (F.col("n_grams") == 0), F.col("doc"))
        .otherwise(F.col("component_id"))
        .alias("component_id"),
    )


def one_of_each(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    n: int = 5,
    percent: int = 80,
    rounds: int = 4,
) -> DataFrame:
    """The row of least key of each component; rows with null keys all stay.

    Rows that repeat a key stay if that key does. Sets of lower similarity have
    more keys, hence the larger number of rounds.
    """
    found = jaccard_components(df, key, text, n, percent, rounds)
    gone = found.where(F.col(key) != F.col("component_id")).select(key).distinct()
    return df.join(gone, key, "left_anti").select(*df.columns)
