"""Near-duplicate embeddings by E8 lattice hashing.

Unit vectors are projected at random into blocks of eight dimensions and each
block is decoded to its nearest point of the E8 lattice. The points of
``BLOCKS`` blocks together are a cell; ``TABLES`` independent tables of cells are
kept. A vector lies in its own cell of each table and probes the ``PROBES``
neighbouring cells that it is closest to. Two vectors meet where the own cell of
one is an own or probed cell of the other. Pairs that meet are compared by cosine
in double precision, so no pair below the threshold is ever linked. Pairs above
it are missed only if they meet in no table; the tests measure how often.

Equal vectors form a class, which is hashed and compared once. Cells with many
classes are split into pairs of tiles for many tasks. A pair that meets in
several cells is counted in the first of them only; tasks return counts of links
and the least class that each class reaches within a block, never the pairs
themselves. So components follow from all links.

Vectors that are null or zero, or hold null or non-finite components, link with
nothing, as do rows without a key. Vectors of different length never link. Rows
that repeat a key are compared each. Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from martflow.llm import bytes as raw
from martflow.llm.components import connected
from martflow.llm.passages import anchor_blocks
from martflow.llm.stored import stored

TABLES = 16
BLOCKS = 2
PROBES = 5
# Length in projected space that one unit of the lattice stands for.
SCALE = 1.5
TILE_ROWS = 1_000


def _flips(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Close points of D8 (integers of even sum): points and squared distances.

    The result has four candidates for each row, not in order of distance.
    """
    near = np.rint(x)
    error = x - near
    order = np.argsort(-np.abs(error), axis=1)
    rows = np.arange(len(x))
    odd = near.sum(axis=1).astype(np.int64) & 1
    # Even sums: the rounded point, or with two of the worst roundings turned.
    # Odd sums: one of the worst roundings turned.
    choices = (((), (0, 1), (0, 2), (1, 2)), ((0,), (1,), (2,), (3,)))
    points = np.repeat(near[:, None, :], 4, axis=1)
    for parity in (0, 1):
        own = rows[odd == parity]
        for number, turned in enumerate(choices[parity]):
            for worst in turned:
                place = order[own, worst]
                step = np.where(error[own, place] >= 0, 1.0, -1.0)
                points[own, number, place] += step
    return points, ((x[:, None, :] - points) ** 2).sum(axis=2)


def close_points(x: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` closest of some near E8 points, doubled to be integers.

    E8 is D8 and D8 shifted by a half in every dimension. The first point is the
    nearest one of the lattice.
    """
    whole, far = _flips(x)
    half, far_half = _flips(x - 0.5)
    points = np.concatenate([2 * whole, 2 * half + 1], axis=1)
    far = np.concatenate([far, far_half], axis=1)
    order = np.argsort(far, axis=1, kind="stable")[:, :count]
    rows = np.arange(len(x))[:, None]
    return points[rows, order].astype(np.int64), far[rows, order]


def cells(units: np.ndarray, tables: int = TABLES, probes: int = PROBES) -> np.ndarray:
    """Cell hashes by row, table, and own cell followed by probed ones."""
    count, size = units.shape
    out = np.zeros((count, tables, probes + 1), np.int64)
    per_block = 4
    combos = np.stack(
        np.meshgrid(*[np.arange(per_block)] * BLOCKS, indexing="ij"), axis=-1
    ).reshape(-1, BLOCKS)
    for table in range(tables):
        rng = np.random.default_rng([size, table])
        codes, far = [], np.zeros((count, len(combos)))
        for block in range(BLOCKS):
            turn = rng.standard_normal((size, 8)) / SCALE
            shift = rng.uniform(0, 2, 8)
            points, distance = close_points(units @ turn + shift, per_block)
            code = np.zeros(points.shape[:2], np.uint64)
            for axis in range(8):
                code = raw.mix(code + points[:, :, axis].astype(np.uint64) + np.uint64(axis + 1))
            codes.append(code)
            far += distance[:, combos[:, block]]
        order = np.argsort(far, axis=1, kind="stable")[:, : probes + 1]
        rows = np.arange(count)[:, None]
        key = np.full(order.shape, (size * 1000 + table) & raw.MASK, np.uint64)
        for block in range(BLOCKS):
            key = raw.mix(key + codes[block][rows, combos[order, block]])
        out[:, table] = key.view(np.int64)
    return out


def unit_vectors(column: pa.Array) -> list[np.ndarray | None]:
    """Vectors of length one in double precision; None where there is none."""
    out: list[np.ndarray | None] = []
    for value in column:
        own = value.as_py()
        if not own or None in own:
            out.append(None)
            continue
        vector = np.array(own, np.float64)
        size = np.abs(vector).max()
        if not np.isfinite(vector).all() or size == 0:
            out.append(None)
            continue
        vector = vector / size
        out.append(vector / np.linalg.norm(vector))
    return out


def cell_table(classes: DataFrame) -> DataFrame:
    """``class``, ``copies``, the unit vector as bytes, and its cells."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                units = unit_vectors(batch.column("vector"))
                by_size: dict[int, list[int]] = {}
                for i, unit in enumerate(units):
                    if unit is not None:
                        by_size.setdefault(len(unit), []).append(i)
                for rows in by_size.values():
                    block = np.stack([units[i] for i in rows])
                    code = cells(block).reshape(len(rows), -1)
                    taken = pa.array(rows)
                    lists = pa.FixedSizeListArray.from_arrays(pa.array(code.ravel()), code.shape[1])
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column("class").take(taken),
                            batch.column("copies").take(taken),
                            pa.array([u.tobytes() for u in block], pa.binary()),
                            lists.cast(pa.list_(pa.int64())),
                        ],
                        ["class", "copies", "unit", "cells"],
                    )

    return classes.mapInArrow(scan, "class long, copies long, unit binary, cells array<long>")


def _first_meeting(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """The first cell in which each pair meets; rows by table and cell."""
    out = np.zeros(len(one), np.int64)
    left = np.arange(len(one))
    for table in range(one.shape[1]):
        a, b = one[left, table], other[left, table]
        in_b = (b == a[:, :1]).any(axis=1)
        in_a = (a == b[:, :1]).any(axis=1)
        cell = np.where(in_b & in_a, np.minimum(a[:, 0], b[:, 0]), np.where(in_b, a[:, 0], b[:, 0]))
        met = in_a | in_b
        out[left[met]] = cell[met]
        left = left[~met]
        if not len(left):
            break
    return out


def _joined(root: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The least member of each component, with some more links between members."""
    while True:
        a, b = root[i], root[j]
        apart = a != b
        if not apart.any():
            return root
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        root = root.copy()
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while not np.array_equal(up := root[root], root):
            root = up


def _compared(table: pa.Table, threshold: float) -> pa.RecordBatch:
    """Link counts of the classes of each cell in a block, and what they reach there."""
    anchors = table.column("anchor").to_numpy()
    keys, tiles = table.column("cell").to_numpy(), table.column("tile").to_numpy()
    own, classes = table.column("own").to_numpy(), table.column("class").to_numpy()
    copies = table.column("copies").to_numpy()
    units, codes = table.column("unit"), table.column("cells")
    bounds = np.flatnonzero(np.append(True, anchors[1:] != anchors[:-1])).tolist()
    out: list[np.ndarray] = []
    for low, high in zip(bounds, [*bounds[1:], len(anchors)], strict=True):
        x = np.stack([np.frombuffer(units[i].as_py()) for i in range(low, high)])
        code = np.stack([codes[i].values.to_numpy() for i in range(low, high)])
        code = code.reshape(high - low, TABLES, -1)
        part = tiles[low:high]
        first, second = np.flatnonzero(part == 0), np.flatnonzero(part == 1)
        if not len(second):
            second = first
        elif not len(first):
            first = second
        within = first is second
        add = np.zeros(high - low, np.int64)
        # Members by rank of their class: the least rank stands for a component.
        by_rank = np.argsort(classes[low:high], kind="stable")
        rank = np.argsort(by_rank)
        root = np.arange(high - low)
        linked = np.zeros(high - low, bool)
        for at in range(0, len(first), TILE_ROWS):
            some = first[at : at + TILE_ROWS]
            for to in range(0, len(second), TILE_ROWS):
                others = second[to : to + TILE_ROWS]
                i, j = np.nonzero(x[some] @ x[others].T >= threshold)
                i, j = some[i], others[j]
                good = own[low + i] | own[low + j]
                good &= classes[low + i] != classes[low + j]
                if within:
                    good &= i < j
                i, j = i[good], j[good]
                if not len(i):
                    continue
                linked[i] = linked[j] = True
                root = _joined(root, rank[i], rank[j])
                for cut in range(0, len(i), 200_000):
                    a, b = i[cut : cut + 200_000], j[cut : cut + 200_000]
                    counted = _first_meeting(code[a], code[b]) == keys[low + a]
                    np.add.at(add, a[counted], copies[low + b[counted]])
                    np.add.at(add, b[counted], copies[low + a[counted]])
        some = np.flatnonzero(linked)
        least = classes[low + by_rank[root[rank[some]]]]
        out.append(np.stack([classes[low + some], add[some], least]))
    found = np.concatenate(out, axis=1) if out else np.zeros((3, 0), np.int64)
    return pa.RecordBatch.from_arrays([pa.array(x) for x in found], ["class", "add", "least"])


def near_duplicates(
    df: DataFrame, key: str = "vec_id", vector: str = "embedding", threshold: float = 0.95
) -> DataFrame:
    """Per row: key, ``n_links``, ``component_id`` and ``kept``."""
    rows = df.select(df[key].alias("id"), df[vector].alias("vector"))
    # -0.0 and 0.0 are equal, and hashed alike.
    rows = rows.withColumn(
        "class", F.xxhash64(F.transform("vector", lambda v: v + F.lit(0).cast("float")))
    )
    known = rows.where("id is not null and vector is not null")
    classes = known.groupBy("class").agg(
        F.count("*").alias("copies"), F.first("vector").alias("vector")
    )
    coded = stored(cell_table(classes))
    members = coded.select("class", F.posexplode("cells").alias("place", "cell")).select(
        "class", "cell", (F.col("place") % (PROBES + 1) == 0).alias("own")
    )
    members = members.groupBy("class", "cell").agg(F.max("own").alias("own"))
    crowded = (
        members.groupBy("cell")
        .agg(F.count("*").alias("n"), F.max("own").alias("any_own"))
        .where("n > 1 and any_own")
        .select("cell", F.ceil(F.col("n") / TILE_ROWS).cast("int").alias("tiles"))
    )
    met = members.join(crowded, "cell").withColumn(
        "mine", F.pmod(F.xxhash64("class", F.lit(1)), F.col("tiles")).cast("int")
    )
    met = met.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))).select(
        F.xxhash64("cell", F.least("mine", "other"), F.greatest("mine", "other")).alias("anchor"),
        F.when(F.col("mine") > F.col("other"), 1).otherwise(0).alias("tile"),
        "cell",
        "own",
        "class",
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in anchor_blocks(batches):
            yield _compared(table, threshold)

    compared = (
        met.join(coded, "class")
        .repartition("anchor")
        .sortWithinPartitions("anchor")
        .mapInArrow(compare, "class long, add long, least long")
    )
    compared = stored(compared.groupBy("class", "least").agg(F.sum("add").alias("add")))
    parts = connected(compared.select(F.col("class").alias("a"), F.col("least").alias("b")))
    counts = compared.groupBy("class").agg(F.sum("add").alias("add"))
    ids = known.groupBy("class").agg(F.min("id").alias("first"))
    placed = (
        coded.select("class", "copies")
        .join(ids, "class")
        .join(counts, "class", "left")
        .join(parts.withColumnRenamed("node", "class"), "class", "left")
        .withColumn("component", F.coalesce("component", "class"))
    )
    least = placed.groupBy("component").agg(F.min("first").alias("component_id"))
    named = stored(placed.join(least, "component").select(
        "class",
        (F.col("copies") - 1 + F.coalesce("add", F.lit(0))).alias("links"),
        "component_id",
    ))
    usable = F.col("id").isNotNull() & F.col("vector").isNotNull()
    out = rows.select("id", F.when(usable, F.col("class")).alias("class")).join(
        named, "class", "left"
    )
    component = F.coalesce("component_id", "id")
    return out.select(
        F.col("id").alias(key),
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"),
    )
