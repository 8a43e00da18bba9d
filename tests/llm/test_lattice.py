"""Lattice hashing: nearest points, recall against brute force, exact counts."""

from itertools import product

import numpy as np
import pyarrow as pa
import pytest

from martflow.llm import lattice
from martflow.llm.queries import QUERIES

DATA = "/root/testdata/sf0.01"


def test_first_point_is_the_nearest_of_the_lattice():
    rng = np.random.default_rng(1)
    x = rng.uniform(-1, 1, (40, 8))
    points, far = lattice.close_points(x, 4)
    doubled = [p for p in product((-2, 0, 2), repeat=8) if sum(p) % 4 == 0]
    doubled += [p for p in product((-1, 1), repeat=8) if sum(p) % 4 == 0]
    doubled += [p for p in product((-3, -1, 1, 3), repeat=8) if sum(p) % 4 == 0 and max(map(abs, p)) == 3]
    every = np.array(doubled) / 2
    best = np.array([((every - row) ** 2).sum(axis=1).min() for row in x])
    np.testing.assert_allclose(far[:, 0], best)
    assert (points.sum(axis=2) % 4 == 0).all() and (np.diff(far, axis=1) >= 0).all()


def plain(rows, threshold=0.95):
    """Links and components by comparing all pairs."""
    units = []
    for _, v in rows:
        good = bool(v) and None not in v and np.isfinite(v).all() and np.any(v)
        units.append(np.array(v, float) / np.linalg.norm(np.array(v, float)) if good else None)
    root, count = list(range(len(rows))), [0] * len(rows)

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(units):
        for j in range(i):
            b = units[j]
            if a is None or b is None or len(a) != len(b):
                continue
            if rows[i][1] == rows[j][1] or a @ b >= threshold:
                count[i] += 1
                count[j] += 1
                root[find(i)] = find(j)
    least = {}
    for i, (k, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), k), k)
    return sorted((k, count[i], least[find(i)], k == least[find(i)]) for i, (k, _) in enumerate(rows))


def found(spark, rows):
    df = spark.createDataFrame(
        [(k, v, "x") for k, v in rows], "vec_id long, embedding array<float>, class string"
    ).repartition(3)
    out = lattice.near_duplicates(df).collect()
    return sorted((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in out)


def near(rng, base, cos):
    other = rng.standard_normal(len(base))
    other -= (other @ base) * base
    return cos * base + np.sqrt(1 - cos * cos) * other / np.linalg.norm(other)


def clusters(seed, count, copies, low):
    rng = np.random.default_rng(seed)
    rows = []
    for _ in range(count):
        base = rng.standard_normal(32)
        base /= np.linalg.norm(base)
        rows.append(base)
        rows += [near(rng, base, c) for c in rng.uniform(low, 0.9999, copies)]
    rows = [np.float32(v).tolist() for v in rows]
    rows += rows[:10] + rows[:5]
    keys = rng.permutation(len(rows) * 2)[: len(rows)].tolist()
    return list(zip(keys, rows, strict=True))


@pytest.mark.parametrize("tile", [1000, 7])
def test_counts_of_close_clusters_are_exact(spark, monkeypatch, tile):
    monkeypatch.setattr(lattice, "TILE_ROWS", tile)
    rows = clusters(2, 8, 20, 0.995)
    assert found(spark, rows) == plain(rows)


def steps(rng, start, count, cos):
    """A chain of vectors, each linked with its neighbours only."""
    out, back = [start / np.linalg.norm(start)], np.zeros(len(start))
    for _ in range(count):
        side = rng.standard_normal(len(start))
        side -= (side @ out[-1]) * out[-1]
        side /= np.linalg.norm(side)
        # away from the vector before
        side = side - 4 * back
        side -= (side @ out[-1]) * out[-1]
        side /= np.linalg.norm(side)
        back = out[-1]
        out.append(cos * out[-1] + np.sqrt(1 - cos * cos) * side)
    return out


@pytest.mark.parametrize("tile", [1000, 7])
def test_components_follow_chains_and_bridges(spark, monkeypatch, tile):
    monkeypatch.setattr(lattice, "TILE_ROWS", tile)
    rng = np.random.default_rng(5)
    vectors = []
    for _ in range(20):
        vectors += steps(rng, rng.standard_normal(32), 25, 0.985)
    for _ in range(10):
        # two dense groups whose centres alone are linked: copies lean apart
        pair = steps(rng, rng.standard_normal(32), 1, 0.951)
        for centre, other in (pair, pair[::-1]):
            vectors.append(centre)
            away = (centre @ other) * centre - other
            away /= np.linalg.norm(away)
            for _ in range(30):
                side = near(rng, away, 0.7)
                side -= (side @ centre) * centre
                vectors.append(0.9995 * centre + np.sqrt(1 - 0.9995**2) * side / np.linalg.norm(side))
    keys = rng.permutation(len(vectors)).tolist()
    rows = [(k, np.float32(v).tolist()) for k, v in zip(keys, vectors, strict=True)]
    got, want = found(spark, rows), plain(rows)
    assert [(g[0], g[2]) for g in got] == [(w[0], w[2]) for w in want]


@pytest.mark.parametrize("tile", [1000, 2])
def test_a_chain_within_a_cell_is_one_component(monkeypatch, tile):
    monkeypatch.setattr(lattice, "TILE_ROWS", tile)
    turn = {1: 0, 4: 1, 3: 2, 2: 3}
    angle = np.array([turn[c] for c in (1, 2, 3, 4)]) * 0.3
    units = np.stack([np.cos(angle), np.sin(angle)], axis=1)
    size = lattice.TABLES * (lattice.PROBES + 1)
    table = pa.table(
        {
            "anchor": [9] * 4,
            "tile": [0] * 4,
            "cell": [7] * 4,
            "own": [True] * 4,
            "class": [1, 2, 3, 4],
            "copies": [1] * 4,
            "unit": pa.array([u.tobytes() for u in units], pa.binary()),
            "cells": [[7] * size] * 4,
        }
    )
    out = lattice._compared(table, 0.95).to_pydict()
    assert out == {"class": [1, 2, 3, 4], "add": [1, 1, 2, 2], "least": [1, 1, 1, 1]}


def test_recall_near_the_threshold(spark):
    rows = clusters(3, 120, 2, 0.95)
    got, want = found(spark, rows), plain(rows)
    assert all(g[1] <= w[1] for g, w in zip(got, want, strict=True))
    assert sum(g[1] for g in got) > 0.98 * sum(w[1] for w in want)


def test_cases(spark):
    one = [1.0, 2.0, 3.0]
    rows = [
        (1, one),
        (2, [2.0, 4.0, 6.0]),
        (2, [-1.0, -2.0, -3.0]),
        (3, None),
        (4, [0.0, 0.0, 0.0]),
        (5, [1.0, None, 3.0]),
        (6, [float("nan"), 1.0, 1.0]),
        (7, [float("inf"), 1.0, 1.0]),
        (8, []),
        (9, [1.0, 2.0]),
        (10, one),
        (11, [1e30, 2e30, 3e30]),
        (12, [-0.0, 1.0, 0.0]),
        (13, [0.0, 1.0, -0.0]),
    ]
    got = found(spark, rows)
    clean = [(k, [x + 0.0 for x in v] if v and None not in v else v) for k, v in rows]
    assert got == plain(clean)
    df = spark.createDataFrame([(None, one), (1, one)], "vec_id long, embedding array<float>")
    by = {r["vec_id"]: tuple(r)[1:] for r in lattice.near_duplicates(df).collect()}
    assert by == {None: (0, None, False), 1: (0, 1, True)}
    assert lattice.near_duplicates(df.limit(0)).count() == 0


def test_query(spark):
    table = spark.read.parquet(f"{DATA}/embeddings.parquet").collect()
    rows = [(r["vec_id"], r["embedding"]) for r in table]
    got = sorted(tuple(r) for r in QUERIES["op4_lattice"](spark, DATA).collect())
    want = plain(rows)
    assert [g[0] for g in got] == [w[0] for w in want]
    assert sum(g[1] for g in got) >= 0.9 * sum(w[1] for w in want)
