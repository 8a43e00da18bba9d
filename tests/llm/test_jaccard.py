"""The Jaccard join against all pairs, and its parts on their own."""

import random
import re

import duckdb
import numpy as np
import pytest

from martflow.llm import jaccard
from martflow.llm.components import connected
from martflow.llm.queries import ORACLES, QUERIES

DATA = "/root/testdata/sf0.01"


def shingles(text, n):
    low = re.sub("[A-Z]", lambda m: m.group(0).lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if len(words) < n:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}


def plain(rows, n, percent):
    sets = [shingles(t, n) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            same = len(sets[i] & sets[j])
            if (
                same
                and None not in (rows[i][0], rows[j][0])
                and 100 * same >= percent * len(sets[i] | sets[j])
            ):
                root[find(i)] = find(j)
    out = []
    for i, (d, _) in enumerate(rows):
        reached = [r[0] for j, r in enumerate(rows) if find(j) == find(i)]
        out.append((d, len(sets[i]), None if d is None else min(reached)))
    return sorted(out, key=str)


def found(spark, rows, **options):
    df = spark.createDataFrame(
        [(d, t, "x", 1) for d, t in rows], "doc_id long, text string, uid string, class int"
    ).repartition(3)
    out = jaccard.jaccard_components(df, **options).collect()
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in out), key=str)


def family(rng, size, copies, most):
    base = [f"w{rng.randrange(10**6)}" for _ in range(size)]
    out = []
    for _ in range(copies):
        own = list(base)
        for _ in range(rng.randint(0, most)):
            own[rng.randrange(len(own))] = f"v{rng.randrange(10**6)}"
        if rng.random() < 0.3:
            own = own[: rng.randint(max(1, int(size * 0.85)), size)]
        out.append(" ".join(own))
    return out


@pytest.mark.parametrize("percent", [80, 90])
def test_families_of_near_copies(spark, percent, monkeypatch):
    rng = random.Random(percent)
    texts = []
    for size in (5, 9, 11, 14, 20, 33, 60, 130, 400):
        for _ in range(3):
            texts += family(rng, size, 7, max(1, size // 20))
    rows = [(i * 7 % 1009, t) for i, t in enumerate(texts)]
    n = 3 if percent == 90 else 5
    assert found(spark, rows, n=n, percent=percent) == plain(rows, n, percent)


def test_chains_in_many_tiles(spark, monkeypatch):
    """Drifting copies: most link with neighbours only, not with the hub."""
    monkeypatch.setattr(jaccard, "TILE_GRAMS", 300)
    rng = random.Random(4)
    words = [f"w{i}" for i in range(80)]
    rows = []
    for d in range(40):
        words[rng.randrange(80)] = f"x{d}"
        rows.append((1000 - d, " ".join(words)))
    assert found(spark, rows, n=1, percent=97) == plain(rows, 1, 97)


def test_bounds_by_bitmaps_of_different_width():
    rng = np.random.default_rng(3)
    draw = lambda n: np.unique(rng.integers(0, 2**64 - 1, n, np.uint64))
    for size in (1, 50, 1000, 1030, 5000):
        one = draw(size)
        other = np.sort(np.append(one[: size * 4 // 5], draw(size // 2 + 1)))
        a, b = jaccard.bitmap(one), jaccard.bitmap(other)
        words = min(len(a), len(b))
        a, b = jaccard.folded(a, words), jaccard.folded(b, words)
        same = len(np.intersect1d(one, other))
        bound = jaccard.overlap_bounds(len(one), a, np.array([len(other)]), b[None])[0]
        assert same <= bound < same + max(20, size // 3)


def test_few_texts_meet_in_tiles(spark, monkeypatch):
    """Members of one group that cannot link: no text is sent for them."""
    seen, real = [], jaccard._in_blocks
    monkeypatch.setattr(jaccard, "_in_blocks", lambda df, look, *schema: seen.append(df) or real(df, look, *schema))
    rng = random.Random(2)
    texts = [f"{' '.join(f's{i}' for i in range(30))} {' '.join(f'{d}x{i}' for i in range(30))}" for d in range(40)]
    texts += family(rng, 100, 5, 4)
    rows = list(enumerate(texts))
    assert found(spark, rows) == plain(rows, 3, 90)
    tiles, brought = seen[1], seen[-1]
    assert "bits" in tiles.columns and "text" not in tiles.columns
    assert brought.count() == 0


def test_cases(spark):
    long = " ".join(f"t{i}" for i in range(60_000))
    rows = [
        (1, None),
        (2, ""),
        (3, " \n"),
        (4, "One"),
        (5, "one"),
        (6, "one two"),
        (7, "a b c d"),
        (7, "a b c d"),
        (8, "A B\tC d"),
        (None, "a b c d"),
        (9, long),
        (10, long + " more"),
        (11, "x " * 500),
        (12, "x x x"),
    ]
    assert found(spark, rows) == plain(rows, 3, 90)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert jaccard.jaccard_components(df.limit(0)).count() == 0
    kept = jaccard.one_of_each(df, n=3, percent=90)
    ids = sorted((r["doc_id"] for r in kept.collect()), key=str)
    assert ids == [1, 11, 2, 3, 4, 6, 7, 7, 9, None] and kept.columns == df.columns


@pytest.mark.parametrize("percent", [80, 90])
def test_linked_sets_have_a_common_key(percent):
    rng = np.random.default_rng(percent)
    bands = jaccard.Bands(percent)
    for size in [*range(1, 60), 100, 333, 1000]:
        whole = np.unique(rng.integers(0, 2**64 - 1, size + size // 2, np.uint64))
        for _ in range(20):
            one = np.sort(rng.choice(whole, size, replace=False))
            other = one
            for _ in range(int(rng.integers(1, size * (100 - percent) // 50 + 2))):
                if rng.random() < 0.5:
                    other = np.unique(np.append(other, rng.integers(0, 2**64 - 1, 1, np.uint64)))
                elif len(other) > 1:
                    other = np.delete(other, rng.integers(len(other)))
            same = len(np.intersect1d(one, other))
            if 100 * same >= percent * (len(one) + len(other) - same) and same < max(
                len(one), len(other)
            ):
                assert len(np.intersect1d(bands.keys(one), bands.keys(other)))


def test_components_of_paths_and_stars(spark):
    links = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 140)]
    links += [(200, 200), (None, 5), (5, None), (301, 300), (301, 300)]
    got = connected(spark.createDataFrame(links, "a long, b long")).collect()
    want = {i: 0 for i in range(61)} | {i: 100 for i in range(100, 140)} | {300: 300, 301: 300}
    assert {r["node"]: r["component"] for r in got} == want and len(got) == len(want)


def test_query_equals_sql(spark):
    got = sorted(tuple(r) for r in QUERIES["op3_jaccard"](spark, DATA).collect())
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{DATA}/documents.parquet'")
    assert got == sorted(con.execute(ORACLES["op3_jaccard"]).fetchall())
    assert any(c != d for d, _, c in got)
