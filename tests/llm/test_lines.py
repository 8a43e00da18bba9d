"""Line deduplication against a count over all lines."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from martflow.llm import lines

SPACES = " \t\n\x0b\x0c\r"
LOWER = str.maketrans(lines.UPPER, lines.UPPER.lower())


def plain(rows, chars, docs):
    holders = {}
    for d, t in rows:
        for line in (t or "").split("\n"):
            name = line.strip(SPACES).translate(LOWER)
            if d is not None and len(name) >= chars:
                holders.setdefault(name, set()).add(d)
    out = []
    for d, t in rows:
        own = (t or "").split("\n")
        kept = []
        for line in own:
            held = holders.get(line.strip(SPACES).translate(LOWER), ())
            if d is None or len(held) < docs or d == max(held):
                kept.append(line)
        out.append((d, len(own) - len(kept), "\n".join(kept) if t is not None else None))
    return sorted(out, key=str)


def found(spark, rows, chars, docs, parts=3):
    df = spark.createDataFrame(
        [(d, t, "x", 3, b"y") for d, t in rows],
        "doc_id long, text string, uid string, doc int, keep binary",
    ).repartition(parts)
    bitmaps = lines.keep_bitmaps(df, min_chars=chars, min_docs=docs)
    left = lines.apply_bitmaps(df, bitmaps).select("row.doc_id", "n_dropped", "kept")
    return sorted(map(tuple, left.collect()), key=str)


def drawn(seed, count, pool=12):
    rng = random.Random(seed)
    words = ["same line", "Same Line", " é x y", "a", "", "other words", "\x85edge\x85", "Ünit"]
    fixed = ["".join(rng.choice(words) for _ in range(3)) for _ in range(pool)]
    rows = []
    for d in range(count):
        own = [rng.choice(fixed) + rng.choice(["", " ", "\r"]) for _ in range(rng.randrange(9))]
        rows.append((rng.choice([d, d, d // 2, None]), rng.choice(["\n".join(own)] * 9 + [None])))
    return rows


@pytest.mark.parametrize("least", [1, 2, 5])
def test_random_lines(spark, least):
    for seed in range(2):
        rows = drawn(seed, 60)
        assert found(spark, rows, 3, least) == plain(rows, 3, least)


def test_a_line_in_most_rows_reaches_over_many_ranges(spark):
    line = "this very line stands in nearly every document, and it is long"
    rows = [(d, f"{line}\nown line {d}\n{line}") for d in range(4000)]
    rows += [(7, f"again {line}\n{line}"), (3999, line)]
    assert found(spark, rows, 40, 5, parts=8) == plain(rows, 40, 5)


@pytest.mark.parametrize("size", [1, 2, 3, 7, 1000])
def test_borders_of_batches_and_ranges_change_nothing(spark, size):
    """The same rows, streamed in batches and ranges of any length."""
    import pyarrow as pa

    rng = random.Random(size)
    rows = sorted(
        (bytes([rng.randrange(4)]) * 16, -rng.randrange(7), rng.randrange(3), i) for i in range(90)
    )
    expected = {}
    for h, d, _, _ in rows:
        expected.setdefault(h, set()).add(-d)
    gone = {r for r in rows if len(expected[r[0]]) >= 4 and -r[1] < max(expected[r[0]])}

    dropped, opened, edges = set(), set(), {}
    for begin in range(0, len(rows), 20):
        state = lines._Range(4)
        batches = []
        part = rows[begin : begin + 20]
        for at in range(0, len(part), size):
            h, d, u, i = zip(*part[at : at + size], strict=True)
            table = pa.table(
                {
                    "hash": pa.array(h, pa.binary()),
                    "doc": pa.array([-x for x in d], pa.int64()),
                    "uid": pa.array(u, pa.int64()),
                    "at": pa.array(i, pa.int32()),
                }
            )
            batches += state.take(table)
        batches += state.end()
        for batch in batches:
            for r in batch.to_pylist():
                row = (r["hash"], -(r["doc"] or 0), r["uid"], r["at"])
                if r["kind"] == lines.DROPPED:
                    dropped.add(row)
                elif r["kind"] == lines.OPEN:
                    opened.add(row)
                else:
                    edges.setdefault(r["hash"], []).append((r["high"], r["low"], r["docs"]))
    total = {}
    for h, parts in edges.items():
        parts.sort(reverse=True)
        shared = sum(a[1] == b[0] for a, b in zip(parts, parts[1:], strict=False))
        total[h] = (sum(p[2] for p in parts) - shared, parts[0][0])
    settled = {r for r in opened if total[r[0]][0] >= 4 and -r[1] < total[r[0]][1]}
    assert dropped | settled == gone
    assert not dropped & settled


def test_all_columns_come_back(spark):
    line = "x" * 40
    df = spark.createDataFrame(
        [(i, line + "\nrest", i * 2, "k") for i in range(5)],
        "doc_id int, text string, n_dropped int, kept string",
    )
    out = lines.drop_lines(df)
    assert out.schema == df.schema
    assert sorted(map(tuple, out.collect())) == [
        *[(i, "rest", i * 2, "k") for i in range(4)],
        (4, line + "\nrest", 8, "k"),
    ]


def test_nothing_and_a_very_long_text(spark):
    assert found(spark, [], 40, 5) == []
    long = "\n".join(f"line number {i} of a very long document, long enough" for i in range(50_000))
    rows = [(d, long) for d in range(5)]
    out = found(spark, rows, 40, 5)
    assert [(d, n) for d, n, _ in out] == [*[(d, 50_000) for d in range(4)], (4, 0)]
    assert out[0][2] == "" and out[4][2] == long


def test_a_bitmap_is_compressed_and_covers_all_lines():
    import numpy as np

    bitmap = lines.packed_bitmap(np.arange(5, 100_000))
    assert len(bitmap) < 200
    assert np.flatnonzero(lines.kept_lines(bitmap, 100_003)).tolist() == [0, 1, 2, 3, 4, 100_000, 100_001, 100_002]


def test_digest(spark):
    from martflow.llm.queries import QUERIES

    out = QUERIES["op12_lines"](spark, "/root/testdata/sf0.001")
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    expected = {d: (n, t) for d, n, t in plain([(r["doc_id"], r["text"]) for r in docs], 40, 5)}
    for r in out.collect():
        n, text = expected[r["doc_id"]]
        assert r["n_dropped"] == n
        assert r["kept_sha256"] == hashlib.sha256((text or "").encode()).hexdigest()
    assert out.count() == len(docs) and out.where(F.col("n_dropped") > 0).count() > 0
