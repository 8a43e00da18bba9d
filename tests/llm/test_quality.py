"""Quality classification: learns, scores every row, and holds up on held-out rows."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from martflow.llm import bytes as raw, quality
from martflow.llm.queries import QUERIES

DATA = "/root/testdata/sf0.1"


def test_subwords_equal_a_plain_list():
    data, _ = raw.utf8(pa.array([b"abcd abcd bc"], pa.binary()))
    starts, ends = np.array([0, 5, 10]), np.array([4, 9, 12])
    entry, owner = quality.subwords(data, starts, ends, 1 << 40)
    by = [sorted(entry[owner == i]) for i in range(3)]
    # word, two runs of three, one of four; the same for a repeated word
    assert by[0] == by[1] and len(by[0]) == 4 and len(by[2]) == 1


def test_cases(spark):
    good = [(i, f"a calm and tidy line about rivers {i % 5}", "x") for i in range(60)]
    bad = [(100 + i, f"zzz### qqq$$$ ### {i % 5}", "x") for i in range(60)]
    odd = [(200, None, "x"), (201, "", "x"), (202, "tidy rivers", "x"), (202, "tidy rivers", "x")]
    odd += [(203, "qqq$$$ " * 200_000, "x"), (None, "tidy", "x")]
    df = spark.createDataFrame(good + bad + odd, "doc_id long, text string, score string")
    labels = spark.createDataFrame(
        [(i, 1, 9.0) for i in range(60)]
        + [(100 + i, 0, 9.0) for i in range(60)]
        + [(5, None, 0.0), (None, 1, 0.0), (999, 1, 0.0), (0, 1, 0.0)],
        "doc_id long, quality int, score double",
    )
    model = quality.learn_quality(df, labels)
    out = quality.score_quality(df, model, keep=[df["doc_id"], df["score"].alias("own")])
    rows = out.collect()
    assert len(rows) == df.count()
    score = {r["doc_id"]: r["score"] for r in rows}
    assert min(score[i] for i in range(60)) > 0.5 > max(score[100 + i] for i in range(60))
    assert score[202] > 0.5 > score[203] and score[200] == score[201]
    assert quality.score_quality(df.limit(0), model).count() == 0
    one = quality.learn_quality(df, labels.where("quality = 1"))
    assert 0.5 < quality.score_quality(df, one, keep=[]).first()["score"] < 1
    none = quality.learn_quality(df, labels.limit(0))
    assert quality.score_quality(df, none, keep=[]).first()["score"] == 0.5


def test_held_out_rows(spark):
    out = QUERIES["op9_quality"](spark, DATA)
    labels = spark.read.parquet(f"{DATA}/labels.parquet").select("doc_id", "quality")
    rows = out.where("held_out").join(labels, "doc_id").select("score", "quality").collect()
    scores = np.array([r["score"] for r in rows])
    truth = np.array([r["quality"] for r in rows])
    order = scores.argsort().argsort() + 1
    good = truth == 1
    wins = order[good].sum() - good.sum() * (good.sum() + 1) / 2
    area = wins / (good.sum() * (~good).sum())
    right = ((scores >= 0.5) == good).mean()
    print(area, right, good.mean())
    assert area > 0.95 and right > 0.93
