"""Hard negatives against brute force."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tripstats.llm import negatives
from tripstats.llm.negatives import Settings, hard_negatives


def brute_force(rows, is_anchor, settings=Settings()):
    usable = {}
    for vec_id, label, vector in rows:
        if vec_id is None or label is None or vector is None:
            continue
        if any(x is None or not math.isfinite(x) for x in vector):
            continue
        usable[vec_id, label, tuple(math.floor(256 * x) for x in vector)] = True
    out, anchors = [], {}
    for vec_id, label, vector in usable:
        if is_anchor(vec_id):
            anchors[vec_id] = min(anchors.get(vec_id, (label, vector)), (label, vector))
    for anchor, (label, vector) in anchors.items():
        scored = sorted((-sum(a * b for a, b in zip(vector, v)), i, l) for i, l, v in usable)
        same = [(-s, i) for s, i, l in scored if l == label and i != anchor][: settings.positives]
        for score, positive in set(same):
            fit = [(-s, i) for s, i, l in scored if l != label
                   and settings.least * score <= -100 * s <= settings.most * score]
            for rank, (s, i) in enumerate(fit[: settings.negatives], 1):
                out.append((anchor, positive, rank, i, score, s))
    return sorted(out)


def found(spark, rows, is_anchor, settings=Settings()):
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>")
    df = df.selectExpr("*", "1 AS rank", "'x' AS planes", "2 AS anchor_id", "3 AS row_block")
    out = hard_negatives(df, is_anchor, settings)
    assert out.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(row) for row in out.collect())


def single(x):
    import numpy as np

    return float(np.float32(x))


@pytest.mark.parametrize("blocks", [(4096, 65_536, 1024), (7, 40, 20)])
def test_equals_brute_force(spark, monkeypatch, blocks):
    for name, value in zip(("ANCHOR_BLOCK", "ROW_BLOCK", "LEAST_BLOCK"), blocks):
        monkeypatch.setattr(negatives, name, value)
    rng = random.Random(4)
    centres = [[rng.gauss(0, 0.2) for _ in range(19)] for _ in range(4)]
    rows = []
    for i in range(400):
        centre = rng.choice(centres)
        vector = [single(round(x + rng.gauss(0, 0.1), 1 if i % 3 else 4)) for x in centre]
        rows.append((i - 30, rng.choice([0, 1, 2, -3]), vector))
    rows += [(1000 + i, i % 4, [single(0.25)] * 19) for i in range(60)]
    rows += [(20, 1, [single(0.5)] * 3), (2000, 0, []), (40, 3, rows[7][2])]
    rows += [(3000, None, rows[0][2]), (3010, 1, None), (None, 1, rows[0][2])]
    rows += [(3020, 1, [float("nan")]), (3030, 1, [float("inf")] * 19), (3040, 1, [None, 0.5])]
    rows += rows[:40]
    got = found(spark, rows, F.col("vec_id") % 10 == 0)
    assert got == brute_force(rows, lambda i: i % 10 == 0)
    settings = Settings(positives=2, negatives=9, least=20, most=130)
    got = found(spark, rows, F.col("vec_id") % 50 == 0, settings)
    assert got == brute_force(rows, lambda i: i % 50 == 0, settings)


def test_large_components(spark):
    rows = [(i, i % 2, [single(1000.0 * i), single(-99999.5), single(3.0 ** (i % 11))]) for i in range(40)]
    assert found(spark, rows, F.col("vec_id") % 4 == 0) == brute_force(rows, lambda i: i % 4 == 0)
    with pytest.raises(ValueError, match="too large"):
        found(spark, [(1, 1, [1e30]), (2, 1, [1.0])], F.col("vec_id") > 0)


def test_no_rows_and_no_partners(spark):
    anchor = F.col("vec_id") % 2 == 0
    assert found(spark, [], anchor) == []
    assert found(spark, [(2, 1, [1.0]), (3, 2, [1.0])], anchor) == []
    assert found(spark, [(2, 1, [1.0]), (4, 1, [1.0])], anchor) == []
    assert found(spark, [(1, 1, [1.0]), (3, 2, [1.0])], anchor) == []
