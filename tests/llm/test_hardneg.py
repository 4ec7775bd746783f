import math
import random

import numpy as np
from pyspark.sql import functions as F

from procura.llm import hardneg

SCHEMA = "vec_id long, label int, embedding array<float>, anchor int, rid string"


def _walk(rows, positives=5, negatives=10, low=30, high=90):
    """All pairs, one at a time; rows as (vec_id, label, vector)."""
    kept = []
    for vec_id, label, vector in rows:
        if label is None or vector is None or any(x is None or not math.isfinite(x) or abs(x) > hardneg.LARGEST / 256 for x in vector):
            continue
        kept.append((vec_id, label, [math.floor(256 * float(np.float32(x))) for x in vector]))
    order = lambda x: (-x[1], x[0] is None, x[0] or 0)
    out = []
    for i, (anchor, label, a) in enumerate(kept):
        if anchor is None or anchor % 100:
            continue
        scored = [(v, sum(x * y for x, y in zip(a, b)), m) for j, (v, m, b) in enumerate(kept) if j != i]
        for p in sorted([s for s in scored if s[2] == label], key=order)[:positives]:
            fits = [s for s in scored if s[2] != label and low * p[1] <= 100 * s[1] <= high * p[1]]
            out += [(anchor, p[0], k, n[0], p[1], n[1]) for k, n in enumerate(sorted(fits, key=order)[:negatives], 1)]
    return sorted(out, key=str)


def _mined(spark, rows, **more):
    d = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA).repartition(3)
    got = hardneg.hard_negatives(d, F.col("vec_id") % 100 == 0, **more)
    return sorted([tuple(r) for r in got.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
                   .collect()], key=str)


def test_planes_and_lookups_are_inner_products():
    rng = np.random.default_rng(5)
    for low, high, planes in ((-256, 255, 9), (-1, 0, 1), (0, 1, 2), (-70_000, 70_000, 18)):
        a, c = rng.integers(low, high + 1, (7, 24)), rng.integers(low, high + 1, (2_100, 24))
        packed = hardneg.to_planes(c, planes)
        assert (hardneg.from_planes(packed) == c).all()
        assert (hardneg.scores(packed, hardneg.subset_sums(a)) == c @ a.T).all()


def test_against_all_pairs(spark):
    rng = random.Random(11)
    vector = lambda n=20: [rng.gauss(0, 0.4) for _ in range(n)]
    rows = [(i, rng.randrange(4), vector()) for i in range(350)]
    hot = vector()
    rows += [(1_000 + i, 7, hot) for i in range(120)] + [(2_000 + i, 8, hot) for i in range(120)]
    rows += [(400, None, vector()), (401, 1, None), (402, 1, [None, 1.0]), (500, 1, [float("nan")] * 20),
             (501, 2, [float("inf")] * 20), (502, 2, [1e30] * 20), (503, 1, []), (600, 2, vector(9)), (700, 3, vector(33)),
             (None, 1, vector()), (None, 7, hot), (800, 9, vector())]
    got = _mined(spark, rows)
    assert got == _walk(rows) and len(got) > 100


def test_many_blocks_merge(spark, monkeypatch):
    rng = random.Random(2)
    rows = [(i, rng.randrange(3), [rng.randrange(-3, 4) / 256 for _ in range(8)]) for i in range(900)]
    want = _walk(rows, positives=4, negatives=6, low=10, high=100)
    monkeypatch.setattr(hardneg, "LEAST_BLOCK", 100)
    monkeypatch.setattr(hardneg, "ANCHOR_BLOCK", 4)
    monkeypatch.setattr(hardneg, "ANCHOR_SLICE", 2)
    assert _mined(spark, rows, positives=4, negatives=6, low=10, high=100) == want


def test_repeated_and_no_rows(spark):
    rows = [(100, 1, [1.0, 0.5])] * 2 + [(3, 1, [1.0, 0.5]), (4, 2, [0.5, 0.25]), (4, 2, [0.5, 0.25]), (5, 2, [9.0, 9.0])]
    assert _mined(spark, rows) == _walk(rows)
    assert _mined(spark, []) == []
    assert _mined(spark, [(100, None, None)]) == []
    assert _mined(spark, [(100, 1, [1.0]), (2, 2, [1.0])]) == []
