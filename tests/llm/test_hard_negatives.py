"""Hard negatives against brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import types as T

from tagmill.llm import negatives

ROWS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
                     T.StructField("label", T.IntegerType()), T.StructField("row", T.StringType()), T.StructField("cell", T.StringType())])


def brute(rows, every=100):
    """Every anchor against every row with plain integers."""
    kept = []
    for vec, x, label in rows:
        if vec is None or label is None or x is None or any(v is None or not math.isfinite(v) for v in x):
            continue
        code = [math.floor(max(-2.0**26, min(2.0**26, 256 * float(np.float32(v))))) for v in x]
        kept.append((vec, int(math.fmod(label + 1, 10)) if vec % 7 == 0 else label, code))
    out = []
    for anchor, label, code in kept:
        if anchor % every:
            continue
        scored = [(-sum(a * b for a, b in zip(code, c)), v, i) for i, (v, _, c) in enumerate(kept)]
        order = sorted(s for s in scored if s[1] != anchor and kept[s[2]][1] == label)[:5]
        for p, positive, _ in order:
            fits = sorted(s for s in scored if kept[s[2]][1] != label and 30 * -p <= 100 * -s[0] <= 90 * -p)[:10]
            out += [(anchor, positive, rank, v, -p, -s) for rank, (s, v, _) in enumerate(fits, 1)]
    return sorted(out)


@pytest.fixture
def table(spark):
    return lambda rows: spark.createDataFrame([(i, x, y, "r", "c") for i, x, y in rows], ROWS)


def near(r, centre, by):
    return [v + r.gauss(0, by) for v in centre]


def clustered(many=700, width=12, groups=6, by=0.05, seed=4):
    r = random.Random(seed)
    centres = [[r.gauss(0, 1) for _ in range(width)] for _ in range(groups)]
    return [(i, near(r, centres[i % groups], by), r.randrange(10)) for i in range(many)]


ODD = [(None, [1.0] * 12, 1), (5000, None, 1), (5001, [1.0] * 12, None), (5002, [math.nan] + [1.0] * 11, 1), (5003, [math.inf] * 12, 1),
       (5004, [None] + [1.0] * 11, 1), (6000, [], 3), (6100, [0.0] * 12, 3), (6200, [0.5, 0.5], 2), (6300, [-1.0] * 12, 4),
       (200, [0.1] * 12, 1), (200, [0.1] * 12, 1), (6400, [1e30] * 12, 2), (6500, [1e30] * 12, 3), (6501, [1e-3] * 12, 2), (6600, [9e4] * 12, 2)]


def mined(frame):
    return sorted(map(tuple, negatives.mine(frame).collect()))


def test_equals_brute_force(table):
    rows = clustered() + ODD
    got = mined(table(rows))
    assert got == brute(rows) and len(got) > 200


def test_many_small_blocks(table, monkeypatch):
    for name, value in (("ROW_VALUES", 12 * 40), ("ANCHOR_VALUES", 12 * 3), ("LEAF", 8), ("PENDING", 50), ("SPLITS", 5), ("SAMPLE", 60)):
        monkeypatch.setattr(negatives, name, value)
    rows = clustered(400, seed=9) + [(i, [0.3] * 12, i % 3) for i in range(1000, 1300)]
    assert mined(table(rows)) == brute(rows)


def test_ties_and_copies_go_by_id(table):
    rows = [(i, [0.5, 0.25], 1 if i < 50 else 2) for i in range(201)]
    got = mined(table(rows))
    assert got == brute(rows)


def test_empty(table):
    assert mined(table([(1, [1.0], 1)]).filter("false")) == []
    assert mined(table([(100, [1.0], 1)])) == [] == mined(table([(None, None, None)]))


def test_ranges_leave_out_subtrees():
    r = np.random.default_rng(3)
    centres = r.normal(0, 300, (8, 16))
    code = np.floor(centres[np.arange(8000) % 8] + r.normal(0, 8, (8000, 16))).astype(np.int64)
    anchors = code[::400]
    block = negatives.Search(code, np.arange(8000), np.arange(8000) % 5, np.arange(8000), 10, False)
    best = np.sort(anchors @ code.T, 1)[:, -1]
    w, rows, s = block.run(anchors, np.arange(0, 8000, 400), np.zeros(len(anchors), int), np.arange(len(anchors)), best * 9 // 10, best)
    assert block.compared < 0.4 * len(anchors) * len(code)
    for i in range(len(anchors)):
        score = code @ anchors[i]
        want = sorted((-score[j], j) for j in range(8000) if j % 5 and best[i] * 9 // 10 <= score[j] <= best[i])[:10]
        assert [(-a, b) for a, b in zip(s[w == i], rows[w == i])] == want
