"""Hard negatives against all scores."""

import math
import random

import numpy as np
import pytest

from volpanel.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<float>, label int, rid int, x string, dims string, part int, block int"


def plain(rows):
    good = []
    for vec, v, label in rows:
        if vec is None or label is None or v is None or any(c is None or not math.isfinite(c) for c in v):
            continue
        good.append((vec, [math.floor(256 * float(np.float32(c))) for c in v], (label + 1) % 10 if vec % 7 == 0 else label))
    out = []
    for k, (vec, v, label) in enumerate(good):
        if vec % 50:
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w)), other, i) for i, (other, w, _) in enumerate(good) if len(w) == len(v) and i != k)
        for s, pos, _ in [t for t in scored if good[t[2]][2] == label][:5]:
            fit = [t for t in scored if good[t[2]][2] != label and 50 * -s <= 100 * -t[0] <= 95 * -s][:3]
            out += [(vec, pos, r + 1, t[1], -s, -t[0]) for r, t in enumerate(fit)]
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in df.collect())


def made(spark, rows):
    return spark.createDataFrame([(a, b, c, 1, "x", "y", 2, 3) for a, b, c in rows], SCHEMA)


@pytest.fixture(scope="module")
def rows():
    r = random.Random(6)
    middles = [[r.gauss(0, 0.15) for _ in range(64)] for _ in range(10)]
    out = []
    for i in range(700):
        label = r.randrange(10)
        out.append((i, [m + r.gauss(0, 0.05) for m in middles[label]], label if r.random() < 0.7 else r.randrange(10)))
    out += [(1000 + i, [0.5] * 64, i % 3) for i in range(40)]  # ties
    out += [out[100], out[100], out[5], (50, out[3][1], 4)]  # repeated rows, a repeated id
    out += [(2000, None, 1), (2050, [None] * 64, 1), (2100, [0.1] * 63 + [float("nan")], 1), (2150, [float("inf")] * 64, 2), (None, out[0][1], 1), (2200, out[1][1], None)]
    out += [(2250, [], 1), (2251, [], 1), (2252, [], 2), (2300, [0.2, 0.1], 3), (2301, [0.2, 0.1], 3), (2303, [0.1, 0.1], 5), (2350, [0.0] * 64, 2)]
    return out


def test_mine(spark, rows):
    want = plain(rows)
    assert got(hn.mine(made(spark, rows).repartition(5))) == want and len(want) > 60


def test_many_blocks(spark, rows, monkeypatch):
    monkeypatch.setattr(hn, "BLOCK_ROWS", 60)
    monkeypatch.setattr(hn, "CHUNK", 3)
    assert got(hn.mine(made(spark, rows).repartition(3))) == plain(rows)


def test_intervals_hold_and_filter():
    draw = np.random.default_rng(3)
    for dims in (1, 3, 64, 100):
        x = np.floor(256 * draw.standard_normal((400, dims)) * 0.2)
        y = np.floor(256 * draw.standard_normal((9, dims)) * 0.2)
        low, high = hn.Codes(x).intervals(y)
        true = y @ x.T
        assert (low <= true).all() and (true <= high).all()
    # rows on the far side are passed over without a score
    base = np.floor(256 * draw.standard_normal(64) * 0.2)
    x = base * draw.choice([-1, 1], (2000, 1)) + draw.integers(-3, 4, (2000, 64))
    low, high = hn.Codes(x).intervals(base[None, :])
    assert 0 < (high[0] >= hn.nth_highest(low[0], hn.POSITIVES)).mean() < 0.6


def test_large_components(spark):
    rows = [(0, [3.0e5, 1.0], 1), (1, [3.0e5, -2.0], 1), (2, [2.0e5, 1.0], 3), (3, [1.0e5, 5.0], 3), (4, [2.5e5, 0.0], 3), (5, [-1e5, 0.0], 4)]
    assert got(hn.mine(made(spark, rows))) == plain(rows)
    with pytest.raises(Exception, match="does not fit"):
        hn.mine(made(spark, [(50, [1e30], 1), (1, [1e30], 1)])).collect()


def test_empty(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert hn.mine(none).count() == 0
    assert hn.mine(made(spark, [(0, [0.5], 1)])).count() == 0
