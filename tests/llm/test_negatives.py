"""Hard negatives against scoring every row."""

import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from icuriver.llm import hard_negatives
from icuriver.llm.hard_negatives import MultiIndex, Shard, Top, cells_by_bound, products


def plain(rows, is_anchor, positives=5, negatives=5, low=80, high=100):
    """Rows (id, label, vector) scored pair by pair with whole numbers of any size."""
    def usable(r):
        return r[1] is not None and r[2] and all(v is not None and math.isfinite(v) for v in r[2])

    known = [(n, r[0], r[1], [math.floor(256 * v) for v in r[2]]) for n, r in enumerate(rows) if usable(r)]
    out = []
    for n, name, label, x in known:
        if not is_anchor(name):
            continue
        scored = [(-sum(a * b for a, b in zip(x, y, strict=True)), m is None, m or 0, k, m, own) for k, m, own, y in known if k != n]
        for s, _, _, _, m, own in sorted(r for r in scored if r[5] == label)[:positives]:
            inside = sorted(r for r in scored if r[5] != label and low * -s <= 100 * -r[0] <= high * -s)
            out += [(name, m, rank, r[4], -s, -r[0]) for rank, r in enumerate(inside[:negatives], 1)]
    return sorted(out, key=str)


def mined(frame, anchors, **options):
    return sorted(map(tuple, hard_negatives.hard_negatives(frame, anchors, **options).collect()), key=str)


def made(rng, n, dims, spread, labels=4):
    """Vectors around a few centres, some of them equal."""
    centres = rng.normal(size=(6, dims))
    x = centres[rng.integers(0, 6, n)] + spread * rng.normal(size=(n, dims))
    x[rng.random(n) < 0.2] = x[0]
    x /= np.linalg.norm(x, axis=1)[:, None]
    return [(k, int(rng.integers(0, labels)), [float(np.float32(v)) for v in row]) for k, row in enumerate(x)]


@pytest.mark.parametrize("spread, dims, block, anchors", [(0.05, 8, 16_384, 4096), (0.05, 8, 30, 3), (1.0, 7, 50, 2), (0.3, 1, 64, 5)])
def test_equals_scoring_every_row(spark, monkeypatch, spread, dims, block, anchors):
    monkeypatch.setattr(hard_negatives, "BLOCK", block)
    monkeypatch.setattr(hard_negatives, "ANCHORS", anchors)
    monkeypatch.setattr(hard_negatives, "GATHER", 16)
    rows = made(np.random.default_rng(dims), 400, dims, spread)
    frame = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>").repartition(3)
    assert mined(frame, F.col("vec_id") % 20 == 0) == plain(rows, lambda k: k % 20 == 0)
    got = mined(frame, F.col("vec_id") % 50 == 0, positives=2, negatives=3, shares=(50, 90))
    assert got == plain(rows, lambda k: k % 50 == 0, 2, 3, 50, 90)


def test_defined_results(spark):
    rng = np.random.default_rng(3)
    rows = made(rng, 60, 4, 0.4, labels=2)
    odd = [
        (0, 1, None), (100, None, rows[0][2]), (200, 0, [1.0, None, 0.0, 0.0]), (300, 0, [float("nan"), 0.0, 0.0, 0.0]),
        (400, 0, [float("inf"), 0.0, 0.0, 0.0]), (500, 1, []), (None, 0, rows[1][2]), (None, 1, rows[2][2]), (600, 0, [0.0] * 4), (700, 9, rows[3][2]),
    ]
    every = rows + odd + rows[:3]
    names = "vec_id long, label int, embedding array<double>, row string, score string, block int, id long, kind string, vec string, windows int"
    frame = spark.createDataFrame([(*r, "x", "y", 1, 7, "z", "v", 3) for r in every], names).repartition(4)
    assert mined(frame, F.col("vec_id") % 20 == 0) == plain(every, lambda k: k is not None and k % 20 == 0)
    for none in (frame.limit(0), frame.where("label is null"), frame.where("embedding is null")):
        out = hard_negatives.hard_negatives(none, F.lit(True))
        assert out.count() == 0 and out.columns[0] == "anchor_id"
    assert mined(frame, F.lit(False)) == [] and mined(frame, F.lit(None).cast("boolean")) == []


def test_hot_vector_is_spread_over_blocks(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "BLOCK", 25)
    rows = [(k, k % 3, [0.6, 0.8]) for k in range(200)] + [(1000 + k, k % 3, [0.8, 0.6 - k / 100]) for k in range(40)]
    frame = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    assert mined(frame, F.col("vec_id") % 40 == 0) == plain(rows, lambda k: k % 40 == 0)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.floats(-5, 5), max_size=8), st.lists(st.floats(-5, 5), max_size=8))
def test_heap_gives_every_pair_by_descending_sum(a, b):
    got = list(cells_by_bound(np.array(a), np.array(b)))
    assert sorted((i, j) for _, i, j in got) == [(i, j) for i in range(len(a)) for j in range(len(b))]
    assert all(x[0] >= y[0] for x, y in zip(got, got[1:], strict=False)) and all(s == a[i] + b[j] for s, i, j in got)


def test_search_stops_when_certified():
    rng = np.random.default_rng(5)
    centres = np.array([[256.0, 0, 0, 0], [0, 256, 0, 0], [0, 0, 256, 0], [0, 0, 0, 256], [-256, 0, 0, 0]])
    x = np.floor(centres[rng.integers(0, 5, 2000)] + rng.integers(-9, 9, (2000, 4)))
    index = MultiIndex((hard_negatives.k_means(x[:, :2], 6), hard_negatives.k_means(x[:, 2:], 6)))
    shard = Shard(index, x, np.arange(2000), np.zeros(2000, np.int64), np.arange(2000))
    scored, plain_products = [], hard_negatives.products
    try:
        hard_negatives.products = lambda rows, q: scored.append(len(rows)) or plain_products(rows, q)
        top = Top(5, -np.inf)
        shard.search(centres[0], [top], np.ones(2000, bool))
    finally:
        hard_negatives.products = plain_products
    exact = np.lexsort((np.arange(2000), -(x @ centres[0])))[:5]
    assert top.rows[1].tolist() == exact.tolist() and sum(scored) < 1200


def test_bounds_hold_and_products_are_exact():
    rng = np.random.default_rng(6)
    x = np.floor(256 * rng.normal(size=(500, 10)))
    index = MultiIndex((hard_negatives.k_means(x[:, :5], 7), hard_negatives.k_means(x[:, 5:], 7)))
    (a, ra), (b, rb) = index.assign(x)
    radii = [np.array([r[at == k].max(initial=0) for k in range(7)]) for at, r in ((a, ra), (b, rb))]
    counts = {c: int(((a == c[0]) & (b == c[1])).sum()) for c in set(zip(a.tolist(), b.tolist(), strict=True))}
    spans = index.place(counts, tuple(radii), 40)
    for q in x[:20]:
        bound, score = index.block_bounds(q), x @ q
        for k in range(500):
            low, high = spans[a[k], b[k]]
            assert (bound[low : high + 1] >= score[k]).all()
    big = np.array([[2.0**31 + 1, 3.0], [2.0**30 + 1, -5.0]])
    assert products(big, big[0]).tolist() == [(2**31 + 1) ** 2 + 9, (2**30 + 1) * (2**31 + 1) - 15]
