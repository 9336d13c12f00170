import math
import random

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from parcelspark.llm import negatives
from tests.llm.data import SF_DIR, plain

SCHEMA = "vec_id long, embedding array<float>, label int, row string, wave int, lo double"


def by_hand(rows, every=50, positives=5, count=3):
    """The contract over (vec_id, embedding, label), all pairs at once."""
    taken = []
    for vec_id, x, label, *_ in rows:
        if label is None or x is None or any(v is None or not math.isfinite(v) for v in x):
            continue
        if vec_id is not None and vec_id % 7 == 0:
            label = (label + 1) % 10
        taken.append((vec_id, [math.floor(256 * float(v)) for v in x], label))
    key = lambda p: (-p[0], p[1] is None, p[1] or 0)
    out = []
    for i, (anchor, a, label) in enumerate(taken):
        if anchor is None or anchor % every:
            continue
        scores = [(sum(u * v for u, v in zip(a, b)), other, its) for j, (other, b, its) in enumerate(taken) if j != i]
        for p, mate, _ in sorted((s for s in scores if s[2] == label), key=key)[:positives]:
            inside = sorted((s for s in scores if s[2] != label and 50 * p <= 100 * s[0] <= 95 * p), key=key)
            out += [(anchor, mate, r, other, p, n) for r, (n, other, _) in enumerate(inside[:count], 1)]
    return sorted(map(repr, out))


def rows_of(df):
    return sorted(repr(tuple(r)) for r in df.collect())


@pytest.fixture
def small(monkeypatch):
    monkeypatch.setattr(negatives, "BLOCK", 7)
    monkeypatch.setattr(negatives, "GROUP", 40)
    monkeypatch.setattr(negatives, "WAVE", 3)


def test_hilbert_neighbours_differ_by_one_step():
    for dims, bits in ((1, 4), (2, 4), (3, 3), (4, 2), (5, 1)):
        cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), axis=-1).reshape(-1, dims)
        key = negatives.hilbert(cells, bits)
        assert sorted(key) == list(range(len(cells)))
        assert (np.abs(np.diff(cells[np.argsort(key)], axis=0)).sum(axis=1) == 1).all()


@given(st.integers(0, 2**32 - 1))
@settings(max_examples=40, deadline=None)
def test_bounds_hold_every_product(seed):
    r = np.random.default_rng(seed)
    a, m = r.integers(-300, 300, (4, 6)), r.integers(-300, 300, (9, 6))
    low, high = negatives.bounds(a, m.min(axis=0, keepdims=True), m.max(axis=0, keepdims=True))
    s = negatives.products(a, m)
    assert (s == a @ m.T).all() and (low <= s).all() and (s <= high).all()
    least, most = negatives.bounds(a, m, m)
    assert (least == s).all() and (most == s).all()


def test_products_are_exact_or_an_error():
    big = np.full((1, 4), 2**30)
    assert negatives.products(big, big + 1)[0, 0] == 4 * 2**30 * (2**30 + 1)
    with pytest.raises(OverflowError):
        negatives.products(np.full((1, 4), 2**31), np.full((1, 4), 2**31))


def test_equal_to_all_pairs(spark, small):
    rows = plain(spark, SF_DIR, "embeddings")
    want = by_hand([tuple(r) for r in rows.collect()], every=10)
    assert want and rows_of(negatives.mine(rows, every=10)) == want


def test_ties_repeats_nulls_and_other_lengths(spark, small):
    r = random.Random(5)
    near = lambda: [r.choice([0.25, 0.5, 1.0, -0.25]) for _ in range(6)]
    rows = [(i, near(), r.randrange(3)) for i in range(0, 300, 5)]
    rows += [(i, [1.0] * 6, i % 3) for i in range(300, 380)]  # one very common vector
    rows += [rows[0], rows[10], (50, near(), 1), (None, [1.0] * 6, 1), (None, [0.5] * 6, 2), (3, None, 1), (4, [1.0] * 6, None)]
    rows += [(100, [1.0, None, 1.0], 1), (150, [float("nan")] * 6, 1), (200, [float("inf")] * 6, 1), (8, [], 1), (9, [0.5], 0),
             (11, [1.0] * 9, 2), (12, [0.0] * 6, 1), (13, [-1.0] * 6, 0)]
    df = spark.createDataFrame([(*x, "clash", 1, 0.5) for x in rows], SCHEMA)
    assert rows_of(negatives.mine(df)) == by_hand(rows)


def test_few_blocks_are_read_where_vectors_lie_in_clusters(spark, monkeypatch, small):
    monkeypatch.setattr(negatives, "GROUP", 4000)
    monkeypatch.setattr(negatives, "WAVE", 4000)
    r = np.random.default_rng(1)
    centres = r.normal(size=(12, 8)) * 3
    rows = [(i, (centres[i % 12] + r.normal(size=8) * 0.01).tolist(), i % 4) for i in range(1, 1200)]
    rows = [(i, [float(np.float32(v)) for v in x], c) for i, x, c in rows]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    asked = []
    needs = negatives.Blocks.needs
    monkeypatch.setattr(negatives.Blocks, "needs", lambda self, *a, **k: asked.append((out := needs(self, *a, **k), self)) or out)
    assert rows_of(negatives.mine(df)) == by_hand(rows)
    (mates, blocks), anchors = asked[1], 23
    read = mates.selectExpr("sum(size(need))").first()[0]
    assert read < 0.15 * anchors * blocks.zones.count()


def test_empty_tables(spark):
    for rows in ([], [(50, [], 1), (100, [], 2)]):
        df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
        assert rows_of(negatives.mine(df)) == by_hand(rows)
