"""Hard negatives against plain comparison of all rows."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from plain import SF
from snaplake.llm import hard_negatives as hn
from snaplake.llm import queries
from oracle_harness import compare, duck


def plain(rows, scale=256, low=80, high=100, many=5):
    """Rows are (id, vector, label); the order of equal rows does not show in the result."""
    kept = []
    for i, v, label in rows:
        if i is None or v is None or label is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        x = [math.floor(scale * np.float64(np.float32(c))) for c in v]
        if sum(c * c for c in x) < 2 ** 55:
            kept.append((i, x, label))
    out = []
    for a, (i, x, label) in enumerate(kept):
        if i % 100:
            continue
        scored = sorted((-sum(p * q for p, q in zip(x, y)), j, m, b) for b, (j, y, m) in enumerate(kept) if b != a and len(y) == len(x))
        for p, j, _, _ in [s for s in scored if s[2] == label][:many]:
            window = [s for s in scored if s[2] != label and low * -p <= 100 * -s[0] <= high * -p][:many]
            out += [(i, j, k + 1, s[1], -p, -s[0]) for k, s in enumerate(window)]
    return sorted(out)


def mined(spark, rows, **options):
    df = spark.createDataFrame([(i, v, label, "x", 1) for i, v, label in rows], "vec_id long, embedding array<float>, label int, score string, rank int")
    return sorted(tuple(r) for r in hn.mine_negatives(df.repartition(3), F.col("vec_id") % 100 == 0, **options).collect())


def table(n, size, spread, seed, labels=3):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, size))
    x = centres[rng.integers(0, 6, n)] + spread * rng.normal(size=(n, size))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    ids = rng.permutation(n) * 10
    return [(int(i), v.astype(np.float32).tolist(), int(rng.integers(0, labels))) for i, v in zip(ids, x)]


@pytest.mark.parametrize("n,size,spread", [(400, 16, 0.05), (300, 64, 1.0), (60, 1, 1.0)])
def test_equal_to_comparing_all(spark, n, size, spread, monkeypatch):
    monkeypatch.setattr(hn, "SHARD", 64)
    monkeypatch.setattr(hn, "BLOCK", 4)
    rows = table(n, size, spread, n)
    if size == 16:
        assert mined(spark, rows, per_pass=15, low=50, high=90) == plain(rows, low=50, high=90)
    else:
        assert mined(spark, rows) == plain(rows)


def test_ties_copies_nulls_and_bad_values(spark):
    rng = np.random.default_rng(5)
    rows = [(100 * (k // 3), rng.choice([-1.0, 0.0, 1.0], 4).tolist(), int(k % 2)) for k in range(60)]
    rows += [(7, [1.0, 1.0, 0.0, 0.0], 0)] * 3 + [(8, [0.0] * 4, 1), (100, [0.0] * 4, 1), (None, [1.0] * 4, 1), (9, None, 1), (10, [1.0] * 4, None)]
    rows += [(11, [1.0, None, 0.0, 1.0], 1), (12, [float("nan"), 1.0, 0.0, 1.0], 1), (13, [float("inf"), 1.0, 0.0, 1.0], 1), (14, [3e38, 1.0, 0.0, 1.0], 1),
             (200, [1e5, 1e5, 0.0, 1.0], 1), (15, [9e4, 9e4, 0.0, 1.0], 1), (16, [9e4, 8e4, 0.0, 1.0], 0)]
    rows += [(200, [1.0, 1.0], 0), (201, [1.0, 1.0], 0), (202, [1.0, 0.9], 1), (300, [], 0), (301, [], 0), (302, [], 1)]
    got, want = mined(spark, rows), plain(rows)
    assert [r[:1] + r[2:3] + r[4:] for r in got] == [r[:1] + r[2:3] + r[4:] for r in want] and got == want


def test_only_negative_scores_and_few_rows(spark):
    rows = [(0, [1.0, 0.0], 0), (1, [-1.0, 0.0], 0), (2, [-0.9, 0.0], 1), (3, [0.0, 1.0], 0), (4, [0.0, -1.0], 1), (100, [0.5, 0.5], 2)]
    assert mined(spark, rows) == plain(rows)
    assert mined(spark, rows[1:3]) == [] and mined(spark, []) == []


@pytest.mark.parametrize("threshold", [0.3, 0.6, 0.9])
def test_pruning_keeps_every_pair_at_or_above_the_threshold(threshold):
    rows = table(500, 32, 0.3, 9)
    matrix = np.floor(256 * np.array([v for _, v, _ in rows])).astype("<i4")
    label = np.array([c for *_, c in rows])
    shard = hn.Shard(np.arange(500), np.array([i for i, *_ in rows]), label, matrix)
    low = np.full((50, 1), int(threshold * 65536))
    queries_ = hn.Queries(np.arange(50), label[:50], matrix[:50], low, np.full((50, 1), hn.HIGHEST))
    every = matrix[:50].astype(int) @ matrix.astype(int).T
    for same in (True, False):
        q, r, score = hn.scores_from(shard, queries_, same)
        want = (every >= low) & ((label[:50, None] == label) == same) & (np.arange(50)[:, None] != np.arange(500))
        assert set(zip(q.tolist(), r.tolist())) == set(zip(*(a.tolist() for a in np.nonzero(want)))) and len(q) == want.sum()
        assert (score == every[q, r]).all()


def test_query_equals_its_sql(spark):
    problems, n, _ = compare(spark, duck(SF), "op12_hard_negatives", queries.SPARK["op12_hard_negatives"], queries.ORACLE["op12_hard_negatives"], SF)
    assert not problems and n
