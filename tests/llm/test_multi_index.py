"""Hard negatives against plain Python."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from regstar.llm.multi_index import MultiIndex, codebook, hard_negatives, score_window
from tests.llm.conftest import pairs

OUT = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def plain(rows, anchor_every=5, positives=5, negatives=3):
    kept = {}
    for i, v, label in rows:
        if i is None or v is None or label is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        row = (label, [math.floor(256 * x) for x in v])
        kept[i] = min(kept.get(i, row), row)
    out = []
    for a, (label, q) in kept.items():
        if a % anchor_every:
            continue
        scores = sorted((-sum(x * y for x, y in zip(q, v)), i, other) for i, (other, v) in kept.items() if i != a)
        for p, i, _ in [s for s in scores if s[2] == label][:positives]:
            window = [s for s in scores if s[2] != label and 50 * -p <= 100 * -s[0] <= 95 * -p]
            out += [(a, i, k + 1, j, -p, -s) for k, (s, j, _) in enumerate(window[:negatives])]
    return sorted(out)


def got(spark, rows, **sizes):
    schema = "vec_id long, embedding array<float>, label int, score string, block string, vector string"
    df = spark.createDataFrame([(*r, "x", "x", "x") for r in rows], schema).repartition(3)
    return sorted(pairs(hard_negatives(df, F.col("vec_id") % 5 == 0, **sizes), *OUT))


def clustered(n, dim, seed=0, groups=6):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(groups, dim))
    x = (centres[rng.integers(0, groups, n)] + 0.3 * rng.normal(size=(n, dim))).astype(np.float32)
    return [(i, v.tolist(), int(rng.integers(0, 4))) for i, v in enumerate(x)]


@pytest.mark.parametrize("sizes", [{}, dict(block_rows=20, anchors_per_task=9, codes=5, sample=40)])
def test_clustered_vectors(spark, sizes):
    rows = clustered(300, 10)
    want = plain(rows)
    assert len(want) > 100 and got(spark, rows, **sizes) == want


def test_odd_rows(spark):
    """Nulls, non-finite numbers, ties, repeated rows and ids, uneven lengths."""
    rows = clustered(60, 4, seed=2)
    rows += [rows[7], rows[7], (7, [9.0] * 4, 0), (100, None, 1), (105, [1.0, None, 0.0, 0.0], 1), (None, [1.0] * 4, 1)]
    rows += [(110, [float("nan")] * 4, 1), (115, [float("inf")] * 4, 1), (120, [0.5] * 4, None), (125, [], 2), (130, [1.0], 1)]
    rows += [(200 + i, [0.5, 0.25, 0.5, 0.25], i % 2) for i in range(80)]  # one vector, many ids
    rows += [(400 + i, [0.0] * 4, 3) for i in range(7)] + [(500 + i, [0.0] * 4, 2) for i in range(7)]
    assert got(spark, rows) == plain(rows)


def test_large_components(spark):
    rows = [(i, (np.array(v, np.float32) * np.float32(3000)).tolist(), label) for i, v, label in clustered(80, 6, seed=4)]
    assert got(spark, rows) == plain(rows)


def test_no_rows(spark):
    assert got(spark, [(1, [1.0, 2.0], None)]) == []
    assert got(spark, [(5, [1.0, 2.0], 1)]) == []


def test_windows_of_scores():
    for p in range(-300, 300):
        low, high = score_window(p, 50, 95)
        inside = [s for s in range(-400, 400) if 50 * p <= 100 * s <= 95 * p]
        assert (inside == []) if low > high else (low, high) == (inside[0], inside[-1])


def test_heap_gives_cells_by_falling_bounds_and_ends_early():
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(8, 16)) * 400
    x = np.rint(centres[rng.integers(0, 8, 4000)] + 5 * rng.normal(size=(4000, 16))).astype(np.int64)
    books = [codebook(x[:, :8], 8), codebook(x[:, 8:], 8)]
    index = MultiIndex(np.arange(4000), np.zeros(4000, np.int64), x, books, int(np.abs(x).max()))
    seen, last = [], math.inf
    for rows, scores, bound in index.visits(x[3]):
        assert scores.max() <= last and (scores == x[index.ids[rows]] @ x[3]).all()
        seen += rows.tolist()
        last = bound
    assert sorted(seen) == list(range(4000))
    visited = []
    whole = index.visits

    def counted(q):
        for step in whole(q):
            visited.append(len(step[0]))
            yield step

    index.visits = counted
    best = index.positives(3, 0, x[3], 5)
    scores = x @ x[3]
    assert [s for s, _ in best] == sorted(np.delete(scores, 3).tolist(), reverse=True)[:5]
    assert sum(visited) < 2000
