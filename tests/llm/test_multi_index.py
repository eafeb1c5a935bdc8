"""Hard negatives against brute force."""

import math
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from hazardspark.llm import multi_index


def by_hand(rows, modulus, scale, positives=5, negatives=3):
    """rows: id -> (vector, label)."""
    whole = {i: ([math.floor(scale * x) for x in v], label) for i, (v, label) in rows.items()}
    out = set()
    for a, (v, label) in whole.items():
        if a % modulus:
            continue
        scores = sorted((-sum(x * y for x, y in zip(v, w)), i) for i, (w, _) in whole.items() if i != a and len(w) == len(v))
        for s, p in [x for x in scores if whole[x[1]][1] == label][:positives]:
            fit = [x for x in scores if whole[x[1]][1] != label and 50 * -s <= 100 * -x[0] <= 95 * -s][:negatives]
            out |= {(a, p, k + 1, i, -s, -n) for k, (n, i) in enumerate(fit)}
    return out


@pytest.mark.parametrize("sizes", [{}, {"block": 50, "anchors": 3, "words": 4}, {"block": 1000, "words": 1}])
def test_negatives_with_ties_and_odd_rows(spark, sizes):
    rng = np.random.default_rng(1)
    rows = {i: (rng.integers(-2, 4, 6).astype(float).tolist(), int(rng.integers(0, 4))) for i in range(300)}
    rows |= {1000: ([1.0, 2.0], 1), 1001: ([3.0, 1.0], 1), 1002: ([1.0, 1.0], 2), 1003: ([2.0, 1.5], 0), 1020: ([], 0), 1021: ([], 0), 1022: ([], 1), 1040: ([5.0], 0)}
    rows |= {1100 + i: ([-1.0, -1.0, 0.5], i % 2) for i in range(4)} | {1110 + i: ([1.0, 1.0, -0.5], i % 2) for i in range(4)}
    given = [(i, v, label) for i, (v, label) in rows.items()]
    given += [(400, None, 1), (420, [1.0, None, 0.0, 0.0, 1.0, 1.0], 1), (440, [float("nan")] * 6, 1), (460, [float("inf")] + [0.0] * 5, 1), (480, [1.0] * 6, None), (None, [1.0] * 6, 1), given[0]]
    frame = spark.createDataFrame(given, "vec_id long, embedding array<double>, label int")
    frame = frame.select("*", *(F.lit("clash").alias(c) for c in ("size", "block", "rank", "place", "anchor_id")))
    got = {tuple(r) for r in multi_index.mine(frame, F.col("vec_id") % 10 == 0, scale=4.0, **sizes).collect()}
    assert got == by_hand(rows, 10, 4.0) and len(got) > 300
    assert multi_index.mine(frame.where("vec_id > 5000"), F.col("vec_id") % 10 == 0).count() == 0
    with pytest.raises(Exception, match="2\\^42"):
        multi_index.mine(spark.createDataFrame([(0, [1e9], 1), (1, [1e9], 1)], "vec_id long, embedding array<double>, label int"), F.col("vec_id") % 10 == 0).count()


def test_cells_come_by_falling_bounds_that_hold():
    rng = np.random.default_rng(2)
    x = rng.integers(-50, 50, (400, 8)).astype(float)
    books = tuple(multi_index.codebook(h, 5) for h in (x[:, :4], x[:, 4:]))
    index = multi_index.Index(np.arange(400), np.zeros(400, np.int64), x, books)
    for q in x[:10]:
        bounds, seen = [], 0
        for bound, start, end in index.cells(q):
            assert (index.x[start:end] @ q <= bound).all()
            bounds.append(bound)
            seen += end - start
        assert seen == 400 and bounds == sorted(bounds, reverse=True)


def test_most_is_not_visited_where_vectors_lie_in_groups():
    rng = np.random.default_rng(3)
    centres = rng.normal(0, 100, (16, 8))
    x = np.rint(centres[rng.integers(0, 16, 4000)] + rng.normal(0, 2, (4000, 8)))
    books = tuple(multi_index.codebook(h, 16) for h in (x[:, :4], x[:, 4:]))
    index = multi_index.Index(np.arange(4000), np.zeros(4000, np.int64), x, books)
    visited = defaultdict(int)
    for k, q in enumerate(x[:50]):
        def usable(p, k=k):
            visited[k] += p.stop - p.start
            return np.ones(p.stop - p.start, bool)
        ((ids, scores),) = index.best(q, [(-(2**62), 2**62)], 5, usable)
        all_scores = index.x @ q
        want = sorted(zip((-all_scores).tolist(), index.ids.tolist()))[:5]
        assert list(zip((-scores).tolist(), ids.tolist())) == want
    assert np.mean(list(visited.values())) < 2000
