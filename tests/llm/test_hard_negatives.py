"""Hard negatives against brute force, at sizes that a float or a long cannot hold too."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerspark.llm import hard_negatives as hn

ROWS = "vec_id long, embedding array<double>, label int, score long, rank int, w int, x string, aid int"


def brute(rows, every, k=5):
    """(vec_id, exact vector, label) -> result rows."""
    out = []
    seen = []
    for a in rows:
        if a[0] % every or a in seen:
            continue
        seen.append(a)
        other = [(sum(p * q for p, q in zip(a[1], r[1])), r[0], r[2] == a[2]) for r in rows if r[0] != a[0] and len(r[1]) == len(a[1])]
        for ps, pid, _ in sorted([r for r in other if r[2]], key=lambda r: (-r[0], r[1]))[:k]:
            inside = sorted([r for r in other if not r[2] and 80 * ps <= 100 * r[0] <= 100 * ps], key=lambda r: (-r[0], r[1]))[:k]
            out += [(a[0], pid, i, nid, fits(ps), fits(ns)) for i, (ns, nid, _) in enumerate(inside, 1)]
    return sorted(out, key=str)


def fits(s):
    return s if -2 ** 63 <= s < 2 ** 63 else None


def exact(x):
    return [int(np.floor(c * 256)) if abs(c) < 2.0 ** 45 else int(c) * 256 for c in x]


def mined(spark, rows, every, **options):
    df = spark.createDataFrame([(*r, 1, 1, 1, "x", 1) for r in rows], ROWS)
    return sorted([tuple(r) for r in hn.mine(df, F.col("vec_id") % every == 0, **options).collect()], key=str)


def data(seed, n, dim, spread=1.0):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(6, dim))
    which = rng.integers(0, 6, n)
    return [(i, (middle[c] + spread * rng.normal(size=dim)).tolist(), int(rng.integers(0, 3))) for i, c in enumerate(which)]


@pytest.mark.parametrize("dim", [1, 5, 40])
def test_against_brute_force(spark, dim):
    rows = data(dim, 400, dim, 0.3)
    assert mined(spark, rows, 25, file_block=70, anchor_block=5) == brute([(i, exact(x), y) for i, x, y in rows], 25)


def test_odd_rows(spark):
    rows = data(9, 120, 6)
    odd = [(200, None, 1), (201, [], 1), (202, [None] * 6, 1), (203, [float("nan")] * 6, 1), (204, [float("inf")] * 6, 1), (205, [1.0] * 6, None), (None, [1.0] * 6, 1),
           (225, [1.0] * 4, 1), (226, [1.0] * 4, 1), (227, [0.95] * 4, 2), (250, [0.0] * 6, 1), (275, [-1.0] * 3, 1), (276, [1.0] * 3, 1), (277, [0.9] * 3, 0)]
    again = [rows[0], rows[0], rows[3], rows[3], (rows[25][0], rows[30][1], 2)]
    usable = [r for r in rows + again + odd if r[0] is not None and r[1] and r[2] is not None and all(c is not None and np.isfinite(c) for c in r[1])]
    assert mined(spark, rows + again + odd, 25, file_block=40) == brute([(i, exact(x), y) for i, x, y in usable], 25)
    assert mined(spark, [], 25) == []
    assert mined(spark, [(0, [1.0], 1), (1, [2.0], 2)], 25) == []


def test_scores_beyond_64_bits(spark):
    rows = data(4, 80, 3)
    rows = [(i, [c * 2.0 ** (60 * (i % 4)) for c in x], y) for i, x, y in rows]
    assert mined(spark, rows, 8, file_block=30) == brute([(i, exact(x), y) for i, x, y in rows], 8)


def test_rows_leave_the_bitmap_before_all_dimensions_are_read():
    rng = np.random.default_rng(0)
    columns = [rng.integers(-3, 4, 1000).astype(np.int32) for _ in range(64)]
    columns[7] = np.arange(1000, dtype=np.int32)
    block = hn.Block(np.arange(1000), np.zeros(1000), columns)
    q = np.ones(64, np.int64)
    q[7] = 1000
    looks = []

    def resolve(lower, upper):
        keep = hn.among_best(5)(lower, upper)
        looks.append(int(keep.sum()))
        return keep

    found, score = block.scan(q, np.ones(1000, bool), resolve)
    assert looks[0] == 5 and sorted(found.tolist()) == list(range(995, 1000))
    assert score.tolist() == [int(sum(int(q[d]) * int(columns[d][i]) for d in range(64))) for i in found]


def test_windows_keep_what_may_be_inside():
    lower, upper = np.array([0, 5, 8, 9, 20, 2]), np.array([4, 6, 8, 9, 30, 25])
    assert hn.in_windows([(5, 10)], 1)(lower, upper).tolist() == [False, False, False, True, False, True]
    assert hn.in_windows([(5, 10), (0, 3)], 5)(lower, upper).tolist() == [True, True, True, True, False, True]
    assert hn.window_of(-10, 80, 100) == (-8, -10) and hn.window_of(3, 80, 100) == (3, 3) and hn.window_of(0, 80, 100) == (0, 0)
