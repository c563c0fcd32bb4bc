"""Hard negatives against brute force, and the cover tree's answers against all points."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tenorgrid.llm import negatives
from tenorgrid.llm.negatives import LEAST, MOST, CoverTree, hard_negatives
from tests.llm import helpers as h
from tests.oracle import compare, connect

SCHEMA = "vec_id bigint, label int, embedding array<double>, id bigint, vector string, cell int, score int, `a.b` int"


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 2, 3, 4) for r in rows], SCHEMA)


def sample(seed=5, n=400, spread=0.15):
    rng = np.random.default_rng(seed)
    base = rng.standard_normal((8, 6))
    rows = [(k, int(rng.integers(0, 4)), (base[k % 8] + spread * rng.standard_normal(6)).tolist()) for k in range(n)]
    hot = rows[3][2]
    rows += [(1000 + k, k % 3, hot) for k in range(150)]  # one vector, many rows
    rows += [(2000, None, hot), (None, 1, hot), (2100, 1, None), (2200, 1, []), (2300, 1, [math.nan] * 6), (2400, 1, [None] + hot[1:]),
             (2500, 1, [math.inf] + hot[1:]), (2600, 1, hot[:3]), (2601, 1, hot[:3]), (2602, 2, [0.99 * x for x in hot[:3]]), (2700, 2, [0.0] * 6),
             (2800, 1, [-x for x in hot]), (2900, 1, [1e300] * 6), (1000, 0, hot), (3000, 9, hot), rows[0]]
    return rows


def brute(rows, anchor, k=5, low=80, high=100):
    good = {(i, c, tuple(math.floor(256 * x) for x in v)) for i, c, v in rows
            if i is not None and c is not None and v and all(x is not None and math.isfinite(x) and abs(x) < 1e15 for x in v)}
    out = []
    for i, c, q in good:
        if not anchor(i):
            continue
        scored = sorted((-sum(a * b for a, b in zip(q, x)), j, d) for j, d, x in good if j != i and len(x) == len(q))
        for s, j in [(s, j) for s, j, d in scored if d == c][:k]:
            found = [(t, n) for t, n, d in scored if d != c and low * -s <= 100 * -t <= high * -s][:k]
            out += [(i, j, r + 1, n, -s, -t) for r, (t, n) in enumerate(found)]
    return sorted(out)


def rows_of(df):
    return sorted(map(tuple, df.collect()))


@pytest.mark.parametrize("shard,centres,leaf", [(4096, 256, 48), (40, 4, 3), (25, 30, 1)])
def test_hard_negatives(spark, monkeypatch, shard, centres, leaf):
    for name, value in (("SHARD", shard), ("CENTRES", centres), ("LEAF", leaf), ("WIDTH", 3 if leaf < 48 else 32), ("SAMPLE", 100)):
        monkeypatch.setattr(negatives, name, value)
    rows = sample()
    got = hard_negatives(table(spark, rows), F.col("id") % 10 == 0)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    expected = brute(rows, lambda i: i % 10 == 0)
    assert len(expected) > 300 and rows_of(got) == expected
    got = hard_negatives(table(spark, rows), F.col("id") % 50 == 0, k=2, low=50, high=95)
    assert rows_of(got) == brute(rows, lambda i: i % 50 == 0, 2, 50, 95)


def test_large_components_and_empty_tables(spark):
    rows = [(k, k % 2, [1e6 + 3.1 * k, -2e6 * (k % 3), 5.5e5]) for k in range(40)]
    assert rows_of(hard_negatives(table(spark, rows), F.col("id") % 5 == 0)) == brute(rows, lambda i: i % 5 == 0)
    assert hard_negatives(table(spark, []), F.col("id") % 5 == 0).count() == 0
    assert hard_negatives(table(spark, rows), F.col("id") < 0).count() == 0
    assert hard_negatives(table(spark, [r for r in rows if r[1]]), F.col("id") % 5 == 0).count() == 0


@pytest.mark.parametrize("scale", [40, 10**8])
def test_cover_tree_windows(scale):
    rng = np.random.default_rng(scale)
    points = (rng.standard_normal((900, 5)) * scale).astype(np.int64)
    points[100:300] = points[7]
    ids, labels = rng.permutation(900).astype(np.int64), rng.integers(0, 3, 900)
    big = float((points.astype(float) ** 2).sum(axis=1).max())
    tree = CoverTree(points, ids, labels, big)
    for start, stop in (tree.levels[0][0][0],):
        assert (start, stop) == (0, 900)
    queries, own, mine = points[:30], ids[:30], labels[:30]
    score = queries @ points.T
    of = np.repeat(np.arange(30), 3)
    low, high = np.full(90, LEAST), np.full(90, MOST)
    high[1::3] = np.median(score, axis=1)
    low[2::3], high[2::3] = np.quantile(score, 0.2, axis=1), np.quantile(score, 0.3, axis=1)
    same = np.arange(90) % 2 == 0
    w, other, s = tree.search(queries, own, mine, of, low, high, same, 4)
    for k in range(90):
        q = of[k]
        good = [j for j in range(900) if (labels[j] == mine[q]) == same[k] and ids[j] != own[q] and low[k] <= score[q, j] <= high[k]]
        best = sorted((-int(score[q, j]), int(ids[j])) for j in good)[:4]
        assert sorted(zip((-s[w == k]).tolist(), other[w == k].tolist())) == best


def test_query_equals_sql(spark):
    class Entry:
        sql = negatives.SQL

    for folder in (h.FOLDER, "/root/testdata/sf0.1"):
        problems, odd, n = compare(connect(folder), Entry, negatives.op12_hard_negatives(spark, folder))
        assert not problems and not odd and n > 20
