"""Skew-safe forms give what the plain forms give, whatever the bucket width; brute force on small data."""

import datetime as dt
import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import Window, functions as F

from tenorgrid.operators.aggregates import exact_quantiles, scoped_report
from tenorgrid.operators.asof import asof_join
from tenorgrid.operators.dedup import dedup_keep_last, upsert
from tenorgrid.operators.joins import join_split
from tenorgrid.operators.ordered import monotonic_violations, previous_row, rank_primary, stale_value_flag, variety_gate
from tenorgrid.operators.skew import Sized, per_days, per_seconds, dimension_join, running_total, with_buckets
from tests.helpers import d, order, rows

SMALL = settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def hot_series(seed, n=400):
    """Two thirds of the rows on one key; times repeat."""
    rnd = random.Random(seed)
    return [(rnd.choice("aab"), rnd.randrange(0, 500), i, rnd.choice([None, 0.1, 0.2, 0.5, 0.99])) for i in range(n)]


@pytest.mark.parametrize("strict", [False, True])
@pytest.mark.parametrize("width", [None, 1, 7, 1000])
def test_asof_join(spark, strict, width):
    left = [(k, t, i) for k, t, i, _ in hot_series(1, 200)] + [(None, 5, 900), ("a", None, 901), ("z", 3, 902)]
    right = [(k, t, v) for k, t, v in {(k, t): (k, t, v) for k, t, _, v in hot_series(2, 80)}.values()] + [(None, 1, 0.3)]
    l = spark.createDataFrame(left, "k string, t long, i long")
    r = spark.createDataFrame(right, "k string, rt long, v double")
    out = asof_join(l, r, ["k"], "t", "rt", strict, bucket=width and per_seconds(width))
    got = {x.i: (x.matched_t, x.v) for x in out.collect()}
    for k, t, i in left:
        seen = [(rt, v) for rk, rt, v in right if k is not None and t is not None and rk == k and (rt < t if strict else rt <= t)]
        best = max(seen, key=lambda x: x[0]) if seen else (None, None)
        assert got[i] == best
        assert not strict or best[0] is None or best[0] < t


@pytest.mark.parametrize("width", [1, 13, 600])
def test_previous_row_and_running_total(spark, width):
    df = spark.createDataFrame(hot_series(3), "k string, t long, i long, v double")
    for build in (lambda b: previous_row(df, ["k"], ["t", "i"], ["t", "v"], "p", b),
                  lambda b: running_total(df, ["k"], ["t", "i"], F.col("i"), "p", b)):
        plain, bucketed = build(None), build(per_seconds(width))
        assert rows(plain, "k", "t", "i", "v", "p") == rows(bucketed, "k", "t", "i", "v", "p")


@pytest.mark.parametrize("target", [7, 10_000])
def test_sized_buckets_give_the_same(spark, target):
    df = spark.createDataFrame(hot_series(3) + [("c", None, 1000, 0.3), ("c", 5, 1001, 0.4), (None, 7, 1002, 0.5), (None, 7, 1003, None)], "k string, t long, i long, v double")
    for build in (lambda b: previous_row(df, ["k"], ["t", "i"], ["t", "v"], "p", b), lambda b: running_total(df, ["k"], ["t", "i"], F.col("i"), "p", b)):
        plain, sized = build(None), build(Sized(target))
        assert rows(plain, *plain.columns) == rows(sized, *plain.columns)


def test_a_key_with_all_rows_in_one_day_is_split(spark):
    """Two thirds of all rows are one key's of one day, most of them within a minute of it; a single older row widens its range."""
    day = 86400 * 1_000_000
    t = F.when(F.col("id") == 0, 0).when(F.col("id") % 3 == 0, F.col("id") * 1000).otherwise(day * 20_000 + F.col("id") * 500)
    df = spark.range(60_000).select(F.when(F.col("id") % 3 == 0, F.concat(F.lit("k"), F.col("id") % 50)).otherwise("hot").alias("k"),
                                    F.timestamp_micros(t.cast("long")).alias("t"), "id").union(spark.createDataFrame([("hot", dt.datetime(1971, 1, 1), -1)], "k string, t timestamp, id long"))
    cut = with_buckets(df, ["k"], "t", Sized(2000))
    sizes = {(r.k, r.b): r.n for r in cut.groupBy("k", F.col("__bucket").cast("string").alias("b")).agg(F.count("*").alias("n")).collect()}
    assert sum(k == "hot" for k, _ in sizes) >= 20 and max(sizes.values()) <= 2 * 2000
    order = Window.partitionBy("k").orderBy("t")
    assert cut.withColumn("p", F.lag("__bucket").over(order)).where("p > __bucket").count() == 0
    left = df.where("id % 7 = 0").select("k", "t", "id")
    same = lambda bucket: asof_join(left, df.where("id % 5 = 0").select("k", F.col("t").alias("rt"), F.col("id").alias("rid")), ["k"], "t", "rt", bucket=bucket)
    assert same(Sized(500)).exceptAll(same(None)).count() == 0 and same(Sized(500)).count() == left.count()


@pytest.mark.parametrize("width", [5, 60])
def test_variety_gate(spark, width):
    data = hot_series(4)
    df = spark.createDataFrame(data, "k string, t long, i long, v double")
    for bucket in (None, per_seconds(3)):
        got = {x.i: (x.n_distinct, x.is_live) for x in variety_gate(df, ["k"], "t", "v", width, bucket=bucket).collect()}
        for k, t, i, v in data:
            n = len({w for kk, tt, _, w in data if kk == k and t - width <= tt <= t and w is not None and 0.05 <= w <= 0.95})
            live = n >= 2 if v is not None and 0.05 <= v <= 0.95 else True
            assert got[i] == (n, live)


@SMALL
@given(st.lists(st.tuples(st.sampled_from("aab"), st.floats(-1e6, 1e6, allow_nan=False)), min_size=1, max_size=150),
       st.floats(0, 1))
def test_exact_quantiles(spark, data, p):
    df = spark.createDataFrame(data, "k string, v double")
    got = {x.k: x for x in exact_quantiles(df, ["k"], "v", {"q": p, "median": 0.5}).collect()}
    for k in {k for k, _ in data}:
        v = [x for kk, x in data if kk == k]
        assert got[k].q == pytest.approx(np.quantile(v, p), rel=1e-9, abs=1e-6)
        assert got[k].median == pytest.approx(np.median(v), rel=1e-9, abs=1e-6)


def test_quantiles_of_one_heavy_value_and_many_tails(spark):
    v = [0.5] * 5000 + [i / 7 for i in range(3000)]
    df = spark.createDataFrame([(x,) for x in v], "v double")
    got = exact_quantiles(df, [], "v", {"a": 0.01, "b": 0.5, "c": 0.99}).first()
    assert list(got) == pytest.approx(list(np.quantile(v, [0.01, 0.5, 0.99])))


@SMALL
@given(st.permutations(range(12)), st.integers(1, 11))
def test_keep_last_ignores_order_and_chunks(spark, positions, cut):
    base = [("2022-01-03", "A", float(i % 5), i // 3) for i in range(8)] + [("2022-01-04", "B", float(i), i) for i in range(4)]
    feed = [base[i] for i in positions]
    df = lambda part: spark.createDataFrame(part, "day string, symbol string, price double, recv long")
    key = ["day", "symbol"]
    whole = dedup_keep_last(df(feed), key, ["recv"])
    parts = [dedup_keep_last(df(p), key, ["recv"]) for p in (feed[:cut], feed[cut:])]
    again = dedup_keep_last(parts[0].unionByName(parts[1]), key, ["recv"])
    expected = sorted([("2022-01-03", "A", 2.0, 2), ("2022-01-04", "B", 3.0, 3)], key=order)
    assert rows(whole, *whole.columns) == rows(again, *whole.columns) == expected


def test_upsert_new_wins(spark):
    old = spark.createDataFrame([(1, 0.9), (2, 0.8)], "t int, p double")
    new = spark.createDataFrame([(2, 0.1), (3, 0.2)], "t int, p double")
    assert rows(upsert(old, new, ["t"]), "t", "p") == [(1, 0.9), (2, 0.1), (3, 0.2)]


def test_dimension_join_keeps_every_row(spark):
    left = spark.createDataFrame([("hot", i) for i in range(500)] + [("none", -1), (None, -2)], "k string, i int")
    right = spark.createDataFrame([("hot", 1.5), ("cold", 2.5)], "k string, w double")
    out = dimension_join(left, right, ["k"])
    assert out.count() == 502 and out.where("w = 1.5").count() == 500
    assert dimension_join(left, right, ["k"], "left_anti").count() == 2
    with pytest.raises(ValueError):
        dimension_join(left, right, ["k"], "full")


def test_join_split_equals_or_join(spark):
    dim = spark.createDataFrame([(1, "x", "A", "m1"), (2, "y", "B", "m1"), (3, "y", "C", "m2"), (4, "z", "A", "m1")],
                                "id int, source string, contract string, month string")
    facts = spark.createDataFrame([("A", "m1", True, 1), ("A", "m2", False, 2), ("B", "m1", True, 3), ("C", "m2", False, 4)],
                                  "c string, ym string, cont boolean, f int")
    out = join_split(dim, facts, [(F.col("source") == "x", F.col("contract"), F.lit(True), F.col("c")),
                                  (F.col("source") == "y", F.col("month"), F.col("cont"), F.col("ym"))])
    assert rows(out, "id", "f") == [(1, 1), (1, 2), (2, 1), (2, 3)]
    plan = out._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_rank_primary_nulls_and_ties(spark):
    df = spark.createDataFrame([("m", "b", 5.0), ("m", "a", 5.0), ("m", "c", None), ("n", "y", None), ("n", "x", None)],
                               "g string, id string, v double")
    assert rows(rank_primary(df, ["g"], "v", "id").where("is_primary"), "g", "id") == [("m", "a"), ("n", "x")]


@pytest.mark.parametrize("bucket", [None, per_days(2)])
def test_stale_value_flag_is_three_valued(spark, bucket):
    df = spark.createDataFrame([("c", d(f"2026-01-0{i + 1}"), v) for i, v in enumerate([5, 5, 0, None])], "c string, d date, v long")
    got = [r.f for r in stale_value_flag(df, ["c"], ["d"], "v", "f", bucket).orderBy("d").collect()]
    assert got == [None, True, True, None]


def test_monotonic_violations(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("a", 1), ("a", 2), ("b", 1), ("b", None)], "k string, t long")
    assert rows(monotonic_violations(df, ["k"], "t"), "k", "violations") == [("a", 2), ("b", 0)]


def test_scope_without_rows_reports(spark):
    df = spark.createDataFrame([(1.0,), (2.0,)], "v double")
    out = scoped_report(df, {"all": F.lit(True), "none": F.col("v") > 9, "null": F.lit(None).cast("boolean")},
                        {"n": lambda s: F.count_if(s)}, quantiles=("v", {"m": 0.5}))
    assert rows(out, "scope", "n", "m") == [("all", 2, 1.5), ("none", 0, None), ("null", 0, None)]


def test_salts_are_stable_columns_and_equal_rows_need_no_salt(spark):
    left = spark.createDataFrame([("hot", 7, 1.5, "text")] * 2000 + [("cold", 8, 2.5, "text")], "k string, i int, x double, t string")
    right = spark.createDataFrame([("hot", 1), ("cold", 2)], "k string, w int")
    for salted in (dimension_join(left, right, ["k"]), dimension_join(left, right, ["k"], salt_by=["i"], salts=4)):
        assert salted.groupBy("w").count().orderBy("w").collect() == [(1, 2000), (2, 1)]
    with pytest.raises(ValueError):
        dimension_join(left, right, ["k"], salt_by=["x"])


def test_dimension_join_reads_only_the_columns_in_use(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = dimension_join(docs, docs.groupBy("lang").count(), ["lang"]).select("doc_id", "count")._jdf.queryExecution().executedPlan().toString()
    assert "text" not in plan and "n_chars" not in plan


def test_keep_last_moves_every_column_once(spark):
    df = spark.createDataFrame([(1, "a", 5, None), (1, "b", 6, "x"), (1, "c", 6, "y"), (2, None, None, "z")], "k int, a string, t int, b string")
    assert rows(dedup_keep_last(df, ["k"], ["t"]), "k", "a", "t", "b") == [(1, "c", 6, "y"), (2, None, None, "z")]
    assert rows(dedup_keep_last(df, ["k"], [F.col("t") * -1], ["a"]), "k", "a", "t", "b") == [(1, "a", 5, None), (2, None, None, "z")]
    struct = [f.dataType for f in df.groupBy("k").agg(F.max(F.struct("t", "a", "b"))).schema][1]
    assert len(struct.fields) == 3
