"""Rules as one pass, landed events, and the panel on a spine that it builds itself."""

import json
import re

from pyspark.sql import functions as F

from tenorgrid.operators.aggregates import bounded_values, set_collapse
from tenorgrid.operators.rules import Rule, broken_rules
from tenorgrid.operators.sketches import distinct_sketches, merged_distinct, range_distinct, standard_error
from tenorgrid.plans import coverage as cov
from tenorgrid.plans.panel import Panel
from tenorgrid.sources.landing import event_anomalies, event_markets, match_events, unreadable_events
from tenorgrid.sources.schemas import VENUE_EVENT_JSON
from tests.helpers import d, rows


def test_rules_of_a_table_share_one_scan(spark):
    df = spark.createDataFrame([(1, 5), (2, None), (3, -1), (None, -2)], "k int, v int")
    rules = [Rule("negative", F.col("v") < 0, F.col("k"), F.col("v")), Rule("small", F.col("v") < 3, F.col("k")), Rule("never", F.lit(None).cast("boolean"), F.col("k"))]
    found = broken_rules(df, rules)
    assert found.columns == ["check", "key", "detail"]
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(
        [("negative", "3", "-1"), ("small", "3", None), ("negative", None, "-2"), ("small", None, None)], key=repr)
    assert broken_rules(df.limit(0), rules).count() == 0
    assert found._jdf.queryExecution().executedPlan().toString().count("Scan") == 1


def scans(df) -> int:
    return df._jdf.queryExecution().optimizedPlan().toString().count("Relation ")


def test_each_input_is_read_once_for_a_grain(spark, tmp_path):
    from tenorgrid.catalog import decisions
    from tenorgrid.catalog.registry import Tables

    t = Tables(spark, "/root/testdata/sf0.001")
    at = lambda name, df: (df.write.parquet(f"{tmp_path}/{name}"), spark.read.schema(df.schema).parquet(f"{tmp_path}/{name}"))[1]
    spine, events = at("spine", decisions.decisions(t)), at("events", decisions.ladder_events(t))
    legs, points = at("legs", decisions.legs(t)), at("points", decisions.point_events(t))
    found = cov.link_anomalies(spine, events, legs, points)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    # Events by row and by month, legs by row and by event, the other venue's events, decisions by row and by month;
    # the spine joins three of them.
    assert plan.count("Relation ") == 10
    assert scans(broken_rules(spine, [Rule(str(k), F.col("delta") > k, F.col("meeting_date")) for k in range(30)])) == 1


INVENTORY = {"title": "t", "start": "", "end": "2026-05-20", "closed": False, "markets": [
    {"q": "No change?", "tokens": '["1","2"]', "outcomes": '["Yes","No"]', "end": "2026-05-21T00:00:00Z"}, {"q": "No change?", "tokens": "broken [", "outcomes": None},
    {"q": "What happens?", "tokens": None, "outcomes": '["Up","Down"]'}]}
VENUE = {"id": "v1", "resolutionSource": "board", "markets": [
    {"id": "7", "slug": "s", "question": " NO CHANGE? ", "conditionId": "", "questionID": "q7", "clobTokenIds": '["8","9"]', "outcomes": '["Yes","No"]', "startDate": "a", "endDate": "b"},
    {"id": "6", "question": "no change?", "conditionId": "0x6", "clobTokenIds": '["1","2"]', "umaResolutionStatus": "resolved", "resolutionSource": "paper"}]}


def test_events_meet_their_records_inside_the_event(spark):
    whole = json.dumps(INVENTORY)
    inventory = spark.createDataFrame([("e", "{}", 1), ("e", whole, 2), ("cut", whole[:90], 1), ("null", None, 1), ("bare", '{"markets": []}', 1), ("alone", whole, 1)],
                                      "event_id string, body string, arrival int")
    venue = spark.createDataFrame([("e", json.dumps(VENUE)), ("alone", '{"markets": [{"id"'), ("other", json.dumps(VENUE))], "event_id string, body string")
    calendar = spark.createDataFrame([(d("2026-03-18"),), (d("2026-06-17"),)], "day date")
    matched = match_events(inventory, venue, calendar, "day")
    got = rows(event_markets(matched).where("event_id = 'e'"), "market_id", "venue_market_id", "market_slug", "question_id", "condition_id", "token_ids", "resolution_source")
    assert got == sorted([("0x6", "6", "", "", "0x6", '["1","2"]', "paper"), ("e#1", "7", "s", "q7", "", '["8","9"]', "board"), ("e#2", "", "", "", "", "[]", "board")])
    first = event_markets(matched).where("market_id = '0x6'").first()
    assert (first.venue_event_id, first.resolution_status, first.decision_date, first.end_date) == ("v1", "resolved", None, "2026-05-21T00:00:00Z")
    assert event_markets(matched).where("event_id = 'alone'").count() == 3 and event_markets(matched).count() == 6
    anomalies = rows(event_anomalies(matched).where("key IN ('e', '0x6') OR key LIKE 'e#%' OR key IN ('bare', 'alone')"), "check", "key")
    assert anomalies == sorted([
        ("event start is empty", "e"), ("no decision near the end", "e"), ("market end differs", "0x6"), ("tokens recovered", "e#1"), ("no condition id", "e#1"),
        ("no matching venue record", "e#2"), ("tokens missing", "e#2"), ("question not mapped", "e#2"), ("no condition id", "e#2"), ("no Yes label", "e#2"),
        ("event start is empty", "alone"), ("no decision near the end", "alone"), ("venue record unreadable", "alone"),
        ("event start is empty", "bare"), ("no decision near the end", "bare"), ("event without markets", "bare")])
    assert rows(unreadable_events(inventory), "event_id", "body") == sorted([("cut", whole[:90]), ("e", "{}"), ("null", None)], key=repr)
    assert rows(unreadable_events(venue, VENUE_EVENT_JSON), "event_id") == [("alone",)]
    assert match_events(inventory.limit(0), venue, calendar, "day").count() == 0


def test_texts_of_an_event_are_read_once(spark):
    inventory = spark.createDataFrame([("e", json.dumps(INVENTORY), 1)], "event_id string, body string, arrival int")
    venue = spark.createDataFrame([("e", json.dumps(VENUE))], "event_id string, body string")
    matched = match_events(inventory, venue, spark.createDataFrame([(d("2026-06-17"),)], "day date"), "day")
    for found in (event_markets(matched), event_anomalies(matched)):
        steps = found._jdf.queryExecution().optimizedPlan().toString().splitlines()
        places = [step for step in steps if "Generate explode" in step and "array_position" in step]
        # No text is read for a pair of a market and a record, and no market carries the lists of its event.
        assert len(places) == 1 and "from_json" not in places[0]
        above = "\n".join(steps[:steps.index(places[0])])
        assert not re.search(r"\b(g|records|record_toks|record_qs|markets)#", above)
        # A body is read by the projection alone.
        assert sum(step.count("from_json(StructField") for step in steps) == 2


def test_first_record_in_order_is_taken(spark):
    def landed(markets, records):
        bodies = [spark.createDataFrame([("e", json.dumps({"markets": b}))], "event_id string, body string") for b in (markets, records)]
        return rows(match_events(*bodies, spark.createDataFrame([], "day date"), "day").select("idx", F.col("r.id").alias("id")), "idx", "id")

    n = 150
    tokens = lambda k: json.dumps([f"{k}y", f"{k}n"])
    markets = [{"q": f"Q{k}?", "tokens": tokens(k)} for k in range(n)]
    records = [{"id": str(k), "question": f" q{k}? ", "clobTokenIds": tokens((k * 7) % n)} for k in range(n)]
    assert landed(markets, records) == sorted(((k, str(next(j for j in range(n) if j * 7 % n == k))) for k in range(n)), key=str)
    twice = [{"id": "a", "question": "x"}, None, {"id": "b", "question": "X ", "clobTokenIds": '["1",null]'}, {"id": "c", "clobTokenIds": ' ["1", null] '}]
    assert landed([{"q": "x"}, {"q": "x", "tokens": '["1",null]'}, {"q": "x", "tokens": '["2"]'}, {"tokens": "["}, None, {"q": "y"}], twice) == [
        (0, "a"), (1, "b"), (2, "a"), (3, None), (4, None), (5, None)]


def test_panel_builds_its_spine(spark):
    calendar = spark.createDataFrame([(d("2026-09-16"),), (d("2026-10-28"),)], "meeting_date date")
    raw = {
        "calendar": calendar,
        "ladder_events": spark.createDataFrame([("KXFEDDECISION-26SEP", 1)], "event_id string, seq int"),
        "legs": spark.createDataFrame([("KXFEDDECISION-26SEP", "H25", "settled", "2026-09-16T17:59:00Z", "yes")], "event_id string, leg string, status string, close string, result string"),
        "point_events": spark.createDataFrame([("a", "Fed decision in September?", "2026-09-16"), ("b", "Dissents?", "2026-10-28"), ("c", "Dissents?", "2027-01-01")],
                                              "event_id string, title string, end string"),
        "target": spark.createDataFrame([(d("2026-09-16"), 4.0), (d("2026-09-17"), 4.25)], "date date, value double"),
        "futures": spark.createDataFrame([("ZQU26", "2026-09")], "contract string, event_id string"),
        "point_markets": spark.createDataFrame([("a", "m", "HOLD", "HOLD", 1.0, "t", "2026-01-01", "2026-09-16")],
                                               "event_id string, market_id string, outcome string, outcome_detail string, volume double, event_title string, start_date string, end_date string"),
    }
    kept = []
    panel = Panel(raw, F.lit("2026-09-16").cast("date"), keep=lambda name, df: (kept.append(name), df)[1])
    assert rows(panel["spine"], "meeting_date", "ladder_result_outcome", "realized_outcome") == [(d("2026-09-16"), "HIKE25", "HIKE25"), (d("2026-10-28"), None, None)]
    assert rows(panel["links"], "meeting_date", "event_id", "role", "is_primary") == [(d("2026-09-16"), "a", "decision", True), (d("2026-10-28"), "b", "other", False)]
    assert kept == ["spine", "links"]
    assert "collect_list" not in panel["links"]._jdf.queryExecution().optimizedPlan().toString()


def test_lists_are_bounded(spark):
    df = spark.createDataFrame([(1, v) for v in "cab"] + [(2, str(k)) for k in range(500)] + [(3, None), (None, "x"), (None, "x")], "k int, v string")
    got = {r.k: (r.n_distinct, r.least, r.largest, r.listed) for r in bounded_values(df, ["k"], "v", most=10).collect()}
    assert got == {1: (3, "a", "c", ["a", "b", "c"]), 2: (500, "0", "99", None), 3: (0, None, None, []), None: (1, "x", "x", ["x"])}
    assert {r.k: r.s for r in set_collapse(df, ["k"], "v", "s", most=10).collect()} == {1: "mixed:a,b,c", 2: "mixed:500 from 0 to 99", 3: None, None: "x"}
    assert bounded_values(df.limit(0), ["k"], "v").count() == 0
    most = bounded_values(df, ["k"], "v", most=10)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in most


def test_sketches_merge(spark):
    df = spark.range(60_000).select((F.col("id") % 30).alias("day"), (F.col("id") % 7000).alias("v"))
    daily = distinct_sketches(df, ["day"], "v")
    assert abs(merged_distinct(daily, []).first()[0] - 7000) < 4 * standard_error() * 7000
    few = distinct_sketches(spark.createDataFrame([(1, 5), (1, 5), (2, None), (2, 6)], "day int, v int"), ["day"], "v")
    assert sorted(map(tuple, merged_distinct(few, ["day"]).collect())) == [(1, 1), (2, 1)]
    days = few.withColumn("day", F.date_add(F.lit("2024-01-01").cast("date"), F.col("day")))
    ranges = spark.createDataFrame([("all", d("2024-01-01"), d("2024-01-09")), ("none", d("2025-01-01"), d("2025-01-02"))], "name string, a date, b date")
    assert rows(range_distinct(days, ranges, "day", "a", "b", "name"), "name", "n_estimate") == [("all", 2), ("none", 0)]
