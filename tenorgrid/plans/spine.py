"""Decision spine, inter-decision windows and event links."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tenorgrid.functions.fixed import (CONTINUOUS_SUFFIX, DECISION_DATES, DECISION_TITLE, FIRST_PREV_DECISION,
                                       FIRST_PREV_EFFECTIVE, LEG_OUTCOME, OTHER, PRODUCT)
from tenorgrid.functions.text import event_month
from tenorgrid.functions.times import days_in_month, days_to_month_end, month_contract, month_key, next_business_day
from tenorgrid.functions.values import bucket_change, lookup
from tenorgrid.operators.aggregates import set_collapse
from tenorgrid.operators.ordered import rank_primary, window_starts
from tenorgrid.operators.sets import union_tagged, unnest_array
from tenorgrid.operators.skew import dimension_join
from tenorgrid.sources.schemas import SPINE


def decision_calendar(spark: SparkSession) -> DataFrame:
    dates = spark.createDataFrame([(d,) for d in DECISION_DATES], "d string")
    return dates.select(F.col("d").cast("date").alias("meeting_date"))


def calendar_columns(d: Column | str = "meeting_date", product: str = PRODUCT, holidays: bool = True) -> dict[str, Column]:
    """Columns that follow from the decision date alone.

    ``delta`` is the share of the decision's month at the new rate: zero when the decision only takes effect
    in the next month.
    """
    d = F.col(d) if isinstance(d, str) else d
    effective = next_business_day(d, holidays)
    post = F.when(month_key(effective) == month_key(d), days_to_month_end(effective)).otherwise(0)
    return {
        "meeting_month": month_key(d), "effective_date": effective, "month_end": F.last_day(d),
        "days_in_month": days_in_month(d), "days_post": post, "delta": post / days_in_month(d),
        "contract_symbol": month_contract(d, product),
    }


def ladder_links(ladder_events: DataFrame) -> DataFrame:
    """(``event_id``, ``seq``) to one event per month: the first in ``seq`` wins."""
    parsed = ladder_events.select("event_id", "seq", event_month("event_id").alias("m"))
    return parsed.where("m.ym IS NOT NULL").groupBy(F.col("m.ym").alias("meeting_month")).agg(
        F.min_by("event_id", F.struct("seq", "event_id")).alias("ladder_event"))


def ladder_leg_summary(legs: DataFrame) -> DataFrame:
    """Per event: status (or the mix of statuses), earliest close, and the outcome if exactly one leg paid."""
    paid = F.col("result") == "yes"
    outcome = lookup("leg", LEG_OUTCOME, OTHER)
    summary = legs.groupBy("event_id").agg(
        F.min("close").alias("ladder_close"), F.count_if(paid).alias("n_paid"),
        F.max(F.when(paid, outcome)).alias("__paid"))
    summary = summary.withColumn("ladder_result_outcome", F.when(F.col("n_paid") == 1, F.col("__paid")))
    return summary.drop("__paid").join(set_collapse(legs, ["event_id"], "status", "ladder_status"), "event_id", "left")


def point_event_links(point_events: DataFrame) -> DataFrame:
    """(``event_id``, ``title``, ``end``) to sorted id lists per end date: all, decisions, others."""
    dated = point_events.select("event_id", F.substring("end", 1, 10).try_cast("date").alias("meeting_date"),
                                F.coalesce(F.col("title"), F.lit("")).rlike(DECISION_TITLE).alias("is_decision"))
    ids = lambda keep: F.array_sort(F.collect_list(F.when(keep, F.col("event_id"))))
    return dated.where("meeting_date IS NOT NULL").groupBy("meeting_date").agg(
        ids(F.lit(True)).alias("point_events"), ids(F.col("is_decision")).alias("point_events_decision"),
        ids(~F.col("is_decision")).alias("point_events_other"))


def build_spine(calendar: DataFrame, ladder_events: DataFrame, legs: DataFrame, point_events: DataFrame,
                target: DataFrame, futures: DataFrame, product: str = PRODUCT) -> DataFrame:
    """One row per decision date with links to every source.

    ``target`` is (``date``, ``value``); ``futures`` has ``contract`` and ``event_id`` (the bar's month).
    """
    base = calendar.withColumns(calendar_columns(product=product))
    base = base.join(ladder_links(ladder_events), "meeting_month", "left")
    summary = ladder_leg_summary(legs).withColumnRenamed("event_id", "ladder_event").drop("n_paid")
    base = base.join(summary, "ladder_event", "left").withColumn(
        "ladder_status",
        F.when(F.col("ladder_event").isNotNull(), F.coalesce("ladder_status", F.lit("purged"))))
    base = base.join(point_event_links(point_events), "meeting_date", "left")
    empty = F.array().cast("array<string>")
    base = base.withColumns({c: F.coalesce(c, empty) for c in
                             ("point_events", "point_events_decision", "point_events_other")})

    continuous = F.lit(product + CONTINUOUS_SUFFIX)
    named = futures.where(F.col("contract") != continuous).select(F.col("contract").alias("contract_symbol")).distinct()
    months = futures.where(F.col("contract") == continuous).select(F.col("event_id").alias("meeting_month")).distinct()
    base = base.join(named.withColumn("__named", F.lit(True)), "contract_symbol", "left")
    base = base.join(months.withColumn("__month", F.lit(True)), "meeting_month", "left")
    has_named = F.col("__named").isNotNull()
    base = base.withColumns({
        "contract_source": F.when(has_named, "contract").otherwise("continuous_in_month"),
        "contract_source_symbol": F.when(has_named, F.concat("contract_symbol", F.lit(".CBT"))).otherwise(continuous),
        "contract_data_available": has_named | F.col("__month").isNotNull(),
    })
    at = lambda key, name: target.select(F.col("date").alias(key), F.col("value").alias(name))
    base = base.join(at("meeting_date", "__before"), "meeting_date", "left")
    base = base.join(at("effective_date", "__after"), "effective_date", "left")
    change = F.round((F.col("__after") - F.col("__before")) * 100).cast("int")
    base = base.withColumn("realized_change_bp", change).withColumn(
        "realized_outcome", bucket_change("realized_change_bp"))
    return base.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in SPINE.fields))


def decision_windows(spine: DataFrame) -> DataFrame:
    """Previous decision and previous effective date of each decision."""
    return window_starts(spine.select("meeting_date", "effective_date"), "meeting_date", {
        "prev_meeting_date": ("meeting_date", FIRST_PREV_DECISION),
        "prev_effective_date": ("effective_date", FIRST_PREV_EFFECTIVE),
    })


def spine_links(spine: DataFrame) -> DataFrame:
    """(``meeting_date``, ``event_id``, ``role``) from the spine's event lists."""
    role = lambda array: unnest_array(spine.select("meeting_date", array), array, "event_id")
    return union_tagged({"decision": role("point_events_decision"), "other": role("point_events_other")}, "role")


def dated_links(point_events: DataFrame, calendar: DataFrame) -> DataFrame:
    """The same links straight from the events (``event_id``, ``title``, ``end``), without lists per decision."""
    dated = point_events.select("event_id", F.substring("end", 1, 10).try_cast("date").alias("meeting_date"),
                                F.when(F.coalesce(F.col("title"), F.lit("")).rlike(DECISION_TITLE), "decision")
                                .otherwise("other").alias("role"))
    return dated.join(calendar.select("meeting_date"), "meeting_date", "left_semi").select("meeting_date", "event_id", "role")


def link_events(links: DataFrame, markets: DataFrame) -> DataFrame:
    """Event to decision links with role, event totals, and the primary decision event by volume.

    The top bucket of an event means any hike when it has a 25-or-more leg and no exact 25 leg.
    """
    totals = markets.groupBy("event_id").agg(
        F.sum(F.coalesce("volume", F.lit(0.0))).alias("volume"), F.count("*").alias("n_markets"),
        F.count_if(F.col("outcome") != OTHER).alias("n_canonical_legs"),
        (F.bool_or(F.col("outcome_detail") == "HIKE25P") & ~F.bool_or(F.col("outcome") == "HIKE25")).alias("top_is_any_hike"),
        F.max("event_title").alias("event_title"), F.min(F.col("start_date").try_cast("date")).alias("start_date"),
        F.max(F.col("end_date").try_cast("date")).alias("end_date"))
    ranked = rank_primary(dimension_join(links, totals, ["event_id"]), ["meeting_date", "role"], "volume", "event_id")
    return ranked.withColumn("is_primary", (F.col("role") == "decision") & F.col("is_primary"))
