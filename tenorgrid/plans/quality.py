"""Integrity checks. Every check returns rows; a failing check is a row, not an error."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tenorgrid.functions.fixed import LADDER_BAND, OUTCOMES, SETTLEMENT_TOLERANCE_BP
from tenorgrid.operators.aggregates import exact_quantiles, scoped_report
from tenorgrid.operators.dedup import duplicate_count
from tenorgrid.operators.ordered import monotonic_violations
from tenorgrid.sources.sinks import table_counts


def outside(c: Column, band: tuple[float, float] = LADDER_BAND) -> Column:
    return (c < band[0]) | (c > band[1])


def band_measures(total: str = "sum_raw", band: tuple[float, float] = LADDER_BAND) -> dict:
    value = F.col(total)
    return {
        "n_elig": lambda s: F.count_if(s),
        "n_bad": lambda s: F.count_if(s & outside(value, band)),
        "min_sum": lambda s: F.min(F.when(s, value)),
        "max_sum": lambda s: F.max(F.when(s, value)),
    }


def ladder_band_report(ladder: DataFrame, n_legs: int = len(OUTCOMES)) -> DataFrame:
    """Sum of the quoted ladder against the band, on days when every leg has a bar and a book."""
    base = ladder.where((F.col("n_legs_bar_today") == n_legs) & (F.col("n_legs_quoted") == n_legs))
    return scoped_report(base, {
        "all dates": F.lit(True),
        "inter-decision window": F.col("in_window"),
        "within 60 days": F.col("days_to_decision") <= 60,
        "within 120 days": F.col("days_to_decision") <= 120,
        "all spreads <= 0.05": F.col("max_spread") <= 0.05,
        "all legs two-sided": F.col("n_legs_two_sided") == n_legs,
    }, band_measures(), quantiles=("sum_raw", {"median_sum": 0.5}))


def points_band_report(points: DataFrame, recent_from: str = "2024-06-01") -> DataFrame:
    """The same for the point ladder, on days when every leg was seen and none is the empty-book value."""
    base = points.where((F.col("n_legs_obs_today") == F.col("n_canonical_legs")) & (F.col("n_legs_half") == 0))
    primary = F.col("is_primary")
    window = primary & F.col("in_window")
    return scoped_report(base, {
        "all events, all dates": F.lit(True),
        "primary events": primary,
        "primary, inter-decision window": window,
        "primary, window, recent books": window & (F.col("meeting_date") >= F.lit(recent_from).cast("date")),
        "primary, within 30 days": primary & (F.col("days_to_decision") <= 30),
    }, band_measures(), quantiles=("sum_raw", {"median_sum": 0.5}))


def band_by_event(ladder: DataFrame, by: Sequence[str], eligible: Column) -> DataFrame:
    """Band measures per event over all eligible days and over the inter-decision window."""
    report = scoped_report(ladder.where(eligible), {"all": F.lit(True), "window": F.col("in_window")}, band_measures(), by=by)
    wide = {"all": "", "window": "_w"}
    return report.groupBy(*by).agg(*(
        F.max(F.when(F.col("scope") == s, F.col(m))).alias(m + suffix)
        for s, suffix in wide.items() for m in ("n_elig", "n_bad", "min_sum", "max_sum")))


def violation_profile(ladder: DataFrame, n_legs: int = len(OUTCOMES)) -> DataFrame:
    """Where the band violations lie, and how many days would admit arbitrage on closing quotes."""
    base = ladder.where((F.col("n_legs_bar_today") == n_legs) & (F.col("n_legs_quoted") == n_legs))
    bad = outside(F.col("sum_raw"))
    flat = base.agg(
        F.count_if(F.col("sum_bid") > 1.0).alias("n_bid_over_1"), F.count_if(F.col("sum_ask") < 1.0).alias("n_ask_under_1"),
        F.min(F.when(bad, F.col("days_to_decision"))).alias("nearest_bad"),
        F.count_if(bad & (F.col("days_to_decision") > 120)).alias("n_bad_far"),
        F.count_if(bad & (F.col("n_legs_two_sided") < n_legs)).alias("n_bad_one_sided"))
    median = exact_quantiles(base.where(bad), [], "days_to_decision", {"median_bad": 0.5})
    return flat.withColumn("median_bad", median.scalar())


def check_row(df: DataFrame, name: str, passed: Column, measures: Mapping[str, Column]) -> DataFrame:
    """One-row aggregate as (name, passed, measures)."""
    pairs = [x for k, v in measures.items() for x in (F.lit(k), v.cast("double"))]
    return df.select(F.lit(name).alias("name"), passed.alias("passed"), F.create_map(*pairs).alias("measures"))


def zero_violations(name: str, counted: DataFrame, column: str) -> DataFrame:
    total = counted.agg(F.coalesce(F.sum(column), F.lit(0)).alias("n"))
    return check_row(total, name, F.col("n") == 0, {"violations": F.col("n")})


def unique_check(name: str, df: DataFrame, key: Sequence[str]) -> DataFrame:
    return zero_violations(name, duplicate_count(df, key), "n_duplicates")


def monotonic_check(name: str, df: DataFrame, by: Sequence[str], t: str) -> DataFrame:
    return zero_violations(name, monotonic_violations(df, by, t), "violations")


def settlement_identity(check: DataFrame, first: str, last: str, n_months: int,
                        tol: float = SETTLEMENT_TOLERANCE_BP) -> DataFrame:
    rows = check.where(F.col("ym").between(first, last)).agg(
        F.count("*").alias("n"), F.max(F.abs("diff_bp")).alias("worst"), F.count_if(F.abs("diff_bp") > tol).alias("bad"))
    return check_row(rows, "settlement equals month mean", (F.col("n") == n_months) & (F.col("bad") == 0),
                     {"months": F.col("n"), "max_abs_diff_bp": F.col("worst"), "n_exceed": F.col("bad")})


def point_check(name: str, df: DataFrame, where: Column, value: str, lo: float, hi: float,
                also: Column | None = None) -> DataFrame:
    """One known value lies in its range; a missing row fails."""
    ok = F.col("v").between(lo, hi)
    extra = F.lit(True) if also is None else also
    row = df.where(where).agg(F.max(F.when(extra, F.col(value))).alias("v"))
    return check_row(row, name, F.coalesce(ok, F.lit(False)), {"value": F.col("v")})


def conserved_counts(tables: Mapping[str, DataFrame], inputs: Mapping[str, DataFrame]) -> DataFrame:
    """Row counts of built tables against their inputs, one row per table."""
    built = table_counts(tables)
    raw = table_counts(inputs).withColumnRenamed("n_rows", "n_input")
    return built.join(raw, "table_name", "left").withColumn("passed", F.col("n_rows").eqNullSafe(F.col("n_input")))


def outcome_agreement(df: DataFrame, a: str, b: str) -> DataFrame:
    both = F.col(a).isNotNull() & F.col(b).isNotNull()
    return df.agg(F.count_if(both).alias("n_both"), F.count_if(both & (F.col(a) != F.col(b))).alias("n_differ"))


def key_counts(tables: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """(``table_name``, ``n_rows``, ``n_duplicates``) of many tables from one grouped pass over their keys.

    A key is written as JSON, which keeps NULLs and field names apart. An empty table has a row of zeros.
    """
    names = [F.lit(n) for n in tables]
    parts = [df.select(F.lit(n).alias("table_name"), F.to_json(F.struct(*key)).alias("key"), F.lit(1).alias("n")) for n, (df, key) in tables.items()]
    first = next(iter(tables.values()))[0].sparkSession
    parts.append(first.range(1).select(F.explode(F.array(*names)).alias("table_name"), F.lit(None).cast("string").alias("key"), F.lit(0).alias("n")))
    per_key = reduce(DataFrame.unionAll, parts).groupBy("table_name", "key").agg(F.sum("n").alias("n"))
    return per_key.groupBy("table_name").agg(F.sum("n").alias("n_rows"), F.sum(F.greatest(F.col("n") - 1, F.lit(0))).alias("n_duplicates"))


def rows_of_checks(df: DataFrame, checks: Sequence[tuple[Column, str, Column, Mapping[str, Column]]]) -> DataFrame:
    """(``name``, ``passed``, ``measures``) for each ``(when, name, passed, measures)`` that holds for a row of ``df``."""
    def row(when: Column, name: str, passed: Column, measures: Mapping[str, Column]) -> Column:
        pairs = [x for k, v in measures.items() for x in (F.lit(k), v.cast("double"))]
        return F.when(when, F.struct(F.lit(name).alias("name"), F.coalesce(passed, F.lit(False)).alias("passed"), F.create_map(*pairs).alias("measures")))

    return df.select(F.explode(F.array_compact(F.array(*(row(*c) for c in checks)))).alias("c")).select("c.name", "c.passed", "c.measures")


@dataclass(frozen=True)
class Known:
    """A value that is known: the largest ``value`` of the rows of ``table`` that ``where`` names lies in ``lo .. hi``.

    ``also`` must hold for the row as well; a missing row fails.
    """

    name: str
    table: str
    where: Column
    value: str
    lo: float
    hi: float
    also: Column | None = None


def known_values(t: Mapping[str, DataFrame], known: Sequence[Known]) -> list[DataFrame]:
    """Checks of known values: all those of a table are conditional maxima of one aggregate over it."""
    out = []
    for table in sorted({k.table for k in known}):
        mine = [k for k in known if k.table == table]
        held = [k.where if k.also is None else k.where & k.also for k in mine]
        found = t[table].agg(*(F.max(F.when(w, F.col(k.value)).cast("double")).alias(f"v{i}") for i, (k, w) in enumerate(zip(mine, held))))
        out.append(rows_of_checks(found, [(F.lit(True), k.name, F.col(f"v{i}").between(k.lo, k.hi), {"value": F.col(f"v{i}")})
                                          for i, k in enumerate(mine)]))
    return out


def stack(checks: Sequence[DataFrame]) -> DataFrame:
    out = checks[0]
    for c in checks[1:]:
        out = out.unionAll(c)
    return out


# Key of each table, and the name of the check on it.
KEYS = {
    "quote_bars": ["market_id", "interval", "ts"], "points": ["token_id", "fidelity", "ts"], "trades": ["trade_id"], "futures": ["contract", "date"],
    "rates": ["series_id", "date"], "rates_wide": ["date"], "daily_quotes": ["market_id", "trade_date"], "daily_points": ["market_id", "date"],
}
UNIQUE = {"rates_wide": "rate dates unique", **{t: f"{t.replace('_', ' ')} unique" for t in KEYS if t != "rates_wide"}}
# In order of its time a series increases strictly where no time is repeated.
INCREASING = {"quote_bars": "quote bars increasing", "points": "points increasing"}


def run_checks(t: Mapping[str, DataFrame], inputs: Mapping[str, DataFrame] | None = None, known: Sequence[Known] = (),
               months: tuple[str, str, int] = ("2024-01", "2026-08", 32)) -> DataFrame:
    """All integrity checks of a built panel as (name, passed, measures).

    ``inputs`` are the tables that the panel was built from, under the names of what they became; their rows must be all
    there. Keys of all tables are counted in one grouped pass, which also gives the rows that the inputs are compared
    with, and each other table is read once.
    """
    band = lambda name, report: check_row(report, name, F.col("n_bad") == 0, {
        c: F.col(c) for c in ("n_elig", "n_bad", "min_sum", "median_sum", "max_sum")})
    ladder = ladder_band_report(t["ladder_daily"]).where("scope = 'all dates'")
    points = points_band_report(t["point_ladder_daily"]).where("scope = 'all events, all dates'")
    differ = outcome_agreement(t["spine"], "ladder_result_outcome", "realized_outcome")
    inputs = inputs or {}
    counts = key_counts({n: (t[n], key) for n, key in KEYS.items()} | {f"input {n}": (df.select(F.monotonically_increasing_id().alias("i")), ["i"])
                                                                       for n, df in inputs.items()})
    is_ = lambda n: F.col("table_name") == n
    no_more, found = F.col("n_duplicates") == 0, {"rows": F.col("n_rows"), "violations": F.col("n_duplicates")}
    lost = counts.agg(F.count_if(F.lit(False)).alias("__"), *(
        F.sum(F.when(is_(n), F.col("n_rows")).when(is_(f"input {n}"), -F.col("n_rows")).otherwise(0)).alias(n) for n in inputs)) if inputs else None
    checks = [
        settlement_identity(t["settlement_check"], *months), band("ladder sum in band", ladder), band("point ladder sum in band", points),
        rows_of_checks(counts, [(is_(n), names[n], no_more, found) for names in (UNIQUE, INCREASING) for n in names]),
        check_row(differ, "outcomes agree", F.col("n_differ") == 0, {"n_both": F.col("n_both"), "n_differ": F.col("n_differ")}),
        *known_values(t, known),
    ]
    if lost is not None:
        wrong = reduce(lambda a, b: a + b, [(F.col(n) != 0).cast("int") for n in inputs])
        checks.append(check_row(lost, "row counts conserved", wrong == 0, {"mismatches": wrong}))
    return stack(checks)
