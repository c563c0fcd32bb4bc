"""The whole panel: typed inputs to tables and views."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

from pyspark.sql import Column, DataFrame

from tenorgrid.functions.fixed import EVENT_PREFIX
from tenorgrid.plans import coverage as cov
from tenorgrid.plans import futures as fut
from tenorgrid.plans import ladder as lad
from tenorgrid.plans import quality
from tenorgrid.plans import spine as sp
from tenorgrid.sources.sinks import register_views

Keep = Callable[[str, DataFrame], DataFrame]

INPUTS = ("spine", "quote_bars", "trades", "ladder_markets", "points", "point_markets", "futures", "rates")
# What the spine is built from where it is not an input; ``target`` is the rate that decides the realised change.
SPINE_INPUTS = ("calendar", "ladder_events", "legs", "point_events", "target", "futures")


class Panel(Mapping[str, DataFrame]):
    """Tables of the panel by name, each defined when first asked for.

    Inputs are the typed tables named in ``INPUTS``, with those of ``SPINE_INPUTS`` in place of the spine if that is to be
    built; where an input is enriched (quote bars, futures) the table of
    that name is the enriched one. ``keep(name, df)`` decides what is written out. The spine is joined by almost
    every stage and the two dense grids feed several tables, so a production build passes
    ``lambda name, df: materialise(df, f"panel.{name}")`` to compute each of them once.
    """

    def __init__(self, raw: Mapping[str, DataFrame], fetched_day: Column, keep: Keep = lambda name, df: df,
                 event_prefix: str = EVENT_PREFIX, known: Sequence[quality.Known] = (), months: tuple[str, str, int] = ("2024-01", "2026-08", 32)):
        self.raw = raw
        self.known = known
        self.months = months
        self.fetched_day = fetched_day
        self.keep = keep
        self.event_prefix = event_prefix
        self._made: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._made:
            if name in STAGES:
                df = STAGES[name](self)
                self._made[name] = self.keep(name, df) if name in KEPT else df
            else:
                self._made[name] = self.raw[name]
        return self._made[name]

    def __iter__(self) -> Iterator[str]:
        return iter([*(n for n in self.raw if n not in STAGES), *STAGES])

    def __len__(self) -> int:
        return len(list(iter(self)))

    def publish(self, prefix: str = "v_") -> list[str]:
        """Register every table as a view for SQL use."""
        return register_views({f"{prefix}{name}": self[name] for name in self})


def _spine(p: Panel) -> DataFrame:
    return p.raw["spine"] if "spine" in list(p.raw) else sp.build_spine(*(p.raw[n] for n in SPINE_INPUTS))


def _links(p: Panel) -> DataFrame:
    """From the events themselves where they are at hand: no list per decision lies in between."""
    if "point_events" in list(p.raw):
        return sp.dated_links(p.raw["point_events"], p["spine"])
    return sp.spine_links(p["spine"])


STAGES: dict[str, Callable[[Panel], DataFrame]] = {
    "spine": _spine,
    "windows": lambda p: sp.decision_windows(p["spine"]),
    "quote_bars": lambda p: lad.quote_bars(p.raw["quote_bars"]),
    "futures": lambda p: fut.futures_bars(p.raw["futures"], p.fetched_day),
    "rates_wide": lambda p: fut.rates_wide(p["rates"]),
    "rate_calendar": lambda p: fut.rate_calendar(p["rates_wide"]),
    "links": lambda p: sp.link_events(_links(p), p["point_markets"]),
    "daily_quotes": lambda p: lad.daily_quotes(p["quote_bars"], p.event_prefix),
    "daily_points": lambda p: lad.daily_points(p["points"], p["point_markets"]),
    "ladder_daily": lambda p: lad.ladder_daily(p["daily_quotes"], p["spine"], p["windows"]),
    "point_ladder_daily": lambda p: lad.point_ladder_daily(p["daily_points"], p["links"], p["windows"]),
    "contract_bars": lambda p: fut.contract_bars(p["spine"], p["futures"]),
    "implied_daily": lambda p: fut.implied_daily(p["contract_bars"], p["spine"], p["windows"], p["rates_wide"],
                                                 p["ladder_daily"], p["point_ladder_daily"]),
    "basis_daily": lambda p: fut.basis_daily(p["implied_daily"]),
    "settlement_check": lambda p: fut.settlement_check(p["futures"].where("is_continuous"), p["rate_calendar"],
                                                       within_days=None),
    "coverage_matrix": lambda p: cov.coverage(p["spine"], p["quote_bars"], p["trades"], p["links"], p["points"],
                                              p["contract_bars"], p["basis_daily"]),
    "checks": lambda p: quality.run_checks(p, {n: p.raw[n] for n in ENRICHED}, p.known, p.months),
}

# Inputs that become a table of the same name with more columns and must keep every row.
ENRICHED = ("quote_bars", "futures")

# Tables that several later stages read.
KEPT = {"spine", "windows", "links", "daily_quotes", "daily_points", "basis_daily"}
