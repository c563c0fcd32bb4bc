"""Numeric and lookup columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tenorgrid.functions.fixed import LADDER_BAND, MOVE_BP, OTHER, TAKER_FEE_RATE
from tenorgrid.functions.times import as_col


def number(c: Column | str) -> Column:
    """Numeric text to double; blank or unreadable text to NULL."""
    return F.nullif(F.trim(as_col(c)), F.lit("")).try_cast("double")


def no_nan(c: Column | str) -> Column:
    return F.when(~F.isnan(as_col(c)), as_col(c))


def ratio(num: Column, den: Column) -> Column:
    """Division that is NULL, not an error, where the denominator is zero."""
    return num / F.nullif(den, F.lit(0.0))


def lookup(c: Column | str, table: dict, default=None) -> Column:
    """Value of a fixed dictionary; keys outside it give ``default``."""
    pairs = [F.lit(x) for kv in table.items() for x in kv]
    found = F.try_element_at(F.create_map(*pairs), as_col(c))
    return found if default is None else F.coalesce(found, F.lit(default))


def clamp01(c: Column) -> Column:
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), c))


def mid_price(bid: Column | str, ask: Column | str) -> Column:
    """Middle of the book; NULL where the book is empty (no bid and an offer at the top)."""
    bid, ask = as_col(bid), as_col(ask)
    return F.when(~((bid == 0) & (ask >= 0.99)), (bid + ask) / 2)


def quality_ok(total: Column, stale: Column, n: Column | None = None, n_required: int | None = None,
               half: Column | None = None, max_stale: int = 1, band: tuple[float, float] = LADDER_BAND) -> Column:
    """Quality screen of one ladder row; a missing staleness counts as stale."""
    ok = total.between(*band) & (F.coalesce(stale, F.lit(99)) <= max_stale)
    if n is not None:
        ok = ok & (n == n_required)
    if half is not None:
        ok = (F.coalesce(half, F.lit(0)) == 0) & ok
    return ok


def bucket_change(bp: Column | str) -> Column:
    """Realised change in basis points to its rung; a size between rungs is OTHER."""
    bp = as_col(bp)
    exact = {v: k for k, v in MOVE_BP.items() if abs(v) < 50}
    named = lookup(bp.cast("int"), exact, OTHER)
    return F.when(bp <= -50, "CUT50P").when(bp >= 50, "HIKE50P").when(bp.isNotNull(), named)


def taker_fee(contracts: Column, price: Column) -> Column:
    """Fee in dollars, rounded up to the cent."""
    cents = F.lit(TAKER_FEE_RATE * 100) * contracts * price * (1 - price)
    return F.ceil(F.round(cents, 9)) / 100


def tick_probability(tick: Column, span: Column) -> Column:
    """One price tick as a probability of a 25 bp move."""
    return ratio(tick, F.lit(0.25) * span)
