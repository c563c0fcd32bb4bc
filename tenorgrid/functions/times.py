"""Time, calendar and contract-month columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

from tenorgrid.functions.fixed import MARKET_ZONE, MONTH_CODES

_MONDAY, _THURSDAY, _FRIDAY, _SATURDAY = 2, 5, 6, 7


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def local_date(ts: Column | str, zone: str = MARKET_ZONE, shift_s: int = 0) -> Column:
    """Calendar date of epoch seconds in a named zone; ``shift_s`` moves a bar end into the day it covers."""
    seconds = as_col(ts) - F.lit(shift_s)
    return F.to_date(F.from_utc_timestamp(F.timestamp_seconds(seconds), zone))


def epoch_iso(ts: Column | str) -> Column:
    return F.date_format(F.timestamp_seconds(as_col(ts)), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def iso_timestamp(text: Column | str) -> Column:
    """ISO text, date only or with time and zone, to a timestamp; blank or unreadable text to NULL."""
    return F.nullif(F.trim(as_col(text)), F.lit("")).try_cast("timestamp")


def iso_epoch(text: Column | str) -> Column:
    return F.unix_seconds(iso_timestamp(text))


def month_key(d: Column | str) -> Column:
    return F.date_format(as_col(d), "yyyy-MM")


def month_index(d: Column | str) -> Column:
    return F.year(as_col(d)) * 12 + F.month(as_col(d))


def time_bucket(ts: Column | str, seconds: int) -> Column:
    return F.floor(as_col(ts) / F.lit(seconds)).cast("long")


def days_in_month(d: Column | str) -> Column:
    return F.dayofmonth(F.last_day(as_col(d)))


def days_to_month_end(d: Column | str) -> Column:
    """Days from ``d`` to the end of its month, both included."""
    return F.datediff(F.last_day(as_col(d)), as_col(d)) + 1


def month_contract(d: Column | str, product: Column | str) -> Column:
    """Label of the contract that delivers in the calendar month of ``d``."""
    product = F.lit(product) if isinstance(product, str) else product
    code = F.substring(F.lit(MONTH_CODES), F.month(as_col(d)), F.lit(1))
    return F.concat(product, code, F.lpad((F.year(as_col(d)) % 100).cast("string"), 2, "0"))


def is_weekend(d: Column | str) -> Column:
    return F.dayofweek(as_col(d)).isin(1, 7)


def is_federal_holiday(d: Column | str) -> Column:
    """US federal holidays by rule; fixed dates move to the nearest weekday."""
    d = as_col(d)

    def on(day: Column, month: int, dom: int) -> Column:
        return (F.month(day) == month) & (F.dayofmonth(day) == dom)

    def observed(month: int, dom: int) -> Column:
        return (
            (~is_weekend(d) & on(d, month, dom))
            | ((F.dayofweek(d) == _MONDAY) & on(F.date_sub(d, 1), month, dom))
            | ((F.dayofweek(d) == _FRIDAY) & on(F.date_add(d, 1), month, dom))
        )

    def floating(month: int, weekday: int, first: int, last: int) -> Column:
        return (F.month(d) == month) & (F.dayofweek(d) == weekday) & F.dayofmonth(d).between(first, last)

    rules = [
        observed(1, 1),
        floating(1, _MONDAY, 15, 21),
        floating(2, _MONDAY, 15, 21),
        floating(5, _MONDAY, 25, 31),
        observed(6, 19) & (F.year(d) >= 2021),
        observed(7, 4),
        floating(9, _MONDAY, 1, 7),
        floating(10, _MONDAY, 8, 14),
        observed(11, 11),
        floating(11, _THURSDAY, 22, 28),
        observed(12, 25),
    ]
    return reduce(lambda a, b: a | b, rules)


def next_weekday(d: Column | str) -> Column:
    d = as_col(d)
    return F.date_add(d, F.when(F.dayofweek(d) == _FRIDAY, 3).when(F.dayofweek(d) == _SATURDAY, 2).otherwise(1))


def next_business_day(d: Column | str, holidays: bool = True) -> Column:
    """First open day after ``d``. No two holidays fall on consecutive weekdays, so one is skipped at most."""
    first = next_weekday(d)
    if not holidays:
        return first
    return F.when(is_federal_holiday(first), next_weekday(first)).otherwise(first)
