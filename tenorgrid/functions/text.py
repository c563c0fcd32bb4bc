"""Symbol, ticker and question text to typed columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tenorgrid.functions.fixed import CONTINUOUS_SUFFIX, EVENT_TICKER, MONTH_CODES, MONTH_NAMES
from tenorgrid.functions.times import as_col

def normalise_text(c: Column | str) -> Column:
    """Lower case, one kind of dash, comparison signs spelled out."""
    s = F.lower(as_col(c))
    for sign, spelled in (("≤", "<="), ("≥", ">="), ("–", "-"), ("—", "-")):
        s = F.replace(s, F.lit(sign), F.lit(spelled))
    return s


def parse_symbol(c: Column | str) -> Column:
    """Struct ``(product, contract, delivery_month)``; a continuous symbol has no delivery month."""
    contract = F.split_part(as_col(c), F.lit("."), F.lit(1))
    continuous = contract.endswith(CONTINUOUS_SUFFIX)
    head = lambda n: F.substring(contract, F.lit(1), F.length(contract) - n)
    code = F.substring(contract, F.length(contract) - 2, F.lit(1))
    month = F.position(code, F.lit(MONTH_CODES))
    delivery = F.concat(F.lit("20"), F.right(contract, F.lit(2)), F.lit("-"),
                        F.lpad(F.nullif(month, F.lit(0)).cast("string"), 2, "0"))
    return F.struct(
        F.when(continuous, head(2)).otherwise(head(3)).alias("product"),
        contract.alias("contract"),
        F.when(~continuous, delivery).alias("delivery_month"),
    )


def event_month(c: Column | str) -> Column:
    """Struct ``(ym, day)`` of an event ticker; NULL fields when the ticker does not parse."""
    part = lambda i: F.regexp_extract(as_col(c), EVENT_TICKER, i)
    month = F.array_position(F.array(*map(F.lit, MONTH_NAMES)), part(2))
    ym = F.concat(F.lit("20"), part(1), F.lit("-"), F.lpad(F.nullif(month, F.lit(0)).cast("string"), 2, "0"))
    return F.struct(
        F.when(as_col(c).rlike(EVENT_TICKER), ym).alias("ym"),
        part(3).try_cast("int").alias("day"),
    )
