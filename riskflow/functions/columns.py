"""Column expressions shared by the operators. All are built-in, so they stay in generated code."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F

from riskflow import constants as C
from riskflow.schemas import ITEMS_DDL


def event_level(event_type: Column) -> Column:
    return (
        F.when(event_type.isin(C.LEVEL_1_EVENTS), "L1").when(event_type.isin(C.LEVEL_2_EVENTS), "L2").otherwise("L3")
    )


def percent(part: Column, whole: Column) -> Column:
    """Share in percent, two decimals, as float; null for a null count or an empty whole."""
    return F.round(F.try_divide(part.cast("double"), whole.cast("double")) * 100, 2).cast("float")


def midpoint(start: Column, finish: Column) -> Column:
    """Middle of two timestamps; an odd microsecond rounds up."""
    lo, hi = F.unix_micros(start), F.unix_micros(finish)
    return F.timestamp_micros(lo + F.ceil((hi - lo) / 2))


def time_of_day(hour: Column) -> Column:
    return (
        F.when(hour < 6, "night").when(hour < 12, "morning").when(hour < 18, "afternoon").otherwise("evening")
    )


def as_of_date(as_of: dt.date | None) -> Column:
    """The day that ages are counted to: a fixed date for repeatable runs, else today."""
    return F.current_date() if as_of is None else F.lit(as_of)


def whole_years(since: Column, as_of: dt.date | None) -> Column:
    """Completed years of 365 days."""
    return F.floor(F.datediff(as_of_date(as_of), since) / 365)


def age_bin(age: Column) -> Column:
    """Ten-year bins from 10 to 59. A missing age falls in the open last bin."""
    decade = (F.floor(age / 10) * 10).cast("int")
    return (
        F.when(age < 10, "<10")
        .when(age < 60, F.concat(decade.cast("string"), F.lit("-"), (decade + 9).cast("string")))
        .otherwise("60+")
    )


def geolocation(lat: Column, long: Column) -> Column:
    return F.concat(lat.cast("string"), F.lit(","), long.cast("string"))


def items(product_metadata: Column) -> Column:
    return F.from_json(product_metadata, ITEMS_DDL)


def item_quantities(product_metadata: Column) -> Column:
    """Quantities of the items as an array; only this field is parsed out of the JSON."""
    return items(product_metadata)["quantity"]


def array_total(numbers: Column) -> Column:
    """Sum of an int array as bigint, null when it holds no value (as SQL sum)."""
    return F.aggregate(
        numbers, F.lit(None).cast("long"), lambda total, x: F.coalesce(total + x, total, x.cast("long"))
    )


def label_name(label: Column) -> Column:
    """Display name of a class; null for any other value."""
    named = None
    for value, name in C.LABEL_NAMES.items():
        named = F.when(label == value, name) if named is None else named.when(label == value, name)
    return named


def label_color(label: Column) -> Column:
    return F.when(label == 1, F.array(*map(F.lit, C.FRAUD_COLOR))).otherwise(F.array(*map(F.lit, C.CLEAN_COLOR)))


def unit_hash(key: Column, seed: int, purpose: str = "") -> Column:
    """A number in [0, 1) fixed by key and seed, so that a sample does not depend on partitioning."""
    digest = F.md5(F.concat(key.cast("string"), F.lit(f":{purpose}{seed}")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)
