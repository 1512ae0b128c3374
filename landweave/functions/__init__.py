"""Column helpers for names, dates and numbers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def days_in_month(year: Column, month: Column) -> Column:
    return F.day(F.last_day(F.make_date(year, month, F.lit(1))))


def clean_numeric(c: Column) -> Column:
    """A number written with a decimal comma and blanks; what isn't one is NULL."""
    return F.regexp_replace(F.regexp_replace(c, r"[\s']", ""), ",", ".").try_cast("double")


def clean_label(c: Column) -> Column:
    """Lower case, runs of anything but letters and digits as one underscore."""
    return F.lower(F.regexp_replace(F.trim(c), r"[^A-Za-z0-9]+", "_"))


def cut(c: Column, breaks: list[float], right: bool = True) -> Column:
    """Number of the interval (from 1) that holds c; intervals are closed on the right (or left); outside NULL."""
    out = F.lit(None).cast("int")
    for k, (a, b) in reversed(list(enumerate(zip(breaks, breaks[1:], strict=False), 1))):
        out = F.when(((c > a) & (c <= b)) if right else ((c >= a) & (c < b)), k).otherwise(out)
    return out


def ordinal(c: Column, order: list[str]) -> Column:
    """Place of a category in order, from 1; others NULL."""
    return F.nullif(F.array_position(F.array(*map(F.lit, order)), c), F.lit(0)).cast("int")


def combine(cols: list[Column], how: str) -> Column:
    """Cell-wise sum, mean, product, min or max of layers; a NULL in any of them gives NULL."""
    total = lambda op: reduce(op, cols)
    known = reduce(lambda a, b: a & b, (c.isNotNull() for c in cols))
    value = {"sum": lambda: total(lambda a, b: a + b), "mean": lambda: total(lambda a, b: a + b) / len(cols), "product": lambda: total(lambda a, b: a * b), "min": lambda: F.least(*cols), "max": lambda: F.greatest(*cols)}[how]()
    return F.when(known, value)


def parse_layer_name(c: Column) -> dict[str, Column]:
    """Variable, GCM, SSP, window, middle year (from + 15) and month of names like gcm_var_ssp_2011-01-01_2040-12-31_month."""
    low = F.lower(c)
    first = F.nullif(F.regexp_extract(low, r"_(\d{4})-\d\d-\d\d_", 1), F.lit("")).try_cast("int")
    last = F.nullif(F.regexp_extract(low, r"_\d{4}-\d\d-\d\d_(\d{4})-", 1), F.lit("")).try_cast("int")
    part = lambda p: F.nullif(F.regexp_extract(low, p, 1), F.lit(""))
    return {"variable": part(r"(?:^|_)(tasmin|tasmax|tas|pr|rsds)(?:_|$)"), "gcm": part(r"^([a-z0-9-]+)_(?:tas|pr|rsds)"), "ssp": part(r"(?:^|_)(ssp\d{3})(?:_|$)"), "year_from": first, "year_to": last, "mid_year": first + 15, "month": part(r"_(\d{2})$").try_cast("int")}
