"""Scalar building blocks. Missing stays missing: nothing here turns NULL into 0."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Strings that mean "no value" in published cubes (fixed values).
MISSING = ("", ":", "..", "...", "NaN", "nan", "null", "None")


def is_missing(value: Column) -> Column:
    """Whether a published value is absent; a reported 0 is present."""
    return value.isNull() | F.trim(value.cast("string")).isin(*MISSING)


def number(value: Column) -> Column:
    """value as a double, NULL where it doesn't parse or isn't a number."""
    x = value.try_cast("double")
    return F.when(~F.isnan(x), x)


def ratio(a: Column, b: Column, times: float = 1.0, digits: int | None = None) -> Column:
    """a / b * times, NULL where b is 0 or either is missing."""
    out = F.try_divide(a.cast("double") * F.lit(times), b.cast("double"))
    return out if digits is None else F.round(out, digits)


def sum_if(condition: Column, value: Column, zero_fill: bool = False) -> Column:
    """Sum of value where condition holds: NULL, not 0, where no row contributes, unless zero_fill."""
    return F.sum(F.when(condition, value).otherwise(0)) if zero_fill else F.sum(F.when(condition, value))


def tier(value: Column, cuts: list[tuple[float, str]], rest: str, unknown: str = "Unknown") -> Column:
    """The first label whose cut value reaches."""
    out = F.when(value.isNull(), unknown)
    for cut, label in cuts:
        out = out.when(value >= cut, label)
    return out.otherwise(rest)
