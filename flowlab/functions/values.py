"""Cleaning rules for one value: text to number, class labels, null handling."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column
from pyspark.sql import functions as F

# The spellings of infinity that a raw flow file uses for "no value", the class
# that is not an attack, and the name under which all web attacks are counted.
SENTINELS = ("Infinity", "-Infinity", "inf", "-inf")
BENIGN = "BENIGN"
WEB_MARK = "WEB"
WEB_CLASS = "WEB_ATTACK"


def is_sentinel(name: str) -> Column:
    return F.col(name).isin(*SENTINELS)


def finite_or_null(value: Column) -> Column:
    """NULL for NaN and both infinities, whatever their spelling was."""
    return F.when(F.abs(value) < F.lit(float("inf")), value)  # NaN is above infinity


def not_nan(value: Column) -> Column:
    """NULL for NaN; NULL and infinities stay as they are."""
    return F.when(~F.isnan(value), value)


def number(name: str, strict: bool = False) -> Column:
    """Text to double: sentinels and text that is no number give NULL.

    ``try_cast`` keeps the rule the same with ANSI mode on, where a plain cast stops the job at
    the first bad field. ``strict`` also nulls the infinities and NaNs spelled in other ways.
    """
    value = F.col(name).try_cast("double")
    # strict needs no look at the sentinels: where one is a number, it is infinite
    return finite_or_null(value) if strict else F.when(~is_sentinel(name), value)


def cast_failed(name: str) -> Column:
    """True where there is text that is neither a sentinel nor a number."""
    return F.col(name).isNotNull() & ~is_sentinel(name) & F.col(name).try_cast("double").isNull()


def no_negative(names: list[str], keep_nulls: bool = False) -> Column:
    """Row predicate: no column of ``names`` is below zero.

    A NULL makes the comparison unknown, so by default the row goes, as it does under
    ``NOT (a < 0 OR b < 0 ...)``. Written as a conjunction, every term can reach a Parquet scan.
    NaN counts as larger than any number and passes.
    """
    terms = [F.col(n) >= 0 for n in names]
    if keep_nulls:
        terms = [F.coalesce(t, F.lit(True)) for t in terms]
    return reduce(and_, terms, F.lit(True))


def standard_label(name: str) -> Column:
    """Upper case without padding; every class that names WEB becomes one class."""
    text = F.trim(F.upper(F.col(name)))
    return F.when(text.contains(WEB_MARK), F.lit(WEB_CLASS)).otherwise(text)


def attack_flag(name: str) -> Column:
    """0.0 for the benign class and 1.0 for anything else, a missing label included."""
    return F.when(F.col(name) == BENIGN, F.lit(0.0)).otherwise(F.lit(1.0))


def clamp(value: Column, lower: float, upper: float) -> Column:
    """``value`` held inside [lower, upper]; NULL stays NULL (least/greatest would fill it)."""
    return F.when(value < lower, F.lit(lower)).when(value > upper, F.lit(upper)).otherwise(value)
