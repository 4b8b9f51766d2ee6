"""Scalar column expressions shared by the operators."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

DAYS_PER_YEAR = 365.25
DATE_FORMATS = ["yyyy-MM-dd", "M/d/yyyy", "yyyy-MM-dd HH:mm:ss", "d-MMM-yyyy"]


def holds(predicate: Column) -> Column:
    """A comparison with a missing value counts as false, never as unknown."""
    return F.coalesce(predicate, F.lit(False))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often ``body`` uses it.

    A plain column named inside the lambda of an array function may be computed
    again for each element.
    """
    return F.transform(F.array(value), body)[0]


def parse_date(text: str, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """The first format that fits; text that fits none becomes null."""
    return F.coalesce(
        *[F.try_to_timestamp(F.col(text), F.lit(f)).cast("date") for f in formats]
    )


def survival_days(last: Column, first: Column, offset: Column, fallback: Column | None) -> Column:
    """Whole days between two dates less an offset, else the recorded value."""
    derived = (F.datediff(last, first) - offset).cast("double")
    return derived if fallback is None else F.coalesce(derived, fallback.cast("double"))


def years(days: Column) -> Column:
    return days / F.lit(DAYS_PER_YEAR)


def censored(survival_years: Column, event: Column, horizon: float = 2.0) -> Column:
    """Known to be alive but followed for less than the horizon."""
    return holds((survival_years < horizon) & (event == 0))


def outcome(survival_years: Column, event: Column, horizon: float = 2.0) -> Column:
    """1 when the event is known to fall before the horizon, else 0."""
    return F.when(holds((survival_years < horizon) & (event == 1)), 1).otherwise(0)


def either_equals(left: Column, right: Column, value: str) -> Column:
    """``yes`` when one of the two equals ``value``, ``no`` otherwise or when unknown."""
    return F.when(holds(left == value) | holds(right == value), "yes").otherwise("no")


def to_byte(value: Column) -> Column:
    """A number cut to an unsigned byte, with wrap-around; not-a-number becomes 0."""
    return F.when(
        value.isNull() | F.isnan(value) | (F.abs(value) == float("inf")), F.lit(0)
    ).otherwise(F.pmod(value.cast("long"), F.lit(256)).cast("int"))


def display_name(name: Column) -> Column:
    """``clinical_joined`` -> ``Clinical Joined``."""
    return F.initcap(F.replace(name, F.lit("_"), F.lit(" ")))


def feature_name(qualified: Column) -> Column:
    """The part after the ``__`` that separates the processing group."""
    parts = F.split(qualified, "__")
    return F.coalesce(F.get(parts, F.lit(1)), qualified)


def percent(share: Column, digits: int = 1) -> Column:
    return F.concat(F.bround(share * 100, digits).cast("string"), F.lit("%"))
