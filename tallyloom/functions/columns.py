"""Column expressions: segments, bands, scores, flags."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Thresholds and labels whose results must stay comparable.
SPEND_BOUNDS = (1000, 500)
VALUE_LABELS = ("High Value", "Medium Value", "Low Value")
LOYALTY_LABELS = ("VIP", "Regular", "Occasional")
DISCOUNT_LABELS = ("No Discount", "1-10%", "11-20%", ">20%")
SEVERITY = {"CRITICAL": 5, "ERROR": 4, "WARN": 3, "INFO": 2}
ALERT_LEVELS = ("CRITICAL", "ERROR")
SENSOR_ID_PATTERN = "^SENS[0-9]{3}$"
TEMPERATURE_RANGE = (-50, 50)
HUMIDITY_RANGE = (0, 100)
BATTERY_MINIMUM = 10


def as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def segment(c: Column | str, bounds: Sequence[float] = SPEND_BOUNDS, labels: Sequence[str] = VALUE_LABELS) -> Column:
    """Label of the first (descending) bound that the value exceeds; the last label for the rest and for null."""
    if len(labels) != len(bounds) + 1:
        raise ValueError("one label more than bounds is needed")
    value = as_column(c)
    steps = zip(bounds, labels)
    first_bound, first_label = next(steps)
    chain = F.when(value > F.lit(first_bound), first_label)
    for bound, label in steps:
        chain = chain.when(value > F.lit(bound), label)
    return chain.otherwise(labels[-1])


def discount_band(c: Column | str) -> Column:
    """Band of a discount; null and negative values fall into the last band with those above 20."""
    value = as_column(c)
    none, low, middle, rest = DISCOUNT_LABELS
    return (
        F.when(value == 0, none)
        .when((value > 0) & (value <= 10), low)
        .when((value > 10) & (value <= 20), middle)
        .otherwise(rest)
    )


def severity(c: Column | str) -> Column:
    """Score of a log level, 1 for any level without its own score."""
    scores = F.create_map(*[F.lit(x) for pair in SEVERITY.items() for x in pair])
    return F.coalesce(F.try_element_at(scores, as_column(c)), F.lit(1))


def alert_required(c: Column | str) -> Column:
    return F.coalesce(as_column(c).isin(*ALERT_LEVELS), F.lit(False))


def temperature_alert(c: Column | str, high: float = 30, low: float = 10) -> Column:
    value = as_column(c)
    return F.when(value > high, "HIGH_TEMP").when(value < low, "LOW_TEMP").otherwise("NORMAL")


def joined_text(cols: Sequence[str], sep: str = "-") -> Column:
    """Columns joined by ``sep``; null as soon as one part is null."""
    parts: list[Column] = []
    for name in cols:
        parts += [F.lit(sep), F.col(name)]
    return F.concat(*parts[1:])


def within(c: Column | str, bounds: tuple[float, float]) -> Column:
    return as_column(c).between(*bounds)


def all_of(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def certain(condition: Column) -> Column:
    """The condition with unknown taken as false."""
    return F.coalesce(condition, F.lit(False))


def first_match(rules: Mapping[str, Column], unmatched: str = "unmatched") -> Column:
    """Name of the first rule that holds."""
    return F.coalesce(*[F.when(rule, F.lit(name)) for name, rule in rules.items()], F.lit(unmatched))


def every_match(rules: Mapping[str, Column], unmatched: str = "unmatched") -> Column:
    """Names of all rules that hold, or the single name ``unmatched``."""
    names = F.filter(F.array(*[F.when(rule, F.lit(name)) for name, rule in rules.items()]), lambda x: x.isNotNull())
    return F.when(F.size(names) > 0, names).otherwise(F.array(F.lit(unmatched)))
