"""Sums and averages that read transaction rows and pre-summed transaction totals alike.

Amounts stored as decimals are added up at their own scale. Double amounts are added up as whole units of
10^-AMOUNT_SCALE: the sum is exact, the same in any order, and cheaper than a decimal sum. A double that is no multiple of
that unit raises an error, and so does a sum beyond a long; nothing is rounded.

A totals DataFrame (see ``plans.views.transaction_totals``) holds, per group, the number of rows in ``row_weight``, the
sum of each measure (``<measure>__units`` for doubles) and the number of its non-null values (``<measure>__rows``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROW_WEIGHT = "row_weight"
#: Decimals that a double amount may carry.
AMOUNT_SCALE = 4
UNITS = 10**AMOUNT_SCALE


def present_name(measure: str) -> str:
    return f"{measure}__rows"


def units_name(measure: str) -> str:
    return f"{measure}__units"


def is_double(df: DataFrame, measure: str) -> bool:
    return isinstance(df.schema[measure].dataType, (T.DoubleType, T.FloatType))


def units(c: Column) -> Column:
    """A double amount as a whole number of units; an amount with more decimals than AMOUNT_SCALE raises an error."""
    scaled = c * UNITS
    # A double near a multiple of the unit differs from it by its own precision only.
    off = F.abs(scaled - F.rint(scaled)) > F.greatest(F.lit(1e-6), F.abs(scaled) * 1e-14)
    odd = F.raise_error(F.concat(F.lit(f"an amount has more than {AMOUNT_SCALE} decimals: "), c.cast("string"))).cast("long")
    return F.when(off, odd).otherwise(F.rint(scaled).cast("long"))


def row_count(df: DataFrame) -> Column:
    return F.sum(ROW_WEIGHT) if ROW_WEIGHT in df.columns else F.count(F.lit(1))


def present(df: DataFrame, measure: str) -> Column:
    """Number of non-null values of ``measure``."""
    weight = present_name(measure)
    return F.sum(weight) if weight in df.columns else F.count(measure)


def total(df: DataFrame, measure: str) -> Column:
    """Exact sum: a double for double amounts, else the sum type of the column."""
    summed_units = units_name(measure)
    if summed_units in df.columns:
        return F.sum(summed_units).cast("double") / UNITS
    if is_double(df, measure):
        return F.sum(units(F.col(measure))).cast("double") / UNITS
    return F.sum(measure)


def mean(df: DataFrame, measure: str) -> Column:
    """Average as a double, from the exact sum; null for a group without values."""
    return F.try_divide(total(df, measure).cast("double"), present(df, measure).cast("double"))


def summed(df: DataFrame, keys: list[str], measures: list[str]) -> DataFrame:
    """Rows summed per ``keys`` with the weights that keep counts and averages exact afterwards."""
    sums = [F.sum(units(F.col(m))).alias(units_name(m)) if is_double(df, m) else F.sum(m).alias(m) for m in measures]
    weights = [F.count(m).alias(present_name(m)) for m in measures]
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(ROW_WEIGHT), *sums, *weights)
