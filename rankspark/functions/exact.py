"""Sums of doubles that do not depend on row order.

Each addend is turned into a whole number of 1e-11 units and the numbers are
added.  A task that is run again, or a shuffle that delivers rows in another
order, therefore gives the same score and the same ranking.  ``exact_sum`` adds
decimals of 38 digits; ``units`` gives BIGINTs for the sums of scoring, and an
addend that does not fit raises, in ANSI mode or not.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNIT = 1e11
# Below this an addend's units fit into a BIGINT.
FITS = 9.2e7
# Below this they fit into a decimal of 28 digits.
LARGEST = 9.9e16
RANK_DIGITS = 9
SHOWN_DIGITS = 6


def units(x: Column) -> Column:
    """``x`` in whole units, NULL as 0; a value that does not fit raises."""
    x = F.coalesce(x, F.lit(0.0))
    inside = F.floor(x * F.lit(UNIT) + F.lit(0.5)).cast("bigint")
    problem = F.raise_error(F.concat(F.lit("addend too large for a score: "), x.cast("string")))
    return F.when(F.abs(x) < FITS, inside).otherwise(problem.cast("bigint"))


def total_units(x: Column) -> Column:
    """Sum of BIGINT units of at least one row, none of them NULL; one that leaves their range raises."""
    whole = F.try_sum(x)
    problem = F.raise_error(F.lit("sum of scores leaves the range of BIGINT"))
    return F.when(whole.isNull(), problem.cast("bigint")).otherwise(whole)


def from_units(name: str) -> Column:
    """A sum of units as a double, rounded like ``rank_key`` in whole numbers."""
    return F.expr(f"(`{name}` + 50) div 100") / F.lit(1e9)


def exact_sum(x: Column) -> Column:
    """Sum of doubles in decimals; an addend beyond their range raises, in ANSI mode or not."""
    small = F.floor(x * F.lit(UNIT) + F.lit(0.5)).cast("bigint").cast("decimal(28,0)")
    problem = F.raise_error(F.concat(F.lit("addend too large for a sum: "), x.cast("string")))
    large = F.when(F.abs(x) < LARGEST, (x * F.lit(UNIT)).cast("decimal(28,0)")).otherwise(
        problem.cast("decimal(28,0)")
    )
    addend = F.when(x.isNull() | (F.abs(x) < FITS), small).otherwise(large)
    return F.sum(addend).cast("double") / F.lit(UNIT)


def rank_key(x: Column) -> Column:
    """What rankings compare: differences below 1e-9 are ties."""
    return F.round(x, RANK_DIGITS)


def shown(x: Column) -> Column:
    return F.round(x, SHOWN_DIGITS)
