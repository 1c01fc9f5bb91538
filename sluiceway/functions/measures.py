"""Aggregates and ratios whose result does not depend on the order in which Spark adds.

Measures are doubles. A sum of doubles carries noise in its last bits that changes with the
partitioning, so each value is taken as a decimal of six places, far below a cent, and the sum is exact;
sums of sums stay exact. Nothing is rounded to cents on the way: a ratio or a percentage is rounded
once, half up, from whole numbers. A value of 10^22 or more stops the job in ANSI mode, Spark's default;
a percentage of amounts of 10^19 or more is NULL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from sluiceway.functions.conforming import col

WIDE = "decimal(28,6)"
AMOUNT = "decimal(25,6)"


def total(c: Column | str, over: WindowSpec | None = None) -> Column:
    """The exact sum, of a group or over a window."""
    summed = F.sum(col(c).cast(WIDE))
    return (summed.over(over) if over is not None else summed).cast("double")


def mean(c: Column | str) -> Column:
    """Mean of the non-NULL values; NULL if there are none."""
    return F.try_divide(total(c), F.count(col(c)))


def mean_of_parts(part_sum: Column | str, part_count: Column | str) -> Column:
    """Mean from partial sums and partial counts."""
    return F.try_divide(total(part_sum), F.sum(col(part_count)))


def difference(left: Column | str, right: Column | str) -> Column:
    """``left - right`` without the noise of doubles."""
    return (col(left).cast(WIDE) - col(right).cast(WIDE)).cast("double")


def percent(part: Column | str, whole: Column | str, places: int = 2) -> Column:
    """``part`` as a percentage of ``whole``; both are counts."""
    hundredfold = (col(part) * 100).cast("decimal(22,0)")
    return F.round(F.try_divide(hundredfold, col(whole).cast("decimal(20,0)")), places).cast("double")


def ratio(part: Column | str, whole: Column | str, places: int) -> Column:
    """``part / whole`` where ``whole`` is above zero, else NULL."""
    divided = F.try_divide(col(part).try_cast(WIDE), col(whole).try_cast(WIDE))
    return F.when(col(whole) > 0, F.round(divided, places).cast("double"))


def money_percent(part: Column | str, whole: Column | str, places: int = 2) -> Column:
    """``part`` as a percentage of ``whole``; both are amounts. NULL if ``whole`` is 0.

    The quotient of whole numbers of millionths is taken once, with a half added, so no digit is lost before it is rounded.
    """
    part, whole = col(part).try_cast(AMOUNT), col(whole).try_cast(AMOUNT)
    doubled = F.abs(part) * F.lit(200 * 10**places).cast("decimal(9,0)") + F.abs(whole)
    steps = F.call_function("div", doubled, F.abs(whole) * F.lit(2).cast("decimal(1,0)"))
    # The quotient is a long: a share of 10^14 or more is NULL.
    fits = (whole != 0) & (F.abs(part).cast("double") < F.abs(whole).cast("double") * 1e14)
    return F.when(fits, F.signum(part) * F.signum(whole) * steps.cast("double") / float(10**places))


def percent_of_amount(pct: Column | str, amount: Column | str, places: int = 2) -> Column:
    """``pct`` percent of ``amount``; ``pct`` has two places. The product is exact and rounded once."""
    product = col(pct).try_cast("decimal(12,2)") * col(amount).try_cast(AMOUNT)
    return F.round(product, places - 2).cast("double") / 100


def traffic_light(c: Column | str, red_below: float, amber_below: float) -> Column:
    """RED, AMBER or GREEN; NULL stays NULL."""
    value = col(c)
    return (
        F.when(value < red_below, F.lit("RED"))
        .when(value < amber_below, F.lit("AMBER"))
        .when(value.isNotNull(), F.lit("GREEN"))
    )
