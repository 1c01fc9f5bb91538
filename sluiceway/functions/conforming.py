"""Columns that bring source values to one unit, one code list and one type.

Untrusted text goes through the ``try_`` forms: what cannot be read becomes NULL and is then
judged by the rules, instead of stopping the job.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sluiceway import config


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def number(c: Column | str) -> Column:
    return col(c).try_cast("double")


def whole_number(c: Column | str) -> Column:
    return col(c).try_cast("int")


def text_to_date(c: Column | str) -> Column:
    return F.try_to_date(col(c).cast("string"))


def text_to_timestamp(c: Column | str) -> Column:
    return F.try_to_timestamp(col(c).cast("string"))


def month_start(c: Column | str) -> Column:
    """First day of the month, as a date."""
    return F.trunc(col(c), "MM")


def month_instant(c: Column | str) -> Column:
    """First instant of the month, as a timestamp."""
    return F.date_trunc("month", col(c))


def cubic_metres(value: Column | str, unit: Column | str) -> Column:
    """Litres (in any case) are divided by 1000; every other unit is taken as cubic metres."""
    amount = number(value)
    return F.when(F.upper(col(unit)) == config.LITRE_UNIT, amount / config.LITRES_PER_M3).otherwise(amount)


def payment_status(c: Column | str, codes: dict[str, list[str]] | None = None) -> Column:
    """Map status codes in any case to one name each; an unknown code stays, in lower case."""
    upper = F.upper(col(c))
    named = [F.when(upper.isin(values), F.lit(name)) for name, values in (codes or config.STATUS_CODES).items()]
    return F.coalesce(*named, F.lower(col(c)))


def is_known_status(c: Column | str, codes: dict[str, list[str]] | None = None) -> Column:
    known = [value for values in (codes or config.STATUS_CODES).values() for value in values]
    return F.coalesce(F.upper(col(c)).isin(known), F.lit(False))


def charge_amount(c: Column | str, prefix: str = config.CHARGE_PREFIX) -> Column:
    """``SGD 123.45`` to 123.45; a charge without the prefix is read as a plain number."""
    return F.replace(col(c).cast("string"), F.lit(prefix), F.lit("")).try_cast("double")


def code_in_name(c: Column | str, start: int, length: int) -> Column:
    """The short code that stands at a fixed place in a zone name."""
    return F.substring(col(c), start, length)


def named_bucket(c: Column | str, bucket: str = config.UNALLOCATED_PROJECT) -> Column:
    return F.coalesce(col(c), F.lit(bucket))
