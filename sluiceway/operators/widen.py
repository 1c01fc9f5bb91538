"""Columns whose type changes between deliveries: the narrowest type of each delivery, and the type that holds all of them.

Types widen in one order: whole number, decimal, double, text; date, time, text; flag, text. A column that has had no value yet takes
any. No step loses a digit: a number of more than 15 digits never becomes a double, but text. Numbers with leading zeros are codes, so text.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

from sluiceway.sources.schemas import RESCUE

KIND = "kind"
EMPTY, FLAG, NUMBER, FLOATING, DAY, TIME, TEXT = "empty", "flag", "number", "floating", "day", "time", "text"
LONG_DIGITS, DOUBLE_DIGITS, DECIMAL_DIGITS = 18, 15, 38

# What the texts of a kind look like; dates and times must exist as well.
_WHOLE = "(0|[1-9][0-9]*)"
_PATTERNS = {
    FLAG: r"^(true|false)\z",
    NUMBER: rf"^(?!-0([.]0*)?\z)-?{_WHOLE}([.][0-9]+)?\z",  # only a double has a negative zero
    FLOATING: rf"^-?{_WHOLE}([.][0-9]+)?([eE][+-]?[0-9]{{1,2}})?\z",
    DAY: r"^[0-9]{4}-[0-9]{2}-[0-9]{2}\z",
    TIME: r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}:[0-9]{2}([.][0-9]{1,6})?\z",
}


@dataclass(frozen=True)
class Kind:
    """What the values of a column have been so far. Of numbers: the most digits before the point, after it, and in one value."""

    name: str = EMPTY
    whole: int = 0
    fraction: int = 0
    digits: int = 0

    def __or__(self, other: Kind) -> Kind:
        """The kind that holds both. The order of deliveries does not matter."""
        names = {self.name, other.name} - {EMPTY}
        if not names:
            return Kind()
        if names <= {NUMBER, FLOATING}:
            whole, fraction, digits = (max(getattr(self, of), getattr(other, of)) for of in ("whole", "fraction", "digits"))
            floating = FLOATING in names or whole + fraction > DECIMAL_DIGITS
            if floating and digits > DOUBLE_DIGITS:
                return Kind(TEXT)
            return Kind(FLOATING if floating else NUMBER, whole, fraction, digits)
        if names <= {DAY, TIME}:
            return Kind(TIME if TIME in names else DAY)
        return Kind(names.pop()) if len(names) == 1 else Kind(TEXT)

    @property
    def data_type(self) -> DataType:
        if self.name == NUMBER:
            return LongType() if not self.fraction and self.whole <= LONG_DIGITS else DecimalType(DECIMAL_DIGITS, self.fraction)
        types = {FLAG: BooleanType(), FLOATING: DoubleType(), DAY: DateType(), TIME: TimestampNTZType()}
        return types.get(self.name, StringType())

    def field(self, name: str) -> StructField:
        return StructField(name, self.data_type, True, {KIND: asdict(self)})


def kinds_of(schema: StructType) -> dict[str, Kind]:
    """The kinds that a schema's columns carry; columns of a fixed type carry none."""
    return {f.name: Kind(**f.metadata[KIND]) for f in schema.fields if KIND in f.metadata}


def measured(texts: DataFrame, columns: Sequence[str]) -> dict[str, Kind]:
    """The narrowest kind that holds every value of each text column, found in one aggregation; NULLs fit any kind."""
    if not columns:
        return {}

    def facts(name: str) -> Column:
        value = F.col(f"`{name}`")
        fits = {kind: value.rlike(pattern) for kind, pattern in _PATTERNS.items()}
        fits[DAY] &= value.try_cast("date").isNotNull()
        fits[TIME] &= value.try_cast("timestamp_ntz").isNotNull()
        part = lambda pattern: F.when(fits[FLOATING], F.length(F.regexp_extract(value, pattern, 1)))
        whole, fraction = part("^-?([0-9]+)"), part("[.]([0-9]+)")
        # a decimal with more digits than the type holds is no number here
        fits[NUMBER] &= whole + fraction <= DECIMAL_DIGITS
        counts = [F.count_if(test).alias(kind) for kind, test in fits.items()]
        sizes = [F.max(size).alias(of) for of, size in (("whole", whole), ("fraction", fraction), ("digits", whole + fraction))]
        return F.struct(F.count(value).alias("n"), *counts, *sizes).alias(name)

    row = texts.agg(*map(facts, columns)).first()
    return {name: _narrowest(row[name].asDict()) for name in columns}


def _narrowest(facts: Mapping[str, int]) -> Kind:
    if not facts["n"]:
        return Kind()
    for kind in (FLAG, NUMBER, FLOATING, DAY, TIME):
        if facts[kind] == facts["n"]:
            sizes = (facts["whole"], facts["fraction"], facts["digits"]) if kind in (NUMBER, FLOATING) else ()
            return Kind(kind, *sizes) | Kind()
    # dates and times side by side
    return Kind(TIME) if facts[DAY] + facts[TIME] == facts["n"] else Kind(TEXT)


def as_type(value: Column, have: DataType, want: DataType) -> Column:
    """A value in a wider type. Decimals become text without the zeros that only their scale adds."""
    if have == want:
        return value
    if want == StringType() and isinstance(have, DecimalType) and have.scale:
        return F.regexp_replace(value.cast(want), "[.]?0+$", "")
    return value.try_cast(want) if have == StringType() else value.cast(want)


def typed(texts: DataFrame, hints: StructType, before: StructType | None = None) -> DataFrame:
    """A delivery of text columns and a rescue column, typed: hinted columns as the hints say, the others by their values.

    A column that earlier deliveries have had, ``before``, keeps its type if that holds the new values, and is widened if not; one that is
    absent now is NULL. A value that does not fit its hint goes to rescue, as JSON by column. The delivery is read twice.
    """
    known = kinds_of(before) if before else {}
    fixed = {field.name: field.dataType for field in hints.fields}
    free = [name for name in texts.columns if name not in fixed and name != RESCUE]
    found = measured(texts, free)
    kinds = {name: known.get(name, Kind()) | found.get(name, Kind()) for name in [*known, *(n for n in free if n not in known)]}
    misfits, columns = [], []
    for name, kind in fixed.items():
        value = F.col(f"`{name}`")
        columns.append(value.try_cast(kind).alias(name))
        if kind != StringType():
            misfits.append(F.when(value.isNotNull() & value.try_cast(kind).isNull(), value).alias(name))
    for name, kind in kinds.items():
        field = kind.field(name)
        value = F.col(f"`{name}`") if name in free else F.lit(None).cast("string")
        columns.append(value.try_cast(field.dataType).alias(name, metadata=field.metadata))
    rescue = F.col(RESCUE)
    if misfits:
        left = F.to_json(F.struct(*misfits))  # fields that are NULL are not written
        rescue = F.coalesce(rescue, F.when(left != "{}", left))
    return texts.select(*columns, rescue.alias(RESCUE))
