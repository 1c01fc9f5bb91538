"""Declared schemas of the landing files and of the zone master."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DataType,
    DateType,
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
)

RESCUE = "_rescued_data"
TEXT, NUMBER, WHOLE, DAY, FLAG = StringType(), DoubleType(), IntegerType(), DateType(), BooleanType()


def struct(**columns: DataType) -> StructType:
    return StructType([StructField(name, kind) for name, kind in columns.items()])


BILLS = struct(
    account_id=TEXT,
    meter_id=TEXT,
    billing_period=DAY,
    service_zone=TEXT,
    consumption_value=NUMBER,
    consumption_unit=TEXT,
    amount_billed=NUMBER,
    payment_status=TEXT,
    customer_name=TEXT,
    address=TEXT,
    contact_number=TEXT,
)

WORKS_ORDERS = {
    "contractor_a": struct(
        work_order_id=TEXT, site_location=TEXT, work_description=TEXT, date_completed=TEXT, cost_sgd=NUMBER
    ),
    "contractor_b": struct(WO_Number=TEXT, Location=TEXT, Desc=TEXT, CompletionDate=TEXT, Amount=NUMBER),
    "contractor_c": struct(id=TEXT, loc_id=TEXT, notes=TEXT, completed_on=TEXT, charge=TEXT),
}

READINGS = struct(
    sensor_id=TEXT, location_id=TEXT, timestamp=TEXT, zone=TEXT, reading_type=TEXT, reading_value=NUMBER
)

INVOICE_LINE = struct(line_no=WHOLE, description=TEXT, qty=WHOLE, unit_cost=NUMBER)

INVOICE = struct(
    invoice_id=TEXT,
    invoice_date=TEXT,
    cost_center=TEXT,
    currency=TEXT,
    site_zone=TEXT,
    project_code=TEXT,
    vendor=struct(id=TEXT, name=TEXT),
    line_items=ArrayType(INVOICE_LINE),
)

INVOICE_PAGE = struct(data=ArrayType(INVOICE))


def _described(name: str, kind: DataType, comment: str, required: bool = False) -> StructField:
    return StructField(name, kind, not required, {"comment": comment})


ZONE_MASTER = StructType(
    [
        _described("zone_id", TEXT, "Short code", required=True),
        _described("zone_name", TEXT, "Name as the sources write it", required=True),
        _described("district", TEXT, "Neighbourhood"),
        _described("region", TEXT, "Part of the city"),
        _described("population_served", WHOLE, "Estimated residents"),
        _described("district_manager", TEXT, "Person in charge"),
        _described("sla_response_hours", WHOLE, "Response target in hours"),
        _described("effective_from", DAY, "First day in force", required=True),
        _described("effective_to", DAY, "Last day in force, empty while current"),
        _described("is_current", FLAG, "In force now", required=True),
    ]
)


def with_rescue(schema: StructType) -> StructType:
    """The schema plus the text column that takes lines which do not fit it."""
    return StructType([*schema.fields, StructField(RESCUE, TEXT)])


def with_hints(inferred: StructType, hints: str) -> StructType:
    """An inferred schema with the types of the hinted columns forced; hinted columns not seen are added."""
    forced = {field.name: field.dataType for field in StructType.fromDDL(hints).fields}
    fields = [StructField(f.name, forced.pop(f.name, f.dataType), f.nullable) for f in inferred.fields]
    return StructType([*fields, *[StructField(name, kind) for name, kind in forced.items()]])
