"""Settings of a run and the fixed values the published results depend on."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from sluiceway.operators.rules import DROP, FAIL, WARN, Rule, rules


@dataclass(frozen=True)
class Settings:
    """Everything a run needs that is not data.

    ``as_of`` and ``processed_at`` stand where a clock would, so that a run can be repeated; they bound what is accepted and
    have no default. ``lanes`` is into how many pieces the rows of one key may be cut: at least the rows of the hottest key
    over what one task should hold. No result depends on it. ``dimension_bytes`` bounds what a stream broadcasts.
    """

    as_of: dt.date
    processed_at: dt.datetime
    lanes: int
    earliest_date: dt.date = dt.date(2020, 1, 1)
    cost_cap: int = 100_000
    confidence_threshold: float = 80.0
    zone_code_start: int = 6
    zone_code_length: int = 1
    dimension_bytes: int = 8 << 20


# ---------------------------------------------------------------------------
# Codes, names and limits that results must agree on.
# ---------------------------------------------------------------------------

LITRE_UNIT = "L"
LITRES_PER_M3 = 1000

STATUS_CODES = {
    "paid": ["PAID"],
    "pending": ["PENDING", "PEND"],
    "overdue": ["OUTSTANDING", "OS"],
}

CURRENCY = "SGD"
CHARGE_PREFIX = "SGD "
UNALLOCATED_PROJECT = "OPEX-UNALLOCATED"
MASK_TEXT = "***MASKED***"
PII_COLUMNS = ["customer_name", "address", "contact_number"]
PII_TAGS = {"sensitivity": "pii", "domain": "billing"}
PII_UNMASK_GROUP = "billing_pii_unmask"

CONTRACTORS = {
    "contractor_a": {
        "work_order_id": "work_order_id",
        "zone": "site_location",
        "description": "work_description",
        "completion_date": "date_completed",
        "cost": "cost_sgd",
    },
    "contractor_b": {
        "work_order_id": "WO_Number",
        "zone": "Location",
        "description": "Desc",
        "completion_date": "CompletionDate",
        "cost": "Amount",
    },
    "contractor_c": {
        "work_order_id": "id",
        "zone": "loc_id",
        "description": "notes",
        "completion_date": "completed_on",
        "cost": "charge",
    },
}

ZONE_SEED = [
    ("A", "Zone A - Bukit Timah", "Bukit Timah", "Central", 380000, None, 4, dt.date(2015, 1, 1), None, True),
    ("B", "Zone B - Tampines", "Tampines", "East", 420000, None, 4, dt.date(2015, 1, 1), None, True),
    ("C", "Zone C - Jurong", "Jurong", "West", 450000, None, 6, dt.date(2015, 1, 1), None, True),
    ("D", "Zone D - Woodlands", "Woodlands", "North", 390000, None, 6, dt.date(2015, 1, 1), None, True),
    ("E", "Zone E - Punggol", "Punggol", "Northeast", 350000, None, 4, dt.date(2015, 1, 1), None, True),
    ("F", "Zone F - Pasir Ris", "Pasir Ris", "East", 280000, None, 4, dt.date(2015, 1, 1), None, True),
]

SCORECARD_COLUMNS = [
    "zone_name", "region", "population_served", "sla_response_hours", "month_start_date",
    "total_consumption_m3", "total_billed_sgd", "total_accounts", "overdue_count", "overdue_rate_pct",
    "total_invoice_spend_sgd", "invoice_line_count", "total_work_orders", "total_contractor_cost_sgd",
    "avg_pressure_bar", "avg_flow_lpm", "telemetry_reliability_pct",
    "total_opex_sgd", "opex_per_m3", "revenue_at_risk_sgd", "cost_recovery_ratio",
    "consumption_per_capita_m3", "opex_per_capita_sgd",
    "cost_recovery_flag", "network_reliability_flag",
    "data_sources_available", "data_freshness_flag", "refresh_timestamp",
]

# Rule sets. Bronze warns, silver drops, gold fails; names appear in quarantine reasons.

BILL_LANDING = rules(WARN, no_rescued_data="_rescued_data IS NULL")

READING_LANDING = rules(WARN, no_rescued_data="_rescued_data IS NULL")

INVOICE_LANDING = rules(
    WARN,
    no_rescued_data="_rescued_data IS NULL",
    valid_invoice_id="invoice_id IS NOT NULL",
    valid_currency="currency IS NOT NULL AND currency <> ''",
    valid_vendor="vendor IS NOT NULL",
    has_line_items="line_items IS NOT NULL AND size(line_items) > 0",
)

WORKS_LANDING = {
    "contractor_a": rules(
        WARN,
        no_rescued_data="_rescued_data IS NULL",
        valid_work_order_id="work_order_id IS NOT NULL",
        valid_cost="cost_sgd > 0",
        valid_date="date_completed IS NOT NULL",
        valid_location="site_location IS NOT NULL",
    ),
    "contractor_b": rules(
        WARN,
        no_rescued_data="_rescued_data IS NULL",
        valid_wo_number="WO_Number IS NOT NULL",
        valid_amount="Amount > 0",
        valid_date="CompletionDate IS NOT NULL",
        valid_location="Location IS NOT NULL",
    ),
    "contractor_c": rules(
        WARN,
        no_rescued_data="_rescued_data IS NULL",
        valid_id="id IS NOT NULL",
        valid_charge_format="charge LIKE 'SGD %'",
        valid_date="completed_on IS NOT NULL",
        valid_location="loc_id IS NOT NULL",
    ),
}

BILL_HARD = (
    Rule("valid_account_id", "account_id IS NOT NULL", DROP, "missing account_id"),
    Rule("valid_meter_id", "meter_id IS NOT NULL", DROP, "missing meter_id"),
    Rule("valid_consumption", "consumption_value IS NOT NULL", DROP, "missing consumption"),
    Rule("valid_amount", "amount_billed IS NOT NULL", DROP, "missing amount_billed"),
)

BILL_HARD_OUTPUT = rules(
    DROP,
    valid_account_id="account_id IS NOT NULL",
    valid_meter_id="meter_id IS NOT NULL",
    valid_consumption_not_null="consumption_m3 IS NOT NULL",
    valid_amount_not_null="amount_billed IS NOT NULL",
)

BILL_SOFT = rules(
    WARN,
    consumption_upper_bound="consumption_m3 < 10000",
    consumption_negative_check="consumption_m3 >= 0",
    known_zone="_known_zone",
)

PII_VERSION = (
    *rules(FAIL, valid_account_id="account_id IS NOT NULL", valid_effective_from="effective_from IS NOT NULL"),
    *rules(WARN, valid_date_range="effective_to IS NULL OR effective_from <= effective_to"),
)

LINE_HARD = rules(
    DROP,
    valid_invoice_id="invoice_id IS NOT NULL",
    positive_qty="qty > 0",
    positive_unit_cost="unit_cost > 0",
    valid_line_no="line_no > 0",
    valid_description="description IS NOT NULL",
    valid_line_total="line_total > 0",
)

READING_HARD = (
    Rule("valid_sensor_id", "sensor_id IS NOT NULL", DROP, "missing sensor_id"),
    Rule("valid_reading_ts", "reading_ts IS NOT NULL", DROP, "missing or unparseable timestamp"),
    Rule("valid_reading_value", "reading_value IS NOT NULL", DROP, "missing reading_value"),
)

READING_SOFT = rules(
    WARN,
    pressure_in_range="NOT (reading_type = 'pressure') OR reading_value BETWEEN -2 AND 8",
    flow_in_range="NOT (reading_type = 'flow') OR reading_value BETWEEN -50 AND 150",
    zone_is_resolved="NOT zone_is_uncertain",
)

BILLING_MART = (
    *rules(FAIL, valid_zone="service_zone IS NOT NULL", valid_month="month_start_date IS NOT NULL"),
    *rules(WARN, positive_total_consumption="total_consumption >= 0", positive_total_billed="total_billed >= 0"),
)

SPEND_MART = (
    *rules(FAIL, valid_invoice_month="invoice_month IS NOT NULL", valid_site_zone="site_zone IS NOT NULL"),
    *rules(WARN, positive_total_spend="total_spend > 0"),
)

CATEGORY_MART = (
    *rules(
        FAIL,
        valid_invoice_month="invoice_month IS NOT NULL",
        valid_zone="zone IS NOT NULL",
        valid_cost_category="cost_category IS NOT NULL",
    ),
    *rules(WARN, positive_total_spend="total_spend > 0", positive_line_count="line_count > 0"),
)

CONTRACTOR_MART = (
    *rules(FAIL, valid_completion_month="completion_month IS NOT NULL", valid_zone="zone IS NOT NULL"),
    *rules(WARN, positive_work_order_count="work_order_count > 0", positive_total_cost="total_cost > 0"),
)

WORK_TYPE_MART = (
    *rules(
        FAIL,
        valid_completion_month="completion_month IS NOT NULL",
        valid_zone="zone IS NOT NULL",
        valid_work_type="work_type IS NOT NULL",
    ),
    *rules(WARN, positive_order_count="order_count > 0", positive_total_cost="total_cost > 0"),
)

NETWORK_MART = rules(FAIL, valid_zone="zone IS NOT NULL", valid_month="month_start_date IS NOT NULL")

NETWORK_DIAGNOSTIC_MART = (*NETWORK_MART, *rules(WARN, acceptable_reliability="reliability_pct >= 50.0"))

SCORECARD = (
    *rules(FAIL, valid_zone="zone_name IS NOT NULL", valid_month="month_start_date IS NOT NULL"),
    *rules(
        WARN,
        positive_opex="total_opex_sgd IS NULL OR total_opex_sgd >= 0",
        valid_cost_recovery="cost_recovery_ratio IS NULL OR cost_recovery_ratio >= 0",
        valid_reliability="telemetry_reliability_pct IS NULL OR telemetry_reliability_pct BETWEEN 0 AND 100",
    ),
)


# ---------------------------------------------------------------------------
# Rule sets that take a setting.
# ---------------------------------------------------------------------------


def _in_window(column: str, settings: Settings) -> str:
    return f"{column} BETWEEN DATE'{settings.earliest_date}' AND DATE'{settings.as_of}'"


def invoice_rules(settings: Settings) -> tuple[Rule, ...]:
    return (
        *rules(
            DROP,
            valid_invoice_id="invoice_id IS NOT NULL",
            valid_site_zone="site_zone IS NOT NULL AND site_zone <> ''",
            valid_vendor_id="vendor_id IS NOT NULL",
            valid_invoice_date="invoice_date IS NOT NULL",
            valid_invoice_date_range=_in_window("invoice_date", settings),
            has_cost_center="cost_center IS NOT NULL",
            has_vendor_name="vendor_name IS NOT NULL",
            valid_currency=f"currency = '{CURRENCY}'",
        ),
        *rules(WARN, has_project_code="project_code IS NOT NULL"),
    )


def works_rules(settings: Settings) -> tuple[Rule, ...]:
    return rules(
        DROP,
        valid_work_order_id="work_order_id IS NOT NULL",
        valid_zone="zone_id IS NOT NULL",
        positive_cost="cost > 0",
        valid_completion_date="completion_date IS NOT NULL",
        valid_description="description IS NOT NULL",
        reasonable_cost=f"cost < {settings.cost_cap}",
        valid_date_range=_in_window("completion_date", settings),
    )


def location_rules(settings: Settings) -> tuple[Rule, ...]:
    return (
        *rules(FAIL, valid_location_id="location_id IS NOT NULL", valid_resolved_zone="resolved_zone IS NOT NULL"),
        *rules(
            WARN,
            known_zone="_known_zone",
            high_confidence=f"confidence_pct >= {settings.confidence_threshold}",
        ),
    )
