"""Bronze, silver and gold datasets."""

from __future__ import annotations

from pyspark.sql import functions as F

from sluiceway import config
from sluiceway.operators import profile
from sluiceway.operators.rules import dq_metrics, enforce_observed
from sluiceway.plans import billing, contractors, finance, network, scorecard
from sluiceway.queries.oracle import (
    BILL_BAD, BILL_FIELDS, INVOICE_OK, LINE_OK, PROCESSED, READING_BAD, WORKS_OK, all_hold, all_reasons, first_reason, half_up,
)
from sluiceway.queries.registry import SETTINGS, query


def metrics_sql(source: str, dataset: str, cases: dict[str, str], action: str = "warn", by: str = "") -> str:
    """One row per rule: passed, failed, failed percent."""
    lead = f"{by}, " if by else ""
    group = f"GROUP BY {by}" if by else ""
    return "\nUNION ALL\n".join(
        f"""SELECT '{dataset}' AS dataset, {lead}'{name}' AS rule, '{action}' AS action,
        count(*) FILTER (({ok}) IS TRUE) AS passed, count(*) FILTER (({ok}) IS NOT TRUE) AS failed,
        {half_up(f"100 * count(*) FILTER (({ok}) IS NOT TRUE)", "count(*)", 2)} AS failed_pct
        FROM {source} {group}"""
        for name, ok in cases.items()
    )


# --- billing ---------------------------------------------------------------


@query("M-23, A-01..A-06, A-09, D-06", "SELECT * FROM billing_mart")
def billing_by_zone_month(inputs):
    return inputs.billing_mart()


@query("M-07, C-01, C-02, W-01, P-01, P-03", "SELECT * FROM consumption")
def billing_consumption(inputs):
    return inputs.consumption()


@query(
    "M-07 with valid bills first (Q-01)",
    """SELECT * EXCLUDE (consumption_value, customer_name, address, contact_number, seq) FROM conformed_bills
    WHERE account_id IS NOT NULL AND meter_id IS NOT NULL AND consumption_value IS NOT NULL AND amount_billed IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY account_id, meter_id, month_start_date
        ORDER BY billing_period, amount_billed, consumption_m3, consumption_value, payment_status, service_zone) = 1""",
)
def billing_consumption_valid_first(inputs):
    return billing.billing_consumption(inputs.bills(), valid_first=True)


@query("M-33, D-04", "SELECT * FROM consumption WHERE consumption_m3 IS NOT NULL")
def billing_legacy_rules(inputs):
    return billing.billing_consumption_output_rules(inputs.bills())


_REJECTED_BILL = " OR ".join(BILL_BAD.values())


@query(
    "M-10, D-07, P-09, P-10",
    f"""SELECT {BILL_FIELDS}, CAST(NULL AS VARCHAR) AS _rescued_data, {first_reason(BILL_BAD)} AS quarantine_reason,
    {PROCESSED} AS quarantined_at, 'bronze.billing_customer' AS source_table
    FROM in_bills WHERE {_REJECTED_BILL}""",
)
def billing_quarantine(inputs):
    return billing.billing_quarantine(inputs.bills().drop("seq"), SETTINGS)


@query(
    "Q-03: bills that lost to an earlier one",
    f"""SELECT account_id, meter_id, billing_period, month_start_date, service_zone, consumption_m3, amount_billed,
    payment_status FROM ranked_bills WHERE rn > 1 AND NOT ({_REJECTED_BILL})""",
)
def billing_superseded(inputs):
    return billing.superseded_bills(inputs.bills(), SETTINGS, "seq")


_BILL_SOFT = {
    "consumption_upper_bound": "consumption_m3 < 10000",
    "consumption_negative_check": "consumption_m3 >= 0",
    "known_zone": "service_zone IN (SELECT zone_name FROM current_zones)",
}


@query("M-09, D-13, P-12", metrics_sql("consumption", "billing_consumption", _BILL_SOFT))
def billing_dq_metrics(inputs):
    return billing.billing_dq(inputs.consumption(), inputs.zones())


@query(
    "P-12, J-07",
    """SELECT service_zone, count(*) AS bills FROM consumption
    WHERE service_zone NOT IN (SELECT zone_name FROM current_zones) GROUP BY service_zone""",
)
def unknown_zone_check(inputs):
    zones = inputs.zones().where("is_current").select(F.col("zone_name").alias("service_zone"))
    unknown = inputs.consumption().groupBy("service_zone").agg(F.count(F.lit(1)).alias("bills"))
    return unknown.join(zones, "service_zone", "left_anti")


@query("D-03, D-04, D-14", f"SELECT {BILL_FIELDS} FROM in_bills WHERE NOT ({_REJECTED_BILL})")
def expect_drop(inputs):
    kept, _ = enforce_observed(inputs.bills().drop("seq", "_rescued_data"), config.BILL_HARD)
    return kept


@query("D-05, D-06: rules that hold let every row through", "SELECT * FROM billing_mart")
def expect_fail_pass(inputs):
    return enforce_observed(inputs.billing_mart(), config.BILLING_MART)[0]


@query(
    "M-01, D-01: landing warns and keeps all rows",
    f"SELECT {BILL_FIELDS}, CAST(NULL AS VARCHAR) AS _rescued_data FROM in_bills",
)
def billing_bronze(inputs):
    return enforce_observed(inputs.bills().drop("seq"), config.BILL_LANDING)[0]


_BILL_COLUMNS = ["account_id", "meter_id", "consumption_value", "amount_billed", "address", "payment_status"]


def profile_sql(source: str, dataset: str, columns: list[str], text: list[str], by: str = "") -> str:
    lead = f"{by}, " if by else ""
    group = f"GROUP BY {by}" if by else ""
    return "\nUNION ALL\n".join(
        f"""SELECT '{dataset}' AS dataset, {lead}'{c}' AS column_name, count(*) AS row_count,
        count(*) FILTER ({c} IS NULL) AS null_count,
        {f"count(*) FILTER ({c} = '')" if c in text else "CAST(0 AS BIGINT)"} AS empty_count,
        {half_up(f"100 * count(*) FILTER ({c} IS NULL)", "count(*)", 2)} AS null_pct FROM {source} {group}"""
        for c in columns
    )


@query(
    "E-02",
    profile_sql("in_bills", "bills", _BILL_COLUMNS, ["account_id", "meter_id", "address", "payment_status"]),
)
def profile_columns(inputs):
    return profile.profile_columns(inputs.bills(), _BILL_COLUMNS, "bills")


# --- finance ---------------------------------------------------------------


@query(
    "M-02, F-16, P-06, D-02: one row per invoice, its lines nested; several, one, none, or an empty list",
    """SELECT h.invoice_id, h.cost_center, h.site_zone, h.currency, h.invoice_date, h.project_code, h.vendor_id, h.vendor_name,
    CASE WHEN l.invoice_id IS NOT NULL THEN CAST(CASE WHEN CAST(h.invoice_id AS BIGINT) % 7 = 0 THEN 0 ELSE n END AS INT) END AS lines,
    CASE WHEN CAST(h.invoice_id AS BIGINT) % 7 = 0 THEN '' ELSE coalesce(items, '') END AS items
    FROM in_invoice_headers h LEFT JOIN (
      SELECT invoice_id, count(*) AS n, string_agg(concat_ws(':', line_no, description, qty, CAST(unit_cost * 10000 AS BIGINT)), ';' ORDER BY line_no, description NULLS FIRST, qty NULLS FIRST, unit_cost) AS items
      FROM in_invoice_lines GROUP BY invoice_id) l ON h.invoice_id = l.invoice_id""",
)
def invoices_nested(inputs):
    landed, _ = enforce_observed(inputs.nested_invoices(), config.INVOICE_LANDING)
    item = lambda x: F.concat_ws(":", x["line_no"], x["description"], x["qty"], F.round(x["unit_cost"] * 10000).cast("bigint"))
    return landed.select(
        "invoice_id", "cost_center", "site_zone", "currency", "invoice_date", "project_code",
        F.col("vendor.id").alias("vendor_id"),
        F.col("vendor.name").alias("vendor_name"),
        F.when(F.col("line_items").isNotNull(), F.size("line_items")).alias("lines"),
        F.concat_ws(";", F.transform("line_items", item)).alias("items"),
    )


@query("M-11, M-12, P-05, F-02, D-04", "SELECT * FROM headers")
def invoices(inputs):
    return inputs.headers()


@query(
    "M-13, D-09, D-12",
    f"""SELECT *, {all_reasons(INVOICE_OK)} AS _quarantine_reason, {PROCESSED} AS _quarantined_at
    FROM incoming_headers WHERE NOT ({all_hold(INVOICE_OK)})""",
)
def invoices_quarantine(inputs):
    return finance.invoices_quarantine(inputs.invoice_headers(), SETTINGS)


@query("M-14, M-15, F-14, F-15, F-16", "SELECT * FROM lines")
def line_items(inputs):
    return inputs.lines()


@query(
    "M-15 with one row per invoice and line number (Q-19)",
    f"""SELECT * FROM (SELECT * FROM incoming_lines QUALIFY row_number() OVER (PARTITION BY invoice_id, line_no
    ORDER BY description NULLS FIRST, qty NULLS FIRST, unit_cost NULLS FIRST) = 1) WHERE {all_hold(LINE_OK)}""",
)
def line_items_once(inputs):
    return finance.line_items(inputs.invoice_line_records(), once=True)


@query(
    "M-16, D-10",
    f"""SELECT *, {all_reasons(LINE_OK)} AS _quarantine_reason, {PROCESSED} AS _quarantined_at
    FROM incoming_lines WHERE NOT ({all_hold(LINE_OK)})""",
)
def line_items_quarantine(inputs):
    return finance.line_items_quarantine(inputs.invoice_line_records(), SETTINGS)


@query("M-24, J-01, C-10, F-11", "SELECT * FROM spend_mart")
def spend_by_zone_month(inputs):
    return inputs.spend_mart()


@query(
    "M-25, A-07, F-08",
    """SELECT substring(h.site_zone, 8, 2) AS zone_id, h.site_zone AS zone, l.description AS cost_category,
    CAST(date_trunc('month', h.invoice_date) AS TIMESTAMP) AS invoice_month, CAST(sum(CAST(l.line_total AS DECIMAL(28,6))) AS DOUBLE) AS total_spend,
    count(*) AS line_count, CAST(sum(CAST(l.unit_cost AS DECIMAL(28,6))) AS DOUBLE) / count(*) AS avg_unit_cost
    FROM lines l JOIN headers h ON l.invoice_id = h.invoice_id GROUP BY 1, 2, 3, 4""",
)
def spend_by_zone_category_month(inputs):
    return finance.spend_by_zone_category_month(inputs.lines(), inputs.stored_headers(), SETTINGS)


# --- contractors -----------------------------------------------------------


@query("M-03..M-05, M-17, C-05, C-06, J-03, U-07", "SELECT * FROM orders_done")
def works_orders(inputs):
    return inputs.orders()


@query(
    "M-18, D-11",
    f"""SELECT *, {all_reasons(WORKS_OK)} AS _quarantine_reason, {PROCESSED} AS _quarantined_at
    FROM incoming_orders WHERE NOT ({all_hold(WORKS_OK)})""",
)
def works_orders_quarantine(inputs):
    return contractors.works_orders_quarantine(inputs.works_orders(), inputs.zones(), SETTINGS)


_WORKS_LANDING_OK = {
    "contractor_a": ("A", {"valid_work_order_id": "work_order_id IS NOT NULL", "valid_cost": "cost > 0",
                           "valid_date": "completion_date IS NOT NULL", "valid_location": "zone IS NOT NULL"}),
    "contractor_b": ("N", {"valid_wo_number": "work_order_id IS NOT NULL", "valid_amount": "cost > 0",
                           "valid_date": "completion_date IS NOT NULL", "valid_location": "zone IS NOT NULL"}),
    "contractor_c": ("R", {"valid_id": "work_order_id IS NOT NULL", "valid_charge_format": "charge LIKE 'SGD %'",
                           "valid_date": "completion_date IS NOT NULL", "valid_location": "zone IS NOT NULL"}),
}


@query(
    "M-03..M-05, D-02, P-13: the landing warnings per contractor",
    "\nUNION ALL\n".join(
        metrics_sql(f"(SELECT * FROM in_works_orders WHERE layout = '{flag}')", name, {"no_rescued_data": "TRUE", **cases})
        for name, (flag, cases) in _WORKS_LANDING_OK.items()
    ),
)
def works_landing_metrics(inputs):
    frames = inputs.works_orders()
    metrics = [dq_metrics(frames[name], rule_set, name) for name, rule_set in config.WORKS_LANDING.items()]
    return metrics[0].unionByName(metrics[1]).unionByName(metrics[2])


@query("M-26", "SELECT * FROM contractor_mart")
def contractor_by_zone_month(inputs):
    return inputs.contractor_mart()


@query(
    "M-27",
    """SELECT zone_id, zone, description AS work_type, CAST(date_trunc('month', completion_date) AS TIMESTAMP)
    AS completion_month, count(*) AS order_count, CAST(sum(CAST(cost AS DECIMAL(28,6))) AS DOUBLE) AS total_cost,
    CAST(sum(CAST(cost AS DECIMAL(28,6))) AS DOUBLE) / count(*) AS avg_cost FROM orders_done GROUP BY 1, 2, 3, 4""",
)
def works_by_zone_type_month(inputs):
    return contractors.works_by_zone_type_month(inputs.orders())


# --- network ---------------------------------------------------------------


@query("M-19, C-07, C-08, A-10, W-04", "SELECT * FROM locations")
def location_zone(inputs):
    return network.location_zone(inputs.readings(), SETTINGS)


@query(
    "M-19 warn rules (Q-12)",
    metrics_sql("locations", "dim_location_zone",
                {"valid_location_id": "location_id IS NOT NULL", "valid_resolved_zone": "resolved_zone IS NOT NULL"}, "fail")
    + "\nUNION ALL\n"
    + metrics_sql("locations", "dim_location_zone",
                  {"known_zone": "resolved_zone IN (SELECT zone_name FROM current_zones)",
                   "high_confidence": "confidence_pct >= 80"}),
)
def location_dq_metrics(inputs):
    return network.location_dq(inputs.locations(), inputs.zones(), SETTINGS)


@query(
    "M-06, M-20, W-03, C-09, F-03, J-02",
    "SELECT * EXCLUDE (resolved_zone, is_ambiguous) FROM readings_done",
)
def telemetry(inputs):
    return inputs.telemetry(inputs.locations())


@query(
    "M-22, D-08",
    f"""SELECT sensor_id, location_id, reading_time AS "timestamp", zone, reading_type,
    CAST(reading_value AS DOUBLE) AS reading_value, reading_ts, CAST(NULL AS VARCHAR) AS _rescued_data,
    {first_reason(READING_BAD)} AS quarantine_reason, {PROCESSED} AS quarantined_at, 'bronze.sensor_readings' AS source_table
    FROM parsed_readings WHERE {" OR ".join(READING_BAD.values())}""",
)
def telemetry_quarantine(inputs):
    return network.telemetry_quarantine(inputs.readings().drop("seq"), SETTINGS)


_READING_SOFT = {
    "pressure_in_range": "reading_type <> 'pressure' OR reading_value BETWEEN -2 AND 8",
    "flow_in_range": "reading_type <> 'flow' OR reading_value BETWEEN -50 AND 150",
    "zone_is_resolved": "NOT zone_is_uncertain",
}


@query("M-21, P-14, P-15", metrics_sql("readings_done", "network_telemetry", _READING_SOFT))
def telemetry_dq_metrics(inputs):
    return network.telemetry_dq(inputs.telemetry(inputs.locations()))


@query(
    "M-28, P-07, A-08",
    """SELECT resolved_zone AS zone, month_start_date,
    CAST(sum(CAST(reading_value AS DECIMAL(28,6))) FILTER (reading_type = 'pressure') AS DOUBLE) / count(*) FILTER (reading_type = 'pressure') AS avg_pressure,
    CAST(sum(CAST(reading_value AS DECIMAL(28,6))) FILTER (reading_type = 'flow') AS DOUBLE) / count(*) FILTER (reading_type = 'flow') AS avg_flow,
    count(*) AS reading_count FROM readings_done WHERE NOT is_ambiguous AND NOT is_duplicate GROUP BY 1, 2""",
)
def network_health(inputs):
    locations = inputs.locations()
    return network.network_health(inputs.telemetry(locations), locations)


@query("M-29, J-06", "SELECT * FROM network_mart")
def network_diagnostic(inputs):
    locations = inputs.locations()
    return network.network_diagnostic(inputs.telemetry(locations), locations)


# --- scorecard -------------------------------------------------------------


@query(
    "K-01, J-05, U-04, U-05",
    "SELECT zone_name, region, population_served, sla_response_hours, month_start_date FROM current_zones CROSS JOIN months",
)
def scorecard_spine(inputs):
    return scorecard.spine(inputs.zones(), scorecard.months_seen(inputs.marts()))


@query("M-30, K-01..K-12, J-04, A-11, F-05", "SELECT * FROM scorecard")
def zone_performance(inputs):
    return scorecard.zone_performance(inputs.zones(), inputs.marts(), SETTINGS)


@query(
    "Q-16: names the scorecard leaves out",
    """SELECT * FROM (SELECT 'billing' AS mart, service_zone AS zone_name, count(*) AS mart_rows FROM billing_mart GROUP BY ALL
    UNION ALL SELECT 'spend', zone_name, count(*) FROM card_spend GROUP BY ALL
    UNION ALL SELECT 'contractor', zone_name, count(*) FROM card_contractor GROUP BY ALL
    UNION ALL SELECT 'network', zone, count(*) FROM network_mart GROUP BY ALL)
    WHERE zone_name NOT IN (SELECT zone_name FROM current_zones)""",
)
def unscored_zones(inputs):
    return scorecard.unscored_zones(inputs.zones(), inputs.marts())
