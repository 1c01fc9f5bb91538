"""SQL inputs for the checks: the landing texts and the datasets over them, written apart from the Spark code.

A check names the inputs it needs; ``with_inputs`` puts those, and what they build on, in front.
"""

from __future__ import annotations

import re

from sluiceway.sources.driver_tables import SQL, TABLES

AS_OF = "DATE '2001-06-30'"
EARLIEST = "DATE '1996-01-01'"
PROCESSED = "TIMESTAMP '2001-06-30 06:00:00'"


def half_up(part: str, whole: str, places: int) -> str:
    """Exact ``part / whole`` of two whole numbers, rounded half up, as a double; NULL unless ``whole`` > 0."""
    scale = 10**places
    return (
        f"CAST(CASE WHEN ({whole}) > 0 THEN CAST(sign({part}) AS HUGEINT) * "
        f"((2 * abs(CAST({part} AS HUGEINT)) * {scale} + ({whole})) // (2 * CAST({whole} AS HUGEINT))) END AS DOUBLE)"
        f" / {scale}"
    )


def cents(amount: str) -> str:
    return f"CAST(round(({amount}) * 100) AS HUGEINT)"


def micros(amount: str) -> str:
    return f"CAST(round(({amount}) * 1000000) AS HUGEINT)"


def first_reason(cases: dict[str, str]) -> str:
    return "CASE " + " ".join(f"WHEN {test} THEN '{reason}'" for reason, test in cases.items()) + " END"


def all_reasons(cases: dict[str, str]) -> str:
    """``cases``: rule name to the condition under which it is kept; NULL counts as broken."""
    return "concat_ws(', ', " + ", ".join(f"CASE WHEN ({ok}) IS NOT TRUE THEN '{name}' END" for name, ok in cases.items()) + ")"


def all_hold(cases: dict[str, str]) -> str:
    return " AND ".join(f"(({ok}) IS TRUE)" for ok in cases.values())


INVOICE_OK = {
    "valid_invoice_id": "invoice_id IS NOT NULL",
    "valid_site_zone": "site_zone <> ''",
    "valid_vendor_id": "vendor_id IS NOT NULL",
    "valid_invoice_date": "invoice_date IS NOT NULL",
    "valid_invoice_date_range": f"invoice_date >= {EARLIEST} AND invoice_date <= {AS_OF}",
    "has_cost_center": "cost_center IS NOT NULL",
    "has_vendor_name": "vendor_name IS NOT NULL",
    "valid_currency": "currency = 'SGD'",
}

LINE_OK = {
    "valid_invoice_id": "invoice_id IS NOT NULL",
    "positive_qty": "qty > 0",
    "positive_unit_cost": "unit_cost > 0",
    "valid_line_no": "line_no > 0",
    "valid_description": "description IS NOT NULL",
    "valid_line_total": "line_total > 0",
}

WORKS_OK = {
    "valid_work_order_id": "work_order_id IS NOT NULL",
    "valid_zone": "zone_id IS NOT NULL",
    "positive_cost": "cost > 0",
    "valid_completion_date": "completion_date IS NOT NULL",
    "valid_description": "description IS NOT NULL",
    "reasonable_cost": "cost < 100000",
    "valid_date_range": f"completion_date >= {EARLIEST} AND completion_date <= {AS_OF}",
}

BILL_BAD = {
    "missing account_id": "account_id IS NULL",
    "missing meter_id": "meter_id IS NULL",
    "missing consumption": "consumption_value IS NULL",
    "missing amount_billed": "amount_billed IS NULL",
}

READING_BAD = {
    "missing sensor_id": "sensor_id IS NULL",
    "missing or unparseable timestamp": "reading_ts IS NULL",
    "missing reading_value": "reading_value IS NULL",
}

BILL_FIELDS = (
    "account_id, meter_id, billing_period, service_zone, CAST(consumption_value AS DOUBLE) AS consumption_value, "
    "consumption_unit, CAST(amount_billed AS DOUBLE) AS amount_billed, payment_status, customer_name, address, contact_number"
)

BILL_ORDER = (
    "billing_period NULLS FIRST, amount_billed NULLS FIRST, consumption_m3 NULLS FIRST, "
    "consumption_value NULLS FIRST, payment_status NULLS FIRST, service_zone NULLS FIRST"
)
READING_ORDER = "reading_value, reading_type, location_id, zone, seq"

_LANDING = {f"in_{name}": text.format(**{t: t for t in TABLES}) for name, text in SQL.items()}

INPUTS = {
    **_LANDING,
    "current_zones": "SELECT * FROM in_dim_zone WHERE is_current",
    "conformed_bills": """
SELECT account_id, meter_id, billing_period, CAST(date_trunc('month', billing_period) AS DATE) AS month_start_date,
       service_zone, consumption_value,
       CASE WHEN upper(consumption_unit) = 'L' THEN CAST(consumption_value AS DOUBLE) / 1000
            ELSE CAST(consumption_value AS DOUBLE) END AS consumption_m3,
       CAST(amount_billed AS DOUBLE) AS amount_billed,
       CASE upper(payment_status) WHEN 'PAID' THEN 'paid' WHEN 'PENDING' THEN 'pending' WHEN 'PEND' THEN 'pending'
            WHEN 'OUTSTANDING' THEN 'overdue' WHEN 'OS' THEN 'overdue' ELSE lower(payment_status) END AS payment_status,
       customer_name, address, contact_number, seq
FROM in_bills""",
    "ranked_bills": f"""
SELECT *, row_number() OVER (PARTITION BY account_id, meter_id, month_start_date ORDER BY {BILL_ORDER}) AS rn
FROM conformed_bills""",
    "consumption": """
SELECT account_id, meter_id, billing_period, month_start_date, service_zone, consumption_m3, amount_billed, payment_status
FROM ranked_bills
WHERE rn = 1 AND account_id IS NOT NULL AND meter_id IS NOT NULL AND consumption_value IS NOT NULL
      AND amount_billed IS NOT NULL""",
    "billing_mart": f"""
SELECT service_zone, month_start_date, CAST(sum(CAST(consumption_m3 AS DECIMAL(28,6))) AS DOUBLE) AS total_consumption,
       CAST(sum(CAST(amount_billed AS DECIMAL(28,6))) AS DOUBLE) AS total_billed, count(DISTINCT account_id) AS total_accounts,
       count(*) FILTER (payment_status = 'overdue') AS overdue_count,
       {half_up("100 * count(*) FILTER (payment_status = 'overdue')", "count(DISTINCT account_id)", 2)} AS overdue_rate_pct
FROM consumption GROUP BY service_zone, month_start_date""",
    "incoming_headers": """
SELECT invoice_id, cost_center, vendor_id, vendor_name, site_zone, currency, TRY_CAST(invoice_date AS DATE) AS invoice_date,
       project_code FROM in_invoice_headers""",
    "headers": f"SELECT * FROM incoming_headers WHERE {all_hold(INVOICE_OK)}",
    "incoming_lines": """
SELECT invoice_id, line_no, description, qty, CAST(unit_cost AS DOUBLE) AS unit_cost,
       CAST(qty AS DOUBLE) * CAST(unit_cost AS DOUBLE) AS line_total FROM in_invoice_lines""",
    "lines": f"SELECT * FROM incoming_lines WHERE {all_hold(LINE_OK)}",
    "spend_mart": """
SELECT h.site_zone, coalesce(h.project_code, 'OPEX-UNALLOCATED') AS project_code,
       CAST(date_trunc('month', h.invoice_date) AS TIMESTAMP) AS invoice_month,
       CAST(sum(CAST(l.line_total AS DECIMAL(28,6))) AS DOUBLE) AS total_spend, count(*) AS line_item_count
FROM lines l JOIN headers h ON l.invoice_id = h.invoice_id GROUP BY ALL""",
    "incoming_orders": """
SELECT work_order_id, zone, description,
       CASE layout WHEN 'A' THEN 'contractor_a' WHEN 'N' THEN 'contractor_b' ELSE 'contractor_c' END AS contractor_source,
       TRY_CAST(completion_date AS DATE) AS completion_date,
       CASE WHEN layout = 'R' THEN CAST(replace(charge, 'SGD ', '') AS DOUBLE) ELSE CAST(cost AS DOUBLE) END AS cost,
       zone_id
FROM in_works_orders LEFT JOIN (SELECT zone_id, zone_name FROM current_zones) ON zone = zone_name""",
    "orders_done": f"SELECT * FROM incoming_orders WHERE {all_hold(WORKS_OK)}",
    "contractor_mart": """
SELECT zone, contractor_source, CAST(date_trunc('month', completion_date) AS TIMESTAMP) AS completion_month,
       count(*) AS work_order_count, CAST(sum(CAST(cost AS DECIMAL(28,6))) AS DOUBLE) AS total_cost
FROM orders_done GROUP BY ALL""",
    "parsed_readings": "SELECT *, TRY_CAST(reading_time AS TIMESTAMP) AS reading_ts FROM in_readings",
    "ranked_zones": """
SELECT location_id, zone, count(*) AS votes, sum(count(*)) OVER (PARTITION BY location_id) AS total,
       row_number() OVER (PARTITION BY location_id ORDER BY count(*) DESC, zone NULLS LAST) AS rn
FROM in_readings WHERE location_id IS NOT NULL GROUP BY location_id, zone""",
    "locations": f"""
SELECT location_id, zone AS resolved_zone, {half_up("100 * votes", "total", 2)} AS confidence_pct,
       {half_up("100 * votes", "total", 2)} < 80 AS is_ambiguous
FROM ranked_zones WHERE rn = 1""",
    "flagged_readings": f"""
SELECT r.*, resolved_zone, is_ambiguous, CAST(date_trunc('month', reading_ts) AS DATE) AS month_start_date,
       row_number() OVER (PARTITION BY sensor_id, reading_ts ORDER BY {READING_ORDER}) > 1 AS is_duplicate,
       CASE WHEN resolved_zone IS NULL OR is_ambiguous OR zone <> resolved_zone THEN TRUE ELSE FALSE END
           AS zone_is_uncertain
FROM parsed_readings r LEFT JOIN locations USING (location_id)
WHERE sensor_id IS NOT NULL AND reading_ts IS NOT NULL AND reading_value IS NOT NULL""",
    "readings_done": """
SELECT sensor_id, location_id, reading_ts, month_start_date, reading_type, CAST(reading_value AS DOUBLE) AS reading_value,
       is_duplicate, zone_is_uncertain, resolved_zone, is_ambiguous FROM flagged_readings""",
    "network_mart": f"""
SELECT resolved_zone AS zone, month_start_date,
       CAST(sum(CAST(reading_value AS DECIMAL(28,6))) FILTER (reading_type = 'pressure' AND NOT is_duplicate) AS DOUBLE)
           / count(*) FILTER (reading_type = 'pressure' AND NOT is_duplicate) AS avg_pressure,
       CAST(sum(CAST(reading_value AS DECIMAL(28,6))) FILTER (reading_type = 'flow' AND NOT is_duplicate) AS DOUBLE)
           / count(*) FILTER (reading_type = 'flow' AND NOT is_duplicate) AS avg_flow,
       count(*) AS total_readings,
       count(*) FILTER (NOT is_duplicate AND NOT zone_is_uncertain) AS reliable_readings,
       {half_up("100 * count(*) FILTER (NOT is_duplicate AND NOT zone_is_uncertain)", "count(*)", 2)} AS reliability_pct,
       count(*) FILTER (is_duplicate) AS duplicate_count,
       count(*) FILTER (zone_is_uncertain) AS zone_uncertain_count
FROM readings_done WHERE resolved_zone IS NOT NULL GROUP BY 1, 2""",
    "card_spend": """
SELECT site_zone AS zone_name, CAST(invoice_month AS DATE) AS month_start_date,
       CAST(sum(CAST(total_spend AS DECIMAL(28,6))) AS DOUBLE) AS total_invoice_spend_sgd, CAST(sum(line_item_count) AS BIGINT) AS invoice_line_count
FROM spend_mart GROUP BY 1, 2""",
    "card_contractor": """
SELECT zone AS zone_name, CAST(completion_month AS DATE) AS month_start_date,
       CAST(sum(work_order_count) AS BIGINT) AS total_work_orders, CAST(sum(CAST(total_cost AS DECIMAL(28,6))) AS DOUBLE) AS total_contractor_cost_sgd
FROM contractor_mart GROUP BY 1, 2""",
    "months": """
SELECT month_start_date FROM billing_mart UNION SELECT month_start_date FROM card_spend
UNION SELECT month_start_date FROM card_contractor UNION SELECT month_start_date FROM network_mart""",
    "card_joined": """
SELECT z.zone_name, z.region, z.population_served, z.sla_response_hours, m.month_start_date,
       b.total_consumption AS total_consumption_m3, b.total_billed AS total_billed_sgd, b.total_accounts, b.overdue_count,
       b.overdue_rate_pct, f.total_invoice_spend_sgd, f.invoice_line_count, c.total_work_orders,
       c.total_contractor_cost_sgd, n.avg_pressure AS avg_pressure_bar, n.avg_flow AS avg_flow_lpm,
       n.reliability_pct AS telemetry_reliability_pct,
       CAST(CAST(coalesce(f.total_invoice_spend_sgd, 0) AS DECIMAL(28,6)) + CAST(coalesce(c.total_contractor_cost_sgd, 0) AS DECIMAL(28,6)) AS DOUBLE) AS total_opex_sgd
FROM current_zones z CROSS JOIN months m
LEFT JOIN billing_mart b ON b.service_zone = z.zone_name AND b.month_start_date = m.month_start_date
LEFT JOIN card_spend f ON f.zone_name = z.zone_name AND f.month_start_date = m.month_start_date
LEFT JOIN card_contractor c ON c.zone_name = z.zone_name AND c.month_start_date = m.month_start_date
LEFT JOIN network_mart n ON n.zone = z.zone_name AND n.month_start_date = m.month_start_date""",
    "card": f"""
SELECT *,
       {half_up(micros("total_opex_sgd"), micros("total_consumption_m3"), 2)} AS opex_per_m3,
       {half_up(cents("overdue_rate_pct") + " * " + micros("total_billed_sgd"), "10000000000", 2)} AS revenue_at_risk_sgd,
       {half_up(micros("total_billed_sgd"), micros("total_opex_sgd"), 2)} AS cost_recovery_ratio,
       {half_up(micros("total_consumption_m3"), "CAST(population_served AS HUGEINT) * 1000000", 4)} AS consumption_per_capita_m3,
       {half_up(micros("total_opex_sgd"), "CAST(population_served AS HUGEINT) * 1000000", 4)} AS opex_per_capita_sgd,
       CAST((total_consumption_m3 IS NOT NULL)::INT + (total_invoice_spend_sgd IS NOT NULL)::INT
            + (total_contractor_cost_sgd IS NOT NULL)::INT
            + (avg_pressure_bar IS NOT NULL OR avg_flow_lpm IS NOT NULL)::INT AS INT) AS data_sources_available,
       CAST(trunc((year({AS_OF}) - year(month_start_date)) * 12 + month({AS_OF}) - month(month_start_date)
            + (day({AS_OF}) - day(month_start_date)) / 31.0) AS INT) AS age
FROM card_joined""",
    "scorecard": f"""
SELECT * EXCLUDE (age),
       CASE WHEN cost_recovery_ratio IS NULL THEN NULL WHEN cost_recovery_ratio < 0.8 THEN 'RED'
            WHEN cost_recovery_ratio < 1.0 THEN 'AMBER' ELSE 'GREEN' END AS cost_recovery_flag,
       CASE WHEN telemetry_reliability_pct IS NULL THEN NULL WHEN telemetry_reliability_pct < 50 THEN 'RED'
            WHEN telemetry_reliability_pct < 80 THEN 'AMBER' ELSE 'GREEN' END AS network_reliability_flag,
       CASE WHEN age <= 1 AND data_sources_available >= 3 THEN 'FRESH'
            WHEN age <= 1 AND data_sources_available >= 1 THEN 'PARTIAL'
            WHEN age <= 1 THEN 'STALE' WHEN age <= 3 AND data_sources_available >= 3 THEN 'FRESH'
            WHEN age <= 3 THEN 'INCOMPLETE' ELSE 'HISTORICAL' END AS data_freshness_flag,
       {PROCESSED} AS refresh_timestamp
FROM card""",
    "pii_daily": """
SELECT account_id, billing_period, customer_name, address, contact_number
FROM in_bills WHERE account_id IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY account_id, billing_period ORDER BY customer_name DESC NULLS LAST,
                           address DESC NULLS LAST, contact_number DESC NULLS LAST) = 1""",
    "pii_changes": """
SELECT * FROM pii_daily
WINDOW w AS (PARTITION BY account_id ORDER BY billing_period)
QUALIFY row_number() OVER w = 1 OR customer_name IS DISTINCT FROM lag(customer_name) OVER w
        OR address IS DISTINCT FROM lag(address) OVER w OR contact_number IS DISTINCT FROM lag(contact_number) OVER w""",
    "pii_history": """
SELECT account_id, customer_name, address, contact_number, billing_period AS effective_from,
       CAST(lead(billing_period) OVER w - INTERVAL 1 DAY AS DATE) AS effective_to,
       lead(billing_period) OVER w IS NULL AS is_current
FROM pii_changes WINDOW w AS (PARTITION BY account_id ORDER BY billing_period)""",
}


def with_inputs(sql: str) -> str:
    """Put the named inputs, and the inputs they name, in front of a query."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in INPUTS:
            if name not in needed and re.search(rf"\b{name}\b", text):
                visit(INPUTS[name])
                if name not in needed:
                    needed.append(name)

    visit(sql)
    if not needed:
        return sql.strip()
    if sql.strip().upper().startswith("WITH "):
        sql = ", " + sql.strip()[5:]
    ctes = ",\n".join(f"{name} AS ({INPUTS[name].strip()})" for name in needed)
    return f"WITH {ctes}\n{sql.strip()}"
