"""Dashboard numbers and the reports beside them."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from sluiceway import config
from sluiceway.functions.conforming import month_start
from sluiceway.operators.profile import profile_columns, repeated_keys
from sluiceway.operators.rules import dq_metrics
from sluiceway.plans import billing, contractors, dashboard, reports
from sluiceway.plans.finance import incoming_invoices
from sluiceway.queries.marts import metrics_sql, profile_sql
from sluiceway.queries.oracle import half_up, micros
from sluiceway.queries.registry import query

# --- dashboard -------------------------------------------------------------


@query(
    "B-01",
    """SELECT CAST(sum(work_order_count) AS BIGINT) AS total_work_orders, CAST(sum(CAST(total_cost AS DECIMAL(28,6))) AS DOUBLE) AS total_cost,
    CAST(sum(CAST(total_cost AS DECIMAL(28,6))) AS DOUBLE) / sum(work_order_count) AS avg_cost_per_order FROM contractor_mart""",
)
def kpi_contractor(inputs):
    return dashboard.contractor_kpis(inputs.contractor_mart())


@query(
    "B-01 per contractor",
    """SELECT contractor_source, CAST(sum(work_order_count) AS BIGINT) AS total_work_orders,
    CAST(sum(CAST(total_cost AS DECIMAL(28,6))) AS DOUBLE) AS total_cost, CAST(sum(CAST(total_cost AS DECIMAL(28,6))) AS DOUBLE) / sum(work_order_count) AS avg_cost_per_order
    FROM contractor_mart GROUP BY 1""",
)
def kpi_by_contractor(inputs):
    return dashboard.contractor_kpis(inputs.contractor_mart(), ["contractor_source"])


@query(
    "B-02",
    "SELECT completion_month, contractor_source, CAST(sum(CAST(total_cost AS DECIMAL(28,6))) AS DOUBLE) AS total_cost FROM contractor_mart GROUP BY 1, 2",
)
def cost_trend(inputs):
    return dashboard.cost_trend(inputs.contractor_mart())


@query(
    "B-03",
    "SELECT zone, contractor_source, CAST(sum(work_order_count) AS BIGINT) AS total_work_orders FROM contractor_mart GROUP BY 1, 2",
)
def orders_by_zone(inputs):
    return dashboard.orders_by_zone(inputs.contractor_mart())


@query(
    "B-04",
    "SELECT zone, "
    + ", ".join(f"CAST(sum(CAST(total_cost AS DECIMAL(28,6))) FILTER (contractor_source = '{c}') AS DOUBLE) AS {c}" for c in config.CONTRACTORS)
    + " FROM contractor_mart GROUP BY zone",
)
def cost_matrix(inputs):
    return dashboard.cost_matrix(inputs.contractor_mart(), list(config.CONTRACTORS))


@query(
    "B-05",
    "SELECT CAST(sum(CAST(total_spend AS DECIMAL(28,6))) AS DOUBLE) AS total_spend, CAST(sum(line_item_count) AS BIGINT) AS total_line_items FROM spend_mart",
)
def kpi_spend(inputs):
    return dashboard.spend_kpis(inputs.spend_mart())


@query("B-06", "SELECT invoice_month, project_code, CAST(sum(CAST(total_spend AS DECIMAL(28,6))) AS DOUBLE) AS total_spend FROM spend_mart GROUP BY 1, 2")
def spend_by_project(inputs):
    return dashboard.spend_by_project(inputs.spend_mart())


@query(
    "B-07, U-03",
    "SELECT site_zone, CAST(sum(CAST(total_spend AS DECIMAL(28,6))) AS DOUBLE) AS total_spend FROM spend_mart GROUP BY 1 ORDER BY total_spend DESC, site_zone",
)
def spend_rank(inputs):
    return dashboard.spend_rank(inputs.spend_mart())


@query(
    "B-08",
    f"""SELECT site_zone, project_code, total_spend, {half_up("100 * " + micros("total_spend"), micros("zone_total"), 2)} AS share_pct
    FROM (SELECT site_zone, project_code, CAST(sum(CAST(total_spend AS DECIMAL(28,6))) AS DOUBLE) AS total_spend,
                 CAST(sum(sum(CAST(total_spend AS DECIMAL(28,6)))) OVER (PARTITION BY site_zone) AS DOUBLE) AS zone_total
          FROM spend_mart GROUP BY site_zone, project_code)""",
)
def spend_share(inputs):
    return dashboard.spend_share(inputs.spend_mart())


@query(
    "B-09",
    """SELECT * FROM spend_mart WHERE invoice_month BETWEEN TIMESTAMP '1997-01-01' AND TIMESTAMP '1998-12-01'
    AND site_zone IN ('NATION_1', 'NATION_2', 'NATION_3') AND project_code IN ('P1', 'P2', 'OPEX-UNALLOCATED')""",
)
def sliced_spend(inputs):
    return dashboard.sliced(
        inputs.spend_mart(),
        "invoice_month",
        dt.date(1997, 1, 1),
        dt.date(1998, 12, 1),
        site_zone=["NATION_1", "NATION_2", "NATION_3"],
        project_code=["P1", "P2", config.UNALLOCATED_PROJECT],
    )


# --- integrity -------------------------------------------------------------


@query(
    "E-01",
    """SELECT invoice_id, count(*) AS line_count, CAST(sum(CAST(line_total AS DECIMAL(28,6))) AS DOUBLE) AS line_value FROM lines
    WHERE invoice_id NOT IN (SELECT invoice_id FROM headers) GROUP BY invoice_id""",
)
def orphan_lines(inputs):
    return reports.orphan_lines(inputs.lines(), inputs.headers())


@query(
    "E-02: works order ids that are not unique",
    "SELECT contractor_source, work_order_id, count(*) AS copies FROM incoming_orders GROUP BY 1, 2 HAVING count(*) > 1",
)
def repeated_work_orders(inputs):
    return repeated_keys(contractors.conformed_orders(inputs.works_orders()), ["contractor_source", "work_order_id"])


_HEADER_COLUMNS = ["invoice_id", "vendor_id", "currency", "invoice_date", "project_code"]


@query(
    "E-02 by month and zone",
    profile_sql(
        "(SELECT *, CAST(date_trunc('month', invoice_date) AS DATE) AS month_start_date FROM incoming_headers)",
        "finance_invoices", ["project_code"], ["project_code"], "month_start_date, site_zone",
    ),
)
def null_rate_by_month_zone(inputs):
    headers = incoming_invoices(inputs.invoice_headers()).withColumn("month_start_date", month_start("invoice_date"))
    return profile_columns(headers, ["project_code"], "finance_invoices", ["month_start_date", "site_zone"])


@query(
    "E-02 by vendor",
    profile_sql("incoming_headers", "finance_invoices", _HEADER_COLUMNS, ["invoice_id", "currency", "project_code"], "vendor_name"),
)
def null_rate_by_vendor(inputs):
    return profile_columns(incoming_invoices(inputs.invoice_headers()), _HEADER_COLUMNS, "finance_invoices", ["vendor_name"])


@query(
    "E-03, with a code list that knows only the long forms",
    """SELECT lower(payment_status) AS payment_status, count(*) AS bills FROM in_bills
    WHERE upper(payment_status) NOT IN ('PAID', 'PENDING', 'OUTSTANDING') GROUP BY 1""",
)
def unknown_status(inputs):
    long_forms = {name: codes[:1] for name, codes in config.STATUS_CODES.items()}
    return reports.unknown_status(inputs.bills(), long_forms)


_HARD = {
    "valid_account_id": "account_id IS NOT NULL",
    "valid_meter_id": "meter_id IS NOT NULL",
    "valid_consumption": "consumption_value IS NOT NULL",
    "valid_amount": "amount_billed IS NOT NULL",
}


@query("D-13 by month", metrics_sql("conformed_bills", "bills", _HARD, "drop", "month_start_date"))
def reject_rates_by_month(inputs):
    bills = billing.conformed_bills(inputs.bills())
    return dq_metrics(bills, config.BILL_HARD, "bills", ["month_start_date"])


@query(
    "E-04",
    f"""SELECT dataset, rule, month_start_date, failed, failed_pct, z_score, coalesce(z_score > 2, FALSE) AS is_spike
    FROM (SELECT *, round((failed_pct - avg(failed_pct) OVER w) / nullif(round(stddev_pop(failed_pct) OVER w, 9), 0), 3) AS z_score
          FROM ({metrics_sql("conformed_bills", "bills", _HARD, "drop", "month_start_date")})
          WINDOW w AS (PARTITION BY dataset, rule))""",
)
def reject_spikes(inputs):
    bills = billing.conformed_bills(inputs.bills())
    rates = dq_metrics(bills, config.BILL_HARD, "bills", ["month_start_date"])
    return reports.reject_spikes(rates, "month_start_date", 2.0)


# --- trends and alerts -----------------------------------------------------


@query(
    "E-07",
    f"""SELECT *, CAST(CAST(current_value AS DECIMAL(28,6)) - CAST(previous_value AS DECIMAL(28,6)) AS DOUBLE) AS change,
    {half_up("100 * " + micros("current_value - previous_value"), micros("previous_value"), 2)} AS change_pct
    FROM (SELECT zone_name AS zone, month_start_date, total_invoice_spend_sgd AS current_value,
          lag(total_invoice_spend_sgd) OVER (PARTITION BY zone_name ORDER BY month_start_date) AS previous_value FROM card_spend)""",
)
def month_over_month(inputs):
    return reports.month_over_month(inputs.spend_mart(), "site_zone", "invoice_month", "total_spend")


@query(
    "E-08",
    """SELECT coalesce(c.zone_name, f.zone_name) AS zone_name, coalesce(c.month_start_date, f.month_start_date) AS month_start_date,
    total_contractor_cost_sgd, total_invoice_spend_sgd,
    CAST(CAST(coalesce(total_contractor_cost_sgd, 0) AS DECIMAL(28,6)) - CAST(coalesce(total_invoice_spend_sgd, 0) AS DECIMAL(28,6)) AS DOUBLE) AS cost_minus_invoices
    FROM card_contractor c FULL JOIN card_spend f ON c.zone_name = f.zone_name AND c.month_start_date = f.month_start_date""",
)
def contractor_against_invoices(inputs):
    return reports.contractor_against_invoices(inputs.contractor_mart(), inputs.spend_mart())


@query(
    "E-09",
    """SELECT zone_name, month_start_date, total_invoice_spend_sgd, CAST(sum(CAST(total_invoice_spend_sgd AS DECIMAL(28,6))) OVER
    (PARTITION BY zone_name, year(month_start_date) ORDER BY month_start_date) AS DOUBLE) AS ytd_spend_sgd FROM card_spend""",
)
def year_to_date_spend(inputs):
    return reports.year_to_date(inputs.spend_mart())


@query("E-10: overdue rate", "SELECT * FROM billing_mart WHERE overdue_rate_pct > 40")
def overdue_alerts(inputs):
    return reports.alerts(inputs.billing_mart(), F.col("overdue_rate_pct") > 40)


@query("E-10: monthly cost", "SELECT * FROM contractor_mart WHERE total_cost > 250000")
def cost_alerts(inputs):
    return reports.alerts(inputs.contractor_mart(), F.col("total_cost") > 250_000)
