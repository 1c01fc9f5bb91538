"""One short query per building block: projections, predicates, joins, aggregates, windows, functions, tables."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from sluiceway import config
from sluiceway.functions import conforming as c
from sluiceway.functions import measures as m
from sluiceway.operators import dedup, history, lookup, resolve, rules
from sluiceway.operators.conform import union_all
from sluiceway.operators.layout import cluster_rows, curve_rows
from sluiceway.operators.profile import merged_sketches, value_profile, value_sketches
from sluiceway.operators.quarantine import all_reasons, first_reason
from sluiceway.plans import billing, contractors, finance, network, scorecard
from sluiceway.queries.oracle import AS_OF, BILL_BAD, BILL_ORDER, EARLIEST, LINE_OK, READING_ORDER, half_up
from sluiceway.queries.oracle import all_reasons as reasons_sql
from sluiceway.queries.oracle import first_reason as reason_sql
from sluiceway.queries.registry import SETTINGS, query
from sluiceway.sources import tables
from sluiceway.sources.tables import scratch, store


def part(name: str, covers: str, sql: str, build) -> None:
    build.__name__ = name
    query(covers, sql)(build)


def conformed(i):
    return billing.conformed_bills(i.bills())


def incoming_orders(i):
    return contractors.conformed_orders(i.works_orders())


# --- projections and predicates ---------------------------------------------

part(
    "select_and_rename",
    "P-01, P-02",
    "SELECT account_id AS account, service_zone AS zone, billing_period AS billed_on FROM in_bills",
    lambda i: i.bills().select(
        F.col("account_id").alias("account"),
        F.col("service_zone").alias("zone"),
        F.col("billing_period").alias("billed_on"),
    ),
)

part(
    "derived_columns",
    "P-03",
    "SELECT seq, month_start_date, consumption_m3, amount_billed, payment_status FROM conformed_bills",
    lambda i: conformed(i).select(
        "seq", "month_start_date", "consumption_m3", "amount_billed", "payment_status"
    ),
)

part(
    "drop_after_join",
    "P-04",
    """SELECT h.invoice_id, h.site_zone, z.region FROM in_invoice_headers h JOIN in_dim_zone z ON h.site_zone =
    z.zone_name""",
    lambda i: lookup.lookup(
        i.invoice_headers().select("invoice_id", "site_zone"),
        i.zones().select("zone_name", "region"),
        "site_zone",
        "zone_name",
        "inner",
    ),
)

part(
    "nested_field",
    "P-05",
    "SELECT invoice_id, vendor_id, vendor_name FROM in_invoice_headers",
    lambda i: i.invoice_headers().select(
        "invoice_id", F.col("vendor.id").alias("vendor_id"), F.col("vendor.name").alias("vendor_name")
    ),
)

part(
    "struct_star",
    "P-06",
    "SELECT invoice_id, vendor_id AS id, vendor_name AS name FROM in_invoice_headers",
    lambda i: i.invoice_headers().select("invoice_id", "vendor.*"),
)

part(
    "filter_by_column",
    "P-07",
    "SELECT * FROM in_dim_zone WHERE is_current AND sla_response_hours = 4",
    lambda i: i.zones().where(F.col("is_current") & (F.col("sla_response_hours") == 4)),
)

part(
    "filter_by_text",
    "P-08",
    "SELECT * FROM incoming_lines WHERE NOT (qty > 0 AND description IS NOT NULL) ",
    lambda i: finance.incoming_lines(i.invoice_line_records()).where(
        "NOT (qty > 0 AND description IS NOT NULL)"
    ),
)


def _rule_and_complement(i):
    good, bad = rules.split(i.bills(), config.BILL_HARD)
    sides = union_all([good.withColumn("side", F.lit("good")), bad.withColumn("side", F.lit("bad"))])
    return sides.groupBy("side").agg(F.count(F.lit(1)).alias("bills"))


part(
    "rule_and_complement",
    "P-09: both sides add up to the input",
    f"SELECT CASE WHEN {' OR '.join(BILL_BAD.values())} THEN 'bad' ELSE 'good' END AS side, count(*) AS bills FROM in_bills GROUP BY 1",
    _rule_and_complement,
)

part(
    "null_tests",
    "P-10",
    "SELECT seq, account_id IS NULL AS no_account, amount_billed IS NOT NULL AS has_amount FROM in_bills",
    lambda i: i.bills().select(
        "seq",
        F.col("account_id").isNull().alias("no_account"),
        F.col("amount_billed").isNotNull().alias("has_amount"),
    ),
)

part(
    "membership_in_literals",
    "P-11",
    "SELECT seq, upper(payment_status) IN ('OUTSTANDING', 'OS') AS is_overdue FROM in_bills",
    lambda i: i.bills().select(
        "seq", F.upper("payment_status").isin(config.STATUS_CODES["overdue"]).alias("is_overdue")
    ),
)

part(
    "membership_in_table",
    "P-12",
    """SELECT work_order_id, zone, cost, coalesce(zone IN (SELECT zone_name FROM current_zones), FALSE) AS is_known
    FROM incoming_orders""",
    lambda i: rules.flag_known(
        incoming_orders(i).select("work_order_id", "zone", "cost"),
        "zone",
        history.current(i.zones()),
        "zone_name",
        "is_known",
    ),
)

part(
    "pattern_match",
    "P-13",
    "SELECT work_order_id, charge LIKE 'SGD %' AS has_prefix FROM in_works_orders WHERE layout = 'R'",
    lambda i: i.works_orders()["contractor_c"].select(
        F.col("id").alias("work_order_id"), F.col("charge").like("SGD %").alias("has_prefix")
    ),
)

part(
    "range_check",
    "P-14",
    "SELECT seq, CAST(reading_value AS DOUBLE) BETWEEN -2 AND 8 AS in_range FROM in_readings",
    lambda i: i.readings().select("seq", F.col("reading_value").between(-2, 8).alias("in_range")),
)

part(
    "implication",
    "P-15",
    "SELECT seq, reading_type <> 'flow' OR reading_value BETWEEN -50 AND 150 AS holds FROM in_readings",
    lambda i: i.readings().select(
        "seq", F.expr("NOT (reading_type = 'flow') OR reading_value BETWEEN -50 AND 150").alias("holds")
    ),
)

part(
    "boolean_logic",
    "P-16",
    "SELECT * FROM incoming_headers WHERE (currency IS NULL OR currency = '') AND NOT (project_code IS NULL)",
    lambda i: finance.flatten_headers(i.invoice_headers()).where(
        (F.col("currency").isNull() | (F.col("currency") == "")) & ~F.col("project_code").isNull()
    ),
)

part(
    "non_empty",
    "P-17, F-17",
    """SELECT h.invoice_id, count(*) AS records, count(*) FILTER (currency <> '') AS with_currency,
    count(l.invoice_id) AS with_lines FROM in_invoice_headers h LEFT JOIN in_invoice_lines l USING (invoice_id)
    GROUP BY 1""",
    lambda i: i.invoice_records().groupBy("invoice_id").agg(
        F.count(F.lit(1)).alias("records"),
        F.count_if(F.col("currency") != "").alias("with_currency"),
        F.count_if(F.size("line_items") > 0).alias("with_lines"),
    ),
)

part(
    "date_window",
    "P-18, F-04",
    f"SELECT invoice_id, invoice_date FROM incoming_headers WHERE invoice_date BETWEEN {EARLIEST} AND {AS_OF}",
    lambda i: finance.flatten_headers(i.invoice_headers()).select("invoice_id", "invoice_date").where(
        F.col("invoice_date").between(F.lit(SETTINGS.earliest_date), F.lit(SETTINGS.as_of))
    ),
)

# --- joins -------------------------------------------------------------------

part(
    "inner_join",
    "J-01",
    "SELECT l.*, h.site_zone FROM lines l JOIN headers h ON l.invoice_id = h.invoice_id",
    lambda i: i.lines().join(i.stored_headers().select("invoice_id", "site_zone"), "invoice_id"),
)

part(
    "left_join",
    "J-02",
    """SELECT seq, r.location_id, zone, resolved_zone FROM in_readings r LEFT JOIN locations l ON r.location_id =
    l.location_id""",
    lambda i: i.readings().select("seq", "location_id", "zone").join(
        i.locations().select("location_id", "resolved_zone"), "location_id", "left"
    ),
)

part(
    "zone_lookup",
    "J-03, C-06",
    "SELECT work_order_id, zone, cost, zone_id FROM incoming_orders",
    lambda i: contractors.with_zone_id(incoming_orders(i), i.zones(), SETTINGS).select(
        "work_order_id", "zone", "cost", "zone_id"
    ),
)

part(
    "salted_lookup",
    "J-03 with a dimension that is not broadcast",
    "SELECT work_order_id, zone, cost, zone_id FROM incoming_orders",
    lambda i: lookup.lookup(
        incoming_orders(i).select("work_order_id", "zone", "cost"),
        history.current(i.zones()).select("zone_id", "zone_name"),
        "zone",
        "zone_name",
        spread=["work_order_id", "cost"],
        salts=8,
    ),
)

part(
    "two_column_left_join",
    "J-04",
    """SELECT b.service_zone AS zone_name, b.month_start_date, total_billed, total_invoice_spend_sgd FROM
    billing_mart b LEFT JOIN card_spend f ON f.zone_name = b.service_zone AND f.month_start_date =
    b.month_start_date""",
    lambda i: i.billing_mart().select(F.col("service_zone").alias("zone_name"), "month_start_date", "total_billed").join(
        scorecard.spend_rollup(i.spend_mart()).drop("invoice_line_count"), scorecard.KEY, "left"
    ),
)

part(
    "left_join_then_not_null",
    "J-06",
    """SELECT seq, location_id, resolved_zone FROM in_readings JOIN locations USING (location_id) WHERE
    resolved_zone IS NOT NULL""",
    lambda i: i.readings().select("seq", "location_id").join(
        i.locations().select("location_id", "resolved_zone"), "location_id", "left"
    ).where(
        "resolved_zone IS NOT NULL"
    ),
)

part(
    "existence_check",
    "J-07",
    "SELECT * FROM lines WHERE invoice_id IN (SELECT invoice_id FROM headers)",
    lambda i: i.lines().join(i.stored_headers().select("invoice_id"), "invoice_id", "left_semi"),
)

# --- aggregates --------------------------------------------------------------

part(
    "group_by_columns",
    "A-01, A-03, A-04",
    """SELECT service_zone, payment_status, count(*) AS bills, CAST(sum(CAST(amount_billed AS DECIMAL(28,6))) AS DOUBLE) AS billed FROM
    conformed_bills GROUP BY 1, 2""",
    lambda i: conformed(i).groupBy("service_zone", "payment_status").agg(
        F.count(F.lit(1)).alias("bills"), m.total("amount_billed").alias("billed")
    ),
)

part(
    "group_by_expressions",
    "A-02",
    """SELECT substring(site_zone, 8, 2) AS zone_code, coalesce(project_code, 'OPEX-UNALLOCATED') AS project_code,
    CAST(date_trunc('month', invoice_date) AS DATE) AS month_start_date, count(*) AS invoices FROM headers GROUP
    BY 1, 2, 3""",
    lambda i: i.headers().groupBy(
        c.code_in_name("site_zone", 8, 2).alias("zone_code"),
        c.named_bucket("project_code").alias("project_code"),
        c.month_start("invoice_date").alias("month_start_date"),
    ).agg(
        F.count(F.lit(1)).alias("invoices")
    ),
)

part(
    "conditional_count",
    "A-05",
    """SELECT location_id, count(*) FILTER (is_duplicate) AS duplicates, count(*) FILTER (NOT zone_is_uncertain) AS
    certain FROM readings_done GROUP BY 1""",
    lambda i: i.telemetry(i.locations()).groupBy("location_id").agg(
        F.count_if("is_duplicate").alias("duplicates"), F.count_if(~F.col("zone_is_uncertain")).alias("certain")
    ),
)

part(
    "distinct_count",
    "A-06",
    "SELECT service_zone, count(DISTINCT account_id) AS accounts FROM in_bills GROUP BY 1",
    lambda i: i.bills().groupBy("service_zone").agg(F.countDistinct("account_id").alias("accounts")),
)

part(
    "mean_per_group",
    "A-07",
    """SELECT description, CAST(sum(CAST(unit_cost AS DECIMAL(28,6))) AS DOUBLE) / count(unit_cost) AS mean_unit_cost FROM incoming_lines GROUP
    BY 1""",
    lambda i: finance.incoming_lines(i.invoice_line_records()).groupBy("description").agg(
        m.mean("unit_cost").alias("mean_unit_cost")
    ),
)

part(
    "conditional_mean",
    "A-08",
    """SELECT location_id, CAST(sum(CAST(reading_value AS DECIMAL(28,6))) FILTER (reading_type = 'pressure') AS DOUBLE) /
    count(reading_value) FILTER (reading_type = 'pressure') AS mean_pressure FROM in_readings GROUP BY 1""",
    lambda i: i.readings().groupBy("location_id").agg(
        m.mean(F.when(F.col("reading_type") == "pressure", F.col("reading_value"))).alias("mean_pressure")
    ),
)

part(
    "rate_of_counts",
    "A-09, F-13",
    f"""SELECT service_zone, {half_up("100 * count(*) FILTER (payment_status = 'overdue')", "count(*)", 2)} AS overdue_pct FROM conformed_bills GROUP BY 1""",
    lambda i: conformed(i).groupBy("service_zone").agg(
        F.count_if(F.col("payment_status") == "overdue").alias("n"), F.count(F.lit(1)).alias("all")
    ).select(
        "service_zone", m.percent("n", "all").alias("overdue_pct")
    ),
)

part(
    "two_level_count",
    "A-10",
    """SELECT location_id, CAST(sum(votes) AS BIGINT) AS readings, count(*) AS zones FROM ranked_zones GROUP BY 1""",
    lambda i: resolve.votes(i.readings(), "location_id", "zone").groupBy("location_id").agg(
        F.sum("votes").alias("readings"), F.count(F.lit(1)).alias("zones")
    ),
)

part(
    "mart_rollup",
    "A-11",
    "SELECT * FROM card_contractor",
    lambda i: scorecard.contractor_rollup(i.contractor_mart()),
)

part(
    "global_count",
    "A-12",
    "SELECT count(*) AS zones FROM in_zone_master",
    lambda i: i.zone_master().agg(F.count(F.lit(1)).alias("zones")),
)

# --- windows -----------------------------------------------------------------

part(
    "first_per_key",
    "W-01",
    f"""SELECT account_id, month_start_date, billing_period, amount_billed FROM conformed_bills
     QUALIFY row_number() OVER (PARTITION BY account_id, month_start_date ORDER BY {BILL_ORDER}, seq) = 1""",
    lambda i: dedup.keep_first(conformed(i), ["account_id", "month_start_date"], [*billing.FIRST_BILL, "seq"]).select(
        "account_id", "month_start_date", "billing_period", "amount_billed"
    ),
)

part(
    "latest_per_key",
    "W-02",
    """SELECT account_id, billing_period, seq FROM in_bills QUALIFY row_number() OVER (PARTITION BY account_id
    ORDER BY billing_period DESC, seq DESC) = 1""",
    lambda i: dedup.keep_latest(i.bills(), ["account_id"], "billing_period", ["seq"]).select(
        "account_id", "billing_period", "seq"
    ),
)

part(
    "duplicate_flags",
    "W-03",
    f"""SELECT seq, row_number() OVER (PARTITION BY sensor_id, reading_ts ORDER BY {READING_ORDER}) > 1 AS is_duplicate
     FROM parsed_readings WHERE reading_value IS NOT NULL""",
    lambda i: dedup.flag_duplicates(
        network.parsed_readings(i.readings()).where("reading_value IS NOT NULL"),
        network.READING_KEY,
        ["reading_value", "reading_type", "location_id", "zone", "seq"],
        ["seq"],
        SETTINGS.lanes,
    ).select(
        "seq", "is_duplicate"
    ),
)

part(
    "top_label",
    "W-04, C-07",
    "SELECT location_id, zone AS resolved_zone FROM ranked_zones WHERE rn = 1",
    lambda i: resolve.resolve(resolve.votes(i.readings(), "location_id", "zone"), "location_id", "zone", 80).select(
        "location_id", "resolved_zone"
    ),
)


def _zone_months(i):
    return conformed(i).groupBy("service_zone", "month_start_date").agg(F.count(F.lit(1)).alias("bills"))


_ZONE_MONTHS = "(SELECT service_zone, month_start_date, count(*) AS bills FROM conformed_bills GROUP BY 1, 2)"

part(
    "previous_value",
    "W-05",
    f"SELECT *, lag(bills) OVER (PARTITION BY service_zone ORDER BY month_start_date) AS bills_before FROM {_ZONE_MONTHS}",
    lambda i: _zone_months(i).withColumn(
        "bills_before", F.lag("bills").over(Window.partitionBy("service_zone").orderBy("month_start_date"))
    ),
)

part(
    "next_value",
    "W-06",
    f"SELECT *, lead(bills) OVER (PARTITION BY service_zone ORDER BY month_start_date) AS bills_after FROM {_ZONE_MONTHS}",
    lambda i: _zone_months(i).withColumn(
        "bills_after", F.lead("bills").over(Window.partitionBy("service_zone").orderBy("month_start_date"))
    ),
)

# --- order, sets -------------------------------------------------------------

part(
    "order_by_key",
    "U-01",
    "SELECT zone_id, zone_name FROM in_dim_zone ORDER BY zone_id",
    lambda i: i.zones().select("zone_id", "zone_name").orderBy("zone_id"),
)

part(
    "latest_rows",
    "U-02: a report of the ten newest bills",
    "SELECT seq, billing_period FROM in_bills ORDER BY billing_period DESC, seq LIMIT 10",
    lambda i: i.bills().select("seq", "billing_period").orderBy(F.col("billing_period").desc(), "seq").limit(10),
)

part(
    "union_of_months",
    "U-04, U-05",
    """SELECT CAST(date_trunc('month', billing_period) AS DATE) AS month_start_date FROM in_bills UNION SELECT
    CAST(date_trunc('month', completion_date) AS DATE) FROM incoming_orders WHERE completion_date IS NOT NULL""",
    lambda i: union_all(
        [
            conformed(i).select("month_start_date"),
            incoming_orders(i).where("completion_date IS NOT NULL").select(
                c.month_start("completion_date").alias("month_start_date")
            ),
        ],
    ).distinct(),
)

part(
    "distinct_on_key",
    "U-06",
    "SELECT DISTINCT site_zone FROM in_invoice_headers",
    lambda i: i.invoice_headers().select("site_zone").dropDuplicates(["site_zone"]),
)

part(
    "many_sources_one_table",
    "C-05, U-07",
    "SELECT contractor_source, count(*) AS orders FROM incoming_orders GROUP BY 1",
    lambda i: incoming_orders(i).groupBy("contractor_source").agg(F.count(F.lit(1)).alias("orders")),
)

# --- scalar functions --------------------------------------------------------

part(
    "month_truncation",
    "F-01",
    """SELECT seq, CAST(date_trunc('month', billing_period) AS DATE) AS month_start_date, CAST(date_trunc('month',
    billing_period) AS TIMESTAMP) AS month_instant FROM in_bills""",
    lambda i: i.bills().select(
        "seq",
        c.month_start("billing_period").alias("month_start_date"),
        c.month_instant("billing_period").alias("month_instant"),
    ),
)

part(
    "text_to_date",
    "F-02",
    "SELECT invoice_id, TRY_CAST(invoice_date AS DATE) AS invoice_date FROM in_invoice_headers",
    lambda i: i.invoice_headers().select("invoice_id", c.text_to_date("invoice_date").alias("invoice_date")),
)

part(
    "text_to_timestamp",
    "F-03",
    "SELECT seq, reading_ts FROM parsed_readings",
    lambda i: i.readings().select("seq", c.text_to_timestamp("timestamp").alias("reading_ts")),
)

part(
    "months_between",
    "F-04, F-05",
    f"""SELECT seq, CAST(trunc(CASE WHEN day(billing_period) = 30 THEN 0.0 WHEN billing_period = last_day(billing_period) THEN 0.0
     ELSE (30 - day(billing_period)) / 31.0 END + (year({AS_OF}) - year(billing_period)) * 12 + 6 - month(billing_period)) AS INT) AS age_months
     FROM in_bills""",
    lambda i: i.bills().select(
        "seq", resolve.months_since(SETTINGS.as_of, F.col("billing_period")).alias("age_months")
    ),
)

part(
    "day_before",
    "F-06, F-19",
    "SELECT seq, CAST(billing_period - INTERVAL 1 DAY AS DATE) AS day_before FROM in_bills",
    lambda i: i.bills().select("seq", F.date_sub("billing_period", 1).alias("day_before")),
)

part(
    "upper_lower",
    "F-07",
    "SELECT seq, upper(payment_status) AS upper_status, lower(payment_status) AS lower_status FROM in_bills",
    lambda i: i.bills().select(
        "seq", F.upper("payment_status").alias("upper_status"), F.lower("payment_status").alias("lower_status")
    ),
)

part(
    "code_in_name",
    "F-08",
    "SELECT invoice_id, substring(site_zone, 8, 2) AS zone_code FROM in_invoice_headers",
    lambda i: i.invoice_headers().select("invoice_id", c.code_in_name("site_zone", 8, 2).alias("zone_code")),
)

part(
    "charge_to_number",
    "F-09, C-04",
    """SELECT work_order_id, CAST(replace(charge, 'SGD ', '') AS DOUBLE) AS cost FROM in_works_orders WHERE layout
    = 'R'""",
    lambda i: i.works_orders()["contractor_c"].select(
        F.col("id").alias("work_order_id"), c.charge_amount("charge").alias("cost")
    ),
)

part(
    "reasons_joined",
    "F-10, D-12",
    f"SELECT invoice_id, line_no, qty, {reasons_sql(LINE_OK)} AS reasons FROM incoming_lines",
    lambda i: finance.incoming_lines(i.invoice_line_records()).select(
        "invoice_id", "line_no", "qty", all_reasons(config.LINE_HARD).alias("reasons")
    ),
)

part(
    "first_of_reasons",
    "F-12, D-07",
    f"SELECT seq, {reason_sql(BILL_BAD)} AS reason FROM in_bills",
    lambda i: i.bills().select("seq", first_reason(config.BILL_HARD).alias("reason")),
)

part(
    "null_bucket",
    "F-11, C-10",
    "SELECT invoice_id, coalesce(project_code, 'OPEX-UNALLOCATED') AS project_code FROM in_invoice_headers",
    lambda i: i.invoice_headers().select("invoice_id", c.named_bucket("project_code").alias("project_code")),
)

part(
    "status_codes",
    "F-12, C-02",
    "SELECT seq, payment_status FROM conformed_bills",
    lambda i: conformed(i).select("seq", "payment_status"),
)

part(
    "guarded_ratio",
    "F-13, F-14",
    f"""SELECT service_zone, month_start_date, {half_up("CAST(round(total_billed * 1000000) AS HUGEINT)", "CAST(round(total_consumption * 1000000) AS HUGEINT)", 4)}
     AS billed_per_m3 FROM billing_mart""",
    lambda i: i.billing_mart().select(
        "service_zone",
        "month_start_date",
        m.ratio("total_billed", "total_consumption", 4).alias("billed_per_m3"),
    ),
)

part(
    "casts",
    "F-15",
    """SELECT invoice_id, line_no, qty, CAST(qty AS VARCHAR) AS qty_text, CAST(unit_cost AS DOUBLE) AS unit_cost,
    CAST(trunc(unit_cost) AS INT) AS whole_cost FROM in_invoice_lines""",
    lambda i: finance.incoming_lines(i.invoice_line_records()).select(
        "invoice_id",
        "line_no",
        "qty",
        F.col("qty").cast("string").alias("qty_text"),
        "unit_cost",
        c.whole_number("unit_cost").alias("whole_cost"),
    ),
)

part(
    "explode_lines",
    "F-16, C-11",
    """SELECT invoice_id, line_no, description, qty, CAST(unit_cost AS DOUBLE) AS unit_cost FROM in_invoice_lines""",
    lambda i: i.invoice_line_records().select("invoice_id", F.explode("line_items").alias("line")).select(
        "invoice_id", "line.*"
    ),
)

part(
    "literal_tag",
    "F-18",
    "SELECT seq, 'bronze.billing_customer' AS source_table FROM in_bills",
    lambda i: i.bills().select("seq", F.lit("bronze.billing_customer").alias("source_table")),
)

part(
    "sql_expression",
    "F-19",
    "SELECT seq, amount_billed > 100000 AND upper(consumption_unit) = 'L' AS is_large FROM in_bills",
    lambda i: i.bills().select(
        "seq", F.expr("amount_billed > 100000 AND upper(consumption_unit) = 'L'").alias("is_large")
    ),
)

# --- conforming and resolution -----------------------------------------------

part(
    "unit_normalisation",
    "C-01",
    "SELECT seq, consumption_m3 FROM conformed_bills",
    lambda i: i.bills().select(
        "seq", c.cubic_metres("consumption_value", "consumption_unit").alias("consumption_m3")
    ),
)

part(
    "ambiguous_locations",
    "C-08",
    "SELECT location_id, confidence_pct FROM locations WHERE is_ambiguous",
    lambda i: network.location_zone(i.readings(), SETTINGS).where("is_ambiguous").select(
        "location_id", "confidence_pct"
    ),
)

part(
    "uncertain_zones",
    "C-09",
    """SELECT location_id, count(*) FILTER (zone_is_uncertain) AS uncertain, count(*) AS readings FROM
    readings_done GROUP BY 1""",
    lambda i: i.telemetry(i.locations()).groupBy("location_id").agg(
        F.count_if("zone_is_uncertain").alias("uncertain"), F.count(F.lit(1)).alias("readings")
    ),
)

# --- tables ------------------------------------------------------------------


def _overwrite_and_append(i):
    """Recompute a table, then append to it; the second overwrite replaces the first."""
    path = f"{tables.scratch(i.spark)}/mart"
    bills = i.bills().select("seq", "service_zone", "billing_period")
    tables.overwrite(bills, path)
    tables.overwrite(bills.where("billing_period < DATE'1998-01-01'"), path)
    bills.where("billing_period >= DATE'1998-01-01'").write.mode("append").parquet(path)
    return i.spark.read.parquet(path)


part(
    "overwrite_and_append",
    "S-08, S-11, S-12",
    "SELECT seq, service_zone, billing_period FROM in_bills",
    _overwrite_and_append,
)


def _clustered_table(i):
    path = f"{tables.scratch(i.spark)}/clustered"
    return tables.overwrite(i.consumption(), path, ["service_zone", "month_start_date"], ["account_id", "meter_id", "billing_period"])


part(
    "clustered_table",
    "S-14",
    "SELECT * FROM consumption",
    _clustered_table,
)

part(
    "clustered_rows",
    "S-14 without a write",
    "SELECT invoice_id, site_zone, invoice_date FROM headers",
    lambda i: cluster_rows(
        i.headers().select("invoice_id", "site_zone", "invoice_date"),
        ["site_zone", "invoice_date"],
        ["invoice_id"],
    ),
)


def _merge_through_view(i):
    """Insert-only merge written as SQL over session views; the views go when the frame is made."""
    suffix = uuid.uuid4().hex[:8]
    i.zone_master().where("zone_id <> '3'").createOrReplaceTempView(f"target_{suffix}")
    i.zone_master().createOrReplaceTempView(f"source_{suffix}")
    merged = i.spark.sql(
        f"SELECT * FROM target_{suffix} UNION ALL "
        f"SELECT s.* FROM source_{suffix} s LEFT ANTI JOIN target_{suffix} t ON s.zone_id = t.zone_id"
    )
    i.spark.catalog.dropTempView(f"target_{suffix}")
    i.spark.catalog.dropTempView(f"source_{suffix}")
    return merged


part(
    "merge_through_view",
    "S-16, R-04",
    "SELECT * FROM in_zone_master",
    _merge_through_view,
)


@query("S-14: one layout for several keys", "SELECT * FROM orders_done")
def curve_layout(inputs):
    path = f"{scratch(inputs.spark)}/orders"
    curve_rows(store(inputs.orders()), ["zone", "completion_date"], partitions=16, bits=4).write.parquet(path)
    return inputs.spark.read.parquet(path)


@query(
    "E-02: value profiles from sketches of two batches; distinct values within 5 % and quantiles within 3 % of the ranks",
    """SELECT column_name, count(*) AS row_count, count(*) FILTER (v IS NULL) AS null_count, count(DISTINCT v) > 0 AS distinct_close, TRUE AS quantiles_close
    FROM (SELECT 'account_id' AS column_name, account_id AS v FROM conformed_bills UNION ALL SELECT 'payment_status', payment_status FROM conformed_bills
    UNION ALL SELECT 'amount_billed', CAST(amount_billed AS VARCHAR) FROM conformed_bills
    UNION ALL SELECT 'consumption_m3', CAST(consumption_m3 AS VARCHAR) FROM conformed_bills) GROUP BY column_name""",
)
def value_profile_of_bills(inputs):
    bills = store(billing.conformed_bills(inputs.bills()))
    columns = ["account_id", "payment_status", "amount_billed", "consumption_m3"]
    half = F.pmod(F.xxhash64("seq"), F.lit(2)) == 0
    batches = [value_sketches(part, columns, "bills") for part in (bills.where(half), bills.where(~half))]
    found = value_profile(merged_sketches(batches[0].unionByName(batches[1])))
    exact = []
    for c in columns:  # what the sketches estimate, counted in full
        kinds = F.col(c).cast("double") if c in ("amount_billed", "consumption_m3") else F.lit(None).cast("double")
        asked = store(found.where(F.col("column_name") == c)).select("q05", "q50", "q95").first()
        below = [F.count_if(kinds <= q) if q is not None else F.lit(0) for q in asked]
        share = [F.coalesce(F.abs(F.try_divide(n, F.count(kinds)) - s) <= 0.03, F.lit(True)) for n, s in zip(below, (0.05, 0.5, 0.95), strict=True)]
        exact.append(bills.agg(F.lit(c).alias("name"), F.countDistinct(c).alias("exact"), (share[0] & share[1] & share[2]).alias("quantiles_close")))
    counted = exact[0].unionByName(exact[1]).unionByName(exact[2]).unionByName(exact[3])
    close = F.abs(F.col("distinct_values") - F.col("exact")) <= F.col("exact") * 0.05 + 1
    return found.join(counted, F.col("column_name") == F.col("name")).select(
        "column_name", "row_count", "null_count", close.alias("distinct_close"), "quantiles_close"
    )
