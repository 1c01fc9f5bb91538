"""Streams: landing files written from the driver's tables, read back as streams, run to the end.

Each result equals its batch twin, which is what the SQL computes.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from sluiceway import config
from sluiceway.operators.quarantine import bad_rows, good_rows
from sluiceway.operators.rules import DROP, enforce, keep_valid, with_action
from sluiceway.plans import contractors, finance, network
from sluiceway.queries.oracle import BILL_FIELDS, INVOICE_OK, LINE_OK, PROCESSED, WORKS_OK, all_hold, all_reasons
from sluiceway.queries.registry import SETTINGS, query
from sluiceway.sources import files, schemas
from sluiceway.sources.schemas import RESCUE
from sluiceway.sources.tables import move, scratch, store
from sluiceway.sources.versions import BATCH
from sluiceway.streaming import flows
from sluiceway.streaming.gold import BillingSteps, DetailsSteps, GoldRun
from sluiceway.streaming.landing import Landing
from sluiceway.streaming.once import OnceRun
from sluiceway.streaming.silver import Silver
from sluiceway.streaming.telemetry import TelemetryRun


def landed_csv(df: DataFrame, path: str | None = None) -> str:
    path = path or f"{scratch(df.sparkSession)}/landing"
    df.write.option("header", True).mode("append").csv(path)
    return path


def write_pages(records: DataFrame, path: str, page_rows: int = 5000, compression: str = "none") -> None:
    """Write records as paged documents, one per file, at most ``page_rows`` records each; readers unpack a page by its file's ending."""
    texts = records.select(F.to_json(F.struct(*records.columns)).alias("record")).withColumn("n", F.monotonically_increasing_id())
    pages = texts.groupBy(F.expr(f"n div {page_rows}").alias("page"), F.shiftright("n", 33).alias("task"))
    bodies = pages.agg(F.concat(F.lit('{"data":['), F.concat_ws(",", F.collect_list("record")), F.lit("]}")).alias("value"))
    bodies.select("value").write.option("maxRecordsPerFile", 1).mode("append").text(path, compression=compression)


def run(stream: DataFrame, partition_by: tuple[str, ...] = ()) -> DataFrame:
    base = scratch(stream.sparkSession)
    return flows.run_available(stream, f"{base}/table", f"{base}/checkpoint", partition_by)


def landing(inputs, max_files: int = 20) -> Landing:
    """A landing of its own, two folders in scratch."""
    base = scratch(inputs.spark)
    return Landing(inputs.spark, f"{base}/landing", f"{base}/lake", max_files)


def contractor_streams(inputs) -> dict[str, DataFrame]:
    """Each contractor's layout, written as CSV with its own headers and read back as a stream."""
    return {
        name: files.csv_files(inputs.spark, landed_csv(df.drop(RESCUE)), schemas.WORKS_ORDERS[name], stream=True)
        for name, df in inputs.works_orders().items()
    }


def bill_texts(inputs) -> DataFrame:
    """Bills as they stand in files; a missing consumption is text that does not fit the number column."""
    bills = inputs.bills().select(*schemas.BILLS.names)
    return bills.withColumn("consumption_value", F.coalesce(F.col("consumption_value").cast("string"), F.lit("n/a")))


def bill_files(inputs) -> str:
    return landed_csv(bill_texts(inputs))


@query(
    "S-01, S-05, T-01, M-01, D-01",
    f"SELECT {BILL_FIELDS}, consumption_value IS NULL AS is_rescued FROM in_bills",
)
def stream_ingest_csv(inputs):
    stream = files.csv_files(inputs.spark, bill_files(inputs), schemas.BILLS, stream=True)
    landed = run(enforce(stream, config.BILL_LANDING))
    return landed.withColumn("is_rescued", F.col(RESCUE).isNotNull()).drop(RESCUE)


@query("M-32, D-03: the older variant drops rescued lines", f"SELECT {BILL_FIELDS} FROM in_bills WHERE consumption_value IS NOT NULL")
def stream_ingest_csv_drop(inputs):
    stream = files.csv_files(inputs.spark, bill_files(inputs), schemas.BILLS, stream=True)
    return run(keep_valid(stream, config.BILL_LANDING).drop(RESCUE))


@query("S-02, S-10, M-03..M-05", "SELECT * EXCLUDE (zone_id) FROM incoming_orders")
def stream_contractor_csv(inputs):
    return run(contractors.conformed_orders(contractor_streams(inputs)))


@query(
    "S-03, M-06",
    """SELECT CAST(sensor_id AS VARCHAR) AS sensor_id, CAST(location_id AS VARCHAR) AS location_id, reading_time AS "timestamp",
    zone, reading_type, CAST(reading_value AS DOUBLE) AS reading_value, CAST(NULL AS VARCHAR) AS _rescued_data FROM in_readings""",
)
def stream_jsonl(inputs):
    path = f"{scratch(inputs.spark)}/landing"
    inputs.readings().drop(RESCUE, "seq").write.json(path)
    return run(enforce(files.json_lines(inputs.spark, path, schemas.READINGS, stream=True), config.READING_LANDING))


def invoice_stream(inputs) -> DataFrame:
    path = f"{scratch(inputs.spark)}/landing"
    write_pages(inputs.invoice_records().drop(RESCUE), path, compression="gzip")
    return files.invoice_pages(inputs.spark, path, stream=True)


@query(
    "S-04, M-02, C-11",
    """SELECT h.invoice_id, CAST(h.vendor_id AS VARCHAR) AS vendor_id, h.vendor_name, h.currency, h.invoice_date, l.line_no, l.description,
    l.qty, CAST(l.unit_cost AS DOUBLE) AS unit_cost FROM in_invoice_headers h JOIN in_invoice_lines l USING (invoice_id)""",
)
def stream_paged_json(inputs):
    landed = run(invoice_stream(inputs))
    return landed.select(
        "invoice_id",
        F.col("vendor.id").alias("vendor_id"),
        F.col("vendor.name").alias("vendor_name"),
        "currency",
        "invoice_date",
        F.explode("line_items").alias("line"),
    ).select("invoice_id", "vendor_id", "vendor_name", "currency", "invoice_date", "line.*")


@query("T-03, U-06: an invoice is in as many pages as it has lines", "SELECT * REPLACE (CAST(vendor_id AS VARCHAR) AS vendor_id) FROM incoming_headers")
def stream_dedup(inputs):
    return run(flows.once_per_key(finance.flatten_headers(invoice_stream(inputs)), "invoice_id"))


@query("T-03 with lanes for hot invoices", "SELECT * REPLACE (CAST(vendor_id AS VARCHAR) AS vendor_id) FROM incoming_headers")
def stream_dedup_lanes(inputs):
    thinned = flows.once_per_key(invoice_stream(inputs), "invoice_id", [files.SOURCE_FILE, "line_items"], salts=16)
    return run(finance.flatten_headers(thinned))


@query(
    "T-03 with a watermark: readings delivered twice",
    """SELECT seq, CAST(sensor_id AS BIGINT) AS sensor_id, reading_ts, reading_type FROM parsed_readings WHERE reading_ts IS NOT NULL""",
)
def stream_dedup_watermark(inputs):
    path = f"{scratch(inputs.spark)}/landing"
    parsed = network.parsed_readings(inputs.readings()).where("reading_ts IS NOT NULL")
    once = parsed.select("seq", "sensor_id", "reading_ts", "reading_type")
    once.unionByName(once).write.parquet(path)
    stream = files.stored_files(inputs.spark, path, once.schema, stream=True)
    return run(flows.once_per_key_within(stream, "seq", "reading_ts", "2 hours"))


@query("T-02, S-09: explode and rules on a stream over a stored table", "SELECT * FROM lines")
def stream_lines(inputs):
    path = f"{scratch(inputs.spark)}/landing"
    inputs.invoice_line_records().write.parquet(path)
    return run(finance.line_items(files.stored_files(inputs.spark, path, stream=True)))


@query("T-04, J-03: all contractors", "SELECT * FROM incoming_orders")
def stream_enrich(inputs):
    return run(flows.works_orders_stream(contractor_streams(inputs), inputs.zones(), SETTINGS)).select(*contractors.ORDER, "zone_id")


@query("T-05, U-07", "SELECT * FROM orders_done")
def stream_multi_flow(inputs):
    stream = flows.works_orders_stream(contractor_streams(inputs), inputs.zones(), SETTINGS)
    return run(keep_valid(stream, with_action(config.works_rules(SETTINGS), DROP)))


@query(
    "T-06, D-11: both sides of one pass",
    f"""SELECT *, CASE WHEN {all_hold(WORKS_OK)} THEN NULL ELSE {all_reasons(WORKS_OK)} END AS _quarantine_reason,
    CASE WHEN NOT ({all_hold(WORKS_OK)}) THEN {PROCESSED} END AS _quarantined_at FROM incoming_orders""",
)
def stream_split(inputs):
    stream = flows.works_orders_stream(contractor_streams(inputs), inputs.zones(), SETTINGS)
    base = scratch(inputs.spark)
    routed = flows.split_stream(stream, config.works_rules(SETTINGS), SETTINGS, f"{base}/table", f"{base}/checkpoint")
    return good_rows(routed).unionByName(bad_rows(routed), allowMissingColumns=True)


def deliver_bronze(base: str, table: str, df: DataFrame, number: int) -> None:
    """One delivery into a bronze table, as a landing run leaves it."""
    df.write.parquet(f"{base}/bronze/{table}/_batch={number}")


def _bronze_tables(inputs) -> dict[str, DataFrame]:
    """All bronze tables as landing leaves them."""
    vendor = F.struct(F.col("vendor.id").cast("string").alias("id"), F.col("vendor.name").alias("name"))
    page = F.concat(F.lit("page"), F.pmod(F.xxhash64("line_items"), F.lit(9)))
    records = inputs.invoice_records().withColumn("vendor", vendor).withColumn(files.SOURCE_FILE, page)
    readings = files.with_row_id(inputs.readings().drop("seq").withColumns({c: F.col(c).cast("string") for c in ("sensor_id", "location_id")}))
    return {
        "billing_customer": inputs.bills(),
        "finance_invoices_raw": records,
        "sensor_readings": readings,
        **{f"works_orders_{name[-1]}": df for name, df in inputs.works_orders().items()},
    }


def stage_deliveries(df: DataFrame, path: str, conditions: list, kind: str = "parquet", **options) -> None:
    """Write a table once, the rows of each delivery into a folder of its own: ``_batch=n`` holds those of the n-th condition."""
    number = F.coalesce(*[F.when(condition, F.lit(n)) for n, condition in enumerate(conditions)])
    df.withColumn(BATCH, number).write.partitionBy(BATCH).format(kind).options(**options).save(path)


def stored_deliveries(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A staged Parquet table, with the number of the delivery of each row."""
    return spark.read.schema(StructType([*schema.fields, StructField(BATCH, IntegerType())])).parquet(path)


def _after_deliveries(inputs, run, tables: dict[str, DataFrame], splits: dict[str, list]):
    """``run`` after each delivery of bronze tables, ``splits`` giving the condition of each one's rows; returns what the last gives.

    Every table is computed and written once, in its deliveries; a delivery arrives as its folder is moved into the bronze table.
    """
    base = scratch(inputs.spark)
    with ThreadPoolExecutor(len(splits)) as pool:
        for job in [pool.submit(stage_deliveries, tables[name], f"{base}/staged/{name}", conditions) for name, conditions in splits.items()]:
            job.result()
    for number in range(len(next(iter(splits.values())))):
        for table in splits:
            if not move(inputs.spark, f"{base}/staged/{table}/{BATCH}={number}", f"{base}/bronze/{table}/{BATCH}={number}"):
                deliver_bronze(base, table, inputs.spark.createDataFrame([], tables[table].schema), number)  # it has no rows
        result = run(base)
    return result


def _thirds(column: str) -> list:
    """Three deliveries by a hash, so that rows of any key and month are spread over all of them."""
    return [F.pmod(F.xxhash64(column), F.lit(3)) == n for n in range(3)]


def _silver_after_two_deliveries(inputs, run, lines_only: bool = False) -> list:
    """``run`` after each of two deliveries of all bronze tables; returns what the second gives."""
    tables = {n: df for n, df in _bronze_tables(inputs).items() if n != "billing_customer"}
    if lines_only:  # with those that name no invoice
        tables["finance_invoices_raw"] = inputs.invoice_line_records()
    keys = {name: "timestamp" if name == "sensor_readings" else df.columns[0] for name, df in tables.items()}
    half = {name: F.pmod(F.xxhash64(key), F.lit(2)) == 0 for name, key in keys.items()}
    return _after_deliveries(inputs, run, tables, {name: [test, ~test] for name, test in half.items()})


AS_TEXT = "* REPLACE (CAST(vendor_id AS VARCHAR) AS vendor_id)"


@query("T-01, T-03, T-05, M-12, M-13: headers appended in two runs", f"""SELECT {AS_TEXT}, CASE WHEN {all_hold(INVOICE_OK)} THEN NULL
    ELSE {all_reasons(INVOICE_OK)} END AS _quarantine_reason FROM incoming_headers""")
def incremental_invoices(inputs):
    good, bad = _silver_after_two_deliveries(inputs, lambda base: Silver(inputs.spark, base, SETTINGS).invoices())
    return good.unionByName(bad.drop("_quarantined_at"), allowMissingColumns=True).withColumn("vendor_id", F.col("vendor_id").cast("string"))


@query("T-02, M-15, M-16: lines appended in two runs", f"""SELECT *, CASE WHEN {all_hold(LINE_OK)} THEN NULL
    ELSE {all_reasons(LINE_OK)} END AS _quarantine_reason FROM incoming_lines""")
def incremental_lines(inputs):
    good, bad = _silver_after_two_deliveries(inputs, lambda base: Silver(inputs.spark, base, SETTINGS).lines(), lines_only=True)
    return good.unionByName(bad.drop("_quarantined_at"), allowMissingColumns=True)


@query("T-04..T-06, M-17, M-18: works orders appended in two runs", f"""SELECT *, CASE WHEN {all_hold(WORKS_OK)} THEN NULL
    ELSE {all_reasons(WORKS_OK)} END AS _quarantine_reason FROM incoming_orders""")
def incremental_orders(inputs):
    good, bad = _silver_after_two_deliveries(inputs, lambda base: Silver(inputs.spark, base, SETTINGS).works_orders(inputs.zones()))
    return good.unionByName(bad.drop("_quarantined_at"), allowMissingColumns=True)


def _telemetry(inputs, base: str) -> TelemetryRun:
    run = TelemetryRun(inputs.spark, base, SETTINGS, months="yyyy", days="yyyy-MM", buckets=2)
    run.run()
    return run


def _telemetry_after_three(inputs) -> TelemetryRun:
    """Each delivery holds readings of all instants, so later ones take the place of first readings of earlier ones."""
    tables = {"sensor_readings": _bronze_tables(inputs)["sensor_readings"]}
    return _after_deliveries(inputs, lambda base: _telemetry(inputs, base), tables, {"sensor_readings": _thirds("_row_id")})


@query("C-07, T-07, M-19: vote counts merged over three runs, no reading read again", "SELECT * REPLACE (CAST(location_id AS VARCHAR) AS location_id) FROM locations")
def stream_location_votes(inputs):
    return _telemetry_after_three(inputs).locations()


@query("T-07, M-29, S-11: the health mart by the months that three runs touch", "SELECT * FROM network_mart")
def telemetry_run(inputs):
    return _telemetry_after_three(inputs).diagnostic.read()


@query(
    "W-03, M-20: duplicates flagged in three runs that read no earlier reading",
    """SELECT CAST(sensor_id AS VARCHAR) AS sensor_id, CAST(location_id AS VARCHAR) AS location_id, reading_ts, month_start_date, reading_type,
    reading_value, is_duplicate, zone_is_uncertain FROM readings_done""",
)
def telemetry_flags_in_steps(inputs):
    run = _telemetry_after_three(inputs)
    return run.readings(store(run.locations()))


@query("M-08, R-02: history grown by three deliveries out of order", "SELECT * FROM pii_history")
def pii_in_steps(inputs):
    def run(base: str) -> DetailsSteps:
        steps = DetailsSteps(inputs.spark, base, SETTINGS, buckets=4)
        steps.run()
        return steps

    table = {"billing_customer": inputs.bills()}
    return _after_deliveries(inputs, run, table, {"billing_customer": _thirds("seq")}).customer_pii()


@query(
    "T-03: copies that come deliveries later, with neither an event time nor a state that grows",
    "SELECT * REPLACE (CAST(vendor_id AS VARCHAR) AS vendor_id) FROM incoming_headers",
)
def stream_dedup_in_steps(inputs):
    records = _bronze_tables(inputs)["finance_invoices_raw"]

    def run(base: str) -> DataFrame:
        once = OnceRun(inputs.spark, base, SETTINGS, "headers", "invoice_id", finance.HEADER, fold_every=2, buckets=4, bucket_keys=2000)
        return once.run(finance.flatten_headers(once.bronze("finance_invoices_raw", records.schema)))

    # An invoice is in as many records as it has lines, and those are in any of four deliveries.
    quarters = [F.pmod(F.xxhash64("line_items"), F.lit(4)) == n for n in range(4)]
    return _after_deliveries(inputs, run, {"finance_invoices_raw": records}, {"finance_invoices_raw": quarters})


def _billing_after_two(inputs) -> BillingSteps:
    def run(base: str) -> BillingSteps:
        steps = BillingSteps(inputs.spark, base, SETTINGS, months="yyyy", buckets=2)
        steps.run()
        return steps

    half = F.pmod(F.xxhash64("seq"), F.lit(2)) == 0
    return _after_deliveries(inputs, run, {"billing_customer": inputs.bills()}, {"billing_customer": [half, ~half]})


@query("T-07, S-11, A-06, M-23: the billing mart by the months that two runs touch, late first bills among them", "SELECT * FROM billing_mart")
def billing_in_steps(inputs):
    return _billing_after_two(inputs).mart.read()


@query(
    "A-06: distinct accounts per zone and year, from the bitmaps of zones and months",
    """SELECT service_zone, CAST(year(month_start_date) AS INTEGER) AS year, count(DISTINCT account_id) AS accounts FROM consumption GROUP BY ALL""",
)
def accounts_by_year(inputs):
    return _billing_after_two(inputs).accounts([F.col("service_zone"), F.year("month_start_date").alias("year")], "accounts")


def _gold_after_two(inputs) -> GoldRun:
    def run(base: str) -> GoldRun:
        silver = Silver(inputs.spark, base, SETTINGS)
        silver.invoices(), silver.lines(), silver.works_orders(inputs.zones())
        gold = GoldRun(inputs.spark, base, SETTINGS, months="yyyy", days="yyyy", buckets=2)
        gold.run()
        return gold

    tables = _bronze_tables(inputs)
    keys = {"billing_customer": "seq", "finance_invoices_raw": "line_items", "sensor_readings": "_row_id"}
    half = {name: F.pmod(F.xxhash64(keys.get(name, df.columns[0])), F.lit(2)) == 0 for name, df in tables.items()}
    return _after_deliveries(inputs, run, tables, {name: [test, ~test] for name, test in half.items()})


@query("T-07, S-09, S-11, M-30: from appended rows to the scorecard, in two runs", "SELECT * FROM scorecard")
def scorecard_in_steps(inputs):
    return _gold_after_two(inputs).scorecard(store(inputs.zones()))


def _halves(df: DataFrame, by: str) -> tuple[DataFrame, DataFrame]:
    half = F.pmod(F.xxhash64(by), F.lit(2)) == 0
    return df.where(half), df.where(~half)


@query(
    "S-01, S-07, M-01: files whose columns stand in another order",
    f"SELECT {BILL_FIELDS}, consumption_value IS NULL AS is_rescued FROM in_bills",
)
def stream_reordered_csv(inputs):
    run = landing(inputs, max_files=8)
    first, second = _halves(bill_texts(inputs), "customer_name")
    for part in (first, second.select(*reversed(schemas.BILLS.names))):
        landed_csv(part, f"{run.landing}/billing_customer")
    return run.bills().withColumn("is_rescued", F.col(RESCUE).isNotNull()).drop(RESCUE)


@query(
    "S-07, M-03..M-05: a column is added in the middle, its text kept as it is",
    """SELECT work_order_id, zone AS site_location, description AS work_description, completion_date AS date_completed,
    CAST(cost AS DOUBLE) AS cost_sgd, CASE WHEN description LIKE '%BRASS' THEN '00' || length(description) END AS crew
    FROM in_works_orders WHERE layout = 'A'""",
)
def stream_added_column(inputs):
    run = landing(inputs)
    orders = inputs.works_orders()["contractor_a"].drop(RESCUE)
    brass = F.coalesce(F.col("work_description").like("%BRASS"), F.lit(False))
    crew = F.concat(F.lit("00"), F.length("work_description")).alias("crew")
    landed_csv(orders.where(~brass), f"{run.landing}/contractor_a")
    landed_csv(orders.where(brass).select("work_order_id", crew, *orders.columns[1:]), f"{run.landing}/contractor_a")
    landed = run.csv("works_orders_a", schemas.WORKS_ORDERS["contractor_a"], config.WORKS_LANDING["contractor_a"])
    return landed.drop(RESCUE)


@query(
    "S-05, S-06, S-07, M-03: undeclared columns come as whole numbers, then decimals, then text, and keep every value",
    """SELECT work_order_id, CAST(cost AS DOUBLE) AS cost_sgd, size / CASE WHEN part = 1 THEN 4.0 ELSE 1.0 END AS crew,
    CASE part WHEN 0 THEN CAST(size AS VARCHAR) WHEN 1 THEN rtrim(rtrim(CAST(CAST(size / 4.0 AS DECIMAL(18, 2)) AS VARCHAR), '0'), '.')
    ELSE 'G-' || size END AS grade
    FROM (SELECT *, length(description) AS size, coalesce(length(description) % 3, 2) AS part FROM in_works_orders WHERE layout = 'A')""",
)
def stream_widened_column(inputs):
    run = landing(inputs)
    orders = inputs.works_orders()["contractor_a"].drop(RESCUE)
    size = F.length("work_description")
    part = F.coalesce(F.pmod(size, F.lit(3)), F.lit(2))
    quarter = (size / 4).cast("decimal(18,2)").cast("string")
    grades = [size.cast("string"), quarter, F.concat(F.lit("G-"), size.cast("string"))]
    hints = schemas.struct(work_order_id=schemas.TEXT, cost_sgd=schemas.NUMBER)
    for number, grade in enumerate(grades):
        crew = quarter if number == 1 else size.cast("string")
        delivery = orders.where(part == number).select("work_order_id", crew.alias("crew"), "cost_sgd", grade.alias("grade"))
        landed_csv(delivery, f"{run.landing}/contractor_a")
        landed = run.widened_csv("works_orders_a", hints, config.WORKS_LANDING["contractor_a"][:3])
    return landed.select("work_order_id", "cost_sgd", F.col("crew").cast("double").alias("crew"), "grade")


@query(
    "S-03, S-05, M-06: fields that are not declared go to rescue",
    """SELECT CAST(sensor_id AS VARCHAR) AS sensor_id, CAST(location_id AS VARCHAR) AS location_id, reading_time AS "timestamp",
    zone, reading_type, CAST(reading_value AS DOUBLE) AS reading_value,
    CASE WHEN reading_type = 'flow' THEN '{"firmware":"00' || location_id || '"}' END AS _rescued_data FROM in_readings""",
)
def stream_json_unknown_field(inputs):
    run = landing(inputs)
    firmware = F.when(F.col("reading_type") == "flow", F.concat(F.lit("00"), F.col("location_id").cast("string")))
    inputs.readings().drop(RESCUE, "seq").withColumn("firmware", firmware).write.json(f"{run.landing}/network_telemetry")
    return run.readings().drop("_row_id")


LANDED = {
    "bronze.billing_customer": ("in_bills", {"no_rescued_data": "consumption_value IS NOT NULL"}),
    "bronze.finance_invoices_raw": (
        "(SELECT h.*, l.invoice_id IS NOT NULL AS has_line FROM in_invoice_headers h LEFT JOIN in_invoice_lines l USING (invoice_id))",
        {
            "no_rescued_data": "TRUE", "valid_invoice_id": "invoice_id IS NOT NULL", "valid_currency": "currency <> ''",
            "valid_vendor": "TRUE", "has_line_items": "has_line",
        },
    ),
    "bronze.sensor_readings": ("in_readings", {"no_rescued_data": "reading_type <> 'flow'"}),
    **{
        f"bronze.works_orders_{letter}": (
            f"(SELECT * FROM in_works_orders WHERE layout = '{flag}')",
            {
                "no_rescued_data": "TRUE", names[0]: "work_order_id IS NOT NULL", names[1]: money,
                "valid_date": "completion_date IS NOT NULL", "valid_location": "zone IS NOT NULL",
            },
        )
        for letter, flag, names, money in (
            ("a", "A", ("valid_work_order_id", "valid_cost"), "cost > 0"),
            ("b", "N", ("valid_wo_number", "valid_amount"), "cost > 0"),
            ("c", "R", ("valid_id", "valid_charge_format"), "charge LIKE 'SGD %'"),
        )
    },
}


@query(
    "D-01, D-02, M-01..M-06: what the landing rules count, over all micro-batches of two deliveries",
    " UNION ALL ".join(
        f"SELECT '{dataset}' AS dataset, '{rule}' AS rule, 'warn' AS action, count(*) FILTER ({ok}) AS passed, "
        f"count(*) FILTER (({ok}) IS NOT TRUE) AS failed FROM {source}"
        for dataset, (source, cases) in LANDED.items()
        for rule, ok in cases.items()
    ),
)
def landing_rule_counts(inputs):
    spark, base = inputs.spark, scratch(inputs.spark)
    run = landing(inputs, max_files=8)
    firmware = F.when(F.col("reading_type") == "flow", F.lit("1"))
    records = inputs.invoice_records().drop(RESCUE)
    readings = inputs.readings().drop(RESCUE, "seq").withColumn("firmware", firmware)
    texts = {"billing_customer": (bill_texts(inputs), "customer_name")}
    texts |= {name: (df.drop(RESCUE), df.columns[0]) for name, df in inputs.works_orders().items()}

    def stage(folder: str, df: DataFrame, by: str, *kind: str, **options) -> None:
        half = F.pmod(F.xxhash64(by), F.lit(2)) == 0
        stage_deliveries(df, f"{base}/{folder}", [half, ~half], *kind, **options)

    def stage_pages(number: int) -> None:
        rows = stored_deliveries(spark, f"{base}/records", records.schema).where(F.col(BATCH) == number).drop(BATCH)
        write_pages(rows, f"{base}/finance_erp/{BATCH}={number}", compression="gzip")

    def arrive(folder: str, number: int) -> None:
        if not move(spark, f"{base}/{folder}/{BATCH}={number}", f"{run.landing}/{folder}/delivery-{number}"):  # it has no rows
            nothing = spark.createDataFrame([], texts[folder][0].schema if folder in texts else readings.schema)
            landed_csv(nothing, f"{run.landing}/{folder}") if folder in texts else nothing.write.mode("append").json(f"{run.landing}/{folder}")

    # Every source is computed once; the second delivery's pages are written while the first delivery lands.
    with ThreadPoolExecutor(len(texts) + 2) as pool:
        staged = [pool.submit(stage, name, df, by, "csv", header=True) for name, (df, by) in texts.items()]
        staged.append(pool.submit(stage, "network_telemetry", readings, "timestamp", "json"))
        stage("records", records, "invoice_id")
        pages = [pool.submit(stage_pages, number) for number in (0, 1)]
        for job in staged:
            job.result()
        for number in (0, 1):
            pages[number].result()
            for folder in (*texts, "network_telemetry", "finance_erp"):
                arrive(folder, number)
            run.all()
    return run.rule_counts().groupBy("dataset", "rule", "action").agg(F.sum("passed").alias("passed"), F.sum("failed").alias("failed"))


@query(
    "S-06, S-07: a second delivery lacks one column and brings another",
    """SELECT account_id, CASE WHEN contact_number = 'F' THEN meter_id END AS meter_id, billing_period, service_zone,
    CASE WHEN contact_number <> 'F' THEN customer_name END AS channel FROM in_bills""",
)
def schema_drift(inputs):
    bills = inputs.bills().select("account_id", "meter_id", "billing_period", "service_zone", "customer_name", "contact_number")
    first = bills.where("contact_number = 'F'").select("account_id", "meter_id", "billing_period", "service_zone")
    second = bills.where("contact_number <> 'F'").select(
        "account_id", "billing_period", "service_zone", F.col("customer_name").alias("channel")
    )
    return files.csv_deliveries(inputs.spark, [landed_csv(first), landed_csv(second)], schemas.BILLS).drop(RESCUE)


@query(
    "S-06: types inferred from the files, two of them forced",
    """SELECT account_id, CAST(meter_id AS INT) AS meter_id, billing_period, consumption_unit,
    CAST(amount_billed AS DOUBLE) AS amount_billed, payment_status FROM in_bills""",
)
def schema_hints(inputs):
    columns = ["account_id", "meter_id", "billing_period", "consumption_unit", "amount_billed", "payment_status"]
    path = landed_csv(inputs.bills().select(*columns))
    schema = files.infer_with_hints(inputs.spark, path, "account_id STRING, billing_period DATE")
    return files.csv_files(inputs.spark, path, schema).drop(RESCUE)
