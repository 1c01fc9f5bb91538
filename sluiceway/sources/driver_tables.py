"""Landing data derived from the driver's TPC-H-like tables.

The tables have other names than the landing files and no defects, so each text below builds one
landing input and injects defects by key. ``{orders}`` and the like stand for the tables. The texts
are plain enough for any SQL engine; the checks build on them as well.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluiceway.sources.schemas import RESCUE

SQL = {
    "dim_zone": """
SELECT CAST(n_nationkey AS STRING) AS zone_id, n_name AS zone_name, r_name AS region,
       CAST(100000 + n_nationkey * 10000 AS INT) AS population_served,
       CAST(CASE WHEN n_regionkey % 2 = 0 THEN 4 ELSE 6 END AS INT) AS sla_response_hours,
       n_nationkey <> 24 AS is_current
FROM {nation} JOIN {region} ON n_regionkey = r_regionkey""",
    "bills": """
SELECT CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE CAST(c_custkey AS STRING) END AS account_id,
       CASE WHEN o_orderkey % 89 = 0 THEN NULL ELSE CAST(o_orderkey % 2 AS STRING) END AS meter_id,
       CAST(o_orderdate AS DATE) AS billing_period, n_name AS service_zone,
       CAST(CASE WHEN o_orderkey % 83 = 0 THEN NULL WHEN o_orderkey % 47 = 0 THEN -5
            ELSE floor(o_totalprice / 40) END AS DECIMAL(18,2)) AS consumption_value,
       CASE WHEN o_orderkey % 5 = 0 THEN 'l' ELSE 'm3' END AS consumption_unit,
       CASE WHEN o_orderkey % 79 = 0 THEN NULL ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) + (o_orderkey % 97) * CAST(0.0001 AS DECIMAL(18,4)) AS DECIMAL(18,4)) END
           AS amount_billed,
       CASE WHEN o_orderkey % 113 = 0 THEN 'Disputed' WHEN o_orderstatus = 'F' THEN 'Paid' WHEN o_orderstatus = 'P' THEN 'PEND'
            ELSE 'OS' END AS payment_status,
       c_name AS customer_name, CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderpriority END AS address,
       o_orderstatus AS contact_number, o_orderkey AS seq
FROM {orders} JOIN {customer} ON o_custkey = c_custkey JOIN {nation} ON c_nationkey = n_nationkey""",
    "invoice_headers": """
SELECT CAST(o_orderkey AS STRING) AS invoice_id, CASE WHEN o_orderkey % 107 = 0 THEN NULL ELSE c_mktsegment END AS cost_center,
       CASE WHEN o_orderkey % 41 = 0 THEN NULL ELSE c_custkey END AS vendor_id,
       CASE WHEN o_orderkey % 109 = 0 THEN NULL ELSE c_name END AS vendor_name,
       CASE WHEN o_orderkey % 127 = 0 THEN '' ELSE n_name END AS site_zone,
       CASE WHEN o_orderkey % 30 = 0 THEN '' WHEN o_orderkey % 31 = 0 THEN NULL ELSE 'SGD' END AS currency,
       CASE WHEN o_orderkey % 101 = 0 THEN 'n/a' ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) END AS invoice_date,
       CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN NULL
            ELSE concat('P', substring(o_orderpriority, 1, 1)) END AS project_code
FROM {orders} JOIN {customer} ON o_custkey = c_custkey JOIN {nation} ON c_nationkey = n_nationkey""",
    "invoice_lines": """
SELECT CASE WHEN l_orderkey % 131 = 0 THEN NULL ELSE CAST(l_orderkey AS STRING) END AS invoice_id,
       CASE WHEN l_partkey % 29 = 0 AND l_linenumber = 2 THEN 0 ELSE l_linenumber END AS line_no,
       CASE WHEN l_partkey % 53 = 0 THEN NULL ELSE p_type END AS description,
       CAST(CASE WHEN l_orderkey % 61 = 0 THEN -l_quantity WHEN l_orderkey % 67 = 0 THEN NULL
            ELSE l_quantity END AS INT) AS qty,
       CAST(CASE WHEN p_partkey % 37 = 0 THEN 0 ELSE 1 END * CAST(p_retailprice AS DECIMAL(18,2)) + CASE WHEN p_partkey % 37 = 0 THEN 0 ELSE 1 END * (p_partkey % 97) * CAST(0.0001 AS DECIMAL(18,4)) AS DECIMAL(18,4)) AS unit_cost
FROM {lineitem} JOIN {part} ON l_partkey = p_partkey""",
    "works_orders": """
SELECT l_returnflag AS layout,
       CASE WHEN l_orderkey % 139 = 0 THEN NULL ELSE concat(CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING)) END AS work_order_id,
       CASE WHEN l_orderkey % 43 = 0 THEN 'NOWHERE' ELSE n_name END AS zone, CASE WHEN l_orderkey % 149 = 0 THEN NULL ELSE p_type END AS description,
       CASE WHEN l_orderkey % 103 = 0 THEN 'n/a' ELSE CAST(CAST(l_shipdate AS DATE) AS STRING) END AS completion_date,
       CASE WHEN l_orderkey % 71 = 0 THEN NULL ELSE CAST(CAST(l_extendedprice AS DECIMAL(18,2)) + l_linenumber * CAST(0.0003 AS DECIMAL(18,4)) AS DECIMAL(18,4)) END AS cost,
       concat('SGD ', CAST(CAST(CAST(l_extendedprice AS DECIMAL(18,2)) + l_linenumber * CAST(0.0003 AS DECIMAL(18,4)) AS DECIMAL(18,4)) AS STRING)) AS charge
FROM {lineitem} JOIN {part} ON l_partkey = p_partkey JOIN {supplier} ON l_suppkey = s_suppkey
     JOIN {nation} ON s_nationkey = n_nationkey""",
    "readings": """
SELECT CASE WHEN event_id % 73 = 0 THEN NULL ELSE user_id END AS sensor_id, user_id % 16 AS location_id,
       CASE WHEN event_id % 59 = 0 THEN 'bad'
            ELSE CAST(date_trunc('hour', ts - INTERVAL '24' YEAR) AS STRING) END AS reading_time,
       concat('NATION_', CAST(CASE WHEN event_id % (2 + user_id % 16) = 0 THEN event_id % 25
                              ELSE user_id % 16 END AS STRING)) AS zone,
       CASE WHEN event_type IN ('click', 'view') THEN 'pressure' ELSE 'flow' END AS reading_type,
       CASE WHEN event_type = 'error' AND event_id % 7 = 0 THEN NULL ELSE CAST(value AS DECIMAL(18,2)) END
           AS reading_value,
       event_id AS seq
FROM {events}""",
    "zone_master": """
SELECT CAST(n_nationkey AS STRING) AS zone_id, n_name AS zone_name, CAST(NULL AS STRING) AS district, r_name AS region,
       CAST(100000 + n_nationkey * 10000 AS INT) AS population_served, CAST(NULL AS STRING) AS district_manager,
       CAST(CASE WHEN n_regionkey % 2 = 0 THEN 4 ELSE 6 END AS INT) AS sla_response_hours,
       min(CAST(o_orderdate AS DATE)) AS effective_from, CAST(NULL AS DATE) AS effective_to, TRUE AS is_current
FROM {orders} JOIN {customer} ON o_custkey = c_custkey JOIN {nation} ON c_nationkey = n_nationkey
     JOIN {region} ON n_regionkey = r_regionkey
GROUP BY n_nationkey, n_name, r_name, n_regionkey""",
}

TABLES = "region nation customer supplier part orders lineitem events".split()


class DriverTables:
    """The landing inputs of one directory of driver tables; amounts are doubles, as the files declare them."""

    def __init__(self, spark: SparkSession, directory: str):
        self.spark = spark
        self.directory = directory
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.directory.rstrip('/')}/{name}.parquet")
        return self._tables[name]

    def _derive(self, name: str) -> DataFrame:
        text = SQL[name]
        derived = self.spark.sql(text, **{t: self.table(t) for t in TABLES if f"{{{t}}}" in text})
        amounts = {f.name for f in derived.schema.fields if f.dataType.typeName() == "decimal"}
        return derived.select(*[F.col(c).cast("double") if c in amounts else F.col(c) for c in derived.columns])

    def zones(self) -> DataFrame:
        return self._derive("dim_zone")

    def zone_master(self) -> DataFrame:
        """The zones that have customers, in force since their first order."""
        return self._derive("zone_master")

    def bills(self) -> DataFrame:
        return self._derive("bills").withColumn(RESCUE, F.lit(None).cast("string"))

    def readings(self) -> DataFrame:
        readings = self._derive("readings").withColumnRenamed("reading_time", "timestamp")
        return readings.withColumn(RESCUE, F.lit(None).cast("string"))

    def invoice_headers(self) -> DataFrame:
        """Invoice records without lines, the vendor nested."""
        vendor = F.struct(F.col("vendor_id").alias("id"), F.col("vendor_name").alias("name"))
        return self._derive("invoice_headers").withColumn("vendor", vendor).drop("vendor_id", "vendor_name")

    def invoice_line_records(self) -> DataFrame:
        """Invoice records that hold one line each, so that no invoice is gathered in one place."""
        item = F.struct("line_no", "description", "qty", "unit_cost")
        return self._derive("invoice_lines").select("invoice_id", F.array(item).alias("line_items"))

    def invoice_records(self) -> DataFrame:
        """Full invoice records: header, vendor, one line each; an order without lines has NULL.

        An inner join and the headers that found no line, rather than one outer join: adaptive
        execution can split an invoice with very many lines in the former only.
        """
        headers, lines = self.invoice_headers(), self.invoice_line_records()
        without = headers.join(lines.select("invoice_id").distinct(), "invoice_id", "left_anti")
        records = lines.join(headers, "invoice_id").unionByName(without, allowMissingColumns=True)
        return records.withColumn(RESCUE, F.lit(None).cast("string"))

    def nested_invoices(self) -> DataFrame:
        """One record per invoice: several lines, one, none (NULL), or an empty list (every seventh of those with lines)."""
        lines = self.invoice_line_records().select("invoice_id", F.explode("line_items").alias("item"))
        lists = lines.groupBy("invoice_id").agg(F.array_sort(F.collect_list("item")).alias("line_items"))
        emptied = F.when(F.col("invoice_id").cast("bigint") % 7 == 0, F.slice("line_items", 1, 0)).otherwise(F.col("line_items"))
        records = self.invoice_headers().join(lists.withColumn("line_items", emptied), "invoice_id", "left")
        return records.withColumn(RESCUE, F.lit(None).cast("string"))

    def works_orders(self) -> dict[str, DataFrame]:
        """The three contractors' layouts, by return flag."""
        source = self._derive("works_orders")
        headers = {
            "contractor_a": ("A", ["work_order_id", "site_location", "work_description", "date_completed", "cost_sgd"]),
            "contractor_b": ("N", ["WO_Number", "Location", "Desc", "CompletionDate", "Amount"]),
            "contractor_c": ("R", ["id", "loc_id", "notes", "completed_on", "charge"]),
        }
        plain = ["work_order_id", "zone", "description", "completion_date"]
        layouts = {}
        for name, (flag, columns) in headers.items():
            last = "charge" if name == "contractor_c" else "cost"
            rows = source.where(F.col("layout") == flag).select(*plain, last)
            layouts[name] = rows.toDF(*columns).withColumn(RESCUE, F.lit(None).cast("string"))
        return layouts
