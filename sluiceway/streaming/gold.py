"""Gold in steps: bills, invoices and works orders into their marts, each run by the months its new rows touch.

Sums and counts are kept as decimals per zone and month and added to; only the months that a run's rows fall into are read and written.
What cannot be added to is kept beside them: the first bill of each key and month, which a late bill may replace, and lines whose invoice
has not come yet.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluiceway import config
from sluiceway.config import Settings
from sluiceway.functions import conforming as c
from sluiceway.functions.masking import tag_columns
from sluiceway.functions.measures import WIDE
from sluiceway.operators import history
from sluiceway.operators.distinct import bitmaps, distinct_count, merged, number_keys
from sluiceway.operators.rules import all_pass, enforce, fail_on_violation, with_action
from sluiceway.plans import billing
from sluiceway.plans.scorecard import Marts, zone_performance
from sluiceway.sources import schemas
from sluiceway.sources.parted import PART, bucket, touched_parts
from sluiceway.streaming.steps import Steps, add_sums
from sluiceway.streaming.telemetry import TelemetryRun

_SUM = "decimal(38,6)"


def _sum(value: Column | str, name: str) -> Column:
    return F.coalesce(F.sum(c.col(value).cast(WIDE)), F.lit(0)).cast(_SUM).alias(name)


class BillingSteps(Steps):
    """Bills from bronze: the first bill of each account, meter and month, the billing mart, and mergeable counts of accounts.

    A run reads the first bills of the months it touches, as far as they share a hash bucket with its bills. A new key adds to the month's sums
    and or-s its account's number into the bitmap of zone and month; where a late bill takes an earlier one's place, that one is taken off the
    sums and the month's bitmaps are built anew from its first bills.
    """

    def __init__(self, spark: SparkSession, base: str, settings: Settings, max_files: int = 1000, months: str = "yyyy-MM", buckets: int = 16):
        super().__init__(spark, base, settings, max_files, months)
        self.buckets = buckets
        kinds = {"billing_period": "date", "amount_billed": "double", "consumption_m3": "double", "consumption_value": "double"}
        self.best = f"struct<{', '.join(f'{n}: {kinds.get(n, "string")}' for n in billing.FIRST_BILL)}>"
        self.first = self.table("first_bills", f"account_id string, meter_id string, month_start_date date, best {self.best}")
        self.numbers = self.table("account_numbers", "account_id string, number bigint")
        self.pieces = self.table("account_bitmaps", "service_zone string, month_start_date date, piece bigint, bitmap binary")
        self.sums = self.table(
            "billing_sums", f"service_zone string, month_start_date date, consumption {_SUM}, billed {_SUM}, overdue bigint, bills bigint"
        )
        self.mart = self.table(
            "billing_by_zone_month",
            "service_zone string, month_start_date date, total_consumption double, total_billed double, total_accounts bigint, "
            "overdue_count bigint, overdue_rate_pct double",
        )

    @staticmethod
    def _valid(keyed: DataFrame, bill: str) -> DataFrame:
        """The bills that count, as published."""
        flat = keyed.select(PART, *billing.KEY_MONTH, f"{bill}.*")
        return flat.where(all_pass(config.BILL_HARD))

    def _take(self, batch: DataFrame, number: int) -> None:
        month = self.part("month_start_date")
        part = F.concat(month, F.lit("."), bucket(billing.KEY_MONTH, self.buckets))
        bills = billing.conformed_bills(batch).where("account_id IS NOT NULL AND meter_id IS NOT NULL")
        arrived = self.kept(bills.groupBy(*billing.KEY_MONTH).agg(F.min(F.struct(*billing.FIRST_BILL)).alias("best")).withColumn(PART, part))
        touched = touched_parts(arrived)
        before = self.first.read(touched, before=number).withColumn(PART, part).withColumn("held", F.col("best"))
        both = before.unionByName(arrived.withColumn("held", F.lit(None).cast(self.best)))
        firsts = self.kept(both.groupBy(PART, *billing.KEY_MONTH).agg(F.min("best").alias("best"), F.max("held").alias("held")))
        self.first.replace(firsts, touched, number)
        changed = firsts.withColumn(PART, month).where(~F.col("best").eqNullSafe(F.col("held")))
        on, off = self._valid(changed, "best"), self._valid(changed.where("held IS NOT NULL"), "held")
        signed = on.withColumn("sign", F.lit(1)).unionByName(off.withColumn("sign", F.lit(-1)))
        delta = signed.groupBy("service_zone", "month_start_date").agg(
            _sum(F.col("consumption_m3").cast(WIDE) * F.col("sign"), "consumption"),
            _sum(F.col("amount_billed").cast(WIDE) * F.col("sign"), "billed"),
            F.sum(F.when(F.col("payment_status") == "overdue", F.col("sign")).otherwise(0)).alias("overdue"),
            F.sum("sign").alias("bills"),
        )
        months = add_sums(
            self.sums, self.kept(delta), month, ["service_zone", "month_start_date"], ["consumption", "billed", "overdue", "bills"], number
        )
        self._count_accounts(on, touched_parts(off), number)
        counted = distinct_count(self.pieces.read(months), ["service_zone", "month_start_date"], "total_accounts")
        mart = billing.mart_of_parts(self.sums.read(months), counted)
        self.mart.replace(mart.withColumn(PART, month), months, number)

    def _count_accounts(self, new: DataFrame, taken: list[str], number: int) -> None:
        """Or new bills into the bitmaps; months in which a bill was ``taken`` off are counted anew."""
        group = [PART, "service_zone", "month_start_date"]
        whole = [p for p in self.first.parts() if p.partition(".")[0] in taken]
        again = self.first.read(whole).withColumn(PART, self.part("month_start_date")) if taken else None
        counted = new.where(~F.col(PART).isin(taken))
        counted = counted if again is None else counted.unionByName(self._valid(again, "best"))
        rows = self.kept(counted.select(*group, "account_id").distinct())
        numbers = number_keys(self.numbers, rows, "account_id", self.buckets, number).withColumnRenamed("account_id", "_numbered")
        touched = sorted({*touched_parts(rows), *taken})
        added = bitmaps(rows.join(numbers, F.col("account_id") == F.col("_numbered")), group)
        held = self.pieces.read([p for p in touched if p not in taken], before=number).withColumn(PART, self.part("month_start_date"))
        self.pieces.replace(merged(held.select(*group, "piece", "bitmap").unionByName(added), group), touched, number)

    def run(self) -> None:
        self.take(self.bronze("billing_customer", schemas.BILLS), "steps_billing", self._take)

    def accounts(self, by: list[Column], name: str = "total_accounts") -> DataFrame:
        """Distinct accounts by any grouping of zones and months, such as a zone and year, from the bitmaps alone."""
        pieces = self.pieces.read().select(*by, "piece", "bitmap")
        return distinct_count(pieces, [n for n in pieces.columns if n not in ("piece", "bitmap")], name)


class DetailsSteps(Steps):
    """The history of customer details, grown by the snapshots that arrive; deliveries may come out of order.

    A run reads and rewrites the hash buckets of the accounts it names; other accounts in them pass as they are.
    """

    def __init__(self, spark: SparkSession, base: str, settings: Settings, max_files: int = 1000, months: str = "yyyy-MM", buckets: int = 64):
        super().__init__(spark, base, settings, max_files, months)
        self.buckets = buckets
        columns = ", ".join(f"{name} string" for name in config.PII_COLUMNS)
        self.versions = self.table(
            "customer_pii", f"account_id string, {columns}, effective_from date, effective_to date, is_current boolean, days array<date>"
        )

    def _take(self, batch: DataFrame, number: int) -> None:
        rows = batch.where("account_id IS NOT NULL").withColumn("contact_number", F.col("contact_number").cast("string"))
        part = bucket(["account_id"], self.buckets)
        daily = self.kept(history.daily_rows(rows, "account_id", "billing_period", config.PII_COLUMNS))
        touched = touched_parts(daily.select(part.alias(PART)))
        known = self.versions.read(touched, before=number)
        self.versions.replace(history.merge_versions(known, daily, "account_id", config.PII_COLUMNS).withColumn(PART, part), touched, number)

    def run(self) -> None:
        self.take(self.bronze("billing_customer", schemas.BILLS), "steps_details", self._take)

    def customer_pii(self) -> DataFrame:
        """As published, checked and tagged for masking."""
        rows = self.versions.read().drop("days")
        return tag_columns(fail_on_violation(rows, with_action(config.PII_VERSION, "fail")), config.PII_COLUMNS, config.PII_TAGS)


class SpendSteps(Steps):
    """Good headers and lines from the appended tables into both spend marts.

    Lines are summed per invoice and category as they come. Those whose header is known join it at once; the others wait, as sums, until it
    comes; those of invoices that never do stay waiting. A run reads the hash buckets of the invoices it names.
    """

    def __init__(self, spark: SparkSession, base: str, settings: Settings, max_files: int = 1000, months: str = "yyyy-MM", buckets: int = 64):
        super().__init__(spark, base, settings, max_files, months)
        self.buckets = buckets
        sums = f"spend {_SUM}, lines bigint, unit_costs {_SUM}, priced bigint"
        self.headers = self.table("spend_headers", "invoice_id string, site_zone string, project_code string, invoice_date date")
        self.waiting = self.table("waiting_lines", f"invoice_id string, description string, {sums}")
        self.by_project = self.table("spend_sums", f"site_zone string, project_code string, invoice_month timestamp, spend {_SUM}, lines bigint")
        self.by_category = self.table("category_sums", f"site_zone string, description string, invoice_month timestamp, {sums}")
        self.mart = self.table(
            "spend_by_zone_month", "site_zone string, project_code string, invoice_month timestamp, total_spend double, line_item_count bigint"
        )
        self.category_mart = self.table(
            "spend_by_zone_category_month",
            "zone_id string, zone string, cost_category string, invoice_month timestamp, total_spend double, line_count bigint, avg_unit_cost double",
        )

    def _take(self, batch: DataFrame, number: int) -> None:
        part, names = bucket(["invoice_id"], self.buckets), ["spend", "lines", "unit_costs", "priced"]
        arrived = self.kept(batch)
        header = F.struct("site_zone", "project_code", "invoice_date")
        new = arrived.where("is_header").groupBy("invoice_id").agg(F.min(header).alias("h")).select("invoice_id", "h.*")
        summed = arrived.where("NOT is_header").groupBy("invoice_id", "description").agg(
            _sum("line_total", "spend"), F.count(F.lit(1)).alias("lines"), _sum("unit_cost", "unit_costs"), F.count("unit_cost").alias("priced")
        )
        touched = touched_parts(arrived.select(part.alias(PART)))
        known = self.headers.read(touched, before=number)
        fresh = new.join(known.select(F.col("invoice_id").alias("_known")), F.col("invoice_id") == F.col("_known"), "left_anti")
        headers = self.kept(known.unionByName(fresh))
        self.headers.replace(headers.withColumn(PART, part), touched, number)
        lines = self.waiting.read(touched, before=number).unionByName(summed).groupBy("invoice_id", "description")
        lines = self.kept(lines.agg(*[F.sum(n).cast(t).alias(n) for n, t in zip(names, (_SUM, "bigint", _SUM, "bigint"), strict=True)]))
        still = lines.join(headers.select(F.col("invoice_id").alias("_known")), F.col("invoice_id") == F.col("_known"), "left_anti")
        self.waiting.replace(still.withColumn(PART, part), touched, number)
        month = c.month_instant("invoice_date").alias("invoice_month")
        joined = self.kept(lines.join(headers, "invoice_id").select("site_zone", c.named_bucket("project_code").alias("project_code"), "description", month, *names))
        when, both = self.part("invoice_month"), [F.sum(n).alias(n) for n in names]
        keys = ["site_zone", "project_code", "invoice_month"]
        months = add_sums(self.by_project, joined.groupBy(*keys).agg(*both[:2]), when, keys, names[:2], number)
        keys = ["site_zone", "description", "invoice_month"]
        add_sums(self.by_category, joined.groupBy(*keys).agg(*both), when, keys, names, number)
        spend = F.col("spend").cast("double").alias("total_spend")
        mart = self.by_project.read(months).select("site_zone", "project_code", "invoice_month", spend, F.col("lines").alias("line_item_count"))
        self.mart.replace(enforce(mart, config.SPEND_MART).withColumn(PART, when), months, number)
        code = c.code_in_name("site_zone", self.settings.zone_code_start, self.settings.zone_code_length).alias("zone_id")
        category = self.by_category.read(months).select(
            code, F.col("site_zone").alias("zone"), F.col("description").alias("cost_category"), "invoice_month", spend,
            F.col("lines").alias("line_count"), F.try_divide(F.col("unit_costs").cast("double"), F.col("priced")).alias("avg_unit_cost"),
        )
        self.category_mart.replace(enforce(category, config.CATEGORY_MART).withColumn(PART, when), months, number)

    def run(self) -> None:
        header = self.appended("finance_invoices", "invoice_id string, site_zone string, project_code string, invoice_date date")
        line = self.appended("invoice_line_items", "invoice_id string, description string, unit_cost double, line_total double")
        headers, lines = header.withColumn("is_header", F.lit(True)), line.withColumn("is_header", F.lit(False))
        self.take(headers.unionByName(lines, allowMissingColumns=True), "steps_spend", self._take)


class OrderSteps(Steps):
    """Good works orders from the appended table into both contractor marts."""

    def __init__(self, spark: SparkSession, base: str, settings: Settings, max_files: int = 1000, months: str = "yyyy-MM"):
        super().__init__(spark, base, settings, max_files, months)
        self.by_contractor = self.table(
            "contractor_sums", f"zone string, contractor_source string, completion_month timestamp, cost {_SUM}, orders bigint"
        )
        self.by_type = self.table(
            "work_type_sums", f"zone_id string, zone string, work_type string, completion_month timestamp, cost {_SUM}, orders bigint"
        )
        self.mart = self.table(
            "contractor_by_zone_month",
            "zone string, contractor_source string, completion_month timestamp, work_order_count bigint, total_cost double",
        )
        self.type_mart = self.table(
            "works_by_zone_type_month",
            "zone_id string, zone string, work_type string, completion_month timestamp, order_count bigint, total_cost double, avg_cost double",
        )

    def _take(self, batch: DataFrame, number: int) -> None:
        month, when = c.month_instant("completion_date").alias("completion_month"), self.part("completion_month")
        arrived = self.kept(
            batch.groupBy("zone_id", "zone", F.col("description").alias("work_type"), "contractor_source", month).agg(
                _sum("cost", "cost"), F.count(F.lit(1)).alias("orders")
            )
        )
        sums, both = ["cost", "orders"], [F.sum("cost").alias("cost"), F.sum("orders").alias("orders")]
        keys = ["zone", "contractor_source", "completion_month"]
        months = add_sums(self.by_contractor, arrived.groupBy(*keys).agg(*both), when, keys, sums, number)
        keys = ["zone_id", "zone", "work_type", "completion_month"]
        add_sums(self.by_type, arrived.groupBy(*keys).agg(*both), when, keys, sums, number)
        cost = F.col("cost").cast("double")
        mart = self.by_contractor.read(months).select(
            "zone", "contractor_source", "completion_month", F.col("orders").alias("work_order_count"), cost.alias("total_cost")
        )
        self.mart.replace(enforce(mart, config.CONTRACTOR_MART).withColumn(PART, when), months, number)
        types = self.by_type.read(months).select(
            *keys, F.col("orders").alias("order_count"), cost.alias("total_cost"), F.try_divide(cost, F.col("orders")).alias("avg_cost")
        )
        self.type_mart.replace(enforce(types, config.WORK_TYPE_MART).withColumn(PART, when), months, number)

    def run(self) -> None:
        columns = "zone_id string, zone string, description string, contractor_source string, completion_date date, cost double"
        self.take(self.appended("works_orders", columns), "steps_orders", self._take)


class GoldRun:
    """One run from new bronze and appended rows to all marts and the scorecard; ``Silver`` has run before it.

    The four domains do not read each other. ``months``, ``days`` and ``buckets`` set how fine the parts are, by default as each run has it. The scorecard has a row for each zone and month, and is built from the marts as they stand.
    """

    def __init__(
        self,
        spark: SparkSession,
        base: str,
        settings: Settings,
        max_files: int = 1000,
        months: str = "yyyy-MM",
        days: str = "yyyy-MM-dd",
        buckets: int | None = None,
    ):
        self.settings = settings
        given, sized = (spark, base, settings, max_files, months), {"buckets": buckets} if buckets else {}
        self.billing = BillingSteps(*given, **sized)
        self.spend = SpendSteps(*given, **sized)
        self.orders = OrderSteps(*given)
        self.readings = TelemetryRun(*given, days=days, **sized)

    def run(self) -> None:
        """The domains side by side: the many short jobs of one do not keep the others waiting."""
        domains = (self.billing, self.spend, self.orders, self.readings)
        with ThreadPoolExecutor(len(domains)) as pool:
            for job in [pool.submit(steps.run) for steps in domains]:
                job.result()

    def marts(self) -> dict[str, DataFrame]:
        """All seven, by their published names."""
        return {
            "billing_by_zone_month": self.billing.mart.read(),
            "spend_by_zone_month": self.spend.mart.read(),
            "spend_by_zone_category_month": self.spend.category_mart.read(),
            "contractor_by_zone_month": self.orders.mart.read(),
            "works_by_zone_type_month": self.orders.type_mart.read(),
            "network_health_by_zone_month": self.readings.health.read(),
            "network_health_diagnostic_by_zone_month": self.readings.diagnostic.read(),
        }

    def scorecard(self, zones: DataFrame) -> DataFrame:
        marts = self.marts()
        stored = Marts(
            billing=marts["billing_by_zone_month"],
            spend=marts["spend_by_zone_month"],
            contractor=marts["contractor_by_zone_month"],
            network=marts["network_health_diagnostic_by_zone_month"],
        )
        return zone_performance(zones, stored, self.settings)
