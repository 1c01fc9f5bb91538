"""Customer bills: conformed consumption, quarantine, PII history, the zone-by-month mart."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluiceway import config
from sluiceway.config import Settings
from sluiceway.functions import conforming as c
from sluiceway.functions.masking import tag_columns
from sluiceway.functions.measures import percent, total
from sluiceway.operators import history
from sluiceway.operators.dedup import flag_duplicates, keep_first
from sluiceway.operators.quarantine import FIRST, quarantine
from sluiceway.operators.rules import all_pass, dq_metrics, enforce, fail_on_violation, flag_known, keep_valid, with_action

KEY_MONTH = ["account_id", "meter_id", "month_start_date"]
FACTS = [
    "account_id", "meter_id", "billing_period", "month_start_date",
    "service_zone", "consumption_m3", "amount_billed", "payment_status",
]
# Every column that reaches the output ends the order, so ties are equal rows.
FIRST_BILL = ["billing_period", "amount_billed", "consumption_m3", "consumption_value", "payment_status", "service_zone"]


def conformed_bills(bronze: DataFrame) -> DataFrame:
    """Month, cubic metres, numeric amount and one status code list, in one projection."""
    return bronze.withColumns(
        {
            "month_start_date": c.month_start("billing_period"),
            "consumption_m3": c.cubic_metres("consumption_value", "consumption_unit"),
            "amount_billed": c.number("amount_billed"),
            "payment_status": c.payment_status("payment_status"),
        }
    )


def billing_consumption(bronze: DataFrame, valid_first: bool = False) -> DataFrame:
    """One bill per account, meter and month.

    By default the first bill is picked before the rules apply: an invalid first bill takes a
    later valid one down with it. ``valid_first`` picks among valid bills only. Rows without a key
    are dropped by the rules in either case, so they go before the shuffle.
    """
    bills = conformed_bills(bronze)
    if valid_first:
        bills = keep_valid(bills, config.BILL_HARD)
    keyed = bills.where("account_id IS NOT NULL AND meter_id IS NOT NULL")
    return keep_valid(keep_first(keyed, KEY_MONTH, FIRST_BILL), config.BILL_HARD).select(*FACTS)


def billing_consumption_output_rules(bronze: DataFrame) -> DataFrame:
    """The older variant: the drop rules look at the conformed columns."""
    keyed = conformed_bills(bronze).where("account_id IS NOT NULL AND meter_id IS NOT NULL")
    return enforce(keep_first(keyed, KEY_MONTH, FIRST_BILL).select(*FACTS), config.BILL_HARD_OUTPUT)


def billing_quarantine(bronze: DataFrame, settings: Settings, source: str = "bronze.billing_customer") -> DataFrame:
    return quarantine(bronze, config.BILL_HARD, settings.processed_at, FIRST, source)


def superseded_bills(bronze: DataFrame, settings: Settings, row_id: str | None = None) -> DataFrame:
    """Valid bills that lost to an earlier bill of the same key and month; no other output lists them."""
    keyed = conformed_bills(bronze).where("account_id IS NOT NULL AND meter_id IS NOT NULL")
    spread = [*FIRST_BILL, *([row_id] if row_id else [])]
    flagged = flag_duplicates(keyed, KEY_MONTH, FIRST_BILL, spread, settings.lanes, "superseded")
    return flagged.where(F.col("superseded") & all_pass(config.BILL_HARD)).select(*FACTS)


def billing_dq(consumption: DataFrame, zones: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Soft checks beside the data; a zone is known if it is current in the zone master."""
    flagged = flag_known(consumption, "service_zone", history.current(zones), "zone_name")
    return dq_metrics(flagged, config.BILL_SOFT, "billing_consumption", by)


def customer_pii(bronze: DataFrame, null_safe: bool = True) -> DataFrame:
    """Dated versions of the three PII columns per account, tagged for masking.

    A bill without an account would break a fail rule and halt the run, so such bills are left to
    the quarantine.
    """
    rows = bronze.where("account_id IS NOT NULL").withColumn("contact_number", F.col("contact_number").cast("string"))
    history_rows = history.versions(rows, "account_id", "billing_period", config.PII_COLUMNS, null_safe)
    checked = fail_on_violation(history_rows, with_action(config.PII_VERSION, "fail"))
    return tag_columns(checked, config.PII_COLUMNS, config.PII_TAGS)


def customer_pii_latest(bronze: DataFrame) -> DataFrame:
    """The older variant: the newest details per account, no history."""
    rows = bronze.where("account_id IS NOT NULL").withColumn("contact_number", F.col("contact_number").cast("string"))
    return history.latest_version(rows, "account_id", "billing_period", config.PII_COLUMNS)


def billing_by_zone_month(consumption: DataFrame) -> DataFrame:
    """Consumption, amount billed, accounts, and overdue bills per account in percent.

    Bills are set against distinct accounts, so the rate can pass 100.
    """
    mart = (
        consumption.groupBy("service_zone", "month_start_date")
        .agg(
            total("consumption_m3").alias("total_consumption"),
            total("amount_billed").alias("total_billed"),
            F.countDistinct("account_id").alias("total_accounts"),
            F.count_if(F.col("payment_status") == "overdue").alias("overdue_count"),
        )
        .withColumn("overdue_rate_pct", percent("overdue_count", "total_accounts"))
    )
    return enforce(mart, config.BILLING_MART)


def mart_of_parts(parts: DataFrame, accounts: DataFrame) -> DataFrame:
    """The same mart from sums per zone and month, and from counts of distinct accounts (``total_accounts``) beside them."""
    zone, month = F.col("service_zone").eqNullSafe(F.col("_zone")), F.col("month_start_date").eqNullSafe(F.col("_month"))
    counted = accounts.select(F.col("service_zone").alias("_zone"), F.col("month_start_date").alias("_month"), "total_accounts")
    mart = parts.join(counted, zone & month, "left").select(
        "service_zone",
        "month_start_date",
        F.col("consumption").cast("double").alias("total_consumption"),
        F.col("billed").cast("double").alias("total_billed"),
        F.coalesce("total_accounts", F.lit(0)).alias("total_accounts"),
        F.col("overdue").alias("overdue_count"),
    )
    return enforce(mart.withColumn("overdue_rate_pct", percent("overdue_count", "total_accounts")), config.BILLING_MART)
