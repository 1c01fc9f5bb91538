"""PII history, masking, and the zone master."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from sluiceway import config
from sluiceway.functions.masking import masked_view, rows_for_zones
from sluiceway.operators import history
from sluiceway.operators.changes import snapshot_changes
from sluiceway.plans import billing, contractors, zones
from sluiceway.queries.registry import SETTINGS, query
from sluiceway.sources.tables import scratch, store

# --- personal details ------------------------------------------------------


@query("M-08, R-02, W-05, W-06, D-02, D-05, F-06", "SELECT * FROM pii_history")
def pii_scd2(inputs):
    return billing.customer_pii(inputs.bills())


@query(
    "M-08 comparing with plain <> (Q-07)",
    """SELECT account_id, customer_name, address, contact_number, billing_period AS effective_from,
    CAST(lead(billing_period) OVER w - INTERVAL 1 DAY AS DATE) AS effective_to, lead(billing_period) OVER w IS NULL AS is_current
    FROM (SELECT * FROM pii_daily
          WINDOW v AS (PARTITION BY account_id ORDER BY billing_period)
          QUALIFY lag(customer_name) OVER v IS NULL OR customer_name <> lag(customer_name) OVER v
                  OR address <> lag(address) OVER v OR contact_number <> lag(contact_number) OVER v)
    WINDOW w AS (PARTITION BY account_id ORDER BY billing_period)""",
)
def pii_scd2_plain_compare(inputs):
    return billing.customer_pii(inputs.bills(), null_safe=False)


@query(
    "M-34, R-01, W-02",
    """SELECT account_id, customer_name, address, contact_number FROM pii_daily
    QUALIFY row_number() OVER (PARTITION BY account_id ORDER BY billing_period DESC) = 1""",
)
def pii_scd1(inputs):
    return billing.customer_pii_latest(inputs.bills())


@query(
    "R-09, E-05: faults of a history kept per meter instead of per account",
    """SELECT account_id, count(*) AS version_count, count(*) FILTER (is_current) AS current_count,
    count(*) FILTER (coalesce(effective_to, DATE '9999-12-31') >= following) AS overlap_count,
    count(*) FILTER (effective_from > effective_to) AS inverted_count
    FROM (SELECT *, lead(effective_from) OVER (PARTITION BY account_id
          ORDER BY effective_from, effective_to NULLS LAST, is_current) AS following
          FROM (SELECT account_id, effective_from, effective_to, is_current FROM pii_history
                UNION ALL
                SELECT account_id, effective_from, effective_to, is_current FROM pii_history WHERE is_current
                       AND customer_name IS NOT NULL))
    GROUP BY account_id
    HAVING count(*) FILTER (is_current) <> 1
        OR count(*) FILTER (coalesce(effective_to, DATE '9999-12-31') >= following) > 0
        OR count(*) FILTER (effective_from > effective_to) > 0""",
)
def scd2_checks(inputs):
    """The history with every current version doubled, so that each account has a fault to find.

    It is stored: built once and not for either side of the union, and no task holds its windows beside those of the checks.
    """
    kept = store(billing.customer_pii(inputs.bills()).select("account_id", "customer_name", "effective_from", "effective_to", "is_current"))
    doubled = kept.unionByName(history.current(kept).where("customer_name IS NOT NULL"))
    return history.version_faults(doubled.drop("customer_name"), "account_id")


@query(
    "R-09: a sound history has no faults",
    """SELECT account_id, CAST(0 AS BIGINT) AS version_count, CAST(0 AS BIGINT) AS current_count,
    CAST(0 AS BIGINT) AS overlap_count, CAST(0 AS BIGINT) AS inverted_count FROM pii_history WHERE FALSE""",
)
def scd2_sound(inputs):
    return history.version_faults(billing.customer_pii(inputs.bills()), "account_id")


_SNAPSHOT = """SELECT account_id, customer_name, address, contact_number FROM pii_daily
    WHERE billing_period < DATE '{cut}' QUALIFY row_number() OVER (PARTITION BY account_id ORDER BY billing_period DESC) = 1"""


_CHANGES = f"""WITH old AS ({_SNAPSHOT.format(cut="1997-01-01")}), new AS ({_SNAPSHOT.format(cut="1999-01-01")}),
    both_sides AS (SELECT o.account_id AS ok, n.account_id AS nk,
        o.customer_name AS o1, o.address AS o2, o.contact_number AS o3, n.customer_name AS n1, n.address AS n2, n.contact_number AS n3
        FROM old o FULL JOIN new n ON o.account_id = n.account_id)
    SELECT 'insert' AS _change_type, nk AS account_id, n1 AS customer_name, n2 AS address, n3 AS contact_number
        FROM both_sides WHERE ok IS NULL
    UNION ALL SELECT 'delete', ok, o1, o2, o3 FROM both_sides WHERE nk IS NULL
    UNION ALL SELECT 'update_preimage', ok, o1, o2, o3 FROM both_sides WHERE ok IS NOT NULL AND nk IS NOT NULL
        AND (o1 IS DISTINCT FROM n1 OR o2 IS DISTINCT FROM n2 OR o3 IS DISTINCT FROM n3)
    UNION ALL SELECT 'update_postimage', nk, n1, n2, n3 FROM both_sides WHERE ok IS NOT NULL AND nk IS NOT NULL
        AND (o1 IS DISTINCT FROM n1 OR o2 IS DISTINCT FROM n2 OR o3 IS DISTINCT FROM n3)"""


@query("R-08 on accounts: details as of two dates", _CHANGES)
def pii_change_feed(inputs):
    def as_of(day: dt.date):
        return billing.customer_pii_latest(inputs.bills().where(F.col("billing_period") < F.lit(day)))

    return history.snapshot_diff(as_of(dt.date(1997, 1, 1)), as_of(dt.date(1999, 1, 1)), "account_id")


@query("R-08 by digests: only buckets that differ are joined", _CHANGES)
def pii_change_feed_by_digest(inputs):
    def as_of(day: dt.date):
        return store(billing.customer_pii_latest(inputs.bills().where(F.col("billing_period") < F.lit(day))))

    return snapshot_changes(as_of(dt.date(1997, 1, 1)), as_of(dt.date(1999, 1, 1)), "account_id")


@query(
    "E-06: accounts on an erasure list, here those with a negative balance",
    """SELECT * FROM pii_history
    WHERE account_id NOT IN (SELECT CAST(c_custkey AS VARCHAR) FROM customer WHERE c_acctbal < 0)""",
)
def pii_erasure(inputs):
    wanted = inputs.table("customer").where("c_acctbal < 0").select(F.col("c_custkey").cast("string").alias("account_id"))
    return history.erase(billing.customer_pii(inputs.bills()), wanted, "account_id")


@query("E-06: retention", "SELECT * FROM pii_history WHERE effective_to IS NULL OR effective_to >= DATE '1998-01-01'")
def pii_retention(inputs):
    return history.retain(billing.customer_pii(inputs.bills()), "effective_to", dt.date(1998, 1, 1))


@query(
    "G-01, G-02: as seen by readers outside the exempt group",
    """SELECT account_id, '***MASKED***' AS customer_name, '***MASKED***' AS address, '***MASKED***' AS contact_number,
    effective_from, effective_to, is_current FROM pii_history""",
)
def masked_pii(inputs):
    return masked_view(billing.customer_pii(inputs.bills()), config.PII_TAGS, groups=[])


@query("G-01, G-02: as seen by the exempt group", "SELECT * FROM pii_history")
def unmasked_pii(inputs):
    return masked_view(billing.customer_pii(inputs.bills()), config.PII_TAGS, groups=[config.PII_UNMASK_GROUP])


@query(
    "G-03: facts carry no personal detail; the two parts meet by account and day",
    """SELECT c.account_id, c.billing_period, c.amount_billed, h.address FROM consumption c
    JOIN pii_history h ON c.account_id = h.account_id AND c.billing_period >= h.effective_from
         AND c.billing_period <= coalesce(h.effective_to, DATE '9999-12-31')""",
)
def pii_split(inputs):
    """Facts joined to the version in force on the day.

    Not a range join: bills and version starts of an account are put in one order, at most a few
    rows per account and day, and the version is carried forward.
    """
    facts = inputs.consumption().select("account_id", "billing_period", "amount_billed")
    details = billing.customer_pii(inputs.bills())
    return history.as_of_version(facts, details, "account_id", "billing_period", ["address"])


# --- zone master -----------------------------------------------------------

_SEEN = """SELECT zone, min(completion_date) AS since FROM incoming_orders WHERE zone IS NOT NULL GROUP BY zone"""
_MERGED = f"""SELECT * FROM in_zone_master UNION ALL
    SELECT zone, zone, NULL, NULL, NULL, NULL, NULL, since, NULL, TRUE FROM ({_SEEN})
    WHERE zone NOT IN (SELECT zone_name FROM in_zone_master)"""


def _named_zones(inputs):
    orders = contractors.conformed_orders(inputs.works_orders())
    return zones.zones_named_by(orders, "zone", "completion_date")


@query("M-31, R-03, S-12, S-13, S-15, A-12", "SELECT * FROM in_zone_master")
def zone_seed(inputs):
    """Seeding twice must leave the founding rows once."""
    schema, folder = f"reference_{uuid.uuid4().hex[:8]}", scratch(inputs.spark)
    zones.set_up(inputs.spark, schema, folder, inputs.zone_master())
    seeded = store(zones.set_up(inputs.spark, schema, folder, inputs.zone_master()))
    inputs.spark.sql(f"DROP SCHEMA {schema} CASCADE")
    return seeded


@query("R-04: zones that works orders name and the master lacks", _MERGED)
def zone_merge_insert(inputs):
    return history.merge_insert(inputs.zone_master(), _named_zones(inputs), "zone_name")


@query(
    "R-05",
    f"""SELECT * FROM in_zone_master UNION ALL
    SELECT zone, zone, NULL, NULL, NULL, NULL, NULL, since, NULL, TRUE FROM ({_SEEN}) WHERE zone = 'NOWHERE'""",
)
def zone_add(inputs):
    return history.add_version(inputs.zone_master(), _named_zones(inputs).where("zone_name = 'NOWHERE'"))


_RETIRED = """SELECT * REPLACE (CASE WHEN zone_id = '24' THEN DATE '2001-06-30' ELSE effective_to END AS effective_to,
    is_current AND zone_id <> '24' AS is_current) FROM in_zone_master"""


@query("R-06", _RETIRED)
def zone_retire(inputs):
    return history.retire(inputs.zone_master(), F.col("zone_id") == "24", SETTINGS.as_of)


@query("R-07, U-01", f"SELECT * FROM ({_RETIRED}) WHERE is_current ORDER BY zone_id")
def zone_current(inputs):
    retired = history.retire(inputs.zone_master(), F.col("zone_id") == "24", SETTINGS.as_of)
    return history.current(retired).orderBy("zone_id")


_ZONE_COLUMNS = (
    "zone_id, zone_name, district, region, population_served, district_manager, sla_response_hours, "
    "effective_from, effective_to, is_current"
)


@query(
    "R-08",
    f"""SELECT 'insert' AS _change_type, * FROM ({_MERGED}) WHERE zone_name NOT IN (SELECT zone_name FROM in_zone_master)
    UNION ALL SELECT 'update_preimage', {_ZONE_COLUMNS} FROM in_zone_master WHERE zone_id = '24'
    UNION ALL SELECT 'update_postimage', {_ZONE_COLUMNS} FROM ({_RETIRED}) WHERE zone_id = '24'""",
)
def zone_change_feed(inputs):
    """What a merge and a retirement did to the master."""
    before = inputs.zone_master()
    merged = history.merge_insert(before, _named_zones(inputs), "zone_name")
    after = history.retire(merged, F.col("zone_id") == "24", SETTINGS.as_of)
    return history.snapshot_diff(before, after, "zone_id").select("_change_type", *before.columns)


@query(
    "U-02: the five zones that came into force last",
    "SELECT zone_name, effective_from FROM in_zone_master ORDER BY effective_from DESC, zone_name LIMIT 5",
)
def zone_latest(inputs):
    return inputs.zone_master().orderBy(F.col("effective_from").desc(), "zone_name").limit(5).select("zone_name", "effective_from")


@query("E-11", "SELECT * FROM billing_mart WHERE service_zone IN ('NATION_3', 'NATION_7')")
def zone_filter(inputs):
    return rows_for_zones(inputs.billing_mart(), "service_zone", ["NATION_3", "NATION_7"])
