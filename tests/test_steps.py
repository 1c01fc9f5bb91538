"""Runs that read new rows only: tables in parts, flags, history, bitmaps, and gold by touched months."""

import datetime as dt
import random
from collections import Counter, defaultdict
from functools import reduce
from pathlib import Path
from threading import Barrier
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from sluiceway import config
from sluiceway.operators import history
from sluiceway.operators.changes import changed_buckets, digests, fine_bucket, snapshot_changes
from sluiceway.operators.distinct import bitmaps, distinct_count, number_keys
from sluiceway.operators.layout import cluster_rows, curve_rows
from sluiceway.operators.profile import DISTINCT_ERROR, RANK_ERROR, merged_sketches, value_profile, value_sketches
from sluiceway.plans import finance
from sluiceway.plans.refresh import daily_refresh
from sluiceway.queries.oracle import with_inputs
from sluiceway.queries.registry import SETTINGS, Inputs
from sluiceway.queries.streams import _after_deliveries, _bronze_tables, deliver_bronze
from sluiceway.sources import schemas, tables
from sluiceway.sources.parted import PART, PartedTable, touched_parts
from sluiceway.streaming import flows
from sluiceway.streaming.gold import BillingSteps, DetailsSteps, GoldRun
from sluiceway.streaming.landing import Bronze
from sluiceway.streaming.once import OnceRun, bloom_filters, may_hold
from sluiceway.streaming.silver import Silver
from sluiceway.streaming.telemetry import TelemetryRun
from tests.compare import compare
from tests.conftest import SMALL

ROW = f"{PART} string, k int, v string"


def held(table):
    return sorted(tuple(r) for r in table.read().collect())


def spoil(folder):
    """Files that no one can read any more."""
    for file in Path(folder.removeprefix("file:")).rglob("*.parquet"):
        file.write_bytes(b"")


def test_only_touched_parts_are_replaced(spark, tmp_path):
    table = PartedTable(spark, str(tmp_path / "t"), "k int, v string")
    assert held(table) == [] and table.newest() is None
    table.replace(spark.createDataFrame([("a", 1, "x"), ("b", 2, "y"), ("c", 3, None)], ROW), ["a", "b", "c"], 0)
    names = set(table.files(["a", "c"]))
    table.replace(spark.createDataFrame([("b", 2, "z"), ("d", 4, "n")], ROW), ["b", "d"], 1)
    assert held(table) == [(1, "x"), (2, "z"), (3, None), (4, "n")]
    assert set(table.files(["a", "c"])) == names
    assert sorted(tuple(r) for r in table.read(before=1).collect()) == [(1, "x"), (2, "y"), (3, None)]
    table.replace(spark.createDataFrame([], ROW), ["a"], 2)
    assert held(table) == [(2, "z"), (3, None), (4, "n")]
    table.replace(spark.createDataFrame([], ROW), [], 3)
    assert table.newest() == 2
    kept = sorted(p.name for p in (tmp_path / "t" / "data").glob("n=*/_part=*"))
    assert kept == ["_part=a", "_part=b", "_part=c", "_part=d"], "what the newest two states do not name is deleted"


def test_a_replacement_that_stopped_or_is_repeated(spark, tmp_path):
    table = PartedTable(spark, str(tmp_path / "t"), "k int, v string")
    table.replace(spark.createDataFrame([("a", 1, "x"), ("b", 1, "y")], ROW), ["a", "b"], 0)
    spark.createDataFrame([("a", 9, "half")], ROW).write.partitionBy(PART).parquet(str(tmp_path / "t" / "data" / "n=1"))
    assert held(table) == [(1, "x"), (1, "y")], "without its list a replacement does not count"

    def add(number):
        grown = table.read(["a"], before=number).withColumn("k", F.col("k") + 1).withColumn(PART, F.lit("a"))
        table.replace(grown, ["a"], number)

    add(1), add(1), add(1)
    assert held(table) == [(1, "y"), (2, "x")]


def test_rows_of_other_parts_are_not_read(spark, tmp_path):
    table = PartedTable(spark, str(tmp_path / "t"), "k int, v string")
    table.replace(spark.range(100).selectExpr("concat('p', id % 10) AS _part", "cast(id AS int) AS k", "'x' AS v"), [f"p{i}" for i in range(10)], 0)
    for folder in table.files([f"p{i}" for i in range(10) if i != 3]):
        spoil(folder)
    assert table.read(["p3"]).count() == 10
    assert {"p3"} == {Path(f).parent.name.partition("=")[2] for f in table.read(["p3"]).inputFiles()}


# --- duplicate flags ----------------------------------------------------------

READING = "sensor_id string, location_id string, timestamp string, zone string, reading_type string, reading_value double, _row_id string"


def reading(sensor, at, value, row, place="l", zone="Z", kind="flow"):
    return (sensor, place, at, zone, kind, value, row)


def flags(run):
    locations = tables.store(run.locations())
    rows = run.readings(locations).select("sensor_id", "reading_ts", "reading_value", "is_duplicate").collect()
    return Counter((r.sensor_id, str(r.reading_ts), r.reading_value, r.is_duplicate) for r in rows)


def test_a_late_reading_takes_the_first_place_and_no_history_is_read(spark, tmp_path):
    base, noon = str(tmp_path), "2024-01-01 12:00:00"
    run = TelemetryRun(spark, base, SETTINGS, buckets=2)
    deliveries = [
        [reading("s", noon, 5.0, "r1"), reading("s", noon, 7.0, "r2"), reading("t", "2024-02-03 00:00:00", 1.0, "r3"), reading(None, noon, 1.0, "r4")],
        [reading("s", noon, 3.0, "r5"), reading("u", "2024-03-01 00:00:00", 2.0, "r6")],
        [reading("s", noon, 3.0, "r7"), reading("s", noon, 4.0, "r8", zone="Y")],
    ]
    for number, rows in enumerate(deliveries):
        frame = spark.createDataFrame(rows, READING)
        run._take(frame, number)
        if number == 1:
            run._take(frame, number)  # a batch that is repeated counts once
        if number == 0:
            for folder in run.winners.files([p for p in run.winners.parts() if not p.startswith("2024-01-01")]):
                spoil(folder)  # neither touched nor read from here on
            spoil(f"{run.routed}/_batch=0/_verdict=bad")
    assert flags(run) == Counter(
        {
            ("s", "2024-01-01 12:00:00", 5.0, True): 1, ("s", "2024-01-01 12:00:00", 7.0, True): 1, ("s", "2024-01-01 12:00:00", 3.0, False): 1,
            ("s", "2024-01-01 12:00:00", 3.0, True): 1, ("s", "2024-01-01 12:00:00", 4.0, True): 1,
            ("t", "2024-02-03 00:00:00", 1.0, False): 1, ("u", "2024-03-01 00:00:00", 2.0, False): 1,
        }
    )
    marts = {str(r.month_start_date)[:7]: (r.avg_flow, r.total_readings, r.duplicate_count) for r in run.diagnostic.read().collect()}
    assert marts == {"2024-01": (3.0, 5, 4), "2024-02": (1.0, 1, 0), "2024-03": (2.0, 1, 0)}
    lost = spark.read.parquet(run.demoted)
    assert {r["_row_id"] for r in lost.collect()} == {"r1"}


def test_a_location_that_changes_its_zone_moves_its_months(spark, tmp_path):
    run = TelemetryRun(spark, str(tmp_path), SETTINGS, buckets=2)
    run._take(spark.createDataFrame([reading("s", "2024-01-01 00:00:00", 1.0, "a", zone="A"), reading("t", "2024-05-01 00:00:00", 1.0, "b", place="m", zone="M")], READING), 0)
    may = run.diagnostic.files(["2024-05"])
    run._take(spark.createDataFrame([reading("s", f"2024-02-0{i} 00:00:00", 2.0, f"c{i}", zone="B") for i in (1, 2, 3)], READING), 1)
    got = {(r.zone, str(r.month_start_date)[:7], r.total_readings, r.zone_uncertain_count) for r in run.diagnostic.read().collect()}
    assert got == {("B", "2024-01", 1, 1), ("B", "2024-02", 3, 3), ("M", "2024-05", 1, 0)}
    assert run.diagnostic.files(["2024-05"]) == may


# --- history -------------------------------------------------------------------


def test_history_in_steps_equals_history_of_everything(spark):
    draw = random.Random(2)
    schema = "account_id string, day date, name string, address string"
    for _ in range(3):
        rows = [
            (f"a{draw.randrange(6)}", dt.date(2024, 1, 1) + dt.timedelta(draw.randrange(25)), draw.choice(["x", "y", None]), draw.choice(["p", None]))
            for _ in range(240)
        ]
        draw.shuffle(rows)
        grown = None
        for i in range(0, 240, 60):
            daily = history.daily_rows(spark.createDataFrame(rows[i : i + 60], schema), "account_id", "day", ["name", "address"])
            grown = history.dated_versions(daily, "account_id") if grown is None else history.merge_versions(grown, daily, "account_id", ["name", "address"])
            grown = tables.store(grown)
        whole = history.versions(spark.createDataFrame(rows, schema), "account_id", "day", ["name", "address"])
        assert sorted(map(str, grown.drop("days").collect())) == sorted(map(str, whole.select(*grown.drop("days").columns).collect()))


def test_a_late_snapshot_splits_a_version_and_one_joins_two(spark):
    def day(n):
        return dt.date(2024, 1, n)

    def daily(*rows):
        frame = spark.createDataFrame([("a", day(n), v) for n, v in rows], "account_id string, day date, name string")
        return history.daily_rows(frame, "account_id", "day", ["name"])

    def spans(df):
        return [(r.name, r.effective_from.day, r.effective_to and r.effective_to.day, r.is_current) for r in df.orderBy("effective_from").collect()]

    first = tables.store(history.dated_versions(daily((1, "x"), (5, "x"), (9, "y")), "account_id"))
    assert spans(first) == [("x", 1, 8, False), ("y", 9, None, True)]
    split = tables.store(history.merge_versions(first, daily((3, "z")), "account_id", ["name"]))
    assert spans(split) == [("x", 1, 2, False), ("z", 3, 4, False), ("x", 5, 8, False), ("y", 9, None, True)]
    closed = tables.store(history.merge_versions(split, daily((12, "w")), "account_id", ["name"]))
    assert spans(closed)[-2:] == [("y", 9, 11, False), ("w", 12, None, True)]
    joined = history.merge_versions(closed, daily((9, "zz"), (12, "zz")), "account_id", ["name"])
    assert spans(joined)[-2:] == [("x", 5, 8, False), ("zz", 9, None, True)], "the greater value of a day wins, and equal neighbours are one"


def test_details_steps_touch_only_the_accounts_they_name(spark, tmp_path):
    run = DetailsSteps(spark, str(tmp_path), SETTINGS, buckets=16)
    names = schemas.BILLS.names

    def bills(*rows):
        filled = [tuple({"account_id": a, "billing_period": dt.date(2024, 1, d), "customer_name": n}.get(c) for c in names) for a, d, n in rows]
        return spark.createDataFrame(filled, schemas.BILLS)

    run._take(bills(*((f"a{i}", 1, "x") for i in range(40)), (None, 1, "nobody")), 0)
    before = run.versions.parts()
    run._take(bills(("a7", 3, "y")), 1)
    run._take(bills(("a7", 3, "y")), 1)
    after = run.versions.parts()
    assert sum(before[p] != after[p] for p in before) == 1
    assert Counter((r.customer_name, r.is_current) for r in run.customer_pii().collect()) == {("x", True): 39, ("x", False): 1, ("y", True): 1}


# --- distinct counts -------------------------------------------------------------


def test_bitmaps_of_numbered_keys_count_exactly(spark, tmp_path):
    draw = random.Random(5)
    table = PartedTable(spark, str(tmp_path / "n"), "k string, number bigint")
    truth, pieces, numbers = defaultdict(set), None, {}
    for run in range(3):
        rows = [(draw.choice("xy"), None if draw.random() < 0.05 else f"k{draw.randrange(150_000 if run == 2 else 300)}") for _ in range(3000)]
        frame = spark.createDataFrame(rows, "g string, k string")
        found = tables.store(number_keys(table, frame, "k", 4, run))
        for r in found.collect():
            assert numbers.setdefault(r.k, r.number) == r.number
        new = bitmaps(frame.join(found, "k", "left"), ["g"])
        pieces = tables.store(new if pieces is None else pieces.unionByName(new))
        for g, k in rows:
            truth[g].update([k] if k else [])
    assert len(set(numbers.values())) == len(numbers) and max(numbers.values()) < 2 * len(numbers)
    assert {r.g: r.n for r in distinct_count(pieces, ["g"], "n").collect()} == {g: len(ks) for g, ks in truth.items()}
    assert distinct_count(pieces, [], "n").first().n == len(truth["x"] | truth["y"])


def test_a_late_first_bill_is_taken_off_sums_and_bitmaps(spark, tmp_path):
    run = BillingSteps(spark, str(tmp_path), SETTINGS, buckets=2)
    names = schemas.BILLS.names

    def bills(*rows):
        keys = ("account_id", "billing_period", "service_zone", "amount_billed", "payment_status")
        filled = []
        for row in rows:
            known = dict(zip(keys, row, strict=True)) | {"meter_id": "m", "consumption_value": 1.0, "consumption_unit": "m3"}
            filled.append(tuple(known.get(c) for c in names))
        return spark.createDataFrame(filled, schemas.BILLS)

    run._take(bills(("a", dt.date(2024, 1, 9), "Z", 5.5, "OS"), ("b", dt.date(2024, 1, 9), "Z", 1.0, "Paid"), ("a", dt.date(2024, 3, 1), "Z", 2.0, "Paid")), 0)
    march = run.mart.files(["2024-03"])
    run._take(bills(("a", dt.date(2024, 1, 2), "Y", 7.0, "Paid"), ("b", dt.date(2024, 1, 1), "Z", None, "Paid"), ("c", dt.date(2024, 1, 1), "Z", 4.0, "OS")), 1)
    got = {(r.service_zone, r.month_start_date.month): (r.total_billed, r.total_accounts, r.overdue_count, r.overdue_rate_pct) for r in run.mart.read().collect()}
    assert got == {("Y", 1): (7.0, 1, 0, 0.0), ("Z", 1): (4.0, 1, 1, 100.0), ("Z", 3): (2.0, 1, 0, 0.0)}, "an invalid first bill takes the later one down"
    assert run.mart.files(["2024-03"]) == march
    assert {r.year: r.n for r in run.accounts([F.year("month_start_date").alias("year")], "n").collect()} == {2024: 2}


# --- all of gold -------------------------------------------------------------------


@pytest.fixture(scope="module")
def gold(spark, tmp_path_factory):
    """Land, silver, gold, a full rebuild on the same lake, land, silver, gold."""
    base = str(tmp_path_factory.mktemp("lake"))
    inputs = Inputs(spark, SMALL)
    stored = {name: tables.store(df) for name, df in _bronze_tables(inputs).items()}
    keys = {"billing_customer": "seq", "finance_invoices_raw": "line_items", "sensor_readings": "_row_id"}
    zones = tables.store(inputs.zones())
    for number in (0, 1):
        for name, df in stored.items():
            deliver_bronze(base, name, df.where(F.pmod(F.xxhash64(keys.get(name, df.columns[0])), F.lit(2)) == number), number)
        silver = Silver(spark, base, SETTINGS)
        silver.invoices(), silver.lines(), silver.works_orders(zones)
        run = GoldRun(spark, base, SETTINGS, months="yyyy", days="yyyy-MM", buckets=2)
        run.run()
        if number == 0:
            orders = {f"contractor_{c}": spark.read.parquet(f"{base}/bronze/works_orders_{c}") for c in "abc"}
            read = [spark.read.parquet(f"{base}/bronze/{n}").drop("_batch") for n in ("billing_customer", "finance_invoices_raw", "sensor_readings")]
            daily_refresh(Bronze(read[0], read[1], {n: df.drop("_batch") for n, df in orders.items()}, read[2], zones, "_row_id"), base, SETTINGS)
    return run, zones, base


MARTS = {
    "billing_by_zone_month": "SELECT * FROM billing_mart",
    "spend_by_zone_month": "SELECT * FROM spend_mart",
    "contractor_by_zone_month": "SELECT * FROM contractor_mart",
    "network_health_diagnostic_by_zone_month": "SELECT * FROM network_mart",
}


@pytest.mark.parametrize("name", sorted(MARTS))
def test_marts_in_steps_match_sql(gold, duck, name):
    assert compare(gold[0].marts()[name], duck, with_inputs(MARTS[name])) == []


@pytest.mark.parametrize(
    ("name", "query"),
    [("spend_by_zone_category_month", "spend_by_zone_category_month"), ("works_by_zone_type_month", "works_by_zone_type_month"), ("network_health_by_zone_month", "network_health")],
)
def test_other_marts_match_the_sql_of_their_queries(gold, duck, name, query):
    from sluiceway.queries import QUERIES

    assert compare(gold[0].marts()[name], duck, QUERIES[query].sql) == []


def test_the_scorecard_in_steps_matches_sql(gold, duck):
    assert compare(gold[0].scorecard(gold[1]), duck, with_inputs("SELECT * FROM scorecard")) == []


def test_neither_writer_takes_the_others_folder(gold, spark, tmp_path):
    base = gold[2]
    with pytest.raises(ValueError, match="appended to by a stream"):
        tables.refuse_other_owner(spark, f"{base}/appended/works_orders", streamed=False)
    with pytest.raises(ValueError, match="recomputed table"):
        tables.refuse_other_owner(spark, f"{base}/silver/works_orders", streamed=True)
    tables.refuse_other_owner(spark, str(tmp_path / "new"), streamed=True)


RECORD = "invoice_id string, invoice_date string, cost_center string, currency string, site_zone string, project_code string, " \
    "vendor struct<id: string, name: string>, line_items array<struct<line_no: int, description: string, qty: int, unit_cost: double>>, _source_file string"


def test_silver_keeps_invoices_in_files_and_not_in_the_memory_of_a_stream(spark, tmp_path):
    base = str(tmp_path)
    found = []
    for number, ids in enumerate((["1", "1", "2"], ["2", "3", None, "1"], [None, "3", "4"])):
        rows = [(i, "2000-01-02", f"c{number}", "SGD" if i != "2" else "", "Z", "P", ("v", "V"), [], f"page{n}") for n, i in enumerate(ids)]
        deliver_bronze(base, "finance_invoices_raw", spark.createDataFrame(rows, RECORD), number)
        good, bad = Silver(spark, base, SETTINGS).invoices()
        found.append((sorted((r.invoice_id, r.cost_center) for r in good.collect()), sorted((str(r.invoice_id), r.cost_center, r._quarantine_reason) for r in bad.collect())))
    assert found[0] == ([("1", "c0")], [("2", "c0", "valid_currency")])
    assert found[2] == ([("1", "c0"), ("3", "c1"), ("4", "c2")], [("2", "c0", "valid_currency"), ("None", "c1", "valid_invoice_id")])
    assert not [p for p in (tmp_path / "checkpoints").rglob("state")], "no key of an invoice is held in a state store"


def test_a_table_begun_with_a_streams_state_goes_on_with_it(spark, tmp_path):
    base = str(tmp_path)

    def deliver(number, *ids):
        rows = [(i, None, None, "SGD", None, None, None, None, "page") for i in ids]
        deliver_bronze(base, "finance_invoices_raw", spark.createDataFrame(rows, RECORD), number)

    deliver(0, "1", "2")
    silver = Silver(spark, base, SETTINGS)
    once = flows.once_per_key(silver._invoice_records(), "invoice_id", ["_source_file"], SETTINGS.lanes)
    silver._split("finance_invoices", finance.flatten_headers(once), [r for r in config.invoice_rules(SETTINGS) if r.action == "drop"])
    deliver(1, "2", "3")
    good, bad = silver.invoices()
    assert sorted(r.invoice_id for r in good.select("invoice_id").union(bad.select("invoice_id")).collect()) == ["1", "2", "3"]


def test_touched_parts_names_each_once(spark):
    assert touched_parts(spark.createDataFrame([("b",), ("a",), ("b",)], f"{PART} string")) == ["a", "b"]
    assert config.PII_COLUMNS


# --- one row per key -----------------------------------------------------------------


def test_copies_are_found_long_after_their_keys_left_the_lists(spark, tmp_path):
    draw = random.Random(8)
    run = OnceRun(spark, str(tmp_path), SETTINGS, "rows", "k", ["v"], fold_every=2, buckets=4, bucket_keys=100)
    seen, expected = set(), Counter()
    for number in range(7):
        rows = [(None if draw.random() < 0.02 else f"k{draw.randrange(60)}", draw.randrange(1000)) for _ in range(25)]
        for key in {k for k, _ in rows} - seen:
            expected[key, min(v for k, v in rows if k == key)] += 1
        seen |= {k for k, _ in rows}
        frame = spark.createDataFrame(rows, "k string, v int")
        for _ in range(1 + (number in (1, 4))):  # repeated batches, one that folds among them
            run._take(frame, number)
    got = spark.read.schema("k string, v int").parquet(run.path)
    assert Counter((r.k, r.v) for r in got.collect()) == expected
    lists = sorted(p.name for p in Path(run.recent).iterdir() if p.name.startswith("_batch="))
    assert len(lists) <= 2 * run.fold_every, "keys are in lists for a bounded number of batches"
    assert run.index.read().count() >= len(seen) - 25


def test_filters_find_every_key_and_spare_other_buckets(spark, tmp_path):
    keys = spark.range(3000).selectExpr("concat('p', id % 3) AS _part", "concat('in', id) AS key")
    others = spark.range(3000).selectExpr("concat('p', id % 3) AS _part", "concat('out', id) AS key")
    bits = 32_768 * 2
    filters = tables.store(bloom_filters(keys, "key", bits, 7))
    assert may_hold(keys, filters, "key", bits, 7).count() == 3000
    assert may_hold(others, filters, "key", bits, 7).count() < 30
    run = OnceRun(spark, str(tmp_path), SETTINGS, "rows", "k", ["v"], fold_every=1, buckets=8, bucket_keys=1000)
    run._take(spark.range(800).selectExpr("concat('k', id) AS k", "1 AS v"), 0)
    run._take(spark.createDataFrame([("k5", 2), ("new", 2)], "k string, v int"), 1)
    assert len(run.asked) == 1, "of two buckets named, only the one whose filter hits is read"


# --- change feed -----------------------------------------------------------------------


def test_changes_by_digest_equal_a_plain_comparison(spark):
    draw = random.Random(6)
    before = {**{f"a{i}": (draw.choice("xyz"), draw.choice([None, 1, 2])) for i in range(400)}, None: ("n", 1)}
    after = dict(before)
    for key in draw.sample([k for k in before if k], 12):
        after.pop(key) if draw.random() < 0.4 else after.update({key: ("w", draw.choice([None, 3]))})
    after |= {"new1": ("x", None), None: ("n", 2)}
    frames = [spark.createDataFrame([(k, *v) for k, v in side.items()], "k string, name string, n int") for side in (before, after)]
    expected = Counter()
    for key in before.keys() | after.keys():
        old, new = before.get(key), after.get(key)
        if key not in before:
            expected["insert", key, *new] += 1
        elif key not in after:
            expected["delete", key, *old] += 1
        elif old != new:
            expected["update_preimage", key, *old] += 1
            expected["update_postimage", key, *new] += 1
    for fine, coarse in ((65536, 256), (16, 4), (1, 1)):
        got = snapshot_changes(*frames, "k", fine, coarse)
        assert Counter(tuple(r) for r in got.collect()) == expected
    assert snapshot_changes(frames[0], frames[0], "k").count() == 0


def test_only_buckets_that_differ_are_named(spark):
    before = spark.range(5000).selectExpr("id AS k", "id % 7 AS v")
    after = before.where("k <> 17").withColumn("v", F.when(F.col("k") == 4000, 99).otherwise(F.col("v")))
    held = [digests(df.repartition(n), "k", ["v"], 1024) for df, n in ((before, 3), (after, 5))]
    named = {r.bucket for r in changed_buckets(*held, 32).collect()}
    own = {r.b for r in before.where("k IN (17, 4000)").select(fine_bucket("k", 1024).alias("b")).collect()}
    assert named == own
    plan = snapshot_changes(before, after, "k")._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in plan


# --- layout and profiles ------------------------------------------------------------------


def test_a_filter_on_either_key_of_the_curve_reads_few_files(spark, tmp_path):
    rows = spark.range(60_000).selectExpr("cast(id * 7919 % 1000 AS int) AS a", "concat('z', lpad(cast(xxhash64(id) % 500 + 500 AS string), 4, '0')) AS b", "id")
    rows = rows.unionByName(spark.createDataFrame([(None, None, -1)] * 50, "a int, b string, id bigint"))
    curve_rows(rows, ["a", "b"], partitions=64).write.parquet(str(tmp_path / "curve"))
    cluster_rows(rows, ["a"], ["id"], 64).write.parquet(str(tmp_path / "sorted"))

    def share(name, test):
        """Files whose least and greatest values leave room for the test, as a reader skips them."""
        ends = spark.read.parquet(str(tmp_path / name)).groupBy(F.input_file_name().alias("f")).agg(
            F.min("a").alias("a0"), F.max("a").alias("a1"), F.min("b").alias("b0"), F.max("b").alias("b1")
        )
        return ends.where(test).count() / ends.count()

    on_a, on_b = "a0 <= 333 AND a1 >= 333", "b0 <= 'z0444' AND b1 >= 'z0444'"
    assert share("curve", on_a) <= 0.3 and share("curve", on_b) <= 0.3
    assert share("sorted", on_b) > 0.9
    read = spark.read.parquet(str(tmp_path / "curve"))
    assert read.count() == 60_050 and read.exceptAll(rows).count() == 0


def test_sketches_of_batches_merge_within_their_errors(spark):
    rows = spark.range(40_000).selectExpr("id", "concat('k', id % 9000) AS k", "IF(id % 10 = 0, NULL, cast(id AS double)) AS v", "cast(NULL AS string) AS nothing")
    parts = [value_sketches(rows.where(f"id % 4 = {i}"), ["k", "v", "nothing"], "d") for i in range(4)]
    merged = merged_sketches(reduce(lambda a, b: a.unionByName(b), parts))
    got = {r.column_name: r for r in value_profile(merged).collect()}
    assert (got["v"].row_count, got["v"].null_count, got["nothing"].null_count, got["nothing"].distinct_values) == (40_000, 4000, 40_000, 0)
    assert abs(got["k"].distinct_values - 9000) < 3 * DISTINCT_ERROR * 9000
    for q, name in ((0.05, "q05"), (0.5, "q50"), (0.95, "q95")):
        assert abs(got["v"][name] / 40_000 - q) < RANK_ERROR
    assert got["k"].q50 is None and got["nothing"].q50 is None


def test_deliveries_are_written_once_and_arrive_one_by_one(spark):
    """Tables were stored, and every delivery read all of that store and wrote its rows again."""
    seen = []

    def run(base):
        seen.append({t: sorted(r.id for r in spark.read.schema("id bigint").parquet(f"{base}/bronze/{t}").collect()) for t in ("a", "b")})
        return base

    mark, conditions = tables.scratch_mark(), [F.col("id") % 3 == n for n in range(3)]
    splits = {"a": conditions, "b": [F.col("id") < 5, F.col("id") < 0, F.col("id") >= 5]}
    _after_deliveries(SimpleNamespace(spark=spark), run, {"a": spark.range(7), "b": spark.range(7)}, splits)
    assert seen == [
        {"a": [0, 3, 6], "b": [0, 1, 2, 3, 4]}, {"a": [0, 1, 3, 4, 6], "b": [0, 1, 2, 3, 4]}, {"a": list(range(7)), "b": list(range(7))},
    ]
    assert tables.scratch_mark() - mark == 1


def test_the_domains_of_gold_run_side_by_side():
    """They ran one after the other; each waits here until all four have begun."""
    begun, gold = Barrier(4), GoldRun.__new__(GoldRun)
    gold.billing = gold.spend = gold.orders = gold.readings = SimpleNamespace(run=lambda: begun.wait(20))
    gold.run()
