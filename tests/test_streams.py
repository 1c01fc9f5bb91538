"""Streams that stop and start again: nothing lost, nothing twice, equal to one batch."""

import datetime as dt
from collections import Counter

import pytest
from pyspark.sql import functions as F

from sluiceway import config
from sluiceway.config import Settings
from sluiceway.operators.quarantine import bad_rows, good_rows
from sluiceway.queries.registry import SETTINGS
from sluiceway.sources import files, schemas
from sluiceway.streaming import flows
from sluiceway.streaming.landing import Landing
from sluiceway.streaming.silver import Silver
from sluiceway.streaming.telemetry import TelemetryRun

ORDERS = "work_order_id string, zone_id string, cost double, completion_date date, description string"


def deliver(spark, path, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
    return files.stored_files(spark, path, spark.createDataFrame([], schema).schema, stream=True)


def test_split_over_two_deliveries(spark, tmp_path):
    src, out, check = (str(tmp_path / n) for n in ("src", "out", "check"))
    rows = [("a", "Z", 5.0, None, "x"), ("b", "Z", None, None, "x")]
    for batch in (rows, [("c", "Z", 1.0, None, "x")]):
        stream = deliver(spark, src, batch, ORDERS).withColumn("completion_date", F.to_date(F.lit("2000-01-01")))
        routed = flows.split_stream(stream, config.works_rules(SETTINGS), SETTINGS, out, check)
    assert sorted(r.work_order_id for r in good_rows(routed).collect()) == ["a", "c"]
    assert [(r.work_order_id, r._quarantine_reason) for r in bad_rows(routed).collect()] == [("b", "positive_cost, reasonable_cost")]
    again = flows.split_stream(stream, config.works_rules(SETTINGS), SETTINGS, out, check)
    assert again.count() == 3, "a run without new files adds nothing"


def test_side_reads_its_own_partition_only(spark, tmp_path):
    stream = deliver(spark, str(tmp_path / "src"), [("a", "Z", 5.0, None, "x")], ORDERS)
    routed = flows.split_stream(stream, config.works_rules(SETTINGS), SETTINGS, str(tmp_path / "out"), str(tmp_path / "check"))
    plan = bad_rows(routed)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_verdict" in plan


def test_dedup_remembers_earlier_runs(spark, tmp_path):
    for salts in (1, 4):
        base = tmp_path / str(salts)
        src, out, check = (str(base / n) for n in ("src", "out", "check"))
        hot = [("h", i) for i in range(60)]
        for batch in (hot + [("a", 1), ("b", 1)], [("h", 99), ("c", 1), ("c", 2)]):
            stream = deliver(spark, src, batch, "k string, n int")
            table = flows.run_available(flows.once_per_key(stream, "k", ["n"], salts), out, check)
        assert Counter(r.k for r in table.collect()) == Counter("abch")


READING = "sensor_id string, location_id string, `timestamp` string, zone string, reading_type string, reading_value double, _row_id string"


def readings(*places):
    return [("s", place, "2024-01-01 00:00:00", zone, "flow", 1.0, f"{place}{zone}{i}") for i, (place, zone) in enumerate(places)]


def bronze(spark, base, rows, number):
    spark.createDataFrame(rows, READING).write.parquet(f"{base}/bronze/sensor_readings/_batch={number}")


def test_votes_over_runs_equal_one_batch_and_read_no_history(spark, tmp_path):
    batches = [[("l", "A")] * 3 + [("m", "B")], [("l", "B"), ("m", "B"), (None, "A")], [("l", None)]]
    whole = Counter()
    for number, batch in enumerate(batches):
        bronze(spark, tmp_path, readings(*batch), number)
        run = TelemetryRun(spark, str(tmp_path), SETTINGS)
        run.run()
        whole.update(pair for pair in batch if pair[0] is not None)
        assert {(r.location_id, r.zone): r.votes for r in run.votes().collect()} == whole
        if number:  # earlier readings may be gone: neither the vote nor the routing needs them
            for old in (tmp_path / "bronze" / "sensor_readings" / f"_batch={number - 1}").glob("*.parquet"):
                old.write_bytes(b"")
    assert len(list((tmp_path / "steps" / "zone_votes" / "holds").glob("n=*"))) == 2


def test_a_telemetry_batch_that_is_repeated_counts_once(spark, tmp_path):
    run = TelemetryRun(spark, str(tmp_path), SETTINGS)
    first, second = (spark.createDataFrame(readings(*rows), READING) for rows in ([("l", "A"), ("l", "B")], [("l", "B")]))
    for number, batch in ((0, first), (1, second), (1, second)):
        run._take(batch, number)
    assert {(r.zone, r.votes) for r in run.votes().collect()} == {("A", 1), ("B", 2)}
    assert run.readings(run.locations()).count() == 3 and run.rejected().count() == 0


def test_silver_reads_new_files_only(spark, tmp_path):
    schema = "work_order_id string, site_location string, work_description string, date_completed string, cost_sgd double"
    zones = spark.createDataFrame([("1", "Z", True)], "zone_id string, zone_name string, is_current boolean")
    empty = {"b": schemas.WORKS_ORDERS["contractor_b"], "c": schemas.WORKS_ORDERS["contractor_c"]}
    for letter, kind in empty.items():
        spark.createDataFrame([], kind).write.parquet(f"{tmp_path}/bronze/works_orders_{letter}/_batch=0")
    counts = []
    for number, rows in enumerate([[("a", "Z", "d", "2000-01-01", 5.0), ("b", "Y", "d", "2000-01-01", 5.0)], [("c", "Z", "d", "2000-01-01", 5.0)]]):
        folder = tmp_path / "bronze" / "works_orders_a" / f"_batch={number}"
        spark.createDataFrame(rows, schema).write.parquet(str(folder))
        good, bad = Silver(spark, str(tmp_path), SETTINGS, max_files=1).works_orders(zones)
        counts.append((good.count(), bad.count()))
        for file in folder.glob("*.parquet"):
            file.write_bytes(b"")  # a run that read it again would fail
    assert counts == [(1, 1), (2, 1)]


def test_malformed_lines_land_on_a_stream(spark, tmp_path):
    (tmp_path / "src").mkdir()
    (tmp_path / "src" / "a.csv").write_text("sensor_id,reading_value\ns1,1.5\ns2,oops\n")
    schema = schemas.struct(sensor_id=schemas.TEXT, reading_value=schemas.NUMBER)
    stream = files.csv_files(spark, str(tmp_path / "src"), schema, stream=True)
    landed = flows.run_available(stream, str(tmp_path / "out"), str(tmp_path / "check"))
    assert {r.sensor_id: r._rescued_data for r in landed.collect()} == {"s1": None, "s2": "s2,oops"}


def test_counts_cover_every_batch_of_a_long_run(spark, tmp_path):
    """More micro-batches than the session keeps progress of, two runs, and a batch that is run again."""
    (tmp_path / "in" / "network_telemetry").mkdir(parents=True)
    for i in range(8):
        (tmp_path / "in" / "network_telemetry" / f"{i}.json").write_text('{"sensor_id": "s", "reading_value": "x"}\n{"sensor_id": "t"}\n')
    kept = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", 3)
    try:
        run = Landing(spark, str(tmp_path / "in"), str(tmp_path / "lake"), max_files=1)
        landed = run.readings()
        assert len(run.ran["sensor_readings"]) == 8 and landed.count() == 16
        assert [(r.passed, r.failed) for r in run.rule_counts().groupBy("rule").agg(F.sum("passed").alias("passed"), F.sum("failed").alias("failed")).collect()] == [(8, 8)]
        (tmp_path / "in" / "network_telemetry" / "late.json").write_text('{"sensor_id": "u", "new": 1}\n')
        again = Landing(spark, str(tmp_path / "in"), str(tmp_path / "lake"), max_files=1)
        assert again.readings().count() == 17 and len(again.ran["sensor_readings"]) == 1
        assert [(r.passed, r.failed) for r in again.rule_counts(this_run=True).collect()] == [(0, 1)]
        assert again.rule_counts().count() == 9
    finally:
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", kept)


def test_a_landing_batch_keeps_its_books_without_python_workers(spark, tmp_path, monkeypatch):
    """What a micro-batch takes besides its rows is paid once for every few files of a backlog."""
    folder = tmp_path / "in" / "finance_erp"
    folder.mkdir(parents=True)
    for i in range(4):
        (folder / f"{i}.json").write_text('{"data":[{"invoice_id":"%d","currency":"SGD"}]}' % i)
    run = Landing(spark, str(tmp_path / "in"), str(tmp_path / "lake"), max_files=1)
    with monkeypatch.context() as m:
        m.setattr(type(spark), "createDataFrame", None)  # a frame of Python rows starts a worker
        landed = run.invoices()
    assert landed.count() == 4 and len(run.ran["finance_invoices_raw"]) == 4
    assert {(r.rule, r.passed, r.failed) for r in run.rule_counts().where("rule = 'valid_currency'").collect()} == {("valid_currency", 1, 0)}
    assert len(list((tmp_path / "lake" / "ops" / "landing_counts" / "finance_invoices_raw").glob("_batch=*/rows.json"))) == 4


def test_counts_of_runs_before_they_were_json_still_count(spark, tmp_path):
    folder = tmp_path / "in" / "network_telemetry"
    folder.mkdir(parents=True)
    (folder / "a.json").write_text('{"sensor_id": "s"}\n')
    run = Landing(spark, str(tmp_path / "in"), str(tmp_path / "lake"), max_files=1)
    run.readings()
    old = spark.createDataFrame([("bronze.sensor_readings", "no_rescued_data", "warn", 5, 2)], flows.METRICS)
    old.coalesce(1).write.parquet(str(tmp_path / "lake" / "ops" / "landing_counts" / "sensor_readings" / "_batch=7"))
    assert sorted((r.passed, r.failed, r._batch) for r in run.rule_counts().collect()) == [(1, 0, 0), (5, 2, 7)]


def test_settings_need_a_clock():
    with pytest.raises(TypeError):
        Settings(lanes=4)
    late = Settings(as_of=dt.date(2031, 5, 1), processed_at=dt.datetime(2031, 5, 1), lanes=4)
    assert any("2031-05-01" in rule.predicate for rule in config.invoice_rules(late))
