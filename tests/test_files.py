"""Landing: malformed input, headers that drift, hints, table definitions, the daily run."""

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from sluiceway import config
from sluiceway.operators.rules import keep_valid, observe
from sluiceway.plans import zones
from sluiceway.queries import QUERIES
from sluiceway.queries.streams import write_pages
from sluiceway.sources import files, schemas, tables
from tests.conftest import SMALL

READING = schemas.struct(sensor_id=schemas.TEXT, reading_value=schemas.NUMBER)


def test_csv_rescue(spark, tmp_path):
    (tmp_path / "a.csv").write_text("sensor_id,reading_value\ns1,1.5\ns2,oops\ns3\ns4,2.0,extra\n")
    df = files.csv_files(spark, str(tmp_path), READING)
    watched, observation = observe(df, config.READING_LANDING)
    rows = {r.sensor_id: (r.reading_value, r._rescued_data) for r in watched.collect()}
    assert rows == {"s1": (1.5, None), "s2": (None, "s2,oops"), "s3": (None, "s3"), "s4": (2.0, "s4,2.0,extra")}
    assert observation.get == {"rows": 4, "no_rescued_data": 3}
    assert [r.sensor_id for r in keep_valid(df, config.READING_LANDING).collect()] == ["s1"]


def test_json_lines_rescue(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"sensor_id": 7, "reading_value": 1.5}\n{"sensor_id": "x", "reading_value": "high"}\nnot json\n')
    rows = files.json_lines(spark, str(tmp_path), READING).collect()
    assert [(r.sensor_id, r.reading_value, r._rescued_data is None) for r in rows] == [("7", 1.5, True), ("x", None, False), (None, None, False)]


def test_pages(spark, tmp_path):
    page = {"data": [{"invoice_id": "1", "vendor": {"id": "v", "name": "V"}, "line_items": [{"line_no": 1, "qty": 2, "unit_cost": 1.5}]}, {"invoice_id": "2"}]}
    (tmp_path / "p1.json").write_text(json.dumps(page, indent=2))
    (tmp_path / "p2.json").write_text('{"data": []}')
    (tmp_path / "p3.json").write_text('{"data": [{"invoice_id"')
    rows = files.invoice_pages(spark, str(tmp_path)).collect()
    by_id = {r.invoice_id: r for r in rows}
    assert set(by_id) == {"1", "2", None} and len(rows) == 3
    assert by_id["1"].vendor.name == "V" and by_id["1"].line_items[0].qty == 2 and by_id["2"].vendor is None
    assert by_id[None]._rescued_data and by_id["1"]._rescued_data is None


def test_written_pages_read_back(spark, tmp_path):
    records = spark.createDataFrame([(str(i), None) for i in range(23)], "invoice_id string, currency string").repartition(2)
    write_pages(records, str(tmp_path / "pages"), page_rows=5)
    assert sorted(int(r.invoice_id) for r in files.invoice_pages(spark, str(tmp_path / "pages")).collect()) == list(range(23))
    assert all(len(json.loads(p.read_text())["data"]) <= 5 for p in (tmp_path / "pages").glob("part-*"))


def test_compressed_pages_read_back_and_take_less_room(spark, tmp_path):
    records = spark.range(2000).selectExpr("CAST(id AS STRING) AS invoice_id", "'SGD' AS currency", "CAST(id % 7 AS STRING) AS cost_center")
    for kind in ("none", "gzip"):
        write_pages(records, str(tmp_path / kind), page_rows=500, compression=kind)
    plain, packed = (files.invoice_pages(spark, str(tmp_path / kind)).drop(files.SOURCE_FILE) for kind in ("none", "gzip"))
    assert plain.count() == packed.count() == 2000 and plain.exceptAll(packed).isEmpty()
    room = {kind: sum(p.stat().st_size for p in (tmp_path / kind).glob("part-*")) for kind in ("none", "gzip")}
    assert room["gzip"] * 4 < room["none"]


def test_csv_by_name_takes_any_order_and_keeps_added_text(spark, tmp_path):
    (tmp_path / "a.csv").write_text("sensor_id,reading_value\ns1,1.5\n")
    (tmp_path / "b.csv").write_text("reading_value,firmware,sensor_id\n2.5,0012,s2\noops,7,s3\n")
    (tmp_path / "c.csv").write_text("sensor_id\ns4\n")
    df = files.csv_by_name(spark, [str(p) for p in sorted(tmp_path.glob("*.csv"))], READING)
    assert df.columns == ["sensor_id", "reading_value", "firmware", "_rescued_data"]
    assert {tuple(r) for r in df.collect()} == {
        ("s1", 1.5, None, None), ("s2", 2.5, "0012", None), ("s3", None, "7", "oops,7,s3"), ("s4", None, None, None),
    }


def test_a_header_in_another_order_stops_the_positional_reader(spark, tmp_path):
    (tmp_path / "a.csv").write_text("reading_value,sensor_id\n1.5,s1\n")
    with pytest.raises(Exception, match="header"):
        files.csv_files(spark, str(tmp_path), READING).collect()


def test_rescue_does_not_depend_on_the_columns_asked_for(spark, tmp_path):
    (tmp_path / "a.csv").write_text("sensor_id,reading_value\ns1,1.5\ns2,oops\ns3\ns4,2.0,extra\n")
    df = files.csv_files(spark, str(tmp_path), READING)
    whole = {r.sensor_id: r._rescued_data for r in df.collect()}
    assert {r.sensor_id: r._rescued_data for r in df.select("sensor_id", "_rescued_data").collect()} == whole
    assert df.select("_rescued_data").where("_rescued_data IS NOT NULL").count() == 3


def test_unknown_json_fields_are_rescued_at_any_depth(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"sensor_id": "s", "firmware": "0012", "more": {"a": 1}}\n\n[1]\n{"reading_value": "high", "x": 1}\n')
    rescued = [r._rescued_data for r in files.json_lines(spark, str(tmp_path), READING).collect()]
    assert rescued == ['{"firmware":"0012","more":"{\\"a\\":1}"}', "[1]", '{"reading_value": "high", "x": 1}']
    (tmp_path / "p").mkdir()
    page = {"data": [{"invoice_id": "1", "vendor": {"id": "v", "rank": 2}}, {"invoice_id": "2", "line_items": [{"line_no": 1}, {"tax": 5}]}, {"invoice_id": "3"}], "next": "q"}
    (tmp_path / "p" / "p.json").write_text(json.dumps(page))
    found = {r.invoice_id: r._rescued_data for r in files.invoice_pages(spark, str(tmp_path / "p")).collect()}
    assert "rank" in found["1"] and "next" in found["1"] and "tax" in found["2"] and found["3"] is None


def test_a_page_is_parsed_once_and_not_for_every_record(spark, tmp_path):
    """Beside an explode, the page's text was carried along and parsed again for every record of it."""
    (tmp_path / "p").mkdir()
    (tmp_path / "p" / "a.json").write_text(json.dumps({"data": [{"invoice_id": str(i), "tax": i} for i in range(3)], "next": "q"}))
    (tmp_path / "p" / "b.json").write_text('{"next": "r"}')
    (tmp_path / "p" / "c.json").write_text('{"data": [null, {"invoice_id": "9"}]}')
    rows = files.invoice_pages(spark, str(tmp_path / "p"))
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    above = plan[: plan.index("Generate")]
    assert "value#" not in above and "_beside#" not in above
    found = sorted((r.invoice_id or "", r._rescued_data) for r in rows.collect() if r._rescued_data)
    assert found == [
        ("", '{"data": [null, {"invoice_id": "9"}]}'), ("", '{"next": "r"}'), ("0", '{"next":"q"}\n{"tax":"0"}'), ("1", '{"tax":"1"}'), ("2", '{"tax":"2"}'),
    ]


def test_a_page_read_as_a_whole_gives_what_its_records_give_one_by_one(spark, tmp_path, monkeypatch):
    good = '{"invoice_id":"1","currency":null,"vendor":{"id":7,"name":"a: b"},"line_items":[{"line_no":1,"qty":2,"unit_cost":1.50},{}]}'
    odd = [
        "", "null", "{}", '"', '{"new":1}', '{"vendor":{"id":1,"more":2}}', '{"line_items":[{"qty":1},{"more":1}]}', '{"line_items":[{"qty":"two"}]}',
        '{"line_items":{"qty":1}}', '{"line_items":[]}', '{"line_items":[null,"text"]}', '{"vendor":"v"}', '{"invoice_id":"1","invoice_id":null}',
        '{"invoice_id":null,"invoice_id":"1"}', '{"project_code":{"deep":[1.0E2]}}', '{"invoice_id":12345678901234567890123,"currency":1.10}',
        "{'invoice_id':'quoted'}", "[1]", '{"invoice_id, currency":"x"}', '{"Currency":"SGD"}', '{"vendor":{}}', '{"vendor":null,"line_items":null}',
    ]
    pages = [f'{{"data":[{good},{one}]}}' for one in odd] + [f'{{"data":[{one}]}}' for one in odd] + [
        f'{{"data":[{good}],"next":2}}', f'{{"data":[{good}]}} x', f'{{"data":[{good}],"data":[]}}', '{"data":{}}', '{"other":1}', f"[{good}]", good, "",
        '{"data":[' + ",".join([good] * 200) + "]}", "{'data':[" + good + "]}",
    ]
    for n, page in enumerate(pages):
        (tmp_path / f"{n:03}.json").write_text(page)

    def rows():
        return sorted(map(str, files.invoice_pages(spark, str(tmp_path)).collect()))

    whole = rows()
    assert len(whole) > 200
    monkeypatch.setattr(files, "_shapes", lambda kind: "none")
    assert whole == rows()


def test_drift_and_deliveries(spark, tmp_path):
    declared = schemas.struct(a=schemas.TEXT, b=schemas.NUMBER)
    for name, text in [("one", "a,b\nx,1.5\n"), ("two", "b,c,a\n2.5,new,y\n")]:
        (tmp_path / name).mkdir()
        (tmp_path / name / "f.csv").write_text(text)
    paths = [str(tmp_path / "one"), str(tmp_path / "two")]
    rows = files.csv_deliveries(spark, paths, declared).collect()
    assert sorted((r.a, r.b, r.c) for r in rows) == [("x", 1.5, None), ("y", 2.5, "new")]
    actual = files.header_schema(spark, paths[1], schemas.struct(a=schemas.TEXT, d=schemas.DAY))
    report = files.drift(spark, schemas.struct(a=schemas.NUMBER, d=schemas.DAY), actual).collect()
    assert sorted(tuple(r) for r in report) == [
        ("a", "retyped", "double", "string"), ("b", "new", None, "string"), ("c", "new", None, "string"), ("d", "missing", "date", None),
    ]


def test_hints(spark, tmp_path):
    (tmp_path / "f.csv").write_text("account_id,billing_period,n\n0012,2024-01-05,3\n")
    schema = files.infer_with_hints(spark, str(tmp_path), "account_id STRING, billing_period DATE, extra INT")
    assert [(f.name, f.dataType.simpleString()) for f in schema.fields] == [
        ("account_id", "string"), ("billing_period", "date"), ("n", "int"), ("extra", "int"),
    ]
    row = files.csv_files(spark, str(tmp_path), files.infer_with_hints(spark, str(tmp_path), "account_id STRING")).collect()[0]
    assert row.account_id == "0012"


def test_row_ids_tell_copies_apart(spark):
    stamped = files.with_row_id(spark.createDataFrame([(1,)] * 5, "v int"))
    assert stamped.select("_row_id").distinct().count() == 5


def test_founding_zones_once(spark, tmp_path):
    seed = zones.founding_zones(spark)
    first = zones.set_up(spark, "founding", str(tmp_path), seed)
    again = zones.set_up(spark, "founding", str(tmp_path), seed)
    assert first.count() == again.count() == 6
    fields = {f.name: f for f in again.schema.fields}
    assert fields["zone_id"].metadata["comment"] == "Short code"
    assert sorted(r.zone_id for r in again.collect()) == list("ABCDEF")


def test_scratch_follows_the_session(spark):
    assert tables.scratch(spark).startswith(spark.conf.get("spark.checkpoint.dir"))
    assert tables.scratch(spark) != tables.scratch(spark)


class Conf(dict):
    """Stands for a session whose checkpoint folder is unset."""

    @property
    def conf(self):
        return self


def test_scratch_without_a_setting():
    local = Conf({"spark.master": "local[2]"})
    assert tables.scratch(local).rsplit("/", 1)[0] == tables.scratch(local).rsplit("/", 1)[0]
    with pytest.raises(ValueError, match="all executors share"):
        tables.scratch(Conf({"spark.master": "spark://host:7077"}))
    assert tables.scratch(Conf({"spark.master": "yarn", "spark.checkpoint.dir": "hdfs:///ck/"})).startswith("hdfs:///ck/")


def test_scratch_is_empty_after_clearing(spark):
    folder = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:"))
    tables.clear_scratch(spark)
    before = set(folder.iterdir())
    QUERIES["network_health"].run(spark, SMALL).write.format("noop").mode("overwrite").save()
    assert set(folder.iterdir()) - before
    tables.clear_scratch(spark)
    assert set(folder.iterdir()) == before


def test_store_keeps_rows_and_schema(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    stored = tables.store(df)
    assert stored.schema == df.schema and sorted(map(tuple, stored.collect()), key=str) == [(1, None), (2, "x")]
    assert tables.store(df.where("false")).count() == 0


def test_clustered_overwrite(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.overwrite(spark.range(100).withColumn("k", F.col("id") % 3), path, ["k"], ["id"])
    assert tables.overwrite(spark.range(10).withColumn("k", F.col("id") % 3), path, ["k"], ["id"]).count() == 10


def test_headers_of_many_files_take_one_job(spark, tmp_path):
    """500 files of three headers, one with a blank in its name, one empty, one that begins with a blank line."""
    headers = ["sensor_id,reading_value", "reading_value,sensor_id", "extra,sensor_id"]
    for i in range(500):
        kind = i % 3
        values = [f"s{i},{i}.5", f"{i}.5,s{i}", f"e{i},s{i}"][kind]
        (tmp_path / (f"file {i}.csv" if i == 7 else f"{i}.csv")).write_text(("\n" if i == 9 else "") + f"{headers[kind]}\n{values}\n")
    (tmp_path / "empty.csv").write_text("")
    schema = schemas.struct(sensor_id=schemas.TEXT, reading_value=schemas.NUMBER)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("headers", "headers")
    df = files.csv_by_name(spark, [str(p) for p in sorted(tmp_path.iterdir())], schema)
    jobs = len(tracker.getJobIdsForGroup("headers"))
    spark.sparkContext.setJobGroup("rest", "rest")
    got = {r.sensor_id: (r.reading_value, r.extra) for r in df.collect()}
    assert got == {f"s{i}": (None if i % 3 == 2 else i + 0.5, f"e{i}" if i % 3 == 2 else None) for i in range(500)}
    assert jobs <= 12, "a job or two for all files, and one or two for each different header"
