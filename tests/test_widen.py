"""Columns whose type changes: the order of types, the kinds of values, tables in versions."""

import datetime as dt
from decimal import Decimal

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sluiceway.operators import widen
from sluiceway.operators.widen import Kind
from sluiceway.sources import schemas, versions
from sluiceway.sources.schemas import RESCUE
from sluiceway.streaming import flows
from sluiceway.streaming.landing import Landing

NUMBERS = st.builds(lambda n, w, f: Kind(n, w, f, w + f), st.sampled_from(["number", "floating"]), st.integers(1, 38), st.integers(0, 20))
KINDS = st.one_of(NUMBERS, st.sampled_from(["empty", "flag", "day", "time", "text"]).map(Kind)).map(lambda k: k | Kind())


@given(KINDS, KINDS, KINDS)
def test_order_of_deliveries_does_not_matter(a, b, c):
    assert a | b == b | a
    assert (a | b) | c == a | (b | c)
    assert a | a == a and a | Kind() == a
    assert (a | b) | a == a | b


@pytest.mark.parametrize(
    "values, expected",
    [
        (["1", "-20", None], "bigint"),
        (["1", "2.50"], "decimal(38,2)"),
        (["1", "1e5"], "double"),
        (["1234567890123456", "1e5"], "string"),
        (["9" * 18], "bigint"),
        (["9" * 19], "decimal(38,0)"),
        (["9" * 39], "string"),
        (["9" * 30, "0." + "1" * 20], "string"),
        (["007"], "string"),
        (["-0", "1"], "double"),
        (["true", "false"], "boolean"),
        (["2024-02-29"], "date"),
        (["2023-02-29"], "string"),
        (["2024-02-29", "2024-03-01 10:00:00"], "timestamp_ntz"),
        (["2024-02-29", "1"], "string"),
        ([None, None], "string"),
        ([], "string"),
        ([""], "string"),
        ([" 1"], "string"),
        (["1\n"], "string"),
    ],
)
def test_narrowest_kind(spark, values, expected):
    df = spark.createDataFrame([(v,) for v in values], "`a.b` string")
    assert widen.measured(df, ["a.b"])["a.b"].data_type.simpleString() == expected


def deliver(spark, folder, rows, header):
    spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in header)).coalesce(1).write.option("header", True).mode("append").csv(folder)


def test_versions_of_a_table(spark, tmp_path):
    run = Landing(spark, str(tmp_path / "landing"), str(tmp_path / "lake"), 10)
    folder, path = f"{run.landing}/contractor_a", f"{run.base}/bronze/works_orders_a"
    hints = schemas.struct(id=schemas.TEXT, cost=schemas.NUMBER)

    def land(rows, *header):
        deliver(spark, folder, rows, header)
        return {r.id: r for r in run.widened_csv("works_orders_a", hints, []).collect()}

    first = land([("a", "1", "5", None), ("b", "x", "6", None)], "id", "cost", "crew", "note")
    assert (first["a"].crew, first["a"].note, first["b"].cost) == (5, None, None)
    assert first["b"][RESCUE] == '{"cost":"x"}' and first["a"][RESCUE] is None
    second = land([("2.50", "c"), (None, "d")], "crew", "id")
    assert [second[k].crew for k in "abcd"] == [Decimal(5), Decimal(6), Decimal("2.5"), None]
    assert second["c"].cost is None
    third = land([("e", "3", "six", "2024-01-31", "t")], "id", "cost", "crew", "note", "new")
    assert [third[k].crew for k in "abcde"] == ["5", "6", "2.5", None, "six"]
    assert [third[k].note for k in "ae"] == [None, dt.date(2024, 1, 31)]
    fourth = land([("f", "3", "7", "2024-02-01")], "id", "cost", "crew", "note")
    assert fourth["f"].crew == "7" and fourth["f"].new is None and fourth["e"].new == "t"

    log = {(r.version, r.column_name): (r.change, r.type_before, r.type_after) for r in versions.version_log(spark, path).collect()}
    assert log[1, "crew"] == ("widened", "bigint", "decimal(38,2)")
    assert log[2, "crew"] == ("widened", "decimal(38,2)", "string")
    assert log[2, "new"] == ("new", None, "string")
    assert len(versions.versions(spark, path)) == 3, "the fourth delivery needed no new version"
    before = versions.read_widened(spark, path, up_to=1)
    assert dict(before.dtypes)["crew"] == "decimal(38,2)" and before.count() == 4
    assert run.widened_csv("works_orders_a", hints, []).count() == 6, "a run without new files adds nothing"


def test_a_batch_that_is_run_again_is_there_once(spark, tmp_path):
    path = str(tmp_path / "table")
    for _ in range(2):
        before = versions.newest(spark, path)
        rows = widen.typed(spark.createDataFrame([("1", None), ("2", "broken")], f"n string, {RESCUE} string"), schemas.struct(), before)
        rows.write.mode("overwrite").parquet(f"{path}/{flows.BATCH}=0")
        versions.log_schema(spark, path, 0, rows.schema)
    assert {r.n: r[RESCUE] for r in versions.read_widened(spark, path).collect()} == {1: None, 2: "broken"}


def test_no_batch(spark, tmp_path):
    assert versions.versions(spark, str(tmp_path / "none")) == []
    assert versions.newest(spark, str(tmp_path / "none")) is None
    with pytest.raises(ValueError, match="no batch"):
        versions.read_widened(spark, str(tmp_path / "none"))


def test_readers_merge_no_footers(spark, tmp_path):
    """The schema comes from the notes; tables from before they were kept are read as they were."""
    path = str(tmp_path / "table")
    batches = [spark.range(2).withColumn("x", F.lit("a")), spark.range(3).withColumn("y", F.lit(1.5))]
    for number, df in enumerate(batches):
        df.write.parquet(f"{path}/{flows.BATCH}={number}")
    assert flows.batch_table(spark, path).count() == 5 and versions.merged(spark, path) is None
    for number, df in reversed(list(enumerate(batches))):
        versions.log_schema(spark, path, number, df.schema)
        if number:
            assert versions.merged(spark, path) is None, "a batch without a note"
    table = flows.batch_table(spark, path)
    assert table.columns == ["id", "x", "y"] and table.count() == 5
    assert "mergeschema" not in table._jdf.queryExecution().analyzed().toJSON().lower()
