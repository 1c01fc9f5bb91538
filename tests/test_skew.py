"""Operators that must stay exact when one key holds a third of the rows, against brute force."""

import datetime as dt
import random
from collections import Counter, defaultdict

import pytest

from sluiceway.config import Settings
from sluiceway.operators import dedup, layout, lookup, resolve
from sluiceway.plans import contractors, finance
from sluiceway.sources import files
from sluiceway.sources.schemas import INVOICE
from sluiceway.streaming import flows

random.seed(7)
HOT = [(0, random.randint(0, 50), i) for i in range(2000)]
COLD = [(random.randint(1, 900), random.randint(0, 50), i + 2000) for i in range(4000)]
ROWS = HOT + COLD + [(None, random.randint(0, 50), i + 6000) for i in range(200)]


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame(ROWS, "k int, v int, id int").repartition(5)


def firsts():
    best = {}
    for k, v, i in ROWS:
        best[k] = min(best.get(k, (v, i)), (v, i))
    return best


def test_keep_first(df):
    got = {r.k: (r.v, r.id) for r in dedup.keep_first(df, ["k"], ["v", "id"]).collect()}
    assert got == firsts()


def test_keep_first_thins_out_before_the_shuffle(df):
    plan = dedup.keep_first(df, ["k"], ["v", "id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert plan.index("Exchange hashpartitioning(k") < plan.rindex("WindowGroupLimit")


@pytest.mark.parametrize("salts", [1, 3, 64])
def test_flag_duplicates(df, salts):
    flagged = dedup.flag_duplicates(df, ["k"], ["v", "id"], ["id"], salts).collect()
    assert Counter((r.k, r.v, r.id) for r in flagged) == Counter(ROWS)
    assert {r.k: (r.v, r.id) for r in flagged if not r.is_duplicate} == firsts()
    assert sum(not r.is_duplicate for r in flagged) == len(firsts())


def test_flag_duplicates_among_exact_copies(spark):
    copies = spark.createDataFrame([("s", 1)] * 500 + [("t", 1), ("t", 2), ("t", 1)], "k string, v int").repartition(4)
    flagged = dedup.flag_duplicates(copies, ["k"], ["v"], ["v"], 8).collect()
    assert Counter((r.k, r.is_duplicate) for r in flagged) == {("s", True): 499, ("s", False): 1, ("t", True): 2, ("t", False): 1}


def test_hot_key_is_spread_over_tasks(spark, df):
    """No task of the first window holds the hot key alone, and few rows of it meet in the second."""
    from pyspark.sql import functions as F

    lanes = df.where("k = 0").groupBy(F.pmod(F.xxhash64("id"), F.lit(64))).count().agg(F.max("count")).collect()[0][0]
    assert lanes < len(HOT) / 16


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("salts", [1, 7])
def test_lookup_is_the_same_by_every_way(spark, df, how, salts):
    dimension = spark.createDataFrame([(k, f"n{k}") for k in range(0, 900, 2)], "key int, name string")
    names = {k: f"n{k}" for k in range(0, 900, 2)}
    got = lookup.lookup(df, dimension, "k", "key", how, ["id"], salts)
    assert got.columns == ["k", "v", "id", "name"]
    expected = Counter((k, v, i, names.get(k)) for k, v, i in ROWS if how == "left" or k in names)
    assert Counter(tuple(r) for r in got.collect()) == expected


def test_streamed_orders_broadcast_only_counted_zones(spark, tmp_path):
    schema = "work_order_id string, zone string, description string, contractor_source string, completion_date date, cost double"
    rows = [(str(i), "hot" if i % 3 == 0 else f"z{i % 5}", None, "a", None, float(i)) for i in range(60)]
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "src"))
    zones = spark.createDataFrame([("H", "hot", True), ("1", "z1", True), ("2", "z2", False)], "zone_id string, zone_name string, is_current boolean")
    results = []
    for limit in (1000, 1):
        stream = files.stored_files(spark, str(tmp_path / "src"), stream=True)
        assert lookup.fits(zones.where("is_current"), limit) == (limit == 1000)
        joined = contractors.with_zone_id(stream, zones, Settings(as_of=dt.date(2024, 6, 1), processed_at=dt.datetime(2024, 6, 1), lanes=4, dimension_bytes=limit))
        assert ("strategy=broadcast" in joined._jdf.queryExecution().analyzed().toString()) == (limit == 1000)
        out = flows.run_available(joined, str(tmp_path / f"out{limit}"), str(tmp_path / f"check{limit}"))
        results.append(sorted((r.work_order_id, r.zone_id or "") for r in out.collect()))
    assert results[0] == results[1] and len(results[0]) == 60
    assert dict(results[0])["0"] == "H" and dict(results[0])["2"] == ""


def test_vote(spark):
    rows = [(k, f"z{v % 7}") for k, v, _ in ROWS]
    counts = defaultdict(Counter)
    for k, z in rows:
        if k is not None:
            counts[k][z] += 1
    expected = {}
    for k, c in counts.items():
        top = min(c.items(), key=lambda item: (-item[1], item[0]))
        expected[k] = (top[0], sum(c.values()))
    votes = resolve.votes(spark.createDataFrame(rows, "k int, zone string"), "k", "zone")
    got = {r.k: r for r in resolve.resolve(votes, "k", "zone", 80).collect()}
    assert {k: r.resolved_zone for k, r in got.items()} == {k: z for k, (z, _) in expected.items()}
    for k, r in got.items():
        assert abs(r.confidence_pct - 100 * counts[k][r.resolved_zone] / expected[k][1]) < 0.0051


def test_vote_needs_no_window_and_no_join(spark):
    df = spark.createDataFrame([(1, "a")], "k int, zone string")
    plan = resolve.resolve(resolve.votes(df, "k", "zone"), "k", "zone", 80)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Join" not in plan
    assert plan.count("Exchange hashpartitioning") == 2


def test_one_invoice_with_a_third_of_all_lines(spark):
    line = lambda n: (n, "Labour", 1, 1.0)
    big = ("hot", "2024-01-01", "C", "SGD", "Zone A", "P", ("v", "V"), [line(n) for n in range(1, 3001)])
    small = [(str(i), "2024-01-01", "C", "SGD", "Zone B", "P", ("v", "V"), [line(1), line(2)]) for i in range(3000)]
    records = spark.createDataFrame([big, *small], INVOICE)
    lines = finance.line_items(records)
    mart = finance.spend_by_zone_month(lines, finance.incoming_invoices(records))
    assert {r.site_zone: (r.total_spend, r.line_item_count) for r in mart.collect()} == {"Zone A": (3000.0, 3000), "Zone B": (6000.0, 6000)}
    plan = mart._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join Inner") < plan.index("Aggregate [invoice_id")


def test_clustering_cuts_a_hot_key_into_several_ranges(spark, df):
    from pyspark.sql import functions as F

    placed = layout.cluster_rows(df, ["k"], ["id"], 6).withColumn("p", F.spark_partition_id())
    per_partition = {r.p: r["count"] for r in placed.where("k = 0").groupBy("p").count().collect()}
    assert len(per_partition) >= 2
    assert placed.count() == len(ROWS)


def test_gathering_cuts_a_hot_key_into_lanes_without_sampling(spark, df):
    from pyspark.sql import functions as F

    gathered = layout.gather_rows(df, ["k"], ["id"], 16)
    assert "hashpartitioning" in gathered._jdf.queryExecution().executedPlan().toString()
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        hot = gathered.withColumn("p", F.spark_partition_id()).where("k = 0")
        assert len({r.p for r in hot.collect()}) >= 4
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert Counter((r.k, r.v, r.id) for r in gathered.collect()) == Counter(ROWS)
