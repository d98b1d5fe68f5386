from datetime import datetime, timezone

import pytest

from tapeloom.functions.placement import day
from tapeloom.plans.bucketed import BucketedTrades
from tapeloom.schemas import BUCKETED, TRADE_COLUMNS

DAY_MS = 86_400_000
AS_OF = datetime(2024, 3, 1, tzinfo=timezone.utc)
NOW_US = int(AS_OF.timestamp()) * 1_000_000
COLUMNS = [name for name in BUCKETED.fieldNames() if name != "day"]


def trades(spark, rows, batch=0, age_days=1):
    """Trades (symbol, timestamp, price) of one load, in their order."""
    values = [
        ("trade", None, p, s, t, 1.0, batch, 0, i, 0, NOW_US - age_days * DAY_MS * 1000)
        for i, (s, t, p) in enumerate(rows)
    ]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in BUCKETED if f.name != "day")
    return spark.createDataFrame(values, schema)


def shown(rows):
    return sorted(((r.symbol, r.timestamp, r.price) for r in rows.collect()), key=str)


@pytest.fixture
def table(spark, tmp_path):
    return BucketedTrades(spark, f"{tmp_path}/bucketed", buckets=8)


@pytest.fixture
def no_broadcast(spark):
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.maxMetadataStringLength": "5000"}
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


def test_the_last_write_wins(spark, table):
    first = trades(spark, [("A", 5, 1.0), ("A", 5, 2.0), ("B", DAY_MS, 3.0), ("C", 2 * DAY_MS, 4.0)])
    second = trades(spark, [("A", 5, None), ("B", DAY_MS + 1, 6.0)], batch=1)
    assert table.upsert(first, AS_OF) == [0, 1, 2]
    assert shown(table.live(AS_OF)) == [("A", 5, 2.0), ("B", DAY_MS, 3.0), ("C", 2 * DAY_MS, 4.0)]
    assert table.upsert(second, AS_OF) == [0, 1]
    after = [("A", 5, None), ("B", DAY_MS + 1, 6.0), ("B", DAY_MS, 3.0), ("C", 2 * DAY_MS, 4.0)]
    assert shown(table.live(AS_OF)) == sorted(after, key=str)
    # again, and out of order: nothing changes
    table.upsert(second, AS_OF)
    table.upsert(first, AS_OF)
    assert shown(table.live(AS_OF)) == sorted(after, key=str)


def test_loads_without_rows_and_repeated_rows(spark, table):
    assert table.live(AS_OF).columns == [*TRADE_COLUMNS, "day"] and table.live(AS_OF).count() == 0
    assert table.upsert(trades(spark, []), AS_OF) == [] and table.live(AS_OF).count() == 0
    table.upsert(trades(spark, [("A", 5, 1.0)] * 50), AS_OF)
    assert shown(table.live(AS_OF)) == [("A", 5, 1.0)]


def test_rows_expire(spark, table):
    table.upsert(trades(spark, [("A", 5, 1.0), ("B", DAY_MS, 2.0)], age_days=20), AS_OF)
    later = datetime(2024, 3, 20, tzinfo=timezone.utc)
    assert table.live(later).count() == 0
    table.upsert(trades(spark, [("A", 6, 3.0)], batch=1), later)
    assert shown(table.live(later)) == [("A", 6, 3.0)]
    assert table.expire(later) == [1]  # the other day has a live row
    assert shown(table.live(AS_OF)) == [("A", 6, 3.0)]


def test_stored_rows_are_not_shuffled(spark, table, no_broadcast):
    table.upsert(trades(spark, [("A", i * 1000, 1.0) for i in range(500)]), AS_OF)
    fresh = trades(spark, [("A", i * 500, 2.0) for i in range(500)], batch=1)
    merged = table._merge(fresh.withColumn("day", day()), [0])
    plan = merged._jdf.queryExecution().executedPlan().toString()
    lines = plan[plan.index("SortMergeJoin") :].splitlines()
    scan = next(i for i, line in enumerate(lines) if "FileScan" in line and "Bucketed: true" in line)
    assert not any("Exchange" in line for line in lines[1:scan])  # stored rows are the join's first side
    # nor are the new ones more than once, with as many buckets as shuffle partitions
    assert sum("Exchange" in line for line in plan.splitlines()) == 1
    assert merged.count() == 750


def test_a_bucket_is_a_file_and_a_hot_symbol_is_in_all(spark, table):
    table.upsert(trades(spark, [("hot", i, 1.0) for i in range(2000)] + [("cold", 1, 1.0)]), AS_OF)
    table.upsert(trades(spark, [("hot", i, 2.0) for i in range(1000)], batch=1), AS_OF)
    rows = table.live(AS_OF).where("symbol = 'hot'").selectExpr("input_file_name() as file")
    counts = [r["count"] for r in rows.groupBy("file").count().collect()]
    assert len(counts) == 8 and sum(counts) == 2000 and max(counts) < 400


def test_reads_of_keys(spark, table, no_broadcast):
    table.upsert(trades(spark, [(s, i * 3_600_000, float(i)) for s in "AB" for i in range(72)]), AS_OF)
    one = table.of_key("A", 30 * 3_600_000, AS_OF)
    assert shown(one) == [("A", 30 * 3_600_000, 30.0)]
    plan = one._jdf.queryExecution().executedPlan().toString()
    day_filters = plan[plan.index("PartitionFilters: ") :].split("]")[0]
    assert "day" in day_filters and ">= 1" in day_filters and "EqualTo(symbol,A)" in plan
    wanted = spark.createDataFrame([("B", 3_600_000), ("B", 3_600_000), ("C", 1)], "symbol string, timestamp long")
    assert shown(table.of_keys(wanted, AS_OF)) == [("B", 3_600_000, 1.0)]
    limit = table.newest(2, AS_OF)._jdf.queryExecution().executedPlan().toString()
    assert limit.index("WindowGroupLimit", limit.index("Exchange")) > 0  # in the tasks before the shuffle
    newest = sorted((r.symbol, r["rank"], r.price) for r in table.newest(2, AS_OF).collect())
    assert newest == [("A", 1, 71.0), ("A", 2, 70.0), ("B", 1, 71.0), ("B", 2, 70.0)]


def test_found_again_by_its_folder(spark, table):
    table.upsert(trades(spark, [("A", 5, 1.0), ("B", DAY_MS, 2.0)]), AS_OF)
    again = BucketedTrades(spark, table.root, buckets=8, name="bucketed_again")
    assert shown(again.live(AS_OF)) == [("A", 5, 1.0), ("B", DAY_MS, 2.0)]
    assert shown(again.live(AS_OF, (0, 10))) == [("A", 5, 1.0)]
