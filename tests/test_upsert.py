from datetime import datetime, timedelta, timezone

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tapeloom.functions.placement import FIRST_DAY, LAST_DAY, day, day_of, symbol_bucket
from tapeloom.functions.clock import MS_PER_DAY
from tapeloom.operators import reads
from tapeloom.operators.upsert import TTL_SECONDS, latest, live

COLUMNS = "symbol string, timestamp long, price double, batch_id long, src_partition int, src_offset long, pos int"


def test_last_write_wins(spark):
    rows = [
        ("same_array", 1, 1.0, 0, 0, 5, 0),
        ("same_array", 1, 2.0, 0, 0, 5, 1),
        ("two_messages", 1, 2.0, 0, 0, 6, 0),
        ("two_messages", 1, 1.0, 0, 0, 5, 9),
        ("two_partitions", 1, 1.0, 0, 0, 9, 0),
        ("two_partitions", 1, 2.0, 0, 1, 2, 0),
        ("two_batches", 1, 1.0, 0, 7, 9, 9),
        ("two_batches", 1, 2.0, 1, 0, 0, 0),
        ("null_wins", 1, 1.0, 0, 0, 0, 0),
        ("null_wins", 1, None, 0, 0, 1, 0),
        ("other_time", 1, 1.0, 0, 0, 0, 0),
        ("other_time", 2, 2.0, 0, 0, 0, 1),
    ]
    for order in (rows, rows[::-1]):
        folded = latest(spark.createDataFrame(order, COLUMNS))
        assert folded.columns == [c.split()[0] for c in COLUMNS.split(", ")]
        got = {(r.symbol, r.timestamp): r.price for r in folded.collect()}
        assert got == {
            ("same_array", 1): 2.0,
            ("two_messages", 1): 2.0,
            ("two_partitions", 1): 2.0,
            ("two_batches", 1): 2.0,
            ("null_wins", 1): None,
            ("other_time", 1): 1.0,
            ("other_time", 2): 2.0,
        }


cell = st.tuples(
    st.sampled_from(["a", "b"]),
    st.integers(0, 2),
    st.one_of(st.none(), st.floats(0, 9)),
    st.integers(0, 2),
    st.integers(0, 1),
    st.integers(0, 3),
    st.integers(0, 1),
)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(cell, min_size=1, max_size=30, unique_by=lambda r: r[3:]))
def test_random_upserts(spark, rows):
    expected = {}
    for row in sorted(rows, key=lambda r: r[3:]):
        expected[row[:2]] = row
    got = latest(spark.createDataFrame(rows, COLUMNS)).collect()
    assert {tuple(r)[:2]: tuple(r) for r in got} == expected


def test_one_key_with_most_rows_is_reduced_before_the_shuffle(spark):
    rows = spark.range(200_000).select(
        F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("s"), "id")).alias("symbol"),
        F.lit(1).cast("long").alias("timestamp"),
        F.col("id").cast("double").alias("price"),
        F.lit(0).cast("long").alias("batch_id"),
        F.lit(0).alias("src_partition"),
        F.col("id").alias("src_offset"),
        F.lit(0).alias("pos"),
    )
    folded = latest(rows)
    plan = folded._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_max") > plan.index("Exchange hashpartitioning")
    assert plan.count("Exchange hashpartitioning") == 1
    assert folded.where("symbol = 'hot'").first().price == 199_999.0
    assert folded.count() == 1 + 66_667


AS_OF = datetime(2024, 3, 31, 12, tzinfo=timezone.utc)


def test_lifetime(spark):
    now = int(AS_OF.timestamp() * 1_000_000)
    ttl = TTL_SECONDS * 1_000_000
    ages = {"fresh": 0, "just_live": ttl - 1, "exactly_30_days": ttl, "old": ttl + 1}
    rows = spark.createDataFrame([(n, 0, now - a) for n, a in ages.items()], "n string, timestamp long, ingest_us long")
    assert sorted(r.n for r in live(rows, AS_OF).collect()) == ["fresh", "just_live"]
    assert {r.n for r in live(rows, AS_OF + timedelta(microseconds=-1)).collect()} >= {"exactly_30_days"}
    assert [r.n for r in live(rows, AS_OF, ttl_seconds=1).collect()] == ["fresh"]
    assert live(rows).count() == 0
    with pytest.raises(ValueError):
        live(rows, datetime(2024, 1, 1))


@pytest.mark.parametrize("zone", ["America/New_York", "UTC"])
def test_lifetime_ignores_the_session_zone(spark, zone):
    # the 30 days before AS_OF hold a change of clocks in New York
    now = int(AS_OF.timestamp() * 1_000_000)
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        rows = spark.createDataFrame([(now - TTL_SECONDS * 1_000_000 + d,) for d in (0, 1)], "ingest_us long")
        assert live(rows, AS_OF).count() == 1
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_placement_is_bounded(spark):
    times = [0, 1, -1, MS_PER_DAY, -MS_PER_DAY, 2**63 - 1, -(2**63), 1_704_844_800_000]
    rows = spark.createDataFrame([(t,) for t in times], "timestamp long")
    days = [r[0] for r in rows.select(day()).collect()]
    assert days == [day_of(t) for t in times] == [0, 0, -1, 1, -1, LAST_DAY, FIRST_DAY, 19_732]
    # a later timestamp is never on an earlier day, so a range of one is a range of the other
    assert [day_of(t) for t in sorted(times)] == sorted(days)
    assert day_of((LAST_DAY + 1) * MS_PER_DAY - 1) == day_of((LAST_DAY + 5) * MS_PER_DAY) == LAST_DAY
    symbols = spark.range(1000).select(F.col("id").cast("string").alias("symbol"))
    assert {r[0] for r in symbols.select(symbol_bucket(4)).collect()} == {0, 1, 2, 3}


def test_reads(spark):
    rows = spark.createDataFrame([("a", t, float(t)) for t in range(20)] + [("b", 3, 0.0)], "symbol string, timestamp long, price double")
    assert [r.timestamp for r in reads.by_symbol(rows, "a", newest_first=True).collect()] == list(range(19, -1, -1))
    assert reads.by_symbol(rows, "b").count() == 1
    top = reads.newest(rows, "a", 3)
    assert [(r.timestamp, r["rank"]) for r in top.orderBy("rank").collect()] == [(19, 1), (18, 2), (17, 3)]
    assert "TakeOrderedAndProject" in top._jdf.queryExecution().executedPlan().toString()
    assert sorted(r.timestamp for r in reads.time_range(rows, "a", 3, 5).collect()) == [3, 4, 5]
    assert sorted(r.symbol for r in reads.at_timestamp(rows, 3).collect()) == ["a", "b"]


def test_newest_of_few_or_none(spark):
    rows = spark.createDataFrame([("a", 1, 1.0)], "symbol string, timestamp long, price double")
    assert reads.newest(rows, "nothing", 5).count() == 0
    assert reads.newest(rows, "a", 5).count() == 1
