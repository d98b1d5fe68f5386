import os
import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tapeloom.functions.clock import MS_PER_DAY, instant_us
from tapeloom.functions.placement import day, day_of
from tapeloom.operators import decode as d
from tapeloom.operators import reads
from tapeloom.operators.upsert import latest, live
from tapeloom.plans.table import TradeTable
from tapeloom.schemas import RECORD, TRADE_COLUMNS

DAY0 = 1_704_844_800_000
WRITTEN = datetime(2024, 1, 20, tzinfo=timezone.utc)
AS_OF = WRITTEN + timedelta(hours=1)


def trade(symbol, t, price):
    return f'{{"s":{symbol},"t":{t},"p":{price},"v":1}}'


def classified(spark, trades, written=WRITTEN, first_offset=0):
    """One message a trade; a trade is (symbol, timestamp, price)."""
    values = [
        f'{{"type":"trade","data":[{trade("null" if s is None else chr(34) + s + chr(34), t, p)}]}}'
        for s, t, p in trades
    ]
    stored = F.explode(F.array(*[F.struct(F.lit(v), F.lit(first_offset + i)) for i, v in enumerate(values)]))
    rows = spark.range(1, numPartitions=1).select(stored.alias("r")).selectExpr(
        "cast(null as string) key", "r.col1 value", "0 src_partition", "cast(r.col2 as long) src_offset"
    )
    return d.classify(rows).withColumn("ingest_us", instant_us(written))


def visible(table, as_of=AS_OF):
    rows = table.live(as_of).collect()
    found = {(r.symbol, r.timestamp): r.price for r in rows}
    assert len(found) == len(rows)
    return found


def plan_of(frame):
    mode = frame.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return frame._jdf.queryExecution().explainString(mode)


@pytest.fixture
def table(spark, tmp_path):
    return TradeTable.create(spark, f"{tmp_path}/t", buckets=4)


def files_of(table, *parts):
    return sorted(
        os.path.join(folder, name)
        for folder, _, names in os.walk(os.path.join(table.root, *parts))
        for name in names
        if name.endswith(".parquet")
    )


def test_create_is_idempotent(spark, tmp_path):
    first = TradeTable.create(spark, f"{tmp_path}/t", ttl_seconds=60, buckets=4)
    first.append(classified(spark, [("a", DAY0, 1)]), 0)
    again = TradeTable.create(spark, f"{tmp_path}/t", ttl_seconds=99, buckets=8)
    assert (again.ttl_seconds, again.buckets) == (60, 4)
    assert visible(again, WRITTEN) == {("a", DAY0): 1.0}


def test_empty_table(table):
    assert visible(table) == {}
    assert table.compact(AS_OF) == []
    assert table.live().columns[:6] == TRADE_COLUMNS
    assert table.dead_letters().count() == table.quarantined().count() == table.deliveries().count() == 0
    assert table.gaps().count() == 0


def test_upsert_over_log_and_stored(spark, table):
    table.append(classified(spark, [("a", DAY0, 1), ("b", DAY0, 1), ("a", DAY0, 2)]), 0)
    assert visible(table) == {("a", DAY0): 2.0, ("b", DAY0): 1.0}
    assert table.compact(AS_OF) == [day_of(DAY0)]
    assert visible(table) == {("a", DAY0): 2.0, ("b", DAY0): 1.0}
    table.append(classified(spark, [("a", DAY0, "null"), ("c", DAY0, 3)]), 1)
    expected = {("a", DAY0): None, ("b", DAY0): 1.0, ("c", DAY0): 3.0}
    assert visible(table) == expected
    assert table.compact(AS_OF) == [day_of(DAY0)]
    assert visible(table) == expected
    assert table.compact(AS_OF) == []
    assert visible(table) == expected


def test_another_session_finds_what_lies_there(spark, table):
    """A catalog that forgets, as a session's own does, is filled again from the folders."""
    table.append(classified(spark, [("a", DAY0, 1), ("b", DAY0, 1)]), 0)
    table.compact(AS_OF)
    table.append(classified(spark, [("a", DAY0, 2)]), 1)
    again = TradeTable(spark, table.root, "other_name")
    assert visible(again) == visible(table) == {("a", DAY0): 2.0, ("b", DAY0): 1.0}
    with pytest.raises(ValueError, match="checkpoint"):
        again.append(classified(spark, [("a", DAY0, 3)]), 0)


def test_all_kinds_are_kept(spark, table):
    rows = classified(spark, [("a", DAY0, 1), (None, DAY0, 2), ("", DAY0, 3)])
    dead = d.classify(spark.createDataFrame([(None, "junk", 0, 9)], RECORD))
    table.append(rows.unionByName(dead.withColumn("ingest_us", instant_us(WRITTEN))), 0)
    assert visible(table) == {("a", DAY0): 1.0}
    assert sorted(r.reason for r in table.quarantined().collect()) == ["empty_symbol", "missing_symbol"]
    assert [(r.reason, r.value, r.src_offset) for r in table.dead_letters().collect()] == [("not_decodable", "junk", 9)]
    assert table.batch(0).columns == TRADE_COLUMNS and table.batch(0).count() == 1

    def reports():
        return (
            sorted(tuple(r) for r in table.deliveries().collect()),
            sorted(map(str, table.quarantined().collect())),
            sorted(map(str, table.dead_letters().collect())),
        )

    before = reports()
    assert table.has_batch(0) and not table.has_batch(1)
    assert before[0] == [(0, 0, "bad_key", 2, 1, 2), (0, 0, "dead_letter", 1, 9, 9), (0, 0, "trade", 1, 0, 0)]
    table.compact(AS_OF)
    assert reports() == before
    assert table.has_batch(0) and not os.path.exists(f"{table.root}/log/batch_id=0")
    with pytest.raises(ValueError, match="checkpoint"):
        table.append(rows, -1)
    # a replay of the last batch after it was compacted changes nothing
    table.append(rows.unionByName(dead.withColumn("ingest_us", instant_us(WRITTEN))), 0)
    assert reports() == before and visible(table) == {("a", DAY0): 1.0}


def test_replay_replaces(spark, table):
    table.append(classified(spark, [("a", DAY0, 1), ("b", DAY0, 1)]), 0)
    table.append(classified(spark, [("a", DAY0, 2)]), 0)
    assert visible(table) == {("a", DAY0): 2.0}
    assert [r.rows for r in table.deliveries().collect()] == [1]
    table.compact(AS_OF)
    table.append(classified(spark, [("a", DAY0, 2)]), 0)
    assert visible(table) == {("a", DAY0): 2.0}


def test_batch_ids_must_not_go_back(spark, table):
    table.append(classified(spark, [("a", DAY0, 1)]), 3)
    with pytest.raises(ValueError, match="checkpoint"):
        table.append(classified(spark, [("b", DAY0, 1)]), 2)


def test_a_compacted_id_takes_no_other_rows(spark, table):
    table.append(classified(spark, [("a", DAY0, 1)]), 0)
    table.compact(AS_OF)
    with pytest.raises(ValueError, match="other rows"):
        table.append(classified(spark, [("b", DAY0, 1), ("c", DAY0, 1)]), 0)
    table.append(classified(spark, [("a", DAY0, 1)]), 0)
    assert visible(table) == {("a", DAY0): 1.0}


def test_create_again_after_a_crash(spark, tmp_path):
    os.makedirs(f"{tmp_path}/t/properties")
    assert TradeTable.create(spark, f"{tmp_path}/t", buckets=3).buckets == 3


class CutOff(TradeTable):
    """A compaction that is cut off where it would let the first, or some, batches go."""

    def __init__(self, spark, root, at):
        super().__init__(spark, root)
        self.at = at

    def _drop(self, part, **of):
        if part == "log":
            if self.at == 0:
                raise RuntimeError("cut off")
            self.at -= 1
        super()._drop(part, **of)


@pytest.mark.parametrize("at", [0, 1, 2])
def test_a_compaction_that_is_cut_off_is_run_again(spark, table, at):
    table.append(classified(spark, [("a", DAY0, 0), ("z", DAY0, 0)]), 0)
    table.compact(AS_OF)
    table.append(classified(spark, [("a", DAY0, 1), ("b", DAY0, 1), (None, DAY0, 9)]), 1)
    table.append(classified(spark, [("a", DAY0, 2), ("c", DAY0, 2)]), 2)
    table.append(classified(spark, [("a", DAY0, 3), ("b", DAY0, 3)]), 3)
    expected = {("a", DAY0): 3.0, ("b", DAY0): 3.0, ("c", DAY0): 2.0, ("z", DAY0): 0.0}
    with pytest.raises(RuntimeError, match="cut off"):
        CutOff(spark, table.root, at).compact(AS_OF)

    def state():
        delivered = sorted(tuple(r) for r in table.deliveries().collect())
        return visible(table), delivered, [r.reason for r in table.quarantined().collect()]

    cut = state()
    assert cut[0] == expected and len(cut[1]) == 5 and cut[2] == ["missing_symbol"]
    table.append(classified(spark, [("d", DAY0, 4)]), 4)
    table.compact(AS_OF)
    after = state()
    assert after[0] == expected | {("d", DAY0): 4.0}
    assert [r for r in after[1] if r[0] < 4] == cut[1] and after[2] == cut[2]


def test_a_rewrite_that_fails_leaves_the_old_days(spark, table):
    table.append(classified(spark, [("a", DAY0, 1), ("b", DAY0 + MS_PER_DAY, 1)]), 0)
    table.compact(AS_OF)
    before = files_of(table, "stored")
    table.append(classified(spark, [("a", DAY0, 2), ("b", DAY0 + MS_PER_DAY, 2)]), 1)
    merge = table._merge
    # fails while the rows are written, when one of two days may be written already
    table._merge = lambda *a: merge(*a).withColumn(
        "price", F.when(F.col("symbol") == "b", F.raise_error("worker gone").cast("double")).otherwise(F.col("price"))
    )
    with pytest.raises(Exception, match="worker gone"):
        table.compact(AS_OF)
    del table._merge
    assert files_of(table, "stored") == before
    assert visible(table) == {("a", DAY0): 2.0, ("b", DAY0 + MS_PER_DAY): 2.0}
    table.compact(AS_OF)
    assert visible(table) == {("a", DAY0): 2.0, ("b", DAY0 + MS_PER_DAY): 2.0}


def filters_of(plan):
    return [part.split("]\n")[0] for part in plan.split("PartitionFilters: [")[1:]]


def test_plain_ranges_of_the_view_prune_days(spark, table):
    days = [DAY0 + i * MS_PER_DAY for i in range(6)]
    table.append(classified(spark, [(s, t, 1) for s in "abcdefgh" for t in days]), 0)
    table.compact(AS_OF)
    table.register_view("trades", AS_OF)
    first, last = day_of(days[1]), day_of(days[2])
    found = spark.sql(f"select * from trades where day between {first} and {last} and symbol = 'a'")
    plan = plan_of(found)
    assert found.count() == 2 and found.columns == [*TRADE_COLUMNS, "day", "symbol_bucket"]
    scans = [f for f in filters_of(plan) if "symbol_bucket" in f]
    assert scans and all(f">= {first})" in f and f"<= {last})" in f for f in scans)
    # a range of timestamps alone reads no other day's rows either, by the files' statistics
    ranged = spark.sql(f"select * from trades where timestamp between {days[1]} and {days[2]}")
    assert ranged.count() == 16
    read = [n for name, n in scanned(ranged) if name.endswith("_stored")]
    assert sum(read) <= 2 * 16


def scanned(frame):
    """Rows that each scan of a collected frame has read, by the scanned table's name."""
    frame.collect()
    plan = frame._jdf.queryExecution().executedPlan()
    found, open_ = [], [plan]
    while open_:
        node = open_.pop()
        if node.nodeName() == "AdaptiveSparkPlan":
            open_.append(node.executedPlan())
            continue
        if hasattr(node, "plan") and "QueryStage" in node.nodeName():
            open_.append(node.plan())
            continue
        if node.nodeName().startswith("Scan parquet"):
            found.append((node.nodeName(), node.metrics().apply("numOutputRows").value()))
        children = node.children()
        open_.extend(children.apply(i) for i in range(children.length()))
    return found


def test_the_view_shows_what_came_after_it(spark, table):
    table.append(classified(spark, [("a", DAY0, 1), ("b", DAY0 + MS_PER_DAY, 1)]), 0)
    table.compact(AS_OF)
    table.register_view("trades", AS_OF)

    def shown():
        rows = spark.sql("select * from trades").collect()
        assert len(rows) == len({(r.symbol, r.timestamp) for r in rows})
        return {(r.symbol, r.timestamp): r.price for r in rows}

    assert shown() == visible(table)
    table.append(classified(spark, [("a", DAY0, 2), ("c", DAY0 + 5 * MS_PER_DAY, 2)]), 1)
    assert shown() == visible(table) == {("a", DAY0): 2.0, ("b", DAY0 + MS_PER_DAY): 1.0, ("c", DAY0 + 5 * MS_PER_DAY): 2.0}
    table.append(classified(spark, [("a", DAY0, 3)], WRITTEN - timedelta(days=30)), 2)
    assert shown() == visible(table)  # the last write has expired, and hides the row before it
    table.compact(AS_OF)
    assert shown() == visible(table) == {("b", DAY0 + MS_PER_DAY): 1.0, ("c", DAY0 + 5 * MS_PER_DAY): 2.0}
    table.register_view("trades")
    assert shown() == {}  # by the time of the query all has expired


def test_the_view_joins_touched_days_only(spark, table):
    days = [DAY0 + i * MS_PER_DAY for i in range(4)]
    table.append(classified(spark, [(s, t, 1) for s in "ab" for t in days]), 0)
    table.compact(AS_OF)
    table.append(classified(spark, [("a", days[3], 2)]), 1)
    table.register_view("trades", AS_OF)
    plan = plan_of(spark.sql("select * from trades"))
    assert "dynamicpruning" in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_sql_ranges_and_lists_prune_directories(spark, table):
    days = [DAY0 + i * MS_PER_DAY for i in range(6)]
    table.append(classified(spark, [(s, t, 1) for s in "abcdefgh" for t in days]), 0)
    table.compact(AS_OF)
    table.register_view("trades", AS_OF)
    between = spark.sql(f"select * from trades_between({days[1]}, {days[2]}) where symbol = 'a'")
    filters = [f for f in filters_of(plan_of(between)) if "symbol_bucket" in f]
    assert filters and all(str(day_of(days[1])) in f for f in filters)
    assert between.count() == 2 and between.columns == TRADE_COLUMNS
    several = spark.sql("select * from trades_of(array('a', 'b', 'zz'))")
    assert any("array_contains" in f and "symbol_bucket" in f for f in filters_of(plan_of(several)))
    assert several.count() == 12
    assert spark.sql(f"select * from trades_between({days[0]}, {days[5] + 400 * MS_PER_DAY})").count() == 48
    assert spark.sql(f"select * from trades_between({days[3]}, {days[1]})").count() == 0


def test_a_merge_shuffles_the_log_once(spark, table):
    table.append(classified(spark, [("a", DAY0, 1)]), 0)
    table.compact(AS_OF)
    table.append(classified(spark, [("a", DAY0, 2)]), 1)
    plan = plan_of(table.live(AS_OF))
    assert plan.count("Arguments: hashpartitioning(symbol") - plan.count("ReusedExchange") <= 2
    assert "log/batch_id=1" in plan and "log/batch_id=0" not in plan and "Window" not in plan


def test_expiry_counts_from_the_write(spark, table):
    old = WRITTEN - timedelta(days=30)
    table.append(classified(spark, [("old", DAY0, 1), ("renewed", DAY0, 1)], old), 0)
    table.append(classified(spark, [("fresh", 0, 1), ("renewed", DAY0, 2)]), 1)
    # an expired row hides the live one it replaced, also across log and versions
    table.append(classified(spark, [("late", DAY0, 1)]), 2)
    table.append(classified(spark, [("late", DAY0, 2)], old), 3)
    expected = {("fresh", 0): 1.0, ("renewed", DAY0): 2.0}
    assert visible(table, WRITTEN) == expected
    table.compact(WRITTEN)
    assert visible(table, WRITTEN) == expected
    assert visible(table, WRITTEN + timedelta(days=30)) == {}
    assert table.compact(WRITTEN + timedelta(days=30), full=True) == [0, day_of(DAY0)]
    assert visible(table, WRITTEN) == {}
    assert files_of(table, "stored") == []


def test_wholly_expired_days_are_let_go(spark, table):
    soon = DAY0 + MS_PER_DAY
    written = datetime.fromtimestamp(DAY0 / 1000, timezone.utc)
    table.append(classified(spark, [("a", DAY0, 1), ("b", DAY0, 1)], written), 0)
    table.append(classified(spark, [("b", soon, 1)], written + timedelta(days=1)), 1)
    table.append(classified(spark, [("late", DAY0 - 9 * MS_PER_DAY, 1)], written + timedelta(days=20)), 2)
    assert table.compact(written) == sorted({day_of(DAY0), day_of(soon), day_of(DAY0) - 9})
    later = written + timedelta(days=31)
    before = files_of(table, "stored")
    assert table.compact(later) == []
    # the day of a and b has gone; an older day with a later write stays
    assert len(files_of(table, "stored")) == len(before) - len({f for f in before if f"day={day_of(DAY0)}/" in f})
    assert set(visible(table, later)) == {("late", DAY0 - 9 * MS_PER_DAY)}
    table.append(classified(spark, [("c", DAY0, 1)], later), 3)
    table.compact(later)
    assert set(visible(table, later)) == {("late", DAY0 - 9 * MS_PER_DAY), ("c", DAY0)}


def test_expired_write_in_the_log_hides_a_live_row_of_the_version(spark, table):
    table.append(classified(spark, [("a", DAY0, 1)]), 0)
    table.compact(WRITTEN)
    table.append(classified(spark, [("a", DAY0, 2)], WRITTEN - timedelta(days=30)), 1)
    assert visible(table, WRITTEN) == {}
    table.compact(WRITTEN)
    assert visible(table, WRITTEN) == {}


def test_compaction_rewrites_only_touched_days(spark, table):
    days = [DAY0 + i * MS_PER_DAY for i in range(4)]
    table.append(classified(spark, [("a", t, 1) for t in days]), 0)
    table.compact(AS_OF)
    before = set(files_of(table, "stored"))
    assert len(before) == 4
    table.append(classified(spark, [("a", days[3], 2)]), 1)
    assert table.compact(AS_OF) == [day_of(days[3])]
    after = set(files_of(table, "stored"))
    assert len(after) == 4 and len(after & before) == 3
    assert not [name for name in os.listdir(f"{table.root}/log") if name.startswith("batch_id")]
    expected = {("a", t): 1.0 for t in days[:3]} | {("a", days[3]): 2.0}
    assert visible(table) == expected
    table.append(classified(spark, [("a", days[0], 3)]), 2)
    assert visible(table) == expected | {("a", days[0]): 3.0}


def test_odd_timestamps(spark, table):
    times = [DAY0, DAY0 + 64 * MS_PER_DAY, DAY0 - 64 * MS_PER_DAY, -5, -(10**12), 2**63 - 1, 10**17, -(2**63)]
    table.append(classified(spark, [("a", t, 1) for t in times]), 0)
    table.compact(AS_OF)
    assert visible(table) == {("a", t): 1.0 for t in times}
    for t in times:
        assert reads.at_timestamp(table.live(AS_OF), t).count() == 1
        assert reads.time_range(table.live(AS_OF), "a", t, t).count() == 1
    days = {p["day"] for p in table._partitions("stored")}
    assert {str(day_of(t)) for t in times} == days and {"-1", "47481"} < days
    assert table.live(AS_OF).where(day() != F.col("day")).count() == 0


def test_odd_symbols(spark, table):
    symbols = ["A/B", "BINANCE:BTCUSDT", "IC MARKETS:1", "007", "__HIVE_DEFAULT_PARTITION__", "é€𝄞", "%41", "x" * 5000]
    table.append(classified(spark, [(s, DAY0, i) for i, s in enumerate(symbols)]), 0)
    table.compact(AS_OF)
    assert visible(table) == {(s, DAY0): float(i) for i, s in enumerate(symbols)}
    for s in symbols:
        assert reads.by_symbol(table.live(AS_OF), s).count() == 1


def test_reads_prune_directories(spark, table):
    days = [DAY0 + i * MS_PER_DAY for i in range(4)]
    table.append(classified(spark, [(s, t, 1) for s in "abcdefgh" for t in days]), 0)
    table.compact(AS_OF)
    rows = table.live(AS_OF)
    by_symbol = plan_of(reads.by_symbol(rows, "a"))
    assert "(symbol_bucket" in by_symbol.split("PartitionFilters: [")[1].split("]")[0]
    assert "EqualTo(symbol,a)" in by_symbol and "GreaterThan(ingest_us," in by_symbol
    at = plan_of(reads.at_timestamp(rows, days[1]))
    assert "(day" in at.split("PartitionFilters: [")[1].split("]")[0]
    assert "EqualTo(timestamp," in at
    between = reads.time_range(rows, "a", days[1], days[2])
    assert between.count() == 2
    listed = table.live(AS_OF, between_ms=(days[1], days[2]))
    assert listed.count() == 16
    assert {f"day={day_of(days[1])}" in f or f"day={day_of(days[2])}" in f for f in listed.inputFiles()} == {True}
    assert f"<= {day_of(days[2])})" in plan_of(between).split("PartitionFilters: [")[1].split("]")[0]
    for plan in (by_symbol, at):
        assert "Exchange" not in plan and "Python" not in plan
    table.register_view("trades", AS_OF)
    found = spark.sql(f"select * from trades where symbol = 'a' and timestamp = {days[1]}")
    filters = [f for f in filters_of(plan_of(found)) if "symbol_bucket" in f]
    assert filters and all("(day" in f for f in filters) and found.count() == 1


def test_small_log_does_not_shuffle_the_version(spark, table):
    table.append(classified(spark, [(f"s{i}", DAY0, 1) for i in range(50)]), 0)
    table.compact(AS_OF)
    table.append(classified(spark, [("s1", DAY0, 2)]), 1)
    rows = table.live(AS_OF)
    rows.collect()
    plan = plan_of(rows)
    assert "BroadcastHashJoin LeftAnti" in plan
    assert visible(table)[("s1", DAY0)] == 2.0
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        assert "Broadcast" not in plan_of(table.live(AS_OF))
        assert visible(table) == {(f"s{i}", DAY0): 2.0 if i == 1 else 1.0 for i in range(50)}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_only_touched_days_are_joined(spark, table):
    days = [DAY0 + i * MS_PER_DAY for i in range(4)]
    table.append(classified(spark, [(s, t, 1) for s in "ab" for t in days]), 0)
    table.compact(AS_OF)
    table.append(classified(spark, [("a", days[3], 2), ("c", days[3], 2)]), 1)
    rows = table.live(AS_OF)
    plan = plan_of(rows)
    assert plan.count("Join type: LeftAnti") == 1
    scans = [f for f in filters_of(plan) if "symbol_bucket" in f]
    assert sorted(f"NOT (day" in f for f in scans) == [False, True] and all(str(day_of(days[3])) in f for f in scans)
    before = {(s, t): 1.0 for s in "ab" for t in days}
    assert visible(table) == before | {("a", days[3]): 2.0, ("c", days[3]): 2.0}
    assert "LeftAnti" not in plan_of(table.live(AS_OF, between_ms=(days[0], days[2])))
    table.compact(AS_OF)
    assert "LeftAnti" not in plan_of(table.live(AS_OF))


def test_kinds_are_never_null(spark):
    # a nullable kind would make the writer sort again
    rows = d.classify(spark.createDataFrame([(None, "x", 0, 1)], RECORD))
    assert not rows.schema["kind"].nullable


def test_a_hot_symbol_is_spread_over_files(spark, table):
    rows = spark.range(60_000).select(
        F.lit("trade").alias("message_type"),
        F.lit(None).cast("string").alias("condition"),
        F.rand(1).alias("price"),
        F.when(F.col("id") % 3 == 0, F.concat(F.lit("s"), F.col("id") % 50)).otherwise("hot").alias("symbol"),
        (F.lit(DAY0) + F.col("id")).alias("timestamp"),
        F.rand(2).alias("volume"),
        F.lit(0).alias("src_partition"),
        F.col("id").alias("src_offset"),
        F.lit(0).alias("pos"),
        F.lit(None).cast("string").alias("reason"),
        F.lit(None).cast("string").alias("value"),
        F.lit("trade").alias("kind"),
        instant_us(WRITTEN).alias("ingest_us"),
    )
    table.append(rows, 0)
    small = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256KB",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64KB",
    }
    before = {name: spark.conf.get(name) for name in small}
    for name, value in small.items():
        spark.conf.set(name, value)
    try:
        table.compact(AS_OF)
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    stored = spark.read.parquet(f"{table.root}/stored").where("symbol = 'hot'")
    assert stored.select(F.input_file_name()).distinct().count() > 1
    assert table.live(AS_OF).count() == 60_000


def test_random_splits_give_the_same_table(spark, tmp_path):
    random.seed(7)
    trades = [(random.choice("abc"), DAY0 + random.randrange(6) * MS_PER_DAY // 2, i) for i in range(60)]
    expected = {(s, t): float(p) for s, t, p in trades}
    for run in range(2):
        table = TradeTable.create(spark, f"{tmp_path}/t{run}", buckets=2)
        cuts = sorted(random.sample(range(1, 60), 3))
        for batch_id, (first, last) in enumerate(zip([0] + cuts, cuts + [60])):
            table.append(classified(spark, trades[first:last], first_offset=first), batch_id, rebalance=random.random() < 0.5)
            if random.random() < 0.5:
                table.compact(AS_OF, full=random.random() < 0.3)
        assert visible(table) == expected


def test_the_table_equals_the_plain_operators(spark, table):
    trades = [("a", DAY0, 1), ("b", DAY0, 2), ("a", DAY0, 3), ("c", DAY0, 4)]
    rows = classified(spark, trades).withColumn("batch_id", F.lit(0).cast("long"))
    plain = live(latest(d.keyed_trades(rows)), AS_OF).select(*TRADE_COLUMNS)
    table.append(classified(spark, trades), 0)
    table.compact(AS_OF)
    assert sorted(map(str, plain.collect())) == sorted(map(str, table.live(AS_OF).select(*TRADE_COLUMNS).collect()))


def test_a_table_of_symbols_prunes_buckets(spark, table, tmp_path):
    symbols = [f"s{i}" for i in range(40)]
    table.append(classified(spark, [(s, DAY0 + i % 3 * MS_PER_DAY, i) for i, s in enumerate(symbols)]), 0)
    table.compact(AS_OF)
    spark.createDataFrame([("s3",), ("s3",), ("nobody",), (None,)], "symbol string").write.parquet(f"{tmp_path}/w")
    wanted = spark.read.parquet(f"{tmp_path}/w")
    found = table.of_symbols(wanted, AS_OF)
    plan = plan_of(found)
    assert "dynamicpruning" in plan and "Python" not in plan
    assert [(r.symbol, r.price) for r in found.collect()] == [("s3", 3.0)]
    semi = table.live(AS_OF).join(wanted.distinct(), "symbol", "left_semi")
    assert found.count() == semi.count() == 1
    # only the wanted symbols' buckets are read
    of_bucket = table.live(AS_OF).where("symbol in ('s3', 'nobody')").select("symbol_bucket").distinct()
    held = table.live(AS_OF).join(of_bucket, "symbol_bucket", "left_semi").count()
    assert sum(n for name, n in scanned(found) if name.endswith("_stored")) <= held + 10 < 40
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        assert table.of_symbols(wanted, AS_OF).count() == 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_lookups_skip_row_groups_by_bloom_filters(spark, tmp_path):
    """Many row groups, each of which spans the whole day: statistics alone leave none out."""
    rows = spark.range(60_000).select(
        F.lit("trade").alias("message_type"),
        F.lit(None).cast("string").alias("condition"),
        F.col("id").cast("double").alias("price"),
        F.concat(F.lit("s"), F.col("id") % 20).alias("symbol"),
        (F.lit(DAY0) + (F.col("id") * 7919) % 86_000_000).alias("timestamp"),
        F.lit(1.0).alias("volume"),
        F.lit(0).alias("src_partition"),
        F.col("id").alias("src_offset"),
        F.lit(0).alias("pos"),
        F.lit(None).cast("string").alias("reason"),
        F.lit(None).cast("string").alias("value"),
        F.lit("trade").alias("kind"),
        instant_us(WRITTEN).alias("ingest_us"),
    )
    wanted = DAY0 + (31_234 * 7919) % 86_000_000
    hadoop = spark._jsc.hadoopConfiguration()
    hadoop.set("parquet.block.size", str(64 * 1024))
    try:
        table = TradeTable.create(spark, f"{tmp_path}/t", buckets=2)
        table.append(rows, 0)
        table.compact(AS_OF)
    finally:
        hadoop.unset("parquet.block.size")
    found = reads.at_timestamp(table.live(AS_OF), wanted)
    assert [(r.symbol, r.price) for r in found.collect()] == [("s14", 31_234.0)]
    read = sum(n for _, n in scanned(found))
    assert 1 <= read < 10_000
    before = hadoop.get("parquet.filter.bloom.enabled")
    hadoop.set("parquet.filter.bloom.enabled", "false")
    try:
        plain = reads.at_timestamp(table.live(AS_OF), wanted)
        assert plain.count() == 1 and sum(n for _, n in scanned(plain)) > 3 * read
    finally:
        hadoop.set("parquet.filter.bloom.enabled", before or "true")
