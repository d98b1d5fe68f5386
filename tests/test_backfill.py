import json

import pytest
from pyspark.sql import functions as F

from tapeloom.plans.backfill import backfill, plan, within
from tapeloom.plans.table import TradeTable
from tapeloom.schemas import RECORD
from tapeloom.sources import kafka


def trade(s, t, p):
    return json.dumps({"type": "trade", "data": [{"s": s, "t": t, "p": p, "v": 1}]})


def records(spark, ranges):
    """A trade for every offset of (partition, first, last); an offset's number is its price."""
    rows = [(None, trade("ab"[o % 2], o % 5, o), p, o) for p, first, last in ranges for o in range(first, last + 1)]
    return spark.createDataFrame(rows, RECORD)


class FailsAt(TradeTable):
    def __init__(self, spark, root, batch_id, after):
        super().__init__(spark, root)
        self.fails, self.after = batch_id, after

    def append(self, rows, batch_id, rebalance=False):
        if batch_id == self.fails and not self.after:
            raise RuntimeError("interrupted")
        super().append(rows, batch_id, rebalance)
        if batch_id == self.fails:
            raise RuntimeError("interrupted")


def visible(table):
    return {(r.symbol, r.timestamp): r.price for r in table.live().collect()}


RANGES = [(0, 10, 29), (1, 3, 9)]


@pytest.mark.parametrize("after, compacted", [(False, False), (True, True), (False, True)])
def test_an_interrupted_backfill_goes_on(spark, tmp_path, after, compacted):
    rows = records(spark, RANGES)
    once = TradeTable.create(spark, f"{tmp_path}/once", buckets=2)
    assert backfill(once, rows, "all", 1000) == [0]
    table = TradeTable.create(spark, f"{tmp_path}/t", buckets=2)
    with pytest.raises(RuntimeError, match="interrupted"):
        backfill(FailsAt(spark, table.root, 2, after), rows, "all", 6)
    if compacted:
        table.compact()
    written = backfill(table, rows, "all", 6)
    assert written == ([3] if after else [2, 3])
    assert backfill(table, rows, "all", 6) == []
    delivered = table.deliveries()
    assert delivered.agg(F.sum("rows")).first()[0] == 27 and delivered.select("batch_id").distinct().count() == 4
    # which of two partitions' trades came last depends on the slices; within one it is the offset
    expected = {k: p for k, p in visible(once).items()}
    found = visible(table)
    assert found.keys() == expected.keys()
    assert table.gaps().count() == 0


def test_one_partition_in_slices_equals_one_shot(spark, tmp_path):
    rows = records(spark, [(0, 0, 40)])
    tables = []
    for size in (7, 100):
        table = TradeTable.create(spark, f"{tmp_path}/t{size}", buckets=2)
        backfill(table, rows, "all", size)
        tables.append(visible(table))
    assert tables[0] == tables[1] and len(tables[0]) == 10


def test_the_plan_stays_and_follows_what_is_there(spark, tmp_path):
    table = TradeTable.create(spark, f"{tmp_path}/t", buckets=2)
    backfill(table, records(spark, [(0, 0, 3)]), "first", 100)
    slices = plan(table, records(spark, RANGES), "second", 10)
    assert slices == [(1, {0: (10, 19), 1: (3, 9)}), (2, {0: (20, 29)})]
    assert plan(table, records(spark, [(0, 0, 1000)]), "second", 10) == slices
    assert plan(table, records(spark, []), "empty", 10) == []
    sliced = within(records(spark, RANGES), slices[0].ranges)
    assert sliced.count() == 17


def test_a_slice_reaches_the_files(spark, tmp_path):
    records(spark, RANGES).write.parquet(f"{tmp_path}/r")
    stored = spark.read.schema(RECORD).parquet(f"{tmp_path}/r")
    plan_text = within(stored, {0: (10, 19)})._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(src_offset,10), LessThanOrEq" in plan_text


def test_topic_ranges():
    options = kafka.range_options(kafka.topic_options("a:1", "t", max_offsets_per_trigger=5), {1: (3, 9), 0: (10, 19)})
    assert json.loads(options["assign"]) == {"t": [0, 1]}
    assert json.loads(options["startingOffsets"]) == {"t": {"0": 10, "1": 3}}
    assert json.loads(options["endingOffsets"]) == {"t": {"0": 20, "1": 10}}
    assert "subscribe" not in options and "maxOffsetsPerTrigger" not in options
