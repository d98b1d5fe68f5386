import json
import os
import random
import time
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from tapeloom.operators import decode as d
from tapeloom.operators.publish import trade_records
from tapeloom.plans.table import TradeTable
from tapeloom.schemas import TRADE, TRADE_COLUMNS
from tapeloom.sources import files
from tapeloom.sources.kafka import topic_records
from tapeloom.streaming import job, sinks
from tapeloom.streaming.audit import DeliveryAudit

ONCE = {"availableNow": True}


def add_file(spark, folder, values, first_offset, partition=0):
    """One more file of stored topic rows."""
    rows = [(bytearray(b"d"), v and bytearray(v, "utf-8"), "t", partition, first_offset + i) for i, v in enumerate(values)]
    frame = spark.createDataFrame(rows, "key binary, value binary, topic string, partition int, offset long")
    frame.withColumn("timestamp", F.current_timestamp()).coalesce(1).write.mode("append").parquet(folder)
    time.sleep(0.05)  # the stream takes files in the order of their times


def trade(s, t, p):
    return json.dumps({"type": "trade", "data": [{"s": s, "t": t, "p": p, "v": 1}]})


@pytest.fixture
def topic(spark, tmp_path):
    folder = f"{tmp_path}/topic"
    add_file(spark, folder, [trade("a", 1, 1), trade("b", 1, 1), '{"type":"ping"}'], 0)
    add_file(spark, folder, [trade("a", 1, 2), "junk"], 3)
    add_file(spark, folder, [trade("c", 1, 3), trade(None, 1, 4)], 5)
    return folder


EXPECTED = {("a", 1): 2.0, ("b", 1): 1.0, ("c", 1): 3.0}


def records(spark, folder, max_files=1):
    return topic_records(files.stream_parquet(spark, folder, max_files_per_trigger=max_files))


def visible(table):
    return {(r.symbol, r.timestamp): r.price for r in table.live().collect()}


def batches(table):
    return sorted({r.batch_id for r in table.deliveries().collect()})


def test_batches_into_the_table(spark, topic, tmp_path):
    table = TradeTable.create(spark, f"{tmp_path}/t", buckets=2)
    query = sinks.table_sink(records(spark, topic), table, f"{tmp_path}/c", ONCE).start()
    job.wait([query])
    assert visible(table) == EXPECTED
    assert batches(table) == [0, 1, 2]
    observed = [dict(p.observedMetrics["delivered"].asDict()) for p in query.recentProgress if p.observedMetrics]
    totals = [sum(o[n] for o in observed) for n in ("trades", "bad_keys", "dead_letters")]
    assert totals == [4, 1, 1]
    assert [r.value for r in table.dead_letters().collect()] == ["junk"]
    assert [r.reason for r in table.quarantined().collect()] == ["missing_symbol"]

    # nothing new: no batch, no change
    job.wait([sinks.table_sink(records(spark, topic), table, f"{tmp_path}/c", ONCE).start()])
    assert batches(table) == [0, 1, 2]

    # more records after a compaction
    table.compact()
    add_file(spark, topic, [trade("a", 1, 9)], 7)
    job.wait([sinks.table_sink(records(spark, topic), table, f"{tmp_path}/c", ONCE).start()])
    assert visible(table) == EXPECTED | {("a", 1): 9.0}
    assert batches(table) == [0, 1, 2, 3]

    # the same files as a batch
    stored = topic_records(files.read_parquet(spark, topic))
    assert d.decode(stored).count() == 6

    # a lost checkpoint is noticed, not written over
    with pytest.raises(Exception, match="was the stream's checkpoint lost"):
        job.wait([sinks.table_sink(records(spark, topic), table, f"{tmp_path}/c2", ONCE).start()])
    assert visible(table) == EXPECTED | {("a", 1): 9.0}


class FailsOnce(TradeTable):
    def append(self, rows, batch_id, rebalance=False):
        super().append(rows, batch_id, rebalance)
        if batch_id == 1:
            raise RuntimeError("lost after the write")


def test_restart_after_a_lost_batch(spark, topic, tmp_path):
    table = TradeTable.create(spark, f"{tmp_path}/t", buckets=2)
    failing = FailsOnce(spark, table.root)
    with pytest.raises(Exception, match="lost after the write"):
        job.wait([sinks.table_sink(records(spark, topic), failing, f"{tmp_path}/c", ONCE).start()])
    written = table._read("log").where("batch_id = 1").select("ingest_us").distinct().collect()
    before = sorted(map(str, table.deliveries().collect()))
    table.compact()
    job.wait([sinks.table_sink(records(spark, topic), table, f"{tmp_path}/c", ONCE).start()])
    assert visible(table) == EXPECTED
    assert table._read("log").where("kind = 'trade'").count() == 1  # the replay was compacted already
    assert [r for r in sorted(map(str, table.deliveries().collect())) if "batch_id=2" not in r] == before
    # the write time belongs to the batch, so a replay of what is still in the log has the same
    again = TradeTable.create(spark, f"{tmp_path}/t2", buckets=2)
    with pytest.raises(Exception, match="lost after the write"):
        job.wait([sinks.table_sink(records(spark, topic), FailsOnce(spark, again.root), f"{tmp_path}/c2", ONCE).start()])
    written = again._read("log").where("batch_id = 1").select("ingest_us").distinct().collect()
    job.wait([sinks.table_sink(records(spark, topic), again, f"{tmp_path}/c2", ONCE).start()])
    assert again._read("log").where("kind = 'trade'").count() == 4
    assert again._read("log").where("batch_id = 1").select("ingest_us").distinct().collect() == written


def test_write_time_is_the_batch_time(spark, topic, tmp_path):
    before = datetime.now(timezone.utc).timestamp()
    table = TradeTable.create(spark, f"{tmp_path}/t", buckets=2)
    job.wait([sinks.table_sink(records(spark, topic), table, f"{tmp_path}/c", ONCE).start()])
    after = datetime.now(timezone.utc).timestamp()
    times = [r.ingest_us / 1e6 for r in table._read("log").select("batch_id", "ingest_us").distinct().collect()]
    assert len(times) == 3 and all(before - 1 <= t <= after for t in times)


def test_the_job_reads_its_source_once(spark, topic, tmp_path, capsys):
    table = TradeTable.create(spark, f"{tmp_path}/t", buckets=2)
    queries = job.start(records(spark, topic, None), table, f"{tmp_path}/c", preview_rows=5, trigger=ONCE, rebalance=True)
    job.wait(queries)
    assert len(queries) == 1 and not queries[0].isActive
    assert sum(p.numInputRows for p in queries[0].recentProgress) == 7
    assert capsys.readouterr().out.count("message_type") == 1
    assert visible(table) == EXPECTED


def test_preview_from_the_written_batch(spark, topic, tmp_path, capsys):
    table = TradeTable.create(spark, f"{tmp_path}/t", buckets=2)
    job.wait([sinks.table_sink(records(spark, topic), table, f"{tmp_path}/c", ONCE, preview_rows=5).start()])
    shown = capsys.readouterr().out
    assert shown.count("message_type") == 3


def test_the_failure_of_any_query_is_raised_and_stops_all(spark, topic, tmp_path):
    table = TradeTable.create(spark, f"{tmp_path}/t", buckets=2)
    source = records(spark, topic)
    going_on = sinks.console_sink(d.decode(source), f"{tmp_path}/c1", trigger={"processingTime": "1 second"}).start()
    failing = sinks.table_sink(source, FailsOnce(spark, table.root), f"{tmp_path}/c2", ONCE).start()
    with pytest.raises(Exception, match="lost after the write"):
        job.wait([going_on, failing])
    assert not going_on.isActive


def test_bad_keys_can_be_refused(spark, topic, tmp_path):
    table = TradeTable.create(spark, f"{tmp_path}/t", buckets=2)
    with pytest.raises(Exception, match="trade without key at offset 6"):
        job.wait([sinks.table_sink(records(spark, topic), table, f"{tmp_path}/c", ONCE, refuse_bad_keys=True).start()])
    assert batches(table) == [0, 1]


def test_default_trigger_and_mode(spark, topic, tmp_path):
    query = sinks.console_sink(d.decode(records(spark, topic)), f"{tmp_path}/c").start()
    try:
        assert sinks.TRIGGER == {"processingTime": "10 seconds"} and sinks.PREVIEW_ROWS == 5
        assert query.isActive
    finally:
        job.stop([query])
    assert not query.isActive
    with pytest.raises(Exception, match="[Cc]omplete"):
        d.decode(records(spark, topic)).writeStream.outputMode("complete").format("console").start()


class FailsBefore(TradeTable):
    def append(self, rows, batch_id, rebalance=False):
        if batch_id == 1:
            raise RuntimeError("lost before the write")
        super().append(rows, batch_id, rebalance)


def test_a_file_lost_before_it_was_listed(spark, topic, tmp_path):
    """Spark leaves out a file that is gone when its batch is listed, whatever the option says."""

    def sink(into):
        return sinks.table_sink(records(spark, topic), into, f"{tmp_path}/c", ONCE).start()

    table = TradeTable.create(spark, f"{tmp_path}/t", buckets=2)
    with pytest.raises(Exception, match="lost before the write"):
        job.wait([sink(FailsBefore(spark, table.root))])
    planned = (tmp_path / "c/sources/0/1").read_text()
    os.remove(json.loads(planned.splitlines()[1])["path"].removeprefix("file://"))
    job.wait([sink(table)])
    assert visible(table) == {("a", 1): 1.0, ("b", 1): 1.0, ("c", 1): 3.0}
    # of seven messages two were in the lost file; the ping among the others is no loss
    assert sum(r.rows for r in table.deliveries().collect()) == 5
    assert [tuple(r) for r in table.gaps().collect()] == [(0, 3, 4, 2)]
    table.compact()
    assert [tuple(r) for r in table.gaps().collect()] == [(0, 3, 4, 2)]


def test_a_single_file_streams(spark, topic, tmp_path):
    import glob

    (first, *_) = sorted(glob.glob(f"{topic}/*.parquet"))
    rows = topic_records(files.stream_parquet(spark, first))
    query = rows.writeStream.format("memory").queryName("single").trigger(**ONCE).start()
    query.awaitTermination()
    assert spark.table("single").count() > 0


def test_publishing_stream(spark, topic, tmp_path):
    published = trade_records(files.stream_parquet(spark, topic, max_files_per_trigger=2).select("value"))
    failing = iter([True])

    def write(rows, batch_id):
        if batch_id == 1 and next(failing, False):
            raise RuntimeError("broker gone")
        rows.write.mode("overwrite").parquet(f"{tmp_path}/out/batch_id={batch_id}")

    def start():
        return sinks.publish_sink(published, write, "trades", f"{tmp_path}/c", ONCE).start()

    with DeliveryAudit(spark, f"{tmp_path}/audit", ["trades"]) as audit:
        with pytest.raises(Exception, match="broker gone"):
            job.wait([start()])
        again = start()
        job.wait([again])
        audit.settle(again)
    assert spark.read.parquet(f"{tmp_path}/out").count() == 5
    told = audit.deliveries().collect()
    found = sorted((r.batch_id, r.outcome, r.records) for r in told)
    assert found == [(0, "delivered", 3), (1, "delivered", 2), (1, "failed", 0)]
    assert ["broker gone" in (r.error or "") for r in sorted(told, key=lambda r: r.outcome)] == [False, False, True]
    # the batch that failed took the same files when it was run again
    assert sorted((r.batch_id, r.first_offset, r.last_offset) for r in audit.ranges().collect()) == [(0, 0, 0), (1, 1, 1)]
    with pytest.raises(Exception, match="(?i)kafka"):
        topic_write = sinks.topic_writer("a:1", "trades")
        job.wait([sinks.publish_sink(published, topic_write, "trades", f"{tmp_path}/c3", ONCE).start()])


def plain_rows(values):
    """What a plain reading of the messages says, in order."""
    found = []
    for value in values:
        try:
            message = json.loads(value)
        except (TypeError, ValueError):
            continue
        if not isinstance(message, dict) or not isinstance(message.get("data"), list):
            continue
        for element in message["data"]:
            e = element or {}
            found.append((message.get("type"), e.get("c"), e.get("p"), e.get("s"), e.get("t"), e.get("v")))
    return found


def random_message():
    def element():
        if random.random() < 0.1:
            return None
        e = {
            "c": random.choice([None, "x", 'q"uo\\te', "é€𝄞\n"]),
            "p": random.choice([None, 1.0, 0.1, 1e-300, -2.5e17]),
            "s": random.choice([None, "", "A", "B C:1"]),
            "t": random.choice([None, 0, -5, 2**62]),
            "v": random.choice([None, 0.0, 3.25]),
            "z": [1],
        }
        return {k: v for k, v in e.items() if random.random() < 0.9}

    kind = random.random()
    if kind < 0.1:
        return random.choice([None, "", "5", "[]", "{", '{"type":"trade","data":[{']) 
    return json.dumps({"type": random.choice(["trade", "news", None]), "data": [element() for _ in range(random.randrange(5))]})


def test_random_messages_decode_like_a_plain_reading(spark):
    random.seed(11)
    values = [random_message() for _ in range(500)]
    rows = spark.createDataFrame([(None, v, 0, i) for i, v in enumerate(values)], "key string, value string, src_partition int, src_offset long")
    got = d.flatten(rows).orderBy("src_offset", "pos").select(*TRADE_COLUMNS).collect()
    assert [tuple(r) for r in got] == plain_rows(values)
    judged = d.classify(rows)
    trades = [r for r in plain_rows(values) if r[3] and r[4] is not None]
    assert d.keyed_trades(judged).count() == len(trades)
    assert d.quarantined(judged).count() == len(plain_rows(values)) - len(trades)


def test_random_files_and_batches_give_the_same_table(spark, tmp_path):
    random.seed(5)
    trades = [(random.choice("ab"), random.randrange(4), float(i)) for i in range(40)]
    expected = {(s, t): p for s, t, p in trades}
    folder, start = f"{tmp_path}/topic", 0
    while start < len(trades):
        end = min(len(trades), start + random.randrange(1, 20))
        add_file(spark, folder, [trade(*x) for x in trades[start:end]], start)
        start = end
    table = TradeTable.create(spark, f"{tmp_path}/t", buckets=2)
    job.wait([sinks.table_sink(records(spark, folder, 2), table, f"{tmp_path}/c", ONCE).start()])
    assert visible(table) == expected


def test_compaction_while_the_stream_runs(spark, tmp_path):
    folder = f"{tmp_path}/topic"
    add_file(spark, folder, [trade("a", 0, 0)], 0)
    table = TradeTable.create(spark, f"{tmp_path}/t", buckets=2)
    query = sinks.table_sink(records(spark, folder), table, f"{tmp_path}/c", {"processingTime": "100 milliseconds"}).start()
    for n in range(1, 7):
        add_file(spark, folder, [trade("a", i, n) for i in range(n)], n * 100)
        table.compact()
        assert visible(table).keys() <= {("a", i) for i in range(n)}
    query.processAllAvailable()
    job.stop([query])
    expected = {("a", i): 6.0 for i in range(6)}
    assert visible(table) == expected
    table.compact()
    assert visible(table) == expected
    assert sum(r.rows for r in table.deliveries().collect()) == 22


def test_decoded_schema(spark, topic):
    assert d.decode(records(spark, topic)).schema == TRADE
