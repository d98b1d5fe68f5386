import json

import pytest
from pyspark.sql import functions as F

from tapeloom.operators import publish
from tapeloom.schemas import TRADE
from tapeloom.sources import files, kafka
from tapeloom.streaming import sinks

TRADE_FRAME = '{"type":"trade","data":[{"s":"A"}]}'

PUBLISHED = [
    TRADE_FRAME,
    ' {"data":[], "type" : "trade"} ',
    '{"type":"ping","type":"trade"}',
    '{"type":"trade","x":NaN}',
    '{"type":"trade","x":"é€𝄞"}',
]
NOT_PUBLISHED = [
    None,
    "",
    "5",
    "null",
    "{}",
    '{"type":null}',
    '{"type":"ping"}',
    '{"type":"TRADE"}',
    '{"type":"trade","type":"ping"}',
    '{"type":["trade"]}',
    '{"Type":"trade"}',
    f"[{TRADE_FRAME}]",
    TRADE_FRAME + " x",
    TRADE_FRAME + TRADE_FRAME,
    TRADE_FRAME + "," + TRADE_FRAME,
    TRADE_FRAME + "] x",
    '{"type":"trade"},{"type":"end of frame"}]junk',
    '{"type":"trade"},{"type":"end of frame"}',
    TRADE_FRAME[:-1],
    "{'type':'trade'}",
    '{"type":"trade","x":{bad}}',
]


def frames(spark, values):
    return spark.createDataFrame([(v if v is None else bytearray(v, "utf-8"),) for v in values], "value binary")


def is_trade(value):
    """What a plain reading of a frame says."""
    try:
        return json.loads(value).get("type") == "trade"
    except Exception:
        return False


def test_trade_records(spark):
    for value in PUBLISHED:
        assert is_trade(value)
    for value in NOT_PUBLISHED:
        assert not is_trade(value)
    rows = publish.trade_records(frames(spark, PUBLISHED + NOT_PUBLISHED)).collect()
    assert [row.value for row in rows] == PUBLISHED
    assert {row.key for row in rows} == {"d"}


def test_frames_are_parsed_once(spark, tmp_path):
    frames(spark, PUBLISHED).write.parquet(f"{tmp_path}/f")
    published = publish.trade_records(spark.read.parquet(f"{tmp_path}/f"))
    plan = published._jdf.queryExecution().executedPlan().toString()
    steps, scan = plan.split("FileScan")  # the scan's own line repeats the filter
    assert steps.count("from_json(") == 1 and "Exchange" not in plan


def test_rejects_say_why(spark):
    rows = publish.rejects(frames(spark, PUBLISHED + NOT_PUBLISHED)).collect()
    unreadable = [v for v in NOT_PUBLISHED if not readable(v)]
    assert sorted(str(r.value if r.value is None else bytes(r.value).decode()) for r in rows) == sorted(map(str, unreadable))
    assert {r.reason for r in rows} == {"empty", "not_an_object"}
    broken = spark.createDataFrame([(bytearray(b'{"type":"trade"\xff}'),)], "value binary")
    assert [r.reason for r in publish.rejects(broken).collect()] == ["not_utf8"]


def readable(value):
    """Whether a plain reading finds one JSON object."""
    try:
        return isinstance(json.loads(value), dict)
    except Exception:
        return False


def test_record_key_can_spread(spark):
    rows = publish.trade_records(
        frames(spark, PUBLISHED[:2]), key=F.get_json_object("value", "$.data[0].s")
    ).collect()
    assert [row.key for row in rows] == ["A", None]


def test_bad_utf8(spark):
    good, bad = bytearray(b'{"type":"trade"}'), bytearray(b'{"type":"trade","x":"\xff"}')
    rows = spark.createDataFrame([(good,), (bad,)], "value binary")
    assert publish.trade_records(rows).count() == 1
    assert publish.strict_text(rows, on_error="drop").count() == 1
    kept = publish.strict_text(rows, on_error="null").collect()
    assert [row.value is None for row in kept] == [False, True]
    with pytest.raises(Exception, match="UTF"):
        publish.strict_text(rows).collect()
    with pytest.raises(ValueError):
        publish.strict_text(rows, on_error="ignore")


def trades(spark, symbols):
    return spark.createDataFrame([("trade", None, 1.0, s, i, 1.0) for i, s in enumerate(symbols)], TRADE)


def test_subscribe(spark):
    rows = trades(spark, ["AAPL", "X", None, "IC MARKETS:1", "aapl"])
    assert [r.symbol for r in publish.subscribe(rows).collect()] == ["AAPL", "IC MARKETS:1"]
    assert [r.symbol for r in publish.subscribe(rows, ["X"]).collect()] == ["X"]
    wanted = spark.createDataFrame([("X",), ("X",), (None,), ("aapl",)], "symbol string")
    got = publish.subscribe(rows, wanted)
    assert got.columns == rows.columns
    assert sorted(r.symbol for r in got.collect()) == ["X", "aapl"]


def test_subscribe_to_a_large_table_with_a_hot_symbol(spark):
    rows = trades(spark, ["hot"] * 3000 + [f"s{i}" for i in range(3000)])
    wanted = spark.createDataFrame([("hot",)] + [(f"s{i}",) for i in range(0, 3000, 3)], "symbol string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        assert publish.subscribe(rows, wanted).count() == 3000 + 1000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_topic_options():
    options = kafka.topic_options("a:1,b:2", "trades")
    assert options == {
        "kafka.bootstrap.servers": "a:1,b:2",
        "subscribe": "trades",
        "startingOffsets": "earliest",
        "failOnDataLoss": "true",
        "kafka.session.timeout.ms": "120000",
        "kafka.heartbeat.interval.ms": "40000",
        "kafka.request.timeout.ms": "150000",
        "kafka.max.poll.records": "2000",
        "kafka.fetch.max.wait.ms": "500",
    }
    wide = kafka.topic_options(
        "a:1",
        "trades",
        min_partitions=400,
        **kafka.ORIGINAL_LIMITS,
        client={"kafka.max.poll.records": "9"},
    )
    assert wide["failOnDataLoss"] == "false"
    assert wide["maxOffsetsPerTrigger"] == "5000"
    assert wide["minPartitions"] == "400"
    assert wide["kafka.max.poll.records"] == "9"


def test_connector_options():
    options = sinks.connector_options("market", "trades")
    assert options == {
        "keyspace": "market",
        "table": "trades",
        "spark.cassandra.output.consistency.level": "LOCAL_ONE",
        "spark.cassandra.output.concurrent.writes": "4",
        "spark.cassandra.output.batch.size.rows": "64",
        "spark.cassandra.output.throughput_mb_per_sec": "20",
    }
    assert sinks.connector_options("k", "t", {"x": "1"})["x"] == "1"
    assert sinks.connector_session(["h1", "h2"]) == {
        "spark.cassandra.connection.host": "h1,h2",
        "spark.cassandra.connection.port": "9042",
        "spark.cassandra.connection.keep_alive_ms": "60000",
        "spark.cassandra.connection.timeout_ms": "10000",
        "spark.cassandra.output.batch.size.rows": "50",
    }


def test_absent_packages_are_named(spark, tmp_path):
    with pytest.raises(Exception, match="kafka"):
        kafka.read_topic(spark, kafka.topic_options("a:1", "trades"))
    with pytest.raises(Exception, match="kafka"):
        kafka.read_topic_once(spark, kafka.topic_options("a:1", "trades"))
    stream = spark.readStream.schema(TRADE).parquet(str(tmp_path))
    with pytest.raises(Exception, match="cassandra"):
        sinks.connector_sink(stream, "k", "t", f"{tmp_path}/c").start()


def test_frames_from_text_files(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes((TRADE_FRAME + "\n{}\n").encode() + b'{"type":"trade","x":"\xff"}\n')
    batch = publish.trade_records(files.read_frames(spark, str(tmp_path)))
    assert [r.value for r in batch.collect()] == [TRADE_FRAME]
    stream = publish.trade_records(files.stream_frames(spark, str(tmp_path), max_files_per_trigger=1))
    query = stream.writeStream.format("memory").queryName("frames").trigger(availableNow=True).start()
    query.awaitTermination()
    assert [r.value for r in spark.table("frames").collect()] == [TRADE_FRAME]
