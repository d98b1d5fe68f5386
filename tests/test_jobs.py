import pytest
from pyspark.sql import functions as F

from tapeloom import jobs
from tapeloom.plans.table import TradeTable


def store(spark, folder, first, count):
    value = F.concat(
        F.lit('{"type":"trade","data":[{"s":"A","p":1,"v":1,"t":'), F.col("id") % 5, F.lit("}]}")
    )
    spark.range(first, first + count, numPartitions=1).select(
        F.lit("d").cast("binary").alias("key"),
        value.cast("binary").alias("value"),
        F.lit("t").alias("topic"),
        F.lit(0).alias("partition"),
        F.col("id").alias("offset"),
        F.current_timestamp().alias("timestamp"),
    ).write.mode("append").parquet(folder)


def test_ingest_compact_ingest(spark, tmp_path):
    topic, where = f"{tmp_path}/topic", ["--table", f"{tmp_path}/t"]
    ingest = ["ingest", *where, "--checkpoints", f"{tmp_path}/c", "--files", topic, "--once"]
    store(spark, topic, 0, 20)
    jobs.main(ingest + ["--rebalance"])
    jobs.main(["compact", *where])
    store(spark, topic, 20, 4)
    jobs.main(ingest)
    table = TradeTable(spark, f"{tmp_path}/t")
    assert table.live().count() == 5
    assert sorted(r.rows for r in table.deliveries().collect()) == [4, 20]


def test_backfill_of_stored_rows(spark, tmp_path):
    topic = f"{tmp_path}/topic"
    store(spark, topic, 0, 20)
    jobs.main(["backfill", "--table", f"{tmp_path}/t", "--files", topic, "--buckets", "3", "--lifetime", "99999999"])
    table = TradeTable(spark, f"{tmp_path}/t")
    assert (table.buckets, table.ttl_seconds) == (3, 99999999)
    assert table.live().count() == 5 and table.deliveries().first().rows == 20
    jobs.main(["backfill", "--table", f"{tmp_path}/t", "--files", topic])
    assert table.deliveries().count() == 1  # the same backfill has nothing left to do
    jobs.main(["backfill", "--table", f"{tmp_path}/t", "--files", topic, "--backfill", "again", "--slice", "8"])
    assert sorted(r.rows for r in table.deliveries().collect()) == [4, 8, 8, 20]
    jobs.main(["compact", "--table", f"{tmp_path}/t", "--as-of", "2020-01-01"])
    assert table.live().count() == 5


def test_bad_keys_can_be_refused(spark, tmp_path):
    topic = f"{tmp_path}/topic"
    spark.range(1).selectExpr(
        "cast('d' as binary) key", "cast('{\"type\":\"trade\",\"data\":[{\"p\":1}]}' as binary) value",
        "'t' topic", "0 partition", "id offset", "current_timestamp() timestamp",
    ).write.parquet(topic)
    ingest = ["ingest", "--table", f"{tmp_path}/t", "--checkpoints", f"{tmp_path}/c", "--files", topic, "--once"]
    with pytest.raises(Exception, match="trade without key"):
        jobs.main(ingest + ["--refuse-bad-keys"])


def test_a_topic_needs_its_address(tmp_path, capsys):
    with pytest.raises(SystemExit):
        jobs.main(["ingest", "--table", "t", "--checkpoints", "c"])
    assert "--servers and --topic" in capsys.readouterr().err


def test_publish_goes_to_a_topic(spark, tmp_path):
    (tmp_path / "frames").mkdir()
    (tmp_path / "frames/a.txt").write_text('{"type":"trade"}\n')
    with pytest.raises(Exception, match="kafka"):
        jobs.main(["publish", "--frames", f"{tmp_path}/frames", "--checkpoints", f"{tmp_path}/c", "--servers", "a:1", "--topic", "trades"])
