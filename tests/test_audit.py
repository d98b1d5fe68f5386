import json
from datetime import datetime, timedelta, timezone

import pytest

from tapeloom.streaming import job
from tapeloom.streaming.audit import DeliveryAudit, offset_ranges

ONCE = {"availableNow": True}


def test_ranges_of_a_topic_by_partition():
    start = json.dumps({"trades": {"0": 10, "1": 5, "2": 7}})
    end = json.dumps({"trades": {"0": 30, "1": 5, "2": 8, "10": 4, "11": 0}})
    assert offset_ranges(start, end) == [
        ("trades", 0, 10, 29), ("trades", 2, 7, 7), ("trades", 10, None, 3),
    ]
    assert offset_ranges(None, json.dumps({"a": {"0": 2}, "b": {"0": 1}})) == [("a", 0, None, 1), ("b", 0, None, 0)]
    assert offset_ranges("null", "null") == offset_ranges("None", None) == []


def test_ranges_of_files_and_counts():
    assert offset_ranges(None, '{"logOffset":0}') == [(None, None, 0, 0)]
    assert offset_ranges('{"logOffset":2}', '{"logOffset":5}') == [(None, None, 3, 5)]
    assert offset_ranges('{"logOffset":5}', '{"logOffset":5}') == []
    assert offset_ranges("3", "7") == [(None, None, 3, 7)]


def numbers(spark, folder, tmp_path, name, write=None):
    rows = spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).parquet(folder)
    counted = rows.observe("seen", *[f.alias(n) for n, f in counts().items()])
    sink = counted.writeStream.trigger(**ONCE).option("checkpointLocation", f"{tmp_path}/c-{name or 'none'}")
    sink = sink.foreachBatch(write or (lambda batch, _: batch.write.format("noop").mode("overwrite").save()))
    return (sink.queryName(name) if name else sink).start()


def counts():
    from pyspark.sql import functions as F

    return {"records": F.count(F.lit(1)), "greatest": F.max("id")}


@pytest.fixture
def folder(spark, tmp_path):
    for part in range(3):
        spark.range(part * 10, part * 10 + 4 + part, numPartitions=1).write.mode("append").parquet(f"{tmp_path}/in")
    return f"{tmp_path}/in"


def test_only_the_named_targets(spark, folder, tmp_path):
    with DeliveryAudit(spark, f"{tmp_path}/audit", ["wanted"]) as audit:
        job.wait([numbers(spark, folder, tmp_path, name) for name in ("wanted", "other", None)])
    told = audit.read().collect()
    assert {r.target for r in told} == {"wanted"} and len(told) == 3
    assert sorted(r.records for r in audit.deliveries().collect()) == [4, 5, 6]
    assert {r.observed["greatest"] for r in told} == {3, 14, 25}
    assert all(r.source.startswith("FileStreamSource") for r in told)


def test_a_failure_is_placed_after_a_restart_of_the_driver(spark, folder, tmp_path):
    """A new listener knows the last batch from the table."""

    def refuse(batch, batch_id):
        if batch_id == 2:
            raise ValueError("no room")

    for _ in range(2):
        with DeliveryAudit(spark, f"{tmp_path}/audit", ["refusing"]) as audit:
            with pytest.raises(Exception, match="no room"):
                job.wait([numbers(spark, folder, tmp_path, "refusing", refuse)])
    found = sorted((r.batch_id, r.outcome) for r in audit.deliveries().collect())
    assert found == [(0, "delivered"), (1, "delivered"), (2, "failed"), (2, "failed")]
    assert audit.read().select("query_id").distinct().count() == 1
    assert audit.read().select("run_id").distinct().count() == 2


def test_a_report_that_cannot_be_written_shows(spark, folder, tmp_path):
    (tmp_path / "blocked").write_text("a file, no folder")
    with pytest.raises(Exception, match="(?i)blocked"):
        with DeliveryAudit(spark, f"{tmp_path}/blocked", ["kept"]):
            job.wait([numbers(spark, folder, tmp_path, "kept")])


def test_days_that_have_passed_become_one_file(spark, folder, tmp_path):
    with DeliveryAudit(spark, f"{tmp_path}/audit", ["folded"]) as audit:
        job.wait([numbers(spark, folder, tmp_path, "folded")])
    before = sorted(map(str, audit.read().collect()))
    assert audit.fold() == [] and len(audit.read().inputFiles()) == 3
    assert len(audit.fold(datetime.now(timezone.utc) + timedelta(days=1))) == 1
    assert len(audit.read().inputFiles()) == 1 and sorted(map(str, audit.read().collect())) == before
