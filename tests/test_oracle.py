"""Every registered query against its SQL, on the given tables."""

import os

import pandas as pd
import pytest

duckdb = pytest.importorskip("duckdb")

import __spark_entry__ as driver  # noqa: E402
from tapeloom.plans.oracles import ORACLES  # noqa: E402
from tapeloom.plans.queries import QUERIES  # noqa: E402
from tapeloom.functions.placement import symbol_bucket  # noqa: E402
from tapeloom.operators.upsert import latest, live  # noqa: E402
from tapeloom.plans import table as table_module  # noqa: E402
from tapeloom.plans.table import TradeTable  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for file in os.listdir(SF_DIR):
        name = file.removesuffix(".parquet")
        connection.execute(f"create view {name} as select * from '{SF_DIR}/{file}'")
    yield connection
    connection.close()


def rows_of(frame):
    frame = frame[sorted(frame.columns)]
    rows = [
        tuple(None if pd.isna(v) else v for v in row)
        for row in frame.itertuples(index=False, name=None)
    ]
    return list(frame.columns), sorted(rows, key=repr)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, oracle, name):
    result = driver.queries()[name](spark, SF_DIR)
    columns, rows = rows_of(result.toPandas())
    expected_columns, expected = rows_of(oracle.execute(driver.oracle_sql()[name]).df())
    assert columns == expected_columns
    assert rows == expected
    assert rows, "the query should find something"


@pytest.mark.parametrize("name", ["stream_decode", "stream_upsert", "merge_on_read"])
def test_tables_may_be_directories_of_files(spark, oracle, tmp_path, name):
    events = spark.read.parquet(f"{SF_DIR}/events.parquet")
    events.repartition(5).write.parquet(f"{tmp_path}/events.parquet")
    columns, rows = rows_of(driver.queries()[name](spark, str(tmp_path)).toPandas())
    assert (columns, rows) == rows_of(oracle.execute(driver.oracle_sql()[name]).df())


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES)
    assert set(ORACLES) <= set(driver.oracle_sql()) and set(QUERIES) <= set(driver.queries())


def differs(spark, oracle, name):
    _, rows = rows_of(driver.queries()[name](spark, SF_DIR).toPandas())
    return rows != rows_of(oracle.execute(ORACLES[name]).df())[1]


STORED = ["merge_on_read", "compact_expire", "table_reads", "dashboard_view"]


@pytest.mark.parametrize("name", STORED)
def test_a_merge_that_hides_nothing_shows(spark, oracle, monkeypatch, name):
    def merge(self, base, log, as_of):
        newest = latest(log.drop("kind", "reason", "value")).withColumn("symbol_bucket", symbol_bucket(self.buckets))
        return live(base.unionByName(newest.select(base.columns)), as_of, self.ttl_seconds)

    monkeypatch.setattr(TradeTable, "_merge", merge)
    assert differs(spark, oracle, name)


def test_a_compaction_that_expires_nothing_shows(spark, oracle, monkeypatch):
    whole = TradeTable._merge

    def merge(self, base, log, as_of):
        lasting = TradeTable(self.spark, self.root)
        lasting.ttl_seconds = 10**9
        return whole(lasting, base, log, as_of)

    monkeypatch.setattr(TradeTable, "_merge", merge)
    monkeypatch.setattr(table_module, "live", lambda rows, as_of, ttl=0: rows.where("ingest_us is not null"))
    assert differs(spark, oracle, "compact_expire")


def test_a_batch_written_twice_shows(spark, oracle, monkeypatch):
    """The upsert hides rows that a replay writes once more; the delivered count does not."""
    append, seen = TradeTable.append, set()

    def twice(self, rows, batch_id, rebalance=False):
        again = (self.root, batch_id) in seen
        seen.add((self.root, batch_id))
        append(self, rows.unionByName(rows) if again else rows, batch_id, rebalance)

    monkeypatch.setattr(TradeTable, "append", twice)
    assert differs(spark, oracle, "stream_upsert")


def test_entry(spark):
    assert driver.entry(spark).count() > 0
