from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tapeloom.functions.clock import instant_us, wall_ms, wall_us
from tapeloom.sources.paths import shared_dir

WALLS = [
    "1970-01-01 00:00:00",
    "2024-01-01 00:00:07.179575",
    "2024-03-10 02:30:00.999999",  # no such hour in New York
    "2024-11-03 01:30:00.000001",  # twice there
    "2024-07-01 12:00:00",
    "2262-04-11 23:47:16.854775",
]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_wall_clock_ignores_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        rows = spark.createDataFrame([(w,) for w in WALLS], "w string").select(
            F.col("w").cast("timestamp_ntz").alias("ts")
        )
        got = rows.select(wall_us("ts"), wall_ms(F.col("ts"))).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    epoch = datetime(1970, 1, 1)
    expected = [(datetime.fromisoformat(w) - epoch) // timedelta(microseconds=1) for w in WALLS]
    assert [tuple(r) for r in got] == [(us, us // 1000) for us in expected]


def test_instants(spark):
    at = datetime(2024, 2, 10, 3, tzinfo=timezone(timedelta(hours=3)))
    assert spark.range(1).select(instant_us(at)).first()[0] == 1_707_523_200_000_000
    now = spark.range(1).select(instant_us()).first()[0]
    assert abs(now / 1e6 - datetime.now(timezone.utc).timestamp()) < 60


def test_shared_folder(spark, monkeypatch):
    configured = spark.conf.get("spark.checkpoint.dir")
    assert shared_dir(spark, "x").startswith(f"{configured}/x-")
    assert shared_dir(spark, "x") != shared_dir(spark, "x")


class Cluster:
    """A session on a cluster that names no shared folder."""

    class conf:
        @staticmethod
        def get(name, default):
            return default

    class sparkContext:
        master = "spark://host:7077"

        @staticmethod
        def getCheckpointDir():
            return None


def test_a_cluster_must_name_its_shared_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(Cluster, "x")
