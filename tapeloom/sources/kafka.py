"""The topic source. Needs the Kafka data source package on the cluster."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The client settings of the stream, and the pair of settings with which the
# original job reads. Together these two lose data on a busy topic: with at most 5000 offsets
# every ten seconds the stream falls behind, the topic drops what was not read in time, and
# the loss is tolerated. So neither is a default.
ORIGINAL_LIMITS = {"max_offsets_per_trigger": 5000, "fail_on_data_loss": False}
CLIENT_SETTINGS = {
    "kafka.session.timeout.ms": "120000",
    "kafka.heartbeat.interval.ms": "40000",
    "kafka.request.timeout.ms": "150000",
    "kafka.max.poll.records": "2000",
    "kafka.fetch.max.wait.ms": "500",
}


def topic_options(
    servers: str,
    topic: str,
    *,
    starting_offsets: str = "earliest",
    fail_on_data_loss: bool = True,
    max_offsets_per_trigger: int | None = None,
    min_partitions: int | None = None,
    client: dict[str, str] | None = None,
) -> dict[str, str]:
    """Reader options of one topic.

    A constant record key puts a whole topic into one partition; `min_partitions` splits
    the offset range of such a partition over several tasks. Nothing is capped and a loss
    fails the stream, unless asked for: `topic_options(..., **ORIGINAL_LIMITS)`.
    """
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
        **CLIENT_SETTINGS,
        **(client or {}),
    }
    if max_offsets_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if min_partitions is not None:
        options["minPartitions"] = str(min_partitions)
    return options


def read_topic(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """A stream of topic rows, in the data source's own columns."""
    return spark.readStream.format("kafka").options(**options).load()


def read_topic_once(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """The stored rows of a topic as a batch, for a backfill; rate caps do not apply."""
    batch = {k: v for k, v in options.items() if k != "maxOffsetsPerTrigger"}
    return spark.read.format("kafka").options(**batch).load()


def range_options(options: dict[str, str], ranges: dict[int, tuple[int, int]]) -> dict[str, str]:
    """Reader options for inclusive ranges of offsets by topic partition; other partitions are left out."""

    def offsets(by_partition: dict[int, int]) -> str:
        return json.dumps({options["subscribe"]: {str(p): offset for p, offset in sorted(by_partition.items())}})

    partitions = json.dumps({options["subscribe"]: sorted(ranges)})
    kept = {k: v for k, v in options.items() if k not in ("subscribe", "maxOffsetsPerTrigger")}
    return kept | {
        "assign": partitions,
        "startingOffsets": offsets({p: first for p, (first, _) in ranges.items()}),
        "endingOffsets": offsets({p: last + 1 for p, (_, last) in ranges.items()}),
    }


def topic_records(rows: DataFrame) -> DataFrame:
    """Topic rows as records: key and value as text, and their place in the topic."""
    return rows.select(
        F.col("key").cast("string"),
        F.col("value").cast("string"),
        F.col("partition").cast("int").alias("src_partition"),
        F.col("offset").cast("long").alias("src_offset"),
    )
