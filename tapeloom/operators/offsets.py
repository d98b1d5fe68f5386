"""Runs of offsets, and the gaps between them: what a source lost although the loss was tolerated."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Offsets are looked at in blocks, so that one topic partition is many groups, not one.
BLOCK = 1 << 16


def runs(records: DataFrame, *keys: str) -> DataFrame:
    """The runs of consecutive `src_offset` within each `src_partition` and `keys`.

    Gives keys, src_partition, first_offset, last_offset and rows, the number of records.
    Only the pieces of blocks, one a block and one a gap, meet in one group for a partition.
    """
    return joined(pieces(records, *keys), *keys)


def pieces(records: DataFrame, *keys: str) -> DataFrame:
    """The same runs, cut where a block ends: within a block neighbours tell where they begin."""
    by = [*keys, "src_partition"]
    block = F.floor(F.col("src_offset") / BLOCK).alias("block")
    # one shuffle: all that follows is within a block
    placed = records.select(*by, "src_offset", block).repartition(*by, "block")
    offsets = placed.groupBy(*by, "block", "src_offset").agg(F.count(F.lit(1)).alias("rows"))
    in_block = Window.partitionBy(*by, "block").orderBy("src_offset")
    begins = F.coalesce(F.col("src_offset") - F.lag("src_offset").over(in_block) > 1, F.lit(True))
    running = in_block.rowsBetween(Window.unboundedPreceding, 0)
    numbered = offsets.withColumn("begins", begins.cast("long")).withColumn("run", F.sum("begins").over(running))
    return numbered.groupBy(*by, "block", "run").agg(*_run("src_offset", "src_offset")).drop("block", "run")


def joined(parts: DataFrame, *keys: str) -> DataFrame:
    """Runs that touch or overlap made one, over all blocks, and over batches if these are no key."""
    by = [*keys, "src_partition"]
    order = Window.partitionBy(*by).orderBy("first_offset", "last_offset")
    reached = F.max("last_offset").over(order.rowsBetween(Window.unboundedPreceding, -1))
    begins = F.coalesce(F.col("first_offset") > reached + 1, F.lit(True))
    running = order.rowsBetween(Window.unboundedPreceding, 0)
    numbered = parts.withColumn("begins", begins.cast("long")).withColumn("run", F.sum("begins").over(running))
    return numbered.groupBy(*by, "run").agg(*_run("first_offset", "last_offset")).drop("run")


def _run(first: str, last: str) -> list:
    return [
        F.min(first).alias("first_offset"),
        F.max(last).alias("last_offset"),
        F.sum("rows").alias("rows"),
    ]


def gaps(delivered: DataFrame) -> DataFrame:
    """What is missing between the runs of each partition, as inclusive ranges of offsets.

    Before the first run nothing is missing: a topic may have dropped what is old before it
    was ever read. Offsets of a topic that transactions or its own compaction left out are
    gaps too, as nobody but the broker can tell.
    """
    order = Window.partitionBy("src_partition").orderBy("first_offset")
    before = F.lag("last_offset").over(order)
    return (
        joined(delivered)
        .select("src_partition", (before + 1).alias("first_missing"), (F.col("first_offset") - 1).alias("last_missing"))
        .where("first_missing <= last_missing")
        .withColumn("missing", F.col("last_missing") - F.col("first_missing") + 1)
    )
