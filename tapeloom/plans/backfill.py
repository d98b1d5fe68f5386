"""A backfill in slices: ranges of offsets, one write batch each, that can stop and go on."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeloom.operators.decode import classify
from tapeloom.plans.table import TradeTable, with_ingest_time
from tapeloom.sources import paths

SLICE_OFFSETS = 100_000_000  # of each source partition, in one write batch
_PLAN = "batch_id long, src_partition int, first_offset long, last_offset long"


class Slice(NamedTuple):
    """A write batch and its inclusive range of offsets in each source partition."""

    batch_id: int
    ranges: dict[int, tuple[int, int]]


def plan(table: TradeTable, records: DataFrame, name: str, size: int = SLICE_OFFSETS) -> list[Slice]:
    """The slices of a backfill, planned once under its name and the same whenever it goes on.

    The plan is written beside the table, so what the source gets later is for another
    backfill, and slices keep their batch ids. There is one row for each slice and source
    partition; of the records only their places are read.
    """
    folder = f"{table.root}/backfills/{name}"
    if not paths.glob(table.spark, f"{folder}/_SUCCESS"):
        first_batch = table.last_batch() + 1
        held = records.groupBy("src_partition").agg(
            F.min("src_offset").alias("first"), F.max("src_offset").alias("last")
        )
        number = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("last") - F.col("first")) / size)))
        slices = held.select("*", number.alias("number")).select(
            (F.col("number") + first_batch).alias("batch_id"),
            "src_partition",
            (F.col("first") + F.col("number") * size).alias("first_offset"),
            F.least("last", F.col("first") + (F.col("number") + 1) * size - 1).alias("last_offset"),
        )
        slices.coalesce(1).write.mode("overwrite").json(folder)
    found: dict[int, dict[int, tuple[int, int]]] = {}
    for row in table.spark.read.schema(_PLAN).json(folder).collect():
        found.setdefault(row["batch_id"], {})[row["src_partition"]] = (row["first_offset"], row["last_offset"])
    return [Slice(batch_id, found[batch_id]) for batch_id in sorted(found)]


def within(records: DataFrame, ranges: dict[int, tuple[int, int]]) -> DataFrame:
    """The records of a slice; the smallest and largest offset reach the files' statistics."""
    of_slice = F.lit(False)
    for partition, (first, last) in ranges.items():
        of_slice = of_slice | ((F.col("src_partition") == partition) & F.col("src_offset").between(first, last))
    least = min(first for first, _ in ranges.values())
    most = max(last for _, last in ranges.values())
    return records.where(F.col("src_offset").between(least, most) & of_slice)


def backfill(
    table: TradeTable,
    records: DataFrame,
    name: str,
    size: int = SLICE_OFFSETS,
    read: Callable[[dict[int, tuple[int, int]]], DataFrame] | None = None,
    rebalance: bool = False,
) -> list[int]:
    """Write what is still missing of a backfill, slice by slice; gives the batches that it wrote.

    A slice that is in the table, in the log or compacted, is skipped; one that was cut off is
    not there, and is written. `read` gives the records of a slice's ranges where the source can
    look them up, as a topic can; otherwise they are selected from `records`. Nothing else may
    write to the table until the backfill is done: batch ids do not go back.
    """
    written = []
    for batch_id, ranges in plan(table, records, name, size):
        if table.has_batch(batch_id):
            continue
        rows = read(ranges) if read else within(records, ranges)
        table.append(with_ingest_time(classify(rows)), batch_id, rebalance)
        written.append(batch_id)
    return written
