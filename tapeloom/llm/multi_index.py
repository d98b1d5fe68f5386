"""Nearest neighbours with an inverted multi-index.

The two halves of the vectors are quantised separately, each by its own centroids, so that k
centroids a half give k * k cells. A query walks through the cells by the summed distance of
its halves to their centroids, with a heap, until the cells it has passed hold enough
vectors; these are ranked by their exact distance. Every vector is indexed; only the centroids
come from a sample.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tapeloom.llm.words import only
from tapeloom.sources.paths import shared_dir

NEIGHBOURS = 10
CENTROIDS = 128  # of each half
SAMPLE = 20_000  # vectors the centroids are fitted to: those with the smallest hashes of ids
FIT_ROUNDS = 15
SHARE = 0.4  # of all vectors that a query's cells hold at least, and at least LEAST
LEAST = 2_000
CELL_GROUPS = 64
BLOCK = 16_384  # vectors, or queries, of a group at about most


@dataclass(frozen=True)
class Index:
    """Centroids of both halves, how many vectors each cell holds, and how cells are grouped."""

    first: np.ndarray
    second: np.ndarray
    counts: np.ndarray

    def cells(self, vectors: np.ndarray) -> np.ndarray:
        half = self.first.shape[1]
        i = squared(vectors[:, :half], self.first).argmin(1)
        j = squared(vectors[:, half:], self.second).argmin(1)
        return i * len(self.second) + j

    def walk(self, vector: np.ndarray, candidates: int) -> list[int]:
        """The cells that hold vectors, nearest first, until they hold enough."""
        half = self.first.shape[1]
        a = squared(vector[None, :half], self.first)[0]
        b = squared(vector[None, half:], self.second)[0]
        a_order, b_order = a.argsort(kind="stable"), b.argsort(kind="stable")
        heap = [(a[a_order[0]] + b[b_order[0]], 0, 0)]
        found, held = [], 0
        while heap and held < candidates:
            _, i, j = heapq.heappop(heap)
            cell = int(a_order[i]) * len(b) + int(b_order[j])
            if self.counts[cell]:
                found.append(cell)
                held += int(self.counts[cell])
            # every pair is reached once: along a row, and down the first column
            if j + 1 < len(b):
                heapq.heappush(heap, (a[a_order[i]] + b[b_order[j + 1]], i, j + 1))
            if j == 0 and i + 1 < len(a):
                heapq.heappush(heap, (a[a_order[i + 1]] + b[b_order[0]], i + 1, 0))
        return found


def squared(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances, as far as they differ between centres, plus the point's own part."""
    inner = points @ centres.T
    return (points**2).sum(1)[:, None] - 2 * inner + (centres**2).sum(1)[None, :]


def fit_centroids(points: np.ndarray, count: int, seed: int = 7) -> np.ndarray:
    """K-means with spread-out starts; centroids that lose all points keep their place."""
    draw = np.random.default_rng(seed)
    centres = points[[int(draw.integers(len(points)))]]
    nearest = squared(points, centres)[:, 0].clip(0)
    while len(centres) < min(count, len(points)) and nearest.sum() > 0:
        chosen = draw.choice(len(points), p=nearest / nearest.sum())
        centres = np.vstack([centres, points[chosen]])
        nearest = np.minimum(nearest, squared(points, centres[-1:])[:, 0].clip(0))
    for _ in range(FIT_ROUNDS):
        own = squared(points, centres).argmin(1)
        counts = np.bincount(own, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, own, points)
        centres = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centres)
    return centres


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Equally long lists as rows."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def usable(vectors: DataFrame, id_column: str, vector: str) -> DataFrame:
    """(vec_id, vector) of the rows that take part.

    Out stay null ids, null or empty vectors, those with null or non-finite components, zero
    vectors, and those whose length is not the most frequent one (of equals, the smallest).
    """
    rows = only(vectors, id_column, vector).toDF("vec_id", "vector").select(
        F.col("vec_id").cast("long"), F.col("vector").cast("array<double>")
    )
    finite = F.forall("vector", lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    there = rows.where(F.col("vec_id").isNotNull() & (F.size("vector") > 0) & finite)
    there = there.where(F.exists("vector", lambda x: x != 0))
    lengths = there.groupBy(F.size("vector").alias("l")).count().orderBy(F.desc("count"), "l").first()
    return there.where(F.size("vector") == (lengths["l"] if lengths else 0))


def nearest(
    vectors: DataFrame,
    every: int,
    id_column: str = "vec_id",
    vector: str = "embedding",
    neighbours: int = NEIGHBOURS,
    share: float = SHARE,
) -> DataFrame:
    """The nearest found to each query: rows whose id is divisible by `every`.

    Euclidean distance in double precision, on the vectors as given; ties to the smaller id; a
    query's own row is no candidate. How many vectors a query must pass is a share of all, as
    vectors without structure need: there the distances are nearly equal, and a fixed number
    of candidates would find less and less as the table grows. Rows that repeat an id are rows
    like all others: each is a query of its own, and the others of its id are candidates for it.
    Further columns are ignored. An empty table gives no rows.

    Vectors of a group of cells, and the queries that pass through it, meet in blocks of
    bounded size, also where one cell holds a large part of all vectors.
    """
    spark = vectors.sparkSession
    folder = shared_dir(spark, "multi-index")
    # ids may repeat: what tells rows apart is a number that is written down with them
    numbered = usable(vectors, id_column, vector).withColumn("row", F.monotonically_increasing_id())
    numbered.write.parquet(f"{folder}/vectors")
    rows = spark.read.schema("vec_id long, vector array<double>, row long").parquet(f"{folder}/vectors")
    result = "query_id long, rank int, vec_id long, score double"
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).toArrow()
    if not len(sample):
        return spark.createDataFrame([], result)
    points = matrix(sample["vector"])
    half = max(1, points.shape[1] // 2)
    first, second = fit_centroids(points[:, :half], CENTROIDS), fit_centroids(points[:, half:], CENTROIDS)
    bare = spark.sparkContext.broadcast(Index(first, second, np.zeros(0)))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                cells = bare.value.cells(matrix(batch.column("vector")))
                yield batch.append_column("cell", pa.array(cells.astype(np.int32)))

    cells_schema = "vec_id long, vector array<double>, row long, cell int"
    rows.mapInArrow(place, cells_schema).write.parquet(f"{folder}/cells")
    placed = spark.read.schema(cells_schema).parquet(f"{folder}/cells")
    counts = np.zeros(len(first) * len(second), np.int64)
    for row in placed.groupBy("cell").count().collect():  # at most one row for each cell
        counts[row["cell"]] = row["count"]
    index = spark.sparkContext.broadcast(Index(first, second, counts))
    candidates = max(LEAST, ceil(share * int(counts.sum())))

    of_group = np.bincount(np.arange(len(counts)) % CELL_GROUPS, counts, CELL_GROUPS)
    blocks = [max(1, ceil(n / BLOCK)) for n in of_group.tolist()]
    chosen = placed.where(F.col("vec_id") % every == 0)
    query_blocks = max(1, ceil(chosen.count() / BLOCK))
    group = F.col("cell") % CELL_GROUPS
    own_blocks = F.element_at(F.array(*map(F.lit, blocks)), F.col("group") + 1)
    entries = (
        placed.withColumn("group", group)
        .withColumn("block", F.pmod(F.xxhash64("vec_id", "row"), own_blocks).cast("int"))
        .withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))))
    )

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = index.value
        for batch in batches:
            marks = (batch.column(name).to_pylist() for name in ("vec_id", "row"))
            for vec_id, row, vector in zip(*marks, matrix(batch.column("vector")) if len(batch) else []):
                cells = np.array(own.walk(vector, candidates), np.int32)
                groups = cells % CELL_GROUPS
                found = [cells[groups == g] for g in np.unique(groups)]
                yield pa.record_batch(
                    {
                        "query_id": pa.array([vec_id] * len(found), pa.int64()),
                        "query_row": pa.array([row] * len(found), pa.int64()),
                        "query": pa.array([vector] * len(found), pa.list_(pa.float64())),
                        "group": pa.array(np.unique(groups)),
                        "cells": pa.array(found, pa.list_(pa.int32())),
                    }
                )

    walked = "query_id long, query_row long, query array<double>, group int, cells array<int>"
    walks = (
        chosen.select("vec_id", "row", "vector")
        .mapInArrow(walk, walked)
        .withColumn("part", F.pmod(F.xxhash64("query_row"), F.lit(query_blocks)).cast("int"))
        .withColumn("block", F.explode(F.sequence(F.lit(0), own_blocks - 1)))
    )

    def rank(left: pa.Table, right: pa.Table) -> pa.Table:
        ids, cells, numbers = (left[name].to_numpy() for name in ("vec_id", "cell", "row"))
        points = matrix(left["vector"])
        order = np.argsort(cells, kind="stable")
        ids, cells, numbers, points = ids[order], cells[order], numbers[order], points[order]
        queries, own_rows, ranked, scores = [], [], [], []
        own_cells = right["cells"].combine_chunks()
        marks = (right[name].to_pylist() for name in ("query_id", "query_row"))
        each = zip(*marks, matrix(right["query"]) if len(right) else [])
        for place, (query_id, query_row, query) in enumerate(each):
            wanted = np.sort(own_cells[place].values.to_numpy())
            starts, stops = np.searchsorted(cells, wanted), np.searchsorted(cells, wanted, "right")
            at = np.concatenate([np.arange(a, b) for a, b in zip(starts, stops)])
            at = at[numbers[at] != query_row]
            distance = np.sqrt(((points[at] - query) ** 2).sum(1))
            best = np.lexsort((ids[at], distance))[:neighbours]
            queries.append(np.full(len(best), query_id))
            own_rows.append(np.full(len(best), query_row))
            ranked.append(ids[at][best])
            scores.append(distance[best])
        none = np.zeros(0)
        return pa.table(
            {
                "query_id": pa.array(np.concatenate([none, *queries]).astype(np.int64)),
                "query_row": pa.array(np.concatenate([none.astype(np.int64), *own_rows])),
                "vec_id": pa.array(np.concatenate([none.astype(np.int64), *ranked])),
                "score": pa.array(np.concatenate([none, *scores])),
            }
        )

    keys = ["group", "block", "part"]
    found = (
        entries.groupBy(*keys)
        .cogroup(walks.groupBy(*keys))
        .applyInArrow(rank, "query_id long, query_row long, vec_id long, score double")
    )
    by_score = Window.partitionBy("query_row").orderBy("score", "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= neighbours)
    return ranked.select("query_id", F.col("rank").cast("int"), "vec_id", "score")
