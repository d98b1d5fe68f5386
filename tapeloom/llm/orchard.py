"""Vector codes by product quantisation, where nearest entries are found by Orchard search.

A vector's components become integers and it is cut into equal parts; each part position has a
codebook of 16 entries, refined in rounds. Every entry has a list of all entries by distance. The
search starts at some entry and walks its list; at an entry closer to the part it jumps to
that entry's list. What was visited is marked and not measured again, and the walk ends beyond
twice the current distance, where by the triangle inequality nothing closer can be.

A round is one pass over the table: tasks add up the parts of each entry, and what is shuffled is
one row a task, part position, entry and component. Codebooks are 16 vectors, whatever the table.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapeloom.llm.words import only
from tapeloom.sources.paths import shared_dir

# The scale of integers, parts, entries and rounds.
SCALE = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6

# Below this every squared distance and every sum of a batch fits in 64 bits.
_SMALL = 1 << 28
_BATCH = 1 << 13
_LIMB = 60
_LIMBS = {T.FloatType: 4, T.DoubleType: 20}  # of 60 bits: the largest component, and 2^64 of them


def measurable(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return vector.isNotNull() & ~F.coalesce(F.exists(vector, bad), F.lit(False))


def integers(values: np.ndarray) -> np.ndarray:
    """floor(4096 x) of finite numbers: 64-bit where these are small, else Python's integers."""
    values = values.astype(np.float64)
    if not values.size or np.abs(values).max() < _SMALL / SCALE:
        return np.floor(values * SCALE).astype(np.int64)
    exact = [int(x) * SCALE if abs(x) >= 2.0**53 else math.floor(x * SCALE) for x in values.ravel().tolist()]
    found = np.empty(len(exact), object)
    found[:] = exact
    return found.reshape(values.shape)


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return ((a - b) * (a - b)).sum(axis=-1)


class Book:
    """The entries of one part position, each with a list of all entries by distance."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        self.distances = squared(entries[:, None], entries[None])
        numbers = np.arange(len(entries))
        self.lists = np.array([sorted(numbers, key=lambda e: (row[e], e)) for row in self.distances], np.int64)
        self.reach = np.take_along_axis(self.distances, self.lists, axis=1)
        self.by_first = np.argsort(entries[:, 0], kind="stable") if entries.shape[1] else numbers

    def guess(self, points: np.ndarray) -> np.ndarray:
        """Where to start: an entry whose first component is next to the point's."""
        if not points.shape[1]:
            return np.zeros(len(points), np.int64)
        places = np.searchsorted(self.entries[self.by_first, 0], points[:, 0])
        return self.by_first[np.minimum(places, len(self.by_first) - 1)]

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Each point's nearest entry, the lower one of ties, its squared distance; and how many were measured."""
        many = len(self.entries)
        current = self.guess(points)
        best = squared(points, self.entries[current])
        visited = np.zeros((len(points), many), bool)
        visited[np.arange(len(points)), current] = True
        place, walking, measured = np.zeros(len(points), np.int64), np.arange(len(points)), len(points)
        while True:
            walking = walking[place[walking] < many]
            own, at = current[walking], place[walking]
            # twice the distance is four times its square; at exactly that an entry may tie
            inside = (self.reach[own, at] <= 4 * best[walking]).astype(bool)
            walking, own, at = walking[inside], own[inside], at[inside]
            if not len(walking):
                return current, best, measured
            place[walking] += 1
            other = self.lists[own, at]
            new = ~visited[walking, other]
            moved, other = walking[new], other[new]
            visited[moved, other] = True
            measured += len(moved)
            distance = squared(points[moved], self.entries[other])
            better = ((distance < best[moved]) | ((distance == best[moved]) & (other < current[moved]))).astype(bool)
            moved = moved[better]
            current[moved], best[moved], place[moved] = other[better], distance[better], 0


def books_of(codebooks: list[list[list[int]]]) -> list[Book]:
    """Books of the entries' components, by part position; 64-bit where all are small."""
    small = all(abs(x) < _SMALL for part in codebooks for entry in part for x in entry)
    return [Book(np.array(part, np.int64 if small else object).reshape(len(part), -1)) for part in codebooks]


def assign(vectors: np.ndarray, books: list[Book]) -> tuple[np.ndarray, np.ndarray]:
    """Codes and summed squared distances of vectors of integers, one row each."""
    if books[0].entries.dtype == object or vectors.dtype == object:
        vectors = vectors.astype(object)
    width = vectors.shape[1] // len(books)
    codes, errors = np.zeros((len(vectors), len(books)), np.int64), np.zeros(len(vectors), vectors.dtype)
    for number, book in enumerate(books):
        part = vectors[:, number * width : (number + 1) * width]
        codes[:, number], best, _ = book.nearest(part)
        errors = errors + best
    return codes, errors


def _vectors(batch: pa.RecordBatch, width: int) -> Iterator[tuple[int, np.ndarray]]:
    """The vectors of the codebooks' length, as integers, in blocks, with the places of their rows."""
    column = batch.column("vector")
    sizes = column.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    fitting = np.flatnonzero(sizes == width)
    for start in range(0, len(fitting), _BATCH):
        places = fitting[start : start + _BATCH]
        held = column.take(pa.array(places))
        values = held.flatten().to_numpy(zero_copy_only=False).reshape(len(places), width)
        yield places, integers(values)


def _limbs(value: int, many: int) -> list[int]:
    """A sum in limbs of 60 bits; the last has the sign."""
    mask = (1 << _LIMB) - 1
    return [(value >> (_LIMB * i)) & mask for i in range(many - 1)] + [value >> (_LIMB * (many - 1))]


def _sums(codebooks: list, width: int, limbs: int):
    """The task of a round: sums and counts of the parts assigned to each entry."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = books_of(codebooks)
        cut, many = width // PARTS, len(codebooks[0])
        sums = np.zeros((PARTS, many, cut), object)
        counts = np.zeros((PARTS, many), np.int64)
        for batch in batches:
            for _, vectors in _vectors(batch, width):
                codes, _ = assign(vectors, books)
                for part in range(PARTS):
                    own = vectors[:, part * cut : (part + 1) * cut]
                    added = np.zeros((many, cut), own.dtype)
                    np.add.at(added, codes[:, part], own)
                    sums[part] += added.astype(object)
                    counts[part] += np.bincount(codes[:, part], minlength=many)
        parts, entries, places = np.nonzero(np.broadcast_to(counts[:, :, None] > 0, sums.shape))
        rows = [_limbs(int(sums[key]), limbs) for key in zip(parts, entries, places)]
        columns = [parts, entries, places, counts[parts, entries]] + [[row[i] for row in rows] for i in range(limbs)]
        names = ["part", "entry", "place", "held"] + [f"limb{i}" for i in range(limbs)]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

    return task


def _coded(codebooks: list, width: int):
    """The last pass: every row's code and error; none for a vector of another length."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = books_of(codebooks)
        for batch in batches:
            codes: list[str | None] = [None] * batch.num_rows
            errors: list[int | None] = [None] * batch.num_rows
            for places, vectors in _vectors(batch, width):
                found, error = assign(vectors, books)
                for place, code, e in zip(places.tolist(), found.astype(np.uint8), error.tolist()):
                    codes[place] = code.tobytes().hex()
                    errors[place] = e if e < 1 << 63 else None
            columns = [batch.column("vec_id"), batch.column("label"), pa.array(codes, pa.string()), pa.array(errors, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "label", "code", "error"])

    return task


def train(vectors: DataFrame, rounds: int = ROUNDS) -> list[list[list[int]]]:
    """Codebooks by part, entry and place, from (vec_id, vector) rows that are measurable.

    The seeds are the first rows by id, then by vector; rows without id come last.
    """
    seeds = vectors.orderBy(F.asc_nulls_last("vec_id"), "vector").limit(ENTRIES).collect()
    if not seeds:
        return []
    width = len(seeds[0]["vector"])
    if width % PARTS:
        raise ValueError(f"vectors of {width} components cannot be cut into {PARTS} equal parts")
    cut = width // PARTS
    first = [integers(np.array(row["vector"], np.float64)).tolist() for row in seeds if len(row["vector"]) == width]
    books = [[row[part * cut : (part + 1) * cut] for row in first] for part in range(PARTS)]
    element = vectors.schema["vector"].dataType.elementType
    limbs = _LIMBS.get(type(element), _LIMBS[T.DoubleType])
    names = [f"limb{i}" for i in range(limbs)]
    schema = ", ".join(f"{name} long" for name in ["part", "entry", "place", "held", *names])
    for _ in range(rounds):
        sums = vectors.select("vector").mapInArrow(_sums(books, width, limbs), schema)
        total = sums.groupBy("part", "entry", "place").agg(
            F.sum("held").alias("held"), *[F.sum(F.col(n).cast("decimal(38,0)")).alias(n) for n in names]
        )
        for row in total.collect():  # one row for each component of a codebook
            value = sum(int(row[name]) << (_LIMB * i) for i, name in enumerate(names))
            books[row["part"]][row["entry"]][row["place"]] = value // row["held"]
    return books


def codebooks_digest(codebooks: list[list[list[int]]]) -> str:
    values = (str(x) for part in codebooks for entry in part for x in entry)
    return hashlib.sha256(",".join(values).encode()).hexdigest()


def encode(vectors: DataFrame, codebooks: list[list[list[int]]]) -> DataFrame:
    """vec_id, label, code and error of each row."""
    width = PARTS * len(codebooks[0][0])
    label = vectors.schema["label"].dataType.simpleString()
    return vectors.select("vec_id", "label", "vector").mapInArrow(
        _coded(codebooks, width), f"vec_id long, label {label}, code string, error long"
    )


def compress(
    rows: DataFrame, id_column: str = "vec_id", vector: str = "embedding", label: str = "label", rounds: int = ROUNDS
) -> DataFrame:
    """vec_id, code, error, label_error and codebooks_sha256 of every vector that can be measured.

    Rows whose vector is null or holds null or non-finite components take no part. Repeated
    rows and ids are a row each; with fewer than 16 rows codebooks have fewer entries, and
    with none there is no row. A vector of another length than that of the smallest id has
    no code and no error, and an error beyond 64 bits is null. Rows without label are one
    label. Further columns take no part. The length must be a multiple of 8.
    """
    spark = rows.sparkSession
    kept = only(rows, id_column, vector, label).toDF("vec_id", "vector", "label").where(measurable(F.col("vector")))
    kept = kept.withColumn("vec_id", F.col("vec_id").cast("long"))
    codebooks = train(kept.select("vec_id", "vector"), rounds)
    folder = shared_dir(spark, "codes")
    if not codebooks:
        return kept.select(
            "vec_id", F.lit("").alias("code"), *[F.lit(0).cast("long").alias(n) for n in ("error", "label_error")],
            F.lit("").alias("codebooks_sha256"),
        )
    coded = encode(kept, codebooks)
    coded.write.parquet(folder)
    coded = spark.read.schema(coded.schema).parquet(folder)
    totals = coded.groupBy(F.col("label").alias("own_label")).agg(F.sum("error").alias("label_error"))
    return coded.join(totals, F.col("label").eqNullSafe(F.col("own_label"))).select(
        "vec_id", "code", "error", "label_error", F.lit(codebooks_digest(codebooks)).alias("codebooks_sha256")
    )
