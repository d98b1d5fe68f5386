"""A Merkle manifest of a dataset: one root, and a proof for every row, by time-forward processing.

Every source is a tree whose leaves are its rows by id; the sources' roots are the leaves of
one more tree. A node's label is (the last leaf under it, its level), so children have smaller
labels than their parent. A forward sweep over nodes by label takes the digests of a node's
children out of a priority queue ordered by label and puts its own in for its parent. A reversed
sweep takes a node's proof out, which begins at its parent, and puts longer ones in for its
children, until the leaves have theirs.

The sweeps run over blocks of 16^3 consecutive nodes of a tree. Spark's shuffle sorts what is
known beforehand, and spills; the queue in a task holds at most the unfinished nodes of one
block. What a block leaves, one digest, is a node of the next round's blocks, so a tree of n
leaves takes a twelfth of log2 n rounds, and a large source is as many blocks as it needs.
"""

from __future__ import annotations

import hashlib
import heapq
import itertools
from collections.abc import Iterable, Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapeloom.llm.words import only
from tapeloom.sources.paths import shared_dir

# Children of a node, the fields of a leaf, and which rows are tampered with.
FAN = 16
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
TAMPERED_EVERY = 5

_HEIGHT = 3  # levels of a block
BLOCK = FAN**_HEIGHT
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_FIRST = 1 << 62  # in the order of falling labels

_FORWARD = "tree long, n long, block long, level int, place long, last long, children array<string>, digest string, top boolean"
_PROVED = "tree long, place long, lefts array<string>, rights array<string>"
_NODES = "tree long, n long, place long, digest string, changed string, doc_id long"
_LEAF_PROVED = "doc_id long, tree long, leaf string, proof_sha256 string, folded_root string"
_RESULT = (
    "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
)


def digest_of(parts: Iterable[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


# -- leaves -------------------------------------------------------------------------


def leaf_digest(fields: dict[str, Column]) -> Column:
    """The digest of a row: each field as its length in bytes, a colon and its value; `-` for null."""

    def shown(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*[shown(value) for value in fields.values()]), 256)


def leaves(docs: DataFrame) -> DataFrame:
    """Source, id, digest and, where a row is tampered with, the digest it has then."""
    fields = {name: F.col(name) for name in FIELDS}
    lowered = fields | {"text": F.translate("text", _UPPER, _LOWER)}
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % TAMPERED_EVERY == 0
    return only(docs, *FIELDS).select(
        "source",
        F.col("doc_id").cast("long"),
        leaf_digest(fields).alias("leaf"),
        F.when(chosen, leaf_digest(lowered)).alias("changed"),
    )


def ranked(rows: DataFrame, by: list[str], within: str | None, folder: str) -> DataFrame:
    """`rows` with `place`, their rank by `by`, from 0, overall or within each value of the first of `by`.

    Rows are sorted over all tasks by ranges of `by` and written, each with its place in its
    range; the places where ranges begin are running sums over one row a range and value.
    """
    spark = rows.sparkSession
    (
        rows.repartitionByRange(*by)
        .sortWithinPartitions(*by)
        .withColumn("at", F.monotonically_increasing_id())
        .write.parquet(folder)
    )
    rows = spark.read.parquet(folder).withColumn("range", F.shiftright("at", 33))
    keys = [within] if within else []
    ranges = rows.groupBy("range", *keys).agg(F.count(F.lit(1)).alias("held"), F.min("at").alias("first"))
    before = Window.partitionBy(*keys).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranges.select(
        F.col("range").alias("own_range"),
        *[F.col(key).alias(f"own_{key}") for key in keys],
        (F.coalesce(F.sum("held").over(before), F.lit(0)) - F.col("first")).alias("shift"),
    )
    same = F.col("range") == F.col("own_range")
    for key in keys:
        same = same & F.col(key).eqNullSafe(F.col(f"own_{key}"))
    return rows.join(starts, same).withColumn("place", F.col("at") + F.col("shift")).drop(
        "at", "range", "own_range", "shift", *[f"own_{key}" for key in keys]
    )


# -- sweeps -------------------------------------------------------------------------


def _height(n: int) -> int:
    """Levels of a block's tree that are still to be built above `n` nodes, at most a block's."""
    levels = 0
    while n > 1 and levels < _HEIGHT:
        n, levels = -(-n // FAN), levels + 1
    return levels


def _parent(label: tuple[int, int], n: int) -> tuple[int, int]:
    last, level = label
    span = FAN ** (level + 1)
    return min((last // span + 1) * span, n) - 1, level + 1


class Queue:
    """Messages by the label of the node that they are for."""

    def __init__(self, sign: int = 1):
        self.sign = sign
        self.heap: list = []
        self.put_in = 0

    def put(self, label: tuple[int, int], message) -> None:
        # messages to one node come out in the order in which they were put in
        key = (self.sign * label[0], self.sign * label[1], self.put_in)
        heapq.heappush(self.heap, (key, message))
        self.put_in += 1

    def next_label(self) -> tuple[int, int] | None:
        if not self.heap:
            return None
        (last, level, _), _ = self.heap[0]
        return self.sign * last, self.sign * level

    def take(self, label: tuple[int, int]) -> list:
        found = []
        while self.heap and self.next_label() == label:
            found.append(heapq.heappop(self.heap)[1])
        return found


def forward(nodes: Iterable[tuple[int, int, int, str]]) -> Iterator[tuple]:
    """The inner nodes over sorted rows (tree, n, place, digest), and each block's top.

    Gives (tree, n, block, level, place, last leaf, children, digest, top); a tree of one
    node is its own top, without children.
    """
    queue = Queue()
    for tree, n, place, digest in nodes:
        block, height = place // BLOCK, _height(n)
        if not height:
            yield tree, n, block, 0, place, place, [], digest, True
            continue
        queue.put(_parent((place, 0), n), digest)
        # all labels up to this leaf's have got what they wait for
        while (label := queue.next_label()) is not None and label[0] <= place:
            children = queue.take(label)
            found, (last, level) = digest_of(children), label
            top = level == height
            yield tree, n, block, level, last // FAN**level, last, children, found, top
            if not top:
                queue.put(_parent(label, n), found)


def backward(rows: Iterable[tuple]) -> Iterator[tuple]:
    """Each node's proof, over rows (tree, n, block, last, level, children, proof, node).

    They come block by block, with labels falling: first the proof that the block's top has
    got, then inner nodes with their children and, where `node` is given, the nodes that the
    block stands on. Gives (tree, place, proof, node): a proof is a chain of (left siblings,
    right siblings, chain above), or None at the root.
    """
    queue = Queue(-1)
    for tree, n, block, last, level, children, proof, node in rows:
        if node is not None:
            (own,) = queue.take((last, 0))
            yield tree, last, own, node
        elif children is None:  # the top's label has the block's last node
            queue.put((min((block + 1) * BLOCK, n) - 1, _height(n)), proof)
        else:
            (above,) = queue.take((last, level))
            span = FAN ** (level - 1)
            first = last // (span * FAN) * FAN
            for i in range(len(children)):
                own = ("".join(children[:i]), "".join(children[i + 1 :]), above)
                queue.put((min((first + i + 1) * span, n) - 1, level - 1), own)


def chain_of(lefts: list[str], rights: list[str]):
    chain = None
    for left, right in zip(reversed(lefts), reversed(rights)):
        chain = (left, right, chain)
    return chain


def steps(chain) -> Iterator[tuple[str, str]]:
    while chain is not None:
        left, right, chain = chain
        yield left, right


def _batches(rows: Iterator[tuple], schema: str, types: list[pa.DataType]) -> Iterator[pa.RecordBatch]:
    names = [field.split()[0] for field in schema.split(", ")]
    while held := list(itertools.islice(rows, BLOCK)):
        columns = [pa.array(column, kind) for column, kind in zip(zip(*held), types)]
        yield pa.RecordBatch.from_arrays(columns, names=names)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns))


_LONG, _TEXT, _TEXTS = pa.int64(), pa.string(), pa.list_(pa.string())


def _forward_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    types = [_LONG, _LONG, _LONG, pa.int32(), _LONG, _LONG, _TEXTS, _TEXT, pa.bool_()]
    yield from _batches(forward(_rows(batches)), _FORWARD, types)


def _messages(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for tree, n, block, last, level, children, lefts, rights, *node in _rows(batches):
        if children is not None:
            yield tree, n, block, last, level, children, None, None
        elif lefts is not None:
            yield tree, n, block, last, level, None, chain_of(lefts, rights), None
        else:
            yield tree, n, block, last, level, None, None, node


def _backward_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = (
        (tree, place, [left for left, _ in steps(proof)], [right for _, right in steps(proof)])
        for tree, place, proof, _ in backward(_messages(batches))
    )
    yield from _batches(rows, _PROVED, [_LONG, _LONG, _TEXTS, _TEXTS])


def _leaf_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sweep that ends at leaves: their proofs' digests, and the roots folded with them."""

    def proved() -> Iterator[tuple]:
        for tree, _, chain, (doc_id, leaf, changed) in backward(_messages(batches)):
            proof, folded = hashlib.sha256(), changed or leaf
            for left, right in steps(chain):
                proof.update((left + right).encode())
                folded = digest_of((left, folded, right))
            yield doc_id, tree, leaf, proof.hexdigest(), folded

    yield from _batches(proved(), _LEAF_PROVED, [_LONG, _LONG, _TEXT, _TEXT, _TEXT])


# -- trees --------------------------------------------------------------------------


def build(nodes: DataFrame, most: int, folder: str) -> tuple[DataFrame, list[tuple[DataFrame, DataFrame]]]:
    """Roots (tree, digest) of all trees of `nodes` (tree, n, place, digest), and every round.

    A round is what it stood on and what it found. `most` is the number of nodes of the
    largest tree, which says how many rounds there are.
    """
    spark, rounds, roots = nodes.sparkSession, [], None
    while True:
        path = f"{folder}/forward-{len(rounds)}"
        (
            nodes.select("tree", "n", "place", "digest")
            .repartition("tree", F.floor(F.col("place") / BLOCK))
            .sortWithinPartitions("tree", "place")
            .mapInArrow(_forward_task, _FORWARD)
            .write.parquet(path)
        )
        found = spark.read.schema(_FORWARD).parquet(path)
        rounds.append((nodes, found))
        tops = found.where("top").select(
            "tree", F.ceil(F.col("n") / BLOCK).alias("n"), F.col("block").alias("place"), "digest"
        )
        done = tops.where("n = 1").select("tree", "digest")
        roots = done if roots is None else roots.unionByName(done)
        most = -(-most // BLOCK)
        if most == 1:
            return roots, rounds
        nodes = tops.where("n > 1")


def _swept(nodes: DataFrame, found: DataFrame, proofs: DataFrame, carried: list[str]) -> DataFrame:
    """A round's nodes, its inner nodes and the proofs of its blocks' tops, by falling label."""
    block = F.floor(F.col("place") / BLOCK)
    tops = found.where("top").select("tree", "n", "block")
    kinds = [
        found.where("level > 0").select("tree", "n", "block", "last", "level", "children"),
        proofs.withColumnRenamed("place", "block").join(tops, ["tree", "block"]).withColumn("last", F.lit(_FIRST)),
        nodes.select("tree", "n", block.alias("block"), F.col("place").alias("last"), *carried),
    ]
    names = ["tree", "n", "block", "last", "level", "children", "lefts", "rights", *carried]
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), kinds)
    rows = rows.withColumn("level", F.coalesce("level", F.lit(0))).select(*names)
    return rows.repartition("tree", "block").sortWithinPartitions(
        "tree", "block", F.desc("last"), F.desc("level")
    )


def prove(rounds: list, proofs: DataFrame, folder: str) -> DataFrame:
    """The proofs (tree, place, lefts, rights) of the blocks' tops of the lowest round.

    `proofs` are those of the trees' roots, at place 0. A tree that took fewer rounds than
    the largest joins in at its last.
    """
    spark, came = proofs.sparkSession, None
    for number in range(len(rounds) - 1, -1, -1):
        nodes, found = rounds[number]
        done = found.where(f"top and n <= {BLOCK}").select("tree")
        here = proofs.join(done, "tree", "left_semi")
        came = here if came is None else came.unionByName(here)
        if number:
            path = f"{folder}/backward-{number}"
            _swept(nodes, found, came, []).mapInArrow(_backward_task, _PROVED).write.parquet(path)
            came = spark.read.schema(_PROVED).parquet(path)
    return came


def manifest(docs: DataFrame) -> DataFrame:
    """Each row's leaf, its source's subroot, the root, its proof's digest, and what its fold gives.

    Gives doc_id, leaf, subroot, root, proof_sha256, folded_root and verified. Null fields are
    `-` in a leaf; rows without source are a source of their own, rows without id come first in
    theirs; rows with equal ids come by digest, and equal rows have equal leaves and a row and proof
    each. An empty text is a text of length 0. Further columns take no part. An empty table gives none.
    """
    spark = docs.sparkSession
    folder = shared_dir(spark, "merkle")
    # written first: the ranges are found from a sample, for which texts would be read once more
    leaves(docs).write.parquet(f"{folder}/digests")
    digests = spark.read.schema("source string, doc_id long, leaf string, changed string").parquet(f"{folder}/digests")
    placed = ranked(digests, ["source", "doc_id", "leaf"], "source", f"{folder}/leaves")
    sizes = placed.groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    trees = ranked(sizes, ["source"], None, f"{folder}/sources").select("source", "n", "place")
    largest, many = trees.agg(F.max("n"), F.count(F.lit(1))).first()
    if not many:
        return spark.createDataFrame([], _RESULT)

    own = trees.select(F.col("source").alias("own_source"), "n", F.col("place").alias("tree"))
    (
        placed.join(own, F.col("source").eqNullSafe(F.col("own_source")))
        .select("tree", "n", "place", F.col("leaf").alias("digest"), "changed", "doc_id")
        .write.parquet(f"{folder}/nodes")
    )
    nodes = spark.read.schema(_NODES).parquet(f"{folder}/nodes")
    subroots, rounds = build(nodes, largest, f"{folder}/rows")
    over = subroots.select(
        F.lit(0).cast("long").alias("tree"), F.lit(many).alias("n"), F.col("tree").alias("place"), "digest"
    )
    roots, over_rounds = build(over, many, f"{folder}/subroots")
    root = F.lit(roots.first()["digest"])

    # the root's proof is empty; where a subroot's ends, those of its tree's nodes go on
    nothing = F.array().cast("array<string>")
    empty = spark.range(1).select(
        F.col("id").alias("tree"), F.col("id").alias("place"), nothing.alias("lefts"), nothing.alias("rights")
    )
    above = prove(over_rounds, empty, f"{folder}/subroots")
    path = f"{folder}/subroots/backward-0"
    _swept(*over_rounds[0], above, []).mapInArrow(_backward_task, _PROVED).write.parquet(path)
    proofs = spark.read.schema(_PROVED).parquet(path).select(
        F.col("place").alias("tree"), F.lit(0).cast("long").alias("place"), "lefts", "rights"
    )
    tops = prove(rounds, proofs, f"{folder}/rows")
    swept = _swept(nodes, rounds[0][1], tops, ["doc_id", "digest", "changed"]).mapInArrow(_leaf_task, _LEAF_PROVED)
    return swept.join(subroots.select("tree", F.col("digest").alias("subroot")), "tree").select(
        "doc_id",
        "leaf",
        "subroot",
        root.alias("root"),
        "proof_sha256",
        "folded_root",
        (F.col("folded_root") == root).alias("verified"),
    )
