"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tapeloom.sources.paths import shared_dir

MOST_ROUNDS = 64


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of `edges` (a, b); the smallest node names its component.

    Every node starts with its own label. In a round, the label of an edge's one end is offered
    to its other end and to the node that the other end is labelled with; each takes the
    smallest label offered, and then the label of its label. Labels only fall and stay in the
    component; when none changes, all are the smallest of their component. As labelled nodes are
    offered labels too, whole trees move at once, and a chain of n nodes takes about log n
    rounds, not n. Labels are written to the shared folder after each round, so a lost
    executor repeats one round at most. Offers to a node with very many edges are reduced
    within tasks before they are shuffled.
    """
    spark = edges.sparkSession
    folder = shared_dir(spark, "components")
    both = edges.where("a != b").select("a", "b")
    both = both.unionByName(both.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both.write.parquet(f"{folder}/edges")
    both = spark.read.schema("a long, b long").parquet(f"{folder}/edges")

    # the first round from labels that are the nodes themselves
    offers = both.select(F.col("a").alias("node"), F.least("a", "b").alias("label"))
    labels, state = _round(offers, f"{folder}/1")
    for number in range(2, MOST_ROUNDS):
        of_a = labels.toDF("a", "a_label")
        of_b = labels.toDF("b", "b_label")
        named = both.join(of_a, "a").join(of_b, "b")
        to = F.explode(F.array("a", "a_label")).alias("node")
        offers = named.select(to, F.col("b_label").alias("label")).unionByName(_jumped(labels))
        before = state
        labels, state = _round(offers, f"{folder}/{number}")
        if state == before:
            return labels.toDF("node", "component")
    raise RuntimeError(f"no components after {MOST_ROUNDS} rounds")


def _jumped(labels: DataFrame) -> DataFrame:
    """Each node with its label's label."""
    far = labels.toDF("label", "far")
    return labels.join(far, "label").select("node", F.col("far").alias("label"))


def _round(offers: DataFrame, folder: str) -> tuple[DataFrame, tuple]:
    """The smallest label offered to each node, written; and the number of nodes and a sum of hashes."""
    seen = Observation()
    total = F.sum(F.xxhash64("node", "label").cast("decimal(38,0)")).alias("hashes")
    least = offers.groupBy("node").agg(F.min("label").alias("label"))
    least.observe(seen, F.count(F.lit(1)).alias("nodes"), total).write.parquet(folder)
    labels = offers.sparkSession.read.schema("node long, label long").parquet(folder)
    found = seen.get
    return labels, (found["nodes"], found["hashes"])
