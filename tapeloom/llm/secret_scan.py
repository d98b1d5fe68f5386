"""Secret scans over a ledger of texts: what has been scanned by a rule's version is not again.

Every text ever seen is addressed by the SHA-256 of its content, its blob. The ledger keeps
for each blob which versions of which rules have scanned it and what they found. A scan adds
only what is missing, one text for each blob, and then joins findings back to all paths, that
is, to every document and every historical version that holds the same content. Everything
here is DataFrame functions.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeloom.llm.spans import count_of, joined, labelled, matches, redact, searchable
from tapeloom.llm.words import unused
from tapeloom.sources.paths import glob, shared_dir


@dataclass(frozen=True)
class Rule:
    """A pattern, and which part of a match must have how many characters at least.

    A changed rule gets a new version, so that texts it has scanned before are due again.
    """

    kind: str
    version: int
    pattern: str
    least: int = 0
    group: int = 0
    hint: str | None = None

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"

    def spans(self, searched: Column, order: int) -> Column:
        found = matches(searched, self.pattern, self.hint)
        if self.least:
            part = lambda s: F.regexp_extract(s["value"], self.pattern, self.group)
            found = F.filter(found, lambda s: F.length(part(s)) >= self.least)
        return labelled(found, self.kind, order)


# The patterns of the base kinds, then those that this operator adds. A run that
# is too short is not matched at all where that cannot hide a longer one.
BASE_RULES = [
    Rule(
        "assign",
        1,
        r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        least=8,
        group=1,
    ),
    Rule("access", 1, r"AKIA[A-Z0-9]{12,}", hint="AKIA"),
    Rule("hex", 1, r"[0-9a-f]{32,}"),
]
ADDED_RULES = [
    Rule("private_key", 1, r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----", hint="PRIVATE KEY-----"),
    Rule("code_host", 1, r"gh[opsur]_[A-Za-z0-9]{36,}", hint="gh"),
    Rule("chat", 1, r"xox[abprs]-[A-Za-z0-9-]{10,}", hint="xox"),
    Rule("web_token", 1, r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", hint="eyJ"),
]
RULES = BASE_RULES + ADDED_RULES

FOUND = "array<struct<start:int,kind_order:int,kind:string,stop:int>>"
LEDGER = f"blob binary, scanned array<string>, found {FOUND}"
REDACTED = "[secret]"


def blob(text: Column) -> Column:
    """The address of a content; null counts as empty."""
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256))


class Ledger:
    """The table of scanned blobs: one folder for each scan, complete or not seen at all."""

    def __init__(self, spark: SparkSession, path: str, rules: list[Rule] = RULES):
        self.spark = spark
        self.path = path
        self.rules = rules

    def read(self) -> DataFrame | None:
        scans = [p.rpartition("/")[0] for p in glob(self.spark, f"{self.path}/scan-*/_SUCCESS")]
        return self.spark.read.schema(LEDGER).parquet(*scans) if scans else None

    def scan(self, texts: DataFrame, text: str = "text") -> None:
        """Scan what is new: blobs not in the ledger, and known ones by new rule versions.

        Texts are reduced to one for each blob within tasks before they are shuffled, so a
        content with very many copies is no hot key.
        """
        rows = texts.select(F.col(f"`{text}`").alias("text")).withColumn("blob", blob(F.col("text")))
        blobs = rows.groupBy("blob").agg(F.first("text").alias("text"))
        known = self.read()
        keys = F.array(*[F.lit(rule.key) for rule in self.rules])
        if known is None:
            due = blobs.withColumn("due", keys)
        else:
            seen = known.groupBy("blob").agg(F.flatten(F.collect_list("scanned")).alias("seen"))
            due = blobs.join(seen, "blob", "left").withColumn(
                "due", F.array_except(keys, F.coalesce("seen", F.array().cast("array<string>")))
            )
            due = due.where(F.size("due") > 0)
        searched = due.select("blob", "due", searchable(F.col("text")).alias("text"))
        none = F.array().cast(FOUND)
        first_scan = known is None
        per_rule = []
        for order, rule in enumerate(self.rules):
            spans = rule.spans(F.col("text"), order)
            wanted = F.array_contains("due", rule.key)
            per_rule.append(spans if first_scan else F.when(wanted, spans).otherwise(none))
        found = searched.select("blob", F.col("due").alias("scanned"), F.concat(*per_rule).alias("found"))
        number = len(glob(self.spark, f"{self.path}/scan-*"))
        found.write.parquet(f"{self.path}/scan-{number:06d}")

    def findings(self) -> DataFrame:
        """One row for each blob in which the current rules found something.

        Written to the ledger's folder, so that the join back is with a plain table of known
        size: broadcast if Spark finds it small, else by a shuffle that can be split.
        """
        keys = F.array(*[F.lit(rule.key) for rule in self.rules])
        kinds = F.transform(
            F.array_intersect("scanned", keys), lambda key: F.split_part(key, F.lit("@"), F.lit(1))
        )
        current = self.read().withColumn("kinds", kinds)
        found = F.filter("found", lambda span: F.array_contains(F.col("kinds"), span["kind"]))
        hits = current.select("blob", found.alias("found")).where(F.size("found") > 0)
        whole = hits.groupBy("blob").agg(F.array_sort(F.flatten(F.collect_list("found"))).alias("found"))
        folder = f"{self.path}/findings-{uuid.uuid4().hex}"
        whole.write.parquet(folder)
        return self.spark.read.schema(f"blob binary, found {FOUND}").parquet(folder)

    def join_back(self, paths: DataFrame, text: str = "text", name: str = "_found") -> DataFrame:
        """All rows of `paths` and a new column with the spans in their text by start, then kind.

        Only blobs with findings are joined. A hot blob makes a hot key on the side of the
        paths; adaptive execution splits it, as every blob has one row on the other side.
        """
        own, hit = unused(paths, "_blob", "_hit")
        rows = paths.withColumn(own, blob(F.col(f"`{text}`")))
        hits = self.findings().withColumnsRenamed({"blob": hit, "found": name})
        return rows.join(hits, rows[own] == hits[hit], "left").drop(own, hit)


def scan_documents(
    docs: DataFrame,
    ledger: Ledger | None = None,
    id_column: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Counts, digest and list of the secrets of every document.

    A null text counts as empty. Repeated rows, rows with a null id and several versions of
    a document are paths like any other; further columns are ignored. Without a ledger a new
    one is kept in the shared folder.
    """
    spark = docs.sparkSession
    ledger = ledger or Ledger(spark, shared_dir(spark, "secret-ledger"))
    rows = docs.select(
        F.col(f"`{id_column}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text")
    )
    ledger.scan(rows)
    found = F.coalesce("_found", F.array().cast(FOUND))
    each = ledger.join_back(rows).select("doc_id", found.alias("found"))
    base_kinds = [rule.kind for rule in BASE_RULES]
    base = F.filter("found", lambda span: span["kind"].isin(base_kinds))
    counts = [count_of(F.col("found"), kind).alias(f"n_{kind}") for kind in base_kinds]
    return each.select(
        "doc_id",
        *counts,
        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("found")).alias("spans"),
    )


def redact_documents(docs: DataFrame, ledger: Ledger | None = None, text: str = "text") -> DataFrame:
    """All rows and columns, with every secret in the texts replaced; null texts stay null.

    Where there is a column `n_chars`, it follows the new text.
    """
    spark = docs.sparkSession
    ledger = ledger or Ledger(spark, shared_dir(spark, "secret-ledger"))
    ledger.scan(docs, text)
    column = F.col(f"`{text}`")
    (name,) = unused(docs, "_found")
    clean = F.col(name).isNull()
    rows = ledger.join_back(docs, text, name).withColumn(
        text, F.when(clean, column).otherwise(redact(column, F.col(name), REDACTED))
    )
    if "n_chars" in docs.columns:
        length = F.length(column).cast(docs.schema["n_chars"].dataType)
        rows = rows.withColumn("n_chars", F.when(clean, F.col("n_chars")).otherwise(length))
    return rows.select(*[f"`{name}`" for name in docs.columns])
