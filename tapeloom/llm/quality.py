"""Quality rules, line first: drop failing lines, then documents that lose too much text."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapeloom.llm.words import WINDOW, hash_windows, hash_words, only, raw_texts

# Fixed values of the base counts.
SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 10
MAX_REPEATED_PERCENT = 20
# Fixed values of the line rules.
END_MARKS = b".!?:;,\"')]}"
# Those of scripts with marks of their own: Armenian, Hebrew, Arabic, Syriac, Indic, Tibetan,
# Burmese, Ethiopic, Khmer, Mongolian, CJK and its wide forms.
OTHER_END_MARKS = [
    mark.encode()
    for mark in "՛՜՝՞։׃،؛؟۔܀܁܂।॥།༎၊။።፣፤፥፦፧፨។៕᠂᠃᠈᠉、。」』】！），．：；？］｝｡､｣"
]
SEPARATORS = [b"|", b">", b"\xc2\xbb", b"\xe2\x80\xba"]
BOILERPLATE = [
    b"all rights reserved",
    b"cookie policy",
    b"enable javascript",
    b"lorem ipsum",
    b"privacy policy",
    b"sign up for our newsletter",
    b"terms of service",
    b"terms of use",
]

SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
    "n_repeat_words long, base_failed boolean, kept boolean, "
    "n_lines long, n_failed_lines long, lost_chars long"
)


@dataclass(frozen=True)
class LineRules:
    """Limits of the line rules, and of the text a document may lose to them."""

    symbol_percent: int = 30  # of a line's words hold a symbol: markup or junk
    separator_words: int = 2  # this many words that are only separators: navigation
    unpunctuated_words: int = 40  # a longer line without any end mark is no prose
    lost_percent: int = 50  # of a document's word characters in failed lines: rejected


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a window of five words found twice or more in the text."""
    if len(words) <= WINDOW:
        return 0
    windows = hash_windows(hash_words(words))
    _, inverse, counts = np.unique(windows, return_inverse=True, return_counts=True)
    twice = counts[inverse] > 1
    covered = np.zeros(len(words), bool)
    for place in range(WINDOW):
        covered[place : place + len(twice)] |= twice
    return int(covered.sum())


def line_fails(line: bytes, words: list[bytes], repeated: bool, rules: LineRules) -> bool:
    """Whether a line with words breaks a rule: boilerplate, navigation or punctuation."""
    if repeated:
        return True
    lowered = line.lower()
    if any(phrase in lowered for phrase in BOILERPLATE):
        return True
    if sum(word in SEPARATORS for word in words) >= rules.separator_words:
        return True
    marked = sum(len(word.translate(None, SYMBOLS)) < len(word) for word in words)
    if 100 * marked > rules.symbol_percent * len(words):
        return True
    bare = len(line.translate(None, END_MARKS)) == len(line)
    if not bare or len(words) < rules.unpunctuated_words:
        return False
    return not any(mark in line for mark in OTHER_END_MARKS)


def measure(raw: bytes, rules: LineRules) -> tuple:
    """The columns of SCHEMA after the id, for one whole text."""
    words = raw.split()
    word_chars = len(b"".join(words).decode("utf-8", "replace"))
    symbols = len(raw) - len(raw.translate(None, SYMBOLS))
    seen: set[bytes] = set()
    lines = dup_lines = failed = lost = 0
    for line in raw.split(b"\n"):
        own = line.split()
        if not own:
            continue
        lines += 1
        repeated = line in seen
        seen.add(line)
        dup_lines += repeated
        if line_fails(line, own, repeated, rules):
            failed += 1
            lost += len(b"".join(own).decode("utf-8", "replace"))
    repeats = repeated_words(words)
    base_failed = len(words) < MIN_WORDS or 100 * repeats > MAX_REPEATED_PERCENT * len(words)
    kept = not base_failed and 100 * lost <= rules.lost_percent * word_chars
    return (
        len(words), word_chars, symbols, dup_lines, repeats, base_failed, kept, lines, failed, lost
    )


def clean_text(raw: bytes, rules: LineRules) -> bytes:
    """The text without its failing lines; lines without words stay."""
    seen: set[bytes] = set()
    kept = []
    for line in raw.split(b"\n"):
        words = line.split()
        if words:
            repeated = line in seen
            seen.add(line)
            if line_fails(line, words, repeated, rules):
                continue
        kept.append(line)
    return b"\n".join(kept)


def assess(
    docs: DataFrame, rules: LineRules = LineRules(), id_column: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Counts and verdict of every document, in a map-only job.

    A null or empty text has no words and fails. Repeated rows are each assessed, rows with a
    null id too; further columns are ignored. Memory: the words of one text.
    """
    names = [field.split()[0] for field in SCHEMA.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [measure(raw or b"", rules) for raw in raw_texts(batch)]
            columns = list(zip(*rows)) if rows else [()] * (len(names) - 1)
            kinds = [pa.bool_() if n in ("base_failed", "kept") else pa.int64() for n in names[1:]]
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
            yield pa.record_batch([batch.column("doc_id"), *arrays], names=names)

    rows = only(docs, id_column, text).toDF("doc_id", "text")
    return rows.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, SCHEMA)


def keep_good(docs: DataFrame, rules: LineRules = LineRules(), text: str = "text") -> DataFrame:
    """The rows, with all their columns, of documents that the rules keep; texts stay whole.

    The rows themselves go through the rules, so nothing is joined and repeated rows, or rows
    with a null id, are judged each by its own text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            verdicts = [measure(raw or b"", rules)[6] for raw in raw_texts(batch, text)]
            yield batch.filter(pa.array(verdicts, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def keep_clean(docs: DataFrame, rules: LineRules = LineRules(), text: str = "text") -> DataFrame:
    """The rows of documents that the rules keep, their texts without the lines that fail.

    All columns are kept. Where there is a column `n_chars` of whole numbers, it follows the new
    text; a text none of whose lines fails, and its row, stay as they are.
    """
    counted = {f.name: f.dataType for f in docs.schema.fields}.get("n_chars")
    follows = isinstance(counted, (T.IntegerType, T.LongType))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, kept = batch.schema.get_field_index(text), []
            texts, changed = [], []
            for raw in raw_texts(batch, text):
                *_, keep, _, failed, _ = measure(raw or b"", rules)
                kept.append(keep)
                if keep:
                    texts.append(clean_text(raw, rules) if failed else raw)
                    changed.append(failed > 0)
            batch = batch.filter(pa.array(kept, pa.bool_()))
            cleaned = pa.array(texts, pa.binary()).cast(batch.schema.field(at).type)
            batch = batch.set_column(at, batch.schema.field(at), cleaned)
            if follows:
                at = batch.schema.get_field_index("n_chars")
                lengths = pc.utf8_length(cleaned).cast(batch.column(at).type)
                followed = pc.if_else(pa.array(changed, pa.bool_()), lengths, batch.column(at))
                batch = batch.set_column(at, batch.schema.field(at), followed)
            yield batch

    return docs.mapInArrow(run, docs.schema)


def clean_lines(
    docs: DataFrame, rules: LineRules = LineRules(), id_column: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Each document's text without its failing lines; a null text stays null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [None if raw is None else clean_text(raw, rules) for raw in raw_texts(batch)]
            cleaned = pa.array(texts, pa.binary()).cast(pa.string())
            yield pa.record_batch([batch.column("doc_id"), cleaned], names=["doc_id", "text"])

    rows = only(docs, id_column, text).toDF("doc_id", "text")
    return rows.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, text string"
    )
