"""Token counts of a unigram tokenizer, without the tokens: Viterbi that carries counts only."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeloom.llm.words import only, raw_texts

# The mark that begins a word, and the cost of an unknown character.
WORD_MARK = "▁"
UNKNOWN_PENALTY = 10.0

CACHED_WORDS = 300_000
CACHED_BYTES = 64
SCHEMA = "doc_id long, n_words long, n_tokens long"


def load_pieces(path: str) -> list[tuple[str, float]]:
    """Pieces and scores of a model file, in the order of its ids and without control pieces."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(model.get_piece_size())
    return [(model.id_to_piece(i), model.get_score(i)) for i in ids if not model.is_control(i)]


class Counter(dict):
    """Number of tokens by word. Words are cut apart first, so each counts by itself.

    The automaton reports all pieces that end at a character, longest first. The best way to
    an end replaces the one found before only if it scores more, so of equal ways the one
    whose last piece starts earliest stays, as in the tokenizer. A character that is no
    piece costs ten more than the worst piece and gives one token for each of its bytes.
    """

    def __init__(self, pieces: list[tuple[str, float]]):
        super().__init__()
        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces:
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.single = {piece for piece, _ in pieces if len(piece) == 1}
        self.unknown = min(score for _, score in pieces) - UNKNOWN_PENALTY

    def part(self, text: str) -> int:
        best = [0.0] + [float("-inf")] * len(text)
        count = [0] * (len(text) + 1)
        found = self.automaton.iter(text)
        last, value = next(found, (len(text), None))
        for place, character in enumerate(text):
            end = place + 1
            while last == place:
                length, score = value
                candidate = best[end - length] + score
                if candidate > best[end]:
                    best[end] = candidate
                    count[end] = count[end - length] + 1
                last, value = next(found, (len(text), None))
            if character not in self.single and best[place] + self.unknown > best[end]:
                best[end] = best[place] + self.unknown
                count[end] = count[place] + len(character.encode("utf-8", "replace"))
        return count[-1]

    def __missing__(self, word: bytes) -> int:
        marked = WORD_MARK + word.decode("utf-8", "replace").removeprefix(WORD_MARK)
        count = sum(self.part(WORD_MARK + text) for text in marked.split(WORD_MARK)[1:])
        if len(word) <= CACHED_BYTES:
            if len(self) >= CACHED_WORDS:
                self.clear()
            self[word] = count
        return count


@lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    """The counter of a vocabulary, kept by the worker process over tasks."""
    return Counter(load_pieces(path))


def count_tokens(
    docs: DataFrame, path: str, id_column: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Words and unigram tokens of every whole text, in a map-only job.

    `path` names the model file, which every worker reads for itself. A null or empty text
    has no tokens. Repeated rows and rows with a null id are each counted; further columns
    are ignored. Memory: the words of one text and a cache of fixed size.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = counter(path).__getitem__
        for batch in batches:
            words, counts = [], []
            for raw in raw_texts(batch):
                own = (raw or b"").split()
                words.append(len(own))
                counts.append(sum(map(tokens, own)))
            arrays = [batch.column("doc_id"), pa.array(words, pa.int64()), pa.array(counts, pa.int64())]
            yield pa.record_batch(arrays, names=["doc_id", "n_words", "n_tokens"])

    rows = only(docs, id_column, text).toDF("doc_id", "text")
    return rows.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, SCHEMA)
