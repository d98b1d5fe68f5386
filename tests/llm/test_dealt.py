"""The manifest, decontamination and vector codes against brute force, case by case."""

import random

import numpy as np
import pytest
import reference as ref

from tapeloom.llm import fm_index, merkle, orchard
from tapeloom.llm.shipping import ship

DOCS = "doc_id long, source string, lang string, n_chars long, text string, place long, tree string"


@pytest.fixture(scope="module")
def docs(spark):
    ship(spark)

    def make(rows):
        """Documents with further columns that the operators name columns of their own."""
        return spark.createDataFrame([(*row, 7, "x") for row in rows], DOCS)

    return make


def rows_of(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


# -- manifest -----------------------------------------------------------------------


def check_manifest(docs, rows):
    found = rows_of(merkle.manifest(docs(rows)))
    assert found == ref.manifest(rows)
    return found


def test_manifest_of_nulls_ties_and_repeats(docs):
    rows = [(i, "s", "en", 3, "Abc") for i in range(40)]
    rows += [(None, None, None, None, None), (None, "s", None, 0, ""), (5, "s", "en", 3, "Abc"), (5, "s", "de", 3, "ABC")]
    rows += [(i, None, "en", None, None) for i in range(17)] + [(-3, "", "en", 1, "é" * 900 + "X")]
    rows += [(1, name, "fr", 2, "Up") for name in ("é", "z", "Z", "\U0001f600", "￿")]
    assert not all(row[-1] for row in check_manifest(docs, rows))


@pytest.mark.parametrize("many", [1, 2, 16, 17, 256, 257])
def test_manifest_of_one_source(docs, many):
    check_manifest(docs, [(i, "only", "en", i, "t") for i in range(many)])


def test_manifest_of_a_source_of_several_rounds(docs):
    """One source holds most rows and is three blocks; its tree takes a round more than the others."""
    rows = [(i, "hot", "en", i, f"Text {i}") for i in range(2 * merkle.BLOCK + 5)]
    check_manifest(docs, rows + [(i, f"s{i % 40}", "en", i, "T") for i in range(100)])


def test_manifest_of_many_sources(docs):
    check_manifest(docs, [(i, f"host{i}", "en", i, "T") for i in range(merkle.BLOCK + 3)])


def test_manifest_of_nothing(docs):
    assert rows_of(merkle.manifest(docs([]))) == []


def test_queue_holds_unfinished_nodes_only(monkeypatch):
    most = 0

    class Watched(merkle.Queue):
        def put(self, label, message):
            nonlocal most
            super().put(label, message)
            most = max(most, len(self.heap))

    monkeypatch.setattr(merkle, "Queue", Watched)
    nodes = [(0, merkle.BLOCK, i, ref.sha(str(i))) for i in range(merkle.BLOCK)]
    found = list(merkle.forward(iter(nodes)))
    assert sum(row[-1] for row in found) == 1 and len(found) == 256 + 16 + 1
    assert most <= 16 * 3


# -- decontamination ----------------------------------------------------------------


@pytest.mark.parametrize("part_bytes", [fm_index.PART_BYTES, 40])
def test_decontamination_cases(spark, docs, part_bytes):
    phrase = " ".join(f"w{i}" for i in range(14))
    items = [(1, phrase), (2, "short one"), (10, "ÄRGER 1st; w3 w4"), (None, "no id here"), (3, None), (4, "..."), (5, "")]
    items += [(2, "short one"), (6, phrase.upper()), (7, "a a a a a a a a a a a")]
    texts = [
        "x " + phrase + " y " + " ".join(f"w{i}" for i in range(2, 12)),
        "x " + " ".join(f"w{i}" for i in range(9)),  # one word short of a window
        "A SHORT-one, a short; ONE!",
        "Ärger 1st w3 w4 ÄRGER 1ST w3 w4",
        "ärger 1st w3 w4",
        "no id here",
        None,
        "",
        "\t\n .,;",
        "a " * 3000,
        "w13 " + phrase,
    ]
    rows = [(i, "s", "en", 1, text) for i, text in enumerate(texts)]
    rows += [(None, "s", "en", 1, texts[0]), (0, "s", "en", 1, texts[0]), (2, "s", "en", 1, "short one")]
    table = spark.createDataFrame([(*item, "x") for item in items], "item_id long, text string, row string")
    found = rows_of(fm_index.decontaminate(docs(rows), table, part_bytes=part_bytes))
    assert found == ref.contaminated([(r[0], r[4]) for r in rows], items)
    for row in fm_index.find_hits(docs(rows[:11]), table, part_bytes=part_bytes).collect():
        text = texts[row["doc_id"]]
        words = [m.span() for m in ref.ITEM_WORD.finditer((text or "").translate(ref.ASCII_LOWER))]
        for span in row["spans"]:
            assert (span["start"], span["stop"]) == (words[span["first"]][0], words[span["last"]][1])


def test_decontamination_of_empty_tables(spark, docs):
    none = spark.createDataFrame([], "item_id long, text string")
    found = fm_index.decontaminate(docs([(1, "s", "en", 1, "some text")]), none).collect()
    assert [(r.n_words, r.n_hit, r.contaminated) for r in found] == [(2, 0, False)]
    assert rows_of(fm_index.decontaminate(docs([]), none)) == []


def test_decontamination_by_chance(spark, docs):
    """Few words and many repeats; a text alone gives what it gives in a shard with all others."""
    rng = random.Random(3)
    draw = lambda n: " ".join(rng.choices("abcd", k=n))
    rows = [(i, "s", "en", 1, draw(rng.randrange(80))) for i in range(300)]
    items = [(i, draw(rng.randrange(25))) for i in range(40)]
    table = spark.createDataFrame(items, "item_id long, text string")
    expected = ref.contaminated([(r[0], r[4]) for r in rows], items)
    assert rows_of(fm_index.decontaminate(docs(rows), table)) == expected
    phrases = fm_index.phrases_of([(str(i), text.encode()) for i, text in items])
    numbers = [[phrases.numbers.get(w, 0) for w in fm_index.split_words(r[4].encode())] for r in rows]
    by_one = [fm_index.search_shard([np.array(n, np.int32)], phrases)[0] for n in numbers]
    assert by_one == fm_index.search_shard([np.array(n, np.int32) for n in numbers], phrases)


def test_index_counts_and_locates():
    rng = np.random.default_rng(5)
    for size, symbols in ((1, 2), (50, 2), (3000, 3), (3000, 900)):
        text = rng.integers(0, symbols, size)
        text[size // 2 :] = text[: size - size // 2]  # one long repeat
        index = fm_index.FmIndex(text)
        assert fm_index.suffix_array(text).tolist() == sorted(range(size), key=lambda i: text[i:].tolist())
        patterns = np.array([text[i : i + 4] for i in range(0, max(1, size - 4), 7) if i + 4 <= size] or [[0, 1, 0, 1]])
        which, low, high = index.search(patterns)
        for row, pattern in enumerate(patterns):
            places = [i for i in range(size - 3) if (text[i : i + 4] == pattern).all()]
            own = np.flatnonzero(which == row)
            got = index.locate(np.arange(low[own[0]], high[own[0]])).tolist() if len(own) else []
            assert sorted(got) == places


# -- vector codes -------------------------------------------------------------------


def check_codes(spark, rows, element="float"):
    schema = f"vec_id long, embedding array<{element}>, label int, code string, vector int"
    table = spark.createDataFrame([(*row, "x", 1) for row in rows], schema)
    found = rows_of(orchard.compress(table))
    assert found == ref.vector_codes(rows)
    return found


def floats(values):
    return [float(x) for x in np.asarray(values, np.float32)]


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship(spark)


def test_codes_of_nulls_ties_and_repeats(spark):
    rng = np.random.default_rng(1)
    rows = [(i, floats(rng.normal(size=16)), i % 3) for i in range(60)]
    rows += [(100 + i, floats(np.round(rng.normal(size=16))), None) for i in range(60)]  # many ties
    rows += [(3, rows[3][1], 0), (None, rows[4][1], 1), (200, [0.0] * 16, None)]
    bad = [(1000, None, 1), (-1, [None] * 16, 1), (-2, floats([1] * 15) + [float("nan")], 1), (-3, [float("inf")] * 16, 0)]
    assert len(check_codes(spark, rows + bad)) == len(rows)


def test_codes_of_few_and_of_no_vectors(spark):
    rows = [(i, floats([i] * 8), 0) for i in range(3)]
    check_codes(spark, rows)
    check_codes(spark, [(1, None, 2)])
    check_codes(spark, [])


def test_codes_of_very_large_components(spark):
    rng = np.random.default_rng(2)
    rows = [(i, floats(rng.normal(size=8) * 10.0 ** rng.integers(-3, 6, 8)), 0) for i in range(40)]
    check_codes(spark, rows)
    huge = [(i, [float(x) for x in rng.normal(size=8) * 1e300], 0) for i in range(20)]
    table = spark.createDataFrame(huge, "vec_id long, embedding array<double>, label int")
    expected = ref.vector_codes(huge)
    found = rows_of(orchard.compress(table))
    assert [(r[0], r[1], r[4]) for r in found] == [(r[0], r[1], r[4]) for r in expected]


def test_codes_of_a_vector_of_another_length(spark):
    rows = [(i, floats([i] * 8), 0) for i in range(20)]
    schema = "vec_id long, embedding array<float>, label int"
    table = spark.createDataFrame(rows + [(99, [1.0, 2.0], 1)], schema)
    found = {r.vec_id: r for r in orchard.compress(table).collect()}
    assert found[99].code is None and found[99].error is None and len(found) == 21
    with pytest.raises(ValueError, match="equal parts"):
        orchard.compress(spark.createDataFrame([(1, [1.0] * 9, 0)], schema))


def test_orchard_search_is_exact_and_measures_less():
    rng = np.random.default_rng(4)
    centres = rng.integers(-40, 40, (16, 4)) * 100
    points = centres[rng.integers(0, 16, 4000)] + rng.integers(-20, 20, (4000, 4))
    book = orchard.Book(centres)
    chosen, best, measured = book.nearest(points)
    every = orchard.squared(points[:, None], centres[None])
    assert (chosen == every.argmin(axis=1)).all() and (best == every.min(axis=1)).all()
    assert measured < every.size / 2
    # ties between equal entries go to the lower one
    twice = orchard.Book(np.concatenate((centres[:8], centres[:8])))
    assert (twice.nearest(points)[0] == orchard.squared(points[:, None], centres[None, :8]).argmin(axis=1)).all()
