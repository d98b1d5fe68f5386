import random

import pytest

from tapeloom.operators import offsets


def places(spark, by_partition):
    rows = [(p, o) for p, found in by_partition.items() for o in found]
    return spark.createDataFrame(rows, "src_partition int, src_offset long")


def runs_of(spark, by_partition):
    return sorted(tuple(r) for r in offsets.runs(places(spark, by_partition)).collect())


def test_runs_over_blocks(spark):
    size = offsets.BLOCK
    whole = list(range(size - 2, size + 3))
    found = runs_of(spark, {0: whole + [3 * size, 3 * size], 1: [7], 2: [0, 1, 3]})
    assert found == [(0, size - 2, size + 2, 5), (0, 3 * size, 3 * size, 2), (1, 7, 7, 1), (2, 0, 1, 2), (2, 3, 3, 1)]


def test_gaps_over_batches(spark):
    rows = [(0, 0, 4, 5), (0, 5, 9, 5), (0, 12, 20, 9), (0, 2, 6, 5), (0, 21, 21, 1), (1, 50, 60, 11), (1, 63, 63, 1)]
    delivered = spark.createDataFrame(rows, "src_partition int, first_offset long, last_offset long, rows long")
    assert sorted(map(tuple, offsets.gaps(delivered).collect())) == [(0, 10, 11, 2), (1, 61, 62, 2)]
    assert offsets.gaps(delivered.where("false")).count() == 0


@pytest.mark.parametrize("block", [4, 1 << 16])
def test_runs_by_chance(spark, monkeypatch, block):
    monkeypatch.setattr(offsets, "BLOCK", block)
    random.seed(block)
    held = {p: sorted(random.sample(range(300), 200)) for p in range(3)}
    expected = []
    for p, found in held.items():
        for o in found:
            if expected and expected[-1][0] == p and expected[-1][2] == o - 1:
                expected[-1] = (p, expected[-1][1], o, expected[-1][3] + 1)
            else:
                expected.append((p, o, o, 1))
    assert runs_of(spark, held) == expected
    missing = [(a[0], a[2] + 1, b[1] - 1, b[1] - a[2] - 1) for a, b in zip(expected, expected[1:]) if a[0] == b[0]]
    assert sorted(map(tuple, offsets.gaps(offsets.runs(places(spark, held))).collect())) == missing


def test_a_hot_partition_is_many_groups(spark):
    rows = spark.range(300_000).selectExpr("0 src_partition", "id + if(id > 200000, 5, 0) src_offset")
    found = offsets.runs(rows)
    plan = found._jdf.queryExecution().toString()
    assert "Python" not in plan and "FLOOR" in plan
    assert sorted(map(tuple, found.collect())) == [(0, 0, 200_000, 200_001), (0, 200_006, 300_004, 99_999)]
