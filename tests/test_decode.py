"""Decoding: what each kind of message gives, row by row."""

import math

import pytest
from pyspark.sql import functions as F

from tapeloom.operators import decode as d
from tapeloom.schemas import RECORD, TRADE_COLUMNS
from tapeloom.sources.kafka import topic_records


def records(spark, *values):
    return spark.createDataFrame([(None, v, 0, i) for i, v in enumerate(values)], RECORD)


def message(data, kind='"trade"'):
    return f'{{"type":{kind},"data":{data}}}'


GOOD = '{"c":"x","p":1.5,"s":"A","t":1,"v":2}'

# value, expected (condition, price, symbol, timestamp, volume) rows
CASES = {
    "ok": (
        message('[{"c":null,"p":1.5,"s":"A","t":1,"v":2},{"c":null,"p":2,"s":"B","t":2,"v":0}]'),
        [(None, 1.5, "A", 1, 2.0), (None, 2.0, "B", 2, 0.0)],
    ),
    "condition_list": (
        message('[{"c":["1","8"],"p":1,"s":"A","t":1,"v":1}]'),
        [('["1","8"]', 1.0, "A", 1, 1.0)],
    ),
    "null_element": (
        message(f"[null,{GOOD}]"),
        [(None, None, None, None, None), ("x", 1.5, "A", 1, 2.0)],
    ),
    "bad_price": (
        message(f'[{{"c":"x","p":"abc","s":"A","t":1,"v":2}},{GOOD}]'),
        [("x", None, "A", 1, 2.0), ("x", 1.5, "A", 1, 2.0)],
    ),
    "text_price": (message('[{"p":"1.5","s":"A","t":1,"v":2}]'), [(None, None, "A", 1, 2.0)]),
    "fraction_time": (message('[{"p":1,"s":"A","t":1.5,"v":2}]'), [(None, 1.0, "A", None, 2.0)]),
    "decimal_time": (message('[{"p":1,"s":"A","t":1.0,"v":2}]'), [(None, 1.0, "A", None, 2.0)]),
    "text_time": (message('[{"p":1,"s":"A","t":"17","v":2}]'), [(None, 1.0, "A", None, 2.0)]),
    "huge_time": (
        message('[{"p":1,"s":"A","t":99999999999999999999,"v":2}]'),
        [(None, 1.0, "A", None, 2.0)],
    ),
    "missing_symbol": (message('[{"p":1,"t":1,"v":2}]'), [(None, 1.0, None, 1, 2.0)]),
    "empty_symbol": (message('[{"p":1,"s":"","t":1,"v":2}]'), [(None, 1.0, "", 1, 2.0)]),
    "number_symbol": (message('[{"p":1,"s":5,"t":1,"v":2}]'), [(None, 1.0, "5", 1, 2.0)]),
    "extra_keys": (
        '{"type":"trade","x":1,"data":[{"p":1,"s":"A","t":1,"v":2,"z":{"q":[1]}}]}',
        [(None, 1.0, "A", 1, 2.0)],
    ),
    "trailing_text": (message(f"[{GOOD}]") + " x", [("x", 1.5, "A", 1, 2.0)]),
    "ping": ('{"type":"ping"}', []),
    "data_null": (message("null"), []),
    "data_empty": (message("[]"), []),
    "data_object": (message(GOOD), []),
    "other_case": (f'{{"Type":"trade","Data":[{GOOD}]}}', []),
    "cut_off": ('{"type":"trade","data":[{"p":1', []),
    "empty": ("", []),
    "null": (None, []),
    "scalar": ("5", []),
    "array": (f"[{message('[' + GOOD + ']')}]", []),
}


@pytest.fixture(scope="module")
def flat(spark):
    rows = d.flatten(records(spark, *[value for value, _ in CASES.values()])).collect()
    names = list(CASES)
    found = {name: [] for name in names}
    for row in sorted(rows, key=lambda r: (r.src_offset, r.pos)):
        found[names[row.src_offset]].append(row)
    return found


@pytest.mark.parametrize("name", list(CASES))
def test_message(flat, name):
    rows = flat[name]
    assert [tuple(row)[1:6] for row in rows] == CASES[name][1]
    assert all(row.message_type == "trade" for row in rows)
    assert [row.pos for row in rows] == list(range(len(rows)))


@pytest.mark.parametrize("price", ["NaN", '"NaN"'])
def test_nan_price(spark, price):
    value = message(f'[{{"p":{price},"s":"A","t":1,"v":2}}]')
    (row,) = d.decode(records(spark, value)).collect()
    assert math.isnan(row.price)


def test_last_duplicate_key_wins(spark):
    value = f'{{"type":"a","type":"b","data":[{GOOD}]}}'
    assert [r.message_type for r in d.decode(records(spark, value)).collect()] == ["b"]


def test_type_is_not_filtered_here(spark):
    value = message(f"[{GOOD}]", '"news"')
    assert [r.message_type for r in d.decode(records(spark, value)).collect()] == ["news"]


def test_decode_has_the_public_columns(spark):
    assert d.decode(records(spark, "")).columns == TRADE_COLUMNS


def test_classify_reasons(spark):
    judged = {}
    names = list(CASES)
    for row in d.classify(records(spark, *[value for value, _ in CASES.values()])).collect():
        judged.setdefault(names[row.src_offset], []).append((row.pos, row.kind, row.reason, row.value))
    dead = {n: rows[0][2] for n, rows in judged.items() if rows[0][1] == "dead_letter"}
    assert dead == {
        "data_null": "no_trades",
        "data_empty": "no_trades",
        "data_object": "no_trades",
        "other_case": "not_decodable",
        "cut_off": "not_decodable",
        "empty": "empty_value",
        "null": "empty_value",
        "scalar": "not_decodable",
        "array": "not_decodable",
    }
    for name, rows in judged.items():
        for _, kind, _, value in rows:
            assert value == (CASES[name][0] if kind == "dead_letter" else None)
    bad = {n: [r[2] for r in rows if r[1] == "bad_key"] for n, rows in judged.items()}
    assert {n: reasons for n, reasons in bad.items() if reasons} == {
        "null_element": ["null_trade"],
        "fraction_time": ["missing_timestamp"],
        "decimal_time": ["missing_timestamp"],
        "text_time": ["missing_timestamp"],
        "huge_time": ["missing_timestamp"],
        "missing_symbol": ["missing_symbol"],
        "empty_symbol": ["empty_symbol"],
    }
    assert judged["ping"] == [(None, "control", None, None)]


def test_classified_trades_are_the_keyed_rows_of_flatten(spark):
    source = records(spark, *[value for value, _ in CASES.values()])
    keyed = d.flatten(source).where("symbol <> '' and timestamp is not null")
    trades = d.keyed_trades(d.classify(source))
    assert sorted(map(str, trades.collect())) == sorted(map(str, keyed.collect()))


def test_refuse_bad_keys(spark):
    fine = d.classify(records(spark, message(f"[{GOOD}]"), '{"type":"ping"}', "junk"))
    kept = d.refuse_bad_keys(fine)
    assert kept.columns == fine.columns
    assert sorted(r.kind for r in kept.collect()) == ["control", "dead_letter", "trade"]
    with pytest.raises(Exception, match="missing_symbol"):
        d.refuse_bad_keys(d.classify(records(spark, CASES["missing_symbol"][0]))).collect()


def test_topic_rows(spark):
    rows = spark.createDataFrame(
        [(bytearray(b"d"), bytearray(message(f"[{GOOD}]").encode()), "t", 3, 17)],
        "key binary, value binary, topic string, partition int, offset long",
    )
    (record,) = topic_records(rows).collect()
    assert (record.key, record.src_partition, record.src_offset) == ("d", 3, 17)
    (row,) = d.flatten(topic_records(rows)).collect()
    assert (row.symbol, row.src_partition, row.src_offset, row.pos) == ("A", 3, 17, 0)


def test_plan_is_map_only_and_parses_once(spark, tmp_path):
    records(spark, message(f"[{GOOD}]")).write.parquet(f"{tmp_path}/r")
    stored = spark.read.parquet(f"{tmp_path}/r")
    for frame in (d.flatten(stored), d.decode(stored), d.classify(stored)):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert plan.count("from_json(") == 1
        assert "Exchange" not in plan and "Python" not in plan
    pruned = d.decode(stored)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<value:string>" in pruned


def test_one_long_message(spark):
    count = 20_000
    value = message("[" + ",".join(f'{{"p":{i},"s":"S{i % 7}","t":{i},"v":1}}' for i in range(count)) + "]")
    got = d.flatten(records(spark, value)).agg(
        F.count("*").alias("n"), F.sum((F.col("pos") == F.col("timestamp")).cast("int")).alias("same")
    ).first()
    assert (got.n, got.same) == (count, count)
