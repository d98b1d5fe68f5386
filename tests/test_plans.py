"""What the registered queries' plans must and must not hold."""

import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
from tapeloom.plans.table import TradeTable

SF_DIR = "/root/testdata/sf0.001"

MAP_ONLY = [
    "decode_trades",
    "publish_rejects",
    "parse_props",
    "dead_letters",
    "quarantine_keys",
    "utf8_strict",
    "publish_trades",
    "subscribe_symbols",
    "ttl_live",
]
READS = ["trades_by_symbol", "symbol_time_range", "latest_for_symbol"]


def plan_of(spark, name):
    frame = driver.queries()[name](spark, SF_DIR)
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return frame._jdf.queryExecution().explainString(mode)


@pytest.mark.parametrize("name", MAP_ONLY)
def test_map_only(spark, name):
    plan = plan_of(spark, name)
    for word in ("Exchange", "Python", "Join", "Sort"):
        assert word not in plan


def test_nested_messages_are_spread_as_texts(spark):
    plan = plan_of(spark, "decode_nested")
    assert plan.count("Exchange") - plan.count("AQEShuffleRead") >= 1 and "RoundRobinPartitioning" in plan
    # the texts move, not the rows that they become
    assert plan.index("RoundRobinPartitioning") < plan.index("posexplode")
    for word in ("Python", "Join", "Sort", "hashpartitioning"):
        assert word not in plan


def test_tasks_get_no_more_words_as_texts_grow(spark, tmp_path):
    """However few bytes the texts are: one file, whose words compress to next to nothing."""
    texts = spark.range(300).selectExpr(
        "id AS doc_id", "repeat('a word ', 2500) AS text", "'en' AS lang", "'s' AS source", "17500L AS n_chars"
    )
    texts.coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    flat = driver.queries()["decode_nested"](spark, str(tmp_path))
    sizes = [row["count"] for row in flat.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 300 * 5001 and max(sizes) <= 510_000


def test_no_texts_at_all(spark, tmp_path):
    texts = spark.createDataFrame([(1, None, "en", "s", 0)], "doc_id long, text string, lang string, source string, n_chars long")
    for name, rows in {"null": texts, "none": texts.limit(0)}.items():
        rows.write.parquet(f"{tmp_path}/{name}/documents.parquet")
        assert driver.queries()["upsert_nested"](spark, f"{tmp_path}/{name}").collect() == []


@pytest.fixture
def many_files(spark, tmp_path):
    """2,000 events of two keys, whose loads are written as many files."""
    rows = spark.range(2000, numPartitions=4).selectExpr(
        "id AS event_id",
        "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, CAST(id * 3 AS DECIMAL(18, 6))) AS ts",
        "id AS user_id",
        "'click' AS event_type",
        "CAST(id AS DOUBLE) AS value",
        "concat('{\"k\":', id, '}') AS props",
    )
    rows.write.parquet(f"{tmp_path}/events.parquet")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield str(tmp_path)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_a_load_is_one_batch_however_many_files_it_has(spark, many_files, monkeypatch):
    append, written, tasks = TradeTable.append, [], []

    def noted(self, rows, batch_id, rebalance=False):
        written.append(batch_id)
        tasks.append(rows.rdd.getNumPartitions())
        append(self, rows, batch_id, rebalance)

    monkeypatch.setattr(TradeTable, "append", noted)
    found = driver.queries()["stream_upsert"](spark, many_files).collect()
    # the second batch fails after its write and comes again, with the same rows
    assert written == [0, 1, 1, 2] and min(tasks) > 1
    # the last load wins, and in it the greatest event of the hour
    last = {e // 1200: e for e in range(2000) if e % 3 == 2}
    assert {row.price for row in found} == {float(e) for e in last.values()}
    assert {row.delivered for row in found} == {2000}


def test_a_capped_stream_has_as_many_batches_however_many_files(spark, many_files):
    found = driver.queries()["stream_decode"](spark, many_files)
    assert found.count() == 2000 and found.select("capped").distinct().collect() == [(True,)]
    checkpoints = found.inputFiles()[0].removeprefix("file://").rpartition("/trades/")[0] + "/checkpoint/offsets"
    assert len([name for name in os.listdir(checkpoints) if name.isdigit()]) == 3


@pytest.mark.parametrize("name", READS)
def test_key_predicates_reach_the_files(spark, name):
    plan = plan_of(spark, name)
    assert "EqualTo(event_type,click)" in plan
    assert "Python" not in plan


@pytest.mark.parametrize("name", ["symbol_time_range", "timestamp_lookup"])
def test_time_predicates_reach_the_files(spark, name):
    plan = plan_of(spark, name)
    assert "GreaterThanOrEqual(ts," in plan and "LessThan(ts," in plan


@pytest.mark.parametrize("name", ["upsert_latest", "upsert_nested"])
def test_upsert_shuffles_once(spark, name):
    plan = plan_of(spark, name)
    assert plan.count("Arguments: hashpartitioning(") == 1
    assert "partial_max" in plan and "Window" not in plan and "Python" not in plan


def test_newest_is_a_top_k(spark):
    assert "TakeOrderedAndProject" in plan_of(spark, "preview")
    plan = plan_of(spark, "latest_for_symbol")
    assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan
    # what is older is dropped before the upsert's shuffle
    assert plan.index(" >= ") < plan.index("partial_max")


@pytest.mark.parametrize("missing", ["tapeloom.llm", "corpus_pipeline", "a_library"])
def test_the_other_queries_stay_without_the_corpus_operators(monkeypatch, missing):
    """Whether the operators, their pipeline or a library that only they need is missing."""

    def find(name, *args, **kwargs):
        wanted = "tapeloom.llm" if missing == "a_library" else missing
        if name == wanted or name.startswith(f"{wanted}."):
            raise ModuleNotFoundError(f"No module named {missing!r}", name=missing)
        return plain(name, *args, **kwargs)

    import builtins
    import sys

    plain = builtins.__import__
    for name in [n for n in sys.modules if n.startswith("tapeloom.llm") or n == "corpus_pipeline"]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setattr(builtins, "__import__", find)
    if missing == "a_library":
        with pytest.warns(UserWarning, match="a_library"):
            found = driver.queries()
    else:
        found = driver.queries()
    assert set(driver.QUERIES) <= set(found) and "pipeline" not in found
