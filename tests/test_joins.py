import pytest
from pyspark.sql import functions as F

from gatehold.operators import joins

from .conftest import rows_of


@pytest.fixture
def no_auto_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.fixture
def hot_fact(spark):
    """A third of the rows share one key and are exact copies; some keys are null or have no partner."""
    return spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot")
        .when(F.col("id") % 50 == 1, None)
        .otherwise(F.concat(F.lit("k"), (F.col("id") % 200).cast("string")))
        .alias("key"),
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("v"),
    )


@pytest.fixture
def lookup(spark):
    keys = [("hot", 1), ("hot", 2)] + [(f"k{i}", i) for i in range(0, 200, 2)] + [(None, 7)]
    return spark.createDataFrame(keys, "key string, w int")


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_join_equals_the_plain_join(no_auto_broadcast, hot_fact, lookup, how):
    expected = rows_of(hot_fact.join(lookup, "key", how).select("key", "v", "w"))
    assert rows_of(joins.lookup_join(hot_fact, lookup, ["key"], how, broadcast_bytes=-1, target_rows=50)) == expected
    assert rows_of(joins.lookup_join(hot_fact, lookup, ["key"], how, broadcast_bytes=-1)) == expected
    assert rows_of(joins.lookup_join(hot_fact, lookup, ["key"], how)) == expected


def test_counts_are_taken_while_the_rows_are_written(spark, hot_fact):
    """The lineage of the fact side runs once, for storing and counting together."""
    ran = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            ran.add(batch.num_rows)
            yield batch

    stored, counts = joins.staged_with_counts(hot_fact.mapInArrow(count, hot_fact.schema), ["key"], "counted", share=0.1)
    assert stored.count() == 3000 and ran.value == 3000
    assert (counts.rows, counts.nulls) == (3000, hot_fact.filter("key is null").count())
    assert list(counts.heavy.values()) == [1000]
    assert rows_of(hot_fact.filter(F.xxhash64("key").isin(*counts.heavy)).select("key").distinct()) == [("hot",)]


def test_salts_follow_the_counts():
    counts = joins.KeyCounts(1000, 0, {7: 300, 8: 100, 9: 101})
    assert counts.salts(100) == {7: 3, 9: 2}
    assert counts.salts(1000) == {}


def test_a_join_reads_its_input_once(spark, no_auto_broadcast, hot_fact, lookup):
    ran = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            ran.add(batch.num_rows)
            yield batch

    fact = hot_fact.mapInArrow(count, hot_fact.schema)
    joined = joins.lookup_join(fact, lookup, ["key"], broadcast_bytes=-1, target_rows=50)
    assert joined.count() == hot_fact.join(lookup, "key").count() and ran.value == 3000


def test_copies_of_one_row_are_spread_as_their_count_asks(spark, no_auto_broadcast, tmp_path):
    """A key with 30 % of the rows, all exact copies, reaches more than 64 tasks, each of about the target size."""
    rows = spark.range(0, 40_000, 1, 2).selectExpr("if(id % 10 < 3, 'hot', concat('k', id)) AS key", "if(id % 10 < 3, 0, id) AS v")
    names = spark.createDataFrame([("hot", 1), ("k5", 2)], "key string, w int")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "400")
    try:
        joined = joins.lookup_join(rows, names, ["key"], broadcast_bytes=-1, target_rows=100)
        tasks = [r["count"] for r in joined.filter("key = 'hot'").groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert sum(tasks) == 12_000 and len(tasks) > 64 and max(tasks) < 800


def test_null_keys_are_spread_in_a_left_join(spark, no_auto_broadcast, lookup):
    rows = spark.range(5_000).selectExpr("if(id % 5 = 0, concat('k', id % 100), null) AS key", "id AS v")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "50")
    try:
        joined = joins.lookup_join(rows, lookup, ["key"], "left", broadcast_bytes=-1, target_rows=200)
        tasks = joined.filter("key is null").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert sum(r["count"] for r in tasks) == 4_000 and len(tasks) >= 10


def test_key_types_must_agree(spark, lookup):
    other = spark.range(3).select(F.col("id").alias("key"))
    with pytest.raises(ValueError, match="key types"):
        joins.salted_join(other, lookup, ["key"], "inner", joins.KeyCounts())
    with pytest.raises(ValueError, match="inner and left"):
        joins.lookup_join(other, other, ["key"], "outer")


def test_small_lookup_is_broadcast_and_large_is_not(spark, no_auto_broadcast, hot_fact, lookup):
    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    assert "BroadcastHashJoin" in plan(joins.lookup_join(hot_fact, lookup, ["key"]))
    assert "BroadcastHashJoin" not in plan(joins.lookup_join(hot_fact, lookup, ["key"], broadcast_bytes=100))


def test_size_in_bytes(spark):
    df = spark.createDataFrame([("abc", 1), (None, 2)], "t string, n int")
    assert joins.size_in_bytes(df) == 2 * 8 * 2 + 3
    assert joins.size_in_bytes(df.filter("n > 5")) == 0
    nested = spark.createDataFrame([(["x" * 50],)], "a array<string>")
    assert joins.size_in_bytes(nested) > 58


@pytest.mark.parametrize("broadcast_bytes", [joins.BROADCAST_BYTES, -1])
def test_keys_of_different_types_and_columns_without_a_hash(spark, broadcast_bytes):
    fact = spark.sql("SELECT CAST(id AS bigint) AS key, map('a', id) AS m FROM range(4)")
    lookup = spark.createDataFrame([(1, "x"), (3, "y")], "key int, w string")
    found = joins.lookup_join(fact, lookup, ["key"], broadcast_bytes=broadcast_bytes)
    assert sorted((r["key"], r["m"]["a"], r["w"]) for r in found.collect()) == [(1, 1, "x"), (3, 3, "y")]
    narrow = joins.lookup_join(lookup, fact.select("key", F.lit(5).alias("v")), ["key"], broadcast_bytes=broadcast_bytes)
    assert dict(narrow.dtypes) == {"key": "int", "w": "string", "v": "int"} and narrow.count() == 2


def test_own_columns_are_not_taken(spark, hot_fact, lookup):
    fact = hot_fact.withColumns({"__salt": F.lit("s"), "__tasks": F.lit("t")})
    joined = joins.lookup_join(fact, lookup.withColumn("__hash", F.lit("h")), ["key"], broadcast_bytes=-1, target_rows=50)
    assert joined.columns == ["key", "v", "__salt", "__tasks", "w", "__hash"]
    assert rows_of(joined.select("__salt", "__tasks", "__hash").distinct()) == [("s", "t", "h")]


def test_the_salted_plan_shuffles(spark, hot_fact, lookup):
    plan = joins.lookup_join(hot_fact, lookup, ["key"], broadcast_bytes=-1)._jdf.queryExecution().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
