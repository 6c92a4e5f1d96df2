import bisect
import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gatehold.operators import encode, layout, ordered

from .conftest import rows_of

_SETTINGS = settings(max_examples=6, deadline=None)


def test_bucket_is_the_number_of_cut_points_not_above(spark):
    points = [3.0, 5.0, 9.0, 20.0, 21.0]
    df = spark.createDataFrame([(float(i),) for i in range(25)] + [(None,)], "x double")
    for r in layout.with_buckets(df, {"b": F.col("x"), "none": F.col("x")}, {"b": points, "none": []}, bits=3).collect():
        assert r["b"] == (0 if r["x"] is None else bisect.bisect_right(points, r["x"])) and r["none"] == 0


def test_quantiles_cut_columns_of_all_kinds_evenly(spark):
    df = spark.range(4096).selectExpr(
        "id AS a", "concat('Customer#', lpad(id, 9, '0')) AS b", "date_add(date'2000-01-01', cast(id AS int)) AS c",
        "timestamp_micros(id * 1000003) AS d", "cast(id AS decimal(12, 2)) AS e", "cast(null AS string) AS f",
    )
    numbers, points, size, rows = layout.ranks(df, df.columns, bits=4)
    assert rows == 4096 and size > 4096 * 6 * 8 and points["f"] == []
    for c in "acde":
        buckets = layout.with_buckets(df, {"k": numbers[c]}, {"k": points[c]}, 4).groupBy("k").count().collect()
        assert len(buckets) == 16 and max(r["count"] for r in buckets) < 300
    order = df.select(numbers["b"].alias("n"), "b").orderBy("b").collect()
    assert [r["n"] for r in order] == sorted(r["n"] for r in order)


@given(st.lists(st.integers(-1000, 1000), unique=True, min_size=1, max_size=60))
@_SETTINGS
def test_running_totals_property(spark, keys):
    weights = {k: abs(k) % 7 for k in keys}
    df = spark.createDataFrame(list(weights.items()), "k int, w int").repartition(3)
    totals = {"total": F.col("w"), "rank": F.lit(1)}
    got = ordered.running_totals(df, "k", totals, {"rank": "rows"}, bucket_rows=8)
    total, expected = 0, []
    for rank, k in enumerate(sorted(weights), start=1):
        total += weights[k]
        expected.append((k, weights[k], total, rank, len(keys)))
    assert sorted(tuple(r) for r in got.collect()) == expected


def test_buckets_follow_the_rows(spark):
    """Ten times the keys make ten times the buckets, of which no one is much larger than asked for."""
    for n in (1_000, 10_000):
        got = ordered.running_totals(spark.range(n).withColumn("v", F.lit(1)), "id", {"rank": F.col("v")}, bucket_rows=100)
        dealt = got.inputFiles()
        sizes = [r["count"] for r in spark.read.parquet(*dealt).groupBy("__bucket").count().collect()]
        assert n / 100 * 0.9 <= len(sizes) <= n / 100 and max(sizes) < 300
        assert got.filter("rank <> id + 1").count() == 0


def test_running_totals_do_not_need_one_task(spark):
    plan = ordered.running_totals(spark.range(1000), "id", {"rank": F.lit(1)})._jdf.queryExecution().executedPlan()
    # The only single-partition window runs over the bucket sums, not the rows.
    text = plan.toString()
    assert text.count("SinglePartition") == 1 and "hashpartitioning(__bucket" in text


def _counting(df, ran):
    def count(batches):
        for batch in batches:
            ran.add(batch.num_rows)
            yield batch

    return df.mapInArrow(count, df.schema)


def test_codes_of_all_large_columns_by_one_read_and_two_shuffles(spark):
    rows = [(i, f"t{i % 40}" if i % 9 else None, "hot" if i % 3 else f"c{i % 7}", {"k": i}, "x") for i in range(900)]
    df = spark.createDataFrame(rows, "i int, p string, q string, m map<string,int>, __row string")
    codes = encode.fit_codes(df.filter("i < 800"), ["p", "q"])
    expected = rows_of(encode.apply_codes(df, codes, ["p", "q"]).drop("m"))
    ran = spark.sparkContext.accumulator(0)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = encode.apply_codes(_counting(df, ran), codes, ["p", "q"], broadcast_bytes=0, target_rows=50)
        text = got._jdf.queryExecution().executedPlan().toString()
        assert rows_of(got.drop("m")) == expected and got.columns == df.columns
        assert sorted(r["m"]["k"] for r in got.collect()) == list(range(900))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert ran.value == 900
    # The values to their codes, the codes themselves, and the codes back to their rows.
    assert text.count("Exchange hashpartitioning") == 3 and "BroadcastHashJoin" in text


def test_some_columns_are_broadcast_and_some_are_not(spark):
    df = spark.createDataFrame([(i, f"long-text-{i}" * 20, "ab"[i % 2], None) for i in range(60)], "i int, p string, q string, r string")
    codes = encode.fit_codes(df, ["p", "q", "r"])
    whole = encode.apply_codes(df, codes, ["p", "q", "r"])
    assert rows_of(encode.apply_codes(df, codes, ["p", "q", "r"], broadcast_bytes=100)) == rows_of(whole)
    clash = df.withColumnsRenamed({"i": "__code"})
    assert encode.apply_codes(clash, codes, ["q"]).columns == ["__code", "p", "q", "r"]
    assert encode.code_counts(codes) == {"p": 60, "q": 2}


def test_codes_are_sorted_ranks_per_column(spark):
    random.seed(3)
    data = [(random.choice("ZabéñN"), random.choice(["x", None, "aa", "b"])) for _ in range(200)]
    df = spark.createDataFrame(data, "p string, q string")
    codes = rows_of(encode.fit_codes(df, ["p", "q"]))
    expected = []
    for name, position in (("p", 0), ("q", 1)):
        ranked = sorted({r[position] for r in data if r[position] is not None}, key=lambda v: v.encode())
        expected += [(name, v, float(i)) for i, v in enumerate(ranked)]
    assert codes == sorted(expected, key=repr)


def test_apply_codes_to_known_new_and_missing_values(spark):
    fitted = encode.fit_codes(spark.createDataFrame([("a",), ("c",)], "p string"), ["p"])
    df = spark.createDataFrame([(1, "a"), (2, "c"), (3, "b"), (4, None)], "i int, p string")
    assert rows_of(encode.apply_codes(df, fitted, ["p"])) == [(1, 0.0), (2, 1.0), (3, 2.0), (4, None)]


def test_interleave(spark):
    df = spark.createDataFrame([(0b10, 0b01), (0b11, 0b11), (0, 0)], "a int, b int")
    z = layout.interleave(["a", "b"], bits=2)
    assert [r[0] for r in df.select(z).collect()] == [0b1001, 0b1111, 0]


def test_zorder_keeps_the_rows_and_narrows_the_files(spark, tmp_path):
    side = 64
    df = spark.range(side * side).select(
        (F.col("id") % side).cast("int").alias("a"),
        F.concat(F.lit("t"), F.lpad((F.col("id") / side).cast("int").cast("string"), 3, "0")).alias("b"),
    )
    path = str(tmp_path / "clustered")
    layout.zorder(df.repartition(4), ["a", "b"], files=16, bits=4).write.parquet(path)
    stored = spark.read.parquet(path)
    assert rows_of(stored) == rows_of(df)
    spans = stored.groupBy(F.input_file_name().alias("f")).agg(
        F.min("a").alias("a0"), F.max("a").alias("a1"), F.min("b").alias("b0"), F.max("b").alias("b1")
    ).collect()
    assert len(spans) == 16
    for value in (5, 40):  # a filter on either column must skip at least half of the files
        assert sum(s["a0"] <= value <= s["a1"] for s in spans) <= 8
        assert sum(s["b0"] <= f"t{value:03d}" <= s["b1"] for s in spans) <= 8


def test_zorder_spreads_copies_of_one_row(spark):
    df = spark.range(4000).select(F.lit(1).alias("a"), F.lit("x").alias("b")).repartition(4)
    sizes = layout.zorder(df, ["a", "b"], files=8, bits=3).groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in sizes) < 4000 / 3


def test_files_follow_the_bytes_and_filters_skip_them(spark, tmp_path):
    df = spark.range(20_000).selectExpr("id % 200 AS a", "concat('name', lpad(cast(hash(id) % 300 AS string), 4, '0')) AS b")
    size = layout.ranks(df, ["a", "b"], 4)[2]
    path = str(tmp_path / "clustered")
    layout.zorder(df, ["a", "b"], bits=5, file_bytes=size // 12).write.parquet(path)
    stored = spark.read.parquet(path)
    point = stored.select("b").first()["b"]
    found = layout.skippable(stored, {"a": 17, "b": point})
    files = found.groupBy("column").agg(F.count(F.lit(1)).alias("n"), F.count_if("skipped").alias("skipped")).collect()
    assert all(12 <= r["n"] <= 14 and r["skipped"] >= r["n"] / 3 for r in files)
    kept = found.filter("column = 'a' AND NOT skipped").select("file")
    at = stored.withColumn("file", F.col("_metadata.file_path"))
    assert at.join(kept, "file").filter("a = 17").count() == stored.filter("a = 17").count() == 100
    assert found.filter("column = 'a'").agg(F.sum("rows")).first()[0] == 20_000
