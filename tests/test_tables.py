import glob

import pytest
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import functions as F

from gatehold.operators import quality, tables
from gatehold.operators.history import VersionedTable
from gatehold.sources import files

from .conftest import rows_of


def test_overwrite_replaces(spark, silver, database):
    name = f"{database}.overwritten"
    tables.overwrite_table(silver, name)
    assert tables.overwrite_table(silver.filter("Year = 2007"), name).count() == 3


def test_create_fails_when_the_table_exists(airport_codes, database):
    assert tables.create_table(airport_codes, f"{database}.referential").count() == 5
    with pytest.raises(AnalysisException, match="TABLE_OR_VIEW_ALREADY_EXISTS"):
        tables.create_table(airport_codes, f"{database}.referential")


def test_replace_partitioned_and_copy(spark, silver, database):
    first = tables.replace_table(silver, f"{database}.parted", ["Year"], ["DateString"])
    assert rows_of(first, *silver.columns) == rows_of(silver)
    assert spark.sql(f"SHOW PARTITIONS {database}.parted").count() == 3
    copy = tables.copy_table(spark, f"{database}.parted", f"{database}.parted_copy", ["Year"])
    assert rows_of(copy, *silver.columns) == rows_of(silver)
    again = tables.replace_table(silver.filter("Year = 2008"), f"{database}.parted", ["Year"])
    assert again.count() == 3


def test_a_table_can_be_replaced_by_rows_of_itself(spark, silver, database):
    name = f"{database}.kept"
    tables.replace_table(silver, name, ["Year"])
    assert tables.replace_table(spark.table(name).filter("Year = 2007"), name, ["Year"]).count() == 3
    assert [r["partition"] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()] == ["Year=2007"]
    assert tables.overwrite_table(spark.table(name).limit(1), name).count() == 1


@pytest.mark.parametrize("partition_by", [[], ["Year"]])
def test_a_failed_write_leaves_the_table_as_it_was(spark, silver, database, partition_by):
    name = f"{database}.survivor{len(partition_by)}"
    tables.replace_table(silver, name, partition_by)
    failing = silver.withColumn("delay", F.when(F.col("Year") == 2008, F.raise_error(F.lit("lost"))).otherwise(F.col("delay")))
    for write in (lambda: tables.replace_table(failing, name, partition_by), lambda: tables.overwrite_table(failing, name)):
        with pytest.raises(PySparkException):
            write()
        assert rows_of(spark.table(name), *silver.columns) == rows_of(silver)
    assert [t.name for t in spark.catalog.listTables(database) if t.name.startswith("survivor")].count(name.split(".")[1]) == 1
    assert not [t.name for t in spark.catalog.listTables(database) if "__" in t.name]


def test_optimize_keeps_what_the_catalog_knows(spark, database):
    name = f"{database}.described"
    rows = spark.range(200).selectExpr("id", "id % 3 AS `the year`", "concat('n', id % 50) AS name")
    tables.replace_table(rows, name, ["the year"])
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('owner.team' = 'o\\'hare', 'comment' = 'all rows')")
    after = tables.optimize_table(spark, name, ["id", "name"])
    assert rows_of(after, *rows.columns) == rows_of(rows)
    described = tables._description(spark, name)
    assert described["Type"] == "MANAGED" and described["Comment"] == "all rows" and "o'hare" in described["Table Properties"]
    assert spark.sql(f"SHOW PARTITIONS {name}").count() == 3
    assert after.filter("`the year` = 1").count() == 67


def test_optimize_wants_a_new_folder_for_a_table_with_its_own(spark, silver, database, tmp_path):
    silver.write.option("path", str(tmp_path / "own")).saveAsTable(f"{database}.own_folder")
    with pytest.raises(ValueError, match="folder of its own"):
        tables.optimize_table(spark, f"{database}.own_folder", ["Month"])
    assert tables.optimize_table(spark, f"{database}.own_folder", ["Month"], 1, str(tmp_path / "new")).count() == 7


def _files(folder):
    return {f.removeprefix(folder) for f in glob.glob(f"{folder}/**/*.parquet", recursive=True)}


def test_compact_writes_only_the_partitions_that_a_delete_touched(spark, tmp_path):
    """One partition loses some rows, one all, with a name that needs escaping; the others keep their files."""
    rows = spark.range(0, 400, 1, 4).selectExpr("id", "concat('a b+', id % 4, '%/') AS kind", "if(id % 8 = 3, null, id % 2) AS half")
    table = VersionedTable(spark, str(tmp_path / "t"))
    table.overwrite(rows, ["kind", "half"])
    folder = table._latest()["data"]
    before = _files(folder)
    table.delete("kind = 'a b+1%/'")
    table.delete("id < 100 AND kind = 'a b+3%/' AND half IS NULL")
    expected = rows_of(table.read())
    after = table.compact()
    assert rows_of(after) == expected and len(expected) == 400 - 100 - 13
    assert table._latest()["deleted"] == [] and table._latest()["data"] == folder
    kept = {f for f in before if "a b%2B1" not in f and "a b+1" not in f and not ("+3" in f and "DEFAULT" in f)}
    assert kept and kept <= _files(folder) and not (before - kept) & _files(folder)
    assert rows_of(table.history(), "operation", "parameters")[0][0] == "COMPACT"
    assert '"rewritten_partitions": 2' in table._latest()["parameters"]
    table.compact()
    assert '"rewritten_partitions": 0' in table._latest()["parameters"] and rows_of(table.read()) == expected


def test_missing_values_are_counted_while_a_table_is_written(spark, silver, database):
    rows, seen = quality.watched(silver)
    tables.overwrite_table(rows, f"{database}.watched")
    assert quality.watched_counts(silver, seen).collect() == quality.missing_counts(silver).collect()


def test_a_hot_partition_is_written_as_several_files(spark, database):
    """Nine tenths of the rows are in one year; no task writes them all."""
    rows = spark.range(0, 200_000, 1, 8).selectExpr("if(id % 10 = 0, 1990 + id % 7, 2008) AS Year", "uuid() AS text")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1MB")
    try:
        table = tables.replace_table(rows, f"{database}.hot_year", ["Year"], ["text"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert table.count() == 200_000
    sizes = table.filter("Year = 2008").groupBy(F.input_file_name()).count().collect()
    assert len(sizes) >= 4 and max(r["count"] for r in sizes) < 70_000


def test_optimize_keeps_rows_and_partitioning(spark, silver, database, tmp_path):
    name = f"{database}.optimized"
    tables.replace_table(silver, name, ["Year"], ["DateString"])
    after = tables.optimize_table(spark, name, ["DateString", "Dest"], 2, str(tmp_path / "optimized"))
    assert rows_of(after, *silver.columns) == rows_of(silver)
    assert spark.sql(f"SHOW PARTITIONS {name}").count() == 3
    again = tables.optimize_table(spark, name, ["Dest"], 1, str(tmp_path / "again"))
    assert rows_of(again, *silver.columns) == rows_of(silver)


def test_optimize_an_unpartitioned_table(spark, daily, database, tmp_path):
    tables.replace_table(daily, f"{database}.optimized_weather")
    after = tables.optimize_table(spark, f"{database}.optimized_weather", ["TMIN", "DATE"], 2, str(tmp_path / "w"))
    assert rows_of(after) == rows_of(daily)


def test_optimize_a_versioned_table(spark, raw, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "bronze"))
    table.overwrite(raw, ["Year"])
    assert rows_of(table.optimize(["Month", "Dest"], 2, ["Year"]), *raw.columns) == rows_of(raw)
    assert rows_of(table.history(), "operation", "parameters")[1] == ("OVERWRITE", "{}")


def test_replace_unpartitioned(daily, database):
    assert rows_of(tables.replace_table(daily, f"{database}.weather_data")) == rows_of(daily)


def test_csv_export_has_the_given_number_of_files(spark, daily, tmp_path):
    path = str(tmp_path / "weather")
    tables.export_csv(daily, path, files=3)
    assert len(glob.glob(f"{path}/*.csv")) == 3
    assert rows_of(files.text_csv(spark, path), "Airport", "PREP") == [
        ("ORD", "0.0"), ("ORD", None), ("ORD", None), ("SEA", "0.29"),
    ]


def test_database_switch(spark, tmp_path):
    tables.create_database(spark, "switch_db", str(tmp_path / "switch_db"))
    tables.create_database(spark, "switch_db")
    before = spark.catalog.currentDatabase()
    tables.use_database(spark, "switch_db")
    try:
        spark.range(3).write.saveAsTable("three")
    finally:
        tables.use_database(spark, before)
    assert spark.table("switch_db.three").count() == 3


def test_statistics(spark, silver, database):
    tables.overwrite_table(silver, f"{database}.measured")
    tables.analyze_table(spark, f"{database}.measured")
    stats = tables.column_statistics(spark, f"{database}.measured", ["delay", "decimal_DepTime"])
    assert [(r["column"], r["num_nulls"]) for r in stats.collect()] == [("delay", 0), ("decimal_DepTime", 2)]
    assert (stats.first()["min"], stats.first()["max"]) == ("-4", "30")


def test_cache_is_released(silver):
    with tables.cached(silver) as kept:
        assert kept.is_cached and kept.count() == 7
    assert not silver.is_cached


def test_local_results_are_bounded(silver):
    assert len(tables.to_local(silver, max_rows=7)) == 7
    with pytest.raises(ValueError, match="more than 6 rows"):
        tables.to_local(silver, max_rows=6)


def test_preview_shape_names_and_distinct(silver):
    assert [r["FlightNum"] for r in tables.preview(silver, 2, ["FlightNum"]).collect()] == [7, 8]
    assert tables.preview(silver, 3).count() == 3
    assert tuple(tables.shape(silver).first()) == (7, 14)
    assert [r["name"] for r in tables.column_names(silver).orderBy("position").collect()] == silver.columns


def test_history_of_a_versioned_table(spark, raw, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "bronze"))
    assert table.latest_version() is None and table.history().count() == 0
    with pytest.raises(ValueError, match="no version"):
        table.read()
    with pytest.raises(ValueError, match="no version"):
        table.delete("true")
    table.overwrite(raw, ["Year"])
    change = table.delete("Year = 1987").first()
    assert (change["rows_before"], change["rows_after"], change["operation"]) == (9, 7, "DELETE")
    assert table.read().filter("Year = 1987").count() == 0 and table.read().count() == 7
    assert table.latest_version() == 1
    table.compact(["Year"])
    assert rows_of(table.history(), "version", "operation", "rows_before", "rows_after") == [
        (0, "OVERWRITE", None, 9), (1, "DELETE", 9, 7), (2, "COMPACT", 7, 7),
    ]
    assert table._latest()["deleted"] == [] and table.read().count() == 7


def test_delete_keeps_rows_for_which_the_condition_is_unknown(spark, raw, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "bronze"))
    table.overwrite(raw)
    table.delete("DepDelay > 15")
    table.delete("DepDelay < 0")
    kept = table.read()
    assert kept.filter("DepDelay IS NULL").count() == 1
    assert kept.count() == 5 == table._latest()["rows_after"]


def test_a_delete_on_the_partition_column_prunes_files(spark, raw, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "bronze"))
    table.overwrite(raw, ["Year"])
    table.delete("Year = 1987")
    plan = table.read()._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [NOT coalesce((Year" in plan


def test_a_version_without_history_row_is_not_read(spark, raw, tmp_path):
    """A job that dies between writing its data and its history row leaves the table as it was."""
    table = VersionedTable(spark, str(tmp_path / "bronze"))
    table.overwrite(raw)
    raw.limit(1).write.parquet(f"{table.path}/data/unfinished")
    assert table.read().count() == 9 and table.latest_version() == 0


def test_cleaned_flights_follow_a_delete(spark, raw, tmp_path):
    from gatehold.plans import flights, reports

    table = VersionedTable(spark, str(tmp_path / "bronze"))
    table.overwrite(flights.bronze(raw, ["ORD", "SEA"]))
    table.delete("Year = 1987")
    silver = flights.silver(table.read())
    assert [r["year"] for r in reports.yearly_delays(silver).collect()] == [2007, 2008]


def test_rewriting_a_versioned_table_keeps_its_partitioning(spark, raw, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    table.overwrite(raw, ["Year"])
    table.delete("Year = 1998")
    for rewrite in (table.compact, lambda: table.optimize(["Month"], files=2)):
        rewrite()
        folder = table.history().orderBy(F.desc("version")).first()["data"]
        assert glob.glob(f"{folder}/Year=*")
    table.compact(partition_by=[])
    assert not glob.glob(f"{table.history().orderBy(F.desc('version')).first()['data']}/Year=*")
