"""DuckDB SQL with the expected result of each registered query, written independently of the Spark code."""

from __future__ import annotations

_INPUTS = """
flights_raw AS (
  SELECT CAST(year(l_shipdate) AS INTEGER) AS "Year", CAST(month(l_shipdate) AS INTEGER) AS "Month",
         CAST(day(l_shipdate) AS INTEGER) AS "DayofMonth", CAST(isodow(l_shipdate) AS INTEGER) AS "DayOfWeek",
         CASE WHEN (l_orderkey + l_linenumber) % 97 = 0 THEN NULL
              WHEN (l_orderkey + l_linenumber) % 89 = 0 THEN '2400'
              ELSE CAST(((l_orderkey * 37 + l_linenumber * 11) % 1440) // 60 * 100
                        + ((l_orderkey * 37 + l_linenumber * 11) % 1440) % 60 AS VARCHAR) END AS "CRSDepTime",
         l_returnflag || l_linestatus AS "UniqueCarrier", l_linenumber AS "FlightNum",
         CASE WHEN l_discount <> 0 THEN 'N' || CAST(l_suppkey AS VARCHAR) END AS "TailNum",
         sn.n_name AS "Origin", cn.n_name AS "Dest", CAST(l_quantity AS INTEGER) AS "Distance",
         CASE WHEN l_tax <> 0 THEN CAST(CAST(l_shipdate AS DATE) - CAST(o_orderdate AS DATE) AS INTEGER) END AS "DepDelay"
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
       JOIN customer ON o_custkey = c_custkey JOIN nation cn ON c_nationkey = cn.n_nationkey
       JOIN supplier ON l_suppkey = s_suppkey JOIN nation sn ON s_nationkey = sn.n_nationkey),
clock AS (
  SELECT *, CAST(substr(lpad(CRSDepTime, 4, '0'), 1, 2) AS INTEGER) AS hh,
         CAST(substr(lpad(CRSDepTime, 4, '0'), 3, 2) AS INTEGER) AS mm FROM flights_raw),
silver AS (
  SELECT "Year", "Month", "DayofMonth" AS "Day", "DayOfWeek",
         lpad(CAST("Year" AS VARCHAR), 4, '0') || lpad(CAST("Month" AS VARCHAR), 2, '0')
           || lpad(CAST("DayofMonth" AS VARCHAR), 2, '0') AS "DateString",
         CASE WHEN hh BETWEEN 0 AND 23 AND mm BETWEEN 0 AND 59
              THEN CAST(hh AS DOUBLE) + CAST(mm AS DOUBLE) / CAST(60 AS DOUBLE) END AS "decimal_DepTime",
         "UniqueCarrier", "FlightNum", coalesce("TailNum", 'N/A') AS "TailNum", "Origin", "Dest", "Distance",
         coalesce("DepDelay", 0) AS "delay",
         CAST(CASE WHEN "DepDelay" > 15 THEN 1 ELSE 0 END AS INTEGER) AS "label"
  FROM clock),
days AS (
  SELECT o_orderdate, c_nationkey, min(o_orderkey) AS k, min(o_totalprice) AS low, max(o_totalprice) AS high
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY o_orderdate, c_nationkey),
weather_raw AS (
  SELECT 'STN' || CAST(c_nationkey AS VARCHAR) AS "STATION", o_orderdate AS "DATE",
         CASE WHEN k % 10 = 0 THEN 'FM-15' WHEN k % 10 < 5 THEN 'SOD' ELSE 'SOD  ' END AS "REPORT_TYPE2",
         CASE WHEN k % 7 = 0 THEN 'T' WHEN k % 11 = 0 THEN NULL WHEN k % 13 = 0 THEN '0.05s'
              ELSE CAST(k % 3 AS VARCHAR) || '.' || lpad(CAST(k % 100 AS VARCHAR), 2, '0') END AS "DailyPrecipitation",
         CASE WHEN k % 5 = 0 THEN 'T' WHEN k % 17 = 0 THEN NULL
              ELSE '0.' || CAST(k % 10 AS VARCHAR) END AS "DailySnowfall",
         CASE WHEN k % 4 = 0 THEN 'T' WHEN k % 6 = 1 THEN CAST(k % 8 AS VARCHAR) || '.' || CAST(k % 10 AS VARCHAR)
              ELSE CAST(k % 20 AS VARCHAR) END AS "DailySnowDepth",
         CAST(trunc(low / 10000) AS INTEGER) AS "DailyMinimumDryBulbTemperature",
         CAST(trunc(high / 10000) AS INTEGER) AS "DailyMaximumDryBulbTemperature"
  FROM days),
weather AS (
  SELECT "STATION", n_name AS "Airport", strftime("DATE", '%Y-%m-%d') AS "DATE",
         CAST(year("DATE") AS INTEGER) AS "YEAR", CAST(month("DATE") AS INTEGER) AS "MONTH",
         CAST(day("DATE") AS INTEGER) AS "DAY", strftime("DATE", '%Y%m%d') AS "DateString",
         TRY_CAST(CASE WHEN "DailyPrecipitation" = 'T' THEN '0.0' ELSE "DailyPrecipitation" END AS DOUBLE) AS "PREP",
         TRY_CAST(CASE WHEN "DailySnowfall" = 'T' THEN '0.0' ELSE "DailySnowfall" END AS DOUBLE) AS "SNOW",
         CAST(trunc(TRY_CAST(CASE WHEN "DailySnowDepth" = 'T' THEN '0' ELSE "DailySnowDepth" END AS DOUBLE)) AS INTEGER)
           AS "SNWD",
         "DailyMinimumDryBulbTemperature" AS "TMIN", "DailyMaximumDryBulbTemperature" AS "TMAX"
  FROM weather_raw JOIN nation ON "STATION" = 'STN' || CAST(n_nationkey AS VARCHAR)
  WHERE trim("REPORT_TYPE2") = 'SOD'),
gold AS (
  SELECT a.*, b."STATION", b."DATE", b."PREP", b."SNOW", b."SNWD", b."TMIN", b."TMAX"
  FROM silver a JOIN weather b ON a."DateString" = b."DateString" AND a."Origin" = b."Airport"),
airports AS (
  SELECT n_name AS iata_code, 'Airport ' || CAST(n_nationkey AS VARCHAR) AS name,
         CASE WHEN n_nationkey % 10 = 0 THEN r_name ELSE r_name || '-' || n_name END AS iso_region,
         CASE WHEN n_nationkey % 10 = 0 THEN NULL ELSE n_name END AS region
  FROM nation JOIN region ON n_regionkey = r_regionkey),
sites AS (
  SELECT c_name AS iata_code, 'Site ' || CAST(c_custkey AS VARCHAR) AS name,
         CASE WHEN c_custkey % 10 = 0 THEN r_name ELSE r_name || '-' || n_name END AS iso_region,
         CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE n_name END AS region
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
features AS (
  SELECT "Year", "Month", "Day", "DayOfWeek", CAST(trunc("decimal_DepTime" * CAST(100 AS DOUBLE)) AS INTEGER) AS "decimal_DepTime",
         "UniqueCarrier", "FlightNum", "TailNum", "Origin", "Dest", "Distance", "label",
         CAST(trunc("PREP" * CAST(100 AS DOUBLE)) AS INTEGER) AS "PREP",
         CAST(trunc("SNOW" * CAST(100 AS DOUBLE)) AS INTEGER) AS "SNOW", "TMIN", "TMAX", "Origin" || "Dest" AS line
  FROM gold WHERE "Year" IN (1997, 1998)),
codes AS (
  SELECT "column", value, CAST(rank() OVER (PARTITION BY "column" ORDER BY value) - 1 AS DOUBLE) AS code FROM (
    SELECT DISTINCT 'TailNum' AS "column", "TailNum" AS value FROM features
    UNION ALL SELECT DISTINCT 'Origin', "Origin" FROM features
    UNION ALL SELECT DISTINCT 'Dest', "Dest" FROM features
    UNION ALL SELECT DISTINCT 'line', line FROM features
    UNION ALL SELECT DISTINCT 'UniqueCarrier', "UniqueCarrier" FROM features)),
encoded AS (
  SELECT f.* REPLACE (t.code AS "TailNum", o.code AS "Origin", d.code AS "Dest", l.code AS line, u.code AS "UniqueCarrier")
  FROM features f
       JOIN codes t ON t."column" = 'TailNum' AND t.value = f."TailNum"
       JOIN codes o ON o."column" = 'Origin' AND o.value = f."Origin"
       JOIN codes d ON d."column" = 'Dest' AND d.value = f."Dest"
       JOIN codes l ON l."column" = 'line' AND l.value = f.line
       JOIN codes u ON u."column" = 'UniqueCarrier' AND u.value = f."UniqueCarrier"),
scored AS (
  SELECT "label", s AS score, CAST(CASE WHEN s >= 0.5 THEN 1 ELSE 0 END AS INTEGER) AS prediction, "Day" % 5 AS fold
  FROM (SELECT *, CAST(("Distance" * 37 + "FlightNum" * 101 + "Day" * 13 + "label" * 150) % 1000 AS DOUBLE)
                  / CAST(1000 AS DOUBLE) AS s FROM silver))
"""

_BODIES: dict[str, str] = {}

_BODIES["s1_headed_csv"] = "SELECT * FROM flights_raw"
_BODIES["s2_headerless_csv"] = "SELECT * FROM flights_raw"
_BODIES["s3_glob_csv"] = 'SELECT * FROM flights_raw WHERE "Year" BETWEEN 1996 AND 1998'
_BODIES["s4_json"] = "SELECT iata_code, name, iso_region FROM sites"
_BODIES["s4_json_inferred"] = "SELECT iata_code, iso_region, name FROM sites"
_BODIES["s5_text_csv"] = """
  SELECT "STATION", "Airport", CAST("YEAR" AS VARCHAR) AS "YEAR", CAST("MONTH" AS VARCHAR) AS "MONTH",
         CAST("DAY" AS VARCHAR) AS "DAY", "DateString", CAST("PREP" AS VARCHAR) AS "PREP", CAST("SNOW" AS VARCHAR) AS "SNOW",
         CAST("SNWD" AS VARCHAR) AS "SNWD", CAST("TMIN" AS VARCHAR) AS "TMIN", CAST("TMAX" AS VARCHAR) AS "TMAX"
  FROM weather"""
_BODIES["s6_table_scan"] = "SELECT * FROM weather"
_BODIES["s7_temp_view"] = 'SELECT "UniqueCarrier", count(*) AS n FROM flights_raw GROUP BY 1'
_YEARLY = """
  SELECT "Year" AS year, count(*) AS delayed, CAST(sum("delay") AS BIGINT) AS total_delay
  FROM silver WHERE "delay" > 0 GROUP BY 1 ORDER BY 1"""
_BODIES["s8_sql_view"] = _YEARLY
_BY_DESTINATION = """
  SELECT "Year" AS year, "Dest" AS dest, CAST(sum("delay") AS BIGINT) AS total_delay
  FROM silver WHERE "Dest" IN ('NATION_3', 'NATION_7') GROUP BY 1, 2 ORDER BY 1"""
_BODIES["s9_local_frame"] = _BY_DESTINATION

_BODIES["t1_overwrite_table"] = "SELECT * FROM flights_raw WHERE \"Origin\" IN ('NATION_3', 'NATION_7')"
_BODIES["t2_create_table"] = "SELECT * FROM sites"
_BODIES["t3_partitioned_table"] = "SELECT * FROM silver"
_BODIES["t4_plain_table"] = "SELECT * FROM weather"
_BODIES["t5_csv_export"] = "SELECT count(*) AS rows, CAST(3 AS BIGINT) AS files FROM weather"
_BODIES["t6_delete_rows"] = 'SELECT "Year", count(*) AS n FROM flights_raw WHERE "Year" <> 1998 GROUP BY 1'
_BODIES["t6_compact"] = """
  SELECT "Year", count(*) AS n, CAST(3 AS INTEGER) AS rewritten FROM flights_raw
  WHERE "Year" <> 1998 AND NOT ("Year" IN (1995, 1996) AND "Month" < 7) GROUP BY 1"""
_BODIES["t7_history"] = """
  SELECT CAST(0 AS BIGINT) AS version, 'OVERWRITE' AS operation, CAST(NULL AS BIGINT) AS rows_before, count(*) AS rows_after
  FROM flights_raw
  UNION ALL SELECT 1, 'DELETE', count(*), count(*) FILTER (WHERE "Year" <> 1998) FROM flights_raw"""
_BODIES["t8_latest_version"] = "SELECT CAST(1 AS BIGINT) AS version"
_BODIES["t9_zorder"] = "SELECT * FROM silver"
_BODIES["t9_optimize_table"] = "SELECT * FROM gold"
_BODIES["t9_file_skipping"] = " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(*) FILTER (WHERE "{c}" = {p}) AS rows, CAST(0 AS BIGINT) AS lost, true AS skips FROM silver"""
    for c, p in (("Month", 6), ("Distance", 10), ("Dest", "'NATION_7'"))
)
_BODIES["t10_database"] = 'SELECT "Origin", count(*) AS n FROM flights_raw GROUP BY 1'
_BODIES["t11_copy_table"] = "SELECT * FROM gold"
_BODIES["t12_column_statistics"] = " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", CAST(min("{c}") AS VARCHAR) AS min, CAST(max("{c}") AS VARCHAR) AS max,
               count(*) - count("{c}") AS num_nulls FROM silver"""
    for c in ("Month", "Distance", "delay", "label")
)
_BODIES["t13_cached"] = _YEARLY
_BODIES["t14_local_result"] = _YEARLY
_BODIES["t15_preview"] = """
  SELECT * FROM silver ORDER BY "Year", "Month", "Day", "DayOfWeek", "DateString", "decimal_DepTime" NULLS FIRST,
    "UniqueCarrier", "FlightNum", "TailNum", "Origin", "Dest", "Distance", "delay", "label" LIMIT 100"""

_BODIES["p1_silver"] = "SELECT * FROM silver"
_BODIES["p2_star"] = "SELECT * FROM weather"
_BODIES["p3_star_and_other_side"] = "SELECT * FROM gold"
_BODIES["p4_star_and_line"] = 'SELECT "Year", "FlightNum", "DateString", "Origin" || "Dest" AS line FROM silver'
_BODIES["p5_add_column"] = "SELECT * FROM sites"
_BODIES["p6_constant_column"] = "SELECT * FROM weather WHERE \"STATION\" = 'STN3'"
_BODIES["p7_drop_columns"] = 'SELECT * EXCLUDE ("DateString", "DATE", "STATION") FROM weather'
_BODIES["p8_rename_columns"] = "SELECT iata_code AS code, name AS airport_name, iso_region, region FROM sites"
_RAW_COLUMNS = (
    "Year Month DayofMonth DayOfWeek CRSDepTime UniqueCarrier FlightNum TailNum Origin Dest Distance DepDelay".split()
)
_BODIES["p9_generated_projection"] = " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(*) - count("{c}") AS nulls, CAST(NULL AS BIGINT) AS nans FROM flights_raw"""
    for c in _RAW_COLUMNS
)
_BODIES["p10_features_side_by_side"] = "SELECT * FROM features"
_BODIES["p11_shape"] = "SELECT count(*) AS rows, CAST(17 AS INTEGER) AS columns FROM features"
_BODIES["p12_derived_table"] = "SELECT CAST(1 AS BIGINT) AS version"
_BODIES["p13_label"] = 'SELECT "label" FROM silver'
_SILVER_COLUMNS = (
    "Year Month Day DayOfWeek DateString decimal_DepTime UniqueCarrier FlightNum TailNum Origin Dest Distance delay label"
).split()
_BODIES["p14_column_names"] = " UNION ALL ".join(
    f"""SELECT CAST({i} AS INTEGER) AS position, '{c}' AS name, count("{c}") AS values FROM silver"""
    for i, c in enumerate(_SILVER_COLUMNS)
)

_BODIES["f1_bronze"] = "SELECT * FROM flights_raw WHERE \"Origin\" = 'NATION_3' OR \"Origin\" = 'NATION_7'"
_BODIES["f2_and"] = "SELECT * FROM silver WHERE \"Year\" = 1997 AND \"Origin\" = 'NATION_3'"
_BODIES["f3_in_list"] = (
    "SELECT * FROM silver WHERE \"Year\" IN (1996, 1997, 1998) AND \"Dest\" IN ('NATION_3', 'NATION_7')"
)
_BODIES["f4_parameter"] = 'SELECT "Origin", count(*) AS n FROM silver WHERE "Year" = 1997 GROUP BY 1'
_BODIES["f5_parameter_list"] = 'SELECT "Year", count(*) AS n FROM silver WHERE "Year" IN (1997, 1998, 1999) GROUP BY 1'
_BODIES["f6_trimmed_equality"] = """
  SELECT "STATION", strftime("DATE", '%Y-%m-%d') AS "DATE", "REPORT_TYPE2" FROM weather_raw WHERE "REPORT_TYPE2" LIKE 'SOD%'"""
_BODIES["f7_comparison"] = 'SELECT * FROM silver WHERE "delay" > 0'
_BODIES["f8_having"] = """
  SELECT "Dest", CAST(sum("delay") AS BIGINT) AS total_delay FROM silver GROUP BY 1 HAVING sum("delay") > 500"""
_BODIES["f9_year_mask"] = 'SELECT * FROM features WHERE "Year" = 1998'
_BODIES["f10_single_year"] = 'SELECT * FROM silver WHERE "Year" = 1998'

_BODIES["j1_gold_join"] = "SELECT * FROM gold"
_BODIES["j1_salted_join"] = "SELECT * FROM gold"
_BODIES["j1_hot_carriers"] = """
  SELECT s.*, c.first_day, c.longest FROM silver s
       JOIN (SELECT "UniqueCarrier", min("DateString") AS first_day, max("Distance") AS longest FROM silver GROUP BY 1) c
         ON s."UniqueCarrier" = c."UniqueCarrier" """
_BODIES["j1_unmatched"] = """
  SELECT count(*) AS unmatched FROM silver a
  WHERE NOT EXISTS (SELECT 1 FROM weather b WHERE a."DateString" = b."DateString" AND a."Origin" = b."Airport")"""
_BODIES["j1_repeated_weather"] = """
  SELECT "DateString", 'all' AS "Airport", count(*) AS n FROM weather GROUP BY 1 HAVING count(*) > 1"""
_BODIES["j2_airport_join"] = """
  SELECT "DateString", "FlightNum", "Origin", "Dest", "delay", name, region FROM silver JOIN airports ON iata_code = "Dest" """

_BODIES["a1_delay_by_route"] = """
  SELECT "Year" AS year, "Origin" AS origin, "Dest" AS dest, CAST(sum("delay") AS BIGINT) AS total_delay
  FROM silver WHERE "Year" = 1997 AND "Origin" = 'NATION_3' GROUP BY 1, 2, 3 HAVING sum("delay") > 500 ORDER BY 1, 4"""
_BODIES["a2_delay_by_route_all_origins"] = """
  SELECT "Year" AS year, "Origin" AS origin, "Dest" AS dest, CAST(sum("delay") AS BIGINT) AS total_delay
  FROM silver WHERE "Year" = 1997 GROUP BY 1, 2, 3 HAVING sum("delay") > 500 ORDER BY 1, 4"""
_NAMED = """
  SELECT "Year" AS year, "Origin" AS origin, "Dest" || ' - ' || i.name AS name, CAST(sum("delay") AS BIGINT) AS total_delay
  FROM silver JOIN airports i ON i.iata_code = "Dest" WHERE {where}
  GROUP BY "Year", "Origin", i.name, "Dest" HAVING sum("delay") > 500 ORDER BY 1, 4"""
_BODIES["a3_delay_by_named_route"] = _NAMED.format(where="\"Year\" IN (1996, 1997, 1998) AND \"Origin\" = 'NATION_3'")
_BODIES["a4_delay_by_named_route_from"] = _NAMED.format(where='"Year" IN (1997, 1998, 1999)')
_BODIES["a5_delay_by_destination"] = _BY_DESTINATION
_BODIES["a6_yearly_delays"] = _YEARLY
_BODIES["a7_filtered_count"] = 'SELECT count(*) AS n FROM flights_raw WHERE "Year" = 1998'
_BODIES["a8_years_present"] = 'SELECT DISTINCT "Year" AS year FROM silver ORDER BY 1'
_GOLD_COLUMNS = [*_SILVER_COLUMNS, "STATION", "PREP", "SNOW", "SNWD", "TMIN", "TMAX"]
_BODIES["a9_missing_counts"] = (
    "SELECT "
    + ", ".join(f'count(*) - count("{c}") AS "{c}_nulls"' for c in _GOLD_COLUMNS)
    + ", "
    + ", ".join(f'count(*) FILTER (WHERE isnan("{c}")) AS "{c}_nans"' for c in ("decimal_DepTime", "PREP", "SNOW"))
    + " FROM gold"
)
_BODIES["a9_missing_while_written"] = _BODIES["a9_missing_counts"]
_BODIES["a10_max"] = "SELECT count(*) AS most_rows FROM flights_raw"
_BODIES["a11_mean_fold_score"] = """
  SELECT round(avg(a), 9) AS mean_accuracy FROM (
    SELECT fold, avg(CASE WHEN "label" = prediction THEN 1.0 ELSE 0.0 END) AS a FROM scored GROUP BY fold)"""

_BODIES["o1_order_by_two_keys"] = """
  SELECT "Year", "Dest", CAST(sum("delay") AS BIGINT) AS total_delay FROM silver GROUP BY 1, 2 ORDER BY 1, 3"""
_BODIES["o2_order_by_date"] = 'SELECT * FROM weather ORDER BY "DATE"'
_BODIES["o3_sorted_write"] = 'SELECT "Year", "DateString", "Origin", "Dest", "delay" FROM silver ORDER BY 1, 2'
_BODIES["o4_top_delays"] = """
  SELECT "delay", "DateString", "Origin", "Dest", "FlightNum" FROM silver ORDER BY 1 DESC, 2, 3, 4, 5 LIMIT 100"""
_BODIES["o5_round_robin"] = "SELECT count(*) AS rows, CAST(3 AS BIGINT) AS parts FROM weather"
_BODIES["u1_multipart_csv"] = "SELECT * FROM flights_raw"
_BODIES["u2_stations_union"] = "SELECT * FROM weather WHERE \"Airport\" IN ('NATION_3', 'NATION_7')"

_BODIES["e1_date_string"] = 'SELECT "DateString", count(*) AS n FROM silver GROUP BY 1'
_BODIES["e2_hour_base10"] = """
  SELECT "CRSDepTime", CASE WHEN hh < 24 THEN CAST(hh AS DOUBLE) + CAST(mm AS DOUBLE) / CAST(60 AS DOUBLE) END AS "decimal_DepTime",
         count(*) AS n FROM clock GROUP BY 1, 2"""
_BODIES["e3_delay_label"] = """
  SELECT "DepDelay", CAST(CASE WHEN coalesce("DepDelay", 0) > 15 THEN 1 ELSE 0 END AS INTEGER) AS "label", count(*) AS n
  FROM flights_raw GROUP BY 1, 2"""
_BODIES["e4_casts"] = """
  SELECT "DailyPrecipitation", TRY_CAST("DailyPrecipitation" AS DOUBLE) AS as_double,
         CAST(trunc(TRY_CAST("DailyPrecipitation" AS DOUBLE)) AS INTEGER) AS as_int,
         CAST(CAST(trunc(TRY_CAST("DailyPrecipitation" AS DOUBLE)) AS INTEGER) AS VARCHAR) AS as_text, count(*) AS n
  FROM weather_raw GROUP BY 1, 2, 3, 4"""
_BODIES["e5_lpad"] = """SELECT lpad("CRSDepTime", 4, '0') AS padded, count(*) AS n FROM flights_raw GROUP BY 1"""
_BODIES["e6_default"] = """
  SELECT "TailNum", count(*) AS n, CAST(sum("delay") AS BIGINT) AS total_delay FROM silver GROUP BY 1"""
_BODIES["e7_trace_amount"] = """
  SELECT TRY_CAST(replace("DailyPrecipitation", 'T', '0') AS DOUBLE) AS "PREP",
         CAST(trunc(TRY_CAST(replace("DailySnowDepth", 'T', '0') AS DOUBLE)) AS INTEGER) AS "SNWD", count(*) AS n
  FROM weather_raw GROUP BY 1, 2"""
_BODIES["e8_trim"] = 'SELECT trim("REPORT_TYPE2") AS kind, count(*) AS n FROM weather_raw GROUP BY 1'
_BODIES["e9_concat"] = """SELECT "TailNum" || ' - ' || "UniqueCarrier" AS label, count(*) AS n FROM flights_raw GROUP BY 1"""
_BODIES["e10_split_part"] = "SELECT iata_code, string_split(iso_region, '-')[2] AS region FROM sites"
_BODIES["e11_date_parts"] = """
  SELECT CAST(year("DATE") AS INTEGER) AS "YEAR", CAST(month("DATE") AS INTEGER) AS "MONTH",
         CAST(day("DATE") AS INTEGER) AS "DAY", count(*) AS n FROM weather_raw GROUP BY 1, 2, 3"""
_BODIES["e12_day_key"] = """SELECT strftime("DATE", '%Y%m%d') AS "DateString", count(*) AS n FROM weather_raw GROUP BY 1"""
_BODIES["e13_isnan"] = """
  SELECT CAST(0 AS BIGINT) AS nan_in_nulls, count(*) - count("DepDelay") AS nan_in_filled FROM flights_raw"""
_BODIES["e14_when"] = """
  SELECT CASE WHEN "DepDelay" > 15 THEN "UniqueCarrier" END AS late_carrier, count(*) AS n FROM flights_raw GROUP BY 1"""
_BODIES["e15_year_arithmetic"] = """
  SELECT "Year", "Year" + 1 AS next_year, count(*) AS n FROM silver WHERE "Year" BETWEEN 1997 AND 1999 GROUP BY 1, 2"""
_BODIES["e16_scaled_int"] = """
  SELECT CAST(trunc("decimal_DepTime" * CAST(100 AS DOUBLE)) AS INTEGER) AS time_100, count(*) AS n FROM silver GROUP BY 1"""
_BODIES["d1_sql_functions"] = 'SELECT "DateString", "decimal_DepTime", "label" FROM silver'
_BODIES["d2_row_expression"] = """
  SELECT "Airport", "DateString", CAST(trunc("PREP" * CAST(100 AS DOUBLE)) AS INTEGER) AS "PREP",
         CAST(trunc("SNOW" * CAST(100 AS DOUBLE)) AS INTEGER) AS "SNOW" FROM weather"""

_BODIES["m1_feature_rows"] = "SELECT * FROM features"
_BODIES["m2_discretised"] = 'SELECT "decimal_DepTime", "PREP", "SNOW", count(*) AS n FROM features GROUP BY 1, 2, 3'
_BODIES["m3_ordinal_codes"] = "SELECT * FROM codes"
_BODIES["m4_feature_table"] = "SELECT * FROM encoded"
# What is certain of samples and trained models; the rest is chance.
_SAMPLE_ROWS = """(SELECT CAST(round(0.3 * count(*)) AS BIGINT) FROM features WHERE "Year" = 1997)"""
_BODIES["m5_train_sample"] = f"SELECT {_SAMPLE_ROWS} AS rows, CAST(0 AS BIGINT) AS other_years, CAST(0 AS BIGINT) AS not_of_the_year"
_BODIES["m6_forest"] = 'SELECT *, true AS is_share, true AS follows FROM encoded WHERE "Year" = 1998'
_GRID = "(VALUES (0, 5, 1), (1, 5, 5), (2, 10, 1), (3, 10, 5)) AS grid(trial, max_depth, min_instances)"
_BODIES["m10_grid_search"] = f"""
  SELECT max_depth, min_instances, 'gini' AS criterion, CAST(100 AS INTEGER) AS trees, CAST(5 AS BIGINT) AS folds,
         true AS is_mean, true AS ranked FROM {_GRID}"""
_BODIES["m10_fold_scores"] = f"""
  SELECT trial, CAST(fold AS INTEGER) AS fold, max_depth, min_instances, 'gini' AS criterion, CAST(100 AS INTEGER) AS trees,
         {_SAMPLE_ROWS} AS all_rows, true AS is_share FROM {_GRID}, range(5) AS f(fold)"""
_BODIES["m11_random_search"] = """
  SELECT CAST(16 AS BIGINT) AS trials, CAST(16 AS BIGINT) AS different, CAST(16 AS BIGINT) AS known,
         CAST(16 AS BIGINT) AS scored, true AS best"""
_BODIES["m12_runs"] = """
  SELECT 'baseline' AS name, CAST(0 AS BIGINT) AS data_version, 'on-time departures' AS tag,
         '{"max_depth": 5, "trees": 100}' AS parameters, 'accuracy,auc' AS measures, true AS are_shares"""
_BODIES["m13_scored_year"] = 'SELECT *, true AS is_share, true AS follows FROM features WHERE "Year" = 1998'
_BODIES["m14_predicted_late"] = """
  SELECT count(*) AS rows, CAST(0 AS BIGINT) AS not_late, true AS complete FROM features WHERE "Year" = 1998"""
_BODIES["m7_model_metrics"] = """
  SELECT count(*) AS rows, CAST(sum("label") AS BIGINT) AS late, CAST(1 AS DOUBLE) AS shares, CAST(1 AS DOUBLE) AS last_fpr,
         CAST(1 AS DOUBLE) AS last_tpr, true AS same_accuracy, true AS same_area FROM features WHERE "Year" = 1998"""
_BODIES["c1_refinement_chain"] = """
  SELECT "Year" AS year, "Origin" AS origin, "Dest" || ' - ' || i.name AS name, CAST(sum("delay") AS BIGINT) AS total_delay
  FROM gold JOIN airports i ON i.iata_code = "Dest"
  WHERE "Origin" IN ('NATION_3', 'NATION_7') AND "Year" IN (1996, 1997)
  GROUP BY "Year", "Origin", i.name, "Dest" HAVING sum("delay") > 0 ORDER BY 1, 4"""
_BODIES["m5_test_rows"] = 'SELECT * FROM encoded WHERE "Year" = 1998'
_BODIES["m7_accuracy"] = """
  SELECT round(avg(CASE WHEN "label" = prediction THEN 1.0 ELSE 0.0 END), 9) AS accuracy FROM scored"""
_BODIES["m8_roc_points"] = """
  SELECT CAST(NULL AS DOUBLE) AS threshold, CAST(0 AS DOUBLE) AS fpr, CAST(0 AS DOUBLE) AS tpr
  UNION ALL
  SELECT score, round(sum(neg) OVER (ORDER BY score DESC) / sum(neg) OVER (), 9),
         round(sum(pos) OVER (ORDER BY score DESC) / sum(pos) OVER (), 9)
  FROM (SELECT score, CAST(sum("label") AS DOUBLE) AS pos, CAST(sum(1 - "label") AS DOUBLE) AS neg FROM scored GROUP BY score)"""
# Rank-sum form, with average ranks for ties.
_BODIES["m8_roc_area"] = """
  SELECT round((sum(CASE WHEN "label" = 1 THEN avg_rank ELSE 0 END)
                - CAST(sum("label") AS DOUBLE) * (sum("label") + 1) / 2)
               / (CAST(sum("label") AS DOUBLE) * sum(1 - "label")), 9) AS auc
  FROM (SELECT "label", rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS avg_rank FROM scored)"""
_BODIES["m9_confusion"] = """
  SELECT CAST(a AS INTEGER) AS "label", CAST(p AS INTEGER) AS prediction,
         count(s."label") AS n, round(CAST(count(s."label") AS DOUBLE) / (SELECT count(*) FROM scored), 9) AS share
  FROM (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) AS cells(a, p)
       LEFT JOIN scored s ON s."label" = a AND s.prediction = p GROUP BY a, p"""


def oracle_sql() -> dict[str, str]:
    return {name: f"WITH {_INPUTS} {body}" for name, body in _BODIES.items()}
