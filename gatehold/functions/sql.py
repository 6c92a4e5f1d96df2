"""The same expressions under their SQL names, for queries written as text."""

from __future__ import annotations

from pyspark.sql import SparkSession

from gatehold.functions.columns import LATE_AFTER

# The function names that existing queries call.
# The bodies are SQL, which Spark inlines, so a call costs no Python.
_FUNCTIONS = {
    "toDateString(year STRING, month STRING, day STRING) RETURNS STRING": """
        CASE WHEN try_cast(year AS INT) BETWEEN 0 AND 9999 AND try_cast(month AS INT) BETWEEN 0 AND 99
                  AND try_cast(day AS INT) BETWEEN 0 AND 99
             THEN lpad(CAST(try_cast(year AS INT) * 10000 + try_cast(month AS INT) * 100
                            + try_cast(day AS INT) AS STRING), 8, '0')
             WHEN try_cast(year AS INT) IS NOT NULL AND try_cast(month AS INT) IS NOT NULL
                  AND try_cast(day AS INT) IS NOT NULL
             THEN format_string('%04d%02d%02d', try_cast(year AS INT), try_cast(month AS INT), try_cast(day AS INT))
        END""",
    "get_hour_base10(t STRING) RETURNS DOUBLE": """
        CASE WHEN length(t) BETWEEN 1 AND 4
                  AND try_cast(substring(lpad(t, 4, '0'), 1, 2) AS INT) BETWEEN 0 AND 23
                  AND try_cast(substring(lpad(t, 4, '0'), 3, 2) AS INT) BETWEEN 0 AND 59
             THEN try_cast(substring(lpad(t, 4, '0'), 1, 2) AS INT)
                  + try_cast(substring(lpad(t, 4, '0'), 3, 2) AS INT) / 60D
        END""",
    "delay_label(delay STRING) RETURNS INT": f"""
        CASE WHEN try_cast(try_cast(delay AS DOUBLE) AS INT) > {LATE_AFTER} THEN 1 ELSE 0 END""",
}


def register_functions(spark: SparkSession) -> None:
    for signature, body in _FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURN {body}")
