"""A table kept as parquet snapshots with a change history.

`<path>/data/<uuid>` holds the rows of a snapshot, `<path>/history` one row per
change. A change becomes visible when its history row is appended, after its
data is complete, so a reader never sees a half-written version and data left by
a failed job is never read. One writer at a time.
"""

from __future__ import annotations

import datetime
import json
import uuid
from functools import reduce
from operator import and_, or_

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gatehold.functions.names import quoted
from gatehold.operators.layout import zorder
from gatehold.session import staged

HISTORY = (
    "version long, timestamp timestamp, operation string, parameters string, "
    "rows_before long, rows_after long, data string, schema string, partitions array<string>, deleted array<string>"
)


def _matches(predicates: list[str]) -> Column:
    """Whether one of the SQL conditions is true; an unknown one is not."""
    return reduce(or_, [F.coalesce(F.expr(p), F.lit(False)) for p in predicates])


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def history(self) -> DataFrame:
        """One row per change, oldest version 0."""
        try:
            return self.spark.read.schema(HISTORY).parquet(f"{self.path}/history")
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], HISTORY)

    def latest_version(self) -> int | None:
        return self.history().agg(F.max("version").alias("version")).first()["version"]

    def _latest(self) -> Row | None:
        return self.history().orderBy(F.desc("version")).first()

    def read(self) -> DataFrame:
        latest = self._latest()
        if latest is None:
            raise ValueError(f"{self.path} has no version yet")
        rows = self._written(latest)
        # A partitioned folder gives its partition columns last; the table keeps the order it was written with.
        rows = rows.select(*map(quoted, self._schema(latest).names))
        for predicate in latest["deleted"]:
            rows = rows.filter(~_matches([predicate]))
        return rows

    def _schema(self, version: Row) -> StructType:
        return StructType.fromJson(json.loads(version["schema"]))

    def _written(self, version: Row) -> DataFrame:
        """The rows in the files of a version, deleted ones included."""
        return self.spark.read.schema(self._schema(version)).parquet(version["data"])

    def overwrite(
        self,
        df: DataFrame,
        partition_by: list[str] | None = None,
        operation: str = "OVERWRITE",
        parameters: dict | None = None,
    ) -> DataFrame:
        """Publish `df` as the next version. `df` may come from this table."""
        data = f"{self.path}/data/{uuid.uuid4().hex}"
        before = self._latest()
        seen = Observation()  # the rows are counted while they are written
        writer = df.observe(seen, F.count(F.lit(1)).alias("rows")).write
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(data)
        rows = seen.get["rows"]
        self._append(before, operation, parameters or {}, rows, data, df.schema.json(), list(partition_by or []), [])
        return self.read()

    def delete(self, predicate: str) -> DataFrame:
        """Remove the rows for which the SQL condition is true, and return the history row as a frame.

        The condition must depend on the row alone, not on the time or on chance.
        The version records the condition and `read()` applies it, so a delete
        costs one count of the matching rows, not a rewrite; on a partition
        column the deleted files are pruned. `compact()` rewrites the files.
        """
        before = self._latest()
        if before is None:
            raise ValueError(f"{self.path} has no version yet")
        removed = self.read().filter(predicate).count()
        self._append(
            before,
            "DELETE",
            {"predicate": predicate},
            before["rows_after"] - removed,
            before["data"],
            before["schema"],
            before["partitions"],
            [*before["deleted"], predicate],
        )
        return self.history().filter(F.col("version") == before["version"] + 1)

    def compact(self, partition_by: list[str] | None = None) -> DataFrame:
        """Take deleted rows out of the current files. The partitioning stays as it is where none is given.

        Of a partitioned table only the partitions that hold deleted rows are written again, in place; the files of the
        others keep their names. If the job dies in between, the conditions of the deletes still hold for old and new
        files, and it can be run again. Frames that were made before must not be read afterwards.
        """
        latest = self._latest()
        partitions = self._partitions(partition_by)
        if latest is None or not partitions or partitions != list(latest["partitions"] or []):
            return self.overwrite(self.read(), partitions, "COMPACT")
        if latest["deleted"]:
            rewritten = self._rewrite_touched(latest, partitions)
        else:
            rewritten = 0
        parameters = {"rewritten_partitions": rewritten}
        self._append(
            latest, "COMPACT", parameters, latest["rows_after"], latest["data"], latest["schema"], partitions, []
        )
        return self.read()

    def _rewrite_touched(self, latest: Row, partitions: list[str]) -> int:
        """Write the partitions again that hold rows of `latest` that were deleted; their number."""
        rows, gone = self._written(latest), _matches(latest["deleted"])
        place = F.regexp_replace(rows.metadataColumn("_metadata")["file_path"], "/[^/]*$", "")
        touched = (
            rows.groupBy(place.alias("folder"), *[quoted(p).alias(f"value_{i}") for i, p in enumerate(partitions)])
            .agg(F.count_if(gone).alias("gone"), F.count_if(~gone).alias("kept"))
            .filter("gone > 0")
            .select(
                "kept",
                F.url_decode(F.replace("folder", F.lit("+"), F.lit("%2B"))).alias("folder"),
                F.struct(*[f"value_{i}" for i in range(len(partitions))]).alias("values"),
            )
        )
        touched = staged(touched, "touched")
        for r in touched.filter("kept = 0").select("folder").collect():  # one row per emptied partition
            left = [f for f in self._schema(latest).fields if f.name not in partitions]
            self.spark.createDataFrame([], StructType(left)).write.mode("overwrite").parquet(r["folder"])
        some = F.broadcast(touched.filter("kept > 0").select("values"))  # no more rows than partitions
        same = [quoted(p).eqNullSafe(F.col("values")[f"value_{i}"]) for i, p in enumerate(partitions)]
        condition = reduce(and_, same)
        # Stored apart first: the folder that is written must not be read by the same job.
        survivors = staged(rows.join(some, condition, "left_semi").filter(~gone), "survivors")
        writer = survivors.hint("rebalance", *map(quoted, partitions)).write.mode("overwrite").partitionBy(*partitions)
        writer.option("partitionOverwriteMode", "dynamic").parquet(latest["data"])
        return touched.count()

    def optimize(self, columns: list[str], files: int | None = None, partition_by: list[str] | None = None) -> DataFrame:
        """Rewrite the rows clustered by `columns`; the partitioning stays as it is where none is given."""
        partition_by = self._partitions(partition_by)
        clustered = zorder(self.read(), columns, files, partition_by)
        return self.overwrite(clustered, partition_by, "OPTIMIZE", {"zorder": columns})

    def _partitions(self, given: list[str] | None) -> list[str]:
        latest = self._latest()
        return list(latest["partitions"] or []) if given is None and latest else list(given or [])

    def _append(self, before, operation, parameters, rows_after, data, schema, partitions, deleted) -> None:
        row = (
            0 if before is None else before["version"] + 1,
            datetime.datetime.now(datetime.timezone.utc),
            operation,
            json.dumps(parameters, sort_keys=True),
            None if before is None else before["rows_after"],
            rows_after,
            data,
            schema,
            partitions,
            deleted,
        )
        self.spark.createDataFrame([row], HISTORY).coalesce(1).write.mode("append").parquet(f"{self.path}/history")
