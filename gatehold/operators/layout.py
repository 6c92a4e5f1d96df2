"""Clustering rows over files by several columns at once.

Every file then covers a narrow range of each column, so the min/max statistics
in the parquet footers let a filter on any of them skip files.
"""

from __future__ import annotations

from os.path import commonprefix

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gatehold.functions.names import fresh, quoted
from gatehold.operators.joins import row_bytes

FILE_BYTES = 256 * 1024 * 1024  # of values in a file
_TEXT_BYTES = 6  # of a text, behind what all texts of the column begin with; a double holds them exactly
_ACCURACY = 10_000


def _is_text(kind: str) -> bool:
    return kind in ("string", "binary") or kind.startswith(("char", "varchar"))


def _number(column: Column, kind: str, shared: int) -> Column:
    """A double in the order of the column's values; of texts the bytes behind the first `shared` ones."""
    if _is_text(kind):
        part = F.hex(F.substring(column.cast("binary"), shared + 1, _TEXT_BYTES))
        return F.conv(F.rpad(part, 2 * _TEXT_BYTES, "0"), 16, 10).cast("double")
    if kind.startswith("timestamp"):
        return F.unix_micros(column.cast("timestamp")).cast("double")
    if kind == "date":
        return F.unix_date(column).cast("double")
    return column.cast("double")


def ranks(df: DataFrame, columns: list[str], bits: int) -> tuple[dict[str, Column], dict[str, list[float]], int, int]:
    """(numbers in the order of each column, their cut points, bytes of all values, rows).

    One aggregate measures the rows and finds what the texts of a column begin with, one merges quantile sketches of all
    columns: a summary for each task and column, of a size that does not depend on the data.
    """
    kinds = dict(df.dtypes)
    texts = [c for c in columns if _is_text(kinds[c])]
    ends = [f(quoted(c).cast("binary")).alias(f"{name}_{i}") for i, c in enumerate(texts) for f, name in ((F.min, "low"), (F.max, "high"))]
    found = df.agg(F.coalesce(F.sum(row_bytes(df)), F.lit(0)).alias("bytes"), F.count(F.lit(1)).alias("rows"), *ends).first()
    shared = {}
    for i, c in enumerate(texts):
        low, high = (bytes(found[f"{end}_{i}"] or b"") for end in ("low", "high"))
        shared[c] = len(commonprefix([low, high]))
    numbers = {c: _number(quoted(c), kinds[c], shared.get(c, 0)) for c in columns}
    shares = [i / 2**bits for i in range(1, 2**bits)]
    sketches = [F.percentile_approx(n, shares, _ACCURACY).alias(f"cuts_{i}") for i, n in enumerate(numbers.values())]
    cuts = df.agg(*sketches).first()
    points = {c: sorted({p for p in cuts[f"cuts_{i}"] or [] if p == p}) for i, c in enumerate(columns)}
    return numbers, points, found["bytes"], found["rows"]


def with_buckets(df: DataFrame, numbers: dict[str, Column], points: dict[str, list[float]], bits: int) -> DataFrame:
    """Add a column for each name: how many of its ascending points, fewer than 2**bits, are <= its number (null: 0).

    A binary search, one projection per bit, so that each row costs `bits` comparisons per column and the expression
    stays small.
    """
    arrays = {c: F.array(*[F.lit(p) for p in points[c]]).cast("array<double>") for c in numbers}
    held = dict(zip(numbers, fresh(df, *[f"__number_{i}" for i in range(len(numbers))])))
    df = df.withColumns({held[c]: n for c, n in numbers.items()}).withColumns({c: F.lit(0) for c in numbers})
    for step in (1 << b for b in reversed(range(bits))):
        higher = {c: F.get(arrays[c], quoted(c) + F.lit(step - 1)) <= quoted(held[c]) for c in numbers}
        df = df.withColumns({c: quoted(c) + F.when(higher[c], step).otherwise(0) for c in numbers})
    return df.drop(*held.values())


def interleave(buckets: list[str], bits: int) -> Column:
    """One number whose bits take turns from each bucket number, highest bits first."""
    z = F.lit(0).cast("long")
    width = len(buckets)
    for bit in range(bits):
        for i, name in enumerate(buckets):
            one = F.shiftright(F.col(name), bit).bitwiseAND(F.lit(1)).cast("long")
            z = z.bitwiseOR(F.shiftleft(one, bit * width + width - 1 - i))
    return z


def zorder(
    df: DataFrame,
    columns: list[str],
    files: int | None = None,
    partition_by: list[str] | None = None,
    bits: int = 8,
    file_bytes: int = FILE_BYTES,
) -> DataFrame:
    """Rows of `df` range-partitioned and sorted along a z-curve over `columns`, for `files` output files.

    Without `files` there are as many as the bytes of the values ask for. The values are replaced by their bucket numbers
    only inside the sort key, so skewed columns use the curve evenly; of a text column the six bytes behind the common
    beginning of its texts count. Rows with equal curve position, such as many copies of one row, are spread over
    neighbouring files by a hash. `df` is read four times, twice for the columns it is measured by: pass a stored table.
    """
    if bits * len(columns) > 62:
        raise ValueError("bits * number of columns must not exceed 62")
    partition_by = list(partition_by or [])
    numbers, points, size, _ = ranks(df, columns, bits)
    files = files or max(1, -(-size // file_bytes))
    z, tie, *names = fresh(df, "__z", "__tie", *[f"__bucket_{i}" for i in range(len(columns))])
    pairs = list(zip(names, columns))
    bucketed = with_buckets(df, {n: numbers[c] for n, c in pairs}, {n: points[c] for n, c in pairs}, bits)
    # A column of few values has few cut points; its buckets are stretched, so that it divides by its highest bits too.
    wide = {n: F.floor(quoted(n) * (2**bits / (len(points[c]) + 1))).cast("int") for n, c in pairs}
    bucketed = bucketed.withColumns(wide)
    spread = F.pmod(F.pmod(F.xxhash64(*map(quoted, df.columns)), F.lit(1024)) + F.spark_partition_id(), F.lit(1024))
    keyed = bucketed.withColumns({z: interleave(names, bits), tie: spread})
    by = [*map(quoted, partition_by), quoted(z)]
    return keyed.repartitionByRange(files, *by, quoted(tie)).sortWithinPartitions(*by).select(*map(quoted, df.columns))


def file_spans(stored: DataFrame, columns: list[str]) -> DataFrame:
    """(file, column position i as low_i and high_i, rows) of a frame read from files: what their footers can tell."""
    file = stored.metadataColumn("_metadata")["file_path"]
    spans = [f(quoted(c)).alias(f"{name}_{i}") for i, c in enumerate(columns) for f, name in ((F.min, "low"), (F.max, "high"))]
    return stored.groupBy(file.alias("file")).agg(F.count(F.lit(1)).alias("rows"), *spans)


def skippable(stored: DataFrame, points: dict[str, object]) -> DataFrame:
    """(file, rows, column, skipped): whether an equality filter on each column at its point need not read a file."""
    columns = list(points)
    spans = file_spans(stored, columns)
    outside = [
        F.coalesce((F.lit(points[c]) < F.col(f"low_{i}")) | (F.lit(points[c]) > F.col(f"high_{i}")), F.lit(True))
        for i, c in enumerate(columns)
    ]
    entries = [F.struct(F.lit(c).alias("column"), o.alias("skipped")) for c, o in zip(columns, outside)]
    return spans.select("file", "rows", F.inline(F.array(*entries)))
