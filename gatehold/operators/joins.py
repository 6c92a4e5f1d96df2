"""Joining a large table to a lookup side."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce
from operator import add, or_

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from gatehold.functions.names import fresh, quoted
from gatehold.session import staged

BROADCAST_BYTES = 64 * 1024 * 1024
HOT_SHARE = 0.001  # a key above this share of the rows gets salts; adaptive execution splits what smaller ones gather
TARGET_ROWS = 1_000_000  # of a key in one task of the join
_SKETCH_ITEMS = 10_000


def _value_bytes(name: str, kind: str) -> Column:
    if kind in ("string", "binary") or kind.startswith(("char", "varchar")):
        size = F.octet_length(name)
    elif kind.startswith(("array", "map", "struct")):
        size = F.octet_length(F.to_json(F.struct(name)))
    else:
        return F.lit(8).cast("long")
    return F.coalesce(size, F.lit(0)).cast("long") + 8


def row_bytes(df: DataFrame) -> Column:
    """Size of the values of a row: 8 bytes per value plus the bytes of its texts."""
    return reduce(add, [_value_bytes(c, t) for c, t in df.dtypes])


def size_in_bytes(df: DataFrame) -> int:
    """Size of the values of `df`, by one aggregate."""
    return df.agg(F.coalesce(F.sum(row_bytes(df)), F.lit(0)).alias("bytes")).first()["bytes"]


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once; such keys multiply the rows of a join."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def _key_hash(keys: list[str]) -> Column:
    return F.xxhash64(*[quoted(k) for k in keys])


def _any_null(keys: list[str]) -> Column:
    return reduce(or_, [quoted(k).isNull() for k in keys])


@dataclass
class KeyCounts:
    """How the rows of a table spread over its keys: all rows, those with a null key, and the heavy keys by their hash."""

    rows: int = 0
    nulls: int = 0
    heavy: dict[int, int] = field(default_factory=dict)

    def salts(self, target_rows: int) -> dict[int, int]:
        """Tasks for each key that needs more than one: ceil(count / target_rows)."""
        wanted = {h: -(-n // target_rows) for h, n in self.heavy.items()}
        return {h: n for h, n in wanted.items() if n > 1}


def key_count_columns(keys: list[str], share: float = HOT_SHARE) -> list[Column]:
    """Aggregates from which `key_counts` takes the counts: a heavy-hitter sketch per task, merged.

    At most 1/share keys can qualify, so what reaches the driver is bounded whatever the table.
    """
    most = int(1 / share)
    known = F.when(~_any_null(keys), _key_hash(keys))
    return [
        F.count(F.lit(1)).alias("rows"),
        F.count_if(_any_null(keys)).alias("nulls"),
        F.call_function("approx_top_k", known, F.lit(most), F.lit(max(_SKETCH_ITEMS, 10 * most))).alias("top"),
    ]


def key_counts(found: dict, share: float = HOT_SHARE) -> KeyCounts:
    least = share * (found["rows"] - found["nulls"])
    heavy = {e["item"]: e["count"] for e in found["top"] or [] if e["item"] is not None and e["count"] >= least}
    return KeyCounts(found["rows"], found["nulls"], heavy)


def staged_with_counts(df: DataFrame, keys: list[str], label: str, share: float = HOT_SHARE) -> tuple[DataFrame, KeyCounts]:
    """The rows stored once, and their counts by key, taken while they were written: one run of the lineage of `df`."""
    seen = Observation()
    stored = staged(df.observe(seen, *key_count_columns(keys, share)), label)
    return stored, key_counts(seen.get, share)


def position(stored: DataFrame) -> Column:
    """A number for each row of a frame read from files, from its place there.

    It differs also between copies of a row and is the same when a lost task is run again.
    """
    place = stored.metadataColumn("_metadata")
    return F.xxhash64(place["file_path"], place["row_index"])


def lookup_join(
    fact: DataFrame,
    lookup: DataFrame,
    keys: list[str],
    how: str = "inner",
    broadcast_bytes: int = BROADCAST_BYTES,
    hot_share: float = HOT_SHARE,
    target_rows: int = TARGET_ROWS,
    lookup_bytes: int | None = None,
) -> DataFrame:
    """`fact` joined to `lookup` on equal `keys`, inner or left; all fact columns plus the lookup's others.

    The lookup side is measured, unless its size is given. Up to `broadcast_bytes` it is broadcast and the fact side is
    not shuffled. Beyond that the fact side is stored, which also counts its heavy keys, and both sides are shuffled on
    the keys and a salt: each heavy key is dealt over as many tasks as its count asks for, and only the lookup rows of
    such keys are repeated, once per task.
    """
    if how not in ("inner", "left"):
        raise ValueError("lookup_join supports inner and left joins")
    lookup_bytes = size_in_bytes(lookup) if lookup_bytes is None else lookup_bytes
    columns = [*fact.columns, *_others(lookup, keys)]
    fact, lookup, keys = _comparable(fact, lookup, keys)
    if lookup_bytes <= broadcast_bytes:
        joined = fact.join(F.broadcast(lookup), keys, how)
    else:
        stored, counts = staged_with_counts(fact, keys, "fact", hot_share)
        joined = salted_join(stored, lookup, keys, how, counts, target_rows, position(stored))
    return joined.select(*map(quoted, columns))


def _comparable(fact: DataFrame, lookup: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame, list[str]]:
    """Both sides with keys of one type. Where types differ, copies of the keys get the wider one, as in Spark's own
    comparison, and the fact side keeps its column beside the copy."""
    names = []
    for k in keys:
        left, right = fact.schema[k].dataType, lookup.schema[k].dataType
        if left == right:
            names.append(k)
            continue
        both = fact.select(quoted(k)).limit(0).union(lookup.select(quoted(k)).limit(0)).schema[0].dataType
        [name] = fresh(fact.join(lookup.limit(0), F.lit(False)), f"__{k}")
        fact, lookup = fact.withColumn(name, quoted(k).cast(both)), lookup.withColumn(name, quoted(k).cast(both)).drop(k)
        names.append(name)
    return fact, lookup, names


def salted_join(
    fact: DataFrame,
    lookup: DataFrame,
    keys: list[str],
    how: str,
    counts: KeyCounts,
    target_rows: int = TARGET_ROWS,
    spread: Column | None = None,
) -> DataFrame:
    """Shuffle join with the rows of heavy keys dealt over ceil(count / target_rows) tasks by the number `spread`.

    Rows with a null key, which find no partner, are dealt over as many as they need. The counts steer balance only; the
    result is exact for any of them.
    """
    if [fact.schema[k].dataType for k in keys] != [lookup.schema[k].dataType for k in keys]:
        raise ValueError("both sides must have the same key types, since their hashes are compared")
    spark = fact.sparkSession
    for_nulls = max(1, -(-counts.nulls // target_rows))
    heavy = counts.salts(target_rows)
    columns = [*fact.columns, *_others(lookup, keys)]
    if heavy or for_nulls > 1:
        salt, tasks, of = fresh(fact.select("*", *[F.lit(0).alias(c) for c in _others(lookup, keys)]), "__salt", "__tasks", "__hash")
        if spread is None:
            # The partition id spreads exact copies of a row, which hash alike.
            hashed = [quoted(c) for c, kind in fact.dtypes if "map<" not in kind and "variant" not in kind]
            spread = F.xxhash64(*hashed) + F.spark_partition_id()
        dealt = F.broadcast(spark.createDataFrame(list(heavy.items()), f"`{of}` long, `{tasks}` int"))
        wanted = F.when(_any_null(keys), F.lit(for_nulls)).otherwise(F.coalesce(quoted(tasks), F.lit(1)))
        fact = fact.select("*", spread.alias(salt)).join(dealt, _key_hash(keys) == quoted(of), "left")
        fact = fact.withColumn(salt, F.pmod(quoted(salt), wanted).cast("int")).drop(tasks, of)
        copies = F.sequence(F.lit(0), F.coalesce(quoted(tasks), F.lit(1)) - 1)
        lookup = lookup.join(dealt, _key_hash(keys) == quoted(of), "left")
        lookup = lookup.withColumn(salt, F.explode(copies)).drop(tasks, of)
        keys = [*keys, salt]
    # This plan is for lookups too large to broadcast, whatever Spark estimates.
    return fact.join(lookup.hint("merge"), keys, how).select(*map(quoted, columns))


def _others(lookup: DataFrame, keys: list[str]) -> list[str]:
    taken = {k.lower() for k in keys}
    return [c for c in lookup.columns if c.lower() not in taken]
