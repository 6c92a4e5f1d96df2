"""Connected components by rounds of joins."""

from __future__ import annotations

import itertools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gatehold.llm.storage import Rounds

_EDGES = ("u", "v")


def components(links: DataFrame, into: Rounds, label: str) -> DataFrame:
    """(node, component) for links (u, v) of long ids: the least id reachable, for every id in a link.

    Each round ties all neighbours of a node to the least of them, first those above it and then those below; paths
    shrink by a factor each time, and the number of links never grows. Sums inside the tasks come first, so a node with
    many links is not gathered. Acts at once: each round is stored, and the result, which is all that stays, as `label`.
    No links give no rows; loops and repeats are fine.
    """
    rounds = Rounds(links.sparkSession)
    known = links.select(
        F.greatest(*_EDGES).cast("long").alias("u"), F.least(*_EDGES).cast("long").alias("v")
    ).dropna()
    known = rounds.store(known.distinct(), "links-0")
    nodes = known.select(F.explode(F.array("u", "v")).alias("node")).distinct()
    nodes = rounds.store(nodes, "nodes")
    known = known.filter("u != v")
    before = None
    for n in itertools.count(1):
        after = tuple(known.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64(*_EDGES))).first())
        if after == before or not after[0]:
            break
        before = after
        both = known.union(known.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        least = rounds.store(least, "least")
        above = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        above = rounds.store(above, "above")
        rounds.drop("least")
        least = rounds.store(above.groupBy("u").agg(F.min("v").alias("m")), "least")
        below = above.join(least, "u").select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
        known = rounds.store(below.filter("u != v").distinct(), f"links-{n}")
        rounds.drop("least", "above", f"links-{n - 1}")
    # Now each node has one link, to the least of its component.
    found = nodes.join(known.withColumnRenamed("u", "node"), "node", "left")
    found = into.store(found.select("node", F.coalesce("v", "node").alias("component")), label)
    del nodes, known
    rounds.clear()
    return found
