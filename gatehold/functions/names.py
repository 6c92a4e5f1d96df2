"""Names for columns that an operator adds to a caller's frame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fresh(df: DataFrame, *names: str) -> list[str]:
    """`names`, each with underscores added until no column of `df` is called so, whatever the case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def quoted(name: str) -> Column:
    """A top-level column, also when its name holds dots."""
    return F.col("`" + name.replace("`", "``") + "`")
