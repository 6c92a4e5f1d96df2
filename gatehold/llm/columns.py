"""Columns that the operators add to a caller's frame, under names that cannot clash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# White space that ends a word, as a class inside a regular expression and as characters.
SPACE = r"\x20\x09-\x0D"
SPACE_CHARS = " \t\n\x0b\x0c\r"


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


def documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id as long and the text, under their usual names; other columns are pruned from the scan."""
    return df.select(quoted(id_col).cast("long").alias("doc_id"), quoted(text_col).cast("string").alias("text"))


def extended(schema: StructType, *fields: tuple[str, str]) -> StructType:
    """A new schema with more fields (name, type); `StructType.add` would change the frame's own."""
    new = StructType.fromDDL(", ".join(f"`{name}` {kind}" for name, kind in fields))
    return StructType([*schema.fields, *new.fields])
