"""Passing keys sideways: what a report asks for restricts its lookups.

A lookup that is aggregated per key and then joined does the work for every
key of its table, however few the report needs.  :class:`Keys` holds the keys
that a report needs, written once; :meth:`Keys.restrict` puts them below the
aggregate: first as bounds (two values, whatever the number of keys), which
reach the scan and skip row groups of tables that are clustered by the key,
then as an exact semi join, whose side of keys adaptive execution broadcasts
if it measures it to be small and shuffles otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lorry.session import stage


class Keys:
    """The distinct non-null values of a column, or several unions of them."""

    def __init__(self, *columns: tuple[DataFrame, str], label: str = "keys"):
        frames = [df.select(F.col(c).alias("key")) for df, c in columns]
        union = frames[0]
        for f in frames[1:]:
            union = union.union(f)
        self.frame = stage(union.where("key is not null").distinct(), label)
        bounds = self.frame.agg(F.min("key").alias("lo"), F.max("key").alias("hi"), F.count("key").alias("keys")).first()
        self.count = bounds["keys"]
        self.bounds = None if bounds["lo"] is None else (bounds["lo"], bounds["hi"])

    def restrict(self, table: DataFrame, column: str) -> DataFrame:
        """The rows of ``table`` whose ``column`` is one of the keys."""
        if self.bounds is None:
            return table.where(F.lit(False))
        kept = table.where(F.col(column).between(*map(F.lit, self.bounds)))
        return kept.join(self.frame.withColumnRenamed("key", column), column, "left_semi").select(*table.columns)

    def texts(self, label: str = "text-keys") -> Keys:
        """The same keys as text, for tables that hold them so."""
        return Keys((self.frame.select(F.col("key").cast("string")), "key"), label=label)


def restricted(table: DataFrame, column: str, keys: Keys | None) -> DataFrame:
    """``table`` for a report of everything (no keys), or its rows with one of the keys."""
    return table if keys is None else keys.restrict(table, column)
