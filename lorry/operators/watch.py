"""What a report takes for granted, observed while it runs.

A lookup by an id that is taken to be unique multiplies rows where it is not,
and nothing in the result says so.  A :class:`Watch` counts, in the same pass
that computes the report, the rows behind such a join, those without a partner
and those whose partner is one of several, and rows of which a condition
holds; no table is scanned again.  The counts are there once the report has
been written.  All counts of a name are taken at one place of the plan, so
their shares are exact; where a sort below samples its ranges, Spark lets the
same rows pass that place twice and all of them count double.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F


class FanOut(RuntimeError):
    """A row met several rows of a table whose key should be unique."""


class Watch:
    def __init__(self):
        self._seen: dict[str, list[Observation]] = {}

    def _observe(self, df: DataFrame, name: str, **counts: Column) -> DataFrame:
        seen = self._seen.setdefault(name, [])
        own = Observation(f"{name} ({len(seen) + 1})")
        seen.append(own)
        return df.observe(own, *[c.alias(k) for k, c in counts.items()])

    def lookup(self, df: DataFrame, table: DataFrame, key: str, on: Column, name: str, how: str = "inner") -> DataFrame:
        """``df`` joined (``inner`` or ``left``) with a table whose column
        ``key`` should be unique; counts ``rows`` (behind the join),
        ``unmatched`` and ``doubled``.  How often a key stands in the table is
        counted on the table's side, by the partitioning that the join needs."""
        if how not in ("inner", "left"):
            raise ValueError(f"how must be 'inner' or 'left', not {how!r}")
        met = df.join(table.withColumn("_times", F.count(F.lit(1)).over(Window.partitionBy(key))), on, "left")
        met = self._observe(met, name, rows=F.count(F.lit(1)), unmatched=F.count_if(F.col("_times").isNull()),
                            doubled=F.count_if(F.col("_times") > 1))
        return (met.where("_times is not null") if how == "inner" else met).drop("_times")

    def count(self, df: DataFrame, name: str, condition: Column) -> DataFrame:
        """``df``; counts its ``rows`` and those for which the condition holds (``hits``)."""
        return self._observe(df, name, rows=F.count(F.lit(1)), hits=F.count_if(condition))

    def report(self) -> dict[str, dict[str, int]]:
        """The counts by name.  Waits for the first action on the watched
        report, so call it behind one."""
        return {name: {k: v for o in seen for k, v in o.get.items()} for name, seen in self._seen.items()}

    def check(self) -> dict[str, dict[str, int]]:
        """The report; raises :class:`FanOut` if a lookup multiplied rows."""
        found = self.report()
        wide = [f"{name}: {c['doubled']} of {c['rows']} rows" for name, c in found.items() if c.get("doubled")]
        if wide:
            raise FanOut("several partners: " + "; ".join(wide))
        return found


def look_up(watch: Watch | None, df: DataFrame, table: DataFrame, key: str, on: Column, name: str, how: str = "inner") -> DataFrame:
    """A plain join, or a watched one."""
    return df.join(table, on, how) if watch is None else watch.lookup(df, table, key, on, name, how)
