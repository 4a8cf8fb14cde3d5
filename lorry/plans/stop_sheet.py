"""The contract's stop rows as a table that is kept and brought up to date.

A full rebuild looks at every leg, however few have changed.  The table is
stored in buckets of legs, next to the trip that each leg was on.  A change
reaches stops along three ways: a leg's own rows; the legs of its trip, whose
carriers' first and last legs may move (of the trip it is on and of the one it
was on, and of legs whose freight rows name one of these); the legs that a
changed bill stops on.  Only the stops of these legs are built again, with the
lookups restricted to them, and only the buckets that hold them are replaced.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from lorry.operators.keys import Keys
from lorry.plans.contract import STOP_COLUMNS, stop_rows
from lorry.sources.tables import Tables, live

BUCKET = "_bucket"
#: rows of more columns are compared by hashes
LONG_ROW = 8


def changed_keys(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """``key`` of every row that one of two versions of a table has more often
    than the other: versions are counted together, equal rows cancel.  A long
    row is told by its key and two 64-bit hashes of all its columns, which also
    tell nulls by their place; only these move."""
    columns = new.columns
    if len(columns) <= LONG_ROW:
        both = new.withColumn("_sign", F.lit(1)).unionByName(old.select(*columns).withColumn("_sign", F.lit(-1)))
        return both.groupBy(*columns).agg(F.sum("_sign").alias("_n")).where("_n <> 0").select(key).distinct()
    told = [F.xxhash64(*(e for c in columns for e in (F.col(c).isNull(), F.col(c)))).alias("_h1"),
            F.xxhash64(F.lit(1), *(e for c in reversed(columns) for e in (F.col(c), F.col(c).isNull()))).alias("_h2")]
    both = new.select(key, *told, F.lit(1).alias("_sign")).unionAll(old.select(key, *told, F.lit(-1).alias("_sign")))
    return both.groupBy(key, "_h1", "_h2").agg(F.sum("_sign").alias("_n")).where("_n <> 0").select(key).distinct()


class StopSheet:
    """Stop rows under ``path``, for all legs of the tables last seen."""

    def __init__(self, t: Tables, path: str, buckets: int = 64):
        self.t, self.path, self.buckets = t, path.rstrip("/"), buckets

    def _bucketed(self, df: DataFrame, leg: str) -> DataFrame:
        return df.withColumn(BUCKET, F.pmod(F.xxhash64(leg), F.lit(self.buckets)).cast("int"))

    def _write(self, df: DataFrame, leg: str, name: str, whole: bool, watched: Callable[[DataFrame], DataFrame] = lambda df: df) -> None:
        (watched(self._bucketed(df, leg).hint("rebalance", BUCKET)).write.mode("overwrite").partitionBy(BUCKET)
         .option("partitionOverwriteMode", "static" if whole else "dynamic").parquet(f"{self.path}/{name}"))

    def _trips(self) -> DataFrame:
        return self.t.legsum.select("ls_leg_id", "ls_trip_number")

    def build(self) -> None:
        """Everything, from the tables."""
        for name, leg, df in (("stops", "leg_id", stop_rows(self.t)), ("trips", "ls_leg_id", self._trips())):
            self._bucketed(df, leg).limit(0).write.mode("overwrite").parquet(f"{self.path}/{name}-schema")
            self._write(df, leg, name, True)

    def _read(self, name: str) -> DataFrame:
        """A stored table; its schema is kept beside it, as all its buckets may be empty."""
        spark = self.t.spark
        schema = spark.read.parquet(f"{self.path}/{name}-schema").schema
        return spark.read.schema(schema).parquet(f"{self.path}/{name}")

    def rows(self) -> DataFrame:
        return self._read("stops").select(*STOP_COLUMNS)

    def affected(self, legs: DataFrame, bills: DataFrame | None = None) -> Keys:
        """The legs whose stops may differ once the rows of ``legs`` (a frame
        with ``ls_leg_id``) and of ``bills`` (with ``detail_line_id``) have changed."""
        t, own = self.t, Keys((legs, "ls_leg_id"), label="changed-legs")
        was = self._read("trips").drop(BUCKET)
        trips = Keys((own.restrict(self._trips(), "ls_leg_id"), "ls_trip_number"), (own.restrict(was, "ls_leg_id"), "ls_trip_number"),
                     label="changed-trips")
        reached = [(own.frame, "key"), (trips.restrict(self._trips(), "ls_trip_number"), "ls_leg_id"),
                   (trips.restrict(was, "ls_trip_number"), "ls_leg_id"), (trips.restrict(t.ilegdtl, "ild_trip_number"), "ild_leg_id")]
        if bills is not None:
            named = Keys((bills, "detail_line_id"), label="changed-bills")
            reached += [(named.restrict(t.legdtl, "ld_fb_id"), "ld_leg_id"), (named.restrict(t.ilegdtl, "ild_fb_id"), "ild_leg_id")]
        return Keys(*reached, label="affected-legs")

    def refresh(self, legs: DataFrame, bills: DataFrame | None = None) -> Keys:
        """Brings the table up to date after the rows of ``legs`` and ``bills``
        changed in the tables; the legs whose stops were built again."""
        again = self.affected(legs, bills)
        where = self._bucketed(again.frame, "key").select(BUCKET).distinct()
        self._replace("stops", "leg_id", stop_rows(self.t, again.frame.withColumnRenamed("key", "ls_leg_id")), again, where, STOP_COLUMNS)
        self._replace("trips", "ls_leg_id", again.restrict(self._trips(), "ls_leg_id"), again, where, ("ls_leg_id", "ls_trip_number"))
        return again

    def _replace(self, name: str, leg: str, new: DataFrame, again: Keys, where: DataFrame, columns: Sequence[str]) -> None:
        held = self._read(name)
        # the buckets are at most self.buckets rows: a proven bound
        kept = held.join(F.broadcast(where), BUCKET, "left_semi").join(again.frame.withColumnRenamed("key", leg), leg, "left_anti")
        # one job reads and replaces the buckets: files that a dynamic overwrite replaces go when its
        # tasks have all ended; which buckets got rows is counted while they are written
        seen = Observation()
        rows = kept.select(*columns).unionByName(new.select(*columns))
        marks = [F.bit_or(F.when(F.floor(F.col(BUCKET) / 63) == i, F.call_function("shiftleft", F.lit(1).cast("long"), F.col(BUCKET) % 63))).alias(f"_{i}")
                 for i in range(self.buckets // 63 + 1)]
        self._write(rows, leg, name, False, lambda df: df.observe(seen, *marks))
        got = {63 * i + k for i in range(len(marks)) for k in range(63) if (seen.get[f"_{i}"] or 0) >> k & 1}
        self._clear(name, [r[0] for r in where.collect() if r[0] not in got])  # at most self.buckets numbers

    def _clear(self, name: str, buckets: Sequence[int]) -> None:
        """Removes buckets in which no row is left: an overwrite touches only those that get rows."""
        jvm, conf = self.t.spark.sparkContext._jvm, self.t.spark.sparkContext._jsc.hadoopConfiguration()
        for b in buckets:
            p = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}/{BUCKET}={b}")
            p.getFileSystem(conf).delete(p, True)


class Earlier:
    """Tables of which some are given in an earlier version."""

    def __init__(self, t: Tables, **frames: DataFrame):
        self._t, self._frames = t, frames
        self.spark = t.spark

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self._frames[name] if name in self._frames else getattr(self._t, name)


def stops_after_changes(t: Tables, path: str) -> DataFrame:
    """The stop rows of today's tables, reached from those of an earlier day:
    some legs then were on another trip, had another carrier or did not exist,
    some stop details were missing and some bills had other names."""
    leg = F.col("ls_leg_id")
    legsum = (t.legsum.where(leg % 97 != 3)
              .withColumn("ls_trip_number", F.when(leg % 89 == 1, F.col("ls_trip_number") + 1).otherwise(F.col("ls_trip_number")))
              .withColumn("ls_interliner", F.when(leg % 83 == 2, F.lit(None)).otherwise(F.col("ls_interliner"))))
    legdtl = t.legdtl.where(F.col("ld_leg_id") % 101 != 7)
    today = live(t, "tlorder")
    tlorder = today.withColumn("origname", F.when(F.col("detail_line_id") % 103 == 5, F.lit("FORMER NAME")).otherwise(F.col("origname")))
    StopSheet(Earlier(t, legsum=legsum, legdtl=legdtl, tlorder=tlorder), path).build()
    legs = (changed_keys(legsum, t.legsum, "ls_leg_id")
            .union(changed_keys(legdtl.select("ld_leg_id", "ld_pd", "ld_pd_order", "ld_fb_id", "ld_type"),
                                t.legdtl.select("ld_leg_id", "ld_pd", "ld_pd_order", "ld_fb_id", "ld_type"), "ld_leg_id")))
    bills = changed_keys(*(x.select("detail_line_id", "origname", "destname", "start_zone", "end_zone") for x in (tlorder, today)), "detail_line_id")
    sheet = StopSheet(t, path)
    sheet.refresh(legs, bills)
    return sheet.rows()
