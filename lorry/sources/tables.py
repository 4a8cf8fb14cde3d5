"""Table accessor: one DataFrame per input table, built once per session.

Reports take a :class:`Tables` and read the freight tables by name
(``t.tlorder``, ``t["legsum"]``, ``t["ops.legsum"]``).  :class:`SourceTables`
reads real tables: paths, frames, or a catalog.  :class:`Tables` itself reads
the fixture views over the driver's parquet files (see :mod:`fixture_sql`).

The fixture views that group rows, and the two that reports filter at the scan,
are *prepared once*: each is written as a parquet table in
the shared folder named by ``spark.checkpoint.dir`` (keyed by the view's SQL
text and the size and time of every input file, asked of the file system that
holds it) and then read back like any stored table,
so reports scan columnar files with pushed-down filters instead of
re-deriving their inputs from the raw tables on every run.  Views that only
rename and compute columns of a table's rows (:data:`LIVE`) are not copied:
a report reads the few raw columns behind those it uses.  Pass
``prepared=False`` to read all views as live queries instead.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import weakref
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from lorry.session import ensure_checkpoint_dir, smaller_partitions
from lorry.sources.fixture_sql import BASE_TABLES, FIXTURES, closure, dependencies

#: accessors by session, which they end with
_CACHE: weakref.WeakKeyDictionary[SparkSession, dict[tuple, Tables]] = weakref.WeakKeyDictionary()
# bump when the way tables are prepared changes (part of the prepared-table key)
PREPARE_VERSION = "5"
#: prepared tables that are stored by the month of a date column (:meth:`Tables.period`)
BY_MONTH = {"tlorder": "actual_delivery"}
#: raw table and date column by which such a table's rows are brought together before its view widens them
MONTH_SOURCE = {"tlorder": ("orders", "o_orderdate")}
#: a row of such a table is about so many times as long as its raw row
WIDENED = 8
#: views that compute columns row by row: read from the raw tables, never stored
LIVE = frozenset({
    "client", "trace", "order_interliner_userfields", "vendor", "ip_gl", "ap_bill", "ap_bill_exp", "tldtl",
    "driverdeductions", "odrstat", "tlorder_splits", "notes", "tlorder_customs", "tlshipinstruct", "rpt_gross_margin",
})
#: the partition column of tables stored by month
MONTH = "_month"
#: of views that group ``lineitem``, the columns that a report may ask them dealt out by, as they come from a raw
#: row: raw rows then move once, by that column, and neither the grouping nor a join on the column moves them again
DEALT = {
    ("legsum", "ls_leg_id"): "l_orderkey * 10 + l_linenumber",
    ("legsum", "ls_trip_number"): "l_orderkey - l_orderkey % 3",
    ("ilegdtl", "ild_leg_id"): "l_orderkey * 10 + l_linenumber",
    ("legdtl", "ld_leg_id"): "l_orderkey * 10 + l_linenumber",
    ("order_interliner", "detail_line_id"): "l_orderkey",
}
#: views with a row for each two keys of ``lineitem``, and what of a raw row their grouping can be dealt out by
GROUPED = {"legsum": ("l_orderkey", "l_linenumber"), "order_interliner": ("l_orderkey", "l_linenumber"),
           "ilegdtl": ("l_orderkey * 10 + l_linenumber",), "legdtl": ("l_orderkey * 10 + l_linenumber",)}
#: views of grouped views: what they read has to be dealt out by
DEALT_BELOW = {("trip", "trip_number"): ("legsum", "ls_trip_number")}
#: a period of more days is read from the raw tables, if the months are not stored yet
LONG_PERIOD = 366


def rtrim_strings(df: DataFrame) -> DataFrame:
    """Right-trim every text column on load: the source database ignores
    trailing blanks in comparisons (padded CHAR columns), Spark does not."""
    cols = [F.rtrim(F.col(f.name)).alias(f.name) if isinstance(f.dataType, StringType) and f.name != MONTH else F.col(f.name)
            for f in df.schema.fields]
    return df.select(*cols)


def by_month(df: DataFrame, column: str) -> DataFrame:
    """``df`` with its partition column, rows of a month together: the files of
    a month are as many as its size asks for."""
    return df.withColumn(MONTH, F.date_format(column, "yyyy-MM")).hint("rebalance", MONTH)


class Tables:
    """The fixture tables of a data directory."""

    def __init__(self, spark: SparkSession, sf_dir: str, prepared: bool = True):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self.prepared = prepared
        self._frames: dict[str, DataFrame] = {}
        self._signature = file_signature(spark, [f"{self.sf_dir}/{base}.parquet" for base in BASE_TABLES])

    @classmethod
    def at(cls, spark: SparkSession, sf_dir: str, prepared: bool = True) -> Tables:
        """The session's accessor for a directory; files that have changed since get a new one."""
        own = _CACHE.setdefault(spark, {})
        new = cls(spark, sf_dir, prepared)
        return own.setdefault((new.sf_dir, prepared, new._signature), new)

    def __getitem__(self, name: str) -> DataFrame:
        # the fixtures are one schema: a qualifier (``OPS.LEGSUM``) is not needed
        name = name.lower().rsplit(".", 1)[-1]
        if name not in self._frames:
            self._frames[name] = self._build(name)
        return self._frames[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self[name]

    def _view(self, name: str) -> DataFrame:
        deps = {d: self[d] for d in dependencies(name)}
        if name in GROUPED:
            # raw rows are narrower than half-made groups, of which there are as many
            deps["lineitem"] = deps["lineitem"].repartition(*map(F.expr, GROUPED[name]))
        return rtrim_strings(self.spark.sql(FIXTURES[name], **deps))

    def live(self, name: str, by: str | None = None) -> DataFrame:
        """A view read from the raw tables even if it is one that is stored: for
        a report that reads it once and few of its columns or rows, where
        storing it would move and write them all.  With ``by`` its rows come
        dealt out by that column, if the view can be (:data:`DEALT`), as those
        of a table that is stored in buckets of it."""
        if name not in FIXTURES:
            return self[name]
        if (name, by) in DEALT_BELOW:
            below, column = DEALT_BELOW[name, by]
            return rtrim_strings(self.spark.sql(FIXTURES[name], **{below: self.live(below, column)}))
        if (name, by) not in DEALT:
            return self._view(name)
        # the same groups: what is added to them follows from their keys
        key = DEALT[name, by]
        grouped = FIXTURES[name].replace("group by ", f"group by {key}, ")
        return rtrim_strings(self.spark.sql(grouped, lineitem=self["lineitem"].repartition(F.expr(key))))

    def period(self, name: str, column: str, begin: dt.date, end: dt.date) -> DataFrame:
        """The rows of a table whose date ``column`` lies from ``begin`` to
        ``end`` (both included).  Of a table that is stored by the month of
        that column, other months' files are not opened; else the half-open
        timestamp range prunes row groups.  A long period that is most of a
        table does not store it by month first."""
        long = (end - begin).days > LONG_PERIOD and isinstance(self, Tables) and not self._written(name)
        stored = None if long else self._stored(name, column)
        table = live(self, name) if long else self[name] if stored is None else stored
        if stored is not None:
            table = table.where(F.col(MONTH).between(f"{begin:%Y-%m}", f"{end:%Y-%m}"))
        column = F.col(column)
        return table.where((column >= F.lit(begin)) & (column < F.lit(end + dt.timedelta(days=1)))).drop(MONTH)

    def _written(self, name: str) -> bool:
        """Whether a view is stored already."""
        return self.prepared and self._complete(self._prepared_path(name))

    def _stored(self, name: str, column: str) -> DataFrame | None:
        """The table with its partition column, if it is stored by the month of ``column``."""
        if not self.prepared or BY_MONTH.get(name) != column:
            return None
        self[name]  # written, if it is not yet
        return self.spark.read.parquet(self._prepared_path(name))

    def _build(self, name: str) -> DataFrame:
        if name in BASE_TABLES:
            return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        if name not in FIXTURES:
            raise KeyError(f"unknown table {name!r}")
        if not self.prepared or name in LIVE:
            return self._view(name)
        path = self._prepared_path(name)
        if not self._complete(path):
            if name in BY_MONTH:
                self._write_by_month(name, path)
            else:
                self._view(name).write.mode("overwrite").option("compression", "zstd").parquet(path)
        return self.spark.read.parquet(path).drop(MONTH)

    def _write_by_month(self, name: str, path: str) -> None:
        """Stores a table by month.  The raw rows are moved, not the wide ones;
        as they widen behind the shuffle, its partitions are made smaller by that much."""
        raw, date = MONTH_SOURCE[name]
        rows = by_month(self[raw], date)
        df = rtrim_strings(self.spark.sql(FIXTURES[name], **{raw: rows}))
        df = df.withColumn(MONTH, F.date_format(BY_MONTH[name], "yyyy-MM"))
        with smaller_partitions(self.spark, WIDENED):
            df.write.mode("overwrite").option("compression", "zstd").partitionBy(MONTH).parquet(path)

    def _prepared_path(self, name: str) -> str:
        h = hashlib.sha1()
        h.update(PREPARE_VERSION.encode())
        h.update(self.sf_dir.encode())
        for n in closure([name]):
            h.update(FIXTURES[n].encode())
        h.update(self._signature.encode())
        root = ensure_checkpoint_dir(self.spark).rstrip("/")
        return f"{root}/lorry-tables/{h.hexdigest()[:16]}/{name}"

    def _complete(self, path: str) -> bool:
        jvm = self.spark.sparkContext._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        p = jvm.org.apache.hadoop.fs.Path(path + "/_SUCCESS")
        return p.getFileSystem(conf).exists(p)


def live(t: Tables, name: str, by: str | None = None) -> DataFrame:
    """:meth:`Tables.live`, of any accessor: the table itself where there are no views."""
    return t.live(name, by) if isinstance(t, Tables) else getattr(t, name)


def file_signature(spark: SparkSession, paths: list[str]) -> str:
    """Names, sizes and times of the files under ``paths``, as their own file
    systems tell them (any Hadoop file system)."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    h = hashlib.sha1()
    for path in paths:
        p = jvm.org.apache.hadoop.fs.Path(path)
        fs = p.getFileSystem(conf)
        if not fs.exists(p):
            continue
        files = fs.listFiles(p, True)
        found = []
        while files.hasNext():
            f = files.next()
            found.append(f"{f.getPath()}:{f.getLen()}:{f.getModificationTime()}")
        h.update("\n".join([path, *sorted(found)]).encode())
    return h.hexdigest()


class SourceTables(Tables):
    """Real tables by name.

    ``sources`` maps names to DataFrames, paths (parquet) or catalog table
    names; a name may carry a schema (``"a.zone"``), and two schemas may hold
    tables of one name.  With ``catalog=True`` a name that is not mapped is
    looked up in the session's catalog.  An unqualified name means the table
    of ``schema``, or else the only table of that name; an ambiguous or
    unknown name is a ``KeyError``.  Text columns are right-trimmed.
    ``by_month`` names tables stored with a partition column ``_month``
    (``yyyy-MM`` of the date column given, see :func:`by_month`).
    """

    def __init__(self, spark: SparkSession, sources: Mapping[str, DataFrame | str] | None = None, schema: str | None = None,
                 catalog: bool = False, by_month: Mapping[str, str] | None = None):
        self.spark = spark
        self.schema = schema.lower() if schema else None
        self.catalog = catalog
        self._by_month = {k.lower(): v for k, v in (by_month or {}).items()}
        self._sources = {k.lower(): v for k, v in (sources or {}).items()}
        self._frames = {}

    def __getitem__(self, name: str) -> DataFrame:
        name = name.lower()
        if name not in self._frames:
            self._frames[name] = rtrim_strings(self._find(name))
        return self._frames[name].drop(MONTH) if name in self._by_month else self._frames[name]

    def live(self, name: str, by: str | None = None) -> DataFrame:
        return self[name]

    def _written(self, name: str) -> bool:
        return True

    def _stored(self, name: str, column: str) -> DataFrame | None:
        name = name.lower()
        if self._by_month.get(name) != column:
            return None
        self[name]
        return self._frames[name]

    def _find(self, name: str) -> DataFrame:
        wanted = [name] if "." in name or not self.schema else [f"{self.schema}.{name}", name]
        for key in wanted:
            if key in self._sources:
                return self._open(self._sources[key])
        if self.catalog:
            for key in wanted:
                if self.spark.catalog.tableExists(key):
                    return self.spark.table(key)
        alike = [k for k in self._sources if "." not in name and k.rsplit(".", 1)[-1] == name]
        if len(alike) == 1:
            return self._open(self._sources[alike[0]])
        raise KeyError(f"table {name!r} is in several schemas: {', '.join(sorted(alike))}" if alike else f"unknown table {name!r}")

    def _open(self, source: DataFrame | str) -> DataFrame:
        if isinstance(source, DataFrame):
            return source
        if "/" in source:
            return self.spark.read.parquet(source)
        return self.spark.table(source)
