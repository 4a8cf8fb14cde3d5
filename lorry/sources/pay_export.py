"""The driver-pay export (S11) and reading such exports back.

Layout of the report file: a blank row, a header row (with a trailing empty
field), then per pay type a section-title row followed by one row per driver
and pay date.  Money is written with thousands separators (quoted because
of the comma), the net with a dollar sign, dates as ``MMM d, yyyy``.

Writing: rows are range-partitioned and sorted by (pay type, driver, date);
every range starts with its own blank row, header and section title, so each
file can be read on its own.  A row learns from its predecessor in the range
whether it opens a section and then stands for the layout rows before it as
well.  What the layout has no room for is written as a mark: ``(none)`` as
the title of rows without a pay type (a pay type of that form gets a further
pair of brackets), ``n/a`` for a missing date or amount, so a row of figures
never looks like a title.

Reading is a segmented prefix scan over byte ranges.  Spark's text reader
cuts a plain file into ranges at line ends, wherever quotes open or titles
stand.  Every range reports what it does to the state that enters it: to the
quote state (open or not, see :func:`quote_effect`), to a record that enters
it unfinished, and to the section title.  These reports, one row a range, are
combined along the file; then each range completes its own lines from what
enters it.  A compressed file is one range.  All of it is built from column
functions; no row is dropped but blank, header and title rows; a date or an
amount that cannot be read is NULL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# The export's header row.
HEADER = ("driver ", "pay date", "subsistance", "hours", "overtime", "other", "Net", None)
FIELDS = [f"c{i}" for i in range(8)]
LINE_SCHEMA = ", ".join(f"{c} string" for c in FIELDS)
MONEY = "decimal(18,2)"
MEASURES = ("subsistance", "hours", "overtime", "other", "net")
# marks of this library for what is missing
NO_TYPE, MISSING = "(none)", "n/a"
#: what counts as blank around a cell
BLANKS = " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85 "


def _money(c: str) -> Column:
    return F.coalesce(F.format_number(F.col(c), 2), F.lit(MISSING))


def _dollars(c: str) -> Column:
    v = F.col(c)
    text = F.when(v < 0, F.concat(F.lit("-$"), F.format_number(-v, 2))).otherwise(F.concat(F.lit("$"), F.format_number(v, 2)))
    return F.coalesce(text, F.lit(MISSING))


def _title(pay_type: Column) -> Column:
    return F.when(pay_type.isNull(), NO_TYPE).when(pay_type.rlike(r"^\(+none\)+$"), F.concat(F.lit("("), pay_type, F.lit(")"))).otherwise(pay_type)


def _pay_type(title: Column) -> Column:
    bracketed = title.rlike(r"^\(\(+none\)+\)$")
    return F.when(title == NO_TYPE, None).when(bracketed, title.substr(F.lit(2), F.length(title) - 2)).otherwise(title)


def export_pay_report(summary: DataFrame, path: str, partitions: int | None = None) -> None:
    """Write a pay summary (R12b columns) as report-layout CSV files."""
    keys = [F.col("pay_type").asc_nulls_last(), F.col("driver").asc_nulls_last(), F.col("pay_date").asc_nulls_last()]
    # AQE sizes the ranges unless a count is asked for
    ranged = summary.repartitionByRange(partitions, *keys) if partitions else summary.repartitionByRange(*keys)
    rows = (
        ranged
        .sortWithinPartitions(*keys)
        .select(
            F.spark_partition_id().alias("range"), F.monotonically_increasing_id().alias("place"), _title(F.col("pay_type")).alias("title"),
            F.col("driver").alias("c0"),
            F.coalesce(F.date_format("pay_date", "MMM d, yyyy"), F.lit(MISSING)).alias("c1"),
            _money("subsistance").alias("c2"), _money("hours").alias("c3"), _money("overtime").alias("c4"),
            _money("other").alias("c5"), _dollars("net").alias("c6"), F.lit(None).cast("string").alias("c7"),
        )
    )

    def line(*cells) -> Column:
        given = [c if isinstance(c, Column) else F.lit(c) for c in cells]
        given += [F.lit(None)] * (len(FIELDS) - len(given))
        return F.struct(*[g.cast("string").alias(c) for g, c in zip(given, FIELDS, strict=True)])

    one_range = Window.partitionBy("range").orderBy("place")  # as many rows as the range, which is one file's worth
    none = F.array().cast(f"array<struct<{', '.join(f'{c}:string' for c in FIELDS)}>>")
    opens = F.lag("place").over(one_range).isNull()
    new_title = opens | (F.lag("title").over(one_range) != F.col("title"))
    closes = F.lead("place").over(one_range).isNull()
    told = rows.select("*", opens.alias("opens"), new_title.alias("new_title"), closes.alias("closes"))
    lines = F.concat(
        F.when(F.col("opens"), F.array(line(), line(*HEADER))).otherwise(none),
        F.when(F.col("new_title"), F.array(line(F.col("title")))).otherwise(none),
        F.array(line(*[F.col(c) for c in FIELDS])),
        F.when(F.col("closes"), F.array(line())).otherwise(none),
    )
    # a file is never cut in two: its second half would have no title
    (told.select(F.inline(lines)).write.mode("errorifexists").option("header", False).option("emptyValue", "").option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
        .option("maxRecordsPerFile", 0).option("compression", "gzip").csv(path))


# Reading ----------------------------------------------------------------------

# a quoted field's inside (doubled quotes stay inside), and a whole quoted field with what follows it
_INSIDE = r'[^"]*+(?:""[^"]*+)*+'
_QUOTED = rf'(?<=^|,)"{_INSIDE}"[^,]*+'


def quote_effect(line: Column) -> tuple[Column, Column]:
    """What a line does to the quote state: whether a quoted field is open
    behind it if none was open before it, and if one was.

    A quote opens a field at its start only and closes it unless doubled, so
    a stray quote inside a field changes nothing and does not carry on.
    """
    opened = F.regexp_replace(line, _QUOTED, "").rlike(r'(?:^|,)"')
    after = F.regexp_replace(line, rf'^{_INSIDE}"[^,]*+', "")
    still = ~line.rlike(rf'^{_INSIDE}"')
    return opened, still | F.regexp_replace(after, _QUOTED, "").rlike(r',"')


def _ranges(spark: SparkSession, path: str) -> DataFrame:
    """``file, start, place, line``: lines in their byte ranges, in order."""
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("place"), F.col("value").alias("line"))


def records(spark: SparkSession, path: str) -> DataFrame:
    """``file, start, place, record``: the CSV records of the files at
    ``path``, each in the byte range that it begins in.

    Line breaks inside quotes are kept as they are; a carriage return at the
    end of a record goes with its line break.
    """
    block = Window.partitionBy("file", "start")
    so_far = block.orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    opened, still = quote_effect(F.col("line"))
    lines = _ranges(spark, path).withColumns({"opened": opened, "still": still})
    # a line sets the state (alike for both states before it), leaves it, or turns it around
    turns = F.sum(F.when(F.col("opened") & ~F.col("still"), 1).otherwise(0)).over(so_far)
    lines = lines.withColumn("turns", turns)
    sets = F.last(F.when(F.col("opened") == F.col("still"), F.struct(F.col("opened").cast("int").alias("state"), "turns")), ignorenulls=True).over(so_far)
    lines = lines.withColumn("sets", sets)

    def after(entering: Column) -> Column:
        """The state behind a line, given the state that enters its range."""
        return F.pmod(F.coalesce(F.col("sets.state"), entering) + F.col("turns") - F.coalesce(F.col("sets.turns"), F.lit(0)), F.lit(2))

    # one row a range from here: what it does to either state
    along = Window.partitionBy("file").orderBy("start")
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    reports = lines.groupBy("file", "start").agg(F.max_by(F.struct("sets", "turns"), "place").alias("last")).select("file", "start", "last.*")
    fixed = F.last(F.when(F.col("sets").isNotNull(), F.struct(after(F.lit(0)).alias("state"), F.col("all").alias("turns"))), ignorenulls=True).over(before)
    reports = (reports.withColumn("all", F.coalesce(F.sum("turns").over(along.rowsBetween(Window.unboundedPreceding, Window.currentRow)), F.lit(0)))
               .withColumn("fixed", fixed)
               .withColumn("entering", F.pmod(F.coalesce(F.col("fixed.state"), F.lit(0)) + F.coalesce(F.lag("all").over(along), F.lit(0))
                                              - F.coalesce(F.col("fixed.turns"), F.lit(0)), F.lit(2)).cast("int"))
               .select("file", "start", "entering"))
    lines = lines.join(reports, ["file", "start"]).withColumn("behind", after(F.col("entering")))
    ordered = block.orderBy("place")
    begins = F.coalesce(F.lag("behind").over(ordered), F.col("entering")) == 0
    lines = lines.withColumn("begins", begins)
    lines = lines.withColumn("nth", F.sum(F.col("begins").cast("long")).over(so_far))
    # a record's lines in its range; what a range holds of a record that enters it unfinished has nth 0
    whole = Window.partitionBy("file", "start", "nth").orderBy("place").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    text = F.when(F.count("*").over(Window.partitionBy("file", "start", "nth")) > 1, F.array_join(F.collect_list("line").over(whole), "\n")).otherwise(F.col("line"))
    first = F.row_number().over(Window.partitionBy("file", "start", "nth").orderBy("place")) == 1
    pieces = lines.select("file", "start", "place", "nth", text.alias("record"), first.alias("first")).where("first").drop("first")
    # heads go to the last record that begins before their range: few and short rows
    ends = pieces.groupBy("file", "start").agg(F.max("nth").alias("records"), F.min(F.when(F.col("nth") == 0, F.col("record"))).alias("head"))
    owner = F.max(F.when(F.col("records") > 0, F.col("start"))).over(before)
    tails = (ends.withColumn("owner", owner).where("head is not null and owner is not null")
             .groupBy("file", F.col("owner").alias("start"))
             .agg(F.concat_ws("\n", F.transform(F.array_sort(F.collect_list(F.struct(F.col("start").alias("at"), "head"))), lambda x: x["head"])).alias("tail")))
    last_of = ends.join(tails, ["file", "start"]).select("file", "start", F.col("records").alias("nth"), "tail")
    done = pieces.where("nth > 0").join(last_of, ["file", "start", "nth"], "left")
    record = F.concat_ws("\n", "record", "tail")  # a missing tail adds nothing
    record = F.when(F.col("start") == 0, F.regexp_replace(record, "^﻿", "")).otherwise(record)
    return done.select("file", "start", "place", F.regexp_replace(record, r"\r$", "").alias("record"))


def read_pay_export(spark: SparkSession, path: str) -> DataFrame:
    """The rows of pay-report files with their section as ``pay_type``.

    Blank, header and title rows are dropped; money and dates are parsed
    (values that cannot be parsed become NULL, their rows stay).  A title
    holds until the next one or the end of its file.
    """
    options = {"escape": '"', "multiLine": "true", "lineSep": "\n"}
    cells = records(spark, path).select("file", "start", "place", F.from_csv("record", LINE_SCHEMA, options).alias("r"))
    cells = cells.select("file", "start", "place", *[F.coalesce(F.btrim(F.col(f"r.{c}"), F.lit(BLANKS)), F.lit("")).alias(c) for c in FIELDS])
    header = F.lit(True)
    for c, h in zip(FIELDS[:7], HEADER, strict=False):
        header = header & (F.col(c) == h.strip())
    rest = F.concat(*FIELDS[1:])
    is_title = (F.col("c0") != "") & (rest == "")
    cells = cells.where((F.concat("c0", rest) != "") & ~header).withColumn("title", F.when(is_title, F.col("c0")))
    block = Window.partitionBy("file", "start").orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cells = cells.withColumn("own", F.last("title", ignorenulls=True).over(block))
    # the title that enters a range: the last one of an earlier range of its file
    entering = F.last("last", ignorenulls=True).over(Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1))
    carry = (cells.groupBy("file", "start").agg(F.max_by("own", "place").alias("last"))
             .withColumn("entering", entering).select("file", "start", "entering"))
    data = cells.where("title is null").join(carry, ["file", "start"])

    def text(c: str) -> Column:
        return F.nullif(F.col(c), F.lit(""))

    def money(c: str) -> Column:
        return F.regexp_replace(text(c), "[$,]", "").try_cast(MONEY)

    return data.select(
        _pay_type(F.coalesce("own", "entering")).alias("pay_type"), text("c0").alias("driver"),
        F.try_to_date(text("c1"), "MMM d, yyyy").alias("pay_date"),
        *[money(c).alias(m) for c, m in zip(FIELDS[2:7], MEASURES, strict=True)],
    )
