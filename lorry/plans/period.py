"""Report-period parameters (R15) and the invoiced cut-off report."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lorry.functions.columns import text_key
from lorry.functions.dates import first_day_last_month, last_day_last_month, parse_date, run_note, us_date_text
from lorry.sources.tables import Tables


def period_bounds(spark: SparkSession, as_of=None) -> DataFrame:
    """The 'Detail' view level and the previous calendar month, as dates
    and as the report tool's ``MM/dd/yyyy`` parameters (one row)."""
    first, last = first_day_last_month(as_of), last_day_last_month(as_of)
    return spark.range(1).select(
        F.lit("Detail").alias("detail"),
        first.alias("first_day_last_month"),
        last.alias("last_day_last_month"),
        us_date_text(first).alias("date_begin"),
        us_date_text(last).alias("date_end"),
    )


def report_run_note(spark: SparkSession, ts=None) -> DataFrame:
    """The run stamp line (one row)."""
    return spark.range(1).select(run_note(ts).alias("report_run_note"))


def invoiced_cutoff(t: Tables, delivered_before, invoiced_from, invoiced_to) -> DataFrame:
    """R17 (minimal reading of a prose note): billed bills delivered before
    ``delivered_before`` and invoiced between ``invoiced_from`` and
    ``invoiced_to`` (inclusive)."""
    b = t.tlorder.filter(
        (F.col("current_status") == "BILLED")
        & (F.col("actual_delivery") < F.lit(parse_date(delivered_before)))
        & F.col("bill_date").between(F.lit(parse_date(invoiced_from)), F.lit(parse_date(invoiced_to)))
    )
    return b.select("bill_number", "actual_delivery", "bill_date", "total_charges").orderBy(text_key("bill_number"))
