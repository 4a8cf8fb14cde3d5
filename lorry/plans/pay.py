"""Driver pay (R12, R12b), pay dates (R16) and the pay reallocation note."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

import uuid

from lorry.functions.columns import text_key
from lorry.functions.dates import parse_date
from lorry.operators.reconcile import reconcile
from lorry.session import ensure_checkpoint_dir
from lorry.sources.pay_export import export_pay_report, read_pay_export
from lorry.sources.tables import Tables

MONEY = "decimal(18,2)"
MEASURES = ("subsistance", "hours", "overtime", "other", "net")


def _statements(t: Tables, statement_date, negatives: str) -> DataFrame:
    """Driver statements passing the check-amount rule.

    ``negatives='carry'`` keeps positive checks only (a negative balance is
    carried to the next pay); ``'show'`` keeps every non-zero check.  Both
    union branches get the statement-date filter (the "show" source loses it
    on the second branch to a stray ';', treated as a typo).
    """
    if negatives not in ("carry", "show"):
        raise ValueError(f"negatives must be 'carry' or 'show', not {negatives!r}")
    s = t.dr_stmt_report
    s = s.filter(F.col("check_amt") > 0) if negatives == "carry" else s.filter(F.col("check_amt") != 0)
    s = s.withColumn("pay_date", F.to_date("statement_date"))
    if statement_date is not None:
        s = s.filter(F.col("pay_date") == F.lit(parse_date(statement_date)))
    return s.select("statement_id", "pay_type", "pay_date")


def driver_pay(t: Tables, statement_date=None, negatives: str = "carry") -> DataFrame:
    """Pay lines and deductions of the statements, one row per line.

    ``statement_date=None`` reports every statement date at once.
    """
    s = _statements(t, statement_date, negatives)
    d = t.driver.select("driver_id", "name")
    rule = t.drv_rule_mile.select("rule_id", "user1")
    subs = F.coalesce(F.col("user1"), F.lit("")) == "SUBSISTANCE"
    overtime = F.coalesce(F.col("pay_code"), F.lit("")).isin("HOUR OVER")
    amt = F.col("total_pay_amt")
    pay = (
        s.join(t.driverpay, "statement_id", "inner")
        .join(d, "driver_id", "inner")
        .join(rule, "rule_id", "left")
        .select(
            "pay_type", "driver_id", "name", "pay_date",
            F.when(subs, amt).otherwise(F.lit(0)).cast(MONEY).alias("subsistance"),
            F.when(~overtime, F.col("hours")).otherwise(F.lit(0)).cast(MONEY).alias("hours"),
            F.when(overtime, F.col("hours")).otherwise(F.lit(0)).cast(MONEY).alias("overtime"),
            F.when(~subs, amt).otherwise(F.lit(0)).cast(MONEY).alias("other"),
            amt.cast(MONEY).alias("net"),
        )
    )
    zero = F.lit(0).cast(MONEY)
    ded = (
        s.join(t.driverdeductions, "statement_id", "inner")
        .join(d, "driver_id", "inner")
        .select(
            "pay_type", "driver_id", "name", "pay_date",
            zero.alias("subsistance"), zero.alias("hours"), zero.alias("overtime"), zero.alias("other"),
            (-F.col("ded_amt")).cast(MONEY).alias("net"),
        )
    )
    return pay.unionByName(ded)


def driver_pay_summary(t: Tables, statement_date=None, negatives: str = "carry") -> DataFrame:
    """The export's shape -- R12 summed per (pay type, driver, pay date);
    net = subsistence + other - deductions."""
    lines = driver_pay(t, statement_date, negatives)
    g = lines.groupBy("pay_type", "driver_id", "name", "pay_date").agg(
        *[F.sum(m).cast(MONEY).alias(m) for m in MEASURES]
    )
    return g.select("pay_type", F.col("name").alias("driver"), "pay_date", *MEASURES).orderBy(
        text_key("pay_type"), text_key("driver"), "pay_date"
    )


def driver_pay_dates(t: Tables, driver_id=None, since=None) -> DataFrame:
    """Leg date and paid date of a driver's pay lines after ``since``
    (ISO or US ``MM/dd/yyyy`` text).  ``driver_id=None`` lists every driver."""
    p = t.driverpay
    if driver_id is not None:
        p = p.filter(F.col("driver_id") == F.lit(driver_id))
    if since is not None:
        p = p.filter(F.to_date("leg_date") > F.lit(parse_date(since)))
    return p.select("driver_id", "leg_date", "paid_date")


def pay_reallocation(t: Tables, pay_date, fuel_codes=("FSC", "FUEL")) -> DataFrame:
    """R18 (minimal reading of a prose note): per driver, the payable total of
    the pay lines on driver statements up to ``pay_date``, and the part of it
    paid under fuel-surcharge codes."""
    s = t.dr_stmt_report.filter(F.to_date("statement_date") <= F.lit(parse_date(pay_date))).select("statement_id")
    p = t.driverpay.join(s, "statement_id", "left_semi")
    fuel = F.when(F.col("pay_code").isin(*fuel_codes), F.col("total_pay_amt")).otherwise(F.lit(0))
    return p.groupBy("driver_id").agg(
        F.sum("total_pay_amt").cast(MONEY).alias("payable"), F.sum(fuel).cast(MONEY).alias("fuel")
    )


def pay_report_roundtrip(t: Tables, statement_date=None, negatives: str = "carry", path: str | None = None) -> DataFrame:
    """Write the R12b summary as report-layout CSV into the shared
    folder and read it back (B22); the result must reconcile with R12b."""
    spark = t.spark
    if path is None:
        path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/pay-export-{uuid.uuid4().hex}"
    export_pay_report(driver_pay_summary(t, statement_date, negatives), path)
    return read_pay_export(spark, path)


REPORT_KEY = ("pay_type", "driver", "pay_date")


def reconcile_export(t: Tables, path: str, statement_date=None, negatives: str = "carry") -> DataFrame:
    """The rows in which report files at ``path`` and the R12b summary
    differ: missing from the files, extra in them, or changed."""
    return reconcile(driver_pay_summary(t, statement_date, negatives), read_pay_export(t.spark, path), REPORT_KEY, MEASURES)


def altered_report(summary: DataFrame) -> DataFrame:
    """The summary as a report that was edited by hand: by the day of the pay
    date, rows are left out, get another net, or stand twice, and one day's
    rows lose their hours."""
    kind = F.dayofmonth("pay_date") % 7
    kept = summary.where((kind != 0) | kind.isNull())
    changed = kept.withColumn("net", F.when(kind == 1, (F.col("net") + F.lit(1)).cast(MONEY)).otherwise(F.col("net"))).withColumn(
        "hours", F.when(kind == 2, F.lit(None).cast(MONEY)).otherwise(F.col("hours")))
    return changed.unionByName(summary.where(kind == 3))


def pay_reconciliation(t: Tables, statement_date=None, negatives: str = "carry", path: str | None = None) -> DataFrame:
    """R12c on an altered report: it is written as layout files, read back and
    compared with the summary."""
    if path is None:
        path = f"{ensure_checkpoint_dir(t.spark).rstrip('/')}/pay-altered-{uuid.uuid4().hex}"
    export_pay_report(altered_report(driver_pay_summary(t, statement_date, negatives)), path)
    return reconcile_export(t, path, statement_date, negatives)
