"""Accounts-payable extracts.

* R7: posted AP bills of the IP register (header + expense lines).
* R8: accrual of approved interliner (carrier) bills, in the reference's
  successive forms: v1 per interliner bill, v2/v3 per trip, and the
  alternate-vendor form with a signed net.

All accrual rows share one batch (``CNTBTCH`` = the run date), so the
numbering uses the distributed path of :func:`number_items` rather than a
single-partition window.  IP_GL lines are pre-aggregated per interliner bill
before any join (one row per bill instead of one per GL line).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lorry.functions.columns import (
    AP_EXPENSE_ACCOUNT, abs_amount, account_segment, credit_sign, gl_line_code, signed_amount, text_key,
)
from lorry.operators.item_store import ItemNumbers
from lorry.operators.legs import leg_trip
from lorry.operators.numbering import number_items
from lorry.sources.tables import Tables, live

IP_SOURCE = "IP Source Register"


def _batch(as_of) -> F.Column:
    """CNTBTCH: the run date as yyMMdd text."""
    d = F.current_date() if as_of is None else F.lit(dt.date.fromisoformat(str(as_of)))
    return F.date_format(d, "yyMMdd")


def _constants() -> list[F.Column]:
    return [F.lit("1").alias("swtaxbl"), F.lit("0").alias("swcalctx"), F.lit("0").alias("amttax1"), F.lit("0").alias("amttax2")]


# --- R7: AP register --------------------------------------------------------

def _ap_register(t: Tables, audit, method: str, keep: tuple[str, ...], numbers: ItemNumbers | None) -> DataFrame:
    a = t.ap_bill.filter((F.col("source_audit") > 0) & (F.col("source_reg") == "IP Register"))
    if audit is not None:
        a = a.filter(F.col("source_audit") == F.lit(audit))
    v = t.vendor.select("vendor_id", "user3")
    x = a.join(v, "vendor_id", "inner")
    # numbering writes its rows, so only what the caller reads goes in
    x = x.select(*dict.fromkeys(["source_audit", "user3", "bill_number", "ap_bill_id", *keep]))
    order = [text_key("user3"), text_key("bill_number"), F.col("ap_bill_id")]
    if numbers is not None:
        return numbers.assign(x, ["source_audit"], "ap_bill_id", order, reads=("user3", "bill_number"))
    return number_items(x, ["source_audit"], order, method=method)


def ap_register_header(t: Tables, audit=None, method: str = "range", numbers: ItemNumbers | None = None) -> DataFrame:
    """R7 header; with ``numbers`` items come from (and go to) that store. The gross amount is *not* negated for credits (only the lines are)."""
    x = _ap_register(t, audit, method, ("tx_date", "tx_reference", "tx_amt"), numbers)
    out = x.select(
        F.col("source_audit").alias("cntbtch"),
        "cntitem",
        F.col("user3").alias("idcust"),
        F.lit("1").alias("texttrx"),
        F.col("bill_number").alias("idinvc"),
        F.substring(F.date_format("tx_date", "yyyy-MM-dd"), 1, 10).alias("dateinvc"),
        F.col("tx_reference").alias("ordrnbr"),
        *_constants(),
        F.col("tx_amt").alias("amtgrostot"),
        F.lit("1").alias("swmantx"),
    )
    return out.orderBy("cntbtch", text_key("idcust"), text_key("idinvc"))


def ap_register_detail(t: Tables, audit=None, method: str = "range", numbers: ItemNumbers | None = None) -> DataFrame:
    """R7 detail: expense lines of the numbered bills, credits negated."""
    x = _ap_register(t, audit, method, ("tx_type",), numbers).select("ap_bill_id", "source_audit", "cntitem", "tx_type")
    lines = x.join(t.ap_bill_exp, "ap_bill_id", "inner")
    out = lines.select(
        F.col("source_audit").alias("cntbtch"),
        "cntitem",
        gl_line_code("gl_acct_id").alias("cntline"),
        F.lit("0").alias("amttax1"),
        F.lit("0").alias("amttax2"),
        F.col("gl_acct_id").alias("idglacct"),
        credit_sign("tx_type", "tx_amt").alias("amtdist"),
    )
    return out.orderBy("cntbtch", "cntitem", "cntline", text_key("idglacct"))


# --- R8: interliner accruals --------------------------------------------------

def _approved(t: Tables, userfields: bool = True) -> DataFrame:
    oi = t.order_interliner.filter(F.col("interface_status") == "S")
    if userfields:
        oi = oi.join(t.order_interliner_userfields, "order_interliner_id", "left_semi")
    return oi


def _expense_per_bill(t: Tables, rule: str = "abs") -> DataFrame:
    """Per interliner bill: sum over its IP-source GL lines of the expense
    amount (``abs`` or ``signed`` rule, B8).  Other accounts count 0, which is
    also what callers make of a bill without a row here."""
    amt = abs_amount("debit_amt", "credit_amt") if rule == "abs" else signed_amount("debit_amt", "credit_amt")
    return (
        t.ip_gl.filter((F.col("source_type") == IP_SOURCE) & (F.col("acct_code") == AP_EXPENSE_ACCOUNT))
        .groupBy("order_interliner_id")
        .agg(F.sum(amt).alias("_gross"))
    )


def _bill_number(t: Tables, oi: DataFrame) -> DataFrame:
    """The bill of a single-segment leg is the interliner's own bill; of a
    multi-segment leg, the child bill.  One equi-join on the chosen key
    instead of two conditional left joins."""
    key = F.when((F.col("child_detail_line_id") == 0) | (F.col("child_type") == "S"), F.col("detail_line_id")).when(
        (F.col("child_detail_line_id") > 0) & (F.col("child_type") != "S"), F.col("child_detail_line_id")
    )
    bills = live(t, "tlorder").select(F.col("detail_line_id").alias("_bill_id"), F.col("bill_number").alias("idinvc"))  # two of its columns
    return oi.withColumn("_bill_key", key).join(bills, F.col("_bill_key") == F.col("_bill_id"), "left").drop("_bill_key", "_bill_id")


def _v1_groups(t: Tables, rule: str) -> DataFrame:
    oi = _approved(t).select(
        "order_interliner_id", "interliner_id", "detail_line_id", "child_detail_line_id", "child_type",
        "src_approval_date", "probill",
    )
    # bills without an accrual drop first, by the partitioning of the semi join
    g = oi.join(_expense_per_bill(t, rule), "order_interliner_id", "left")
    g = g.withColumn("amtgrostot", F.coalesce(F.col("_gross"), F.lit(0))).drop("_gross").filter(F.col("amtgrostot") != 0)
    g = _bill_number(t, g).drop("detail_line_id", "child_detail_line_id", "child_type")
    v = t.vendor.select(F.col("vendor_id"), F.col("user3").alias("idvend"), F.col("name").alias("description"))
    return g.join(v, g.interliner_id == v.vendor_id, "left").drop("interliner_id")


def _header_cols(extra_after_vend: list | None = None) -> list:
    return [
        "cntbtch", "cntitem", "idvend", *(extra_after_vend or []), F.lit("1").alias("texttrx"), "idinvc", "description",
        F.date_format("src_approval_date", "yyyy-MM-dd").alias("dateinvc"),
        F.col("probill").alias("ordrnbr"), *_constants(), "amtgrostot", F.lit("1").alias("swmantx"),
    ]


def ap_v1_header(t: Tables, as_of=None, method: str = "range", numbers: ItemNumbers | None = None) -> DataFrame:
    """One row per approved interliner bill with a non-zero accrual (ABS rule)."""
    # constants follow behind the sort, which moves the rows
    return _v1_header(t, as_of, method, numbers).orderBy("cntbtch", "cntitem").select(*_header_cols())


def _v1_header(t: Tables, as_of, method: str, numbers: ItemNumbers | None = None, keep: tuple[str, ...] = ("*",)) -> DataFrame:
    # numbering writes its rows, so only what the caller reads goes in
    g = _v1_groups(t, "abs").withColumn("cntbtch", _batch(as_of)).select(*keep)
    order = [text_key("idvend"), text_key("idinvc"), F.col("order_interliner_id")]
    if numbers is not None:
        return numbers.assign(g, ["cntbtch"], "order_interliner_id", order, reads=("idvend", "idinvc"))
    return number_items(g, ["cntbtch"], order, method=method)


def ap_v1_detail(t: Tables, as_of=None, method: str = "range", numbers: ItemNumbers | None = None) -> DataFrame:
    """The raw expense lines of each header row (line grain)."""
    keep = ("cntbtch", "idvend", "idinvc", "order_interliner_id")
    h = _v1_header(t, as_of, method, numbers, keep).select("cntbtch", "cntitem", "order_interliner_id")
    lines = t.ip_gl.filter((F.col("source_type") == IP_SOURCE) & (F.col("acct_code") == AP_EXPENSE_ACCOUNT))
    d = h.join(lines, "order_interliner_id", "inner")
    out = d.select(
        "cntbtch", "cntitem", F.lit("40").alias("cntline"), F.lit("0").alias("amttax1"), F.lit("0").alias("amttax2"),
        account_segment("acct_code").alias("idglacct"), abs_amount("debit_amt", "credit_amt").alias("amtdist"),
    )
    return out.orderBy("cntbtch", "cntitem", text_key("idglacct"))


def ap_user3_header(t: Tables, as_of=None, method: str = "range") -> DataFrame:
    """R8g: v1 with the numeric vendor id and the *signed* net (offsetting lines drop)."""
    g = _v1_groups(t, "signed").withColumn("cntbtch", _batch(as_of))
    order = [
        text_key("idvend"), F.col("vendor_id").asc_nulls_last(), text_key("idinvc"),
        F.col("order_interliner_id"),
    ]
    h = number_items(g, ["cntbtch"], order, method=method)
    # constants follow behind the sort, which moves the rows
    return h.orderBy("cntbtch", "cntitem").select(*_header_cols([F.col("vendor_id").alias("vendid")]))


def _trip_lines(t: Tables, userfields: bool) -> DataFrame:
    """Approved interliner bills with vendor, trip (B6) and accrual amount."""
    oi = _approved(t, userfields).select("order_interliner_id", "interliner_id", "legid", "src_approval_date", "probill")
    v = t.vendor.select(F.col("vendor_id"), F.col("user3").alias("idvend"), F.col("name").alias("description"))
    oi = oi.join(v, oi.interliner_id == v.vendor_id, "left")
    lm = leg_trip(live(t, "legsum"))  # two of its columns
    oi = oi.join(lm, oi.legid == lm.ls_leg_id, "left")
    oi = oi.join(_expense_per_bill(t), "order_interliner_id", "left")
    return oi.withColumn("_gross", F.coalesce(F.col("_gross"), F.lit(0)))


def _trip_header(t: Tables, as_of, version: str, method: str) -> DataFrame:
    x = _trip_lines(t, userfields=True)
    date = F.date_format("src_approval_date", "yyyy-MM-dd").alias("dateinvc")
    if version == "v2":
        g = x.groupBy("idvend", "description", "trip_number", date, "probill").agg(F.sum("_gross").alias("amtgrostot"))
    else:  # v3: one probill per (vendor, trip, date)
        g = x.groupBy("idvend", "description", "trip_number", date).agg(
            F.max("probill").alias("probill"), F.sum("_gross").alias("amtgrostot"))
    g = g.filter(F.col("amtgrostot") != 0).withColumn("cntbtch", _batch(as_of))
    order = [
        text_key("idvend"), F.col("trip_number").asc_nulls_last(),
        text_key("description"), text_key("dateinvc"), text_key("probill"),
    ]
    h = number_items(g, ["cntbtch"], order, method=method)
    return h.select(
        "cntbtch", "cntitem", "idvend", F.lit("1").alias("texttrx"), F.col("trip_number").alias("idinvc"), "description",
        "dateinvc", F.col("probill").alias("ordrnbr"), *_constants(), "amtgrostot", F.lit("1").alias("swmantx"),
    ).orderBy("cntbtch", "cntitem")


def ap_v2_header(t: Tables, as_of=None, method: str = "range") -> DataFrame:
    """Per (vendor, trip, approval date, probill)."""
    return _trip_header(t, as_of, "v2", method)


def ap_v3_header(t: Tables, as_of=None, method: str = "range") -> DataFrame:
    """R8e: per (vendor, trip, approval date) with the largest probill."""
    return _trip_header(t, as_of, "v3", method)


def ap_v2_detail(t: Tables, as_of=None, method: str = "range") -> DataFrame:
    """R8d (= R8f): the header re-grouped by (vendor code, trip) -- without the
    user-field filter, as in the reference -- joined to one expense total per
    trip.  Header rows without a trip drop at the inner join."""
    x = _trip_lines(t, userfields=False)
    h = x.groupBy("idvend", "trip_number").agg(F.sum("_gross").alias("_tot")).filter(F.col("_tot") != 0)
    h = h.withColumn("cntbtch", _batch(as_of))
    h = number_items(h, ["cntbtch"], [text_key("idvend"), F.col("trip_number").asc_nulls_last()], method=method)

    lm = leg_trip(live(t, "legsum"))  # two of its columns
    oi = _approved(t, userfields=False).select("order_interliner_id", "legid")
    lines = t.ip_gl.filter((F.col("source_type") == IP_SOURCE) & (F.col("acct_code") == AP_EXPENSE_ACCOUNT))
    dtl = (
        oi.join(lm, oi.legid == lm.ls_leg_id, "inner")
        .join(lines, "order_interliner_id", "inner")
        .groupBy("trip_number", account_segment("acct_code").alias("idglacct"))
        .agg(F.sum(abs_amount("debit_amt", "credit_amt")).alias("amtdist"))
    )
    d = h.select("cntbtch", "cntitem", "trip_number").join(dtl, "trip_number", "inner")
    out = d.select(
        "cntbtch", "cntitem", F.lit("40").alias("cntline"), F.lit("0").alias("amttax1"), F.lit("0").alias("amttax2"),
        "idglacct", "amtdist",
    )
    return out.orderBy("cntbtch", "cntitem", text_key("idglacct"))


ap_v3_detail = ap_v2_detail
