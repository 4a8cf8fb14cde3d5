"""Accounts-receivable extracts: invoice headers ("page 1") and GL lines ("page 2").

One function per page, with the lineage variants as parameters:

* ``audit``: an audit batch number, ``'latest'`` (newest billing-register
  batch, B1) or ``None`` (every positive batch at once -- numbering restarts
  per batch, so all batches are computed together).
* ``company``: ``'control'`` / ``'trucking'`` restricts to bills with a GL
  line in that company's receivable accounts (B7); ``None`` keeps all.
* ``numbers``: a store of item numbers (:class:`ItemNumbers`): both pages take
  theirs from it, so they are given once and stay as they are when later
  batches arrive.  A store holds one numbering, so pages that number after a
  company filter need one of their own.
* ``watch``: counts, while the page is computed, bills whose customer is
  missing or doubled and lines whose account has no segment.
* ``number``: ``'before'`` numbers every bill of the batch and filters
  afterwards (gaps stay); ``'after'`` filters first (contiguous numbers).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lorry.functions.columns import account_segment, company_accounts, gl_line_code, text_key
from lorry.operators.item_store import ItemNumbers
from lorry.operators.lookups import first_trace, latest_audit
from lorry.operators.numbering import number_items
from lorry.operators.watch import Watch, look_up
from lorry.session import ensure_checkpoint_dir
from lorry.sources.tables import Tables, live


def _table(t: Tables, name: str, audit) -> DataFrame:
    """A table of the report.  Pages of one batch read the stored table, whose
    scan its filters cut; pages of all batches read every row and few columns,
    which storing would only move and write once more."""
    return live(t, name) if audit is None else getattr(t, name)


def _bills(t: Tables, audit, watch: Watch | None = None) -> DataFrame:
    """Non-child bills of the chosen batch(es) with their customer code."""
    bills = _table(t, "tlorder", audit).filter((F.col("interface_status_f") > 0) & (F.col("extra_stops") != "Child"))
    if audit == "latest":
        latest = latest_audit(t.reg_audit)  # exactly one row
        bills = bills.join(F.broadcast(latest), bills.interface_status_f == latest.source_audit, "inner").drop("source_audit")
    elif audit is not None:
        bills = bills.filter(F.col("interface_status_f") == F.lit(audit))
    client = t.client.select("client_id", "user3")
    bills = bills.select("detail_line_id", "interface_status_f", "bill_number", "bill_to_code", "total_charges")
    return look_up(watch, bills, client, "client_id", bills.bill_to_code == client.client_id, "client of a bill")


def _with_company_gl(t: Tables, bills: DataFrame, company: str, audit) -> DataFrame:
    """EXISTS a GL line of the bill in the company's accounts (semi join)."""
    gl = _table(t, "billgl", audit).filter(F.col("acct_code").isin(*company_accounts(company))).select("detail_line_id")
    return bills.join(gl, "detail_line_id", "left_semi")


def _number(bills: DataFrame, method: str, numbers: ItemNumbers | None = None) -> DataFrame:
    order = [
        text_key("user3"),
        text_key("bill_number"),
        F.col("detail_line_id").asc_nulls_last(),  # unique last key: deterministic
    ]
    if numbers is not None:
        return numbers.assign(bills, ["interface_status_f"], "detail_line_id", order, reads=("user3", "bill_number"))
    return number_items(bills, ["interface_status_f"], order, out="cntitem", method=method)


def ar_header(t: Tables, company: str | None = None, audit=None, number: str = "after",
              method: str = "range", numbers: ItemNumbers | None = None, watch: Watch | None = None) -> DataFrame:
    """Invoice headers: CNTBTCH, CNTITEM, IDCUST, IDINVC, TEXTTRX, CUSTPO, AMTINVCTOT, SWMANTX.

    R1 = (company=None, audit=n); R3 = (company, audit=n, number='after');
    R5 = (company, audit='latest', number='before').
    """
    bills = _bills(t, audit, watch)
    if company is not None and number == "after":
        bills = _with_company_gl(t, bills, company, audit)
    # the bills of a batch are few and cut the traces; those of all batches would only be computed and moved twice
    po = first_trace(t.trace, {"custpo": "P"}, bills=None if audit is None else bills)
    bills = bills.join(po, "detail_line_id", "left").drop("bill_to_code", "client_id")
    numbered = _number(bills, method, numbers)
    if company is not None and number == "before":
        numbered = _with_company_gl(t, numbered, company, audit)
    # constants follow behind the sort, which moves the rows
    ordered = numbered.orderBy(F.col("interface_status_f").asc_nulls_last(), F.col("cntitem"), text_key("user3"), text_key("bill_number"))
    return ordered.select(
        F.col("interface_status_f").alias("cntbtch"),
        F.col("cntitem"),
        F.col("user3").alias("idcust"),
        F.col("bill_number").alias("idinvc"),
        F.lit("1").alias("texttrx"),
        F.col("custpo"),
        F.col("total_charges").alias("amtinvctot"),
        F.lit("1").alias("swmantx"),
    )


def ar_detail(t: Tables, company: str | None = None, audit=None, segment: bool = False,
              absolute: bool = False, method: str = "range", numbers: ItemNumbers | None = None,
              watch: Watch | None = None) -> DataFrame:
    """GL lines of the numbered bills: CNTBTCH, CNTITEM, CNTLINE, QTYINVC, AMOUNT,
    IDACCTREV, DISTNETHC, AMTECTNHC.  Bills are numbered before the account filter.

    R2 = (None, n); R4 = (company, n, segment); R6 = (company, 'latest', True, True).
    """
    bills = _bills(t, audit, watch).select("detail_line_id", "interface_status_f", "user3", "bill_number")
    numbered = _number(bills, method, numbers)
    gl = _table(t, "billgl", audit)
    if company is not None:
        gl = gl.filter(F.col("acct_code").isin(*company_accounts(company)))
    lines = numbered.select("detail_line_id", "interface_status_f", "cntitem").join(gl, "detail_line_id", "inner")
    if watch is not None:
        lines = watch.count(lines, "account without a segment", account_segment("acct_code").isNull())
    amount = F.abs(F.col("amount")) if absolute else F.col("amount")
    acct = account_segment("acct_code") if segment else F.col("acct_code")
    # amounts are repeated behind the sort, which moves the rows
    lines = lines.select("interface_status_f", "cntitem", "acct_code", "amount")
    return lines.orderBy("interface_status_f", "cntitem", gl_line_code("acct_code"), text_key(acct)).select(
        F.col("interface_status_f").alias("cntbtch"),
        F.col("cntitem"),
        gl_line_code("acct_code").alias("cntline"),
        F.lit(0).alias("qtyinvc"),
        amount.alias("amount"),
        acct.alias("idacctrev"),
        amount.alias("distnethc"),
        amount.alias("amtectnhc"),
    )


# Named report forms ---------------------------------------------------------

def ar_header_all(t: Tables, audit=None) -> DataFrame:
    """Headers of every non-child bill of the batch (all batches when audit is None)."""
    return ar_header(t, None, audit)


def ar_detail_all(t: Tables, audit=None) -> DataFrame:
    """R2: every GL line of those bills, raw account."""
    return ar_detail(t, None, audit)


def ar_header_filtered(t: Tables, company: str, audit=None) -> DataFrame:
    """Headers of bills with a GL line in the company's accounts, numbered after the filter."""
    return ar_header(t, company, audit, number="after")


def ar_detail_filtered(t: Tables, company: str, audit=None, segment: bool = False) -> DataFrame:
    """The company's GL lines; v2 reports the account's middle segment."""
    return ar_detail(t, company, audit, segment=segment)


def ar_header_current(t: Tables, company: str) -> DataFrame:
    """Latest billing batch, numbered before the company filter."""
    return ar_header(t, company, "latest", number="before")


def ar_detail_current(t: Tables, company: str) -> DataFrame:
    """Latest batch, absolute amounts, account segment."""
    return ar_detail(t, company, "latest", segment=True, absolute=True)


def ar_detail_late_batch(t: Tables, path: str | None = None) -> DataFrame:
    """R2 from stored numbers: all batches but the newest are numbered by a run
    of the header page, then the newest arrives and the detail page of all
    batches is asked for."""
    if path is None:
        path = f"{ensure_checkpoint_dir(t.spark).rstrip('/')}/ar-items-{uuid.uuid4().hex}"
    numbers = ItemNumbers(t.spark, path)
    bills = _bills(t, None)
    newest = bills.agg(F.max("interface_status_f").alias("newest"))  # exactly one row
    _number(bills.join(F.broadcast(newest), bills.interface_status_f < newest.newest, "left_semi"), "range", numbers)
    return ar_detail(t, numbers=numbers)
