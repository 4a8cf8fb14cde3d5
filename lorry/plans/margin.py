"""Gross margin per trip leg.

Each prepared margin row (trip, leg) is decorated with its last bill (``T``,
``MAX_DLID``) and first bill (``O``, ``MIN_DLID``): traces, milestones, carrier,
drivers, site, parent bill, goods length, rounded measures and margin %.
The reference looks traces and milestones up with seven correlated
subqueries per row; here TRACE and ODRSTAT are each scanned once and
aggregated per bill.  Lookups keyed by the same bill are joined one after the
other so they reuse one partitioning of the margin rows; what hangs on a bill
alone (site, master order, split origin) is joined to the bills.  The
lookups are made for each trip and pair of bills, not for each of their legs,
and the margin rows move once, narrow, to meet them before the sort.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lorry.functions.columns import held_narrow, margin_percent, non_blank, text_key
from lorry.operators.keys import Keys
from lorry.operators.lookups import beside, feet, first_trace, lookup, milestones
from lorry.session import stage
from lorry.sources.tables import Tables, live

MEASURES = ("revenue_ship", "revenue_fsc", "revenue_acc", "revenue_total", "ip_ship", "ip_fsc", "ip_acc", "ip_total",
            "dp", "total_cost", "margin")


#: what tells rows apart; legs without bills, splits or masters are many
ROW = ("trip", "leg")
#: what the lookups of a leg depend on, but for carrier and drivers
BILLS = ("trip", "min_dlid", "max_dlid")
#: what of a margin row goes to the join with its bills
NARROW = (*MEASURES, "margin_percent", "leg_miles", "leg", "trip", "min_dlid", "max_dlid", "empty_loaded", "truck", "trailer", "carrier", "driver_1", "driver_2")


def _named(table: DataFrame, key: str, legs: DataFrame) -> DataFrame:
    """The rows of a small table that ``legs`` name by ``key``."""
    return stage(Keys((legs, key), label=f"named-{key}").restrict(table, key), f"rows-{key}")


def gross_margin(t: Tables) -> DataFrame:
    g = t.rpt_gross_margin.filter(F.col("trip").isNotNull())
    # what the lookups need of the legs: legs of a trip that share their bills are one row
    x = g.select(*BILLS).distinct().join(t.trip.select(F.col("trip_number").alias("trip")), "trip", "inner")

    # --- the last bill (T) and everything keyed by it
    tl = live(t, "tlorder")
    last = tl.select(
        F.col("detail_line_id").alias("max_dlid"), F.col("callname").alias("caller"),
        F.col("bill_number"), F.col("current_status"), "site_id", "master_order",
        F.col("origname").alias("shipper_name"), F.col("origaddr1").alias("shipper_address1"),
        F.col("origaddr2").alias("shipper_address2"), F.col("origcity").alias("shipper_city"),
        F.col("origprov").alias("shipper_state"), F.col("destname").alias("consignee_name"),
        F.col("destaddr1").alias("consignee_address1"), F.col("destaddr2").alias("consignee_address2"),
        F.col("destcity").alias("consignee_city"), F.col("destprov").alias("consignee_state"),
        "op_code", "dangerous_goods", F.col("rollup_pallets").alias("pallets"), F.col("rollup_weight").alias("weight"),
        F.col("rollup_cube").alias("cube"), F.col("currency_code").alias("fb_currency"), "sales_agent",
    )
    # its site and the bill of its master order are found per bill, not per leg; the latter by the two ids alone
    last = last.join(t.site.select("site_id", F.col("site_name").alias("company")), "site_id", "left").drop("site_id")
    p1 = tl.select(F.col("detail_line_id").alias("_p1_master"), F.col("bill_number").alias("_p1_bill"))
    masters = last.select("max_dlid", F.col("master_order").alias("_p1_master")).where("max_dlid is not null and _p1_master is not null").distinct()
    masters = masters.join(p1, "_p1_master", "inner")

    # --- the first bill (O), its milestones and split origin
    first = tl.select(
        F.col("detail_line_id").alias("min_dlid"), F.col("actual_pickup").alias("picked_up_on"),
        F.col("actual_delivery").alias("delivered_on"), F.col("bill_date").alias("invoiced_on"), "created_by",
    )
    # --- parent bill (B23): split origin's bill, else master order's bill, else own
    p3 = tl.select(F.col("detail_line_id").alias("orig_detail_line_id"), F.col("bill_number").alias("_p3_bill"))
    splits = t.tlorder_splits.select(F.col("detail_line_id").alias("min_dlid"), "orig_detail_line_id")
    splits = lookup(splits, p3, "orig_detail_line_id", ("min_dlid",)).select("min_dlid", "_p3_bill")

    g = g.withColumns({"margin_percent": margin_percent("margin", "revenue_total"), **{m: F.round(F.col(m), 2) for m in MEASURES}})
    g, own = held_narrow(g, MEASURES)
    # --- carriers and drivers, while the rows are narrow: those that the legs name, written
    # once, so that their size is known before the join and the legs stay where they are
    v = t.vendor.select(F.col("vendor_id").alias("carrier_id"), F.col("name").alias("carrier"))
    g = lookup(g, _named(v, "carrier_id", g), "carrier_id", ROW)
    for k in ("1", "2"):
        d = t.driver.select(F.col("driver_id").alias(f"driver{k}_id"), F.col("name").alias(f"driver_{k}"))
        g = lookup(g, _named(d, f"driver{k}_id", g), f"driver{k}_id", ROW)
    g = g.select(*NARROW)

    # --- narrow lookups first, the wide bill last
    for table in (first, milestones(t.odrstat, key="min_dlid"), splits):
        x = lookup(x, table, "min_dlid", BILLS)
    traces = first_trace(t.trace, {"po": "P", "bol": "1", "order_no": "9"}, key="max_dlid")
    for table in (traces, feet(t.tldtl).withColumnRenamed("order_id", "max_dlid"), last):
        x = lookup(x, table, "max_dlid", BILLS)
    # the masters come to the bills they are of, a bill has one (or few, where its id stands several times)
    x = lookup(x, masters, "max_dlid", BILLS, also=beside("master_order", "_p1_master")).drop("master_order", "_p1_master")
    x = x.drop("_spread_min_dlid", "_spread_max_dlid").withColumnsRenamed({k: f"_x_{k}" for k in BILLS})
    g = g.join(x, reduce(and_, [F.col(k).eqNullSafe(F.col(f"_x_{k}")) for k in BILLS]), "inner")

    # before the sort, what the legs of a trip share stands together: it packs better on the way
    g = g.select(*[c for c in x.columns if not c.startswith("_x_")], "trip", *MEASURES, *[c for c in NARROW if c not in ("trip", "min_dlid", "max_dlid", *MEASURES)])
    return g.orderBy(text_key("company"), "trip", "leg").select(
        "company", "caller",
        F.coalesce("_p3_bill", "_p1_bill", "bill_number").alias("parent_bill"),
        "bill_number", "trip", "leg", "leg_miles", "empty_loaded", "current_status",
        "picked_up_on", "delivered_on", "invoiced_on", "po", "bol", "order_no",
        "carrier", "driver_1", "driver_2", "truck", "trailer",
        "shipper_name", "shipper_address1", "shipper_address2", "shipper_city", "shipper_state",
        "shipper_arrive", "shipper_depart",
        "consignee_name", "consignee_address1", "consignee_address2", "consignee_city", "consignee_state",
        "consignee_arrive", "consignee_depart",
        "op_code",
        F.when(F.col("dangerous_goods") == "True", F.lit("YES")).otherwise(F.lit("NO")).alias("hazmat"),
        "pallets", "feet", "weight", "cube", "fb_currency",
        *[own(m) for m in MEASURES],
        "margin_percent",
        "sales_agent", "created_by",
        F.when(non_blank("driver_1"), own("revenue_total")).otherwise(F.lit(0)).alias("tlt_charge"),
    )
