"""Inter-company revenue and mileage report.

One row per (bill, trip, leg) for split bills (B13: moved by both a company
driver and an interliner) that are not child bills, with the carrier's pay
prorated to the leg (B19), the leg's share of the bill's freight miles, the
bill's charges (repeated on every leg row -- never re-sum them over legs),
and the charges of its extra-charge copies (B14).

Lineage variants are flags:

* ``zones``: ``'none'`` plain zone descriptions (first versions); ``'inner'``
  terminal-labelled descriptions with four inner zone joins (a leg or trip
  with an unknown zone drops); ``'safe'`` the same labels through a
  de-duplicated zone lookup with left joins (unknown zones are kept).
* ``date_range``: inclusive ``(begin, end)`` on the delivery date; a bill table
  that is stored by month is read for these months only.
* ``bill_prefix``: the stored-procedure form filters bill numbers instead.
* ``watch`` counts legs whose trip or zones are missing or doubled (the inner
  zone joins fan out on a doubled zone; the ``'safe'`` form cannot).
* ``trip_columns`` / ``skids``: the trip from/to, power unit and skid
  columns added in version 2.

Every lookup is joined where rows are narrowest: a leg's carrier pay and trip
to the leg, a bill's extra charges and skids to the bill.  Wide rows arise in
the last join and move once, by the sort.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lorry.functions.columns import prorate, share, text_key, zone_label
from lorry.operators.keys import Keys
from lorry.operators.legs import carrier_miles, carrier_pay, extra_charges
from lorry.operators.lookups import beside, safe_zone, skid_units
from lorry.operators.watch import Watch, look_up
from lorry.session import stage
from lorry.sources.tables import Tables, live


def intercompany(t: Tables, zones: str = "inner", date_range=None, bill_prefix: str | None = None,
                 trip_columns: bool = True, skids: bool = True, watch: Watch | None = None) -> DataFrame:
    if zones not in ("none", "inner", "safe"):
        raise ValueError(f"zones must be 'none', 'inner' or 'safe', not {zones!r}")
    bills = live(t, "tlorder")
    if date_range is not None:
        begin, end = (dt.date.fromisoformat(str(d)) for d in date_range)
        bills = t.period("tlorder", "actual_delivery", begin, end)
    bills = bills.filter(F.col("extra_stops") != "Child")
    if bill_prefix is not None:
        bills = bills.filter(F.col("bill_number").startswith(bill_prefix))
    bills = bills.select(
        "detail_line_id", "bill_number", "actual_delivery", "charges", "xcharges", "tax_1", "tax_2", "total_charges",
        "origcity", "origprov", "destcity", "destprov", "requested_equipmen", "distance", "pallets",
    )

    # a report of few of the bills restricts every lookup to what they name, below its aggregate; one of most
    # bills would move the lookups' rows once more only to keep nearly all of them
    few = watch is not None or 2 * bills.count() < live(t, "tlorder").count()

    # the legs that bills ride, once: miles, split filter and output rows all read
    # it; what is written is not pruned, so only columns that this form shows go in
    legs = (t.legsum if few else live(t, "legsum", by="ls_leg_id")).select(
        "ls_leg_id", "ls_trip_number", "ls_leg_seq", "ls_interliner", "ls_leg_dist", "lego_zone_desc", "legd_zone_desc", "ls_driver",
        *(("ls_from_zone", "ls_to_zone") if zones != "none" else ()), *(("ls_power_unit",) if trip_columns else ()),
    )
    parts = live(t, "ilegdtl", by="ild_leg_id")
    bridge = parts.where("ild_fb_id is not null").select(F.col("ild_fb_id").alias("detail_line_id"), F.col("ild_leg_id").alias("ls_leg_id"), "ild_res_type")
    means = (
        parts.filter(F.col("ild_res_type").isin("D", "I")).groupBy(F.col("ild_leg_id").alias("ls_leg_id"))
        .agg(F.max(F.col("ild_res_type") == "D").alias("_d"), F.max(F.col("ild_res_type") == "I").alias("_i"))
    )
    if few:
        bridge = bridge.join(bills.select("detail_line_id"), "detail_line_id", "left_semi")
    rides = stage(bridge.join(legs, "ls_leg_id", "inner").join(means, "ls_leg_id", "left").drop("ls_leg_id"), "rides")
    freight = F.col("ild_res_type") == "F"
    per_bill = (
        rides.groupBy("detail_line_id")
        .agg(F.sum(F.when(freight, F.col("ls_leg_dist"))).alias("total_fb_miles"),
             F.max(freight & F.col("_d")).alias("_d"), F.max(freight & F.col("_i")).alias("_i"))
        .filter(F.col("_d") & F.col("_i")).select("detail_line_id", "total_fb_miles")
    )
    pays, legs_of_trips, goods, numbers = live(t, "order_interliner", by="detail_line_id"), live(t, "legsum", by="ls_trip_number"), t.tldtl, None
    if few:
        split = stage(bills.select("detail_line_id", "bill_number").join(per_bill, "detail_line_id", "left_semi"), "split-bills")
        chosen, numbers = Keys((split, "detail_line_id"), label="split-ids"), Keys((split, "bill_number"), label="split-numbers")
        if watch is not None or 2 * chosen.count < rides.agg(F.approx_count_distinct("detail_line_id")).first()[0]:
            rides = chosen.restrict(rides, "detail_line_id")  # else it would move more than it saves
        trips = Keys((chosen.restrict(rides.select("detail_line_id", "ls_trip_number"), "detail_line_id"), "ls_trip_number"), label="split-trips")
        pays, goods = chosen.restrict(pays, "detail_line_id"), chosen.restrict(t.tldtl, "order_id")
        legs_of_trips = trips.restrict(t.legsum, "ls_trip_number")
    x = rides.drop("_d", "_i", "ild_res_type")

    # zones (small dimension; AQE broadcasts it after measuring it): those of a leg while its row is
    # narrow, those of a trip while there is a row a trip; a watch counts all of them at the output rows
    if zones != "none":
        z = t.zone.select("zone_id", "province", "is_terminal") if zones == "inner" else stage(safe_zone(t.zone), "safe-zones")
    trip = live(t, "trip", by="trip_number").select("trip_number", "origin_zone", "destination_zone", "orig_zone_desc", "dest_zone_desc")
    if zones == "none":
        x = x.withColumnsRenamed({"lego_zone_desc": "leg_from", "legd_zone_desc": "leg_to"})
        trip = trip.select("trip_number", *((F.col("orig_zone_desc").alias("trip_from"), F.col("dest_zone_desc").alias("trip_to")) if trip_columns else ()))
    elif watch is None:
        x = _labelled(x, z, LEG_ZONES, zones)
        trip = _labelled(trip, z, TRIP_ZONES, zones)

    # legs to their bill: those of the report's split bills stay, and take their carrier's pay
    pay = carrier_pay(pays).withColumnsRenamed({"detail_line_id": "_pay_bill"})
    x = x.join(per_bill.select("detail_line_id").join(bills.select("detail_line_id"), "detail_line_id", "left_semi"), "detail_line_id", "left_semi")
    x = x.join(pay, (x.detail_line_id == pay._pay_bill) & beside(x.ls_interliner, pay.interliner_id), "left").drop("_pay_bill", "interliner_id")
    # legs to their trip
    cm = carrier_miles(legs_of_trips).withColumnRenamed("ls_trip_number", "_cm_trip").withColumnRenamed("ls_interliner", "_cm_carrier")
    x = _with_trip(x, trip, cm, watch)
    x = x.withColumn("carrier_pay", prorate("carrier_pay", "ls_leg_dist", "total_carrier_miles")).drop("total_carrier_miles")
    # what neighbouring rows share stands together, here and before the sort: it packs better on the way
    of_trip = ["ls_trip_number", *(c for c in trip.columns if c != "trip_number")]
    x = x.select(*of_trip, *(c for c in x.columns if c not in of_trip))

    # the bills' lookups, while there is a row a bill: by number (extra-charge copies), then by id
    extra = extra_charges(live(t, "tlorder") if not few else t.tlorder, numbers).select(
        F.col("bill_number").alias("_xb"), *[F.col(m).alias(f"additional_{m}") for m in
                                             ("charges", "xcharges", "tax_1", "tax_2", "total_charges")]
    )
    b = bills.join(extra, bills.bill_number == extra._xb, "left").drop("_xb").join(per_bill, "detail_line_id", "inner")
    if skids:
        b = b.join(skid_units(goods).withColumnRenamed("order_id", "detail_line_id"), "detail_line_id", "left")
    x = b.join(x, "detail_line_id", "inner")
    if zones != "none" and watch is not None:
        x = _labelled(x, z, TRIP_ZONES + LEG_ZONES, zones, watch)

    of_bill = [
        "bill_number", "actual_delivery", "charges", "xcharges", "tax_1", "tax_2", "total_charges", "total_fb_miles",
        F.col("origcity").alias("shipper_city"), F.col("origprov").alias("shipper_prov"),
        F.col("destcity").alias("consignee_city"), F.col("destprov").alias("consignee_prov"),
        F.col("requested_equipmen").alias("service_level"), F.col("distance").alias("billed_miles"),
        "additional_charges", "additional_xcharges", "additional_tax_1", "additional_tax_2", "additional_total_charges",
        *((F.col("pallets").alias("skids"), "skid_units") if skids else ()),
    ]
    of_leg = [
        F.col("ls_trip_number").alias("trip_number"), *(("trip_from", "trip_to", "ls_power_unit") if trip_columns else ()),
        F.col("ls_leg_seq").alias("leg"), F.col("ls_interliner").alias("carrier_id"), "carrier_pay", F.col("ls_leg_dist").alias("miles"),
        "leg_from", "leg_to", F.col("ls_driver").alias("driver_id"),
    ]
    return x.select(*of_bill, *of_leg).orderBy(text_key("bill_number"), "trip_number", "leg").select(
        "bill_number", "actual_delivery", "trip_number", *(("trip_from", "trip_to") if trip_columns else ()),
        "leg", "leg_from", "leg_to", "driver_id", *(("ls_power_unit",) if trip_columns else ()), "carrier_id", "carrier_pay",
        "charges", "xcharges", "tax_1", "tax_2", "total_charges",
        "miles", "total_fb_miles", share("miles", "total_fb_miles").alias("share"),
        "shipper_city", "shipper_prov", "consignee_city", "consignee_prov", "service_level", "billed_miles",
        "additional_charges", "additional_xcharges", "additional_tax_1", "additional_tax_2", "additional_total_charges",
        *(("skids", "skid_units") if skids else ()),
    )


#: label, zone column and description column of the ends of a trip and of a leg
TRIP_ZONES = (("trip_from", "origin_zone", "orig_zone_desc"), ("trip_to", "destination_zone", "dest_zone_desc"))
LEG_ZONES = (("leg_from", "ls_from_zone", "lego_zone_desc"), ("leg_to", "ls_to_zone", "legd_zone_desc"))


def _labelled(df: DataFrame, zone: DataFrame, ends, zones: str, watch: Watch | None = None) -> DataFrame:
    """``df`` with the labels of its zones in place of their ids and descriptions."""
    for label, key, desc in ends:
        zr = zone.select(F.col("zone_id").alias("_z_id"), F.col("province").alias("_z_prov"), F.col("is_terminal").alias("_z_term"))
        df = look_up(watch, df, zr, "_z_id", df[key] == zr["_z_id"], f"zone of {key}", "inner" if zones == "inner" else "left")
        df = df.withColumn(label, zone_label(desc, "_z_term", "_z_prov")).drop("_z_id", "_z_prov", "_z_term", key, desc)
    return df


def _with_trip(x: DataFrame, trip: DataFrame, cm: DataFrame, watch: Watch | None) -> DataFrame:
    """Legs with their trip and their carrier's miles in it, both by the trip:
    legs move once, and meet no more rows of their trip than it has carriers."""
    x = look_up(watch, x, trip, "trip_number", x.ls_trip_number == trip.trip_number, "trip of a leg")
    return x.join(cm, (x.ls_trip_number == cm._cm_trip) & beside(x.ls_interliner, cm._cm_carrier), "left").drop("_cm_trip", "_cm_carrier", "trip_number")


# Named lineage forms ------------------------------------------------------------

def intercompany_v1(t: Tables, date_range) -> DataFrame:
    """First form: plain zone descriptions, no trip/skid columns, delivery-date range."""
    return intercompany(t, zones="none", date_range=date_range, trip_columns=False, skids=False)


def intercompany_v2(t: Tables, date_range) -> DataFrame:
    """Version 2: adds trip from/to, power unit and skids (with the skid lookup joined)."""
    return intercompany(t, zones="none", date_range=date_range)


def intercompany_v3(t: Tables, date_range) -> DataFrame:
    """Version 3: terminal-labelled zones, inner zone joins."""
    return intercompany(t, zones="inner", date_range=date_range)


def intercompany_procedure(t: Tables, bill_prefix: str = "C") -> DataFrame:
    """Stored-procedure form: version 3 filtered on the bill-number prefix."""
    return intercompany(t, zones="inner", bill_prefix=bill_prefix)


def intercompany_safe(t: Tables, bill_prefix: str = "C") -> DataFrame:
    """Safe-join form: de-duplicated zones, left-joined, so legs with unknown zones stay."""
    return intercompany(t, zones="safe", bill_prefix=bill_prefix)


def last_month(as_of=None) -> tuple[dt.date, dt.date]:
    """The report-period parameters of R15 as dates: first and last day of
    the month before ``as_of`` (default today)."""
    from lorry.functions.dates import parse_date

    d = dt.date.today() if as_of is None else parse_date(as_of)
    end = d.replace(day=1) - dt.timedelta(days=1)
    return end.replace(day=1), end


def intercompany_last_month(t: Tables, as_of=None, zones: str = "inner") -> DataFrame:
    """Version 3 for the previous calendar month, the way the scheduled report
    fills ``:DATE_BEGIN`` / ``:DATE_END``."""
    return intercompany(t, zones=zones, date_range=last_month(as_of))
