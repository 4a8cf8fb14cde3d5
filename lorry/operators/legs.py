"""Building blocks over trips, legs and the leg/resource bridge (ILEGDTL).

All are set-based: they compute for every trip / leg / bill at once.  Where
the reference uses correlated MIN/MAX subqueries per row, we use grouped
aggregates or windows partitioned by trip, so one shuffle on the trip key
serves them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lorry.operators.keys import Keys, restricted
from lorry.session import stage


def leg_trip(legsum: DataFrame) -> DataFrame:
    """``(ls_leg_id, trip_number)`` with the largest trip number per leg."""
    return legsum.groupBy("ls_leg_id").agg(F.max("ls_trip_number").alias("trip_number"))


def bill_miles(legsum: DataFrame, ilegdtl: DataFrame) -> DataFrame:
    """Total distance over the freight (``F``) legs of each bill."""
    f = ilegdtl.filter(F.col("ild_res_type") == "F").select("ild_leg_id", "ild_fb_id")
    legs = legsum.select("ls_leg_id", "ls_leg_dist")
    return (
        f.join(legs, f.ild_leg_id == legs.ls_leg_id, "inner")
        .groupBy("ild_fb_id")
        .agg(F.sum("ls_leg_dist").alias("total_fb_miles"))
    )


def carrier_miles(legsum: DataFrame) -> DataFrame:
    """Total distance per (trip, carrier)."""
    return legsum.groupBy("ls_trip_number", "ls_interliner").agg(F.sum("ls_leg_dist").alias("total_carrier_miles"))


def carrier_pay(order_interliner: DataFrame) -> DataFrame:
    """Carrier pay per (bill, carrier): adjusted amount once interfaced ('I'), else the amount."""
    amt = F.when(F.col("interface_status") == "I", F.col("adjusted_amount")).otherwise(F.col("amount"))
    return order_interliner.groupBy("detail_line_id", "interliner_id").agg(F.sum(amt).alias("carrier_pay"))


def split_bills(ilegdtl: DataFrame) -> DataFrame:
    """Bills carried both by a driver ('D') and by an interliner ('I').

    A bill qualifies when the legs it rides (freight bridge rows) carry both
    resource types -- counted over *all* its legs, not per leg.  The
    reference self-joins the bridge on the leg; we first reduce each leg to
    two flags (one row per leg), join the bill's freight rows to them, and
    aggregate per bill: no pair explosion, even on a leg with many bills.
    """
    res = (
        ilegdtl.filter(F.col("ild_res_type").isin("D", "I"))
        .groupBy("ild_leg_id")
        .agg(
            F.max(F.col("ild_res_type") == "D").alias("_has_d"),
            F.max(F.col("ild_res_type") == "I").alias("_has_i"),
        )
    )
    fb = ilegdtl.filter(F.col("ild_res_type") == "F").select("ild_leg_id", "ild_fb_id")
    per_bill = (
        fb.join(res, "ild_leg_id", "inner")
        .groupBy("ild_fb_id")
        .agg(F.max("_has_d").alias("_d"), F.max("_has_i").alias("_i"))
    )
    return per_bill.filter(F.col("_d") & F.col("_i")).select(
        "ild_fb_id", (F.col("_d").cast("int") + F.col("_i").cast("int")).cast("long").alias("res_count")
    )


#: name and zone of the place of a pickup and of a delivery
PLACES = {"P": ("origname", "start_zone"), "D": ("destname", "end_zone")}
MONEY = ("charges", "xcharges", "tax_1", "tax_2", "total_charges")


def extra_charges(tlorder: DataFrame, numbers: Keys | None = None) -> DataFrame:
    """Per parent bill number (of ``numbers`` if given), the sums of the five money columns over
    its extra-charge copies (bill number with a '.', interface status not void)."""
    copies = tlorder.filter(
        (F.coalesce(F.col("interface_status_f"), F.lit(0)) != -1) & F.col("bill_number").contains(".")
    ).select("copy_dlid", *MONEY)
    parents = restricted(tlorder.select("detail_line_id", "bill_number"), "bill_number", numbers)
    j = parents.join(copies, parents.detail_line_id == copies.copy_dlid, "inner")
    return j.groupBy("bill_number").agg(*[F.sum(m).alias(m) for m in MONEY])


def carrier_spans(legsum: DataFrame) -> DataFrame:
    """Per (trip, carrier): first and last leg sequence, plus the earliest first
    leg and the latest last leg of any *other* (non-NULL) carrier in the trip.

    Aggregates, not windows: a trip with very many legs is reduced map-side
    before the shuffle instead of landing whole in one window task.
    """
    cf = (
        legsum.filter(F.col("ls_interliner").isNotNull())
        .groupBy("ls_trip_number", "ls_interliner")
        .agg(F.min("ls_leg_seq").alias("carrier_first_seq"), F.max("ls_leg_seq").alias("carrier_last_seq"))
    )
    # the best and the best among the rest, per trip (ties between carriers are harmless:
    # a different carrier holding the same value gives the same answer)
    best = cf.groupBy("ls_trip_number").agg(
        F.min(F.struct("carrier_first_seq", "ls_interliner")).alias("_f1"),
        F.max(F.struct("carrier_last_seq", "ls_interliner")).alias("_l1"),
    )
    rest = (
        cf.join(best, "ls_trip_number")
        .groupBy("ls_trip_number")
        .agg(
            F.min(F.when(F.col("ls_interliner") != F.col("_f1.ls_interliner"), F.col("carrier_first_seq"))).alias("_f2"),
            F.max(F.when(F.col("ls_interliner") != F.col("_l1.ls_interliner"), F.col("carrier_last_seq"))).alias("_l2"),
        )
    )
    per_trip = best.join(rest, "ls_trip_number")
    out = cf.join(per_trip, "ls_trip_number")
    return out.select(
        "ls_trip_number", "ls_interliner", "carrier_first_seq", "carrier_last_seq",
        F.when(F.col("ls_interliner") == F.col("_f1.ls_interliner"), F.col("_f2"))
        .otherwise(F.col("_f1.carrier_first_seq")).alias("other_first_seq"),
        F.when(F.col("ls_interliner") == F.col("_l1.ls_interliner"), F.col("_l2"))
        .otherwise(F.col("_l1.carrier_last_seq")).alias("other_last_seq"),
    )


def terminal_flags(legsum: DataFrame, zone: DataFrame, leg_ids: DataFrame | None = None, spans: DataFrame | None = None,
                   zone_row: str | None = None) -> DataFrame:
    """Per leg with both zones known, whether its origin / destination is a terminal.

    ``legsum`` holds all legs; ``leg_ids`` (a frame with ``ls_leg_id``) picks
    the legs that are returned.  Their trips are always looked at whole.
    ``spans`` is :func:`carrier_spans` of all legs, if it is there already.
    ``zone_row`` names a column of ``zone`` that tells its rows apart: then the
    legs get that of their two zones (``orig_row``, ``dest_row``) instead of the texts.

    Origin is a terminal when the leg runs empty ('E'), or the origin zone is
    a terminal, or the leg is the first of its carrier in the trip while a
    leg of another carrier comes earlier; the destination mirrors this with
    last/later.  The reference's two-level correlated subqueries become one
    join to :func:`carrier_spans`.  A leg with a NULL carrier is never a
    hand-over, and NULL carriers never count as "another carrier" (SQL's
    ``=``/``<>`` with NULL are unknown).  Both zones are inner-joined: a leg
    with an unknown zone yields nothing.
    """
    l = legsum.select(
        "ls_leg_id", "ls_trip_number", "ls_leg_seq", "ls_interliner", "ls_mt_loaded", "ls_from_zone", "ls_to_zone",
        "ls_planned_departure", "ls_expected_date", "ls_num_pu", "ls_num_del",
    )
    if leg_ids is not None:
        l = l.join(leg_ids.select("ls_leg_id").distinct(), "ls_leg_id", "left_semi")
    if spans is None:
        spans = carrier_spans(legsum)
    l = l.join(spans, ["ls_trip_number", "ls_interliner"], "left")
    hand_o = (F.col("ls_leg_seq") == F.col("carrier_first_seq")) & (F.col("other_first_seq") < F.col("carrier_first_seq"))
    hand_d = (F.col("ls_leg_seq") == F.col("carrier_last_seq")) & (F.col("other_last_seq") > F.col("carrier_last_seq"))

    texts = {"name": "short_description", "addr1": "address1", "addr2": "address2", "city": "city", "prov": "province", "pc": "postal_code"}

    def end(key: str, side: str) -> DataFrame:
        named = [F.col(zone_row).alias(f"{side}_row")] if zone_row else [F.col(c).alias(f"term_{side}{k}") for k, c in texts.items()]
        return zone.select(F.col("zone_id").alias(key), F.col("is_terminal").alias(f"{key}_term"), *named)

    oz, dz = end("_oz", "orig"), end("_dz", "dest")
    l = l.join(oz, l.ls_from_zone == oz._oz, "inner").join(dz, l.ls_to_zone == dz._dz, "inner")
    empty = F.col("ls_mt_loaded") == "E"
    term_orig = F.when(empty | (F.col("_oz_term") == "True") | hand_o, F.lit("True")).otherwise(F.lit("False"))
    term_dest = F.when(empty | (F.col("_dz_term") == "True") | hand_d, F.lit("True")).otherwise(F.lit("False"))
    return (
        l.withColumn("term_orig", term_orig)
        .withColumn("term_dest", term_dest)
        .drop("_oz", "_dz", "_oz_term", "_dz_term", "other_first_seq", "other_last_seq")
    )


def stop_number(legdtl: DataFrame, tlorder: DataFrame, side: str, keep: Sequence[str] = ()) -> DataFrame:
    """Freight stop rows of one side ('P' or 'D', or 'PD' for both) with their stop number:
    the smallest stop order on the same leg among bills sharing the name and
    zone (origin name + start zone for pickups, destination name + end zone
    for deliveries).  A NULL name or zone gives NULL.  ``keep`` carries columns
    of ``legdtl`` along.  Grouped minimum joined
    back (partial aggregation; a hot leg is split by AQE's skew join)."""
    stops = legdtl.filter(F.col("ld_pd").isin(*side) & (F.col("ld_type") == "F")).select(
        "ld_leg_id", "ld_pd", "ld_pd_order", "ld_fb_id", *keep
    )
    pickup = F.col("ld_pd") == "P"
    t = tlorder.select("detail_line_id", *(c for k in side for c in PLACES[k]))

    def place(i: int) -> Column:
        return F.when(pickup, F.col(PLACES["P"][i])).otherwise(F.col(PLACES["D"][i])) if len(side) > 1 else F.col(PLACES[side][i])

    s = stops.join(t, stops.ld_fb_id == t.detail_line_id, "inner").select(
        "ld_leg_id", "ld_pd", "ld_pd_order", "detail_line_id", *keep, place(0).alias("_name"), place(1).alias("_zone"))
    # read by the minimum and by the join behind it: written once
    s = stage(s, f"stop-places-{side}")
    first = (
        s.filter(F.col("_name").isNotNull() & F.col("_zone").isNotNull())
        .groupBy("ld_leg_id", "ld_pd", "_name", "_zone")
        .agg(F.min("ld_pd_order").alias("stop_no"))
    )
    # read back from a written table, the minimum gets an exchange of its own in
    # the join, so a hot leg's rows can be split (they could not be if the join
    # reused the aggregate's partitioning)
    first = stage(first, f"stop-numbers-{side}")
    return s.join(first, ["ld_leg_id", "ld_pd", "_name", "_zone"], "left").select(
        "ld_leg_id", "ld_pd", "ld_pd_order", "detail_line_id", *keep, "stop_no")


def trip_endpoints(legsum: DataFrame) -> DataFrame:
    """Per trip, the first leg's origin and the last leg's destination
    (one aggregate for all trips instead of a top-1 query per trip).

    A NULL sequence ranks above every number, as in the source's database:
    it is never first while the trip has a numbered leg, and always last.
    Legs of equal sequence go by their id.
    """
    place = F.struct(F.col("ls_leg_seq").isNull().alias("unknown"), "ls_leg_seq", "ls_leg_id")
    return legsum.groupBy(F.col("ls_trip_number").alias("trip_number")).agg(
        F.min_by("lego_zone_desc", place).alias("trip_from"),
        F.max_by("legd_zone_desc", place).alias("trip_to"),
    )
