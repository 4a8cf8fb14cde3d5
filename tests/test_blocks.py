"""Hand-made fixtures for the traps and the building blocks."""

import datetime as dt
import decimal
import random

import pytest
from pyspark.sql import functions as F

from lorry.functions.columns import account_segment, blank_to_nbsp, guarded_ratio, non_blank, prorate, share
from lorry.operators.legs import split_bills, stop_number, terminal_flags, trip_endpoints
from lorry.operators.lookups import first_trace, skid_units, trace_list
from lorry.operators.numbering import number_items
from lorry.plans import period, trips

D = decimal.Decimal


def rows(df, *cols):
    return [tuple(r) for r in df.select(*cols).collect()]


# --- T9: account without a second hyphen ---------------------------------------
def test_account_segment(spark):
    df = spark.createDataFrame([("01-4000-00",), ("01-4000",), ("0140000",), (None,), ("02-2210-00-9",)], "a string")
    got = [r[0] for r in df.select(account_segment("a")).collect()]
    assert got == ["4000", None, None, None, "2210"]


# --- T10 / F18 / B19: guarded division and proration ------------------------------
def test_guarded_ratio_and_prorate(spark):
    df = spark.createDataFrame([(D("100.00"), 1, 3), (D("100.00"), 2, 0), (D("100.00"), 2, None), (None, 1, 2),
                                (D("0.05"), 1, 2)],
                               "amt decimal(18,2), part bigint, whole bigint")
    got = [r[0] for r in df.select(prorate("amt", "part", "whole")).collect()]
    assert got == [D("33.33"), D("0.00"), D("0.00"), D("0.00"), D("0.03")]  # half-up: 0.025 -> 0.03
    sh = [r[0] for r in df.select(share("part", "whole")).collect()]
    assert sh == [D("0.33"), D("0.00"), D("0.00"), D("0.50"), D("0.50")]
    assert df.select(guarded_ratio("part", "whole")).count() == 5


# --- B27 / F20 ------------------------------------------------------------------------
def test_blank_rules(spark):
    df = spark.createDataFrame([("x",), ("   ",), ("",), (None,)], "s string")
    assert [r[0] for r in df.select(blank_to_nbsp("s")).collect()] == ["x", " ", " ", " "]
    assert [r[0] for r in df.select(non_blank("s")).collect()] == [True, False, False, None]


# --- B2: distributed numbering == window numbering, with a hot batch ---------------------
@pytest.mark.parametrize("partitions", [None, 1, 3, 16])
def test_number_items_range_equals_window(spark, partitions):
    rnd = random.Random(7)
    data = []
    for i in range(3000):
        batch = 1 if i % 3 == 0 else rnd.choice([2, 3, 4, None])  # batch 1 holds a third of the rows
        data.append((i, batch, rnd.choice(["a", "b", None]), f"k{rnd.randint(0, 50):03d}"))
    df = spark.createDataFrame(data, "id long, batch int, u string, k string")
    order = [F.col("u").asc_nulls_last(), F.col("k"), F.col("id")]
    a = number_items(df, ["batch"], order, out="n", method="range", partitions=partitions)
    b = number_items(df, ["batch"], order, out="n", method="window")
    assert sorted(rows(a, "id", "n")) == sorted(rows(b, "id", "n"))
    # dense 1..n per batch
    per = a.groupBy("batch").agg(F.min("n").alias("lo"), F.max("n").alias("hi"), F.count("*").alias("c")).collect()
    assert all(r.lo == 1 and r.hi == r.c for r in per)


def test_number_items_is_stable_under_column_pruning(spark):
    df = spark.range(0, 5000).select(F.col("id"), (F.col("id") % 2).alias("b"), (F.col("id") * 7 % 13).alias("k"))
    n = number_items(df, ["b"], [F.col("k"), F.col("id")], out="n")
    full = n.collect()
    assert len(full) == 5000 and n.count() == 5000
    assert sorted(r.n for r in full if r.b == 0) == list(range(1, 2501))


# --- T1/T2: NULL last, linguistic order --------------------------------------------------
def test_leg_destinations_order(spark, frames):
    names = ["lowport, xx", "lowport-upper, xx", "lowport-inner, xx", None, "7 elms, yy", "acorn hill, yy"]
    legsum = spark.createDataFrame([(n,) for n in names], "legd_zone_desc string")
    got = [r[0] for r in trips.leg_destinations(frames(legsum=legsum)).collect()]
    assert got == ["7 ELMS, YY", "ACORN HILL, YY", "LOWPORT-INNER, XX", "LOWPORT-UPPER, XX", "LOWPORT, XX", None]


# --- R9: trip endpoints -----------------------------------------------------------------
def test_trip_endpoints(spark):
    legsum = spark.createDataFrame(
        [(1, 2, 11, "B", "C"), (1, 1, 12, "A", "B"), (1, 3, 13, "C", "D"), (2, 5, 21, "X", "Y"),
         (3, 1, 32, "late id", "E"), (3, 1, 31, "early id", "F"),  # equal sequences go by the leg id
         (4, None, 41, "G", "unknown is last"), (4, 7, 42, "known is first", "H"), (5, None, 51, "I", "J")],
        "ls_trip_number long, ls_leg_seq long, ls_leg_id long, lego_zone_desc string, legd_zone_desc string")
    assert sorted(rows(trip_endpoints(legsum), "trip_number", "trip_from", "trip_to")) == [
        (1, "A", "D"), (2, "X", "Y"), (3, "early id", "E"), (4, "known is first", "unknown is last"), (5, "I", "J")]


# --- B13 / T20: split bills counted over all legs of the bill ------------------------------
def test_split_bills(spark):
    bridge = spark.createDataFrame([
        (10, "F", 1), (10, "D", None), (11, "F", 1), (11, "I", None),  # bill 1: D on leg 10, I on leg 11
        (20, "F", 2), (20, "D", None),                                   # bill 2: driver only
        (30, "F", 3), (30, "D", None), (30, "I", None),                  # bill 3: both on one leg
    ], "ild_leg_id long, ild_res_type string, ild_fb_id long")
    assert sorted(rows(split_bills(bridge), "ild_fb_id", "res_count")) == [(1, 2), (3, 2)]


# --- B18: hand-over with a NULL carrier inside the trip --------------------------------------
def test_terminal_flags_null_carrier(spark):
    legs = spark.createDataFrame([
        (1, 7, 1, None, "L", 1, 1), (2, 7, 2, 5, "L", 1, 1), (3, 7, 3, 6, "L", 1, 1), (4, 7, 4, 5, "L", 1, 99),
    ], "ls_leg_id long, ls_trip_number long, ls_leg_seq long, ls_interliner long, ls_mt_loaded string, "
       "ls_from_zone long, ls_to_zone long")
    for c, v in (("ls_planned_departure", None), ("ls_expected_date", None), ("ls_num_pu", 1), ("ls_num_del", 2)):
        legs = legs.withColumn(c, F.lit(v))
    zone = spark.createDataFrame([(1, "Z1", "P1", "False", "a", None, "c", "pc")],
                                 "zone_id long, short_description string, province string, is_terminal string, "
                                 "address1 string, address2 string, city string, postal_code string")
    got = {r.ls_leg_id: (r.term_orig, r.term_dest) for r in terminal_flags(legs, zone).collect()}
    # leg 4 has an unknown destination zone -> dropped (inner join)
    # leg 1: NULL carrier -> never a hand-over; leg 2: carrier 5's first leg, only a NULL carrier earlier -> False
    # leg 3: carrier 6's only leg, carrier 5 earlier (leg 2) and later (leg 4) -> both True
    assert got == {1: ("False", "False"), 2: ("False", "False"), 3: ("True", "True")}


# --- B20: stop number shared by same-name pickups on a leg ------------------------------------
def test_stop_number(spark):
    legdtl = spark.createDataFrame([(100, "P", "F", 1, 4), (100, "P", "F", 2, 2), (100, "P", "F", 3, 3),
                                    (100, "D", "F", 1, 9)],
                                   "ld_leg_id long, ld_pd string, ld_type string, ld_fb_id long, ld_pd_order int")
    tl = spark.createDataFrame([(1, "ACME", 5, "X", 1), (2, "ACME", 5, "Y", 1), (3, None, 5, "Y", 1)],
                               "detail_line_id long, origname string, start_zone long, destname string, end_zone long")
    got = sorted(rows(stop_number(legdtl, tl, "P"), "detail_line_id", "stop_no"))
    assert got == [(1, 2), (2, 2), (3, None)]


# --- B4 / B5 / B15: deterministic picks and lists ------------------------------------------
def test_trace_lookups(spark):
    trace = spark.createDataFrame([
        (1, "P", "PO9", "A"), (1, "P", "PO1", "A"), (1, "1", "BOL", "B"), (1, "2", "DEL", "C"), (1, "B", "X", "D"),
        (1, "B", "X", "D"), (2, "9", "ORD", "E"),
    ], "detail_number long, trace_type string, trace_number string, trace_desc string")
    ft = {r.detail_line_id: (r.po, r.bol) for r in first_trace(trace, {"po": "P", "bol": "1"}).collect()}
    assert ft == {1: ("PO1", "BOL")}
    tl = {r.detail_line_id: (r.trace_p, r.trace_d) for r in trace_list(trace).collect()}
    assert tl[1] == ("A: PO1, A: PO9, B: BOL, D: X", "A: PO1, A: PO9, C: DEL, D: X")
    tldtl = spark.createDataFrame([(1, "PUR"), (1, "PUA"), (1, "PUR"), (2, "X" * 30)], "order_id long, pallet_units string")
    su = {r.order_id: r.skid_units for r in skid_units(tldtl).collect()}
    assert su == {1: "PUAPUR", 2: "X" * 20}


# --- R15: period bounds and run note ----------------------------------------------------------
def test_period_bounds(spark):
    r = period.period_bounds(spark, "2025-05-15").collect()[0]
    assert (r.detail, r.first_day_last_month, r.last_day_last_month, r.date_begin, r.date_end) == (
        "Detail", dt.date(2025, 4, 1), dt.date(2025, 4, 30), "04/01/2025", "04/30/2025")
    r = period.period_bounds(spark, "2025-03-31").collect()[0]
    assert (r.first_day_last_month, r.last_day_last_month) == (dt.date(2025, 2, 1), dt.date(2025, 2, 28))
    note = period.report_run_note(spark, dt.datetime(2025, 4, 17, 9, 5, 1)).collect()[0][0]
    assert note == "This report was run on 04/17/2025 at 09:05:01"


# --- T2 inside ROW_NUMBER: item numbers follow the linguistic order ----------------------
def test_numbering_uses_linguistic_order(spark, frames):
    from lorry.plans import ar

    custs = ["LOWPORT, XX", "LOWPORT-UPPER", "LOWPORT-INNER", None]
    tl = spark.createDataFrame([(i + 1, f"C{i:03d}", 202501, "False", i + 10, D("1.00")) for i in range(4)],
                               "detail_line_id long, bill_number string, interface_status_f int, extra_stops string, "
                               "bill_to_code long, total_charges decimal(18,2)")
    t = frames(tlorder=tl,
               client=spark.createDataFrame([(i + 10, c) for i, c in enumerate(custs)], "client_id long, user3 string"),
               trace=spark.createDataFrame([], "detail_number long, trace_type string, trace_number string, trace_desc string"))
    for method in ("range", "window"):
        got = [r.idcust for r in ar.ar_header(t, None, None, method=method).collect()]
        assert got == ["LOWPORT-INNER", "LOWPORT-UPPER", "LOWPORT, XX", None]


def test_schema_qualified_table_names(spark, sf_dir):
    from lorry.sources.tables import Tables

    t = Tables.at(spark, sf_dir)
    assert t["OPS.LEGSUM"] is t.legsum
    assert t["ZONE"].columns[:2] == ["zone_id", "short_description"]


def test_rtrim_on_load(spark):  # T5
    from lorry.sources.tables import rtrim_strings

    df = spark.createDataFrame([("ab  ", 1, "  x "), (None, 2, "")], "a string, n int, b string")
    assert [tuple(r) for r in rtrim_strings(df).collect()] == [("ab", 1, "  x"), (None, 2, "")]


def test_number_items_edge_inputs(spark):
    empty = spark.createDataFrame([], "id long, b int, k string")
    assert number_items(empty, ["b"], [F.col("k"), F.col("id")], out="n").count() == 0
    nulls = spark.createDataFrame([(i, None, f"k{i % 7}") for i in range(200)], "id long, b int, k string")
    a = number_items(nulls, ["b"], [F.col("k"), F.col("id")], out="n", partitions=4)
    w = number_items(nulls, ["b"], [F.col("k"), F.col("id")], out="n", method="window")
    assert sorted(rows(a, "id", "n")) == sorted(rows(w, "id", "n"))
    assert sorted(r.n for r in a.collect()) == list(range(1, 201))


# --- rows without a key do not meet in one task --------------------------------------------
def test_lookup_spreads_rows_without_key(spark):
    from pyspark.sql import functions as F

    from lorry.operators.lookups import lookup

    df = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, F.col("id")).alias("k"))
    table = spark.range(0, 3000, 2).select(F.col("id").alias("k"), F.lit("v").alias("v"))
    kept = {c: spark.conf.get(c) for c in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        out = lookup(df, table, "k", ("id",))
        sizes = [r["count"] for r in out.withColumn("p", F.spark_partition_id()).where("k is null").groupBy("p").count().collect()]
        got = sorted((r.id, r.v) for r in out.collect())
    finally:
        for c, v in kept.items():
            spark.conf.set(c, v)
    assert sum(sizes) == 2000 and max(sizes) < 600
    assert [g[0] for g in got] == list(range(3000)) and all((v == "v") == (i % 6 == 0) for i, v in got)


# --- branches that no registered row reaches -------------------------------------------------
def test_latest_audit_of_one_register_and_its_companies(spark):
    from lorry.operators.lookups import latest_audit

    audits = spark.createDataFrame([("Billing Register", 0, 202501), ("Billing Register", 1, 202503), ("Billing Register", 2, 202509),
                                    ("IP Register", 0, 202512), ("Billing Register", None, 202511)],
                                   "source_reg string, company_id int, source_audit int")
    assert latest_audit(audits).first()[0] == 202503


def test_port_of_entry_of_the_default_broker(spark):
    from lorry.operators.lookups import port_of_entry

    customs = spark.createDataFrame([(1, "True", "CA", "0901"), (1, "False", "CA", "0902"), (2, "True", None, "0901"), (3, None, "CA", "0901")],
                                    "detail_line_id long, default_broker string, orig_country string, port_of_entry string")
    codes = "seg_name string, ele_nbr int, value string, description string"
    ace = spark.createDataFrame([("PR", 1, "0901", "ace port"), ("XX", 1, "0901", "other segment")], codes)
    aci = spark.createDataFrame([("PR", 1, "0901", "aci port")], codes)
    assert sorted(rows(port_of_entry(customs, ace, aci), "detail_line_id", "port_of_entry")) == [(1, "ace port"), (2, "aci port")]


@pytest.mark.parametrize("hub, picked_up", [("RR-7", True), ("XX-7", False)])
def test_pickups_at_rail_zones(spark, frames, hub, picked_up):
    """A terminal that is neither the carrier's first place nor the bill's own stop: a pickup at RR- zones only."""
    from lorry.plans import contract

    day = dt.datetime(2025, 1, 2)
    t = frames(
        legsum=spark.createDataFrame([(10, 1, 1, 5, "L", "A", hub, day, day, 1, 1), (20, 1, 2, 5, "L", hub, "B", day, day, 1, 1)],
                                     "ls_leg_id long, ls_trip_number long, ls_leg_seq long, ls_interliner long, ls_mt_loaded string, ls_from_zone string, "
                                     "ls_to_zone string, ls_planned_departure timestamp_ntz, ls_expected_date timestamp_ntz, ls_num_pu int, ls_num_del int"),
        zone=spark.createDataFrame([(z, z, "1", None, "c", "p", "pc", str(z == hub)) for z in ("A", "B", hub)],
                                   "zone_id string, short_description string, address1 string, address2 string, city string, province string, "
                                   "postal_code string, is_terminal string"),
        tlorder=spark.createDataFrame([(7, "N", "M", 1, 2)], "detail_line_id long, origname string, destname string, start_zone int, end_zone int"),
        ilegdtl=spark.createDataFrame([(10, "F", 7, 1), (20, "F", 7, 1)], "ild_leg_id long, ild_res_type string, ild_fb_id long, ild_trip_number long"),
        legdtl=spark.createDataFrame([(10, "P", 1, 7, "F"), (20, "D", 2, 7, "F")],
                                     "ld_leg_id long, ld_pd string, ld_pd_order long, ld_fb_id long, ld_type string"),
    )
    got = rows(contract.stop_rows(t).where("leg_id = 20 and ld_pd = 'P'"), "detail_line_id", "term_origname")
    assert got == ([(7, hub)] if picked_up else [])
