"""Report-level traps on hand-made frames, and variants that must differ on
the fixture (otherwise the fixture could not tell them apart)."""

import datetime as dt
import decimal

from pyspark.sql import functions as F

import __spark_entry__ as entry
from lorry.plans import ap, ar, pay

D = decimal.Decimal


def test_null_pay_code_counts_as_hours(spark, frames):  # T11
    t = frames(
        dr_stmt_report=spark.createDataFrame([(1, "COMPANY DRIVER", dt.datetime(2025, 4, 17), D("10.00"))],
                                             "statement_id long, pay_type string, statement_date timestamp_ntz, check_amt decimal(18,2)"),
        driverpay=spark.createDataFrame([(1, 7, D("5.00"), D("3.00"), None, 0), (1, 7, D("6.00"), D("2.00"), "HOUR OVER", 1)],
                                        "statement_id long, driver_id long, total_pay_amt decimal(18,2), hours decimal(9,2), pay_code string, rule_id long"),
        driverdeductions=spark.createDataFrame([(1, 7, D("4.00"))], "statement_id long, driver_id long, ded_amt decimal(18,2)"),
        driver=spark.createDataFrame([(7, "Pat Example")], "driver_id long, name string"),
        drv_rule_mile=spark.createDataFrame([(0, "SUBSISTANCE"), (1, None)], "rule_id long, user1 string"),
    )
    got = sorted((r.subsistance, r.hours, r.overtime, r.other, r.net) for r in pay.driver_pay(t, "04/17/2025").collect())
    assert got == sorted([(D("5.00"), D("3.00"), D("0.00"), D("0.00"), D("5.00")),
                          (D("0.00"), D("0.00"), D("2.00"), D("6.00"), D("6.00")),
                          (D("0.00"), D("0.00"), D("0.00"), D("0.00"), D("-4.00"))])
    s = pay.driver_pay_summary(t).collect()[0]
    assert s.net == s.subsistance + s.other - D("4.00")


def test_child_filter_drops_null(spark, frames):  # T17, and numbering per batch
    tl = spark.createDataFrame([
        (1, "C1", 202501, "False", 10, D("1.00")), (2, "C2", 202501, None, 10, D("2.00")),
        (3, "C3", 202501, "Child", 10, D("3.00")), (4, "C4", 202502, "False", 11, D("4.00")),
        (5, "C5", -1, "False", 10, D("5.00")),
    ], "detail_line_id long, bill_number string, interface_status_f int, extra_stops string, bill_to_code long, total_charges decimal(18,2)")
    t = frames(
        tlorder=tl,
        client=spark.createDataFrame([(10, "CUST A"), (11, None)], "client_id long, user3 string"),
        trace=spark.createDataFrame([(1, "P", "PO1", "A")], "detail_number long, trace_type string, trace_number string, trace_desc string"),
        billgl=spark.createDataFrame([(1, "01-2200-00", D("1.00"))], "detail_line_id long, acct_code string, amount decimal(18,2)"),
    )
    got = sorted((r.cntbtch, r.cntitem, r.idinvc, r.custpo) for r in ar.ar_header_all(t).collect())
    assert got == [(202501, 1, "C1", "PO1"), (202502, 1, "C4", None)]


def test_abs_rule_keeps_offsetting_lines_signed_rule_drops_them(spark, frames):  # T18
    oi = spark.createDataFrame([(1, 5, 100, 0, "M", "S", "PB1", dt.date(2025, 4, 1))],
                               "order_interliner_id long, interliner_id long, detail_line_id long, child_detail_line_id long, "
                               "child_type string, interface_status string, probill string, src_approval_date date")
    gl = spark.createDataFrame([(1, "IP Source Register", "01-4000-00", D("50.00"), D("0.00")),
                                (1, "IP Source Register", "01-4000-00", D("0.00"), D("50.00"))],
                               "order_interliner_id long, source_type string, acct_code string, debit_amt decimal(18,2), credit_amt decimal(18,2)")
    t = frames(order_interliner=oi, order_interliner_userfields=oi.select("order_interliner_id"), ip_gl=gl,
               vendor=spark.createDataFrame([(5, "V5", "Vendor Five")], "vendor_id long, user3 string, name string"),
               tlorder=spark.createDataFrame([(100, "C00000100")], "detail_line_id long, bill_number string"))
    h = ap.ap_v1_header(t, "2025-05-01").collect()
    assert [(r.cntbtch, r.cntitem, r.idinvc, r.amtgrostot) for r in h] == [("250501", 1, "C00000100", D("100.00"))]
    assert ap.ap_user3_header(t, "2025-05-01").count() == 0


def _rows(spark, sf_dir, key):
    return sorted(map(repr, entry.queries()[key](spark, sf_dir).collect()))


def test_variants_differ_on_fixture(spark, sf_dir):
    assert _rows(spark, sf_dir, "driver_pay_carry") != _rows(spark, sf_dir, "driver_pay_show")
    before = entry.queries()["ar_header_current_control"](spark, sf_dir)
    # number-before-filter leaves gaps: the largest item number exceeds the row count
    assert before.agg(F.max("cntitem")).collect()[0][0] > before.count()
    assert _rows(spark, sf_dir, "ap_v1_header") != _rows(spark, sf_dir, "ap_user3_header")
    assert _rows(spark, sf_dir, "ar_detail_filtered_v1_control") != _rows(spark, sf_dir, "ar_detail_filtered_v2_control")
    assert _rows(spark, sf_dir, "trace_list") != _rows(spark, sf_dir, "trace_list_y")


def test_trip_header_grain_v2_vs_v3(spark, frames):  # T4: two probills on one trip
    oi = spark.createDataFrame([
        (11, 5, 1, 110, 0, "M", "S", "PB1", dt.date(2025, 4, 1)),
        (12, 5, 1, 120, 0, "M", "S", "PB2", dt.date(2025, 4, 1)),
    ], "order_interliner_id long, interliner_id long, detail_line_id long, legid long, child_detail_line_id long, "
       "child_type string, interface_status string, probill string, src_approval_date date")
    gl = spark.createDataFrame([(11, "IP Source Register", "01-4000-00", D("10.00"), D("0.00")),
                                (12, "IP Source Register", "01-4000-00", D("0.00"), D("5.00"))],
                               "order_interliner_id long, source_type string, acct_code string, debit_amt decimal(18,2), credit_amt decimal(18,2)")
    legsum = spark.createDataFrame([(110, 900), (120, 900)], "ls_leg_id long, ls_trip_number long")
    t = frames(order_interliner=oi, order_interliner_userfields=oi.select("order_interliner_id"), ip_gl=gl, legsum=legsum,
               vendor=spark.createDataFrame([(5, "V5", "Vendor Five")], "vendor_id long, user3 string, name string"))
    v2 = sorted((r.cntitem, r.idinvc, r.ordrnbr, r.amtgrostot) for r in ap.ap_v2_header(t, "2025-05-01").collect())
    v3 = sorted((r.cntitem, r.idinvc, r.ordrnbr, r.amtgrostot) for r in ap.ap_v3_header(t, "2025-05-01").collect())
    assert v2 == [(1, 900, "PB1", D("10.00")), (2, 900, "PB2", D("5.00"))]
    assert v3 == [(1, 900, "PB2", D("15.00"))]
    d = [(r.cntitem, r.idglacct, r.amtdist) for r in ap.ap_v2_detail(t, "2025-05-01").collect()]
    assert d == [(1, "4000", D("15.00"))]


def test_safe_zone_removes_duplicates(spark):
    from lorry.operators.lookups import safe_zone

    zone = spark.createDataFrame([(1, "P1", "False"), (1, "P2", "True"), (2, "P3", "False")],
                                 "zone_id long, province string, is_terminal string")
    assert sorted(tuple(r) for r in safe_zone(zone).collect()) == [(1, "P2", "True"), (2, "P3", "False")]


def test_last_month_parameters(spark):
    from lorry.plans import intercompany as ic, period

    assert ic.last_month("2025-05-15") == (dt.date(2025, 4, 1), dt.date(2025, 4, 30))
    assert ic.last_month("01/10/2025") == (dt.date(2024, 12, 1), dt.date(2024, 12, 31))
    r = period.period_bounds(spark, "2025-05-15").collect()[0]
    assert ic.last_month("2025-05-15") == (r.first_day_last_month, r.last_day_last_month)


def test_intercompany_last_month_is_the_month(spark, sf_dir):
    from lorry.plans import intercompany as ic
    from lorry.sources.tables import Tables

    t = Tables.at(spark, sf_dir)
    df = ic.intercompany_last_month(t, "1998-07-15")
    days = df.select(F.min("actual_delivery"), F.max("actual_delivery")).collect()[0]
    assert df.count() > 0 and days[0] >= dt.date(1998, 6, 1) and days[1] <= dt.date(1998, 6, 30)
    full = ic.intercompany_v3(t, ("1998-06-01", "1998-06-30"))
    assert sorted(map(repr, df.collect())) == sorted(map(repr, full.collect()))


def test_contract_for_some_legs_equals_all_legs_filtered(spark, sf_dir):
    """The sheet of single legs = the whole sheet filtered to those legs: the
    legs picked cut through trips, and flags still see the whole trip."""
    from lorry.operators.legs import terminal_flags
    from lorry.plans import contract
    from lorry.sources.tables import Tables

    t = Tables.at(spark, sf_dir)
    some = t.legsum.filter(F.col("ls_leg_id") % 2 == 0).select("ls_leg_id")
    cut = t.legsum.groupBy("ls_trip_number").agg(F.count_if(F.col("ls_leg_id") % 2 == 0).alias("n"), F.count("*").alias("all"))
    assert cut.where("n > 0 and n < all").count() > 0
    flags = sorted(map(repr, terminal_flags(t.legsum, t.zone, some).collect()))
    every = terminal_flags(t.legsum, t.zone).join(some, "ls_leg_id", "left_semi").select(*terminal_flags(t.legsum, t.zone).columns)
    assert flags == sorted(map(repr, every.collect()))
    part = contract.carrier_contract(t, leg_ids=some)
    full = contract.carrier_contract(t).join(some.withColumnRenamed("ls_leg_id", "leg_id"), "leg_id", "left_semi")
    a, b = sorted(map(repr, part.collect())), sorted(map(repr, full.select(*part.columns).collect()))
    assert len(a) > 0 and a == b
