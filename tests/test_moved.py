"""How often wide rows move: shuffles that carry a column, counted in a plan without broadcasts."""

import datetime
import decimal
import re
from contextlib import contextmanager

from pyspark.sql import functions as F

from lorry.functions import columns
from lorry.operators import lookups, numbering
from lorry.plans import ap, ar, contract, intercompany, margin
from lorry.sources import tables as sources
from lorry.sources.tables import Tables

D = decimal.Decimal


@contextmanager
def settings(spark, **conf):
    was = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in was.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def moved(spark, df, column) -> int:
    """Shuffles of ``df`` whose rows hold ``column``."""
    with settings(spark, **{"spark.sql.debug.maxToStringFields": "1000"}):
        text = df._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    inputs = re.findall(r"^\(\d+\) Exchange[^\n]*\nInput \[\d+\]: \[([^\n]*)\]$", text, re.M)
    return sum(bool(re.search(rf"\b{column}#", x)) for x in inputs)


UNJOINED = {"spark.sql.autoBroadcastJoinThreshold": "-1"}


def test_margin_rows_move_to_bills_once(spark, sf_dir):
    t = Tables.at(spark, sf_dir)
    with settings(spark, **UNJOINED):
        df = margin.gross_margin(t)
        # to carriers and two drivers (broadcast where these are few), to their bills, and by the sort
        assert moved(spark, df, "revenue_ship") == 5


def test_views_of_single_rows_are_not_copied(spark, sf_dir):
    t = Tables(spark, sf_dir)
    for name in ("trace", "rpt_gross_margin", "tlorder_customs"):
        t[name].count()
        assert not t._complete(t._prepared_path(name))
    t.legsum.count()
    assert t._complete(t._prepared_path("legsum"))


def test_receivables_of_all_batches_store_no_tables(spark, sf_dir, tmp_path):
    (tmp_path / "tables").symlink_to(sf_dir)  # what is stored is stored by path
    t = Tables(spark, f"{tmp_path}/tables")
    assert ar.ar_header_filtered(t, "trucking").count() > 0 and ar.ar_detail_late_batch(t).count() > 0
    assert not any(t._complete(t._prepared_path(name)) for name in ("tlorder", "billgl"))


def test_receivables_read_bills_once_and_sort_narrow_rows(spark, frames):
    t = frames(
        tlorder=spark.createDataFrame([(1, "C1", 202501, "False", 10, D("1.00")), (1, "C1", 202501, "False", 10, D("1.00")),
                                       (2, "C2", 202501, "False", 10, D("2.00")), (None, "C3", 202501, "False", 10, D("3.00"))],
                                      "detail_line_id long, bill_number string, interface_status_f int, extra_stops string, bill_to_code long, total_charges decimal(18,2)"),
        client=spark.createDataFrame([(10, "A")], "client_id long, user3 string"),
        trace=spark.createDataFrame([(1, "P", "N2"), (1, "P", "N1"), (1, "1", "N0"), (2, "P", "N3"), (None, "P", "N4")],
                                    "detail_number long, trace_type string, trace_number string"),
        billgl=spark.createDataFrame([(1, "02-2200-00", D("-4.00")), (1, "02-3000-00", D("5.00")), (2, "01-2200-00", D("6.00")), (None, "02-2200-00", D("7.00"))],
                                     "detail_line_id long, acct_code string, amount decimal(18,2)"),
    )
    header = ar.ar_header(t, "trucking", method="window")
    assert header._jdf.queryExecution().executedPlan().toString().count("Scan ExistingRDD") == 4
    assert [(r.cntitem, r.idinvc, r.custpo, r.texttrx) for r in header.collect()] == [(1, "C1", "N1", "1"), (2, "C1", "N1", "1")]
    with settings(spark, **UNJOINED):
        detail = ar.ar_detail(t, "trucking", method="window", segment=True, absolute=True)
        assert moved(spark, header, "swmantx") == moved(spark, detail, "distnethc") == 0
    assert [(r.cntitem, r.cntline, r.idacctrev, r.amount, r.distnethc) for r in detail.collect()] == [
        (n, line, account, amount, amount) for n in (1, 2) for line, account, amount in (("20", "3000", D("5.00")), ("40", "2200", D("4.00")))]


def test_accruals_drop_empty_bills_before_they_move_on(spark, sf_dir, tmp_path, frames):
    (tmp_path / "tables").symlink_to(sf_dir)  # what is stored is stored by path
    t = Tables(spark, f"{tmp_path}/tables")
    with settings(spark, **UNJOINED):
        header = ap.ap_user3_header(t, "2025-05-01", method="window")
        # to user fields and accruals, to bills, to vendors, to the numbering (the sort keeps its one partition)
        assert moved(spark, header, "probill") == 4 and moved(spark, header, "swmantx") == 0
    assert not t._complete(t._prepared_path("tlorder"))
    day = datetime.date(2025, 4, 1)
    oi = spark.createDataFrame([(1, 5, 100, 0, "M", "S", "PB1", day), (2, 6, 100, 200, "M", "S", "PB2", day), (3, None, None, 0, "S", "S", "PB3", None),
                                (4, 5, 100, 0, "M", "S", "PB4", day), (5, 5, 100, 0, "M", "S", "PB5", day), (None, 5, 100, 0, "M", "S", "PB6", day)],
                               "order_interliner_id long, interliner_id long, detail_line_id long, child_detail_line_id long, "
                               "child_type string, interface_status string, probill string, src_approval_date date")
    source, expense = "IP Source Register", "01-4000-00"
    gl = spark.createDataFrame([(1, source, expense, D("50.00"), D("0.00")), (1, source, expense, D("0.00"), D("20.00")), (1, source, "01-2200-00", D("9.00"), D("0.00")),
                                (2, source, expense, D("7.00"), D("0.00")), (2, source, expense, None, D("1.00")), (3, source, expense, D("0.00"), D("3.00")),
                                (4, source, "01-2200-00", D("8.00"), D("0.00")), (5, source, expense, D("4.00"), D("4.00")), (None, source, expense, D("5.00"), D("0.00"))],
                               "order_interliner_id long, source_type string, acct_code string, debit_amt decimal(18,2), credit_amt decimal(18,2)")
    t = frames(order_interliner=oi, order_interliner_userfields=oi.select("order_interliner_id"), ip_gl=gl,
               vendor=spark.createDataFrame([(5, "V5", "Five"), (6, None, "Six")], "vendor_id long, user3 string, name string"),
               tlorder=spark.createDataFrame([(100, "C100"), (100, "C100"), (200, "C200")], "detail_line_id long, bill_number string"))
    got = [(r.cntitem, r.vendid, r.idvend, r.idinvc, r.ordrnbr, r.amtgrostot) for r in ap.ap_user3_header(t, "2025-05-01").collect()]
    assert got == [(1, 5, "V5", "C100", "PB1", D("30.00")), (2, 5, "V5", "C100", "PB1", D("30.00")),
                   (3, 6, None, "C200", "PB2", D("7.00")), (4, None, None, None, "PB3", D("-3.00"))]


def test_only_raw_rows_move_into_months(spark, sf_dir, tmp_path, monkeypatch):
    t = Tables(spark, sf_dir)
    seen = []
    monkeypatch.setattr(sources, "by_month", lambda df, column: seen.append(df.columns) or df.withColumn("_month", F.date_format(column, "yyyy-MM")).hint("rebalance", "_month"))
    was = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    t._write_by_month("tlorder", f"{tmp_path}/tlorder")
    assert len(seen) == 1 and "o_orderkey" in seen[0] and "bill_number" not in seen[0]
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == was
    got = spark.read.parquet(f"{tmp_path}/tlorder").drop("_month")
    want = Tables(spark, sf_dir, prepared=False).tlorder
    assert got.count() == want.count() and not want.select(*got.columns).exceptAll(got).take(1)


def test_terminal_texts_come_last(spark, sf_dir):
    t = Tables.at(spark, sf_dir)
    df = contract.stop_rows(t)  # the zones are few: broadcast
    assert moved(spark, df, "term_origaddr1") == 0


def test_bills_of_a_sheet_move_for_their_ids_and_dimensions_only(spark, sf_dir, monkeypatch):
    t = Tables.at(spark, sf_dir)
    seen = {}
    monkeypatch.setattr(contract, "stage", lambda df, label, real=contract.stage: seen.setdefault(label, df) and real(df, label))
    with settings(spark, **UNJOINED):
        contract.carrier_contract(t)
        assert moved(spark, seen["contract-bills"], "t_origaddr1") == 2


def test_a_doubled_zone_doubles_its_stops_once(spark, frames):
    import datetime as dt

    at = dt.datetime(2024, 1, 1)
    legsum = spark.createDataFrame(
        [(1, 10, 1, 7, "L", 3, 4, at, at, 1, 1)],
        "ls_leg_id long, ls_trip_number long, ls_leg_seq int, ls_interliner long, ls_mt_loaded string, ls_from_zone int, ls_to_zone int, "
        "ls_planned_departure timestamp_ntz, ls_expected_date timestamp_ntz, ls_num_pu long, ls_num_del long")
    zone = spark.createDataFrame(
        [(3, "True", "A", "a", "b", "c", "d", "e"), (3, "True", "B", "a", "b", "c", "d", "e"), (4, "False", "C", "a", "b", "c", "d", "e")],
        "zone_id int, is_terminal string, short_description string, address1 string, address2 string, city string, province string, postal_code string")
    # one bill rides on the leg's own trip, one was booked on another trip of the same carrier, one on none
    ilegdtl = spark.createDataFrame([(1, "F", 100, 10), (1, "F", 101, 11), (1, "F", 102, None)],
                                    "ild_leg_id long, ild_res_type string, ild_fb_id long, ild_trip_number long")
    legdtl = spark.createDataFrame([(1, "P", "F", 102, 2), (1, "D", "F", 100, 5), (1, "D", "F", 101, 4)],
                                   "ld_leg_id long, ld_pd string, ld_type string, ld_fb_id long, ld_pd_order int")
    tlorder = spark.createDataFrame([(100, "N", 1, "M", 2), (101, "N", 1, "M", 2), (102, "N", 1, "M", 2)],
                                    "detail_line_id long, origname string, start_zone int, destname string, end_zone int")
    t = frames(legsum=legsum, zone=zone, ilegdtl=ilegdtl, legdtl=legdtl, tlorder=tlorder)
    got = sorted((r.ld_pd, r.detail_line_id, r.term_origname or "", r.stop_no) for r in contract.stop_rows(t).collect())
    assert got == [("D", 100, "", 4), ("D", 100, "", 4), ("D", 101, "", 4), ("D", 101, "", 4),
                   ("P", 100, "A", 1), ("P", 100, "B", 1), ("P", 102, "A", 1), ("P", 102, "B", 1)]


def test_split_bills_and_their_legs_widen_in_the_last_join(spark, sf_dir):
    t = Tables.at(spark, sf_dir)
    with settings(spark, **UNJOINED):
        df = intercompany.intercompany_v2(t, ("1990-01-01", "2030-12-31"))
        # bills to their number and their id, then the sort
        assert moved(spark, df, "origcity") + moved(spark, df, "shipper_city") == 3
        # legs to their pay, their trip and their bill, then the sort
        assert moved(spark, df, "ls_power_unit") == 4


def test_views_read_once_are_not_stored(spark, sf_dir):
    t = Tables(spark, sf_dir)
    assert t.live("order_interliner").count() == Tables(spark, sf_dir, prepared=False).order_interliner.count()
    assert "order_interliner" not in t._frames and t.live("lineitem").count() == t.lineitem.count()


def test_legs_without_a_carrier_have_no_carrier_miles(spark):
    legs = spark.createDataFrame([(1, 10, 7), (2, 10, None), (3, None, 7), (4, 11, 7)], "leg int, ls_trip_number int, ls_interliner int")
    trip = spark.createDataFrame([(10, "a"), (10, "b")], "trip_number int, name string")  # doubled; 11 is missing
    cm = spark.createDataFrame([(10, 7, 5), (10, None, 9), (11, 7, 3), (None, 7, 1)], "_cm_trip int, _cm_carrier int, total_carrier_miles long")
    got = sorted((r.leg, r.name, r.total_carrier_miles) for r in intercompany._with_trip(legs, trip, cm, None).collect())
    assert got == [(1, "a", 5), (1, "b", 5), (2, "a", None), (2, "b", None)]


def test_payables_read_two_columns_of_legs_live(spark, sf_dir):
    t = Tables(spark, sf_dir)
    for report in (ap.ap_v3_header, ap.ap_v3_detail):
        report(t, "2025-01-01")
    assert "legsum" not in t._frames


def test_detail_numbers_narrow_rows(spark, sf_dir, monkeypatch):
    seen = []
    monkeypatch.setattr(numbering, "stage", lambda df, label, real=numbering.stage: seen.append(df.columns) or real(df, label))
    ap.ap_v1_detail(Tables.at(spark, sf_dir), "2025-01-01")
    assert len(seen) == 1 and not {"probill", "description", "amtgrostot"} & set(seen[0])


def test_intercompany_of_most_bills_stores_no_tables(spark, sf_dir, tmp_path):
    (tmp_path / "tables").symlink_to(sf_dir)  # what is stored is stored by path
    t = Tables(spark, f"{tmp_path}/tables")
    with settings(spark, **UNJOINED):
        df = intercompany.intercompany_v3(t, ("1990-01-01", "2030-12-31"))
        assert moved(spark, df, "share") == 0  # it follows the sort
    assert not any(t._complete(t._prepared_path(name)) for name in ("tlorder", "legsum", "ilegdtl", "order_interliner", "trip"))


def test_dealt_views_equal_the_plain_ones_and_are_not_moved_again(spark, sf_dir):
    odd = [(1, 1, 5, 50, 1.0, 10.0, "R", "F"), (1, 1, 4, 60, 2.0, 20.0, "A", "O"), (1, 2, 3, None, None, 30.0, None, "F"), (None, 1, 2, 70, 4.0, 5.0, "N", None),
           (2, None, 1, 80, 5.0, 50.0, "R", "O"), (None, None, 7, 80, 6.0, None, "R", "O"), (1, 11, 9, 90, 7.0, 70.0, "A", "F"), (2, 1, 9, 90, 8.0, 80.0, "A", "F")]
    lineitem = spark.createDataFrame(
        [(*r[:2], *r[2:], datetime.datetime(2020, 1, i + 1)) for i, r in enumerate(odd)],
        "l_orderkey long, l_linenumber int, l_suppkey long, l_partkey long, l_quantity double, l_extendedprice double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz")
    hand = Tables(spark, sf_dir, prepared=False)
    hand._frames["lineitem"] = lineitem
    for t in (Tables(spark, sf_dir, prepared=False), hand):
        for name, column in [*sources.DEALT, *sources.DEALT_BELOW]:
            got, want = t.live(name, by=column), t.live(name)
            assert got.columns == want.columns and got.count() == want.count() > 0
            assert not got.exceptAll(want).take(1) and not want.exceptAll(got).take(1), (name, column)
            plan = got.groupBy(column).count()._jdf.queryExecution().executedPlan().toString()
            assert plan.count("Exchange hashpartitioning") == (2 if name in ("ilegdtl", "legdtl") else 1), (name, plan)


def test_long_periods_are_read_live_unless_the_months_are_stored(spark, sf_dir, tmp_path):
    (tmp_path / "tables").symlink_to(sf_dir)
    t, day = Tables(spark, f"{tmp_path}/tables"), datetime.date
    whole = t.period("tlorder", "actual_delivery", day(1990, 1, 1), day(2030, 12, 31))
    assert not t._written("tlorder") and whole.count() == t.live("tlorder").where("actual_delivery is not null").count() > 0
    month = t.period("tlorder", "actual_delivery", day(1996, 2, 1), day(1996, 2, 29))
    assert t._written("tlorder") and month.count() == whole.where("actual_delivery between '1996-02-01' and '1996-02-29'").count()
    assert "_month" in t.period("tlorder", "actual_delivery", day(1990, 1, 1), day(2030, 12, 31))._jdf.queryExecution().optimizedPlan().toString()


def test_pay_and_miles_go_to_the_legs_of_their_carrier(spark):
    x = spark.createDataFrame([(1, 10, 7), (2, 10, 8), (3, 10, None)], "leg int, ls_trip_number int, ls_interliner int")
    trip = spark.createDataFrame([(10, "a"), (None, "b")], "trip_number int, name string")
    cm = spark.createDataFrame([(10, 7, 5), (10, 9, 6), (10, None, 9)], "_cm_trip int, _cm_carrier int, total_carrier_miles long")
    got = intercompany._with_trip(x, trip, cm, None)
    assert sorted((r.leg, r.name, r.total_carrier_miles) for r in got.collect()) == [(1, "a", 5), (2, "a", None), (3, "a", None)]
    with settings(spark, **UNJOINED):
        assert moved(spark, intercompany._with_trip(x, trip, cm, None), "leg") == 1


def test_margin_bills_move_once_before_their_trips_and_are_not_stored(spark, sf_dir, tmp_path):
    (tmp_path / "tables").symlink_to(sf_dir)  # what is stored is stored by path
    t = Tables(spark, f"{tmp_path}/tables")
    with settings(spark, **UNJOINED):
        df = margin.gross_margin(t)
        # to their site (broadcast where sites are few), to their trips' rows, with these to the legs, and by the sort
        assert moved(spark, df, "shipper_address1") == 4 and moved(spark, df, "tlt_charge") == moved(spark, df, "hazmat") == 0
    assert not t._written("tlorder")


def test_lookup_with_a_condition_beside_the_key(spark):
    df = spark.createDataFrame([(1, 5, "a"), (1, 6, "b"), (1, None, "c"), (None, 5, "d"), (2, 5, "e")], "k int, m int, v string")
    table = spark.createDataFrame([(1, 5, "x"), (1, 5, "y"), (1, 7, "z"), (None, 5, "n"), (2, None, "o")], "k int, n int, w string")
    got = lookups.lookup(df, table, "k", ("v",), also=lookups.beside("m", "n"))
    assert got.columns == ["k", "m", "v", "_spread_k", "n", "w"]
    key = lambda r: tuple(x or "" for x in r)
    assert sorted(((r.v, r.w) for r in got.collect()), key=key) == [("a", "x"), ("a", "y"), ("b", None), ("c", None), ("d", None), ("e", None)]


def test_decimals_are_held_narrow_only_if_all_fit(spark):
    df = spark.createDataFrame([(D("1.25"), D("9999999999999999.99"), D("1.5")), (D("-3.00"), D("-10000000000000000.00"), None), (None, None, None)],
                               "a decimal(24,2), b decimal(24,2), c decimal(10,2)")
    narrow, own = columns.held_narrow(df, ["a", "b", "c"])
    assert [narrow.schema[c].dataType.simpleString() for c in "abc"] == ["decimal(18,2)", "decimal(24,2)", "decimal(10,2)"]
    back = narrow.select(*[own(c) for c in "abc"])
    assert back.schema == df.schema and sorted(map(str, back.collect())) == sorted(map(str, df.collect()))
    empty, own = columns.held_narrow(df.where("a > 5"), ["a", "b"])
    assert empty.select(own("a")).schema["a"].dataType == df.schema["a"].dataType and empty.count() == 0


def test_grouped_views_move_raw_rows_and_nothing_else(spark, sf_dir):
    t = Tables(spark, sf_dir, prepared=False)
    for name in sources.GROUPED:
        text = t[name]._jdf.queryExecution().executedPlan().toString()
        moves = [line for line in text.splitlines() if "Exchange" in line]
        assert moves and all("REPARTITION_BY_COL" in line for line in moves), (name, text)


def test_a_sheet_of_all_legs_stores_no_bills_and_zones_of_its_legs_once(spark, sf_dir, tmp_path, monkeypatch):
    (tmp_path / "tables").symlink_to(sf_dir)  # what is stored is stored by path
    t, seen = Tables(spark, f"{tmp_path}/tables"), []
    monkeypatch.setattr(contract, "stage", lambda df, label, real=contract.stage: seen.append(label) or real(df, label))
    assert contract.carrier_contract(t).count() > 0
    assert seen.count("contract-stops-zones") == 1
    assert not t._written("tlorder")
