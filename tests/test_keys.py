"""Key-restricted lookups, storage by month, bounded lists."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from lorry.operators import lookups
from lorry.operators.keys import Keys, restricted
from lorry.plans import contract, intercompany
from lorry.session import ensure_checkpoint_dir
from lorry.sources import tables as sources
from lorry.sources.tables import SourceTables, Tables


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_restrict_is_a_semi_join(spark):
    rnd = random.Random(1)
    rows = [(rnd.choice([None, *range(50)]), k, None) for k in range(400)]
    table = spark.createDataFrame(rows, "a long, b long, key string")
    keys = spark.createDataFrame([(k,) for k in (3, 3, 7, None, 49, 1000)], "k long")
    more = spark.createDataFrame([(11,)], "j long")
    got = Keys((keys, "k"), (more, "j")).restrict(table, "a")
    assert got.columns == table.columns
    assert sorted(r.b for r in got.collect()) == [b for a, b, _ in rows if a in (3, 7, 49, 11)]
    assert Keys((keys.where("k < 0"), "k")).restrict(table, "a").count() == 0
    assert restricted(table, "a", None) is table
    texts = spark.createDataFrame([("3",), ("03",), ("11",), (None,)], "t string")
    assert [r.t for r in Keys((keys, "k")).texts().restrict(texts, "t").collect()] == ["3"]


def test_bounds_reach_the_scan(spark, tmp_path):
    spark.range(100).selectExpr("id as a", "id * 2 as b").write.parquet(f"{tmp_path}/t")
    got = Keys((spark.range(40, 50), "id")).restrict(spark.read.parquet(f"{tmp_path}/t"), "a")
    assert "GreaterThanOrEqual(a,40)" in plan(got) and "LessThanOrEqual(a,49)" in plan(got)


# --- the contract of chosen legs, the inter-company report of a month --------------

def _watch(monkeypatch, module, name, seen, at=0):
    real = getattr(module, name)

    def watched(*args, **kw):
        seen.setdefault(name, []).append(args[at])
        return real(*args, **kw)

    monkeypatch.setattr(module, name, watched)


def test_contract_of_legs_aggregates_their_own_rows_only(spark, sf_dir, monkeypatch):
    t, seen = Tables.at(spark, sf_dir), {}
    for name in ("trace_list", "notes_lookup", "port_of_entry", "carrier_spans", "stop_number", "terminal_flags"):
        _watch(monkeypatch, contract, name, seen)
    legs = t.legsum.orderBy("ls_leg_id").limit(5).select("ls_leg_id")
    sheet = contract.carrier_contract(t, legs)
    bills = {r[0] for r in contract.stop_rows(t, legs).select("detail_line_id").distinct().collect()}
    chosen = {r[0] for r in legs.collect()}
    trips = {r[0] for r in t.legsum.where(F.col("ls_leg_id").isin(*chosen)).select("ls_trip_number").collect()}
    trips |= {r[0] for r in t.ilegdtl.where(F.col("ild_leg_id").isin(*chosen)).select("ild_trip_number").collect()}
    assert {r[0] for r in seen["trace_list"][0].select("detail_number").distinct().collect()} <= bills
    assert {r[0] for r in seen["port_of_entry"][0].select("detail_line_id").distinct().collect()} <= bills
    assert {r[0] for r in seen["carrier_spans"][0].select("ls_trip_number").distinct().collect()} == trips
    assert {r[0] for s in seen["stop_number"] for r in s.select("ld_leg_id").distinct().collect()} <= chosen
    on_bills, on_clients = seen["notes_lookup"]
    assert {r[0] for r in on_bills.select("id_key").distinct().collect()} <= {str(b) for b in bills}
    assert on_clients.count() < t.notes.count()
    whole = contract.carrier_contract(t)
    want = whole.where(F.col("leg_id").isin(*chosen))
    assert sorted(map(str, sheet.collect())) == sorted(map(str, want.collect())) != []


def test_month_of_intercompany_reads_its_own_files_and_keys(spark, sf_dir, monkeypatch):
    t, seen = Tables.at(spark, sf_dir), {}
    for name in ("carrier_miles", "carrier_pay", "skid_units", "extra_charges"):
        _watch(monkeypatch, intercompany, name, seen)
    month = ("1996-02-01", "1996-02-29")
    rows = intercompany.intercompany_v3(t, month).collect()
    numbers = {r.bill_number for r in rows}
    assert rows and all(f"{r.actual_delivery:%Y-%m}" == "1996-02" for r in rows)
    bills = {r[0] for r in t.tlorder.where(F.col("bill_number").isin(*numbers)).select("detail_line_id").collect()}
    own = {r[0] for r in seen["carrier_pay"][0].select("detail_line_id").distinct().collect()}
    assert own and len(own) < t.order_interliner.select("detail_line_id").distinct().count() / 5
    assert {r.detail_line_id for r in t.order_interliner.where(F.col("detail_line_id").isin(*bills)).collect()} <= own
    assert {r[0] for r in seen["skid_units"][0].select("order_id").distinct().collect()} >= bills
    assert seen["skid_units"][0].count() < t.tldtl.count() / 5
    assert seen["carrier_miles"][0].count() < t.legsum.count() / 2
    read = t.period("tlorder", "actual_delivery", dt.date(1996, 2, 1), dt.date(1996, 2, 29))
    assert "PartitionFilters: [isnotnull(_month" in plan(read)
    files = read.select(F.input_file_name().alias("f")).distinct().collect()
    assert files and all("_month=1996-02/" in r.f for r in files)


def test_period_equals_a_plain_filter(spark, tmp_path):
    rows = [(k, None if k % 11 == 0 else dt.datetime(2020, 1, 1) + dt.timedelta(hours=37 * k)) for k in range(300)]
    df = spark.createDataFrame(rows, "id long, day timestamp_ntz")
    sources.by_month(df, "day").write.partitionBy(sources.MONTH).parquet(f"{tmp_path}/stored")
    stored = SourceTables(spark, {"a.bills": f"{tmp_path}/stored", "plain": df}, by_month={"a.bills": "day"})
    for begin, end in ((dt.date(2020, 2, 1), dt.date(2020, 2, 29)), (dt.date(2020, 1, 31), dt.date(2020, 4, 1)), (dt.date(2030, 1, 1), dt.date(2031, 1, 1))):
        want = sorted(i for i, d in rows if d and begin <= d.date() <= end)
        for name in ("a.bills", "plain"):
            got = stored.period(name, "day", begin, end)
            assert got.columns == ["id", "day"] and sorted(r.id for r in got.collect()) == want
    assert "PartitionFilters: [isnotnull(_month" in plan(stored.period("a.bills", "day", dt.date(2020, 2, 1), dt.date(2020, 2, 2)))
    assert stored["a.bills"].columns == ["id", "day"]


# --- bounded lists -------------------------------------------------------------------

def test_skid_units_of_an_order_with_very_many_codes(spark):
    rows = spark.range(200_000).selectExpr("1L as order_id", "concat('c', lpad(cast(id as string), 7, '0')) as pallet_units")
    odd = spark.createDataFrame([(2, None), (3, ""), (3, "b"), (3, "a"), (3, "b"), (4, "x" * 30), (4, "x" * 30 + "y")]
                                + [(5, c) for c in ["", *"zyxwvutsrqponmlkjihgfedcba"]], "order_id long, pallet_units string")
    df = lookups.skid_units(rows.union(odd))
    got = {r.order_id: r.skid_units for r in df.collect()}
    assert got == {1: "c0000000c0000001c000", 2: "", 3: "ab", 4: "x" * 20, 5: "abcdefghijklmnopqrst"}
    assert plan(df).count("WindowGroupLimit") >= 2  # one below the shuffle by order


@pytest.mark.parametrize("most", [1, 3, 7, 50_000])
def test_trace_lists_in_runs(spark, most):
    rnd = random.Random(4)
    rows = [(1, rnd.choice("BPKSV12YQ"), f"n{rnd.randrange(60):03d}", rnd.choice(["PO", "BOL"])) for _ in range(300)]
    rows += [(2, "P", "x", "PO"), (3, "1", None, "PO"), (3, "2", "z", "BOL"), (4, "Q", "no", "PO"), (5, "P", None, None), (None, "P", "q", "PO")]
    trace = spark.createDataFrame(rows, "detail_number long, trace_type string, trace_number string, trace_desc string")
    want = {}
    for bill in {r[0] for r in rows if r[1] != "Q"}:
        lists = []
        for types in (lookups.PICKUP_TRACE_TYPES, lookups.DELIVERY_TRACE_TYPES):
            lists.append(", ".join(sorted({f"{d}: {n}" for b, t, n, d in rows if b == bill and t in types and n is not None and d is not None})) or None)
        want[bill] = tuple(lists)
    got = lookups.trace_list(trace, most=most).collect()
    assert {r.detail_line_id: (r.trace_p, r.trace_d) for r in got} == want and len(got) == len(want)


def test_keys_are_written_to_the_shared_folder(spark):
    root = ensure_checkpoint_dir(spark)
    assert all(root.split(":")[-1] in f for f in Keys((spark.range(3), "id")).frame.inputFiles())
