"""Every registered report: key -> (Spark job, oracle SQL or None).

``__spark_entry__`` exposes these to the driver; tests and the bench use
the same table.  Each Spark job reads the whole fixture tables at ``sf_dir``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lorry import oracle as O
from lorry.operators import legs as LG, lookups as LK
from lorry.plans import ap, ar, contract, intercompany as ic, margin, pay, period, stop_sheet, trips
from lorry.session import ensure_checkpoint_dir
from lorry.sources.tables import Tables

Job = Callable[[Tables], DataFrame]

REPORTS: dict[str, tuple[Job, str | None]] = {}


def register(key: str, job: Job, sql: str | None) -> None:
    if key in REPORTS:
        raise ValueError(f"duplicate key {key}")
    REPORTS[key] = (job, O.with_fixtures(sql) if sql else None)


# --- accounts receivable (R1-R6) -------------------------------------------
register("ar_header_all", lambda t: ar.ar_header_all(t), O.ar_header_sql())
register("ar_detail_all", lambda t: ar.ar_detail_all(t), O.ar_detail_sql())
for _co in ("control", "trucking"):
    register(f"ar_header_filtered_{_co}", lambda t, c=_co: ar.ar_header_filtered(t, c), O.ar_header_sql(_co, None, "after"))
    register(f"ar_detail_filtered_v1_{_co}", lambda t, c=_co: ar.ar_detail_filtered(t, c), O.ar_detail_sql(_co))
    register(f"ar_detail_filtered_v2_{_co}", lambda t, c=_co: ar.ar_detail_filtered(t, c, segment=True),
             O.ar_detail_sql(_co, segment=True))
    register(f"ar_header_current_{_co}", lambda t, c=_co: ar.ar_header_current(t, c), O.ar_header_sql(_co, "latest", "before"))
    register(f"ar_detail_current_{_co}", lambda t, c=_co: ar.ar_detail_current(t, c),
             O.ar_detail_sql(_co, "latest", segment=True, absolute=True))


# one audit batch, the form in which the source asks for it
AUDIT = 199503
register("ar_header_audit", lambda t: ar.ar_header_all(t, AUDIT), O.ar_header_sql(None, AUDIT))
register("ar_detail_audit", lambda t: ar.ar_detail_all(t, AUDIT), O.ar_detail_sql(None, AUDIT))
# item numbers kept in a store: the newest batch arrives after the others were numbered
register("ar_detail_late_batch", lambda t: ar.ar_detail_late_batch(t), O.ar_detail_sql())
register("account_quality", lambda t: LK.account_quality(t.billgl), O.ACCOUNT_QUALITY)


# --- accounts payable (R7, R8a-g) ---------------------------------------------
AS_OF = O.AS_OF
register("ap_register_header", lambda t: ap.ap_register_header(t), O.ap_register_sql())
register("ap_register_detail", lambda t: ap.ap_register_detail(t), O.ap_register_sql(detail=True))
register("ap_v1_header", lambda t: ap.ap_v1_header(t, AS_OF), O.ap_v1_header_sql())
register("ap_v1_detail", lambda t: ap.ap_v1_detail(t, AS_OF), O.ap_v1_detail_sql())
register("ap_v2_header", lambda t: ap.ap_v2_header(t, AS_OF), O.ap_trip_header_sql("v2"))
register("ap_v2_detail", lambda t: ap.ap_v2_detail(t, AS_OF), O.ap_trip_detail_sql())
register("ap_v3_header", lambda t: ap.ap_v3_header(t, AS_OF), O.ap_trip_header_sql("v3"))
register("ap_v3_detail", lambda t: ap.ap_v3_detail(t, AS_OF), O.ap_trip_detail_sql())
register("ap_user3_header", lambda t: ap.ap_user3_header(t, AS_OF), O.ap_user3_header_sql())


# --- inter-company (R10) --------------------------------------------------------
WHOLE_PERIOD = ("1990-01-01", "2030-12-31")
register("intercompany_v1", lambda t: ic.intercompany_v1(t, WHOLE_PERIOD),
         O.intercompany_sql("none", WHOLE_PERIOD, trip_columns=False, skids=False))
register("intercompany_v2", lambda t: ic.intercompany_v2(t, WHOLE_PERIOD), O.intercompany_sql("none", WHOLE_PERIOD))
register("intercompany_v3", lambda t: ic.intercompany_v3(t, WHOLE_PERIOD), O.intercompany_sql("inner", WHOLE_PERIOD))
# one delivery month; bills are delivered on both its first and its last day
MONTH = ("1996-02-01", "1996-02-29")
register("intercompany_month", lambda t: ic.intercompany_v3(t, MONTH), O.intercompany_sql("inner", MONTH))
register("intercompany_procedure", lambda t: ic.intercompany_procedure(t), O.intercompany_sql("inner", bill_prefix="C"))
register("intercompany_safe", lambda t: ic.intercompany_safe(t), O.intercompany_sql("safe", bill_prefix="C"))


# --- trips (R9, R9b) and leg destinations (R13) -----------------------------------
register("trip_endpoints", trips.trip_endpoints, O.TRIP_ENDPOINTS)
register("trip_from", trips.trip_from, O.TRIP_FROM)
register("trip_to", trips.trip_to, O.TRIP_TO)
register("leg_destinations", trips.leg_destinations, O.LEG_DESTINATIONS)

# --- building blocks, each checked on its own (B1-B28) ------------------------------
register("latest_audit", lambda t: LK.latest_audit(t.reg_audit), O.LATEST_AUDIT_Q)
register("bill_traces", lambda t: LK.first_trace(t.trace, {"po": "P", "bol": "1", "order_no": "9"}), O.BILL_TRACES)
register("trace_list", lambda t: LK.trace_list(t.trace), O.trace_list_sql())
register("trace_list_y", lambda t: LK.trace_list(t.trace, LK.PICKUP_TRACE_TYPES_Y),
         O.trace_list_sql(pickup=LK.PICKUP_TRACE_TYPES_Y))
register("leg_trip", lambda t: LG.leg_trip(t.legsum), O.LEG_TRIP)
register("bill_miles", lambda t: LG.bill_miles(t.legsum, t.ilegdtl), O.BILL_MILES)
register("carrier_miles", lambda t: LG.carrier_miles(t.legsum), O.CARRIER_MILES)
register("carrier_pay", lambda t: LG.carrier_pay(t.order_interliner), O.CARRIER_PAY)
register("split_bills", lambda t: LG.split_bills(t.ilegdtl), O.SPLIT_BILLS)
register("extra_charges", lambda t: LG.extra_charges(t.tlorder), O.EXTRA_CHARGES)
register("skid_units", lambda t: LK.skid_units(t.tldtl), O.SKID_UNITS)
register("safe_zone", lambda t: LK.safe_zone(t.zone), O.SAFE_ZONE)
register("terminal_flags", lambda t: LG.terminal_flags(t.legsum, t.zone).select("ls_leg_id", "term_orig", "term_dest"),
         O.TERMINAL_FLAGS)
register("stop_numbers", lambda t: LG.stop_number(t.legdtl, t.tlorder, "P").unionByName(LG.stop_number(t.legdtl, t.tlorder, "D")),
         O.stop_number_sql())
register("milestones", lambda t: LK.milestones(t.odrstat), O.MILESTONES)
register("port_of_entry", lambda t: LK.port_of_entry(t.tlorder_customs, t.edi_ace_res_codes, t.edi_aci_res_codes),
         O.PORT_OF_ENTRY)
register("notes_lookup", lambda t: LK.notes_lookup(t.notes, "TLORDER", {"note_p": "1", "note_d": "2"}), O.NOTES_LOOKUP)


# --- driver pay (R12, R12b, R16, R18) and billing cut-off (R17) -------------------
STATEMENT_DATE = "2024-01-05"
for _neg in ("carry", "show"):
    register(f"driver_pay_{_neg}", lambda t, n=_neg: pay.driver_pay(t, None, n), O.driver_pay_sql(_neg))
    register(f"driver_pay_summary_{_neg}", lambda t, n=_neg: pay.driver_pay_summary(t, None, n),
             O.driver_pay_summary_sql(_neg))
    # one statement date
    register(f"driver_pay_day_{_neg}", lambda t, n=_neg: pay.driver_pay(t, STATEMENT_DATE, n), O.driver_pay_sql(_neg, STATEMENT_DATE))
register("pay_report_roundtrip", lambda t: pay.pay_report_roundtrip(t), O.driver_pay_summary_sql("carry"))
register("pay_reconciliation", lambda t: pay.pay_reconciliation(t), O.pay_reconciliation_sql("carry"))
register("driver_pay_dates", lambda t: pay.driver_pay_dates(t, None, "12/31/2023"), O.driver_pay_dates_sql("2023-12-31"))
register("pay_reallocation", lambda t: pay.pay_reallocation(t, "2024-12-31"), O.pay_reallocation_sql("2024-12-31"))
register("invoiced_cutoff", lambda t: period.invoiced_cutoff(t, "2030-01-01", "1990-01-01", "2030-12-31"),
         O.invoiced_cutoff_sql("2030-01-01", "1990-01-01", "2030-12-31"))


# --- gross margin (R11) --------------------------------------------------------------
register("gross_margin", margin.gross_margin, O.GROSS_MARGIN)


# --- carrier contract (R14) ------------------------------------------------------------
register("contract_stop_rows", lambda t: contract.stop_rows(t), O.contract_stop_rows_sql())
# the kept table, brought up to date from an earlier version of legs, stop details and bills
register("contract_stops_after_changes",
         lambda t: stop_sheet.stops_after_changes(t, f"{ensure_checkpoint_dir(t.spark).rstrip('/')}/stop-sheet-{uuid.uuid4().hex}"),
         O.contract_stop_rows_sql())
register("carrier_contract", lambda t: contract.carrier_contract(t), O.carrier_contract_sql())
# the "pick up modification" source: pickup traces list type 'Y' instead of '1'
register("carrier_contract_pickup_y", lambda t: contract.carrier_contract(t, pickup_trace_types=LK.PICKUP_TRACE_TYPES_Y),
         O.carrier_contract_sql(pickup=LK.PICKUP_TRACE_TYPES_Y))
# the legs that leave in one month: the source asks leg by leg, and a trip's legs leave on different days
LEAVING = "ls_planned_departure >= DATE '1996-03-01' AND ls_planned_departure < DATE '1996-04-01'"
register("carrier_contract_legs", lambda t: contract.carrier_contract(t, t.legsum.where(LEAVING).select("ls_leg_id")),
         O.carrier_contract_sql(legs=LEAVING))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: (lambda spark, sf_dir, j=job: j(Tables.at(spark, sf_dir))) for k, (job, _) in REPORTS.items()}


def oracle_sql() -> dict[str, str]:
    return {k: sql for k, (_, sql) in REPORTS.items() if sql}
