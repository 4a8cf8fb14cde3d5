"""Carrier-contract stop sheet.

The reference is a stored procedure called once per leg: a cursor over the
leg computes terminal flags, nested cursors insert stop rows one at a time
into a session temp table, and a three-branch UNION returns freight lines,
shipping instructions and empty-leg rows.  Here the same result is built for
*all* legs (or the legs in ``leg_ids``) at once:

1. :func:`terminal_flags` (B18) for every leg whose two zones are known;
2. the stop rows, as a union of five set-based producers
   (terminal pickup / terminal delivery / shipper pickup / consignee
   delivery / empty leg) -- this is the temp table, written once to the
   shared checkpoint folder because all three sections read it;
3. the three output sections over the stop rows, aligned to one 96-column
   schema.

Lookups that the procedure runs as correlated ``LIMIT 1`` or LISTAGG
subqueries per output row (traces, equipment, notes, directions, port of
entry) are pre-aggregated once per key and left-joined.  The client join of
the destination side is built as evidently intended (on the destination
client); the output has no ORDER BY.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lorry.operators.keys import Keys, restricted
from lorry.operators.legs import carrier_spans, stop_number, terminal_flags
from lorry.operators.lookups import PICKUP_TRACE_TYPES, lookup, notes_lookup, port_of_entry, trace_list
from lorry.session import stage
from lorry.sources.tables import Tables, live

TERM_ORIG = ("term_origname", "term_origaddr1", "term_origaddr2", "term_origcity", "term_origprov", "term_origpc")
TERM_DEST = ("term_destname", "term_destaddr1", "term_destaddr2", "term_destcity", "term_destprov", "term_destpc")
STOP_COLUMNS = (
    "leg_id", "ld_pd", "ld_pd_order", "detail_line_id", "pick_up_by", "pick_up_by_end", "deliver_by", "deliver_by_end",
    *TERM_ORIG, *TERM_DEST, "stop_no", "fbs_on_leg",
)
PARTY = ("name", "addr1", "addr2", "city", "prov", "pc", "contact", "phone", "email")
GOODS = ("description", "pieces", "pallets", "weight", "weight_units", "length_1", "length_units", "width",
         "width_units", "height", "height_units", "cube", "cube_units", "temperature", "temperature_units",
         "temp_controlled", "un_number")
CUSTOMS = ("customs_name", "customs_phone", "customs_fax", "customs_email", "customs_addr1", "customs_addr2",
           "customs_city", "customs_prov", "customs_pc", "customs_contact")
CONTAINER = ("container_number", "container_size", "container_type", "container_owner", "vessel", "voyage")
OUTPUT_COLUMNS = (
    *STOP_COLUMNS, "bill_number",
    *[f"orig{p}" for p in PARTY], "origopen", "origclose",
    *[f"dest{p}" for p in PARTY], "destopen", "destclose",
    *GOODS, "tarp", "high_value", "dangerous_goods", *CUSTOMS, "port_of_entry",
    "pick_up_appt_req", "pick_up_appt_made", "delivery_appt_req", "delivery_appt_made", *CONTAINER,
    "pick_up_appt", "delivery_appt", "trace", "equip_type", "location_notes", "ls_from_zone", "ls_to_zone",
    "directions", "sequence", "sort_order",
)
assert len(OUTPUT_COLUMNS) == 96


#: a stop while it is put together: its terminals are named by their row, the texts come last
NARROW = tuple(c for c in STOP_COLUMNS if c not in TERM_ORIG + TERM_DEST) + ("orig_row", "dest_row")


def _stop(**cols) -> list[F.Column]:
    """The narrow stop-row schema (missing columns NULL)."""
    types = {
        "leg_id": "bigint", "ld_pd": "string", "ld_pd_order": "bigint", "detail_line_id": "bigint",
        "pick_up_by": "timestamp_ntz", "pick_up_by_end": "timestamp_ntz", "deliver_by": "timestamp_ntz",
        "deliver_by_end": "timestamp_ntz", "stop_no": "bigint", "fbs_on_leg": "bigint", "orig_row": "bigint", "dest_row": "bigint",
    }
    out = []
    for c in NARROW:
        e = cols.get(c, F.lit(None))
        if isinstance(e, str):
            e = F.col(e)
        out.append(e.cast(types[c]).alias(c))
    return out


def _numbered(zone: DataFrame) -> DataFrame:
    """The zones with a number for each row, fixed by writing them."""
    return stage(zone.withColumn("zone_row", F.monotonically_increasing_id()), "zone-rows")


def _with_terminals(df: DataFrame, zones: DataFrame) -> DataFrame:
    """``df`` with the texts of the zones that its stops name by row (one row each, so none is doubled)."""
    texts = ("short_description", "address1", "address2", "city", "province", "postal_code")
    for row, terms in (("orig_row", TERM_ORIG), ("dest_row", TERM_DEST)):
        named = zones.select(F.col("zone_row").alias(row), *[F.col(c).cast("string").alias(k) for c, k in zip(texts, terms, strict=True)])
        df = lookup(df, named, row, ("leg_id", "detail_line_id")).drop(f"_spread_{row}")
    return df


def stop_rows(t: Tables, leg_ids: DataFrame | None = None) -> DataFrame:
    """The temp table of the procedure, for every selected leg (see :func:`_stop_rows`)."""
    zones = _numbered(t.zone)
    return _with_terminals(_stop_rows(t, zones, leg_ids), zones).select(*STOP_COLUMNS)


def _stop_rows(t: Tables, zones: DataFrame, leg_ids: DataFrame | None) -> DataFrame:
    """The stop rows, their terminals as rows of the numbered ``zones``.

    For selected legs the bridge and the stop details are read for these legs,
    the legs of their trips (and of the trips that their bridge rows name)
    whole, and bills for what rides them.
    """
    legs = Keys((leg_ids, "ls_leg_id"), label="legs-asked") if leg_ids is not None else None
    ilegdtl = restricted(t.ilegdtl, "ild_leg_id", legs)
    legdtl = restricted(t.legdtl, "ld_leg_id", legs)
    legsum, tlorder = t.legsum, live(t, "tlorder")  # few columns of the bills
    if legs is not None:
        trips = Keys((legs.restrict(t.legsum, "ls_leg_id"), "ls_trip_number"), (ilegdtl, "ild_trip_number"), label="trips-asked")
        legsum = trips.restrict(t.legsum, "ls_trip_number")
        aboard = Keys((ilegdtl.filter(F.col("ild_res_type") == "F"), "ild_fb_id"), (legdtl, "ld_fb_id"), label="bills-aboard")
        tlorder = aboard.restrict(tlorder, "detail_line_id")
    # carrier spans and flags look at the whole trip, also for a part of its legs
    all_spans = stage(carrier_spans(legsum), "carrier-spans")
    # one row per selected leg, read by all producers: written once
    flags = stage(terminal_flags(legsum, zones, leg_ids, all_spans, zone_row="zone_row").select(
        "ls_leg_id", "ls_trip_number", "ls_leg_seq", "ls_interliner", "ls_mt_loaded", "ls_planned_departure", "ls_expected_date",
        "ls_num_pu", "ls_num_del", "term_orig", "term_dest", "orig_row", "dest_row", "carrier_first_seq", "carrier_last_seq",
        F.col("ls_from_zone").cast("string").startswith("RR-").alias("_yard")), "contract-flags")

    # 1./2. terminal pickups and deliveries: what rides a leg, with what is picked up and delivered on it
    bills = tlorder.select("detail_line_id")
    bridge = (
        ilegdtl.filter(F.col("ild_res_type") == "F")
        .select("ild_leg_id", F.col("ild_fb_id").alias("detail_line_id"), "ild_trip_number")
        .join(bills, "detail_line_id", "left_semi")
    )
    marks = legdtl.filter(F.col("ld_pd").isin("P", "D") & (F.col("ld_type") == "F")).groupBy(
        F.col("ld_leg_id").alias("_m_leg"), F.col("ld_fb_id").alias("_m_fb")).agg(
        F.max(F.col("ld_pd") == "P").alias("_picked"), F.max(F.col("ld_pd") == "D").alias("_dropped"))
    riding = bridge.join(marks, (bridge.ild_leg_id == marks._m_leg) & (bridge.detail_line_id == marks._m_fb), "left").select(
        "ild_leg_id", "detail_line_id", "ild_trip_number", "_picked", "_dropped")
    x = flags.filter((F.col("term_orig") == "True") | (F.col("term_dest") == "True")).drop("ls_mt_loaded")
    # written once: its two readers below take different columns, so they would not share a shuffle
    x = stage(x.join(riding, x.ls_leg_id == riding.ild_leg_id, "inner").drop("ild_leg_id"), "contract-riding")
    # most ride on the leg's own trip, whose spans the leg has; others look theirs up
    own = F.col("ild_trip_number").eqNullSafe(F.col("ls_trip_number"))
    spans = all_spans.select(
        F.col("ls_trip_number").alias("_sp_trip"), F.col("ls_interliner").alias("_sp_carrier"),
        F.col("carrier_first_seq").alias("_sp_first"), F.col("carrier_last_seq").alias("_sp_last"),
    )
    other = x.filter(~own).drop("carrier_first_seq", "carrier_last_seq").join(
        spans, (F.col("ild_trip_number") == F.col("_sp_trip")) & (F.col("ls_interliner") == F.col("_sp_carrier")), "left"
    ).drop("_sp_trip", "_sp_carrier").withColumnsRenamed({"_sp_first": "carrier_first_seq", "_sp_last": "carrier_last_seq"})
    x = x.filter(own).unionByName(other)
    picked = (F.col("term_orig") == "True") & (
        (F.col("ls_leg_seq") == F.col("carrier_first_seq")) | F.col("_picked") | F.col("_yard"))
    dropped = (F.col("term_dest") == "True") & ((F.col("ls_leg_seq") == F.col("carrier_last_seq")) | F.col("_dropped"))
    tp = _stop(leg_id="ls_leg_id", ld_pd=F.lit("P"), ld_pd_order=F.lit(1), detail_line_id="detail_line_id",
               pick_up_by="ls_planned_departure", pick_up_by_end="ls_planned_departure",
               orig_row="orig_row", stop_no=F.lit(1), fbs_on_leg="ls_num_pu")
    td = _stop(leg_id="ls_leg_id", ld_pd=F.lit("D"), ld_pd_order=F.lit(9999), detail_line_id="detail_line_id",
               deliver_by="ls_expected_date", deliver_by_end="ls_expected_date",
               dest_row="dest_row", stop_no=F.lit(9999), fbs_on_leg="ls_num_del")
    terminal = x.select(F.explode(F.array_compact(F.array(F.when(picked, F.struct(*tp)), F.when(dropped, F.struct(*td))))).alias("s")).select("s.*")

    # 3./4. shipper pickups and consignee deliveries on non-terminal sides; a stop
    # number looks at one leg, so legs that need none are left out before
    sides = flags.filter((F.col("term_orig") == "False") | (F.col("term_dest") == "False")).select(
        "ls_leg_id", "term_orig", "term_dest", "ls_num_pu", "ls_num_del")
    pickup = F.col("ld_pd") == "P"
    y = legdtl.filter(F.col("ld_pd").isin("P", "D") & (F.col("ld_type") == "F")).join(sides, F.col("ld_leg_id") == F.col("ls_leg_id"), "inner")
    y = y.filter(F.when(pickup, F.col("term_orig")).otherwise(F.col("term_dest")) == "False")
    y = y.withColumn("fbs_on_leg", F.when(pickup, F.col("ls_num_pu")).otherwise(F.col("ls_num_del")))
    shipper = stop_number(y, tlorder, "PD", keep=("fbs_on_leg",)).select(*_stop(
        leg_id="ld_leg_id", ld_pd="ld_pd", ld_pd_order="ld_pd_order", detail_line_id="detail_line_id", stop_no="stop_no",
        fbs_on_leg="fbs_on_leg"))
    # 5. empty legs: one pickup row without a bill
    em = flags.filter(F.col("ls_mt_loaded") == "E").select(*_stop(
        leg_id="ls_leg_id", ld_pd=F.lit("P"), ld_pd_order=F.lit(1), detail_line_id=F.lit(0),
        pick_up_by="ls_planned_departure", pick_up_by_end="ls_planned_departure",
        orig_row="orig_row", stop_no=F.lit(9999), fbs_on_leg="ls_num_del"))
    return terminal.unionByName(shipper).unionByName(em)


def carrier_contract(t: Tables, leg_ids: DataFrame | None = None, pickup_trace_types=PICKUP_TRACE_TYPES,
                     stage_stops: bool = True, stage_bills: bool = True) -> DataFrame:
    """R14 for the legs in ``leg_ids`` (a frame with ``ls_leg_id``), or all legs."""
    # the procedure's temp table, read by all three sections: written once
    zones = _numbered(t.zone)
    stops = _stop_rows(t, zones, leg_ids)
    if stage_stops or leg_ids is not None:
        stops = stage(stops, "contract-stops")
    # a sheet of chosen legs: every lookup below is aggregated for the bills on it only
    called = Keys((stops, "detail_line_id"), label="bills-called") if leg_ids is not None else None
    ids = called.frame if called else stage(stops.select(F.col("detail_line_id").alias("key")).where("key is not null").distinct(), "bills-called")
    bill_cols = [
        "detail_line_id", "bill_number", "origin", "destination", "requested_equipmen",
        "pick_up_by", "pick_up_by_end", "deliver_by", "deliver_by_end",
        *[f"orig{p}" for p in PARTY], *[f"dest{p}" for p in PARTY],
        "tarp", "high_value", "dangerous_goods", "pick_up_appt_req", "pick_up_appt_made", "delivery_appt_req",
        "delivery_appt_made", "pick_up_appt", "delivery_appt",
    ]
    # per bill on the sheet: the bill columns and every bill-keyed lookup, built
    # once (staged) and joined to the stop rows of both freight and instruction sections
    # a sheet of all legs calls nearly every bill: none is left out before they meet the stops
    tl = (live(t, "tlorder") if called is None else called.restrict(t.tlorder, "detail_line_id")).select(*[F.col(c).alias(f"t_{c}") for c in bill_cols])
    loc = notes_lookup(restricted(t.notes, "id_key", called.texts() if called else None), "TLORDER", {"loc_note_p": "1", "loc_note_d": "2"}, key="_id_key")
    # notes know bills as text: found by the narrow ids, so that the bills stay where they are
    loc = ids.join(loc, ids.key.cast("string") == loc._id_key, "inner").select(F.col("key").alias("_l_id"), "loc_note_p", "loc_note_d")
    # dimensions: equipment class, clients, client directions, for each set of them that bills name
    ends = ("t_requested_equipmen", "t_origin", "t_destination")
    dims = tl.select(*ends).distinct()
    eq = t.eqclass.groupBy(F.col("code").alias("_eq_code")).agg(F.min("codedesc").alias("equip_type"))
    dims = dims.join(eq, dims.t_requested_equipmen == eq._eq_code, "left")
    clients = Keys((tl, "t_origin"), (tl, "t_destination"), label="clients-called").texts() if called else None
    dirs = notes_lookup(restricted(t.notes, "id_key", clients), "CLIENT", {"_dir": "D"}, key="_dir_key")
    for end, k in (("orig", "o"), ("dest", "d")):
        named = "t_origin" if k == "o" else "t_destination"
        c = t.client.select(F.col("client_id").alias(f"_c_{k}"), F.col("open_time").alias(f"{end}open"), F.col("close_time").alias(f"{end}close"))
        d = dirs.select(F.col("_dir_key").alias(f"_d_{k}"), F.col("_dir").alias(f"_dir_{k}"))
        dims = dims.join(c, dims[named] == c[f"_c_{k}"], "left")
        dims = dims.join(d, dims[named].cast("string") == d[f"_d_{k}"], "left")
    dims = dims.drop("_eq_code", "_c_o", "_c_d", "_d_o", "_d_d").withColumnsRenamed({c: f"_{c}" for c in ends})
    b = tl.join(dims, reduce(and_, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in ends]), "inner").drop(*[f"_{c}" for c in ends])
    traces = trace_list(restricted(t.trace, "detail_number", called), pickup_types=pickup_trace_types)
    customs = port_of_entry(restricted(t.tlorder_customs, "detail_line_id", called), t.edi_ace_res_codes, t.edi_aci_res_codes, keep=CUSTOMS)
    customs = customs.withColumnRenamed("detail_line_id", "_c_id")
    b = b.join(loc, b.t_detail_line_id == loc._l_id, "left")
    b = b.join(traces.withColumnRenamed("detail_line_id", "_tr_id"), b.t_detail_line_id == F.col("_tr_id"), "left")
    b = b.join(customs, b.t_detail_line_id == customs._c_id, "left")
    b = b.drop("_c_id", "_tr_id", "_l_id", *ends)
    if stage_bills:
        b = stage(b, "contract-bills")

    # the narrow leg columns first, the wide bill columns last
    legs = t.legsum.select(F.col("ls_leg_id").alias("_s_leg"), "ls_from_zone", "ls_to_zone")
    x = stops.join(legs, stops.leg_id == legs._s_leg, "inner").drop("_s_leg")
    if stage_stops or leg_ids is not None:
        x = stage(x, "contract-stops-zones")  # read by two sections, for bills each
    x = _with_terminals(x.join(b, x.detail_line_id == b.t_detail_line_id, "inner"), zones)

    pd_ = F.col("ld_pd")

    def by_side(p: str, d: str, other) -> F.Column:
        return F.when(pd_ == "P", F.col(p)).when(pd_ == "D", F.col(d)).otherwise(other)

    common = {
        **{c: F.col(c) for c in STOP_COLUMNS},
        "pick_up_by": F.coalesce("pick_up_by", "t_pick_up_by"),
        "pick_up_by_end": F.coalesce("pick_up_by_end", "t_pick_up_by_end"),
        "deliver_by": F.coalesce("deliver_by", "t_deliver_by"),
        "deliver_by_end": F.coalesce("deliver_by_end", "t_deliver_by_end"),
        "bill_number": F.col("t_bill_number"),
        **{f"orig{p}": F.col(f"t_orig{p}") for p in PARTY},
        **{f"dest{p}": F.col(f"t_dest{p}") for p in PARTY},
        "origopen": F.col("origopen"), "origclose": F.col("origclose"),
        "destopen": F.col("destopen"), "destclose": F.col("destclose"),
        "tarp": F.col("t_tarp"), "high_value": F.col("t_high_value"), "dangerous_goods": F.col("t_dangerous_goods"),
        **{c: F.col(c) for c in CUSTOMS},
        "port_of_entry": F.col("port_of_entry"),
        **{c: F.col(f"t_{c}") for c in ("pick_up_appt_req", "pick_up_appt_made", "delivery_appt_req",
                                        "delivery_appt_made", "pick_up_appt", "delivery_appt")},
        "trace": by_side("trace_p", "trace_d", F.lit("")),
        "equip_type": F.col("equip_type"),
        "location_notes": by_side("loc_note_p", "loc_note_d", F.lit("")),
        "ls_from_zone": F.col("ls_from_zone"), "ls_to_zone": F.col("ls_to_zone"),
        "directions": by_side("_dir_o", "_dir_d", F.lit("")),
    }

    # FREIGHT: one row per goods line (picked and deficit lines excluded)
    goods = restricted(t.tldtl, "order_id", called).filter((F.col("pick_id") == 0) & (F.col("deficit") == 0)).select(
        F.col("order_id").alias("_g_id"), *GOODS, "sequence", "sort_order")
    fr = x.join(goods, x.detail_line_id == goods._g_id, "left")
    freight = fr.select(*[
        (common[c] if c in common else
         F.coalesce(F.col("temperature"), F.lit(-999)) if c == "temperature" else
         F.lit(None).cast("string") if c in CONTAINER else F.col(c)).alias(c)
        for c in OUTPUT_COLUMNS
    ])
    schema = {f.name: f.dataType for f in freight.schema.fields}

    def null(c: str) -> F.Column:
        return F.lit(None).cast(schema[c])

    # SHIP INSTRUCT: active instructions that apply to the stop's side or both
    si = restricted(t.tlshipinstruct, "order_id", called).filter(F.col("active") == "True").select(F.col("order_id").alias("_si_order"), "instruction_id")
    ins = t.shipinstruct.select(F.col("instruction_id").alias("_ins_id"), "applies_to", "instruction")
    sx = x.join(si, x.detail_line_id == si._si_order, "inner").join(ins, F.col("instruction_id") == ins._ins_id, "inner")
    sx = sx.filter((F.col("applies_to") == F.col("ld_pd")) | (F.col("applies_to") == "B"))
    ship = sx.select(*[
        (F.concat(F.col("ld_pd"), F.lit("1")) if c == "ld_pd" else
         F.col("instruction").cast(schema[c]) if c == "description" else
         null(c) if c in GOODS or c in CONTAINER or c in ("sequence", "sort_order") else
         common[c].cast(schema[c]) if c in common else null(c)).alias(c)
        for c in OUTPUT_COLUMNS
    ])

    # EMPTY: the empty-leg rows with their leg's zones only
    el = _with_terminals(stops.filter(F.col("detail_line_id") == 0).join(legs, F.col("leg_id") == legs._s_leg, "inner"), zones)
    empty = el.select(*[
        (F.col(c).cast(schema[c]) if c in STOP_COLUMNS or c in ("ls_from_zone", "ls_to_zone") else
         F.lit("False").cast(schema[c]) if c == "temp_controlled" else null(c)).alias(c)
        for c in OUTPUT_COLUMNS
    ])
    return freight.unionByName(ship).unionByName(empty)
