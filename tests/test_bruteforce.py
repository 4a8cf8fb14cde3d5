"""Blocks against brute force on generated data with a hot key (one trip
holding about a third of all legs, NULL carriers included)."""

import random

from pyspark.sql import functions as F

from lorry.operators.legs import split_bills, terminal_flags, trip_endpoints


def _legs(seed=3, n=1500):
    rnd = random.Random(seed)
    rows, seqs = [], {}
    for i in range(n):
        trip = 0 if i % 3 == 0 else rnd.randint(1, 60)  # trip 0 is hot
        seq = seqs[trip] = seqs.get(trip, 0) + rnd.randint(1, 3)
        carrier = rnd.choice([None, 1, 2, 3])
        rows.append((i, trip, seq, carrier, rnd.choice(["E", "L", "L", "L"]), rnd.randint(0, 4), rnd.randint(0, 5)))
    return rows


def _reference_flags(rows, terminal_zones):
    """The procedure's CASE, evaluated literally per leg."""
    out = {}
    for (lid, trip, seq, carrier, mt, fz, tz) in rows:
        if tz > 4:  # unknown destination zone: the inner join drops the leg
            continue
        same = [r for r in rows if r[1] == trip and carrier is not None and r[3] == carrier]
        first = min((r[2] for r in same), default=None)
        last = max((r[2] for r in same), default=None)
        others = [r for r in rows if r[1] == trip and r[3] is not None and carrier is not None and r[3] != carrier]
        o = mt == "E" or fz in terminal_zones or (
            first is not None and seq == first and any(r[2] < first for r in others))
        d = mt == "E" or tz in terminal_zones or (
            last is not None and seq == last and any(r[2] > last for r in others))
        out[lid] = ("True" if o else "False", "True" if d else "False")
    return out


def test_terminal_flags_bruteforce(spark):
    rows = _legs()
    legs = spark.createDataFrame(rows, "ls_leg_id long, ls_trip_number long, ls_leg_seq long, ls_interliner long, "
                                       "ls_mt_loaded string, ls_from_zone long, ls_to_zone long")
    for c in ("ls_planned_departure", "ls_expected_date", "ls_num_pu", "ls_num_del"):
        legs = legs.withColumn(c, F.lit(None).cast("long"))
    terminal = {0, 3}
    zone = spark.createDataFrame([(z, f"Z{z}", "P", "True" if z in terminal else "False", "a", None, "c", "pc") for z in range(5)],
                                 "zone_id long, short_description string, province string, is_terminal string, "
                                 "address1 string, address2 string, city string, postal_code string")
    got = {r.ls_leg_id: (r.term_orig, r.term_dest) for r in terminal_flags(legs, zone).collect()}
    assert got == _reference_flags(rows, terminal)


def test_trip_endpoints_bruteforce(spark):
    rnd = random.Random(5)
    rows = [(r[0], r[1], None if rnd.random() < 0.1 else r[2] // 2) for r in _legs(seed=5)]  # ties and unknown sequences
    legs = spark.createDataFrame([(trip, seq, lid, f"from{lid}", f"to{lid}") for lid, trip, seq in rows],
                                 "ls_trip_number long, ls_leg_seq long, ls_leg_id long, lego_zone_desc string, legd_zone_desc string")
    trips = {}
    for lid, trip, seq in rows:
        trips.setdefault(trip, []).append((float("inf") if seq is None else seq, lid))
    got = {r.trip_number: (r.trip_from, r.trip_to) for r in trip_endpoints(legs).collect()}
    assert got == {k: (f"from{min(v)[1]}", f"to{max(v)[1]}") for k, v in trips.items()}


def test_split_bills_bruteforce(spark):
    rnd = random.Random(11)
    rows = []
    for leg in range(400):
        for bill in rnd.sample(range(60), rnd.randint(0, 4)) + ([0] if leg % 3 == 0 else []):  # bill 0 is hot
            rows.append((leg, "F", bill))
        for t in rnd.sample(["D", "I"], rnd.randint(0, 2)):
            rows.append((leg, t, None))
    bridge = spark.createDataFrame(rows, "ild_leg_id long, ild_res_type string, ild_fb_id long")
    # the reference: self-join on the leg, COUNT(DISTINCT resource type) > 1 per bill
    types = {}
    for leg, t, _ in rows:
        if t in ("D", "I"):
            types.setdefault(leg, set()).add(t)
    per_bill = {}
    for leg, t, bill in rows:
        if t == "F":
            per_bill.setdefault(bill, set()).update(types.get(leg, set()))
    want = sorted((b, len(s)) for b, s in per_bill.items() if len(s) > 1)
    got = sorted((r.ild_fb_id, r.res_count) for r in split_bills(bridge).collect())
    assert got == want
