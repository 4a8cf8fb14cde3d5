"""The kept stop rows after a change equal a full rebuild, and only what a change reaches is replaced."""

import random
import uuid
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lorry.plans import stop_sheet
from lorry.plans.contract import stop_rows
from lorry.plans.stop_sheet import Earlier, StopSheet, changed_keys
from lorry.session import ensure_checkpoint_dir
from lorry.sources.tables import Tables


@pytest.fixture(scope="module")
def t(spark, sf_dir):
    return Tables.at(spark, sf_dir)


@pytest.fixture(scope="module")
def path(spark, t):
    """The sheet of today's tables, which each test finds and leaves as it is."""
    p = f"{ensure_checkpoint_dir(spark).rstrip('/')}/sheet-{uuid.uuid4().hex}"
    StopSheet(t, p).build()
    return p


def _rows(df):
    return Counter(map(str, df.collect()))


def _files(sheet):
    return {f for name in ("stops", "trips") for f in sheet._read(name).inputFiles()}


def test_changed_keys(spark):
    rnd = random.Random(6)
    old = [(rnd.randrange(40), rnd.choice([1, 2, None]), rnd.choice(["a", None])) for _ in range(200)]
    new = old[15:] + [(rnd.randrange(40), 3, "b") for _ in range(5)] + [(None, 1, "a")]
    a, b = Counter(old), Counter(new)
    schema = "k long, x long, y string"
    got = {r.k for r in changed_keys(spark.createDataFrame(old, schema), spark.createDataFrame(new, schema), "k").collect()}
    assert got == {r[0] for r in ((a - b) + (b - a))}


def test_a_leg_that_moves_to_another_trip_and_back(spark, t, path):
    sheet = StopSheet(t, path)
    leg = t.legsum.join(t.ilegdtl.where("ild_res_type = 'F'"), F.col("ls_leg_id") == F.col("ild_leg_id")).agg(F.min("ls_leg_id")).first()[0]
    moved = t.legsum.withColumn("ls_trip_number", F.when(F.col("ls_leg_id") == leg, F.col("ls_trip_number") + 1).otherwise(F.col("ls_trip_number")))
    then = Earlier(t, legsum=moved)
    one = spark.createDataFrame([(leg,)], "ls_leg_id long")
    before = _files(sheet)
    again = StopSheet(then, path).refresh(one)
    assert _rows(StopSheet(then, path).rows()) == _rows(stop_rows(then))
    built = {r.key for r in again.frame.collect()}
    assert leg in built and len(built) < t.legsum.count() / 4
    touched = {r[0] for r in sheet._bucketed(again.frame, "key").select(stop_sheet.BUCKET).distinct().collect()}
    after = _files(sheet)
    assert {f for f in before - after} and all(any(f"{stop_sheet.BUCKET}={b}/" in f for b in touched) for f in before ^ after)
    sheet.refresh(one)
    assert _rows(sheet.rows()) == _rows(stop_rows(t))


def test_legs_that_come_and_go(spark, t, path):
    gone = t.legsum.orderBy("ls_leg_id").limit(40).select("ls_leg_id")
    then = Earlier(t, legsum=t.legsum.join(gone, "ls_leg_id", "left_anti"))
    few = StopSheet(then, path, 64)
    few.refresh(gone)
    assert _rows(few.rows()) == _rows(stop_rows(then))
    StopSheet(t, path).refresh(gone)
    assert _rows(StopSheet(t, path).rows()) == _rows(stop_rows(t))


def test_a_table_that_loses_and_regains_all_rows(spark, t):
    p = f"{ensure_checkpoint_dir(spark).rstrip('/')}/sheet-{uuid.uuid4().hex}"
    only = t.legsum.orderBy("ls_leg_id").limit(3)
    some, none = Earlier(t, legsum=only), Earlier(t, legsum=only.where("false"))
    StopSheet(some, p).build()
    legs = only.select("ls_leg_id")
    StopSheet(none, p).refresh(legs)
    assert StopSheet(none, p).rows().count() == 0 and not _files(StopSheet(none, p))
    StopSheet(some, p).refresh(legs)
    assert _rows(StopSheet(some, p).rows()) == _rows(stop_rows(some)) != Counter()


def test_earlier_tables_and_stop_rows_store_no_bills(spark, sf_dir, tmp_path):
    (tmp_path / "tables").symlink_to(sf_dir)  # what is stored is stored by path
    t = Tables(spark, f"{tmp_path}/tables")
    got = stop_sheet.stops_after_changes(t, f"{tmp_path}/sheet")
    assert _rows(got) == _rows(stop_rows(t)) and got.count() > 0
    assert not t._written("tlorder")


def test_long_rows_are_compared_by_hashes_of_all_columns(spark):
    names = [f"c{i}" for i in range(stop_sheet.LONG_ROW + 2)]
    schema = "key long, " + ", ".join(f"{c} {'string' if i % 2 else 'long'}" for i, c in enumerate(names))

    def table(*rows):
        return spark.createDataFrame([(k, *(v.get(c) for c in names)) for k, v in rows], schema)

    old = table((1, {"c0": 5}), (2, {"c0": 5}), (3, {"c1": "a"}), (4, {}), (5, {"c2": 1}), (5, {"c2": 1}), (6, {"c3": "x"}), (None, {"c0": 1}))
    new = table((1, {"c0": 5}), (2, {"c2": 5}), (3, {"c3": "a"}), (4, {"c1": ""}), (5, {"c2": 1}), (7, {}), (None, {"c0": 2}))
    got = changed_keys(old, new, "key")
    assert {r.key for r in got.collect()} == {2, 3, 4, 5, 6, 7, None}
    text = got._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" in text and not any("c0#" in line for line in text.splitlines() if "hashpartitioning" in line)
