"""Shared folders, staged intermediates, and the accessors of tables."""

import os

import pytest

from lorry import session
from lorry.sources.tables import SourceTables, Tables


class _Cluster:
    """What ensure_checkpoint_dir looks at, as a cluster session has it."""

    class conf:
        @staticmethod
        def get(key, default=None):
            return default

    class sparkContext:
        master = "spark://host:7077"

        @staticmethod
        def getCheckpointDir():
            return None


def test_refuses_a_machine_local_folder_on_a_cluster():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(_Cluster())


def test_staged_tables_are_released(spark):
    other = spark.newSession()
    a, b = session.stage(other.range(5), "a"), session.stage(other.range(7), "b")
    assert (a.count(), b.count()) == (5, 7)
    paths = [p.removeprefix("file:") for p in (a.inputFiles()[0], b.inputFiles()[0])]
    paths = [p[p.index("/"):].replace("///", "/") for p in paths]
    assert all(os.path.exists(p) for p in paths)
    assert session.release(other) == 2
    assert not any(os.path.exists(p) for p in paths)
    assert session.release(other) == 0


def test_tables_of_two_schemas(spark, tmp_path):
    spark.createDataFrame([(1, "one  ")], "zone_id long, name string").write.parquet(str(tmp_path / "a"))
    b = spark.createDataFrame([(2, "two")], "zone_id long, name string")
    t = SourceTables(spark, {"A.ZONE": str(tmp_path / "a"), "b.zone": b, "b.leg": b})
    assert [tuple(r) for r in t["a.zone"].collect()] == [(1, "one")]  # right-trimmed
    assert [tuple(r) for r in t["B.ZONE"].collect()] == [(2, "two")]
    assert t.leg.count() == 1  # only one schema has it
    for unknown in ("zone", "c.zone", "nothing"):
        with pytest.raises(KeyError):
            t[unknown]
    assert SourceTables(spark, {"a.zone": b, "b.zone": b}, schema="b").zone.count() == 1


def test_tables_of_the_catalog(spark):
    spark.createDataFrame([(3, "x ")], "zone_id long, name string").createOrReplaceTempView("lorry_catalog_zone")
    t = SourceTables(spark, catalog=True)
    assert [tuple(r) for r in t.lorry_catalog_zone.collect()] == [(3, "x")]
    with pytest.raises(KeyError):
        t["lorry_no_such_table"]


def test_a_report_over_real_tables(spark):
    from lorry.plans import trips

    legs = spark.createDataFrame([(1, 1, 11, "A", "B"), (1, 2, 12, "B", "C")],
                                 "ls_trip_number long, ls_leg_seq long, ls_leg_id long, lego_zone_desc string, legd_zone_desc string")
    got = trips.trip_endpoints(SourceTables(spark, {"ops.legsum": legs})).collect()
    assert [tuple(r) for r in got] == [(1, "A", "C")]


def test_changed_files_get_new_tables(spark, tmp_path):
    one = Tables.at(spark, str(tmp_path))
    assert Tables.at(spark, str(tmp_path)) is one
    spark.range(3).write.parquet(str(tmp_path / "orders.parquet"))
    assert Tables.at(spark, str(tmp_path)) is not one
    assert Tables.at(spark.newSession(), str(tmp_path)).spark is not spark
