"""Doubled and missing keys are reported by the job itself."""

import pytest
from pyspark.sql import functions as F

from lorry.operators.watch import FanOut, Watch
from lorry.plans import ar, intercompany
from lorry.plans.stop_sheet import Earlier
from lorry.sources.tables import Tables


class Changed(Earlier):
    def period(self, *args):
        return self._t.period(*args)


def _rows(df):
    return sorted(map(str, df.collect()))


def _scans(df):
    return df._jdf.queryExecution().executedPlan().toString().count("FileScan")


def test_lookup_counts_and_equals_the_join(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (None, "d")], "k long, v string")
    once, twice = (spark.createDataFrame(r, "id long, w string") for r in ([(1, "x"), (2, "y"), (9, "z")], [(1, "x"), (1, "y"), (2, None)]))
    for how in ("inner", "left"):
        for table, out, doubled in ((once, 4, 0), (twice, 5, 2)):
            w = Watch()
            got = w.lookup(left, table, "id", left.k == table.id, "dimension", how)
            assert _rows(got) == _rows(left.join(table, left.k == table.id, how)) and got.columns == ["k", "v", "id", "w"]
            assert w.report() == {"dimension": {"rows": out, "unmatched": 2, "doubled": doubled}}
            if doubled:
                with pytest.raises(FanOut, match="dimension: 2 of 5 rows"):
                    w.check()
            else:
                w.check()
    with pytest.raises(ValueError):
        Watch().lookup(left, once, "id", left.k == once.id, "x", "full")


def test_receivables_report_a_doubled_customer_in_the_same_pass(spark, sf_dir):
    t = Tables.at(spark, sf_dir)
    w = Watch()
    watched, plain = ar.ar_detail(t, segment=True, watch=w), ar.ar_detail(t, segment=True)
    assert _scans(watched) == _scans(plain)
    assert _rows(watched) == _rows(plain)
    found = w.check()
    assert found["client of a bill"]["rows"] >= found["client of a bill"]["unmatched"] and found["client of a bill"]["doubled"] == 0
    # shares are exact, also where the sort's sampling lets the rows pass twice
    lines, without = plain.count(), plain.where("idacctrev is null").count()
    assert found["account without a segment"]["hits"] * lines == without * found["account without a segment"]["rows"] and lines > 0
    code = t.tlorder.where("interface_status_f > 0 and extra_stops <> 'Child'").agg(F.min("bill_to_code")).first()[0]
    doubled = t.client.union(t.client.where(F.col("client_id") == code))
    w = Watch()
    ar.ar_header(Earlier(t, client=doubled), watch=w).count()
    with pytest.raises(FanOut, match="client of a bill"):
        w.check()


def test_intercompany_reports_doubled_and_unknown_zones(spark, sf_dir):
    t = Tables.at(spark, sf_dir)
    month = ("1996-01-01", "1996-06-30")
    w = Watch()
    plain = _rows(intercompany.intercompany_v3(t, month))
    assert _rows(intercompany.intercompany(t, date_range=month, watch=w)) == plain != []
    found = w.check()
    zone = t.legsum.groupBy("ls_from_zone").count().orderBy(F.desc("count")).first()[0]
    w = Watch()
    rows = intercompany.intercompany(Changed(t, zone=t.zone.union(t.zone.where(F.col("zone_id") == zone))), date_range=month, watch=w).collect()
    assert len(rows) > len(plain)
    with pytest.raises(FanOut, match="zone of ls_from_zone"):
        w.check()
    w = Watch()
    intercompany.intercompany(Changed(t, zone=t.zone.where(F.col("zone_id") != zone)), date_range=month, watch=w).collect()
    assert w.check()["zone of ls_from_zone"]["unmatched"] > found["zone of ls_from_zone"]["unmatched"]
