"""Reports called from SQL with named arguments equal the Python reports; filters reach the scans."""

import datetime as dt
from collections import Counter

import pytest

from lorry.plans import pay, trips
from lorry.sources import sql_functions
from lorry.sources.tables import Tables


@pytest.fixture(scope="module")
def t(spark, sf_dir):
    t = Tables.at(spark, sf_dir)
    assert sql_functions.register(t, "t_") == [f"t_{n}" for n in sql_functions.FUNCTIONS]
    return t


def _rows(df):
    return Counter(tuple(r) for r in df.collect())


def _pushed(df):
    """The pushed filters of all scans, and what they read."""
    text = df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    return "\n".join(x for x in text.splitlines() if x.startswith(("PushedFilters", "ReadSchema")))


def test_driver_pay(spark, t):
    for call, given in (("", {}), ("negatives => 'show'", {"negatives": "show"}), ("DATE '2024-01-05'", {"statement_date": "2024-01-05"}),
                        ("negatives => 'show', statement_date => DATE '2024-01-05'", {"statement_date": "2024-01-05", "negatives": "show"})):
        want = pay.driver_pay(t, **given)
        got = spark.sql(f"SELECT * FROM t_driver_pay({call})")
        assert got.columns == want.columns and _rows(got) == _rows(want) != Counter()
    with pytest.raises(Exception, match="must be 'carry' or 'show'"):
        spark.sql("SELECT * FROM t_driver_pay(negatives => 'hide')").collect()


def test_filters_on_the_result_and_arguments_reach_the_scans(spark, t):
    day = spark.sql("SELECT max(pay_date) FROM t_driver_pay()").first()[0]
    p = _pushed(spark.sql(f"SELECT net FROM t_driver_pay(statement_date => DATE '{day}') WHERE driver_id = 7"))
    assert p.count("EqualTo(driver_id,7)") >= 2 and "GreaterThan(check_amt,0" in p and "ReadSchema: struct<statement_id" in p
    assert "pay_type" not in p and "name" not in p  # columns that nobody asks for are not read
    p = _pushed(spark.sql("SELECT * FROM t_driver_pay_dates(driver => 7, since => DATE '2023-12-31') WHERE paid_date > DATE '2024-01-02'"))
    for pushed in ("EqualTo(driver_id,7)", "GreaterThan(leg_date,2023-12-31)", "GreaterThan(paid_date,2024-01-02)"):
        assert pushed in p


def test_pay_dates_and_leg_destinations(spark, t):
    assert _rows(spark.sql("SELECT * FROM t_driver_pay_dates()")) == _rows(pay.driver_pay_dates(t))
    got = spark.sql("SELECT * FROM t_driver_pay_dates(since => DATE '2023-12-31', driver => 7)")
    assert _rows(got) == _rows(pay.driver_pay_dates(t, 7, dt.date(2023, 12, 31).isoformat())) != Counter()
    assert _rows(spark.sql("SELECT leg_to FROM t_leg_destinations()")) == _rows(trips.leg_destinations(t).select("leg_to"))
    trip = t.legsum.agg({"ls_trip_number": "min"}).first()[0]
    one = spark.sql(f"SELECT * FROM t_leg_destinations({trip})")
    assert 0 < one.count() <= t.legsum.where(f"ls_trip_number = {trip}").count()


def test_results_join_with_tables(spark, t):
    got = spark.sql("SELECT p.driver_id, sum(p.net) AS net FROM t_driver_pay() p JOIN t_lorry_driver d ON d.driver_id = p.driver_id GROUP BY p.driver_id")
    want = pay.driver_pay(t).groupBy("driver_id").sum("net")
    assert _rows(got) == _rows(want)
