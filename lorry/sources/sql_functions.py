"""Reports as SQL table functions with named arguments.

``register`` makes the reports below callable from SQL over the tables of an
accessor, e.g. ``SELECT * FROM driver_pay(statement_date => DATE '2024-01-05')
WHERE driver_id = 7``.  A function is one query in which the optimizer puts
the arguments; an argument left out asks for everything.  So filters on the
result and on arguments reach the scans alike, and results can be joined.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from lorry.sources.tables import Tables

MONEY = "DECIMAL(18,2)"

#: name -> (tables read, arguments, columns, body); tables are named ``{table}`` in the body
FUNCTIONS: dict[str, tuple[tuple[str, ...], str, str, str]] = {
    # Pay lines of a driver after a day
    "driver_pay_dates": (
        ("driverpay",), "driver BIGINT DEFAULT NULL, since DATE DEFAULT NULL", "driver_id BIGINT, leg_date DATE, paid_date DATE", """
SELECT driver_id, leg_date, paid_date FROM {driverpay}
WHERE (driver IS NULL OR driver_id = driver) AND (since IS NULL OR leg_date > since)"""),
    # Pay lines and deductions; negatives 'carry' leaves out balances that go to the next pay
    "driver_pay": (
        ("dr_stmt_report", "driverpay", "driverdeductions", "driver", "drv_rule_mile"),
        "statement_date DATE DEFAULT NULL, negatives STRING DEFAULT 'carry'",
        f"pay_type STRING, driver_id BIGINT, name STRING, pay_date DATE, subsistance {MONEY}, hours {MONEY}, overtime {MONEY}, other {MONEY}, net {MONEY}", """
SELECT s.pay_type, l.driver_id, d.name, CAST(s.statement_date AS DATE),
  CASE WHEN l.meals THEN l.amount ELSE 0 END, CASE WHEN l.overtime THEN 0 ELSE l.hours END,
  CASE WHEN l.overtime THEN l.hours ELSE 0 END, CASE WHEN l.pay AND NOT l.meals THEN l.amount ELSE 0 END, l.amount
FROM {dr_stmt_report} s
JOIN (SELECT p.statement_id, p.driver_id, p.total_pay_amt AS amount, p.hours, TRUE AS pay,
        COALESCE(p.pay_code = 'HOUR OVER', FALSE) AS overtime, COALESCE(m.user1 = 'SUBSISTANCE', FALSE) AS meals
      FROM {driverpay} p LEFT JOIN {drv_rule_mile} m ON m.rule_id = p.rule_id
      UNION ALL
      SELECT statement_id, driver_id, -ded_amt, 0, FALSE, FALSE, FALSE FROM {driverdeductions}) l ON l.statement_id = s.statement_id
JOIN {driver} d ON d.driver_id = l.driver_id
WHERE (driver_pay.statement_date IS NULL OR CAST(s.statement_date AS DATE) = driver_pay.statement_date)
  AND CASE negatives WHEN 'carry' THEN s.check_amt > 0 WHEN 'show' THEN s.check_amt <> 0
           ELSE raise_error("negatives must be 'carry' or 'show'") END"""),
    # R13, for some trips' legs: where legs end
    "leg_destinations": (
        ("legsum",), "trip BIGINT DEFAULT NULL", "leg_to STRING",
        "SELECT DISTINCT upper(legd_zone_desc) FROM {legsum} WHERE trip IS NULL OR ls_trip_number = trip"),
}


def register(t: Tables, prefix: str = "") -> list[str]:
    """Makes the functions available to ``t.spark.sql`` (for this session) as
    ``prefix`` + name, over views of the tables that they read; their names."""
    spark: SparkSession = t.spark
    names = []
    for name, (tables, arguments, columns, body) in FUNCTIONS.items():
        views = {}
        for table in tables:
            views[table] = f"{prefix}lorry_{table}"
            t[table].createOrReplaceTempView(views[table])
        text = body.format(**views).replace(f"{name}.", f"{prefix}{name}.")
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {prefix}{name}({arguments}) RETURNS TABLE({columns}) RETURN {text}")
        names.append(prefix + name)
    return names
