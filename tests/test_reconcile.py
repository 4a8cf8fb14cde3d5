"""The signed multiset difference of two tables."""

import random
from collections import Counter

from lorry.operators.reconcile import changed_columns, reconcile

SCHEMA = "k string, day long, a long, b string"


def brute(expected, actual):
    e, a = Counter(expected), Counter(actual)
    left, right = e - a, a - e
    out = Counter()
    for key in {r[:2] for r in (*left, *right)}:
        def order(r):
            return [(x is None, x or 0 if not isinstance(x, str) else x) for x in r]

        x, y = (sorted((r[2:] for r in c.elements() if r[:2] == key), key=order) for c in (left, right))
        for n in range(max(len(x), len(y))):
            p, q = (s[n] if n < len(s) else (None, None) for s in (x, y))
            status = "missing" if n >= len(y) else "extra" if n >= len(x) else "changed"
            out[status, *key, *p, *q] += 1
    return out


def _check(spark, expected, actual):
    got = reconcile(spark.createDataFrame(expected, SCHEMA), spark.createDataFrame(actual, SCHEMA), ["k", "day"], ["a", "b"])
    assert got.columns == ["status", "k", "day", "expected_a", "expected_b", "actual_a", "actual_b"]
    assert Counter(tuple(r) for r in got.collect()) == brute(expected, actual)
    return got


def test_reconcile_equals_brute_force(spark):
    rnd = random.Random(2)

    def rows(n):
        return [(rnd.choice(["x", "y", None]), rnd.choice([1, 2, None]), rnd.choice([1, 2, 3, None]), rnd.choice(["p", "q", None])) for _ in range(n)]

    same = rows(150)
    _check(spark, same + rows(40), same + rows(60))
    _check(spark, same, same[::-1])
    _check(spark, [], same)
    _check(spark, same, [])
    _check(spark, [], [])


def test_a_key_that_most_rows_share_and_repeated_rows(spark):
    same = [("hot", 1, k, "v") for k in range(3000)]
    got = _check(spark, [*same, ("hot", 1, 5, "v"), ("hot", 1, 5, "v"), ("z", 1, 1, None)], [*same[10:], ("hot", 1, -1, "w"), ("z", 1, 2, None)])
    summary = {(r.status, r["columns"]): r.rows for r in changed_columns(got, ["a", "b"]).collect()}
    assert summary == {("changed", "a,b"): 1, ("changed", "a"): 1, ("missing", ""): 11}
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "FullOuter" not in plan and "SinglePartition" not in plan
