"""What differs between two tables that should hold the same rows.

Both tables' rows are counted together, +1 for an expected row and -1 for an
actual one, per full row (grouping treats NULLs as equal), so equal rows
cancel below the shuffle and a key that very many rows share is no join key.
Only what is left is looked at by key: the rows of either side are numbered
within their key across tasks, and the n-th expected and the n-th actual row
of a key are one changed row; those without a partner are missing or extra.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lorry.operators.numbering import number_items


def reconcile(expected: DataFrame, actual: DataFrame, key: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """``status`` (``missing``, ``extra``, ``changed``), the key columns, and
    every measure as ``expected_*`` and ``actual_*`` (NULL on the side that
    has no row); one row per row that differs, repeated rows as often as they
    differ in number.  Numbered rows of a key are taken in the order of their
    measures, NULL last."""
    columns = [*key, *measures]
    signed = expected.select(*columns, F.lit(1).alias("_sign")).unionByName(actual.select(*columns, F.lit(-1).alias("_sign")))
    left = signed.groupBy(*columns).agg(F.sum("_sign").alias("_n")).where("_n <> 0")
    rows = left.select(*columns, (F.col("_n") > 0).alias("_expected"), F.explode(F.sequence(F.lit(1).cast("long"), F.abs("_n"))).alias("_copy"))
    order = [F.col(m).asc_nulls_last() for m in measures] + [F.col("_copy")]
    rows = number_items(rows, [*key, "_expected"], order, out="_nth")
    own = F.struct(*measures)
    pairs = rows.groupBy(*key, "_nth").agg(F.max(F.when(F.col("_expected"), own)).alias("_e"), F.max(F.when(~F.col("_expected"), own)).alias("_a"))
    status = F.when(F.col("_a").isNull(), "missing").when(F.col("_e").isNull(), "extra").otherwise("changed")
    return pairs.select(status.alias("status"), *key, *[F.col(f"_e.{m}").alias(f"expected_{m}") for m in measures],
                        *[F.col(f"_a.{m}").alias(f"actual_{m}") for m in measures])


def changed_columns(reconciled: DataFrame, measures: Sequence[str]) -> DataFrame:
    """Per status and set of measures that differ: how many rows.  ``columns``
    lists the measures of changed rows, comma-separated; it is empty for
    missing and extra rows."""
    differ = F.concat_ws(",", *[F.when((F.col("status") == "changed") & ~F.col(f"expected_{m}").eqNullSafe(F.col(f"actual_{m}")), F.lit(m))
                                for m in measures])
    return reconciled.groupBy("status", differ.alias("columns")).agg(F.count("*").alias("rows"))
