"""Per-key lookups that the reference writes as correlated ``LIMIT 1`` or
LISTAGG subqueries.  Each becomes one grouped aggregate over the lookup table
(a single scan, partial aggregation before the shuffle), joined back by key.
Arbitrary ``LIMIT 1`` picks become deterministic minima.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lorry.functions.columns import account_segment
from lorry.operators.numbering import number_items
from lorry.session import stage

# Trace types listed on pickup and delivery stop lines; the
# "pick up modification" variant lists 'Y' instead of '1' for pickups.
PICKUP_TRACE_TYPES = ("B", "P", "K", "S", "V", "1")
PICKUP_TRACE_TYPES_Y = ("B", "P", "K", "S", "V", "Y")
DELIVERY_TRACE_TYPES = ("B", "P", "K", "S", "V", "2")

# Status-code pairs of the four gross-margin milestones.
MILESTONES = {
    "shipper_arrive": ("ARRSHIP", "BR-ARRSHIP"),
    "shipper_depart": ("DEPSHIP", "BR-DEPSHIP"),
    "consignee_arrive": ("ARRCONS", "BR-ARRCONS"),
    "consignee_depart": ("DEPCONS", "BR-DEPCONS"),
}


def latest_audit(reg_audit: DataFrame, source_reg: str = "Billing Register", companies=(0, 1)) -> DataFrame:
    """B1: one row, ``source_audit`` = the newest audit batch of the register.

    A global aggregate: always exactly one row, so it is safe to broadcast.
    """
    return reg_audit.filter(
        (F.col("source_reg") == source_reg) & F.col("company_id").isin(*companies)
    ).agg(F.max("source_audit").alias("source_audit"))


def first_trace(trace: DataFrame, types: dict[str, str], bills: DataFrame | None = None, key: str = "detail_line_id") -> DataFrame:
    """One trace number per bill and trace type, e.g. ``{'po': 'P', 'bol': '1'}``.

    One scan of TRACE, one conditional ``min`` per requested type (the
    reference runs one ``LIMIT 1`` subquery per column).  ``bills`` (a frame
    with column ``key``) restricts the scan to the bills of interest before
    the shuffle.
    """
    tr = trace.filter(F.col("trace_type").isin(*types.values()))
    if bills is not None:
        tr = tr.join(bills.select(F.col(key).alias("detail_number")), "detail_number", "left_semi")
    aggs = [
        F.min(F.when(F.col("trace_type") == code, F.col("trace_number"))).alias(name)
        for name, code in types.items()
    ]
    return tr.groupBy(F.col("detail_number").alias(key)).agg(*aggs)


#: entries of one bill that are put into text at a time
ENTRIES = 50_000


def trace_list(trace: DataFrame, pickup_types: Sequence[str] = PICKUP_TRACE_TYPES,
               delivery_types: Sequence[str] = DELIVERY_TRACE_TYPES, key: str = "detail_line_id", most: int = ENTRIES) -> DataFrame:
    """Per bill, the distinct ``DESC: NUMBER`` texts joined by ', ' for the
    pickup list (``trace_p``) and the delivery list (``trace_d``).

    The reference's LISTAGG has no order; we sort so results are stable.
    Distinct pairs are formed first (a shuffle on bill+text with map-side
    de-duplication), so each bill's set holds only distinct entries.  A bill
    with more than ``most`` of them is put together in two steps: its entries
    are numbered across tasks, runs of ``most`` become text, and the texts of
    the runs are joined in order.
    """
    item = F.concat(F.col("trace_desc"), F.lit(": "), F.col("trace_number"))
    pairs = (
        trace.filter(F.col("trace_type").isin(*set(pickup_types) | set(delivery_types)))
        .select(
            F.col("detail_number").alias(key),
            item.alias("item"),
            F.col("trace_type").isin(*pickup_types).alias("is_p"),
            F.col("trace_type").isin(*delivery_types).alias("is_d"),
        )
        .groupBy(key, "item")
        .agg(F.max("is_p").alias("is_p"), F.max("is_d").alias("is_d"))
    )
    pairs = stage(pairs, "trace-entries")

    def joined(flag: str):
        return F.array_join(F.array_sort(F.collect_list(F.when(F.col(flag), F.col("item")))), ", ")

    # an empty list is NULL in SQL's LISTAGG
    lists = [F.nullif(joined("is_p"), F.lit("")).alias("trace_p"), F.nullif(joined("is_d"), F.lit("")).alias("trace_d")]
    long = stage(pairs.groupBy(key).count().where(F.col("count") > most).select(key), "long-lists")
    if not long.take(1):
        return pairs.groupBy(key).agg(*lists)
    short = pairs.join(long, key, "left_anti").groupBy(key).agg(*lists)
    rest = number_items(pairs.join(long, key, "left_semi").where("item is not null"), [key], [F.col("item")], out="nth")
    runs = rest.groupBy(key, F.floor((F.col("nth") - 1) / most).alias("run")).agg(*lists)

    def in_order(column: str):
        return F.concat_ws(", ", F.transform(F.array_sort(F.collect_list(F.when(F.col(column).isNotNull(), F.struct("run", column)))), lambda x: x[column]))

    return short.unionByName(runs.groupBy(key).agg(*[F.nullif(in_order(c), F.lit("")).alias(c) for c in ("trace_p", "trace_d")]))


def notes_lookup(notes: DataFrame, prog_table: str, note_types: dict[str, str], key: str = "id_key") -> DataFrame:
    """First note per key for each requested note type, e.g. ``{'note_p': '1'}``."""
    n = notes.filter((F.col("prog_table") == prog_table) & F.col("note_type").isin(*note_types.values()))
    aggs = [F.min(F.when(F.col("note_type") == t, F.col("the_note"))).alias(name) for name, t in note_types.items()]
    return n.groupBy(F.col("id_key").alias(key)).agg(*aggs)


def code_description(codes: DataFrame, seg_name: str = "PR", ele_nbr: int = 1, out: str = "description") -> DataFrame:
    """One description per code value (first = minimum) from an EDI code table."""
    return (
        codes.filter((F.col("seg_name") == seg_name) & (F.col("ele_nbr") == ele_nbr))
        .groupBy("value")
        .agg(F.min("description").alias(out))
    )


def port_of_entry(customs: DataFrame, ace: DataFrame, aci: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Per default-broker customs row, the port description: origin
    country CA reads the ACE table, anything else (NULL too) the ACI table.
    ``keep`` carries more customs columns along (one output row per customs row).
    """
    c = customs.filter(F.col("default_broker") == "True")
    ace_d = code_description(ace, out="ace_desc").withColumnRenamed("value", "ace_value")
    aci_d = code_description(aci, out="aci_desc").withColumnRenamed("value", "aci_value")
    c = c.join(ace_d, c.port_of_entry == ace_d.ace_value, "left").join(aci_d, c.port_of_entry == aci_d.aci_value, "left")
    return c.select(
        "detail_line_id",
        *keep,
        F.when(F.col("orig_country") == "CA", F.col("ace_desc")).otherwise(F.col("aci_desc")).alias("port_of_entry"),
    )


def skid_units(tldtl: DataFrame, width: int = 20) -> DataFrame:
    """Distinct pallet-unit codes per order, concatenated without a
    separator (sorted) and cut to ``width`` characters.

    Of an order's codes no more than the first ``width`` that are not empty,
    and the empty one, can show; only these are collected.  The limit on the
    rank is pushed below the shuffle by order, so an order of very many
    distinct codes sends few rows from each task.
    """
    first = Window.partitionBy("order_id").orderBy(F.col("pallet_units").asc_nulls_last())
    few = tldtl.select("order_id", "pallet_units").distinct().withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= width + 1)
    return few.groupBy("order_id").agg(
        F.substring(F.array_join(F.array_sort(F.collect_list("pallet_units")), ""), 1, width).alias("skid_units")
    )


def safe_zone(zone: DataFrame) -> DataFrame:
    """One row per zone id (max of each attribute), so joins cannot fan out."""
    return zone.groupBy("zone_id").agg(F.max("province").alias("province"), F.max("is_terminal").alias("is_terminal"))


def milestones(odrstat: DataFrame, key: str = "order_id") -> DataFrame:
    """First time of each milestone per order, one scan of ODRSTAT."""
    codes = sorted({c for pair in MILESTONES.values() for c in pair})
    s = odrstat.filter(F.col("status_code").isin(*codes))
    aggs = [F.min(F.when(F.col("status_code").isin(*pair), F.col("changed"))).alias(name) for name, pair in MILESTONES.items()]
    return s.groupBy(F.col("order_id").alias(key)).agg(*aggs)


def feet(tldtl: DataFrame) -> DataFrame:
    """Total length of the non-picked goods lines per order."""
    return tldtl.filter(F.col("pick_id") == 0).groupBy("order_id").agg(F.sum("length_1").alias("feet"))


def account_quality(billgl: DataFrame) -> DataFrame:
    """How many ledger lines, and how many whose account has no middle
    segment (no second hyphen), for which the segment columns are NULL."""
    return billgl.agg(F.count("*").alias("lines"),
                      F.count_if(account_segment("acct_code").isNull()).alias("without_segment"))


def beside(a: str | Column, b: str | Column) -> Column:
    """Equality that is checked on rows that the other columns of a join have
    brought together: the join does not deal rows out by it."""
    a, b = (F.col(c) if isinstance(c, str) else c for c in (a, b))
    return (a <= b) & (a >= b)


def lookup(df: DataFrame, table: DataFrame, key: str, row: Sequence[str], also: Column | None = None) -> DataFrame:
    """``df`` left-joined with ``table`` on ``key`` (and the condition ``also``), a key that many rows may lack.

    Rows without a key match nothing, but a join on the key alone sends all
    of them to one task.  A second join column (0 on rows with a key and in
    the table, a hash of the columns ``row`` on the others) deals them out
    over all tasks; consecutive lookups on one key reuse the partitioning.
    """
    spread = f"_spread_{key}"
    if spread not in df.columns:
        df = df.withColumn(spread, F.when(F.col(key).isNull(), F.xxhash64(*row).bitwiseOR(F.lit(1))).otherwise(F.lit(0).cast("long")))
    # 0, but not as a constant: the optimizer would drop a constant from the join's keys
    table = table.withColumn(spread, F.pmod(F.xxhash64(key), F.lit(1)))
    if also is None:
        return df.join(table, [key, spread], "left")
    table = table.withColumnsRenamed({key: "_t_key", spread: "_t_spread"})
    return df.join(table, (F.col(key) == F.col("_t_key")) & (F.col(spread) == F.col("_t_spread")) & also, "left").drop("_t_key", "_t_spread")
