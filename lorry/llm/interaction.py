"""Operator 11, filter interaction audit by min-plus removal ranks.

A row is known by the set of filters that it fails, as a bit mask; so all rows
of a part are at most ``2**k`` counts, whatever their number, and everything
that grows with the input is one grouped sum.  With ``k`` filters and the
matrices

* ``cost[mask, f]``: 0 where the mask fails filter ``f``, else infinite;
* ``position[order, f]``: the step of ``f`` in an order (the inverse permutation);

the removal step of a mask in every order is their min-plus product,
``min over f of cost[mask, f] + position[order, f]``.  Counts are scattered by
that step: removed (and labelled rows among them) at it, redundant at the
later steps whose filter the mask fails too.

Defined cases: a null text is empty, a null part the empty string; rows
without a label count as neither good nor toxic; a label table that repeats an
id counts once (the greatest value); repeated ids are not smaller than each
other; a null id is smaller than none and has no smaller; an empty table has
no parts and gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lorry.session import stage

#: filters beyond this many have too many orders for a table of all of them
MOST_FILTERS = 7
MEASURES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def positions(k: int) -> np.ndarray:
    """``position[order, f]``, steps from 1, orders as :func:`itertools.permutations` has them."""
    orders = np.array(list(permutations(range(k))), np.int64).reshape(-1, k)
    out = np.empty_like(orders)
    np.put_along_axis(out, orders, np.arange(1, k + 1)[None, :], axis=1)
    return out


def removal_steps(mask: np.ndarray, position: np.ndarray) -> np.ndarray:
    """``step[mask, order]`` as a min-plus product; ``k + 1`` for a mask that fails nothing."""
    k = position.shape[1]
    never = k + 1
    cost = np.where(mask[:, None] >> np.arange(k) & 1, 0, never)
    return np.minimum((cost[:, None, :] + position[None, :, :]).min(axis=2), never)


def interactions(mask: np.ndarray, n: np.ndarray, good: np.ndarray, toxic: np.ndarray, k: int) -> dict[str, np.ndarray]:
    """Every measure as a matrix ``[order, step - 1]``, from the counts of the masks of one part."""
    position = positions(k)
    step = removal_steps(mask, position)
    orders = np.broadcast_to(np.arange(len(position)), step.shape)

    def scatter(weight: np.ndarray) -> np.ndarray:
        out = np.zeros((len(position), k + 2), np.int64)
        np.add.at(out, (orders, step), np.broadcast_to(weight[:, None], step.shape))
        return out[:, 1:k + 1]

    removed = scatter(n)
    redundant, alone, shapley = (np.zeros((len(position), k), np.int64) for _ in range(3))
    every = np.arange(len(position))
    for f in range(k):
        fails = mask >> f & 1
        at = position[:, f]
        redundant[every, at - 1] = ((n * fails)[:, None] * (step < at[None, :])).sum(axis=0)
        alone[every, at - 1] = n[mask == 1 << f].sum()
        shapley[every, at - 1] = removed[every, at - 1].sum()
    return {"kept": n.sum() - np.cumsum(removed, axis=1), "removed": removed, "redundant": redundant, "unique_fails": alone,
            "good_lost": scatter(good), "toxic_lost": scatter(toxic), "shapley": shapley}


def audit(masked: DataFrame, names: Sequence[str]) -> DataFrame:
    """``part, filter_order, step`` and the :data:`MEASURES`, for every order
    of the filters ``names`` (one letter each).  ``masked`` has one row per
    document: ``part``, ``mask`` (bit ``f`` set: fails ``names[f]``), ``good``,
    ``toxic`` (booleans)."""
    k = len(names)
    if not 0 < k <= MOST_FILTERS:
        raise ValueError(f"1 to {MOST_FILTERS} filters")
    # at most 2**k rows a part from here on
    counts = masked.groupBy("part", "mask").agg(F.count("*").alias("n"), F.count(F.when(F.col("good"), 1)).alias("good"),
                                                F.count(F.when(F.col("toxic"), 1)).alias("toxic"))
    labels = ["".join(p) for p in permutations(names)]

    def one(t: pa.Table) -> pa.Table:
        got = interactions(*(np.asarray(t[c]).astype(np.int64) for c in ("mask", "n", "good", "toxic")), k)
        rows = len(labels) * k
        return pa.table({"part": pa.array([t["part"][0].as_py()] * rows, pa.string()),
                         "filter_order": pa.array(np.repeat(labels, k).tolist(), pa.string()),
                         "step": pa.array(np.tile(np.arange(1, k + 1), len(labels)), pa.int32())}
                        | {m: pa.array(got[m].ravel()) for m in MEASURES})

    return counts.groupBy("part").applyInArrow(one, "part string, filter_order string, step int, " + ", ".join(f"{m} long" for m in MEASURES))


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")


def text_masks(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """``part, mask, good, toxic`` of every document for the filters A (under
    200 words), B (fewer than half of the words distinct), C (over 3 % capital
    letters), D (holds a markup character), E (a smaller id has the same text)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    read = docs.select("doc_id", F.coalesce(F.col(part), F.lit("")).alias("part"), text.alias("text"), words_of(text).alias("words"))
    distinct = F.size(F.array_distinct("words"))
    capitals = F.length(F.regexp_replace("text", "[^A-Z]+", ""))
    fails = [F.size("words") < 200, 100 * distinct < 50 * F.size("words"), 100 * capitals > 3 * F.length("text"), F.col("text").rlike("[#$%&*|]")]
    own = sum((F.when(c, 1 << f).otherwise(0) for f, c in enumerate(fails)), F.lit(0))
    # texts are read once; from here rows are narrow and a text is its digest
    rows = stage(read.select("doc_id", "part", own.alias("own"), F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest")), "masked")
    first = (rows.groupBy("digest").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"))
             .where("lo < hi").select("digest", "lo"))
    told = rows.join(first, "digest", "left").select(
        "doc_id", "part", (F.col("own") + F.when(F.col("doc_id") > F.col("lo"), 1 << len(fails)).otherwise(0)).alias("mask"))
    known = labels.where("doc_id is not null").groupBy("doc_id").agg(F.max("quality").alias("quality"), F.max("toxic").alias("toxic"))
    return told.join(known, "doc_id", "left").select(
        "part", "mask", F.coalesce(F.col("quality") == 1, F.lit(False)).alias("good"), F.coalesce(F.col("toxic") == 1, F.lit(False)).alias("toxic"))
