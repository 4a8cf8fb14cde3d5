"""Connected components of a link table, and a bounded membership filter."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lorry.session import stage


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``id, root`` of every id in a link: the smallest id reachable.

    Every round takes the least label among the neighbours and then follows
    the labels one step (so chains shorten by half); each round is a written
    table.  A hot id is one side of a join on written tables, which adaptive
    execution splits, and minima are combined before the shuffle.
    """
    both = stage(links.select(F.col(a).alias("id"), F.col(b).alias("other"))
                 .union(links.select(F.col(b), F.col(a))).where("id <> other").distinct(), "links")
    labels = stage(both.groupBy("id").agg(F.min("other").alias("least")).select("id", F.least("id", "least").alias("root")), "labels")
    while True:
        near = both.join(labels.withColumnRenamed("id", "other"), "other").groupBy("id").agg(F.min("root").alias("near"))
        told = stage(labels.join(near, "id").select("id", F.col("root").alias("old"), F.least("root", "near").alias("root")), "labels")
        up = told.select(F.col("id").alias("root"), F.col("root").alias("up"))
        labels = stage(told.join(up, "root", "left").select("id", F.least("root", "up").alias("root"), "old"), "labels")
        if not labels.where("root <> old").take(1):
            return labels.select("id", "root")
        labels = labels.select("id", "root")


#: most bits of a filter (16 MB), whatever the number of ids
FILTER_BITS = 1 << 27


def filter_place(ids: np.ndarray, bits: int) -> np.ndarray:
    """The bit of every id."""
    return (ids.astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - bits.bit_length() + 1)).astype(np.int64)


def id_filter(ids: DataFrame, column: str) -> np.ndarray:
    """A bitmap in which the bit of every id is set: a test against it has
    false positives, never false negatives.  Its size follows the count up to
    ``FILTER_BITS``, beyond that it only filters less."""
    bits = int(min(FILTER_BITS, max(1 << 16, 1 << (32 * ids.count()).bit_length())))

    def task(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            at = filter_place(np.asarray(b.column(0).drop_null()), bits)
            word, where = np.unique(at >> 6, return_inverse=True)
            mask = np.zeros(len(word), np.uint64)
            np.bitwise_or.at(mask, where, np.uint64(1) << (at & 63).astype(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(mask.view(np.int64))], ["word", "mask"])

    rows = ids.select(F.col(column).cast("long")).mapInArrow(task, "word long, mask long").groupBy("word").agg(F.bit_or("mask").alias("mask")).toArrow()
    words = np.zeros(bits >> 6, np.uint64)
    words[np.asarray(rows.column("word"))] = np.asarray(rows.column("mask")).view(np.uint64)
    return words


def in_filter(words: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Which ids may be in the filter."""
    at = filter_place(ids, len(words) << 6)
    return (words[at >> 6] >> (at & 63).astype(np.uint64) & np.uint64(1)).astype(bool)


def split_by(docs: DataFrame, ids: DataFrame, column: str = "doc_id", own: str | None = None) -> tuple[DataFrame, DataFrame]:
    """``docs`` in two parts: rows whose ``own`` (or ``column``) cannot be in
    ``ids``, and the rest (few, if ``ids`` are), so that only the rest has to
    be moved to meet ``ids``."""
    words = docs.sparkSession.sparkContext.broadcast(id_filter(ids, column))

    def maybe(s: pa.Array) -> pa.Array:
        return pa.array(in_filter(words.value, np.asarray(s)))

    flag = F.arrow_udf(maybe, "boolean")(F.coalesce(F.col(own or column).cast("long"), F.lit(0).cast("long")))
    return docs.where(~flag), docs.where(flag)


def without(docs: DataFrame, ids: DataFrame, column: str = "doc_id") -> DataFrame:
    """``docs`` without the rows whose id is in ``ids``; rows with a null id stay."""
    clear, rest = split_by(docs, ids, column)
    return clear.union(rest.join(ids.select(column), column, "left_anti").select(*docs.columns))
