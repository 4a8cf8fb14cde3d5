"""Operator 5, MinHash near-duplicates with tensored banding.

Two collections A and B of ``m`` groups of ``r`` minhashes each are computed
per shingle set; the key of table (i, j) is the pair (A_i, B_j), so
``2 m r`` minhashes serve ``m * m`` tables of ``2 r`` rows.  A pair of
similarity s meets in some table with probability ``(1 - (1 - s^r)^m)^2``:
with r = 3, m = 16 at s = 0.85 it is missed less than once in a million.

Steps, each a Spark job on hash keys:

1. every text gives its shingle count, a 128-bit digest of its set, and its
   groups; texts of equal sets become one class (its smallest id);
2. only groups that two classes share are kept, and table keys are formed
   from a class's shared A and B groups;
3. in every table bucket each member is compared with the bucket's smallest
   member, which is linear in the bucket whatever its size, and confirmed
   links are joined to components;
4. members of buckets that still hold two components are compared exactly: a
   linked pair must share a shingle among the rarest of both sets (prefix
   filter, with any common order of shingles), and where they share the first
   one enough must follow on both sides (positional filter); texts of
   different components that pass are confirmed on their full sets.

A link needs ``100 * intersection >= percent * union`` on the full sets of
distinct shingles (64-bit hashes); no bucket is capped.

Defined cases: words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased; a text
with fewer words than ``k`` is one shingle; a null or empty text has none and
is linked with nothing; a row with a null id has no component; rows that repeat an id are one document, linked with whatever any
of its texts is linked with; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lorry.llm import graph
from lorry.llm import textvec as tv
from lorry.llm.graph import in_filter
from lorry.session import stage

#: buckets of the shingle counts that order the prefixes (4 MB, whatever the corpus holds)
ORDER_BUCKETS = 1 << 20


def sets_of(column: pa.Array, k: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first row, last row + 1, shingle, row)`` with the distinct shingles of each row, ascending."""
    for lo, hi, buf, offs in tv.batches(column):
        h, doc = tv.distinct(*tv.shingles(tv.words(buf, offs), hi - lo, k))
        yield lo, hi, h, doc


def signatures(docs: DataFrame, k: int, r: int, m: int) -> DataFrame:
    """``doc_id, n, d1, d2, groups``: set size, set digest, the 2m group hashes (A, then B)."""

    def task(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flip, factor = tv.constants(21, 2 * m * r), tv.constants(22, 2 * m * r) | np.uint64(1)
        for b in it:
            ids = b.column(0)
            for lo, hi, h, doc in sets_of(b.column(1), k):
                size = hi - lo
                n = np.bincount(doc, minlength=size)
                some = np.flatnonzero(n)
                starts = (np.cumsum(n) - n)[some]
                d1, d2 = np.zeros(size, np.uint64), np.zeros(size, np.uint64)
                groups = np.zeros((len(some), 2 * m), np.uint64)
                if len(some):
                    d1[some] = np.add.reduceat(h, starts)
                    d2[some] = np.add.reduceat(tv.mix(h ^ np.uint64(0x5851F42D4C957F2D)), starts)
                    for g in range(2 * m):
                        key = np.full(len(some), g + 1, np.uint64)
                        for j in range(g * r, g * r + r):
                            key = tv.mix(key * np.uint64(tv.PRIME) ^ np.minimum.reduceat((h ^ flip[j]) * factor[j], starts))
                        groups[:, g] = key
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(lo, size), pa.array(n), pa.array(d1.view(np.int64)), pa.array(d2.view(np.int64)),
                     tv.lists(groups.ravel().view(np.int64), np.repeat(some, 2 * m), size, pa.int64())],
                    ["doc_id", "n", "d1", "d2", "groups"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(tv.tidy(task), "doc_id long, n long, d1 long, d2 long, groups array<long>")


def shingle_sets(docs: DataFrame, ids: DataFrame, k: int) -> DataFrame:
    """``doc_id, n, shingles`` of at least the documents in ``ids`` (a column
    ``doc_id``), without moving texts: tasks skip what a bounded filter of the
    ids rules out."""
    sent = docs.sparkSession.sparkContext.broadcast(graph.id_filter(ids, "doc_id"))

    def task(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            b = b.filter(pa.array(in_filter(sent.value, np.asarray(b.column(0)))))
            for lo, hi, h, doc in sets_of(b.column(1), k):
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, hi - lo), pa.array(np.bincount(doc, minlength=hi - lo)),
                     tv.lists(h.view(np.int64), doc, hi - lo, pa.int64())], ["doc_id", "n", "shingles"])

    return (docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
            .mapInArrow(tv.tidy(task), "doc_id long, n long, shingles array<long>").where("n > 0"))


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a, b`` whose full sets are similar enough."""
    left = sets.select(F.col("doc_id").alias("a"), F.col("n").alias("n_a"), F.col("shingles").alias("s_a"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("n").alias("n_b"), F.col("shingles").alias("s_b"))
    both = F.size(F.array_intersect("s_a", "s_b"))
    return (pairs.join(right, "b").join(left, "a")
            .where(100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))
            .where(100 * both >= percent * (F.col("n_a") + F.col("n_b") - both)).select("a", "b"))


def _rare_first(sets: DataFrame, percent: int) -> DataFrame:
    """``doc_id, n, root, shingle, place``: the prefix of every set, rarest shingles first."""
    spark = sets.sparkSession

    def count(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(ORDER_BUCKETS, np.int64)
        for b in it:
            at = np.asarray(b.column(0).flatten()).view(np.uint64) & np.uint64(ORDER_BUCKETS - 1)
            total += np.bincount(at.astype(np.int64), minlength=ORDER_BUCKETS)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["bucket", "n"])

    rows = sets.select("shingles").mapInArrow(tv.tidy(count), "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    common = np.zeros(ORDER_BUCKETS, np.int64)
    common[np.asarray(rows.column("bucket"))] = np.asarray(rows.column("n"))
    sent = spark.sparkContext.broadcast(np.minimum(common, 2**31 - 1).astype(np.int32))

    def prefix(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            lists = b.column("shingles")
            n = np.diff(np.asarray(lists.offsets))
            h = np.asarray(lists.flatten()).view(np.uint64)
            doc = np.repeat(np.arange(len(n)), n)
            order = np.lexsort((h, sent.value[(h & np.uint64(ORDER_BUCKETS - 1)).astype(np.int64)], doc))
            place = np.arange(len(h)) - np.repeat(np.cumsum(n) - n, n)
            keep = place < (n - -(-n * percent // 100) + 1)[doc]
            at = pa.array(doc[keep])
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").take(at), b.column("n").take(at), b.column("root").take(at), pa.array(h[order][keep].view(np.int64)),
                 pa.array(place[keep])], ["doc_id", "n", "root", "shingle", "place"])

    return sets.mapInArrow(tv.tidy(prefix), "doc_id long, n long, root long, shingle long, place long")


def near_duplicates(docs: DataFrame, percent: int = 85, k: int = 5, r: int = 3, m: int = 16) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id`` (the
    smallest id reachable over links, itself included)."""
    signed = stage(signatures(docs, k, r, m), "signatures")
    sized = signed.where("n > 0 and doc_id is not null")
    classes = stage(sized.groupBy("d1", "d2", "n").agg(F.min("doc_id").alias("rep")), "classes")
    reps = sized.join(classes.select("d1", "d2", F.col("rep").alias("doc_id")), ["d1", "d2", "doc_id"]).select("doc_id", "n", "groups")
    groups = stage(reps.select("doc_id", "n", F.posexplode("groups").alias("place", "g")), "groups")
    shared = stage(groups.groupBy("g").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).where("lo < hi").select("g"), "shared")
    own = (groups.join(shared, "g").groupBy("doc_id").agg(
        F.min("n").alias("n"), F.collect_set(F.when(F.col("place") < m, F.col("g"))).alias("ga"),
        F.collect_set(F.when(F.col("place") >= m, F.col("g"))).alias("gb")))  # at most m each
    keys = stage(own.select("doc_id", "n", F.explode("ga").alias("x"), "gb").select("doc_id", "n", "x", F.explode("gb").alias("y"))
                 .select("doc_id", "n", F.xxhash64("x", "y").alias("key")), "keys")
    tables = stage(keys.groupBy("key").agg(F.min(F.struct("doc_id", "n")).alias("first"), F.max("doc_id").alias("hi"))
                   .where("first.doc_id < hi").select("key", "first"), "tables")
    met = keys.join(tables, "key")
    pairs = stage(met.where("doc_id > first.doc_id").where(100 * F.least("n", "first.n") >= percent * F.greatest("n", "first.n"))
                  .select(F.col("first.doc_id").alias("a"), F.col("doc_id").alias("b")).distinct(), "pairs")
    members = stage(met.select("doc_id").distinct(), "members")
    sets = stage(shingle_sets(docs, members, k).join(members, "doc_id", "left_semi"), "sets")
    links = stage(confirmed(pairs, sets, percent), "confirmed")
    roots = graph.components(links)
    # buckets that still hold two components
    rooted = members.join(roots.withColumnRenamed("id", "doc_id"), "doc_id", "left").select("doc_id", F.coalesce("root", "doc_id").alias("root"))
    rooted = stage(rooted, "rooted")
    keyed = keys.join(rooted, "doc_id").select("doc_id", "root", "key")
    mixed = stage(keyed.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo < hi").select("key"), "mixed")
    open_ids = stage(keyed.join(mixed, "key", "left_semi").select("doc_id", "root").distinct(), "open")
    prefixes = stage(_rare_first(sets.join(open_ids, "doc_id"), percent), "prefixes")
    # at the first shingle that two sets share, no more than what follows in either can be common
    needed = f"{100 + percent} * (n - place) >= {percent} * (n + least)"
    split = stage(prefixes.groupBy("shingle").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.min("n").alias("least"))
                  .where("lo < hi").select("shingle", "least"), "split")
    rows = stage(prefixes.join(split, "shingle").where(needed).drop("least"), "prefixes")
    x, y = (rows.select("shingle", *(F.col(c).alias(f"{c}_{s}") for c in ("doc_id", "n", "root")), (F.col("n") - F.col("place")).alias(f"rest_{s}"))
            for s in "ab")
    rest = stage(x.join(y, "shingle").where("doc_id_a < doc_id_b and root_a <> root_b")
                 .where((100 + percent) * F.least("rest_a", "rest_b") >= percent * (F.col("n_a") + F.col("n_b")))
                 .select(F.col("doc_id_a").alias("a"), F.col("doc_id_b").alias("b")).distinct(), "rest")
    more = stage(confirmed(rest, sets, percent), "confirmed")
    # an id that comes with several texts is one document: its texts' classes belong together
    several = (sized.groupBy("doc_id").agg(F.min(F.struct("d1", "d2", "n")).alias("lo"), F.max(F.struct("d1", "d2", "n")).alias("hi"))
               .where("lo <> hi").select("doc_id"))
    same = (sized.select("doc_id", "d1", "d2", "n").join(several, "doc_id", "left_semi").join(classes, ["d1", "d2", "n"])
            .select(F.col("rep").alias("a"), F.col("doc_id").alias("b")).where("a <> b"))
    roots = graph.components(links.union(more).union(same))
    rep_roots = classes.join(roots.withColumnRenamed("id", "rep"), "rep", "left").select("d1", "d2", "n", F.coalesce("root", "rep").alias("own"))
    return (signed.join(stage(rep_roots, "roots"), ["d1", "d2", "n"], "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.when(F.col("doc_id").isNotNull(), F.coalesce("own", "doc_id")).alias("component_id")))
