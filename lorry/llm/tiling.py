"""Operator 4, benchmark decontamination by greedy string tiling.

Tokens are lower-cased words without ASCII punctuation, as 64-bit hashes.
Running Karp-Rabin hashes of ``seed`` tokens of the benchmark are joined with
those of every document: equal windows on one diagonal make up the maximal
common runs.  Tiling marks the longest run whose tokens are unmarked on both
sides, puts back what is left of the runs that it cuts, and goes on until no
run of ``seed`` tokens remains; so passages are found in any order.  The
coverage of an item is the share of its tokens that are marked.

Documents stay where they are.  The benchmark is sent to the tasks in blocks
of at most about ``block_tokens`` tokens (checked; a larger benchmark means
more passes, a stated query set against all rows, in blocks), and a document
meets only the items that share a seed with it.

Defined cases: a null or empty text, or one of punctuation, has no tokens and
covers nothing; an item without tokens, or with a null text or id, matches
nothing; an item shorter than ``seed`` tokens is its own seed; equal items
are all reported; rows that repeat an id are tiled one by one (the reports of
an id are put together by the caller); ties go to the run that is first in
the item, then in the document; without documents or items the result is
empty.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lorry.llm import textvec as tv

BLOCK_TOKENS = 1 << 20
ROWS = "doc_id long, item_id long, item_tokens long, covered long, coverage double, tiles array<struct<doc:long,item:long,n:long>>"


def tokens(buf: np.ndarray, offs: np.ndarray) -> tv.Words:
    """Words of the chunk with ASCII punctuation as white space."""
    plain = np.arange(256, dtype=np.uint8)
    plain[33:48] = plain[58:65] = plain[91:97] = plain[123:127] = 32
    return tv.words(plain[buf], offs)


def windows(h: np.ndarray, doc: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Running hash of every ``k`` tokens within a document, and where each begins."""
    n = len(h)
    if n < k:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    p = tv.powers(k + 1, 0xD6E8FEB86659FD93)
    total = np.zeros(n - k + 1, np.uint64)
    for j in range(k):
        total += h[j:n - k + 1 + j] * p[j + 1]
    at = np.flatnonzero(doc[:n - k + 1] == doc[k - 1:])
    return tv.mix(total[at]), at


def tile(doc_at: np.ndarray, item_at: np.ndarray, k: int, n_doc: int, n_item: int) -> list[tuple[int, int, int]]:
    """Tiles ``(doc, item, n)`` from the seed pairs of one document and one item."""
    diagonal = doc_at - item_at
    order = np.lexsort((doc_at, diagonal))
    d, g = doc_at[order], diagonal[order]
    cut = np.flatnonzero((np.diff(g) != 0) | (np.diff(d) != 1)) + 1
    lo = np.concatenate([[0], cut])
    n = np.diff(np.concatenate([lo, [len(d)]])) + k - 1
    runs = [(-int(m), int(a - x), int(a)) for m, a, x in zip(n, d[lo], g[lo], strict=True)]
    heapq.heapify(runs)
    in_doc, in_item = np.zeros(n_doc, bool), np.zeros(n_item, bool)
    out = []
    while runs:
        m, i, a = heapq.heappop(runs)
        m = -m
        marked = in_doc[a:a + m] | in_item[i:i + m]
        if not marked.any():
            in_doc[a:a + m] = in_item[i:i + m] = True
            out.append((a, i, m))
            continue
        free = np.flatnonzero(np.diff(np.concatenate([[True], marked, [True]]).astype(np.int8)))
        for s, e in zip(free[::2], free[1::2], strict=True):
            if e - s >= k:
                heapq.heappush(runs, (-int(e - s), int(i + s), int(a + s)))
    return out


class _Block:
    """Items with their seeds, sorted; one seed length at a time."""

    def __init__(self, ids: list[int], texts: list[str], seed: int):
        self.ids, self.n = [], []
        by_length: dict[int, list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = {}
        for _, _, buf, offs in tv.batches(pa.array(texts, pa.string()), 1 << 62):
            w = tokens(buf, offs)
            self.ids, self.n = ids, np.bincount(w.doc, minlength=len(ids))
            first = np.cumsum(self.n) - self.n
            for k in {min(seed, int(x)) for x in self.n if x}:
                mine = (self.n >= seed) if k == seed else (self.n == k)
                keep = mine[w.doc]
                h, at = windows(w.hash[keep], w.doc[keep], k)
                item = w.doc[keep][at]
                by_length.setdefault(k, []).append((h, item, np.flatnonzero(keep)[at] - first[item]))
        self.seeds = []
        for k, parts in sorted(by_length.items()):
            h, item, at = (np.concatenate(x) for x in zip(*parts, strict=True))
            order = np.argsort(h, kind="stable")
            key, start, count = np.unique(h[order], return_index=True, return_counts=True)
            self.seeds.append((k, key, start, count, item[order], at[order]))


def tile_documents(docs: DataFrame, items: DataFrame, seed: int = 5, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """One row per document and item that share a seed: ``doc_id, item_id,
    item_tokens, covered, coverage, tiles`` (token offsets and lengths)."""
    spark = docs.sparkSession
    held = items.where("item_id is not null and text is not null").select(F.col("item_id").cast("long").alias("item_id"), "text")
    # bytes bound tokens: two bytes a token at least
    total = held.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_blocks = max(1, -(-total // (2 * block_tokens)))
    out = None
    for block in range(n_blocks):
        rows = held.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks)) == block).orderBy("item_id", "text").collect()
        sent = spark.sparkContext.broadcast(([r["item_id"] for r in rows], [r["text"] for r in rows]))
        part = _tile_block(docs, sent, seed)
        out = part if out is None else out.union(part)
    return out


def _tile_block(docs: DataFrame, sent, seed: int) -> DataFrame:
    def task(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = _Block(*sent.value, seed)
        for b in it:
            for lo, hi, buf, offs in tv.batches(b.column(1)):
                w = tokens(buf, offs)
                n = np.bincount(w.doc, minlength=hi - lo)
                first = np.cumsum(n) - n
                found: dict[tuple[int, int], list] = {}
                for k, key, start, count, item, at in block.seeds:
                    h, place = windows(w.hash, w.doc, k)
                    where = np.minimum(np.searchsorted(key, h), len(key) - 1)
                    hit = np.flatnonzero(key[where] == h)
                    if not len(hit):
                        continue
                    where, place = where[hit], place[hit]
                    for doc in np.unique(w.doc[place]):  # pairs of one document at a time
                        mine = w.doc[place] == doc
                        times = count[where[mine]]
                        which = np.repeat(start[where[mine]] - (np.cumsum(times) - times), times) + np.arange(int(times.sum()))
                        in_doc = np.repeat(place[mine] - first[doc], times)
                        order = np.argsort(item[which], kind="stable")
                        its = item[which][order]
                        for part in np.split(order, np.flatnonzero(np.diff(its)) + 1):
                            i = int(item[which[part[0]]])
                            found[int(doc), i] = tile(in_doc[part], at[which[part]], k, int(n[doc]), int(block.n[i]))
                if found:
                    pairs = sorted(found)
                    covered = [sum(t[2] for t in found[p]) for p in pairs]
                    size = [int(block.n[i]) for _, i in pairs]
                    yield pa.RecordBatch.from_pylist([
                        {"doc_id": b.column(0)[lo + d].as_py(), "item_id": block.ids[i], "item_tokens": s, "covered": c, "coverage": c / s,
                         "tiles": [{"doc": x, "item": y, "n": z} for x, y, z in found[d, i]]}
                        for (d, i), c, s in zip(pairs, covered, size, strict=True)], schema=_schema())

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(tv.tidy(task), ROWS)


def _schema() -> pa.Schema:
    tiles = pa.list_(pa.struct([("doc", pa.int64()), ("item", pa.int64()), ("n", pa.int64())]))
    return pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("item_tokens", pa.int64()), ("covered", pa.int64()),
                      ("coverage", pa.float64()), ("tiles", tiles)])


def contaminated(tiles: DataFrame, threshold: float = 0.6) -> DataFrame:
    """One row per document that covers an item to ``threshold`` or more:
    ``doc_id, items`` (ascending), ``coverage`` (the best)."""
    return (tiles.where(F.col("coverage") >= threshold).groupBy("doc_id")
            .agg(F.array_sort(F.collect_set("item_id")).alias("items"), F.max("coverage").alias("coverage")))
