"""Operator 12, repeated passages by recompression.

A word goes if a window of ``size`` words that covers it also starts in a
document with a smaller id; windows are judged on the input.

**Names.**  A word sequence is rewritten level by level: runs of one symbol
become a symbol (run compression, at every fourth level), then neighbours ``x y`` whose symbols' bits
are 0 and 1 become one (pair compression).  A name is a 128-bit hash of what
it stands for, so all tasks give equal strings equal names and no dictionary
has to be shuffled.  What a window's content alone decides at a level is its
*interior*: where runs are compressed the first and last run are popped, as
they may go on outside, then a first symbol of bit 1 and a last one of bit 0,
as they may pair outside.
Equal windows have equal interiors and equal popped symbols at every level;
the popped symbols, in order, spell the window, so their combined name is the
window's.

**Rounds.**  Each is a Spark job that groups by name, from high symbols to low:

1. *phrases*: symbols of the top level (some 40 words), with the window at
   their last word.  A phrase that a smaller document also has is repeated as a
   whole; it is marked and takes no further part, as any window in it first
   occurs in a phrase that is not;
2. *anchors*: of the one or two symbols that end a window's interior at the
   last level that leaves any, the one of the least name.  Windows whose anchor
   no other document has are unique;
3. *windows*: the names of the others decide.

What tasks learn of other rows before a shuffle is a filter of bounded size
whose errors only add rows; all decisions are made in joins on full names.

Defined cases: words are ``[^\\x20\\x09-\\x0D]+``, case-sensitive; a null text
has none; texts under ``size`` words keep all; null ids count as smaller than
any other; rows that repeat an id are not smaller than each other; an empty
table gives an empty result.  A task holds some 150 bytes a word of one text
(or of a quarter MB of texts).
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lorry.llm import graph
from lorry.llm import textvec as tv
from lorry.session import stage

SIZE = 50
#: levels of the rewriting; each leaves some three symbols of four
LEVELS = 13
#: runs are compressed at every so manyth level from the first on: the symbols that a
#: window loses to its first and last run are the longer, the higher the level
RUNS_EVERY = 4
#: windows that are followed through the levels at a time
BLOCK = 1 << 15

_K = tv.constants(61, 8) | np.uint64(1)


def _join(x: np.ndarray, y: np.ndarray, lane: int) -> np.ndarray:
    """Hashes of ordered pairs."""
    return tv.mix((x * _K[lane] ^ x >> np.uint64(32)) * _K[lane + 2] + y)


def word_names(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``start, stop`` (bytes), ``doc``, and the two halves of the name of every word."""
    separator = np.zeros(256, bool)
    separator[list(tv.SEPARATORS)] = True
    inside = ~separator[buf]
    begin, last = inside.copy(), inside.copy()
    begin[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    at = offs[(offs > 0) & (offs < len(buf))]
    begin[at] = inside[at]
    last[at - 1] = inside[at - 1]
    start, stop = np.flatnonzero(begin), np.flatnonzero(last) + 1
    if not len(start):
        none = np.zeros(0, np.uint64)
        return start, stop, np.zeros(0, np.int64), none, none
    length = stop - start
    where = np.flatnonzero(inside)
    first = np.cumsum(length) - length
    place = np.arange(len(where)) - np.repeat(first, length)
    value = tv.mix((place.astype(np.uint64) << np.uint64(8) | buf[where]) * np.uint64(tv.PRIME) + _K[4])
    a = tv.mix(np.add.reduceat(value, first) + length.astype(np.uint64))
    b = tv.mix(np.add.reduceat((value ^ value >> np.uint64(29)) * _K[5], first) + length.astype(np.uint64) * _K[6])
    return start, stop, np.searchsorted(offs, start, "right") - 1, a, b


class Level(NamedTuple):
    """One round of rewriting: symbols, their runs, and the pairs of runs."""

    a: np.ndarray  # names of the symbols
    b: np.ndarray
    run: np.ndarray | None  # run of each symbol; None where runs stay symbols of their own
    run_start: np.ndarray | None  # first symbol of each run, and the end
    run_a: np.ndarray  # names of the runs
    run_b: np.ndarray
    right: np.ndarray  # bit of each run
    above: np.ndarray  # symbol of the next level of each run


class Recompression:
    """The levels of a chunk of texts (their words' names one after the other)."""

    def __init__(self, a: np.ndarray, b: np.ndarray, doc: np.ndarray, levels: int = LEVELS):
        self.n = len(a)
        start = np.arange(self.n)
        self.levels: list[Level] = []
        for k in range(levels if self.n else 0):
            run = run_start = None
            ra, rb = a, b
            if k % RUNS_EVERY == 0:
                new = np.ones(len(a), bool)
                new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1]) | (doc[1:] != doc[:-1])
                run = (np.cumsum(new) - 1).astype(np.int32)
                head = np.flatnonzero(new)
                run_start = np.append(head, len(a))
                ra, rb, doc, start = a[head], b[head], doc[head], start[head]
                length = np.diff(run_start)
                many = np.flatnonzero(length > 1)
                if len(many):
                    times = length[many].astype(np.uint64)
                    ra[many], rb[many] = _join(ra[many] ^ _K[7], times, 0), _join(rb[many] ^ _K[7], times, 1)
            right = (tv.mix(ra + tv.constants(62, levels)[k]) & np.uint64(1)).astype(bool)
            pair = ~right[:-1] & right[1:] & (doc[:-1] == doc[1:])
            stays = np.ones(len(ra), bool)
            stays[1:] = ~pair
            self.levels.append(Level(a, b, run, run_start, ra, rb, right, (np.cumsum(stays) - 1).astype(np.int32)))
            na, nb = ra.copy(), rb.copy()
            at = np.flatnonzero(pair)
            na[at], nb[at] = _join(ra[at], ra[at + 1], 0), _join(rb[at], rb[at + 1], 1)
            a, b, doc, start = na[stays], nb[stays], doc[stays], start[stays]
        self.a, self.b, self.doc, self.start = a, b, doc, start

    def windows(self, at: np.ndarray, size: int, named: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``anchor`` and, if ``named``, the two halves of the name of the
        windows of ``size`` words at the words ``at`` (each within a text)."""
        anchor = np.zeros(len(at), np.uint64)
        a, b = (np.zeros(len(at) if named else 0, np.uint64) for _ in range(2))
        for lo in range(0, len(at), BLOCK):
            part = slice(lo, lo + BLOCK)
            anchor[part], *names = self._windows(at[part], size, named)
            if named:
                a[part], b[part] = names
        return anchor, a, b

    def _windows(self, at: np.ndarray, size: int, named: bool) -> tuple[np.ndarray, ...]:
        n = len(at)
        anchor = np.zeros(n, np.uint64)
        spelled = np.zeros((4, n), np.uint64)  # popped on the left (two halves), on the right
        who, lo, hi = np.arange(n), at.astype(np.int64), at.astype(np.int64) + size - 1

        def pop(which: np.ndarray, side: int, a: np.ndarray, b: np.ndarray, times: np.ndarray | int) -> None:
            if named:
                w = who[which]
                spelled[2 * side, w] = _join(spelled[2 * side, w] + np.uint64(1), a + times * _K[3], 0)
                spelled[2 * side + 1, w] = _join(spelled[2 * side + 1, w] + np.uint64(1), b + times * _K[3], 1)

        def leave(over: np.ndarray, x: np.ndarray, y: np.ndarray) -> None:
            nonlocal who, lo, hi
            gone = np.flatnonzero(over)
            if len(gone):
                anchor[who[gone]] = np.minimum(x[gone], y[gone])
                keep = ~over
                who, lo, hi = who[keep], lo[keep], hi[keep]

        for level in self.levels:
            if not len(who):
                break
            if level.run is not None:
                first, last = level.run[lo], level.run[hi]
                x, y = level.a[lo], level.a[hi]
                if named:
                    stop = np.minimum(level.run_start[first + 1] - 1, hi)
                    pop(slice(None), 0, x, level.b[lo], (stop - lo + 1).astype(np.uint64))
                    two = first != last
                    start = level.run_start[last]
                    pop(two, 1, y[two], level.b[hi[two]], (hi - start + 1)[two].astype(np.uint64))
                lo, hi = first.astype(np.int64) + 1, last.astype(np.int64) - 1
                leave(lo > hi, x, y)
                if not len(who):
                    break
            x, y = level.run_a[lo], level.run_a[hi]
            out_left, out_right = level.right[lo], ~level.right[hi]
            single = lo == hi
            if named:
                pop(out_left, 0, x[out_left], level.run_b[lo[out_left]], np.uint64(1))
                alone = out_right & ~(single & out_left)
                pop(alone, 1, y[alone], level.run_b[hi[alone]], np.uint64(1))
            lo, hi = lo + out_left, hi - out_right
            leave(lo > hi, x, y)
            lo, hi = level.above[lo].astype(np.int64), level.above[hi].astype(np.int64)
        while len(who):  # few: an interior that lasts to the top level
            x, y = self.a[lo], self.a[hi]
            if named:
                pop(np.ones(len(who), bool), 0, x, self.b[lo], np.uint64(1))
            lo = lo + 1
            leave(lo > hi, x, y)
        if not named:
            return (anchor,)
        return anchor, _join(spelled[0], spelled[2], 0), _join(spelled[1], spelled[3], 1)


def _rows(docs: DataFrame) -> DataFrame:
    """``doc`` (the id, null as the least), ``key`` (a hash of the text, which
    tells rows of one id apart), ``text``."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63)).cast("long")).alias("doc"),
                       F.xxhash64(text, "doc_id").alias("key"), text.alias("text"))


def _long(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64) if x.dtype == np.uint64 else x.astype(np.int64, copy=False), pa.int64())


def phrases(rows: DataFrame, size: int, levels: int) -> DataFrame:
    """``a, b`` (name), ``doc, key, start, stop`` (words) of every phrase that
    windows start in, with their anchors (``anchors``) and the first window of
    each (``firsts``)."""

    def task(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            ids, keys = (np.asarray(b.column(c)) for c in (0, 1))
            for lo, hi, buf, offs in tv.batches(b.column(2)):
                _, _, doc, wa, wb = word_names(buf, offs)
                count = np.bincount(doc, minlength=hi - lo)
                first = np.cumsum(count) - count
                r = Recompression(wa, wb, doc, levels)
                if not r.n:
                    continue
                stop = np.append(r.start[1:], r.n)
                final = np.minimum(stop - 1, (first + count - size)[r.doc])  # the last window of a phrase
                some = np.flatnonzero(final >= r.start)
                if not len(some):
                    continue
                start, final, d = r.start[some], final[some], r.doc[some]
                _, a, c = r.windows(final, size, True)
                a, c = (_join(_join(x[some], y, k), (final - start).astype(np.uint64), k) for k, (x, y) in enumerate([(r.a, a), (r.b, c)]))
                n = final - start + 1
                phrase = np.repeat(np.arange(len(some)), n)
                at = np.arange(len(phrase)) + np.repeat(start - (np.cumsum(n) - n), n)
                anchor, _, _ = r.windows(at, size, False)
                new = np.ones(len(at), bool)
                new[1:] = (anchor[1:] != anchor[:-1]) | (phrase[1:] != phrase[:-1])
                own = first[d]
                yield pa.RecordBatch.from_arrays(
                    [_long(a), _long(c), _long(ids[lo:hi][d]), _long(keys[lo:hi][d]), _long(start - own), _long(final - own + size),
                     tv.lists(anchor[new].view(np.int64), phrase[new], len(some), pa.int64()),
                     tv.lists((at - own[phrase])[new].astype(np.int32), phrase[new], len(some), pa.int32())],
                    ["a", "b", "doc", "key", "start", "stop", "anchors", "firsts"])

    return rows.mapInArrow(task, "a long, b long, doc long, key long, start long, stop long, anchors array<long>, firsts array<int>")


def window_names(wanted: DataFrame, size: int, levels: int) -> DataFrame:
    """``a, b, doc, key, at`` of the windows that start in the ``ranges`` (of
    words, both ends included) of every row ``doc, key, text, ranges``."""

    def task(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            ids, keys = (np.asarray(batch.column(c)) for c in ("doc", "key"))
            lists = batch.column("ranges")
            edge = np.asarray(lists.offsets)
            struct = lists.flatten()
            lows, highs = (np.asarray(struct.field(k)).astype(np.int64) for k in (0, 1))
            edge = edge - edge[0]
            for lo, hi, buf, offs in tv.batches(batch.column("text")):
                _, _, doc, wa, wb = word_names(buf, offs)
                r = Recompression(wa, wb, doc, levels)
                count = np.bincount(doc, minlength=hi - lo)
                first = np.cumsum(count) - count
                owner = np.repeat(np.arange(hi - lo), np.diff(edge[lo:hi + 1]))
                x, y = (v[edge[lo]:edge[hi]] + first[owner] for v in (lows, highs))
                n = y - x + 1
                at = np.arange(int(n.sum())) + np.repeat(x - (np.cumsum(n) - n), n)
                row = np.repeat(owner, n)
                for k in range(0, len(at), 8 * BLOCK):  # rows of a batch stay bounded whatever the text
                    part, d = at[k:k + 8 * BLOCK], row[k:k + 8 * BLOCK]
                    _, a, b = r.windows(part, size, True)
                    yield pa.RecordBatch.from_arrays([_long(a), _long(b), _long(ids[lo:hi][d]), _long(keys[lo:hi][d]), _long(part - first[d])],
                                                     ["a", "b", "doc", "key", "at"])

    return wanted.select("doc", "key", "text", "ranges").mapInArrow(task, "a long, b long, doc long, key long, at long")


def _first_owners(named: DataFrame, label: str) -> DataFrame:
    """``a, b, first``: names that two documents have, with the smallest."""
    return stage(named.groupBy("a", "b").agg(F.min("doc").alias("first"), F.max("doc").alias("last"))
                 .where("first < last").select("a", "b", "first"), label)


def marks(docs: DataFrame, size: int = SIZE, levels: int = LEVELS) -> DataFrame:
    """``doc, key, spans``: the word ranges to remove of every row that has some."""
    rows = _rows(docs)
    # round 1: whole phrases
    cut = stage(phrases(rows, size, levels), "phrases")
    owners = _first_owners(cut, "phrase-owners")
    clear, rest = graph.split_by(cut, owners, "a")
    met = rest.join(owners, ["a", "b"], "left")
    whole = stage(met.where("doc > first").select("doc", "key", "start", "stop"), "whole")
    left = clear.unionByName(met.where("first is null or doc <= first").drop("first"))
    # round 2: anchors of what is left
    runs = (left.select("doc", "key", F.posexplode("anchors").alias("k", "anchor"), "firsts", "stop")
            .select("doc", "key", "anchor", F.col("firsts")[F.col("k")].alias("lo"),
                    F.coalesce(F.expr("get(firsts, k + 1)") - 1, F.col("stop") - size).cast("int").alias("hi")))
    shared = stage(runs.groupBy("anchor").agg(F.min("doc").alias("first"), F.max("doc").alias("last"))
                   .where("first < last").select("anchor"), "shared")
    _, maybe = graph.split_by(runs, shared, "anchor")
    ranges = stage(maybe.join(shared, "anchor", "left_semi").groupBy("doc", "key").agg(F.collect_set(F.struct("lo", "hi")).alias("ranges")), "ranges")
    # round 3: windows
    _, texts = graph.split_by(rows, ranges, "key")
    named = stage(window_names(texts.join(ranges, ["doc", "key"]), size, levels), "windows")
    firsts = _first_owners(named, "window-owners")
    _, maybe = graph.split_by(named, firsts, "a")
    around = maybe.join(firsts, ["a", "b"]).where("doc > first").select("doc", "key", F.col("at").alias("start"), (F.col("at") + size).alias("stop"))
    return stage(whole.union(around).groupBy("doc", "key").agg(F.collect_set(F.struct("start", "stop")).alias("spans")), "marks")


def remove_repeats(docs: DataFrame, size: int = SIZE, levels: int = LEVELS) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_words, n_removed, kept`` (the
    remaining words joined by one space), ``spans`` (the maximal removed runs
    of words)."""
    marked = marks(docs, size, levels)
    free = "_" * (1 + max((len(c) for c in docs.columns), default=0))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    keyed = docs.select("doc_id", text.alias("text"), F.xxhash64(text, "doc_id").alias(free))
    clear, rest = graph.split_by(keyed, marked, "key", free)
    own = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63)).cast("long"))
    met = (rest.withColumn(free + "_", own).join(marked.withColumnsRenamed({"key": free, "doc": free + "_"}), [free, free + "_"], "left")
           .select("doc_id", "text", "spans"))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def task(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
        for b in it:
            lists = b.column("spans")
            for lo, hi, buf, offs in tv.batches(b.column("text")):
                start, stop, doc, _, _ = word_names(buf, offs)
                edge = np.searchsorted(doc, np.arange(hi - lo + 1))
                kept, runs, words, gone = [], [], [], []
                for k in range(hi - lo):
                    s, e = start[edge[k]:edge[k + 1]], stop[edge[k]:edge[k + 1]]
                    change = np.zeros(len(s) + 1, np.int64)
                    for x in lists[lo + k].as_py() or ():
                        change[x["start"]] += 1
                        change[x["stop"]] -= 1
                    out = np.cumsum(change[:-1]) > 0
                    turn = np.flatnonzero(np.diff(np.concatenate([[False], out, [False]]).astype(np.int8)))
                    runs.append([{"start": int(x), "stop": int(y)} for x, y in zip(turn[::2], turn[1::2], strict=True)])
                    kept.append(b" ".join([buf[x:y].tobytes() for x, y in zip(s[~out], e[~out], strict=True)]).decode())
                    words.append(len(s))
                    gone.append(int(out.sum()))
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").slice(lo, hi - lo), pa.array(words, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.string()),
                     pa.array(runs, span)], ["doc_id", "n_words", "n_removed", "kept", "spans"])

    changed = met.mapInArrow(task, f"doc_id {kind}, n_words long, n_removed long, kept string, spans array<struct<start:long,stop:long>>")
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    return (clear.select("doc_id", words.alias("words"))
            .select("doc_id", F.size("words").cast("long").alias("n_words"), F.lit(0).cast("long").alias("n_removed"),
                    F.array_join("words", " ").alias("kept"), F.array().cast("array<struct<start:long,stop:long>>").alias("spans")).union(changed))
