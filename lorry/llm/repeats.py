"""Operator 8, removal of repeated byte strings with a run-length index.

A byte goes if a string of ``DEPTH`` bytes that covers it also starts in a
document with a smaller id; strings are judged on the input.  Jobs:

1. texts are cut into segments at places that depend on content alone.  A
   segment (with ``DEPTH`` - 1 bytes beyond it) that a smaller document also
   has is repeated as a whole; such segments are marked and take no further
   part, as any string in them first occurs in a segment that is not;
2. every string of ``DEPTH`` bytes holds an anchor: the ``GRAM`` bytes in it
   whose first ``LEAD`` have the lowest hash.  Anchors that occur in two
   documents are kept, with their contexts (all strings around them); equal
   contexts count once;
3. the contexts of an anchor with several of them go to one block, or are
   dealt to several if there are more than ``MOST``.  A block builds the
   run-compressed Burrows-Wheeler transform of its contexts, streams them
   through it, and so learns for every string of every context the smallest
   document that has it.  For an anchor that was dealt out, the blocks'
   answers are combined by a hash of the string;
4. marks meet their documents; documents without marks do not move.

What tasks need to know of other documents reaches them as filters of bounded
size whose errors only add rows; all decisions are made in joins.

Defined cases: a null text is empty; texts under ``DEPTH`` bytes keep all;
null ids count as smaller than any other; rows that repeat an id are not
smaller than each other; an empty table gives an empty result.
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
from lorry.llm.runindex import RunIndex
from lorry.session import stage

DEPTH, GRAM = 50, 28
WINDOW = DEPTH - GRAM + 1  # grams in a string
SIDE = DEPTH - GRAM  # bytes of context on either side of an anchor
#: one anchor in so many cuts a segment, if the last candidate is at least GAP bytes away
CUT, GAP = 32, 64
#: grams that a task packs at a time, grams in a bucket (some), bytes of a gram that are kept beside its bucket
PACKED, BUCKET, LOW_BYTES = 1 << 20, 1 << 18, 5
#: contexts of one anchor in one block, and contexts that make up a block
MOST, BLOCK = 4000, 6000


#: bytes that decide the order of grams
LEAD = 16
#: text that is worked through at a time (some twenty bytes of arrays a byte of it, to stay in a processor's cache)
CHUNK = 1 << 17

_VALUES = tv.constants(31, 256)
_powers = [tv.powers(CHUNK), tv.powers(CHUNK, pow(tv.PRIME, -1, 1 << 64))]


def _slide(x: np.ndarray, w: int, f) -> np.ndarray:
    """``f`` over every ``w`` neighbours (at the place of the first), by doubling."""
    s = 1
    while 2 * s <= w:
        x = f(x[:-s], x[s:])
        s *= 2
    return f(x[:s - w], x[w - s:]) if w > s else x


def _order(buf: np.ndarray) -> np.ndarray:
    """What the ``LEAD`` bytes from every place on decide: 32 bits."""
    x, s, odd = (_VALUES >> np.uint64(32)).astype(np.uint32)[buf], 1, 0x9E3779B1
    while s < LEAD:
        y = x[:-s] * np.uint32(odd)
        y += x[s:]
        x, s, odd = y, 2 * s, odd * odd & 0xFFFFFFFF
    x ^= x >> np.uint32(15)
    x *= np.uint32(0x2C1B3C6D)
    x ^= x >> np.uint32(13)
    return x


def _before(offs: np.ndarray, count: int, size: int) -> np.ndarray:
    """The last ``count`` places of every text that are below ``size``."""
    at = offs[1:, None] - np.arange(1, count + 1)
    return at[(at >= offs[:-1, None]) & (at < size)]


class Scan:
    """Hashes, anchors and segments of a chunk of texts."""

    def __init__(self, buf: np.ndarray, offs: np.ndarray):
        n, self.offs = len(buf), offs
        p, self.back = _powers if n < CHUNK else (tv.powers(n + 1), tv.powers(n + 1, pow(tv.PRIME, -1, 1 << 64)))
        self.sums = np.zeros(n + 1, np.uint64)
        value = _VALUES[buf]
        value *= p[:n]
        np.cumsum(value, out=self.sums[1:])
        self.anchor = np.zeros(0, np.int64)
        if n >= DEPTH:
            g = _order(buf)[:n - GRAM + 1]
            g[_before(offs, GRAM - 1, len(g))] = 2**32 - 1  # no whole gram
            low = np.zeros(len(g) + WINDOW - 1, np.uint32)
            low[WINDOW - 1:len(g)] = _slide(g, WINDOW, np.minimum)
            low[_before(offs, DEPTH - 1, n - DEPTH + 1) + WINDOW - 1] = 0  # no whole string
            self.anchor = np.flatnonzero(g == _slide(low, WINDOW, np.maximum))
        edge = np.searchsorted(self.anchor, offs)
        self.doc = np.repeat(np.arange(len(offs) - 1), np.diff(edge))
        whole = self.anchor + GRAM <= offs[self.doc + 1]
        self.anchor, self.doc = self.anchor[whole], self.doc[whole]
        self.gram = self.hash(self.anchor, self.anchor + GRAM)
        # segments: from a cut to the next one and DEPTH - 1 bytes on
        cuts = self.anchor[self.gram % np.uint64(CUT) == 0]
        cuts = cuts[np.diff(np.concatenate([[-GAP], cuts])) >= GAP]
        start = np.unique(np.concatenate([offs[:-1][np.diff(offs) >= DEPTH], cuts]))
        doc = np.searchsorted(offs, start, "right") - 1
        follow = np.append(start[1:], n)
        stop = np.minimum(np.minimum(follow, offs[doc + 1]) + DEPTH - 1, offs[doc + 1])
        long = stop - start >= DEPTH
        self.seg_start, self.seg_stop, self.seg_doc = start[long], stop[long], doc[long]
        self.seg_hash = self.hash(self.seg_start, self.seg_stop)

    def hash(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return tv.mix((self.sums[stop] - self.sums[start]) * self.back[start] + (stop - start).astype(np.uint64))

    def seg_key(self, key: np.ndarray) -> np.ndarray:
        """A hash of a segment's place: its row and offset."""
        return segment_key(key[self.seg_doc], self.seg_start - self.offs[self.seg_doc])

    def within(self, keep: np.ndarray) -> np.ndarray:
        """Which anchors lie in a segment (or what is beyond it) that is kept."""
        start, stop = self.seg_start[keep], self.seg_stop[keep]
        change = np.bincount(np.searchsorted(self.anchor, start), minlength=len(self.anchor) + 1)
        change -= np.bincount(np.searchsorted(self.anchor, np.maximum(stop - GRAM + 1, start)), minlength=len(change))
        return np.cumsum(change[:-1]) > 0

    def contexts(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and stop of the strings around anchors."""
        at, doc = self.anchor[which], self.doc[which]
        return np.maximum(at - SIDE, self.offs[doc]), np.minimum(at + GRAM + SIDE, self.offs[doc + 1])


def segment_key(key: np.ndarray, start: np.ndarray) -> np.ndarray:
    return tv.mix(key.view(np.uint64) + start.astype(np.uint64) * np.uint64(tv.PRIME)).view(np.int64)


def _turned(gram: np.ndarray) -> np.ndarray:
    """Grams with their halves exchanged: a filter of these errs on other grams than one of the grams."""
    x = gram.view(np.uint64)
    return (x << np.uint64(32) | x >> np.uint64(32)).view(np.int64)


def _long(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64) if x.dtype == np.uint64 else x.astype(np.int64, copy=False), pa.int64())


def _scans(it: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, Scan, np.ndarray]]:
    for b in it:
        doc, key = (np.asarray(b.column(c)) for c in (0, 1))
        for lo, hi, buf, offs in tv.batches(b.column(2), CHUNK - 1):
            yield doc[lo:hi], key[lo:hi], Scan(buf, offs), buf


def _rows(docs: DataFrame) -> DataFrame:
    """``doc`` (the id, null as the least), ``key`` (a hash of id and text), ``text``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63)).cast("long")).alias("doc"),
                       F.xxhash64("doc_id", text).alias("key"), text.alias("text"))


def _segments(rows: DataFrame) -> DataFrame:
    def task(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for doc, key, s, _ in _scans(it):
            at = s.offs[s.seg_doc]
            yield pa.RecordBatch.from_arrays(
                [_long(s.seg_hash), _long(doc[s.seg_doc]), _long(key[s.seg_doc]), _long(s.seg_start - at), _long(s.seg_stop - at)],
                ["segment", "doc", "key", "start", "stop"])

    return rows.mapInArrow(task, "segment long, doc long, key long, start long, stop long")


def _repeated(rows: DataFrame, known, own, buckets: int) -> DataFrame:
    """``gram`` (:func:`_short`) of anchors outside repeated segments that two
    documents have, give or take some that differ in the bits left out.
    Tasks deal their grams to ``buckets`` by their first bits, many to a row."""

    def pack(held: list[np.ndarray]) -> pa.RecordBatch:
        """A row for each bucket; a gram stands twice if two documents have it."""
        h = np.sort(np.concatenate(held))
        edge = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
        h = np.repeat(h[edge], np.minimum(np.diff(np.append(edge, len(h))), 2))
        bucket = (h >> np.uint64(64 - buckets.bit_length() + 1)).astype(np.int64) if buckets > 1 else np.zeros(len(h), np.int64)
        edge = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
        offsets = np.append(edge, len(h)).astype(np.int32) * LOW_BYTES
        low = np.ascontiguousarray(h.view(np.uint8).reshape(-1, 8)[:, :LOW_BYTES])
        grams = pa.Array.from_buffers(pa.binary(), len(edge), [None, pa.py_buffer(offsets), pa.py_buffer(low)])
        return pa.RecordBatch.from_arrays([_long(bucket[edge]), grams], ["bucket", "grams"])

    def deal(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0
        for _, key, s, _ in _scans(it):
            keep = _open(s, key, known.value, own.value)
            # a gram counts once for a document
            h, d = s.gram[keep], s.doc[keep]
            order = np.argsort(h, kind="stable")
            h, d = h[order], d[order]
            once = np.ones(len(h), bool)
            once[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
            held.append(h[once])
            count += len(held[-1])
            if count >= PACKED:
                yield pack(held)
                held, count = [], 0
        if count:
            yield pack(held)

    def twice(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(bucket: int, held: list[bytes]) -> pa.RecordBatch:
            raw = np.frombuffer(b"".join(held), np.uint8).reshape(-1, LOW_BYTES)
            h = np.zeros((len(raw), 8), np.uint8)
            h[:, :LOW_BYTES] = raw
            h = np.sort(h.view(np.uint64).ravel())
            h = np.unique(h[1:][h[1:] == h[:-1]])
            if buckets > 1:
                h |= np.uint64(bucket << 64 - buckets.bit_length() + 1)
            return pa.RecordBatch.from_arrays([_long(h)], ["gram"])

        held, now = [], None
        for b in it:
            for bucket, grams in zip(b.column("bucket").to_pylist(), b.column("grams").to_pylist(), strict=True):
                if held and bucket != now:
                    yield found(now, held)
                    held = []
                now = bucket
                held.append(grams)
        if held:
            yield found(now, held)

    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (rows.mapInArrow(deal, "bucket long, grams binary").repartition(n, "bucket").sortWithinPartitions("bucket")
            .mapInArrow(twice, "gram long"))


def _short(gram: np.ndarray, buckets: int) -> np.ndarray:
    """Grams without the bits that :func:`_repeated` leaves out: those between the bucket's and the low bytes."""
    high = (buckets - 1) << 64 - buckets.bit_length() + 1 if buckets > 1 else 0
    return (gram.view(np.uint64) & np.uint64(high | (1 << 8 * LOW_BYTES) - 1)).view(np.int64)


def _open(s: Scan, key: np.ndarray, known: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Which anchors lie in segments that are not repeated from a smaller
    document: those that ``known`` rules out, and those that it names wrongly."""
    place = s.seg_key(key)
    return s.within(~in_filter(known, place) | in_filter(own, place))


def _contexts(rows: DataFrame, known, own, grams, like, chosen=None) -> DataFrame:
    """``gram, context`` (its hash) of anchors that are, as ``like`` makes them,
    in the filter ``grams``, ``doc``, and where they are; with ``chosen``, a
    filter of contexts and documents, the bytes of those instead of the places."""

    def task(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for doc, key, s, buf in _scans(it):
            which = np.flatnonzero(in_filter(grams.value, like(s.gram)))
            which = which[_open(s, key, known.value, own.value)[which]]
            start, stop = s.contexts(which)
            c = s.hash(start, stop)
            if chosen is None:
                take = stop - start >= DEPTH
            else:
                take = (stop - start >= DEPTH) & in_filter(chosen.value, segment_key(c.view(np.int64), doc[s.doc[which]]))
            which, start, stop, c = which[take], start[take], stop[take], c[take]
            own_doc = s.doc[which]
            if chosen is None:
                at = s.offs[own_doc]
                yield pa.RecordBatch.from_arrays(
                    [_long(s.gram[which]), _long(c), _long(doc[own_doc]), _long(key[own_doc]), _long(start - at), _long(stop - at)],
                    ["gram", "context", "doc", "key", "start", "stop"])
            else:
                _, first = np.unique(tv.mix(s.gram[which]) ^ c + own_doc.astype(np.uint64), return_index=True)
                raw = [buf[a:b].tobytes() for a, b in zip(start[first].tolist(), stop[first].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([_long(s.gram[which][first]), _long(c[first]), _long(doc[own_doc[first]]), pa.array(raw, pa.binary())],
                                                 ["gram", "context", "doc", "bytes"])

    return rows.mapInArrow(task, "gram long, context long, doc long, key long, start long, stop long" if chosen is None
                           else "gram long, context long, doc long, bytes binary")


def _index(contexts: DataFrame) -> DataFrame:
    """``gram, context, least, digest``: for every string of every context the
    smallest document that has it in the block, and for anchors that are dealt
    to several blocks a hash of the string."""
    n = int(contexts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = F.coalesce(F.ceil(F.col("n") / MOST).cast("long"), F.lit(1).cast("long"))
    ready = (contexts.withColumn("part", F.pmod("context", dealt)).withColumn("several", dealt > 1)
             .repartition(n, "gram", "part")
             .groupBy("gram", "part", "context").agg(F.min("doc").alias("first"), F.first("several").alias("several"), F.first("bytes").alias("bytes"))
             .sortWithinPartitions("gram", "part"))

    def answer(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(held).combine_chunks()
        size = np.asarray(pa.compute.binary_length(t["bytes"])).astype(np.int64)
        stops = np.cumsum(size)
        text = np.frombuffer(b"".join(t["bytes"].to_pylist()), np.uint8)
        index = RunIndex(text, stops, DEPTH)
        index.set_values(np.asarray(t["first"]).astype(np.int64))
        least = index.stream(size, DEPTH)
        n = size - DEPTH + 1
        row = np.repeat(np.arange(len(size)), n)
        offset = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        several = np.asarray(t["several"])
        mine = several[row]
        digest, where = np.zeros(0, np.uint64), row[mine]
        if len(where):
            p = tv.powers(DEPTH)
            value = tv.constants(33, 256)[text]
            at = (stops - size)[where] + offset[mine]
            digest = np.zeros(len(at), np.uint64)
            for j in range(DEPTH):
                digest += value[at + j] * p[j]
        yield pa.RecordBatch.from_arrays(
            [t["gram"].combine_chunks(), t["context"].combine_chunks(), tv.lists(least[row, offset], row, len(size), pa.int64()),
             tv.lists(tv.mix(digest).view(np.int64), where, len(size), pa.int64())], ["gram", "context", "least", "digest"])

    def task(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0
        for b in it:
            g, p = np.asarray(b.column("gram")), np.asarray(b.column("part"))
            # a block ends where an anchor's part ends
            if held and (held[-1].column("gram")[-1].as_py(), held[-1].column("part")[-1].as_py()) != (g[0], p[0]) and count >= BLOCK:
                yield from answer(held)
                held, count = [], 0
            edge = np.flatnonzero((g[1:] != g[:-1]) | (p[1:] != p[:-1])) + 1
            lo = 0
            for e in edge:
                if count + e - lo >= BLOCK:
                    yield from answer([*held, b.slice(lo, e - lo)])
                    held, count, lo = [], 0, e
            held.append(b.slice(lo))
            count += b.num_rows - lo
        if count:
            yield from answer(held)

    return ready.mapInArrow(task, "gram long, context long, least array<long>, digest array<long>")


def _intervals(answered: DataFrame) -> DataFrame:
    """``key, start, stop`` of the bytes to remove around anchors: of those
    with ``least`` string by string, of the others (whose context is the only
    one of its anchor) all if ``lo`` is smaller than ``doc``."""

    def task(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            doc, key, start, stop = (np.asarray(b.column(c)) for c in ("doc", "key", "start", "stop"))
            lo = np.asarray(b.column("lo").fill_null(np.iinfo(np.int64).max))
            whole = np.flatnonzero(lo < doc)
            lists = b.column("least")
            n = np.asarray(pa.compute.list_value_length(lists).fill_null(0))
            row = np.repeat(np.arange(len(n)), n)
            offset = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
            hit = np.asarray(lists.flatten()) < doc[row]
            row, at = row[hit], start[row[hit]] + offset[hit]
            first = np.ones(len(row), bool)
            first[1:] = (row[1:] != row[:-1]) | (at[1:] - at[:-1] > DEPTH)
            lo = np.flatnonzero(first)
            hi = np.append(lo[1:], len(row)) - 1 if len(row) else lo
            yield pa.RecordBatch.from_arrays(
                [_long(np.concatenate(x)) for x in ((key[whole], key[row[lo]]), (start[whole], at[lo]), (stop[whole], at[hi] + DEPTH))], ["key", "start", "stop"])

    return answered.select("doc", "key", "start", "stop", "lo", "least").mapInArrow(task, "key long, start long, stop long")


def marks(docs: DataFrame) -> DataFrame:
    """``key, spans``: the byte ranges to remove of every row that has some
    (``key``: a hash of its id and text)."""
    rows, sc = _rows(docs), docs.sparkSession.sparkContext
    segments = stage(_segments(rows), "segments")
    coarse = stage(segments.groupBy("segment").agg(F.min("doc").alias("first"), F.max("doc").alias("last"))
                   .where("first < last").select("segment", "first"), "coarse")
    met = stage(segments.join(coarse, "segment"), "met")
    whole = met.where("doc > first").select("key", "start", "stop")

    def places(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            at = segment_key(np.asarray(b.column("key")), np.asarray(b.column("start")))
            yield pa.RecordBatch.from_arrays([b.column("segment"), b.column("doc"), _long(at)], ["segment", "doc", "place"])

    def named(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in places(it):
            yield b.filter(pa.array(in_filter(known.value, np.asarray(b.column("place")))))

    kind = "segment long, doc long, place long"
    known = sc.broadcast(graph.id_filter(met.where("doc > first").mapInArrow(places, kind), "place"))
    wrongly = segments.mapInArrow(named, kind).join(coarse, "segment", "left").where("first is null or doc <= first")
    own = sc.broadcast(graph.id_filter(wrongly, "place"))
    # about CUT anchors a segment
    buckets = 1 << (segments.count() * CUT // BUCKET).bit_length()
    repeated = stage(_repeated(rows, known, own, buckets), "repeated")
    seen = stage(_contexts(rows, known, own, sc.broadcast(graph.id_filter(repeated, "gram")), lambda gram: _short(gram, buckets)), "seen")
    contexts = stage(seen.groupBy("gram", "context").agg(F.min("doc").alias("first"), F.max("doc").alias("last")), "contexts")
    grams = stage(contexts.groupBy("gram").agg(F.count("*").alias("n"), F.min("first").alias("lo"), F.max("last").alias("hi"), F.min("context").alias("context"))
                  .where("lo < hi"), "grams")
    many = stage(grams.where("n > 1").select("gram", "n"), "many")
    of_many = sc.broadcast(graph.id_filter(many.select(F.shiftleft("gram", 32).bitwiseOR(F.shiftrightunsigned("gram", 32)).alias("turned")), "turned"))

    def first_owners(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            gram, context, first = (np.asarray(b.column(c)) for c in range(3))
            own = in_filter(of_many.value, _turned(gram))
            yield pa.RecordBatch.from_arrays([_long(segment_key(context[own], first[own]))], ["place"])

    # each context's bytes are read from the smallest document that has it
    chosen = stage(contexts.select("gram", "context", "first").mapInArrow(first_owners, "place long"), "chosen")
    raw = _contexts(rows, known, own, of_many, _turned, sc.broadcast(graph.id_filter(chosen, "place")))
    listed = raw.join(stage(many.where(F.col("n") > MOST), "dealt"), "gram", "left")
    index = stage(_index(listed), "index")
    single = index.where(F.size("digest") == 0).select("gram", "context", "least")
    parts = index.where(F.size("digest") > 0).select("gram", "context", F.posexplode(F.arrays_zip("least", "digest")).alias("at", "x")).select(
        "gram", "context", "at", F.col("x.least").alias("least"), F.col("x.digest").alias("digest"))
    best = stage(parts.groupBy("gram", "digest").agg(F.min("least").alias("best")), "best")
    together = (parts.drop("least").join(best, ["gram", "digest"]).groupBy("gram", "context")
                .agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "best"))), lambda s: s.best).alias("least")))
    alone = grams.where("n = 1").select("gram", "context", "lo", F.lit(None).cast("array<bigint>").alias("least"))
    answers = stage(single.union(together).select("gram", "context", F.lit(None).cast("long").alias("lo"), "least").union(alone), "answers")
    around = _intervals(seen.join(answers, ["gram", "context"]))
    return stage(whole.union(around).groupBy("key").agg(F.collect_list(F.struct("start", "stop")).alias("spans")), "marks")


def remove_repeats(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_bytes, n_removed, n_spans,
    kept`` (the remaining bytes), ``spans`` (the maximal removed runs)."""
    free = "_" * (1 + max((len(c) for c in docs.columns), default=0))
    text = F.coalesce(F.col("text"), F.lit(""))
    keyed = docs.select("doc_id", text.alias("text"), F.xxhash64("doc_id", text).alias(free))
    marked = marks(docs)
    clear, rest = graph.split_by(keyed, marked, "key", free)
    met = rest.join(marked.withColumnRenamed("key", free), free, "left").select("doc_id", "text", "spans")
    kind = docs.schema["doc_id"].dataType.simpleString()

    def task(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            spans = b.column("spans")
            count = np.asarray(pa.compute.list_value_length(spans).fill_null(0)).astype(np.int64)
            edge = np.concatenate([[0], np.cumsum(count)])
            flat = spans.flatten()
            starts, stops = (np.asarray(flat.field(k)) for k in (0, 1))
            for lo, hi, buf, offs in tv.batches(b.column("text"), CHUNK):
                row = np.repeat(np.arange(hi - lo), count[lo:hi])
                s, e = (x[edge[lo]:edge[hi]] + offs[row] for x in (starts, stops))
                order = np.lexsort((s, row))
                row, s, e = row[order], s[order], np.maximum.accumulate(e[order])
                new = np.ones(len(row), bool)
                new[1:] = (s[1:] > e[:-1]) | (row[1:] != row[:-1])
                first = np.flatnonzero(new)
                row, s, e = row[first], s[first], e[np.append(first[1:], len(e)) - 1] if len(first) else e
                change = np.zeros(len(buf) + 1, np.int8)
                np.add.at(change, s, 1)
                np.add.at(change, e, -1)
                kept = np.ascontiguousarray(buf[np.cumsum(change[:-1], dtype=np.int8) == 0])
                size = np.diff(offs)
                gone = np.bincount(row, e - s, hi - lo).astype(np.int64)
                ends = np.concatenate([[0], np.cumsum(size - gone)]).astype(np.int32)
                runs = np.bincount(row, minlength=hi - lo)
                own = pa.StructArray.from_arrays([_long(s - offs[row]), _long(e - offs[row])], ["start", "stop"])
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").slice(lo, hi - lo), _long(size), _long(gone), _long(runs),
                     pa.Array.from_buffers(pa.binary(), hi - lo, [None, pa.py_buffer(ends), pa.py_buffer(kept)]),
                     pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(runs)]), pa.int32()), own)],
                    ["doc_id", "n_bytes", "n_removed", "n_spans", "kept", "spans"])

    changed = met.mapInArrow(task, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept binary, spans array<struct<start:long,stop:long>>")
    zero = F.lit(0).cast("long")
    return clear.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), zero.alias("n_removed"), zero.alias("n_spans"),
                        F.col("text").cast("binary").alias("kept"),
                        F.array().cast("array<struct<start:long,stop:long>>").alias("spans")).union(changed)
