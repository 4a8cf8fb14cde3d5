"""Operator 3, training-order materialisation of token ids.

Documents' token ids, each with an end mark, are packed end to end into
sequences of ``length`` ids.  A keyed Feistel permutation of the sequence
numbers (with cycle-walking: values beyond the number of sequences go through
the network again) gives every sequence a global slot.  Sequences are moved
once, to the range of slots that makes up their shard; a shard is a file of
fixed-stride records in slot order, so the record of a slot lies at a known
byte of a known file and reading can be resumed at any slot.

The place of a document in the stream is its place in the input files (path,
block, row), of which only sums per block are gathered; so the input must be
read from files, and the same files give the same shards.  Shards are written
by Spark's own committer to any file system: a record is the ids as raw bytes
and one line feed that ends it (which checks the stride when reading).

Defined cases: null ids are an empty document (an end mark alone); the last
sequence is filled up with ``pad``; repeated rows are documents of their own;
without rows there are no shards; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lorry.llm import textvec as tv

ROUNDS = 6


class Layout(NamedTuple):
    path: str
    sequences: int
    length: int  # ids a sequence
    width: int  # bytes an id
    per_shard: int  # sequences a shard
    key: int

    @property
    def stride(self) -> int:
        return self.length * self.width + 1


def _half(n: int) -> int:
    return max(1, (max(n - 1, 1).bit_length() + 1) // 2)


def _network(x: np.ndarray, half: int, keys: np.ndarray) -> np.ndarray:
    mask = np.uint64((1 << half) - 1)
    left, right = x >> np.uint64(half), x & mask
    for k in keys:
        left, right = right, left ^ (tv.mix(right ^ k) & mask)
    # the last swap is undone, so that the same network with reversed keys inverts it
    return right << np.uint64(half) | left


def permute(x: np.ndarray, n: int, key: int, inverse: bool = False) -> np.ndarray:
    """The keyed permutation of 0..n-1 (or its inverse), element by element."""
    keys = tv.constants(key, ROUNDS)
    if inverse:
        keys = keys[::-1]
    half = _half(n)
    y = _network(np.asarray(x).astype(np.uint64), half, keys)
    while (out := y >= np.uint64(n)).any():  # cycle-walking
        y[out] = _network(y[out], half, keys)
    return y.astype(np.int64)


def _blocks(docs: DataFrame, ids: Column, width: int) -> tuple[dict[tuple[str, int], int], int]:
    """Where the documents of every file block begin in the stream, and the
    stream's length: one number per block, whatever the number of documents."""
    size = F.coalesce((F.octet_length(ids) / width).cast("long"), F.lit(0).cast("long")) + 1
    rows = (docs.select(F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_block_start").alias("b"), size.alias("n"))
            .groupBy("f", "b").agg(F.sum("n").alias("n")).collect())
    at, start = 0, {}
    for f, b, n in sorted((r["f"], r["b"], r["n"]) for r in rows):
        start[f, b] = at
        at += n
    return start, at


def materialise(docs: DataFrame, ids: Column, path: str, width: int, end: int, pad: int, length: int = 512,
                per_shard: int = 1 << 15, key: int = 20240917) -> Layout:
    """Writes the shards under ``path``.  ``ids`` is a binary column:
    little-endian integers of ``width`` bytes."""
    start, total = _blocks(docs, ids, width)
    n = -(-total // length)
    layout = Layout(path, n, length, width, per_shard, key)
    size = length * width
    end_mark, pad_mark = (x.to_bytes(width, "little") for x in (end, pad))
    sent = docs.sparkSession.sparkContext.broadcast(start)

    def cut(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Pieces ``(slot, at, piece)``: whole sequences but at the ends of a block."""
        block, held, place, out = None, [], 0, []

        def flush(last: bool) -> list[tuple[int, int, bytes]]:
            nonlocal held, place
            data = b"".join(held)
            pieces, at = [], 0
            while at < len(data):
                room = size - (place + at) % size
                if len(data) - at < room and not last:
                    break
                pieces.append(((place + at) // size, (place + at) % size, data[at:at + room]))
                at += room
            at = min(at, len(data))
            held, place = [data[at:]], place + at
            return pieces

        def batch(pieces: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
            slot = permute(np.array([p[0] for p in pieces]), n, key)
            return pa.RecordBatch.from_arrays(
                [pa.array(slot // per_shard, pa.int32()), pa.array(slot), pa.array([p[1] for p in pieces], pa.int32()),
                 pa.array([p[2] for p in pieces], pa.binary())], ["shard", "slot", "at", "piece"])

        waiting = 0
        for b in it:
            for f, s, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                if (f, s) != block:
                    if block is not None:
                        out += flush(True)
                    block, held, place = (f, s), [], sent.value[f, s] * width
                held += [data or b"", end_mark]
                waiting += len(data or b"") + width
                if waiting >= 4 << 20:
                    out += flush(False)
                    waiting = 0
                    if out:
                        yield batch(out)
                        out = []
        if block is not None:
            out += flush(True)
        if out:
            yield batch(out)

    def record(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Puts pieces of one slot together (the rows are in order)."""
        slot, held = None, []

        def done() -> bytes:
            whole = b"".join(held)
            return whole + pad_mark * ((size - len(whole)) // width)

        for b in it:
            out = []
            for s, p in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if s != slot:
                    if slot is not None:
                        out.append(done())
                    slot, held = s, []
                held.append(p)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])
        if slot is not None:
            yield pa.RecordBatch.from_arrays([pa.array([done()], pa.binary())], ["record"])

    pieces = docs.select(F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), ids.alias("ids")).mapInArrow(
        cut, "shard int, slot long, at int, piece binary")
    shards = max(1, -(-n // per_shard))
    (pieces.repartitionById(shards, F.col("shard")).sortWithinPartitions("slot", "at").select("slot", "piece")
     .mapInArrow(record, "record binary").select(F.col("record").cast("string").alias("value"))
     # a shard is one file: a session's limit on records would start a second one
     .write.option("lineSep", "\n").option("compression", "none").option("maxRecordsPerFile", 0).text(path))
    return layout


def read_shards(spark: SparkSession, layout: Layout, first_slot: int = 0) -> DataFrame:
    """``slot, sequence, ids`` (raw bytes) of every record from a slot on;
    ``sequence`` is the number that the record has in the packed stream.  A
    reader skips whole shards before the slot and the records before it in its
    own shard.  A task holds one shard at a time."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(layout.path)
    shard = F.regexp_extract(F.element_at(F.split("path", "/"), -1), r"^part-(\d+)", 1).cast("long")
    kept = files.where(F.col("length") > 0).select(shard.alias("shard"), "content").where(F.col("shard") >= first_slot // layout.per_shard)
    stride, per_shard, n, key = layout.stride, layout.per_shard, layout.sequences, layout.key

    def task(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            for shard, content in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                raw = np.frombuffer(content.as_buffer(), np.uint8)
                if len(raw) % stride:
                    raise ValueError(f"shard {shard} is not a number of whole records")
                rows = raw.reshape(-1, stride)
                if (rows[:, -1] != 10).any():
                    raise ValueError(f"shard {shard} has a record without its end")
                if len(rows) != min(per_shard, n - shard * per_shard):
                    raise ValueError(f"shard {shard} is not whole in one file: {len(rows)} records")
                lo = max(0, first_slot - shard * per_shard)
                for at in range(lo, len(rows), 4096):
                    part = np.ascontiguousarray(rows[at:at + 4096, :-1])
                    slot = np.arange(at, at + len(part)) + shard * per_shard
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(slot), pa.array(permute(slot, n, key, inverse=True)), pa.array([r.tobytes() for r in part], pa.binary())],
                        ["slot", "sequence", "ids"])

    return kept.mapInArrow(task, "slot long, sequence long, ids binary")
