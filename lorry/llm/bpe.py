"""Operator 6, byte-level BPE encoding and decoding with a rank queue.

A pre-token is merged with a *hierarchical-bitmap rank queue*: one bucket per
merge rank holds the linked-list positions whose pair has that rank, a
two-level bitmap marks the buckets in use, find-first-set on each level gives
the lowest rank, and entries whose pair has changed since are skipped.  Every merge touches two neighbours, so a pre-token of n bytes
takes O(n log n) whatever its length.

Whole texts are encoded in tasks, batch by batch, without a shuffle.  Results
of short pieces are kept in a bounded cache per worker process.

Defined cases: a null or empty text has no tokens; special tokens do not
exist, their strings are ordinary text; repeated rows give repeated rows;
further columns are dropped except those asked for with ``keep``.
"""

from __future__ import annotations

import base64
import struct
import sys
import types
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lorry.llm import textvec as tv

# Fixed value: the split pattern that never carries a match over a single space into the next word.
SPACE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: strings kept per worker: two generations of this many, of at most this length
CACHE_ENTRIES = 600_000
CACHE_PIECE = 64
#: rows of a Python batch are cut so that no batch of ids gets large
BATCH_BYTES = 8 << 20


def load_ranks(path: str) -> dict[bytes, int]:
    """The ranks of a vocabulary file: base64 token and rank on each line."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class RankQueue:
    """Buckets of positions by rank under a two-level bitmap: ``words`` has a
    bit per rank in use (``2**BITS`` ranks a word), ``top`` a bit per word in
    use.  :func:`merge_piece` works on the parts directly, it leaves the queue
    empty."""

    BITS = 8

    def __init__(self, n_ranks: int):
        self.words = [0] * ((n_ranks >> self.BITS) + 1)
        self.buckets: dict[int, list[int]] = {}
        self.bit = [1 << i for i in range(max(1 << self.BITS, len(self.words)))]


def merge_piece(piece: bytes, ranks: dict[bytes, int], queue: RankQueue) -> list[int]:
    """Ids of one pre-token; the pair of lowest rank merges first, the leftmost
    among equals."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    n = len(piece)
    follow = list(range(1, n + 1))  # start of the next part
    before = list(range(-1, n - 1))
    pair = [-1] * n  # rank of the part at a position joined with the next one
    get, words, buckets, bit = ranks.get, queue.words, queue.buckets, queue.bit
    top = 0
    for i in range(n - 1):
        r = get(piece[i:i + 2])
        if r is not None:
            pair[i] = r
            if r in buckets:
                buckets[r].append(i)
            else:
                buckets[r] = [i]
                w = r >> 8
                if not words[w]:
                    top |= bit[w]
                words[w] |= bit[r & 255]
    while top:
        w = (top & -top).bit_length() - 1  # find-first-set on either level
        used = words[w]
        low = used & -used
        rank = (w << 8) + low.bit_length() - 1
        words[w] = used = used ^ low
        if not used:
            top ^= bit[w]
        bucket = buckets.pop(rank)
        if len(bucket) > 1:
            bucket.sort()
        for at, i in enumerate(bucket):
            if pair[i] != rank:  # stale: this part or the next one has changed
                continue
            j = follow[i]
            k = follow[j]
            follow[i] = k
            pair[i] = pair[j] = -1
            again = False
            h = before[i]
            if k < n:
                before[k] = i
                r = get(piece[i:follow[k]])
                if r is not None:
                    pair[i] = r
                    again = r <= rank
                    if r in buckets:
                        buckets[r].append(i)
                    else:
                        buckets[r] = [i]
                        w = r >> 8
                        if not words[w]:
                            top |= bit[w]
                        words[w] |= bit[r & 255]
            if h >= 0:
                r = get(piece[h:k])
                if r is None:
                    pair[h] = -1
                else:
                    pair[h] = r
                    again = again or r <= rank
                    if r in buckets:
                        buckets[r].append(h)
                    else:
                        buckets[r] = [h]
                        w = r >> 8
                        if not words[w]:
                            top |= bit[w]
                        words[w] |= bit[r & 255]
            if again and at + 1 < len(bucket):
                # a pair made just now goes first: the rest of the bucket waits
                if rank in buckets:
                    buckets[rank] += bucket[at + 1:]
                else:
                    buckets[rank] = bucket[at + 1:]
                    w = rank >> 8
                    if not words[w]:
                        top |= bit[w]
                    words[w] |= bit[rank & 255]
                break
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i:follow[i]]])
        i = follow[i]
    return out


class Encoder:
    """Encodes texts with one vocabulary; keeps results of short strings."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, entries: int | None = None):
        import regex

        self.entries = entries or CACHE_ENTRIES
        self.at_spaces = pattern == SPACE_PATTERN
        self.ranks, self.queue = ranks, RankQueue(max(ranks.values()) + 1)
        self.find = regex.compile(pattern).findall
        # a cut before a space is no boundary inside a run of white space
        self.run = regex.compile(r"\s (?:\s|$)|^ (?:\s|$)").search
        self.kept: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def keep(self, s: str, ids: bytes) -> bytes:
        if len(s) <= CACHE_PIECE:
            if len(self.kept) >= self.entries:
                self.older, self.kept = self.kept, {}
            self.kept[s] = ids
        return ids

    def piece(self, s: str) -> bytes:
        """Ids of one match of the pattern."""
        got = self.kept.get(s)
        if got is None:
            got = self.older.get(s)
            if got is None:
                got = struct.pack("<%dI" % len(found := merge_piece(s.encode(), self.ranks, self.queue)), *found)
            self.keep(s, got)
        return got

    def string(self, s: str) -> bytes:
        """Ids of a string that the pattern never matches over."""
        got = self.older.get(s)
        if got is not None:
            return self.keep(s, got)
        pieces = self.find(s)
        if len(pieces) == 1:
            return self.piece(s)
        return self.keep(s, b"".join(map(self.piece, pieces)))

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers.

        ``SPACE_PATTERN`` never carries a match over a single space into the
        next word, so a text is cut before such spaces and each string is
        looked up; a text with longer white space around a space, and any text
        under another pattern, is matched whole.
        """
        if not self.at_spaces or self.run(text):
            return b"".join(map(self.piece, self.find(text)))
        head, *rest = text.split(" ")
        get, out = self.kept.get, []
        if head:
            out.append(get(head) or self.string(head))
        for s in rest:
            s = " " + s
            out.append(get(s) or self.string(s))
        return b"".join(out)


class Decoder:
    """Token bytes by id, as one flat array."""

    def __init__(self, ranks: dict[bytes, int]):
        n = max(ranks.values()) + 1
        token: list[bytes] = [b""] * n
        self.known = np.zeros(n, bool)
        for b, r in ranks.items():
            token[r] = b
            self.known[r] = True
        self.flat = np.frombuffer(b"".join(token), np.uint8)
        self.length = np.array([len(t) for t in token], np.int64)
        self.start = np.cumsum(self.length) - self.length

    def decode(self, ids: bytes) -> bytes:
        a = np.frombuffer(ids, "<u4")
        if not len(a):
            return b""
        if int(a.max()) >= len(self.known) or not self.known[a].all():
            raise ValueError("id without a token")
        n = self.length[a]
        stop = np.cumsum(n)
        at = np.arange(int(stop[-1])) + np.repeat(self.start[a] - stop + n, n)
        return self.flat[at].tobytes()


def worker_object(key: str, make):
    """One object per worker process, kept over its tasks."""
    kept = sys.modules.setdefault("_lorry_llm_worker", types.ModuleType("_lorry_llm_worker")).__dict__
    if key not in kept:
        kept[key] = make()
    return kept[key]


def slices(batch: pa.RecordBatch, column: str, most: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in parts of at most about ``most`` bytes of a column."""
    c = batch.column(column)
    size = np.asarray(pa.compute.fill_null(pa.compute.binary_length(c), 0)).astype(np.int64)
    total = np.cumsum(size)
    lo = 0
    while lo < len(size):
        base = int(total[lo - 1]) if lo else 0
        hi = max(lo + 1, int(np.searchsorted(total, base + most, "right")))
        yield batch.slice(lo, hi - lo)
        lo = hi


def _digest(ranks: dict[bytes, int], pattern: str) -> str:
    import hashlib

    h = hashlib.sha256(pattern.encode())
    for b, r in sorted(ranks.items()):
        h.update(b"%d:%d:" % (r, len(b)) + b)
    return h.hexdigest()


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, keep: tuple[str, ...] = ("doc_id",),
           text: str = "text", decoded: bool = False, entries: int | None = None, lasting: bool = True) -> DataFrame:
    """``keep`` columns, ``ids`` (binary, little-endian unsigned 32-bit) and
    ``n_tokens`` of every row; with ``decoded`` also the bytes that the ids
    decode to.  The vocabulary is broadcast; its size is that of a vocabulary
    file, whatever the corpus holds.  ``entries`` bounds what a worker keeps
    of strings met before (some 300 bytes each), and without ``lasting`` it
    keeps them for a task only."""
    sent = docs.sparkSession.sparkContext.broadcast((ranks, pattern, _digest(ranks, pattern)))
    names = [*keep, "ids", "n_tokens"] + ["decoded"] * decoded

    def task(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = sent.value[2]
        encoder = worker_object(f"encoder:{entries}:{key}", lambda: Encoder(*sent.value[:2], entries)) if lasting else Encoder(*sent.value[:2], entries)
        back = worker_object("decoder:" + key, lambda: Decoder(sent.value[0])).decode if decoded else None
        for whole in it:
            for b in slices(whole, text):
                ids = [encoder.encode(t) if t else b"" for t in b.column(text).to_pylist()]
                out = [b.column(c) for c in keep] + [pa.array(ids, pa.binary()), pa.array([len(x) // 4 for x in ids], pa.int64())]
                if decoded:
                    out.append(pa.array([back(x) for x in ids], pa.binary()))
                yield pa.RecordBatch.from_arrays(out, names)

    kept = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    return docs.select(*dict.fromkeys([*keep, text])).mapInArrow(
        tv.tidy(task), f"{kept}, ids binary, n_tokens bigint" + ", decoded binary" * decoded)


def decode(encoded: DataFrame, ranks: dict[bytes, int], keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns and ``decoded``: the bytes of the ids (not always valid
    UTF-8 if the ids are cut).  Null ids decode to nothing; an id without a
    token fails the job."""
    sent = encoded.sparkSession.sparkContext.broadcast((ranks, _digest(ranks, "")))

    def task(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = None
        for whole in it:
            for b in slices(whole, "ids"):
                if decoder is None:
                    decoder = worker_object("decoder:" + sent.value[1], lambda: Decoder(sent.value[0]))
                out = [decoder.decode(x) if x else b"" for x in b.column("ids").to_pylist()]
                yield pa.RecordBatch.from_arrays([b.column(c) for c in keep] + [pa.array(out, pa.binary())], [*keep, "decoded"])

    kept = ", ".join(f"`{c}` {encoded.schema[c].dataType.simpleString()}" for c in keep)
    return encoded.select(*dict.fromkeys([*keep, "ids"])).mapInArrow(tv.tidy(task), f"{kept}, decoded binary")
