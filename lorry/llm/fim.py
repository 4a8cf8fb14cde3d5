"""Operator 13, fill-in-middle over seekable compressed frames.

A text is stored as independent zstandard frames of about ``frame_bytes``
bytes, each with the number of line ends, code points and bytes before it.
Units are lines (``[^\\n]*\\n|[^\\n]+``); a cut after ``u`` units lies behind the
``u``-th line end, so the counts name the one frame that holds it and only
that frame is decompressed.  The transformed text is again a list of frames:
those that no cut meets are moved as they are, the two cut ones are split, and
the markers are frames of their own.  Concatenated they are one valid
zstandard stream; digests and the way back read the frames in order, one at a
time, so a task holds a text compressed and one frame of it in clear.

Defined cases: a null text is empty; an empty text and a text that contains a
marker stay plain; a null id is drawn from as an empty string; equal rows are
transformed alike, one by one; a line longer than a frame spans several; an
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lorry.llm import textvec as tv

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
#: what the frames of a text are stored as: counts before the frame, and the frame
FRAMES = "array<struct<units:long,chars:long,bytes:long,data:binary>>"
_FRAME = pa.struct([("units", pa.int64()), ("chars", pa.int64()), ("bytes", pa.int64()), ("data", pa.binary())])


def _chars(raw: np.ndarray) -> int:
    """Code points of UTF-8 bytes."""
    return int(np.count_nonzero((raw & 0xC0) != 0x80))


def frames_of(raw: np.ndarray, pack: zstandard.ZstdCompressor, frame_bytes: int) -> tuple[list[dict], int, int]:
    """The frames of a text, its line ends and its code points."""
    out, at, units, chars = [], 0, 0, 0
    while at < len(raw):
        stop = min(len(raw), at + frame_bytes)
        while stop < len(raw) and raw[stop] & 0xC0 == 0x80 and stop > at + 1:  # code points stay whole
            stop -= 1
        piece = raw[at:stop]
        out.append({"units": units, "chars": chars, "bytes": at, "data": pack.compress(piece)})
        units += int(np.count_nonzero(piece == 10))
        chars += _chars(piece)
        at = stop
    return out, units, chars


def store(docs: DataFrame, frame_bytes: int = 1 << 15, level: int = 3) -> DataFrame:
    """``doc_id, n, chars, size, marked, frames`` of every row: units, code
    points, bytes, whether the text contains a marker, and its frames."""
    if frame_bytes < 4:
        raise ValueError("a frame holds one code point at least")

    def task(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=level, write_content_size=True)
        for b in it:
            for lo, hi, buf, offs in tv.batches(b.column(1)):
                rows = []
                for k in range(hi - lo):
                    raw = buf[offs[k]:offs[k + 1]]
                    text = raw.tobytes()
                    frames, units, chars = frames_of(raw, pack, frame_bytes)
                    n = units + (len(raw) > 0 and raw[-1] != 10)
                    rows.append((n, chars, len(raw), PREFIX in text or SUFFIX in text or MIDDLE in text, frames))
                n, chars, size, marked, frames = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, hi - lo), pa.array(n, pa.int64()), pa.array(chars, pa.int64()), pa.array(size, pa.int64()),
                     pa.array(marked, pa.bool_()), pa.array(frames, pa.list_(_FRAME))], ["doc_id", "n", "chars", "size", "marked", "frames"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
        task, f"doc_id {kind}, n long, chars long, size long, marked boolean, frames {FRAMES}")


def choose(stored: DataFrame, salt: str = "7", percent: int = 100, spm: int = 50) -> DataFrame:
    """Adds ``form``, ``first`` and ``second`` (units before the two cuts),
    drawn from the sha256 of the salt and the id: ``percent`` of the texts
    are transformed, ``spm`` of a hundred of those suffix first."""
    digest = F.sha2(F.concat(F.lit(f"{salt}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"), 256)

    def drawn(k: int, modulus: Column) -> Column:
        return F.conv(F.substring(digest, 8 * k - 7, 8), 16, 10).cast("long") % modulus

    one, two = drawn(1, F.col("n") + 1), drawn(2, F.col("n") + 1)
    form = (F.when((F.col("n") == 0) | F.col("marked") | (drawn(3, F.lit(100)) >= percent), "plain")
            .when(drawn(4, F.lit(100)) < spm, "spm").otherwise("psm"))
    return stored.withColumns({"form": form, "first": F.least(one, two), "second": F.greatest(one, two)})


class Cuts:
    """Where cuts after units fall in the frames of a text."""

    def __init__(self, frames: list[dict], size: int, chars: int, unpack: zstandard.ZstdDecompressor):
        self.frames, self.size, self.chars, self.unpack = frames, size, chars, unpack
        self.units = np.array([f["units"] for f in frames], np.int64)

    def find(self, u: int) -> tuple[int, int, int]:
        """``frame, byte in it, code points before`` of the cut after ``u`` units."""
        if u == 0:
            return 0, 0, 0
        k = int(np.searchsorted(self.units, u, "left")) - 1  # the last frame with fewer line ends before it
        raw = np.frombuffer(self.unpack.decompress(self.frames[k]["data"]), np.uint8)
        ends = np.flatnonzero(raw == 10)
        nth = u - int(self.units[k])
        if nth > len(ends):  # behind a last line without an end
            return len(self.frames), 0, self.chars
        at = int(ends[nth - 1]) + 1
        return k, at, self.frames[k]["chars"] + _chars(raw[:at])

    def between(self, a: tuple[int, int, int], b: tuple[int, int, int], pack: zstandard.ZstdCompressor) -> list[bytes]:
        """The frames from one cut to another: whole ones as stored, cut ones anew."""
        out = []
        for k in range(a[0], min(b[0] + 1, len(self.frames))):
            lo, hi = a[1] if k == a[0] else 0, b[1] if k == b[0] else None
            if lo == 0 and hi is None:
                out.append(self.frames[k]["data"])
            else:
                part = self.unpack.decompress(self.frames[k]["data"])[lo:hi]
                if part:
                    out.append(pack.compress(part))
        return out


def transform(chosen: DataFrame, level: int = 3) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output``: the
    transformed text as zstandard frames (``array<binary>``)."""

    def task(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack, unpack = zstandard.ZstdCompressor(level=level, write_content_size=True), zstandard.ZstdDecompressor()
        marks = {m: pack.compress(m) for m in (PREFIX, SUFFIX, MIDDLE)}
        for b in it:
            for r in range(b.num_rows):
                form, frames = b.column("form")[r].as_py(), b.column("frames")[r].as_py()
                if form == "plain":
                    before = middle = None
                    output = [f["data"] for f in frames]
                else:
                    c = Cuts(frames, b.column("size")[r].as_py(), b.column("chars")[r].as_py(), unpack)
                    x, y = c.find(b.column("first")[r].as_py()), c.find(b.column("second")[r].as_py())
                    before, middle = x[2], y[2] - x[2]
                    head, inner, tail = (c.between(*p, pack) for p in (((0, 0, 0), x), (x, y), (y, (len(frames), 0, 0))))
                    parts = ([marks[PREFIX], *head, marks[SUFFIX], *tail] if form == "psm" else [marks[SUFFIX], *tail, marks[PREFIX], *head])
                    output = [*parts, marks[MIDDLE], *inner]
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").slice(r, 1), b.column("n").slice(r, 1), b.column("form").slice(r, 1), pa.array([before], pa.int64()),
                     pa.array([middle], pa.int64()), pa.array([output], pa.list_(pa.binary()))],
                    ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    kind = chosen.schema["doc_id"].dataType.simpleString()
    return _joined(chosen.select("doc_id", "n", "chars", "size", "frames", "form", "first", "second"), task,
                   f"doc_id {kind}, n long, form string, prefix_chars long, middle_chars long, output array<binary>")


def _joined(df: DataFrame, task, schema: str, most: int = 4 << 20) -> DataFrame:
    """``mapInArrow`` with the one-row batches of ``task`` put together up to ``most`` bytes."""

    def grouped(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for b in task(it):
            held.append(b)
            size += b.get_total_buffer_size()
            if size >= most or len(held) >= 2000:
                yield pa.concat_batches(held)
                held, size = [], 0
        if held:
            yield pa.concat_batches(held)

    return df.mapInArrow(grouped, schema)


def stream(frames: list[bytes], start: int = 0, stop: int | None = None) -> Iterator[bytes]:
    """The bytes from ``start`` to ``stop`` of frames in order, one frame at a
    time; frames outside are passed by their content size alone."""
    unpack, at = zstandard.ZstdDecompressor(), 0
    for f in frames:
        size = zstandard.frame_content_size(f)
        if (stop is None or at < stop) and at + size > start:
            yield unpack.decompress(f)[max(0, start - at):None if stop is None else stop - at]
        at += size


def marker_places(frames: list[bytes]) -> dict[bytes, int]:
    """Where each marker first begins in the stream of frames."""
    found, tail, at = {}, b"", 0
    for piece in stream(frames):
        text = tail + piece
        for m in (PREFIX, SUFFIX, MIDDLE):
            if m not in found and (k := text.find(m)) >= 0:
                found[m] = at - len(tail) + k
        at += len(piece)
        tail = text[-2:]
    return found


def restored(frames: list[bytes], form: str) -> Iterator[bytes]:
    """The text that was transformed, read back from its output and form."""
    if form == "plain":
        yield from stream(frames)
        return
    where, size = marker_places(frames), 3
    order = [PREFIX, SUFFIX, MIDDLE] if form == "psm" else [SUFFIX, PREFIX, MIDDLE]
    stops = {m: where[n] for m, n in zip(order, order[1:], strict=False)}
    for m in (PREFIX, MIDDLE, SUFFIX):
        yield from stream(frames, where[m] + size, stops.get(m))


def digests(transformed: DataFrame) -> DataFrame:
    """``output_sha256, restored_sha256`` in place of ``output``."""

    def hexdigest(pieces: Iterator[bytes]) -> str:
        h = hashlib.sha256()
        for p in pieces:
            h.update(p)
        return h.hexdigest()

    def task(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            out, back = [], []
            for r in range(b.num_rows):  # one text's frames at a time
                frames, form = b.column("output")[r].as_py(), b.column("form")[r].as_py()
                out.append(hexdigest(stream(frames)))
                back.append(hexdigest(restored(frames, form)))
            yield pa.RecordBatch.from_arrays([b.column(c) for c in names] + [pa.array(out, pa.string()), pa.array(back, pa.string())],
                                             [*names, "output_sha256", "restored_sha256"])

    names = [c for c in transformed.columns if c != "output"]
    kinds = ", ".join(f"`{c}` {transformed.schema[c].dataType.simpleString()}" for c in names)
    return transformed.mapInArrow(task, f"{kinds}, output_sha256 string, restored_sha256 string")


def texts(transformed: DataFrame) -> DataFrame:
    """``text`` (the transformed text, decompressed) in place of ``output``."""

    def task(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            for r in range(b.num_rows):
                whole = b"".join(stream(b.column("output")[r].as_py())).decode()
                yield pa.RecordBatch.from_arrays([b.column(c).slice(r, 1) for c in names] + [pa.array([whole], pa.string())], [*names, "text"])

    names = [c for c in transformed.columns if c != "output"]
    kinds = ", ".join(f"`{c}` {transformed.schema[c].dataType.simpleString()}" for c in names)
    return _joined(transformed, task, f"{kinds}, text string")
