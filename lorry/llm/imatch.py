"""Operator 1, I-Match fingerprints over randomised lexicon subsets.

Terms are lower-cased words without ASCII punctuation (64-bit hashes).  The
lexicon holds the terms whose document frequency lies in a band, that is whose
inverse document frequency ln(N / df) lies between ``ln(1 / high)`` and
``ln(1 / low)``.  A document's terms are made distinct, sorted, and hashed
whole and for ``SUBSETS`` random series of lexicon subsets of 1/2, 1/4, ...,
2**-LEVELS of the lexicon.  A fingerprint is a string: number of terms, hash
of all terms, a byte for every subset.

Two documents agree on a subset of share p with probability (1 - p)**D, D
being the number of terms that only one of them has.  :func:`likeness` takes
the D under which the agreements seen are likeliest and returns the Jaccard
similarity that D and the two numbers of terms amount to.

Corpus statistics cover all documents.  A term in the band is frequent enough
in some task's own rows (its share there reaches ``low``), so a first pass
names candidates and a second counts them exactly; the lexicon has at most
(terms a document) / ``low`` entries, whatever the corpus holds, and only that
is broadcast.

Defined cases: a null text is an empty text; a text with fewer than
``FEW`` lexicon terms uses all its terms, one without any term the hash of
its bytes; equal texts have equal fingerprints; two texts without terms are
alike (1) if equal, else 0; an empty table gives an empty result.  For the
successor of a document, null ids come first and rows of one id go by text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lorry.llm import textvec as tv
from lorry.llm.graph import id_filter, in_filter
from lorry.session import stage

SUBSETS, LEVELS, FEW = 16, 12, 5


def tokens(buf: np.ndarray, offs: np.ndarray) -> tv.Words:
    """Words of the chunk with ASCII punctuation as white space."""
    plain = np.arange(256, dtype=np.uint8)
    plain[33:48] = plain[58:65] = plain[91:97] = plain[123:127] = 32
    return tv.words(plain[buf], offs)


def _merge(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    term, where = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    return term, np.bincount(where, weights=np.concatenate([p[1] for p in parts])).astype(np.int64)


def lexicon(docs: DataFrame, low: float = 1e-3, high: float = 0.2) -> np.ndarray:
    """The sorted hashes of the terms in the band, over all rows of ``docs``."""
    texts = docs.select("text")

    def frequent(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, rows = [], 0
        for b in it:
            rows += b.num_rows
            for lo, hi, buf, offs in tv.batches(b.column(0)):
                w = tokens(buf, offs)
                parts.append(np.unique(tv.distinct(w.hash, w.doc)[0], return_counts=True))
                if len(parts) >= 64:
                    parts = [_merge(parts)]
        if parts:
            term, n = _merge(parts)
            often = term[n >= low * rows]
            yield pa.RecordBatch.from_arrays([pa.array(often.view(np.int64))], ["term"])

    candidates = stage(texts.mapInArrow(frequent, "term long").distinct(), "candidates")
    sent = docs.sparkSession.sparkContext.broadcast(id_filter(candidates, "term"))

    def count(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = []
        for b in it:
            for lo, hi, buf, offs in tv.batches(b.column(0)):
                w = tokens(buf, offs)
                h, _ = tv.distinct(w.hash, w.doc)
                parts.append(np.unique(h[in_filter(sent.value, h.view(np.int64))], return_counts=True))
                if len(parts) >= 64:
                    parts = [_merge(parts)]
        if parts:
            term, n = _merge(parts)
            yield pa.RecordBatch.from_arrays([pa.array(term.view(np.int64)), pa.array(n)], ["term", "n"])

    rows = docs.count()
    band = (texts.mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
            .where((F.col("n") >= low * rows) & (F.col("n") <= high * rows)).select("term").toArrow())
    return np.sort(np.asarray(band.column("term")).view(np.uint64))


def fingerprints(texts: pa.Array, band: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(number of terms, hash of all terms, subset bytes)`` of each text."""
    size = len(texts)
    number, head = np.zeros(size, np.int64), np.zeros(size, np.uint64)
    marks = np.zeros((size, SUBSETS, LEVELS), np.uint8)
    seeds = tv.constants(41, SUBSETS)
    for lo, hi, buf, offs in tv.batches(texts):
        n_docs = hi - lo
        w = tokens(buf, offs)
        h, doc = tv.distinct(w.hash, w.doc)
        if len(band):
            within = band[np.minimum(np.searchsorted(band, h), len(band) - 1)] == h
        else:
            within = np.zeros(len(h), bool)
        enough = np.bincount(doc[within], minlength=n_docs) >= FEW
        keep = within | ~enough[doc]
        h, doc = h[keep], doc[keep]
        number[lo:hi] = np.bincount(doc, minlength=n_docs)
        value = tv.mix(h + np.uint64(tv.PRIME))

        def total(v: np.ndarray, d: np.ndarray, n_docs: int = n_docs) -> np.ndarray:
            out = np.zeros(n_docs, np.uint64)
            if len(v):
                at = np.flatnonzero(np.concatenate([[True], d[1:] != d[:-1]]))
                out[d[at]] = np.add.reduceat(v, at)
            return out

        head[lo:hi] = tv.mix(total(value, doc))
        for r in range(SUBSETS):
            drawn, v, d = tv.mix(h ^ seeds[r]), value, doc
            for level in range(LEVELS):
                inside = drawn < np.uint64(1 << (63 - level))
                drawn, v, d = drawn[inside], v[inside], d[inside]
                marks[lo:hi, r, level] = tv.mix(total(v, d) ^ seeds[r]) >> np.uint64(56)
        for i in np.flatnonzero(number[lo:hi] == 0):
            raw = hashlib.blake2b(buf[offs[i]:offs[i + 1]].tobytes(), digest_size=8).digest()
            head[lo + i] = int.from_bytes(raw, "little")
    return number, head, marks


def write(number: np.ndarray, head: np.ndarray, marks: np.ndarray) -> list[str]:
    """Fingerprints as strings."""
    return [f"{n:x}-{h:016x}-{m.tobytes().hex()}" for n, h, m in zip(number.tolist(), head.tolist(), marks, strict=True)]


def likeness(a: tuple[np.ndarray, np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
    """Estimated Jaccard similarity of the terms of fingerprints, pair by pair."""
    grid = np.unique(np.round(2 ** np.arange(0, 17, 1 / 12)))
    below = (1 - 0.5 ** np.arange(1, LEVELS + 1))[None, :] ** grid[:, None]  # agreement on the subsets of a level
    chance = np.diff(np.concatenate([np.zeros((len(grid), 1)), below, np.ones((len(grid), 1))], axis=1), axis=1)
    same = a[2] == b[2]
    first = LEVELS - np.cumprod(same[:, :, ::-1], axis=2).sum(axis=2)  # the first level from which all agree
    seen = np.stack([(first == k).sum(axis=1) for k in range(LEVELS + 1)], axis=1)
    total = (a[0] + b[0]).astype(float)
    differ = grid[np.argmax(seen @ np.log(np.maximum(chance, 1e-12)).T, axis=1)]
    differ = np.clip(differ, np.abs(a[0] - b[0]), total)
    equal = (a[0] == b[0]) & (a[1] == b[1])
    some = (a[0] > 0) & (b[0] > 0)
    return np.where(equal, 1.0, np.where(some, (total - differ) / np.maximum(total + differ, 1), 0.0))


def successors(docs: DataFrame) -> DataFrame:
    """Rows ``doc_id, text`` in ranges of ids, each range followed by a copy of
    the next range's first row (``tail``), the last one by that of the first:
    whoever reads a partition in order sees every row before its successor.
    Texts move once."""
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    least = F.lit(-(2**63)).cast("long")
    keyed = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.coalesce(F.col("doc_id").cast("long"), least).alias("k"))
    cuts = keyed.agg(F.percentile_approx("k", [i / n for i in range(1, n)], 10 * n)).first()[0] if n > 1 else []
    bounds = np.unique(np.array(cuts or [], np.int64))

    @F.pandas_udf("int")
    def place(k: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, k.to_numpy(), "right").astype(np.int32))

    placed = keyed.withColumn("part", place("k"))
    firsts = sorted((r["part"], r["k"]) for r in keyed.select("k").withColumn("part", place("k")).groupBy("part").agg(F.min("k").alias("k")).collect())
    own = placed.withColumn("tail", F.lit(False))
    if not firsts:
        return own
    before = F.create_map(*[F.lit(x) for i, (_, k) in enumerate(firsts) for x in (k, firsts[i - 1][0])])
    tails = (keyed.where(F.col("k").isin([k for _, k in firsts])).withColumn("part", before[F.col("k")].cast("int"))
             .withColumn("tail", F.lit(True)))
    return own.unionByName(tails).repartitionById(len(bounds) + 1, F.col("part")).sortWithinPartitions("part", "tail", "k", "text")


def fingerprint_edits(docs: DataFrame, band: np.ndarray) -> DataFrame:
    """Fingerprints of every text and of its edited text (the last quarter of
    its code points replaced by as many of the successor's first)."""
    sent = docs.sparkSession.sparkContext.broadcast(band)
    schema = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
              "near_edited double, near_next double")

    def rows(b: pa.RecordBatch, keep: list, most: int = 4 << 20) -> Iterator[list]:
        held = sum(len(t) for _, t, _ in keep)
        for i, t, tail in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), b.column("tail").to_pylist(), strict=True):
            keep.append((i, t, tail))
            held += len(t)
            if held >= most:
                yield keep
                held = sum(len(t) for _, t, _ in keep)

    def results(keep: list) -> pa.RecordBatch | None:
        """Of all rows but the last, which stays."""
        band = sent.value
        texts = [t for _, t, _ in keep]
        at = [i for i in range(len(keep) - 1) if not keep[i][2]]
        if at:
            edited = []
            for i in at:
                m = len(texts[i]) // 4
                edited.append(texts[i][:len(texts[i]) - m] + texts[i + 1][:m])
            own = fingerprints(pa.array(texts, pa.string()), band)
            new = fingerprints(pa.array(edited, pa.string()), band)
            mine, follow = (tuple(x[[i + d for i in at]] for x in own) for d in (0, 1))
            out = pa.RecordBatch.from_arrays([
                pa.array([keep[i][0] for i in at], pa.int64()), pa.array([len(texts[i]) for i in at], pa.int64()),
                pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited]), pa.array(write(*mine)), pa.array(write(*new)),
                pa.array(likeness(mine, new)), pa.array(likeness(mine, follow))],
                ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])
        del keep[:-1]
        return out if at else None

    def task(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep: list = []
        for b in it:
            for full in rows(b, keep):
                if (out := results(full)) is not None:
                    yield out
        if keep and (out := results(keep)) is not None:
            yield out

    return successors(docs).select("doc_id", "text", "tail").mapInArrow(task, schema)
