"""Operator 9, quality classifier: a factorisation machine.

Features of a text: its distinct lower-cased words hashed into ``2**bits``
buckets (each with the value 1/sqrt(distinct buckets)), and structure
statistics and the length, each as one of ``BINS`` indicator features.  The
score is a logistic of ``w0 + sum w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j``;
the pairwise part is computed in linear time with the sum-of-squares identity
``1/2 * sum_f ((sum_i v_if x_i)^2 - sum_i (v_if x_i)^2)``.

The model is fitted on at most ``max_train`` labelled rows (the bound is a
parameter; rows are taken by the order of a hash of their id), so what is
collected and broadcast has a fixed size; scoring covers every whole text.

Defined cases: a null text is an empty text; an empty text has statistics
only and gets a score; rows without a label do not train; without any
labelled row, or with labels of one kind only, the score is the smoothed
share of good labels (0.5 without any); repeated rows are scored alike; of the
texts of one id only the one of the least hash trains; a null id never trains.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lorry.llm import textvec as tv

BINS = 16
#: byte classes: 0 other, 1 upper, 2 lower, 3 digit, 4 space, 5 line break, 6 not ASCII, 7 sentence marks, 8 other marks
CLASSES = 9
STATISTICS = 15


class Model(NamedTuple):
    bits: int
    bias: float
    linear: np.ndarray  # one weight a feature
    factors: np.ndarray  # features x rank


def byte_classes() -> np.ndarray:
    c = np.zeros(256, np.int64)
    c[33:127] = 8
    c[65:91], c[97:123], c[48:58] = 1, 2, 3
    c[[32, 9, 11, 12]], c[[10, 13]] = 4, 5
    c[128:] = 6
    c[[ord(x) for x in ".,;:?-'\"()"]] = 7
    return c


def features(buf: np.ndarray, offs: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(feature, value, row)`` of a chunk of texts, rows ascending."""
    n = len(offs) - 1
    size = np.diff(offs)
    kinds = np.bincount(np.repeat(np.arange(n), size) * CLASSES + byte_classes()[buf], minlength=n * CLASSES).reshape(n, CLASSES)
    w = tv.words(buf, offs)
    n_words = np.bincount(w.doc, minlength=n)
    bucket = (w.hash >> np.uint64(64 - bits)).astype(np.int64)
    key, times = np.unique(w.doc << bits | bucket, return_counts=True)
    row, hashed = key >> bits, key & ((1 << bits) - 1)
    n_distinct = np.bincount(row, minlength=n)
    most = np.zeros(n, np.int64)
    np.maximum.at(most, row, times)
    same = np.zeros(n, np.int64)
    again = w.doc[1:][(w.hash[1:] == w.hash[:-1]) & (w.doc[1:] == w.doc[:-1])]
    same += np.bincount(again, minlength=n)
    marked = np.bincount(w.doc, weights=(byte_classes()[buf[w.stop - 1]] == 8) if len(w.stop) else None, minlength=n)
    word_bytes = np.bincount(w.doc, weights=w.stop - w.start, minlength=n)
    one = np.maximum(size, 1)
    ones = np.maximum(n_words, 1)
    share = [kinds[:, k] / one for k in range(1, CLASSES)] + [n_distinct / ones, most / ones, same / ones, marked / ones]
    stats = np.stack([np.sqrt(np.clip(s, 0, 1)) for s in share] + [
        np.minimum(word_bytes / ones / 24, 1), np.log2(1 + n_words) / 20, np.log2(1 + size) / 24], axis=1)
    place = np.minimum((stats * BINS).astype(np.int64), BINS - 1) + np.arange(STATISTICS) * BINS + (1 << bits)
    feature = np.concatenate([hashed, place.ravel()])
    value = np.concatenate([1 / np.sqrt(n_distinct[row]), np.full(n * STATISTICS, 1 / np.sqrt(STATISTICS))])
    rows = np.concatenate([row, np.repeat(np.arange(n), STATISTICS)])
    order = np.argsort(rows, kind="stable")
    return feature[order], value[order], rows[order]


def raw_scores(m: Model, feature: np.ndarray, value: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Logits of rows whose features begin at ``starts`` (none is empty)."""
    x = value[:, None].astype(np.float32)
    vx = m.factors[feature] * x
    first = np.add.reduceat(vx, starts, axis=0, dtype=np.float64)
    second = np.add.reduceat(vx * vx, starts, axis=0, dtype=np.float64)
    linear = np.add.reduceat(m.linear[feature] * value, starts, dtype=np.float64)
    return m.bias + linear + 0.5 * (first * first - second).sum(axis=1)


def fit(feature: np.ndarray, value: np.ndarray, starts: np.ndarray, label: np.ndarray, bits: int, rank: int,
        epochs: int = 8, steps: int = 1000, batch: int = 128, rate: float = 0.1, decay: float = 1e-4, seed: int = 7) -> Model:
    """Logistic loss, mini-batches with Adagrad steps: at least ``epochs`` passes and ``steps`` steps."""
    size = (1 << bits) + STATISTICS * BINS
    good = float(label.sum())
    bias = float(np.log((good + 0.5) / (len(label) - good + 0.5)))
    rng = np.random.default_rng(seed)
    m_lin, m_fac = np.zeros(size), rng.normal(0, 0.05, (size, rank))
    if not 0 < good < len(label):
        return Model(bits, bias, m_lin.astype(np.float32), np.zeros((size, rank), np.float32))
    g_lin, g_fac, g_bias = np.full(size, 1e-3), np.full((size, rank), 1e-3), 1e-3
    stops = np.append(starts[1:], len(feature))
    for _ in range(max(epochs, -(-steps * batch // len(label)))):
        order = rng.permutation(len(label))
        for lo in range(0, len(order), batch):
            rows = order[lo:lo + batch]
            n = stops[rows] - starts[rows]
            at = np.repeat(starts[rows] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
            f, x, r = feature[at], value[at], np.repeat(np.arange(len(rows)), n)
            own = np.cumsum(n) - n
            vx = m_fac[f] * x[:, None]
            first = np.add.reduceat(vx, own, axis=0)
            z = bias + np.add.reduceat(m_lin[f] * x, own) + 0.5 * (first * first - np.add.reduceat(vx * vx, own, axis=0)).sum(axis=1)
            error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - label[rows]) / len(rows)
            e = error[r]
            used, where = np.unique(f, return_inverse=True)
            d_lin = np.bincount(where, weights=e * x) + decay / len(rows) * m_lin[used]
            each = (e * x)[:, None] * (first[r] - vx)
            d_fac = np.stack([np.bincount(where, weights=each[:, k]) for k in range(rank)], axis=1) + decay / len(rows) * m_fac[used]
            g_lin[used] += d_lin ** 2
            g_fac[used] += d_fac ** 2
            m_lin[used] -= rate * d_lin / np.sqrt(g_lin[used])
            m_fac[used] -= rate * d_fac / np.sqrt(g_fac[used])
            g_bias += error.sum() ** 2
            bias -= rate * error.sum() / np.sqrt(g_bias)
    return Model(bits, float(bias), m_lin.astype(np.float32), m_fac.astype(np.float32))


def held_out(doc_id: Column) -> Column:
    """Whether a row is kept from training: crc32 of the id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def train(docs: DataFrame, labels: DataFrame, bits: int = 15, rank: int = 8, max_train: int = 6000) -> Model:
    """Fits on at most ``max_train`` labelled rows that are not held out."""
    chosen = (labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
              .groupBy("doc_id").agg(F.max("quality").cast("double").alias("label"))
              .orderBy(F.xxhash64(F.col("doc_id"), F.lit(17)), "doc_id").limit(max_train))
    # at most max_train ids and labels: a size known beforehand; one text an id, so that
    # no more than max_train rows reach the driver whatever ids repeat
    sample = (docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
              .groupBy("doc_id").agg(F.min_by("text", F.xxhash64("text")).alias("text"), F.max("label").alias("label")))

    def task(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            label, ids = b.column("label"), b.column("doc_id")
            for lo, hi, buf, offs in tv.batches(b.column("text")):
                f, x, r = features(buf, offs, bits)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(lo, hi - lo), label.slice(lo, hi - lo), tv.lists(f.astype(np.int32), r, hi - lo, pa.int32()),
                     tv.lists(x.astype(np.float32), r, hi - lo, pa.float32())], ["doc_id", "label", "feature", "value"])

    got = sample.mapInArrow(tv.tidy(task), f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, label double, feature array<int>, value array<float>").toArrow()
    got = got.sort_by("doc_id")
    if not len(got):
        return fit(np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64), np.zeros(0), bits, rank)
    lists = got.column("feature").combine_chunks()
    n = np.diff(np.asarray(lists.offsets))
    feature = np.asarray(lists.flatten()).astype(np.int64)
    value = np.asarray(got.column("value").combine_chunks().flatten()).astype(np.float64)
    return fit(feature, value, np.cumsum(n) - n, np.asarray(got.column("label")), bits, rank)


def probabilities(m: Model, texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray]]:
    """``(first row, last row + 1, score of each)`` of a column of texts, part by part."""
    for lo, hi, buf, offs in tv.batches(texts):
        f, x, r = features(buf, offs, m.bits)
        n = np.bincount(r, minlength=hi - lo)
        z = raw_scores(m, f, x, np.cumsum(n) - n)
        yield lo, hi, 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def score_of(docs: DataFrame, model: Model, text: str = "text") -> Column:
    """The score of every row of ``docs`` as a column: only the text goes to
    Python workers and only the score comes back, rows stay where they are."""
    sent = docs.sparkSession.sparkContext.broadcast(tuple(model))

    @F.arrow_udf("double")
    def scored(it: Iterator[pa.Array]) -> Iterator[pa.Array]:
        m = Model(*sent.value)
        for texts in it:
            out = np.zeros(len(texts))
            for lo, hi, p in probabilities(m, texts):
                out[lo:hi] = p
            yield pa.array(out)

    return scored(F.col(text))


def score(docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",), text: str = "text", out: str = "score") -> DataFrame:
    """``keep`` columns and the score (0 to 1) of every row in the column
    ``out`` (none of ``keep``), in one pass."""
    if out in keep:
        raise ValueError(f"{out!r} is a column of the input; name another with out=")
    sent = docs.sparkSession.sparkContext.broadcast(tuple(model))  # 2**bits + a few rows of rank + 1 floats

    def task(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Model(*sent.value)
        for b in it:
            for lo, hi, p in probabilities(m, b.column(text)):
                yield pa.RecordBatch.from_arrays([b.column(c).slice(lo, hi - lo) for c in keep] + [pa.array(p)], [*keep, out])

    kept = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    return docs.select(*dict.fromkeys([*keep, text])).mapInArrow(tv.tidy(task), f"{kept}, `{out}` double")
