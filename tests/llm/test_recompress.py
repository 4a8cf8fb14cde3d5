"""Operator 12 against brute force; the names' consistency on its own."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from lorry.llm import recompress
from lorry.llm import textvec as tv

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def brute(rows, size):
    """``(doc_id, n_words, n_removed, kept)`` of every row."""
    words = [(i, WORD.findall((t or "").encode())) for i, t in rows]
    low = -(2**63)
    first = {}
    for i, w in words:
        own = low if i is None else i
        for k in range(len(w) - size + 1):
            s = tuple(w[k:k + size])
            first[s] = min(own, first.get(s, own))
    out = []
    for i, w in words:
        own = low if i is None else i
        gone = set()
        for k in range(len(w) - size + 1):
            if first[tuple(w[k:k + size])] < own:
                gone.update(range(k, k + size))
        out.append((i, len(w), len(gone), b" ".join(x for k, x in enumerate(w) if k not in gone).decode()))
    return out


def _check(got, rows, size):
    def key(r):
        return str(r[0]), *map(str, r[1:])

    assert sorted(map(key, ((r.doc_id, r.n_words, r.n_removed, r.kept) for r in got))) == sorted(map(key, brute(rows, size)))


def _prose(rnd, n, pool=300):
    return [f"w{rnd.randrange(pool)}" for _ in range(n)]


def _docs(spark, rows):
    data = [(i, t, 1, 2, "x", "y") for i, t in rows]
    return spark.createDataFrame(data, "doc_id long, text string, doc long, key long, spans string, anchors string")


@pytest.mark.parametrize("size, levels, seed", [(50, 13, 1), (50, 13, 2), (7, 5, 3), (1, 4, 4), (3, 1, 5)])
def test_removal_equals_brute_force(spark, size, levels, seed):
    """Shared passages (just as long as a window, shorter, longer, at either end), copies,
    near copies, texts of few distinct words."""
    rnd = random.Random(seed)
    passages = [_prose(rnd, n) for n in (size - 1, size, size + 1, 3 * size, 400)]
    rows = []
    for i in range(70):
        w = _prose(rnd, rnd.choice([0, 5, size, 60, 300]))
        for p in rnd.sample(passages, rnd.randint(0, 3)):
            at = rnd.choice([0, len(w), rnd.randint(0, len(w))])
            w = w[:at] + p + w[at:]
        rows.append((i, rnd.choice([" ", "\n", " \t "]).join(w)))
    rows += [(100 + k, rows[k][1]) for k in range(0, 70, 3)]
    rows += [(200 + k, rows[k][1].replace("w7", "W7")) for k in range(0, 70, 5)]
    rows += [(300 + k, " ".join(rnd.choice("ab") for _ in range(200))) for k in range(6)]
    rows += [(400, "a " * 500), (401, "a " * 300), (402, "b " + "a " * 120 + "b"), (403, "a b " * 90), (404, "b a " * 70)]
    rnd.shuffle(rows)
    got = recompress.remove_repeats(_docs(spark, rows), size=size, levels=levels).collect()
    _check(got, rows, size)
    assert any(r.n_removed for r in got) and any(not r.n_removed for r in got)


def test_odd_rows(spark):
    """Null and repeated ids, null and empty texts, a text for a third of the rows, very long texts in many chunks."""
    rnd = random.Random(9)
    p = " ".join(_prose(rnd, 60))
    long = " ".join(_prose(rnd, 120_000, 5000))
    rows = [(None, p), (None, p), (1, p), (2, None), (3, ""), (3, p + " x"), (3, "y " + p), (4, " \n "), (-5, p), (10, long), (11, "start " + long + " end"),
            (12, "é " + long[:2000] + " ß")]
    rows += [(1000 + k, "common " + p + f" {k}") for k in range(40)]
    got = recompress.remove_repeats(_docs(spark, rows)).collect()
    _check(got, rows, 50)
    for r in got:
        assert sum(s.stop - s.start for s in r.spans) == r.n_removed
        assert all(a.stop < b.start for a, b in zip(r.spans, r.spans[1:], strict=False))


def test_empty_table(spark):
    assert recompress.remove_repeats(_docs(spark, [])).collect() == []


def test_null_ids_are_smaller_but_not_than_each_other(spark):
    p = " ".join(f"t{k}" for k in range(55))
    got = {(r.doc_id, r.n_removed) for r in recompress.remove_repeats(_docs(spark, [(None, p), (None, p + " z"), (7, p)])).collect()}
    assert got == {(None, 0), (7, 55)}


@pytest.mark.parametrize("size", [1, 2, 5, 50])
def test_names_stand_for_windows(size):
    """Equal windows have equal names and anchors wherever they stand, different ones do not, in either half."""
    rnd = random.Random(size)
    texts = [" ".join(rnd.choice("ab") for _ in range(300)) for _ in range(4)] + ["a " * 200, "a " * 150 + "b b b " + "a " * 90]
    texts += [" ".join(_prose(rnd, 400, 40)) for _ in range(3)]
    texts += [texts[7][11:900], f"x {texts[8]} z", f"{texts[7]} {texts[8]}"]
    name, window = {}, ({}, {})
    for lo, hi, buf, offs in tv.batches(pa.array(texts), 2000):
        start, stop, doc, a, b = recompress.word_names(buf, offs)
        r = recompress.Recompression(a, b, doc, 6)
        count = np.bincount(doc, minlength=hi - lo)
        first = np.cumsum(count) - count
        at = np.concatenate([np.arange(f, f + max(0, n - size + 1)) for f, n in zip(first, count, strict=True)]).astype(np.int64)
        anchor, x, y = r.windows(at, size, True)
        assert (anchor == r.windows(at, size, False)[0]).all()
        words = [bytes(buf[s:e]) for s, e in zip(start, stop, strict=True)]
        for t, *n in zip(at, anchor, x, y, strict=True):
            w = tuple(words[t:t + size])
            assert name.setdefault(w, n) == n
            assert all(seen.setdefault(half, w) == w for seen, half in zip(window, n[1:], strict=True))
    assert len(name) > 30


def test_decisions_need_both_halves(spark, monkeypatch):
    """With the first half of all names forced equal, the second still tells windows apart."""
    one = recompress._join

    def halved(x, y, lane):
        return one(x, y, lane) if lane else one(x, y, lane) & np.uint64(1)

    rnd = random.Random(3)
    rows = [(i, " ".join(_prose(rnd, 70))) for i in range(12)]
    rows += [(20 + i, rows[i][1] + " more") for i in range(3)]
    monkeypatch.setattr(recompress, "_join", halved)
    _check(recompress.remove_repeats(_docs(spark, rows)).collect(), rows, 50)
