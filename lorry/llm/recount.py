"""Operator 10, edit-aware token counts.

A document's pre-tokens are kept as leaves of up to ``LEAF`` pre-tokens in a
segment tree whose nodes hold sums of characters and tokens.  An edit
(replace ``start..stop`` by a text) descends to the leaf that holds the
character two before it, since a match of the pattern depends on at most two
characters behind its end; from there the new text is matched again until a
match begins, beyond the edit, where an old leaf began.  Only the leaves in
between are encoded anew, and the sums on the paths to the root change.

The tree of a document is two lists (characters and tokens of its leaves), so
it can be kept in a table and edited by a later job (:func:`build`,
:func:`apply_edits`); the count of a text is the root's sum.

Defined cases: a null text is empty; null or empty edits change nothing;
positions outside the current text are moved to its ends, and ``stop`` before
``start`` means an insertion at ``start``; a null replacement is empty; edits
apply one after the other, each to the text that the one before left;
repeated rows are handled one by one; further columns are dropped except
those asked for with ``keep``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lorry.llm.bpe import Encoder, _digest, slices, worker_object

LEAF = 32
EDITS = "array<struct<start:int,stop:int,text:string>>"


class Counter:
    """Pre-tokens and their token counts."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex

        self.encoder = Encoder(ranks, pattern)
        self.iterate = regex.compile(pattern).finditer
        self.find = self.encoder.find
        self.known: dict[str, int] = {}

    def count(self, piece: str) -> int:
        n = self.known.get(piece)
        if n is None:
            n = len(self.encoder.piece(piece)) // 4
            if len(piece) <= 64:
                if len(self.known) >= 1_000_000:
                    self.known.clear()
                self.known[piece] = n
        return n

    def leaves(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Characters and tokens of the leaves of a text."""
        pieces = self.find(text)
        if not pieces:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.arange(0, len(pieces), LEAF)
        get, count = self.known.get, self.count
        return (np.add.reduceat(np.fromiter(map(len, pieces), np.int64, len(pieces)), at),
                np.add.reduceat(np.fromiter((get(p) or count(p) for p in pieces), np.int64, len(pieces)), at))


class Tree:
    """Sums of characters and tokens over leaves."""

    def __init__(self, chars: np.ndarray, tokens: np.ndarray):
        self.n = len(chars)
        self.size = 1 << max(0, self.n - 1).bit_length()
        self.sum = np.zeros((2 * self.size, 2), np.int64)
        self.sum[self.size:self.size + self.n, 0] = chars
        self.sum[self.size:self.size + self.n, 1] = tokens
        at = self.size
        while at > 1:
            self.sum[at // 2:at] = self.sum[at:2 * at:2] + self.sum[at + 1:2 * at:2]
            at //= 2

    def leaf_at(self, place: int) -> tuple[int, int]:
        """The leaf that holds a character, and where the leaf begins."""
        at, start = 1, 0
        while at < self.size:
            left = int(self.sum[2 * at, 0])
            if place - start < left:
                at = 2 * at
            else:
                start += left
                at = 2 * at + 1
        return at - self.size, start

    def leaves(self) -> tuple[np.ndarray, np.ndarray]:
        own = self.sum[self.size:self.size + self.n]
        return own[:, 0], own[:, 1]

    def replace(self, lo: int, hi: int, chars: list[int], tokens: list[int]) -> Tree:
        """The tree with leaves ``lo..hi`` replaced: sums on the paths to the
        root change if their number stays, else the tree is put together anew
        from its leaves (nothing is encoded for that)."""
        if len(chars) != hi - lo:
            c, t = self.leaves()
            return Tree(np.concatenate([c[:lo], chars, c[hi:]]).astype(np.int64), np.concatenate([t[:lo], tokens, t[hi:]]).astype(np.int64))
        for k in range(lo, hi):
            change = np.array([chars[k - lo], tokens[k - lo]]) - self.sum[self.size + k]
            at = self.size + k
            while at:
                self.sum[at] += change
                at //= 2
        return self

    @property
    def tokens(self) -> int:
        return int(self.sum[1, 1]) if self.n else 0


def edit(text: str, tree: Tree, counter: Counter, start: int, stop: int, new: str) -> tuple[str, Tree, int]:
    """The edited text, its tree (the one passed is used up), and how many
    pre-tokens were encoded for it."""
    start = min(max(start, 0), len(text))
    stop = min(max(stop, start), len(text))
    after = text[:start] + new + text[stop:]
    shift = len(new) - (stop - start)
    if not tree.n:
        chars, tokens = counter.leaves(after)
        return after, Tree(chars, tokens), len(counter.find(after))
    first, begin = tree.leaf_at(max(0, start - 2))
    # old leaf starts at or beyond the end of the edit, in the new text's places
    last, end = (tree.n, len(text)) if stop >= len(text) else tree.leaf_at(stop)
    chars_of = tree.leaves()[0]
    if last < tree.n and end < stop:
        end += int(chars_of[last])
        last += 1
    goal = max(end + shift, start + len(new))
    chars, tokens, n, at = [], [], 0, begin
    for m in counter.iterate(after, begin):
        while last < tree.n and end + shift < at:
            end += int(chars_of[last])
            last += 1
        if at >= start + len(new) and at == end + shift and last <= tree.n and at >= goal:
            break
        if n % LEAF == 0:
            chars.append(0)
            tokens.append(0)
        chars[-1] += m.end() - m.start()
        tokens[-1] += counter.count(m.group())
        n += 1
        at = m.end()
    else:
        last = tree.n
    return after, tree.replace(first, last, chars, tokens), n


def edit_all(text: str, tree: Tree, counter: Counter, edits: list | None) -> tuple[str, Tree, int]:
    """A document after its edits, one after the other."""
    n = 0
    for e in edits or ():
        if e is not None:
            start = e["start"] or 0
            text, tree, k = edit(text, tree, counter, start, start if e["stop"] is None else e["stop"], e["text"] or "")
            n += k
    return text, tree, n


def _counter(sent) -> Counter:
    return worker_object("counter:" + sent.value[2], lambda: Counter(*sent.value[:2]))


def _types(docs: DataFrame, keep: tuple[str, ...]) -> str:
    return ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)


def build(docs: DataFrame, ranks: dict[bytes, int], pattern: str, keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """``keep`` columns, the text, and its tree: ``leaf_chars, leaf_tokens``."""
    sent = docs.sparkSession.sparkContext.broadcast((ranks, pattern, _digest(ranks, pattern)))
    names = [*keep, "text", "leaf_chars", "leaf_tokens"]

    def task(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(sent)
        for whole in it:
            for b in slices(whole, text):
                trees = [counter.leaves(t or "") for t in b.column(text).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*(b.column(c) for c in keep), b.column(text),
                     *(pa.array([t[k].astype(np.int32) for t in trees], pa.list_(pa.int32())) for k in (0, 1))], names)

    return docs.select(*dict.fromkeys([*keep, text])).mapInArrow(
        task, f"{_types(docs, keep)}, text string, leaf_chars array<int>, leaf_tokens array<int>")


def apply_edits(trees: DataFrame, ranks: dict[bytes, int], pattern: str, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``trees`` (as from :func:`build`, with a column ``edits``) after their
    edits: ``keep`` columns, ``text, leaf_chars, leaf_tokens, n_tokens_before,
    n_tokens, n_recoded``."""
    sent = trees.sparkSession.sparkContext.broadcast((ranks, pattern, _digest(ranks, pattern)))
    names = [*keep, "text", "leaf_chars", "leaf_tokens", "n_tokens_before", "n_tokens", "n_recoded"]

    def task(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(sent)
        for whole in it:
            for b in slices(whole, "text"):
                out = []
                for text, c, t, edits in zip(*(b.column(x).to_pylist() for x in ("text", "leaf_chars", "leaf_tokens", "edits")), strict=True):
                    tree = Tree(np.array(c or (), np.int64), np.array(t or (), np.int64))
                    before = tree.tokens
                    text, tree, n = edit_all(text or "", tree, counter, edits)
                    out.append((text, *(x.astype(np.int32) for x in tree.leaves()), before, tree.tokens, n))
                columns = list(zip(*out, strict=True)) or [()] * 6
                kinds = [pa.string(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.int64(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([*(b.column(x) for x in keep), *(pa.array(x, k) for x, k in zip(columns, kinds, strict=True))], names)

    return trees.select(*dict.fromkeys([*keep, "text", "leaf_chars", "leaf_tokens", "edits"])).mapInArrow(
        task, f"{_types(trees, keep)}, text string, leaf_chars array<int>, leaf_tokens array<int>, "
              "n_tokens_before long, n_tokens long, n_recoded long")


def count_edits(docs: DataFrame, ranks: dict[bytes, int], pattern: str, keep: tuple[str, ...] = ("doc_id",),
                text: str = "text") -> DataFrame:
    """:func:`build` and :func:`apply_edits` in one pass over texts that come
    with a column ``edits``, for trees that nobody keeps: ``keep`` columns,
    ``text`` (edited), ``n_tokens_before, n_tokens, n_recoded``."""
    sent = docs.sparkSession.sparkContext.broadcast((ranks, pattern, _digest(ranks, pattern)))
    names = [*keep, "text", "n_tokens_before", "n_tokens", "n_recoded"]

    def task(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(sent)
        for whole in it:
            for b in slices(whole, text):
                out = []
                for t, edits in zip(b.column(text).to_pylist(), b.column("edits").to_pylist(), strict=True):
                    tree = Tree(*counter.leaves(t or ""))
                    before = tree.tokens
                    t, tree, n = edit_all(t or "", tree, counter, edits)
                    out.append((t, before, tree.tokens, n))
                columns = list(zip(*out, strict=True)) or [()] * 4
                kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([*(b.column(x) for x in keep), *(pa.array(x, k) for x, k in zip(columns, kinds, strict=True))], names)

    return docs.select(*dict.fromkeys([*keep, text, "edits"])).mapInArrow(
        task, f"{_types(docs, keep)}, text string, n_tokens_before long, n_tokens long, n_recoded long")


def attach(trees: DataFrame, edits: DataFrame, key: str = "doc_id") -> DataFrame:
    """``trees`` with the rows ``key, edit_no, start, stop, text`` of a table of
    edits as the column ``edits`` (in the order of ``edit_no``); a document's
    own edits meet in one row."""
    own = edits.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("edit_no", "start", "stop", "text"))).alias("e"))
    ordered = own.select(key, F.transform("e", lambda x: F.struct(
        x.start.cast("int").alias("start"), x.stop.cast("int").alias("stop"), x.text.alias("text"))).alias("edits"))
    return trees.join(ordered, key, "left")
