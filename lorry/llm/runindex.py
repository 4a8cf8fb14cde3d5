"""A run-length index (run-compressed Burrows-Wheeler transform) of strings.

The strings of a block are concatenated, each with an end mark of its own, and
their suffixes sorted.  What is kept is the run-length encoded transform, the
suffix positions sampled at run ends, and where the common prefix of
neighbouring suffixes drops below ``depth``; suffixes between two such places
begin with the same ``depth`` bytes.
"""

from __future__ import annotations

import numpy as np

def sorted_order(key: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The stable order of keys from 0 to ``most``, and where in it a key
    differs from the one before.  Keys that leave room for it are sorted as
    numbers together with their places."""
    n = len(key)
    bits = max(1, (n - 1).bit_length())
    new = np.ones(n, bool)
    if int(most).bit_length() + bits <= 63:
        both = key << bits
        both |= np.arange(n)
        both.sort()
        order = both & ((1 << bits) - 1)
        both >>= bits
    else:
        order = np.argsort(key, kind="stable")
        both = key[order]
    np.not_equal(both[1:], both[:-1], out=new[1:])
    return order, new


class Marks:
    """A bit vector that counts its marks up to a place: a word and the count
    before it for every 64 places."""

    def __init__(self, marked: np.ndarray):
        packed = np.packbits(marked, bitorder="little")
        self.words = np.zeros((len(marked) >> 6) + 1, np.uint64)
        self.words.view(np.uint8)[:len(packed)] = packed
        count = np.bitwise_count(self.words).astype(np.int64)
        self.before = np.cumsum(count) - count

    def up_to(self, place: np.ndarray) -> np.ndarray:
        """How many marks there are up to and with every place."""
        word = place >> 6
        below = self.words[word] << (63 - (place & 63)).astype(np.uint64)
        return self.before[word] + np.bitwise_count(below)


class RunIndex:
    def __init__(self, text: np.ndarray, stops: np.ndarray, depth: int):
        """``text``: the strings' bytes one after the other; ``stops``: where each ends."""
        m, depth = len(stops), int(depth)
        length = np.diff(np.concatenate([[0], stops]))
        n = len(text) + m
        # symbols: end marks 0..m-1 in the order of the strings, bytes above
        own = np.repeat(np.arange(m), length)
        at = np.arange(len(text)) + own
        symbol = np.empty(n, np.int64)
        symbol[at] = text.astype(np.int64) + m
        ends = stops + np.arange(m)
        symbol[ends] = np.arange(m)
        self.string = np.empty(n, np.int32)
        self.string[at] = own
        self.string[ends] = np.arange(m)
        self.ends = ends
        # ranks by ever longer prefixes; a prefix ends with its end mark. The first are as many
        # bytes (numbered as they occur, 0 for an end mark) as fit in a key beside a place
        used = np.bincount(text, minlength=256) > 0
        base = int(used.sum()) + 1
        digit = np.zeros(n, np.int64)
        digit[at] = np.cumsum(used)[text]
        room = 63 - max(1, (n - 1).bit_length())
        first = 1
        while first < depth and base ** (first + 1) < 1 << room:
            first += 1
        left = np.empty(n, np.int64)
        left[at] = ends[own] - at
        left[ends] = 0
        key = np.zeros(n, np.int64)
        for j in range(first):
            key *= base
            # beyond an end mark the key does not reach into the next string
            key[:max(0, n - j)] += np.where(left[:max(0, n - j)] >= j, digit[j:], 0)
        # equal short suffixes differ in their end marks, which come in the order of places
        order, new = sorted_order(key, base ** first)
        new |= (left < first)[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(new) - 1
        step, levels = first, [(first, rank)]
        longest = int(length.max()) + 1 if m else 0
        while step < longest and int(rank.max()) < n - 1:
            follow = np.zeros(n, np.int64)
            follow[:max(0, n - step)] = rank[step:]
            follow[left < step] = 0  # the rank is already that of a whole suffix
            follow += rank * n
            order, new = sorted_order(follow, n * n)  # equal pairs get one rank
            rank = np.empty(n, np.int64)
            rank[order] = np.cumsum(new) - 1
            step *= 2
            levels.append((step, rank))
        suffix = np.empty(n, np.int64)
        suffix[rank] = np.arange(n)
        # where the common prefix with the suffix before is shorter than depth
        step, by = max((x for x in levels if x[0] <= depth), key=lambda x: x[0])
        a, b = suffix[:-1], suffix[1:]
        alike = (left[a] >= depth) & (left[b] >= depth)
        place = 0
        while place < depth:
            place = min(place, depth - step)
            alike &= by[np.minimum(a + place, n - 1)] == by[np.minimum(b + place, n - 1)]
            place += step
        begins = np.concatenate([[True], ~alike])
        self.class_start, self.class_marks = np.flatnonzero(begins), Marks(begins)
        # the transform, run by run
        before = symbol[suffix - 1]
        run = np.concatenate([[True], before[1:] != before[:-1]])
        self.run_start, self.run_marks = np.flatnonzero(run), Marks(run)
        self.run_symbol = before[self.run_start]
        run_length = np.diff(np.append(self.run_start, n))
        self.run_end_sample = suffix[self.run_start + run_length - 1]
        by_symbol = np.argsort(self.run_symbol, kind="stable")
        so_far = np.cumsum(run_length[by_symbol]) - run_length[by_symbol]
        self.run_to = np.empty(len(by_symbol), np.int64)  # first rank that a run's suffixes step to
        self.run_to[by_symbol] = so_far
        self.least = None
        self.suffix_string = self.string[suffix]

    def set_values(self, values: np.ndarray) -> None:
        """Keeps the least value of the strings in each class, and forgets the order of the suffixes."""
        self.least = np.minimum.reduceat(values[self.suffix_string], self.class_start)
        self.suffix_string = None

    def step(self, rank: np.ndarray) -> np.ndarray:
        """The rank of the suffix that begins one symbol earlier (LF mapping over runs)."""
        run = self.run_marks.up_to(rank) - 1
        return self.run_to[run] + rank - self.run_start[run]

    def least_of(self, rank: np.ndarray) -> np.ndarray:
        """The least value among the strings that hold the suffix's first ``depth`` bytes."""
        return self.least[self.class_marks.up_to(rank) - 1]

    def stream(self, length: np.ndarray, depth: int) -> np.ndarray:
        """Matching statistics of the block's own strings, all at once and from
        their ends backwards: for every string and offset the least value of a
        string with the same ``depth`` bytes (-1 where fewer are left)."""
        width = max(0, int(length.max()) - depth + 1) if len(length) else 0
        out = np.full((len(length), width), np.iinfo(np.int64).max)
        rank = np.arange(len(length), dtype=np.int64)  # of the end marks
        active = np.arange(len(length))
        for done in range(1, int(length.max()) + 1 if len(length) else 1):
            stays = length[active] >= done
            if not stays.all():
                active, rank = active[stays], rank[stays]
            rank = self.step(rank)
            if done >= depth:
                out[active, length[active] - done] = self.least_of(rank)
        return out
