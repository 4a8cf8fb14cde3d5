"""Operator 11 against a plain simulation, document by document."""

import random
import re
from itertools import permutations

import numpy as np
import pytest

from lorry.llm import interaction

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, labels, names="ABCDE"):
    """Every order applied to every document, one filter after the other."""
    first = {}
    for i, t, _ in rows:
        if i is not None:
            first[t or ""] = min(i, first.get(t or "", i))
    docs = []
    for i, t, part in rows:
        t = t or ""
        w = WORD.findall(t)
        fails = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 3 * len(t),
                 "D": bool(re.search(r"[#$%&*|]", t)), "E": i is not None and first[t] < i}
        docs.append((part or "", fails, *labels.get(i, (0, 0))))
    out = {}
    for part in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == part]
        total = dict.fromkeys(names, 0)
        for order in permutations(names):
            alive = own
            for step, f in enumerate(order, 1):
                gone = [d for d in alive if d[1][f]]
                alive_after = [d for d in alive if not d[1][f]]
                out[part, "".join(order), step] = [
                    len(alive_after), len(gone), sum(d[1][f] for d in own) - len(gone),
                    sum(d[1][f] and sum(d[1].values()) == 1 for d in own), sum(d[2] == 1 for d in gone), sum(d[3] == 1 for d in gone)]
                total[f] += len(gone)
                alive = alive_after
        for order in permutations(names):
            for step, f in enumerate(order, 1):
                out[part, "".join(order), step].append(total[f])
    return out


def _rows(seed, n):
    rnd = random.Random(seed)
    texts = []
    for _ in range(n):
        k = rnd.choice([0, 3, 150, 199, 200, 260])
        pool = rnd.choice([20, 5000])
        words = [f"w{rnd.randrange(pool)}" for _ in range(k)]
        if rnd.random() < 0.3:
            words = [w.upper() for w in words]
        if rnd.random() < 0.3:
            words.insert(0, rnd.choice("#$%&*|"))
        texts.append(rnd.choice([" ", "\n", "\x0b "]).join(words))
    texts += rnd.choices(texts, k=n // 2) + [None, "", "É" * 30 + "A", " " * 3]
    return [(i, t, rnd.choice(["en", "de", None])) for i, t in enumerate(texts)]


def _frames(spark, rows, labels):
    docs = spark.createDataFrame([(i, t, p, 1, "x", 2.0) for i, t, p in rows], "doc_id long, text string, lang string, mask int, digest string, quality double")
    return docs, spark.createDataFrame([(i, *v) for i, v in labels], "doc_id long, quality int, toxic int")


def _got(df):
    assert df.columns == ["part", "filter_order", "step", *interaction.MEASURES]
    rows = df.collect()
    out = {(r.part, r.filter_order, r.step): list(r)[3:] for r in rows}
    assert len(out) == len(rows)
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_audit_equals_a_simulation(spark, seed):
    rows = _rows(seed, 60)
    rnd = random.Random(seed + 50)
    labels = [(i, (rnd.randrange(2), rnd.choice([0, 1, None]))) for i in range(0, 90, 2)]
    docs, known = _frames(spark, rows, labels)
    assert _got(interaction.audit(interaction.text_masks(docs, known), "ABCDE")) == brute(rows, dict(labels))


def test_odd_rows(spark):
    """Null and repeated ids, repeated labels, one text for a third of the rows, a very long text."""
    rows = [(None, "a b", "en"), (5, "a b", "en"), (5, "a b", "en"), (9, "a b", None), (None, None, None)]
    rows += [(100 + k, "the same text", "en") for k in range(300)] + [(7, "word " * 400_000, "en"), (8, "", "en")]
    docs, known = _frames(spark, rows, [(5, (0, 1)), (5, (1, None)), (9, (1, 1)), (None, (1, 1))])
    got = _got(interaction.audit(interaction.text_masks(docs, known), "ABCDE"))
    assert got == brute(rows, {5: (1, 1), 9: (1, 1)})
    # E alone first: copies beyond the smallest id go; the two rows of id 5 are no copies of each other
    assert got["en", "EABCD", 1][1] == 299 and got["", "EABCD", 1][1] == 1


def test_empty_table(spark):
    docs, known = _frames(spark, [], [])
    assert interaction.audit(interaction.text_masks(docs, known), "ABCDE").collect() == []


def test_min_plus_steps():
    position = interaction.positions(4)
    orders = list(permutations(range(4)))
    assert all(position[r, f] == orders[r].index(f) + 1 for r in range(24) for f in range(4))
    steps = interaction.removal_steps(np.arange(16), position)
    for m in range(16):
        for r, order in enumerate(orders):
            assert steps[m, r] == next((s for s, f in enumerate(order, 1) if m >> f & 1), 5)


def test_number_of_filters(spark):
    masked = spark.createDataFrame([("p", 1, True, False), ("p", 0, None, None)], "part string, mask int, good boolean, toxic boolean")
    assert [tuple(r) for r in interaction.audit(masked, "X").collect()] == [("p", "X", 1, 1, 1, 0, 1, 1, 0, 1)]
    for names in ("", "ABCDEFGH"):
        with pytest.raises(ValueError):
            interaction.audit(masked, names)
