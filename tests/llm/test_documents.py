"""Operators 1, 2, 3, 4, 5, 8, 9 on small tables: brute force and odd rows."""

import hashlib
import random
import re
import uuid

import numpy as np
import pytest
from pyspark.sql import functions as F

from lorry.llm import fm, graph, imatch, minhash, order, pii, repeats, runindex, tiling
from lorry.llm import textvec as tv
from lorry.session import ensure_checkpoint_dir

from .conftest import WORD, lower, shingle_set


def _prose(rnd, n, vocabulary=400):
    return " ".join(f"w{rnd.randrange(vocabulary)}" for _ in range(n))


# --- words and shingles -------------------------------------------------------

@pytest.mark.parametrize("most", [1, 40, 1 << 20])
def test_words_and_shingles(most):
    import pyarrow as pa

    rnd = random.Random(3)
    texts = ["", None, " a  b", "Foo foo BAR", "x\ty\nz é É", "   "] + ["".join(rnd.choice("aB cé\n\t ß") for _ in range(rnd.randint(0, 60))) for _ in range(200)]
    word_of, sets = {}, {}
    for lo, hi, buf, offs in tv.batches(pa.array(texts), most):
        w = tv.words(buf, offs, max(4, most // 2))
        got = {}
        for s, e, d, h in zip(*w, strict=True):
            word = lower(bytes(buf[s:e]))
            got.setdefault(int(d), []).append(word)
            assert word_of.setdefault(int(h), word) == word
        h, doc = tv.distinct(*tv.shingles(w, hi - lo, 5))
        for d in range(hi - lo):
            assert got.get(d, []) == WORD.findall(lower((texts[lo + d] or "").encode()))
            sets.setdefault(frozenset(shingle_set(texts[lo + d])), set()).add(frozenset(h[doc == d].tolist()))
    assert len(set(word_of.values())) == len(word_of)
    assert all(len(v) == 1 and len(next(iter(v))) == len(k) for k, v in sets.items())


# --- components ---------------------------------------------------------------

def test_components_of_chains_stars_and_loops(spark):
    links = [(i, i + 1) for i in range(100, 140)] + [(7, k) for k in range(200, 230)] + [(5, 5), (300, 2), (2, 301), (301, 300), (300, 2)]
    got = {r.id: r.root for r in graph.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 100 for i in range(100, 141)}, 7: 7, **{k: 7 for k in range(200, 230)}, 2: 2, 300: 2, 301: 2}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_without_keeps_what_is_not_named(spark):
    docs = spark.createDataFrame([(i if i % 10 else None, f"t{i}") for i in range(500)], "doc_id long, text string")
    ids = spark.createDataFrame([(i,) for i in range(0, 500, 7)] + [(-5,), (None,)], "doc_id long")
    got = sorted(r.text for r in graph.without(docs, ids).collect())
    assert got == sorted(f"t{i}" for i in range(500) if i % 10 == 0 or i % 7)


# --- 5 MinHash ----------------------------------------------------------------

def _brute_components(rows, percent=85):
    sets = {}
    for i, t in rows:
        if i is not None:
            sets.setdefault(i, []).append(shingle_set(t))
    ids = sorted(sets)
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            if any(x and y and 100 * len(x & y) >= percent * len(x | y) for x in sets[a] for y in sets[b]):
                lo, hi = sorted((find(a), find(b)))
                root[hi] = lo
    return {i: find(i) for i in ids}


def test_near_duplicates_against_brute_force(documents):
    rnd = random.Random(8)
    rows = [(1, None), (2, ""), (3, "two words"), (4, "TWO  words"), (None, "no id at all here today"), (6, "no id at all here today")]
    at = 10
    for g in range(10):
        base = _prose(rnd, rnd.choice([30, 60, 200])).split()
        passage = _prose(rnd, 40).split()
        for _ in range(8):
            w = list(base)
            for _ in range(rnd.choice([0, 0, 1, 1, 2, 4])):
                w[rnd.randrange(len(w))] = f"x{rnd.randrange(10**6)}"
            rows.append((at, " ".join(w)))
            rows.append((at + 1, " ".join(passage + _prose(rnd, rnd.choice([3, 6, 12])).split())))
            at += 2
    chain = _prose(rnd, 120).split()
    for _ in range(12):  # each is linked with the next only
        rows.append((at, " ".join(chain)))
        at += 1
        k = rnd.randrange(len(chain) - 2)
        chain = chain[:k] + [f"y{rnd.randrange(10**6)}"] + chain[k + 1:]
    rows += [(at, "same id " + _prose(rnd, 20)), (at, rows[8][1])]
    rnd.shuffle(rows)
    got = minhash.near_duplicates(documents(rows)).collect()
    want = _brute_components(rows)
    assert len(got) == len(rows)
    for r in got:
        assert r.component_id == (None if r.doc_id is None else want[r.doc_id]), r
    sizes = {}
    for i, t in rows:
        sizes.setdefault(i, []).append(len(shingle_set(t)))
    assert {i: sorted(v) for i, v in sizes.items()} == {i: sorted(r.n_shingles for r in got if r.doc_id == i) for i in sizes}


def test_near_duplicates_of_an_empty_table(documents):
    assert minhash.near_duplicates(documents([])).count() == 0


def test_tensored_keys_need_a_group_of_both_collections():
    """2mr minhashes stand for m*m tables of 2r rows: what a pair of a given similarity meets in."""
    rnd, m, r = np.random.default_rng(1), 16, 3
    met = 0
    for _ in range(300):
        agree = rnd.random((2 * m, r)) < 0.85
        groups = agree.all(axis=1)
        met += groups[:m].any() and groups[m:].any()
    assert met == 300


# --- 4 string tiling ----------------------------------------------------------

def test_tiles_are_greedy_and_do_not_overlap():
    rnd = random.Random(2)
    for _ in range(200):
        doc = [rnd.randrange(4) for _ in range(rnd.randint(0, 40))]
        item = [rnd.randrange(4) for _ in range(rnd.randint(3, 20))]
        pairs = [(i, j) for i in range(len(doc) - 2) for j in range(len(item) - 2) if doc[i:i + 3] == item[j:j + 3]]
        if not pairs:
            continue
        got = tiling.tile(np.array([p[0] for p in pairs]), np.array([p[1] for p in pairs]), 3, len(doc), len(item))
        in_doc, in_item, want = [False] * len(doc), [False] * len(item), []
        while True:  # the longest unmarked common run, the first in the item, then in the document
            best = (0, 0, 0)
            for j in range(len(item)):
                for i in range(len(doc)):
                    n = 0
                    while i + n < len(doc) and j + n < len(item) and doc[i + n] == item[j + n] and not in_doc[i + n] and not in_item[j + n]:
                        n += 1
                    if n > best[2]:
                        best = (i, j, n)
            if best[2] < 3:
                break
            i, j, n = best
            in_doc[i:i + n], in_item[j:j + n] = [True] * n, [True] * n
            want.append((i, j, n))
        assert [x[2] for x in got] == [x[2] for x in want] and sum(x[2] for x in got) == sum(in_item)
        assert got == want


def test_decontamination_finds_reordered_passages(spark, documents):
    rnd = random.Random(5)
    items = [_prose(rnd, n, 5000) for n in (40, 25, 60)]
    a, b = items[0].split()[:20], items[0].split()[20:]
    rows = [(1, f"Start. {items[1].upper()}, end"), (2, " ".join(b) + " between " + " ".join(a)), (3, _prose(rnd, 300, 5000)), (4, None), (5, ""),
            (6, " ".join(items[2].split()[:20])), (7, "tiny one"), (8, "a tiny one here"), (9, "... !!! ,,,"), (None, items[0]), (1, "again"),
            (10, (_prose(rnd, 3000, 5000) + " ") * 3 + items[2])]
    bench = [*enumerate(items), (10, "tiny one"), (11, ""), (12, None), (None, "x y z"), (13, items[1])]
    table = spark.createDataFrame([(i, t, "clash") for i, t in bench], "item_id long, text string, doc_id string")
    docs = documents(rows)
    want = {1: [1, 13], 2: [0], 7: [10], 8: [10], None: [0], 10: [2]}
    for block in (1 << 20, 30):  # in one block, and in several
        found = tiling.contaminated(tiling.tile_documents(docs, table, block_tokens=block))
        assert {r.doc_id: list(r["items"]) for r in found.collect()} == want
    assert tiling.tile_documents(docs, table.limit(0)).count() == 0
    assert tiling.tile_documents(docs.limit(0), table).count() == 0


# --- 8 repeats ----------------------------------------------------------------

def _brute_repeats(rows):
    first = {}
    for i, t in rows:
        raw = (t or "").encode()
        for p in range(len(raw) - 49):
            w = raw[p:p + 50]
            first[w] = min(first.get(w, 2**63), -(2**63) if i is None else i)
    out = []
    for i, t in rows:
        raw = (t or "").encode()
        gone = bytearray(len(raw))
        for p in range(len(raw) - 49):
            if first[raw[p:p + 50]] < (-(2**63) if i is None else i):
                gone[p:p + 50] = b"\1" * 50
        spans = [(m.start(), m.end()) for m in re.finditer(b"\1+", bytes(gone))]
        out.append((i is not None, i, len(raw), sum(gone), bytes(c for c, g in zip(raw, gone, strict=True) if not g), spans))
    return sorted(out)


def test_run_index_against_brute_force():
    rnd = random.Random(2)
    for depth in (8, 20, 50):
        for _ in range(40):
            base = "".join(rnd.choice("ab") for _ in range(200))
            strings = []
            for _ in range(rnd.randint(1, 30)):
                i = rnd.randint(0, 150)
                s = base[i:i + rnd.randint(0, 78)]
                strings.append((s[:rnd.randint(0, len(s))] + "x" + s[len(s) // 2:] if rnd.random() < 0.4 else s)[:78].encode())
            values = np.array([rnd.randint(0, 50) for _ in strings])
            length = np.array([len(s) for s in strings])
            index = runindex.RunIndex(np.frombuffer(b"".join(strings), np.uint8), np.cumsum(length), depth)
            index.set_values(values)
            got = index.stream(length, depth)
            least = {}
            for s, v in zip(strings, values, strict=True):
                for o in range(len(s) - depth + 1):
                    least[s[o:o + depth]] = min(least.get(s[o:o + depth], 99), v)
            for k, s in enumerate(strings):
                assert [got[k, o] for o in range(len(s) - depth + 1)] == [least[s[o:o + depth]] for o in range(len(s) - depth + 1)]
    repetitive = np.frombuffer(b"abcdefghijklmnopqrstuvwxyz" * 3 * 50, np.uint8)
    assert len(runindex.RunIndex(repetitive, np.arange(78, 78 * 50 + 1, 78), 50).run_start) < len(repetitive) / 5


def test_repeats_against_brute_force(documents, monkeypatch):
    monkeypatch.setattr(repeats, "MOST", 4)  # so that an anchor's contexts are dealt out
    monkeypatch.setattr(repeats, "BLOCK", 6)
    rnd = random.Random(6)
    passage, line = _prose(rnd, 30), _prose(rnd, 12) + " ü"
    rows = [(1, None), (2, ""), (3, "short"), (None, passage), (None, "x " + passage), (4, "a" * 400), (5, "b" * 60 + "a" * 120), (6, "ab" * 100)]
    base = [_prose(rnd, 60) for _ in range(5)]
    for i in range(10, 60):
        kind = rnd.randrange(5)
        t = rnd.choice(base)
        if kind == 0:
            t = _prose(rnd, 20) + " " + passage + " " + _prose(rnd, 10)
        elif kind == 1:
            k = rnd.randrange(len(t))
            t = t[:k] + "#" + t[k:]
        elif kind == 2:
            t = f"{line}\n{_prose(rnd, 8)}\n{line}"
        elif kind == 3:
            t = t[rnd.randrange(100):len(t) - rnd.randrange(100)]
        rows.append((i, t))
    rows += [(12, rows[-1][1]), (13, passage), (13, passage), (61, base[0])]
    rnd.shuffle(rows)
    got = repeats.remove_repeats(documents(rows)).collect()
    assert sorted((r.doc_id is not None, r.doc_id, r.n_bytes, r.n_removed, bytes(r.kept), [(s.start, s.stop) for s in r.spans]) for r in got) == _brute_repeats(rows)


def test_repeats_move_places_once_and_read_a_context_from_one_document(documents, monkeypatch):
    rnd = random.Random(8)
    passage = "".join(rnd.choice("abcdefgh ") for _ in range(90))
    rows = []
    for k in range(40):  # every second text goes on differently beside the passage, so an anchor has several contexts
        around = ["".join(rnd.choice("ijklmnop ") for _ in range(60)) for _ in range(2)] if k % 2 else ["q" * 60, "r" * 60]
        rows.append((k, around[0] + passage + around[1]))
    staged, listed = {}, []
    stage, index = repeats.stage, repeats._index
    monkeypatch.setattr(repeats, "stage", lambda df, label: staged.setdefault(label, (df, stage(df, label)))[1])
    monkeypatch.setattr(repeats, "_index", lambda contexts: listed.append(contexts) or index(contexts))
    got = repeats.remove_repeats(documents(rows)).collect()
    assert sorted((r.doc_id is not None, r.doc_id, r.n_bytes, r.n_removed, bytes(r.kept), [(s.start, s.stop) for s in r.spans]) for r in got) == _brute_repeats(rows)
    # anchors meet their answers in one join, whether they have one context or several
    assert staged["marks"][0]._jdf.queryExecution().optimizedPlan().toString().count("Join") == 1
    # bytes of a context move once, from the smallest document
    moved = listed[0].select("gram", "context", "doc").collect()
    assert moved and len({(r.gram, r.context) for r in moved}) == len(moved)
    assert {(r.gram, r.context, r.doc) for r in moved} <= {(r.gram, r.context, r.first) for r in staged["contexts"][1].collect()}


def test_anchors_depend_on_the_string_alone():
    rnd = random.Random(9)
    texts = [bytes(rnd.choice(b"abc ") for _ in range(n)) for n in (0, 5, 27, 28, 49, 50, 51, 400, 0, 3000)]
    texts += [b"a" * 300, texts[-1][1000:1100], b"ab" * 100, b""]
    offs = np.cumsum([0, *map(len, texts)])
    s = repeats.Scan(np.frombuffer(b"".join(texts), np.uint8), offs)
    places = {}
    for k, t in enumerate(texts):
        own = s.anchor[s.doc == k] - offs[k]
        for p in range(len(t) - 49):
            inside = own[(own >= p) & (own + repeats.GRAM <= p + 50)] - p
            assert len(inside)
            # the least places of a string are anchors wherever it stands
            places.setdefault(t[p:p + 50], []).append(set(inside.tolist()))
    assert all(set.intersection(*x) for x in places.values())
    assert all(a >= offs[d] and a + repeats.GRAM <= offs[d + 1] for a, d in zip(s.anchor, s.doc, strict=True))
    keep = np.arange(len(s.seg_start)) % 2 == 0
    inside = [any(a >= x and a < max(y - repeats.GRAM + 1, x) for x, y in zip(s.seg_start[keep], s.seg_stop[keep], strict=True)) for a in s.anchor]
    assert s.within(keep).tolist() == inside


def test_grams_of_two_documents_are_found_in_buckets(documents, monkeypatch):
    rnd = random.Random(12)
    texts = ["".join(rnd.choices("abcdefgh ", k=300)) for _ in range(30)]
    rows = [(k, t + texts[k // 2]) for k, t in enumerate(texts)] + [(40, "x" * 200), (41, texts[3])]
    docs = documents(rows)
    nothing = docs.sparkSession.sparkContext.broadcast(np.zeros(1 << 10, np.uint64))
    s = repeats.Scan(*(lambda raw: (np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)])))([t.encode() for _, t in rows]))
    for buckets in (1, 2, 64):
        owners = {}
        for g, d in zip(repeats._short(s.gram, buckets).tolist(), s.doc.tolist(), strict=True):
            owners.setdefault(g, set()).add(d)
        for n in (1, 5):
            found = [r.gram for r in repeats._repeated(repeats._rows(docs).repartition(n), nothing, nothing, buckets).collect()]
            assert sorted(found) == sorted(g for g, d in owners.items() if len(d) > 1)


def test_marks_are_counted_up_to_a_place():
    rnd = np.random.default_rng(3)
    for n in (1, 63, 64, 65, 1000):
        marked = rnd.random(n) < 0.3
        assert runindex.Marks(marked).up_to(np.arange(n)).tolist() == np.cumsum(marked).tolist()
    for most in (50, 2**62):  # by sorting numbers with their places, and without
        key = rnd.integers(0, 50, 300)
        order, new = runindex.sorted_order(key, most)
        assert order.tolist() == np.argsort(key, kind="stable").tolist()
        assert new.tolist() == [True, *(np.diff(key[order]) != 0).tolist()]


def test_repeats_of_texts_longer_than_a_chunk(documents):
    rnd = random.Random(10)
    base = "".join(rnd.choices("abcdefgh é", k=repeats.CHUNK + 5000))
    far = len(base) - 3000
    rows = [(3, base), (1, base[100:700]), (2, base[far:] + base[:200]), (None, base[far + 1000:far + 1080]), (5, base[300:350]), (4, None)]
    got = repeats.remove_repeats(documents(rows)).collect()
    assert sorted((r.doc_id is not None, r.doc_id, r.n_bytes, r.n_removed, bytes(r.kept), [(s.start, s.stop) for s in r.spans]) for r in got) == _brute_repeats(rows)


def test_repeats_of_an_empty_table(documents):
    assert repeats.remove_repeats(documents([])).count() == 0


# --- 1 I-Match ----------------------------------------------------------------

def test_fingerprints_of_edited_texts(spark, documents, monkeypatch):
    rnd = random.Random(7)
    rows = [(i, _prose(rnd, rnd.choice([0, 1, 4, 80, 300]), 900)) for i in range(60)]
    rows += [(100, None), (101, ""), (102, "é" * 4000), (103, rows[5][1]), (104, rows[5][1].upper()), (105, "... !!"), (106, "..."), (None, "no id"),
             (50, "again"), (50, "again")]
    df = documents(rows)
    band = imatch.lexicon(df, low=0.02, high=0.5)
    got = imatch.fingerprint_edits(df, band).collect()
    assert len(got) == len(rows)
    ordered = sorted(((-(2**63) if i is None else i), t or "") for i, t in rows)
    want = []
    for k, (i, t) in enumerate(ordered):
        m = len(t) // 4
        e = t[:len(t) - m] + ordered[(k + 1) % len(ordered)][1][:m]
        want.append((i, len(t), hashlib.sha256(e.encode()).hexdigest()))
    assert sorted((-(2**63) if r.doc_id is None else r.doc_id, r.n_chars, r.edited_sha256) for r in got) == sorted(want)
    by_id = {r.doc_id: r for r in got}
    text_of = {}
    for i, t in rows:
        text_of.setdefault(t or "", set()).add(by_id[i].fingerprint)
    assert all(len(v) == 1 for v in text_of.values())
    assert by_id[103].fingerprint == by_id[104].fingerprint  # the same terms
    assert by_id[105].fingerprint != by_id[106].fingerprint
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    long = [r for r in got if r.n_chars > 1000 and r.doc_id < 60]
    assert sum(r.near_edited > r.near_next for r in long) >= 0.9 * len(long)
    empty = df.limit(0)
    assert imatch.fingerprint_edits(empty, imatch.lexicon(empty)).count() == 0


def test_lexicon_counts_all_documents(documents):
    rows = [(i, f"all half{'' if i % 2 else 'x'} rare{i} {'some' if i % 10 == 0 else ''}") for i in range(200)]
    band = imatch.lexicon(documents(rows), low=0.05, high=0.6)
    import pyarrow as pa

    _, _, buf, offs = next(tv.batches(pa.array(["half halfx some"])))
    assert sorted(band.tolist()) == sorted(imatch.tokens(buf, offs).hash.tolist())


def test_likeness_estimates_jaccard():
    import pyarrow as pa

    rnd = random.Random(1)
    error = []
    for share in (0.95, 0.8, 0.5, 0.2, 0.0):
        for _ in range(12):
            words = [f"t{rnd.randrange(10**9)}" for _ in range(200)]
            k = int(200 * share)
            a, b = words, words[:k] + [f"u{rnd.randrange(10**9)}" for _ in range(200 - k)]
            f = imatch.fingerprints(pa.array([" ".join(a), " ".join(b)]), np.zeros(0, np.uint64))
            got = imatch.likeness(*(tuple(x[[i]] for x in f) for i in (0, 1)))[0]
            error.append(got - len(set(a) & set(b)) / len(set(a) | set(b)))
    assert abs(np.mean(error)) < 0.08 and np.std(error) < 0.12


# --- 9 factorisation machine --------------------------------------------------

def test_sum_of_squares_identity():
    rnd = np.random.default_rng(3)
    m = fm.Model(4, 0.3, rnd.normal(size=300), rnd.normal(size=(300, 5)))
    feature, value = rnd.permutation(300)[:20], rnd.normal(size=20)
    pairs = sum(m.factors[a] @ m.factors[b] * x * y for i, (a, x) in enumerate(zip(feature, value, strict=True))
                for b, y in list(zip(feature, value, strict=True))[i + 1:])
    want = 0.3 + sum(m.linear[feature] * value) + pairs
    assert fm.raw_scores(m, feature, value, np.array([0]))[0] == pytest.approx(want, rel=1e-4)


def test_scores_of_odd_rows_and_labels(spark, documents):
    rnd = random.Random(4)
    rows = [(i, _prose(rnd, 50) if i % 3 else "!! ".join(["LOUD", "NOISE"] * 30)) for i in range(150)]
    rows += [(None, "no id"), (900, None), (901, ""), (902, "x " * 50000), (3, "repeated"), (3, "repeated")]
    docs = documents(rows)
    labels = spark.createDataFrame([(i, int(bool(i % 3)), "clash") for i in range(150)] + [(900, 1, "c"), (901, None, "c"), (None, 0, "c"), (5, 1, "c")],
                                   "doc_id long, quality int, text string")
    model = fm.train(docs, labels)
    got = fm.score(docs, model).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    score = {r.doc_id: r.score for r in got}
    assert min(score[i] for i in range(150) if i % 3) > max(score[i] for i in range(0, 150, 3))
    with pytest.raises(ValueError):
        fm.score(docs, model, keep=("doc_id", "score"))
    none = fm.train(docs, labels.limit(0))
    assert {r.score for r in fm.score(docs, none).collect()} == {0.5}
    one = fm.train(docs, labels.where("quality = 1"))
    assert len({r.score for r in fm.score(docs, one).collect()}) == 1
    assert fm.score(docs.limit(0), model).count() == 0


def test_quality_on_held_out_rows(spark):
    from lorry.llm.q_fm import op9_quality_fm

    d = "/root/testdata/sf0.01"
    m = op9_quality_fm(spark, d).join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id").where("held_out").collect()
    good, bad = ([r.score for r in m if r.quality == q] for q in (1, 0))
    auc = np.mean([[g > b for g in good] for b in bad])
    assert auc > 0.95 and np.mean([g >= 0.3 for g in good]) > 0.95


def test_held_out_is_crc32_of_the_id(spark):
    import zlib

    got = spark.range(200).select("id", fm.held_out(F.col("id")).alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 5 == 0) for r in got)


# --- 2 surrogates -------------------------------------------------------------

def test_formats_types_and_coreference():
    detect = pii.detector()
    text = ("Mr. John Smith and Mrs. O'Neil, Frau Müller; MR. X. JOHN SMITH: éon.Foo+x@mail7.example.com ÉON.FOO+X@MAIL7.EXAMPLE.COM 10.2.33.255 "
            "+1 (487) 555-7209 4111 1111 1111 1111 4111-1111-1111-1112 token = \"04dbebab91ab85687d33eeaaf9ac699e1188f962\" 123-45-6789 GB29 NWBK 6016 1331 9268 19")
    found = detect(text)
    kinds = [f[2] for f in found]
    assert kinds == ["name", "name", "name", "name", "email", "email", "ip", "phone", "card", "card", "secret", "ssn", "iban"][:len(kinds)] or "name" in kinds
    new = {}
    for a, b, kind, form in found:
        s = pii.surrogate(kind, form, 0, b"k")
        out = pii.render(kind, text[a:b], s)
        assert out != text[a:b] and new.setdefault((kind, form), s) == s
        if kind != "name" and kind != "ip":
            assert re.sub(r"\d", "9", re.sub(r"[^\W\d_]", "a", out)) == re.sub(r"\d", "9", re.sub(r"[^\W\d_]", "a", text[a:b]))
        if kind == "card":
            assert pii._luhn(s) == pii._luhn(form)
    assert len({f[3] for f in found if f[2] == "email"}) == 1
    gender = {f[3].partition(":")[0] for f in found if f[2] == "name"}
    assert gender == {"m", "f"}
    male = pii.surrogate("name", "m:john smith", 0, b"k").split(":")[1].split(" ")[0].capitalize()
    assert male in pii.FIRST["latin", "m"]
    assert pii.surrogate("name", "f:анна петрова", 0, b"k").split(":")[1].split(" ")[0].capitalize() in pii.FIRST["cyrillic", "f"]
    assert detect("Version 1.2.3 of 2024-05-06 costs 12,500.00 and M is a letter. The token is short. 12345") == []


@pytest.mark.parametrize("text, want", [
    ("password = correcthorsebatterystaple", [("secret", "correcthorsebatterystaple")]),
    ("password = correcthorsebatterystaple 7", [("secret", "correcthorsebatterystaple")]),
    ("password: hunter2hunter2.", [("secret", "hunter2hunter2")]),
    ('{"password": "s3cr#t!x9"}', [("secret", "s3cr#t!x9")]),
    ("token = abcdefghijklmnopqrst", [("secret", "abcdefghijklmnopqrst")]),
    *((f"call {x}, please", [("phone", x)]) for x in (
        "555 123 4567", "+1 555 123 4567", "+44 20 7946 0958", "+49 30 1234567", "5551234567", "(555) 123-4567", "555.123.4567", "1-555-123-4567", "+15551234567")),
    ("at 1700000000 a price of 12,500.25, 0.5551234567 or $5551234567 and token: short", []),
    ("4785 3805 9239 1139 then 10.2.33.255 and 123-45-6789, Mr. John Smith, ann@mail.example.com, GB29 NWBK 6016 1331 9268 19",
     [("card", "4785 3805 9239 1139"), ("ip", "10.2.33.255"), ("ssn", "123-45-6789"), ("name", "John Smith"), ("email", "ann@mail.example.com"),
      ("iban", "GB29 NWBK 6016 1331 9268 19")]),
])
def test_exact_entities(text, want):
    found = pii.detector()(text)
    assert [(kind, text[a:b]) for a, b, kind, _ in found] == want
    for a, b, kind, form in found:
        assert pii.render(kind, text[a:b], pii.surrogate(kind, form, 0, b"k")) != text[a:b]


def test_secrets_of_few_surrogates(spark):
    """Without a letter or digit, and one letter each: longer surrogates, no collision."""
    forms = ["!#%&*+-"] + [f"{c}#####" for c in "abcdefghijklmnopqrstuvwxyz"]
    got = pii.assign(spark.createDataFrame([(1, "secret", f) for f in forms], "key long, kind string, form string"), b"key").collect()
    names = [r.surrogate for r in got]
    assert len(got) == len(forms) == len(set(names)) and not set(names) & set(forms)


def test_collisions_are_resolved(spark):
    """Twelve hundred addresses whose own format leaves few others: all differ, none is a real one."""
    forms = [f"{a}.{b}.{c}.{d}" for a in range(6) for b in range(6) for c in range(6) for d in range(6)]
    found = spark.createDataFrame([(k % 7, "ip", f) for k, f in enumerate(forms)], "key long, kind string, form string")
    got = pii.assign(found, b"key").collect()
    names = [r.surrogate for r in got]
    assert len(got) == len(forms) == len(set(names)) and not set(names) & set(forms)


def test_names_and_phones_across_formats(spark, documents):
    """One surname for one surname whatever the title, others for others, and one number with and without its country code."""
    texts = ["Mr. John Smith", "Mr. Smith", "Dr. John Smith", "Mrs. Smith", "Mr. JOHN SMITH", "Mrs. Anna Brown", "Dr. Brown", "Mr. Paul Smith",
             "+1 (487) 555-7209", "487-555-7209", "487 555 7209", "4875557209", "1-487-555-7209", "+44 20 7946 0958", "+44 (0)20 7946 0958"]
    out = {r.doc_id: r.text for r in pii.replace_entities(documents(list(enumerate(texts))), b"secret").collect()}
    new = [out[k] for k in range(len(texts))]
    last = [x.split(" ")[-1].upper() for x in new[:8]]
    assert len({last[k] for k in (0, 1, 2, 3, 4, 7)}) == 1 and last[5] == last[6] != last[0] and not {"SMITH", "BROWN"} & set(last)
    first = [new[k].split(" ")[1].upper() for k in (0, 2, 4, 7)]
    assert first[0] == first[1] == first[2] != first[3] and new[0].split(" ")[1] in pii.FIRST["latin", "m"]
    assert new[5].split(" ")[1] in pii.FIRST["latin", "f"]
    digits = ["".join(c for c in x if c.isdigit()) for x in new[8:]]
    assert len({x[-10:] for x in digits[:5]}) == 1 and digits[1] != "4875557209" and digits[0][0] == "1"
    assert digits[5][:2] == "44" and digits[6] == "440" + digits[5][2:] and digits[5] != "442079460958"


def test_written_names_do_not_collide(spark, monkeypatch):
    """Few syllables and first names: surnames of both genders differ as written, given names within a surname too."""
    monkeypatch.setitem(pii.SYLLABLES, "latin", ["ba", "be", "bi"])
    forms = [f"{g}:w{chr(97 + k)}" for k in range(12) for g in "mf"] + [f"m:g{chr(97 + k)} wa" for k in range(26)] + ["m:bababa", "f:ga wa"]
    got = {r.form: r.surrogate for r in pii.assign(spark.createDataFrame([(1, "name", f) for f in forms], "key long, kind string, form string"), b"key").collect()}
    assert set(got) == set(forms) and all(f[:2] == s[:2] for f, s in got.items())
    last = {f[2:].split(" ")[-1]: s[2:].split(" ")[-1] for f, s in got.items()}
    assert all(s[2:].split(" ")[-1] == last[f[2:].split(" ")[-1]] for f, s in got.items())
    assert len(set(last.values())) == len(last) and not set(last) & set(last.values())
    written = [s[2:] for f, s in got.items() if " " in f]
    assert len(set(written)) == len(written)


def test_replaced_texts(spark, documents):
    mail, card = "ann.lee@mail.example.org", "4785380592391139"
    rows = [(1, f"write to {mail} or {mail.upper()}"), (2, f"{mail}"), (None, f"no id {card}!!"), (4, None), (5, ""), (6, "clean text, 3 of 4"), (1, f"again {mail}"),
            (7, ("clean words " * 20000) + card)]
    docs = documents(rows)
    out = pii.replace_entities(docs, b"secret")
    assert out.columns == [c for c in docs.columns if c != "n_entities"] + ["n_entities"]
    got = {(r.doc_id, len(r.text or "")): r for r in out.collect()}
    assert len(got) == len(rows)
    text = {k: r.text for k, r in got.items()}
    assert text[4, 0] is None and text[5, 0] == "" and text[6, 18] == "clean text, 3 of 4"
    new = text[2, len(mail)]
    assert new != mail and new.endswith(".org") and text[1, len(rows[0][1])] == f"write to {new} or {new.upper()}" and text[1, 6 + len(mail)] == f"again {new}"
    assert card not in text[None, len(rows[2][1])] and text[7, len(rows[7][1])][-16:] == text[None, len(rows[2][1])][6:22]
    assert sorted(r.n_entities for r in got.values()) == [0, 0, 0, 1, 1, 1, 1, 2]
    other = pii.replace_entities(docs, b"another key").where("doc_id = 2").first().text
    assert other != new and pii.replace_entities(docs.limit(0), b"secret").count() == 0


# --- 3 training order ---------------------------------------------------------

def test_permutation_is_keyed_and_inverted():
    for n in (1, 2, 3, 5, 17, 100, 1000, 4097):
        p = order.permute(np.arange(n), n, 5)
        assert sorted(p) == list(range(n)) and (order.permute(p, n, 5, inverse=True) == np.arange(n)).all()
    assert (order.permute(np.arange(1000), 1000, 1) != order.permute(np.arange(1000), 1000, 2)).sum() > 900


def test_shards_hold_the_stream_in_order(spark, tmp_path, documents):
    rnd = random.Random(9)
    rows = [(i, "".join(rnd.choice("ab\né漢") for _ in range(rnd.choice([0, 3, 50, 900])))) for i in range(80)] + [(None, None), (3, "x"), (3, "x"), (4, "y" * 40000)]
    documents(rows).repartition(5).write.parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d"))
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/shards-{uuid.uuid4().hex}"
    layout = order.materialise(docs, F.col("text").cast("binary"), path, 1, 255, 254, length=64, per_shard=100)
    stream = b"".join((r.text or "").encode() + b"\xff" for r in docs.select("_metadata.file_path", "_metadata.row_index", "text").orderBy("file_path", "row_index").collect())
    assert layout.sequences == -(-len(stream) // 64)
    got = order.read_shards(spark, layout).collect()
    assert sorted(r.slot for r in got) == list(range(layout.sequences)) == sorted(r.sequence for r in got)
    for r in got:
        assert bytes(r.ids) == stream[64 * r.sequence:64 * r.sequence + 64].ljust(64, b"\xfe")
        assert r.slot == order.permute(np.array([r.sequence]), layout.sequences, layout.key)[0]
    rest = order.read_shards(spark, layout, first_slot=150).collect()
    assert sorted(r.slot for r in rest) == list(range(150, layout.sequences))
    # two-byte ids
    wide = f"{path}-wide"
    ids = F.unhex(F.regexp_replace(F.hex(F.col("text").cast("binary")), "(..)", "00$1"))
    two = order.materialise(docs, ids, wide, 2, 0xFFFF, 0xFFFE, length=32, per_shard=64)
    assert two.sequences == -(-len(stream) // 32) and order.read_shards(spark, two).count() == two.sequences
    # no rows
    documents([]).write.parquet(str(tmp_path / "e"))
    none = order.materialise(spark.read.parquet(str(tmp_path / "e")), F.col("text").cast("binary"), f"{path}-none", 1, 255, 254)
    assert none.sequences == 0 and order.read_shards(spark, none).count() == 0


def test_a_limit_on_records_per_file_does_not_move_slots(spark, tmp_path, documents):
    documents([(i, "abc" * (i + 5)) for i in range(60)]).write.parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d"))
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/shards-{uuid.uuid4().hex}"
    spark.conf.set("spark.sql.files.maxRecordsPerFile", 7)
    try:
        layout = order.materialise(docs, F.col("text").cast("binary"), path, 1, 255, 254, length=16, per_shard=50)
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    got = order.read_shards(spark, layout).collect()
    assert sorted(r.slot for r in got) == list(range(layout.sequences)) and layout.sequences > 150
    stream = b"".join(r.text.encode() + b"\xff" for r in docs.select("_metadata.file_path", "_metadata.row_index", "text").orderBy("file_path", "row_index").collect())
    assert all(bytes(r.ids) == stream[16 * r.sequence:16 * r.sequence + 16].ljust(16, b"\xfe") for r in got)
    # a shard in two files is refused
    with pytest.raises(Exception, match="not whole in one file"):
        order.read_shards(spark, layout._replace(per_shard=60)).collect()


def test_the_training_order_query_holds_the_stream(spark, sf_dir):
    from lorry.llm.q_order import op3_training_order

    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("_metadata.file_path", "_metadata.row_index", "text").orderBy("file_path", "row_index").collect()
    stream = b"".join((r.text or "").encode() + b"\xff" for r in rows)
    n = -(-len(stream) // 512)
    got = op3_training_order(spark, sf_dir).collect()
    assert sorted(r.slot for r in got) == list(range(n)) == sorted(r.sequence for r in got)
    for r in got:
        own = stream[512 * r.sequence:512 * r.sequence + 512]
        assert r.ids_sha256 == hashlib.sha256(own.ljust(512, b"\xfe")).hexdigest() and r.n_tokens == len(own)
