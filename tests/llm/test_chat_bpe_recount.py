"""Operators 7, 6 and 10: round trips, the tiktoken library, full recounts."""

import base64
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lorry.llm import bpe, chat, recount
from lorry.llm.q_bpe import vocabulary
from lorry.llm.q_chat import PROBE

ALPHABET = list("ab  \n\t'sdtrevml019_.,!é漢🙂  ²\u0085\x1c|#İß")


@pytest.fixture(scope="module")
def vocab():
    return vocabulary()


@pytest.fixture(scope="module")
def reference(vocab):
    import tiktoken

    return tiktoken.Encoding("own", pat_str=vocab[1], mergeable_ranks=vocab[0], special_tokens={}).encode_ordinary


def _texts(n, size, seed):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(ALPHABET) for _ in range(rnd.randint(0, size))) for _ in range(n)]


# --- chat ---------------------------------------------------------------------

def test_chat_reads_back_every_turn(spark):
    rnd = random.Random(3)
    parts = ["\\", "###", "</turn>", "</part>", "\n", " ", "a", "### assistant:\n", "\n</turn>\n", "\\n", "\n</part>\n", "é", ":"]
    rows = [(c, t, rnd.choice(["user", "assistant", "system", "a\\b\n:c", "x###", None]),
             None if rnd.random() < 0.1 else "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 9))))
            for c in range(60) for t in range(rnd.randint(1, 8))]
    rows += [(None, 0, "user", "no id"), (None, 1, "assistant", "still"), (90, 0, "user", PROBE), (90, 1, "assistant", PROBE),
             (91, None, "user", "no turn"), (92, 1, "user", "tie b"), (92, 1, "user", "tie a"), (92, 1, "user", "tie a"),
             (93, 0, "assistant", "long " * 20000)]
    df = spark.createDataFrame([(*r, "extra", 1) for r in rows], "conv_id long, turn long, role string, text string, formatted string, ts int")
    formatted = chat.format_conversations(df)
    got = {r.conv_id: r for r in chat.parse(formatted).collect()}
    want = {}
    for c, t, role, text in rows:
        want.setdefault(c, []).append((t is not None, t or 0, role or "", text or ""))
    assert set(got) == set(want)
    for c, turns in want.items():
        turns.sort()
        assert [(t.role, t.text) for t in got[c].turns] == [x[2:] for x in turns]
        assert list(got[c].loss_texts) == [x[3] for x in turns if x[2] == "assistant"]
        assert [got[c].formatted[s.start:s.stop] for s in got[c].loss_spans] == [
            f for f in (_escaped(x[3]) for x in turns if x[2] == "assistant")]


def _escaped(text):
    import re

    return re.sub(r"(\\|###|</turn>|</part>)", r"\\\1", text)


def test_chat_merges_adjacent_turns_and_takes_empty_tables(spark):
    df = spark.createDataFrame([(1, 0, "user", "a"), (1, 1, "user", "b"), (1, 2, "assistant", "c")], "conv_id long, turn long, role string, text string")
    assert chat.format_conversations(df).first().formatted == "### user:\na\n</part>\nb\n</turn>\n### assistant:\nc\n</turn>\n"
    assert chat.parse(chat.format_conversations(df.limit(0))).count() == 0


def test_chat_runs_no_python(spark):
    from lorry.llm.q_chat import op7_chat_formatting

    plan = op7_chat_formatting(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


# --- byte-level BPE -----------------------------------------------------------

def test_bpe_equals_tiktoken(vocab, reference):
    encoder, decoder = bpe.Encoder(*vocab), bpe.Decoder(vocab[0])
    for t in [*_texts(2000, 30, 1), "a" * 5000, "é" * 3000, " " * 999 + "x", "the" * 3000, "!" * 3001, "ab" * 4000, "a b" * 2000]:
        ids = encoder.encode(t)
        assert np.frombuffer(ids, "<u4").tolist() == reference(t), t[:50]
        assert decoder.decode(ids) == t.encode()


def test_rank_queue_against_plain_merging():
    """Any ranks, also those under which a merge makes a pair of a lower rank."""
    rnd = random.Random(4)
    for _ in range(300):
        tokens = {bytes([x]) for x in b"abc"}
        while len(tokens) < 14:
            a, b = rnd.choice(sorted(tokens)), rnd.choice(sorted(tokens))
            if len(a + b) < 6:
                tokens.add(a + b)
        order = sorted(tokens)
        rnd.shuffle(order)
        ranks = {t: i for i, t in enumerate(order)}
        queue = bpe.RankQueue(len(ranks))
        for _ in range(20):
            piece = bytes(rnd.choice(b"abc") for _ in range(rnd.randint(1, 14)))
            parts = [piece] if piece in ranks else [bytes([x]) for x in piece]
            while len(parts) > 1:
                r, i = min((ranks.get(parts[i] + parts[i + 1], 99), i) for i in range(len(parts) - 1))
                if r == 99:
                    break
                parts[i:i + 2] = [parts[i] + parts[i + 1]]
            assert bpe.merge_piece(piece, ranks, queue) == [ranks[p] for p in parts]
            assert not queue.buckets and not any(queue.words)


def test_bpe_cache_generations(vocab, reference, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_ENTRIES", 7)
    encoder = bpe.Encoder(*vocab)
    for t in _texts(200, 40, 9) * 2:
        assert np.frombuffer(encoder.encode(t), "<u4").tolist() == reference(t)
    assert len(encoder.kept) <= 7 and len(encoder.older) <= 7


def test_bpe_of_another_pattern(vocab, reference):
    import tiktoken

    from lorry.llm.bpe import SPACE_PATTERN

    ranks, own = vocab
    assert own == SPACE_PATTERN  # so the registered query takes the fast path
    pattern = r"[^\n]+|\n"  # matches over spaces
    whole = tiktoken.Encoding("lines", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    encoder = bpe.Encoder(ranks, pattern)
    texts = [*_texts(100, 60, 21), "two words here", " a b\n c d ", "one  two"]
    assert [np.frombuffer(encoder.encode(t), "<u4").tolist() for t in texts] == [whole(t) for t in texts]


def test_bpe_rows(documents, vocab, reference):
    rows = [(1, "Hello <|endoftext|> world"), (2, None), (3, ""), (None, "no id"), (1, "Hello <|endoftext|> world"), (4, "w" * 300000)]
    df = documents(rows)
    got = bpe.encode(df, *vocab, decoded=True).collect()
    assert sorted((r.doc_id or -1, r.n_tokens, bytes(r.decoded)) for r in got) == sorted(
        (i or -1, len(reference(t or "")), (t or "").encode()) for i, t in rows)
    back = bpe.decode(bpe.encode(df, *vocab), vocab[0]).collect()
    assert sorted(bytes(r.decoded) for r in back) == sorted((t or "").encode() for _, t in rows)
    assert bpe.encode(df.limit(0), *vocab).count() == 0


def test_vocabulary_file(tmp_path):
    (tmp_path / "v").write_bytes(b"".join(base64.b64encode(t) + b" %d\n" % i for i, t in enumerate((b"a", b"b", b"ab"))))
    assert bpe.load_ranks(str(tmp_path / "v")) == {b"a": 0, b"b": 1, b"ab": 2}


# --- edit-aware counts --------------------------------------------------------

@pytest.mark.parametrize("leaf", [3, 32])
def test_edits_equal_a_full_recount(vocab, reference, monkeypatch, leaf):
    monkeypatch.setattr(recount, "LEAF", leaf)
    counter, rnd, recoded, whole = recount.Counter(*vocab), random.Random(leaf), 0, 0
    for text in _texts(300, 400, 11) + _texts(100, 6, 12):
        tree = recount.Tree(*counter.leaves(text))
        for _ in range(4):
            start = rnd.randint(-2, len(text) + 2)
            stop = start + rnd.choice([0, 1, 3, 60, -2])
            new = "".join(rnd.choice(ALPHABET) for _ in range(rnd.choice([0, 1, 2, 9, 70])))
            a = min(max(start, 0), len(text))
            want = text[:a] + new + text[min(max(stop, a), len(text)):]
            text, tree, n = recount.edit(text, tree, counter, start, stop, new)
            assert text == want and tree.tokens == len(reference(text)) and tree.leaves()[0].sum() == len(text)
            recoded, whole = recoded + n, whole + len(counter.find(text))
    assert recoded < whole


def test_only_the_surroundings_are_encoded_again(vocab):
    counter = recount.Counter(*vocab)
    text = "some words of a text " * 5000
    for place in (0, 50000, len(text) - 3):
        tree = recount.Tree(*counter.leaves(text))
        assert recount.edit(text, tree, counter, place, place + 2, "xyz")[2] < 4 * recount.LEAF


def test_kept_trees_and_tables_of_edits(spark, documents, vocab, reference):
    rows = [(1, "one two three"), (2, None), (3, ""), (None, "no id"), (4, "unedited"), (5, "long text " * 3000)]
    docs = documents(rows)
    edits = spark.createDataFrame([(1, 2, 0, 3, "ONE"), (1, 1, 3, 3, "!!"), (2, 1, 0, 9, "new"), (3, 1, None, None, None), (5, 1, 100, 20000, "cut"),
                                   (77, 1, 0, 0, "nobody")], "doc_id long, edit_no int, start int, stop int, text string")
    trees = recount.build(docs, *vocab)
    got = {r.doc_id: r for r in recount.apply_edits(recount.attach(trees, edits), *vocab).collect()}
    want = {1: "ONE!! two three", 2: "new", 3: "", None: "no id", 4: "unedited", 5: ("long text " * 3000)[:100] + "cut" + ("long text " * 3000)[20000:]}
    assert {i: r.text for i, r in got.items()} == want
    for i, t in dict(rows).items():
        assert (got[i].n_tokens_before, got[i].n_tokens) == (len(reference(t or "")), len(reference(want[i])))
        assert sum(got[i].leaf_tokens) == got[i].n_tokens and sum(got[i].leaf_chars) == len(want[i])
    once = recount.count_edits(docs.withColumn("edits", F.lit(None).cast(recount.EDITS)), *vocab)
    assert all(r.n_tokens == r.n_tokens_before and r.n_recoded == 0 for r in once.collect())
    assert recount.count_edits(docs.limit(0).withColumn("edits", F.lit(None).cast(recount.EDITS)), *vocab).count() == 0


def test_query_against_full_encoding(spark, sf_dir, reference):
    from lorry.llm.q_recount import edits_of, op10_edit_counts

    got = {r.doc_id: r for r in op10_edit_counts(spark, sf_dir).collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", edits_of(F.col("doc_id"), F.col("text")).alias("e")).collect()
    assert len(got) == len(docs)
    for d in docs:
        t = d.text
        for e in d.e:
            t = t[:e.start] + e.text + t[max(e.start, e.stop):]
        assert (got[d.doc_id].n_tokens_before, got[d.doc_id].n_tokens) == (len(reference(d.text)), len(reference(t)))
