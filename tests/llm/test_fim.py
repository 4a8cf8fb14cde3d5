"""Operator 13 against a plain version, and exact round trips through the frames."""

import hashlib
import random
import re

import pytest
import zstandard

from lorry.llm import fim


def units(text):
    return re.findall(r"[^\n]*\n|[^\n]+", text)


def brute(doc_id, text, percent=100):
    text = text or ""
    h = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[k:k + 8], 16) for k in (0, 8, 16, 24))
    u = units(text)
    lo, hi = sorted((h1 % (len(u) + 1), h2 % (len(u) + 1)))
    a, m, z = "".join(u[:lo]), "".join(u[lo:hi]), "".join(u[hi:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= percent:
        return len(u), "plain", None, None, text
    if h4 % 100 < 50:
        return len(u), "spm", len(a), len(m), f"<S>{z}<P>{a}<M>{m}"
    return len(u), "psm", len(a), len(m), f"<P>{a}<S>{z}<M>{m}"


def _texts():
    rnd = random.Random(5)
    fixed = ["", None, "\n", "\n\n\n", "one line", "one line\n", "a\nb", "é\nß\n漢字\n😀", "<P>", "x<S>y", "<M", "<P\n>\n<\nS", "<<\n<P\n<S\n", "\r\n\r\n"]
    drawn = ["".join(rnd.choice("ab é😀<P>S\n\n") for _ in range(rnd.randint(1, 300))) for _ in range(120)]
    return fixed + drawn + ["line of a long text\n" * 20_000, "no line end " * 20_000, "x\n" + "é" * 70_000 + "\ny"]


def _docs(spark, rows):
    return spark.createDataFrame([(i, t, 1, "x", [2], "f") for i, t in rows], "doc_id long, text string, n int, frames string, first array<int>, form string")


@pytest.mark.parametrize("frame_bytes", [7, 64, 1 << 15])
def test_transform_and_way_back(spark, frame_bytes):
    texts = _texts() if frame_bytes > 7 else _texts()[:-3]
    rows = [*enumerate(texts), (None, "a null\nid\n"), (3, "a\nrepeated\nid"), (3, "a\nrepeated\nid")]
    chosen = fim.choose(fim.store(_docs(spark, rows), frame_bytes=frame_bytes))
    made = fim.transform(chosen)
    want = sorted((str(i), *map(str, brute(i, t))) for i, t in rows)
    assert sorted((str(r.doc_id), str(r.n), r.form, str(r.prefix_chars), str(r.middle_chars), r.text) for r in fim.texts(made).collect()) == want
    # the list of frames is one valid zstandard stream
    for r in made.collect():
        whole = zstandard.ZstdDecompressor().decompressobj(read_across_frames=True).decompress(b"".join(r.output)) if r.output else b""
        assert whole == b"".join(fim.stream(r.output))
    assert {r.form for r in made.collect()} == {"plain", "psm", "spm"}
    digest = {(r.doc_id, r.n, r.output_sha256, r.restored_sha256) for r in fim.digests(made).collect()}
    for i, t in rows:
        n, _, _, _, out = brute(i, t)
        assert (i, n, hashlib.sha256(out.encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()) in digest


def test_share_of_transformed_texts(spark):
    rows = [(i, f"first {i}\nsecond\nthird\n") for i in range(400)]
    made = fim.texts(fim.transform(fim.choose(fim.store(_docs(spark, rows)), percent=30))).collect()
    assert {(r.doc_id, r.form, r.text) for r in made} == {(i, *(brute(i, t, percent=30)[k] for k in (1, 4))) for i, t in rows}
    assert 0.2 < sum(r.form != "plain" for r in made) / 400 < 0.4


def test_empty_table_and_too_small_frames(spark):
    assert fim.digests(fim.transform(fim.choose(fim.store(_docs(spark, []))))).collect() == []
    with pytest.raises(ValueError):
        fim.store(_docs(spark, []), frame_bytes=3)


def test_only_cut_frames_are_decompressed(monkeypatch):
    """A text of many frames: a cut reads the one frame that holds it."""
    import numpy as np

    text = b"".join(b"line %d\n" % k for k in range(50_000))
    raw = np.frombuffer(text, np.uint8)
    frames, ends, chars = fim.frames_of(raw, zstandard.ZstdCompressor(), 1 << 12)
    assert ends == 50_000 and chars == len(text) and len(frames) > 100
    real, read = zstandard.ZstdDecompressor(), []

    class Counting:
        def decompress(self, data):
            read.append(data)
            return real.decompress(data)

    pack = zstandard.ZstdCompressor()
    c = fim.Cuts(frames, len(text), chars, Counting())
    x, y = c.find(10_000), c.find(40_000)
    parts = [c.between((0, 0, 0), x, pack), c.between(x, y, pack), c.between(y, (len(frames), 0, 0), pack)]
    lines = text.splitlines(keepends=True)
    assert [b"".join(fim.stream(p)) for p in parts] == [b"".join(lines[a:b]) for a, b in ((0, 10_000), (10_000, 40_000), (40_000, None))]
    assert len(set(read)) <= 2
    whole = [f["data"] for f in frames]
    assert b"".join(fim.stream(whole, 5_000, 5_010)) == text[5_000:5_010]
