import json
import re

import pytest

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def lower(b: bytes) -> bytes:
    return bytes(c + 32 if 65 <= c <= 90 else c for c in b)


def shingle_set(text, k=5):
    w = WORD.findall(lower((text or "").encode()))
    if not w:
        return set()
    return {tuple(w)} if len(w) < k else {tuple(w[i:i + k]) for i in range(len(w) - k + 1)}


@pytest.fixture
def documents(spark):
    """Rows ``(doc_id, text)`` as a table with the columns of ``documents`` and
    further columns whose names operators use themselves."""

    def make(rows):
        schema = ("doc_id long, text string, lang string, source string, n_chars long, score double, key long, ids string, "
                  "spans string, n_entities long, n string, edits_ string")
        data = [(i, t, None, None, None if t is None else len(t), None, 1, "x", "y", 3, "z", json.dumps(t)) for i, t in rows]
        return spark.createDataFrame(data, schema)

    return make
