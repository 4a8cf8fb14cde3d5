"""T4: item numbers given once: one numbering for a page pair, late batches and late rows."""

import random
import uuid

import pytest
from pyspark.sql import functions as F

from lorry.operators import item_store
from lorry.operators.item_store import ItemNumbers
from lorry.operators.numbering import number_items
from lorry.plans import ap, ar
from lorry.session import ensure_checkpoint_dir
from lorry.sources.tables import Tables


def order():
    return [F.col("name").asc_nulls_last(), F.col("id")]



@pytest.fixture
def store(spark):
    return ItemNumbers(spark, f"{ensure_checkpoint_dir(spark).rstrip('/')}/items-{uuid.uuid4().hex}")


@pytest.fixture
def numberings(monkeypatch):
    """How often rows were numbered."""
    calls, real = [], item_store.number_items
    monkeypatch.setattr(item_store, "number_items", lambda *a, **k: calls.append(a[0].count()) or real(*a, **k))
    return calls


def _rows(seed, batches, n=200):
    rnd = random.Random(seed)
    return [(rnd.choice(batches), k + 1000 * seed, rnd.choice(["a", "b", "c", None])) for k in range(n)]


def _frame(spark, rows):
    return spark.createDataFrame(rows, "batch int, id long, name string")


def _items(df):
    return {(r.batch, r.id): r.cntitem for r in df.collect()}


def test_numbers_are_those_of_one_numbering_and_stay(spark, store, numberings):
    rows = _rows(1, [1, 2, None])
    df = _frame(spark, rows)
    first = _items(store.assign(df, ["batch"], "id", order(), ["name"]))
    assert first == _items(number_items(df, ["batch"], order())) and len(first) == 200
    files = set(store.stored().inputFiles())
    # again, in part, and with another order of rows: no numbering, no file
    assert _items(store.assign(_frame(spark, rows[::-1][:70]), ["batch"], "id", order(), ["name"])) == {k: first[k] for k in ((r[0], r[1]) for r in rows[::-1][:70])}
    assert numberings == [200] and set(store.stored().inputFiles()) == files
    # a late batch adds rows only
    late = _rows(2, [7], 50)
    got = _items(store.assign(_frame(spark, rows + late), ["batch"], "id", order(), ["name"]))
    assert {k: v for k, v in got.items() if k in first} == first
    assert {k: v for k, v in got.items() if k[0] == 7} == _items(number_items(_frame(spark, late), ["batch"], order()))
    assert numberings == [200, 50] and set(store.stored().inputFiles()) > files
    # late rows of numbered batches follow behind
    more = [(1, 5001, "a"), (1, 5000, "a"), (None, 5002, None), (9, 5003, "z")]
    got = _items(store.assign(_frame(spark, more), ["batch"], "id", order(), ["name"]))
    top = {b: max(v for k, v in first.items() if k[0] == b) for b in (1, None)}
    assert got == {(1, 5000): top[1] + 1, (1, 5001): top[1] + 2, (None, 5002): top[None] + 1, (9, 5003): 1}


def test_no_rows(spark, store, numberings):
    assert store.assign(_frame(spark, []), ["batch"], "id", order(), ["name"]).collect() == []
    assert store.stored() is None and numberings == []


@pytest.mark.parametrize("header, detail", [(ar.ar_header, ar.ar_detail), (ap.ap_register_header, ap.ap_register_detail), (ap.ap_v1_header, ap.ap_v1_detail)])
def test_a_page_pair_is_numbered_once(spark, sf_dir, store, numberings, header, detail):
    t = Tables.at(spark, sf_dir)
    given = {} if header is not ap.ap_v1_header else {"as_of": "2025-05-01"}
    for page in (header, detail):
        stored = sorted(map(str, page(t, **given, numbers=store).collect()))
        assert stored == sorted(map(str, page(t, **given).collect())) != []
    assert len(numberings) == 1
