"""Report-layout pay files, read back."""

import csv
import datetime as dt
import decimal
import io
import random
import re
import uuid

import pytest

from lorry.session import ensure_checkpoint_dir
from lorry.sources.pay_export import HEADER, _ranges, export_pay_report, read_pay_export

D = decimal.Decimal
COLUMNS = ("pay_type string, driver string, pay_date date, subsistance decimal(18,2), hours decimal(18,2), "
           "overtime decimal(18,2), other decimal(18,2), net decimal(18,2)")

# A file in the export's layout; names, dates and amounts are invented.
SAMPLE = """,,,,,,,
driver ,pay date,subsistance,hours,overtime,other,Net,
CITY DRIVER,,,,,,,
Kim Placeholder,"Feb 3, 2021",12.00,40.00,1.50,"1,234.56","$1,246.56",
"Lee
Linebreak","Feb 3, 2021",0.00,0.00,0.00,75.25,$75.25,
LONG HAUL,,,,,,,
Max Muster,someday,0.00,0.00,0.00,10.00,-$10.00,
,"Mar 9, 2021",0.00,n/a,0.00,20.00,$20.00,
,,,,,,,
"""


def _path(spark):
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/test-pay-{uuid.uuid4().hex}"


def _key(row):
    return tuple((x is None, str(x)) for x in row)


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=_key)


def test_read_layout_file(spark, tmp_path):
    p = tmp_path / "pay.csv"
    p.write_text(SAMPLE)
    day = dt.date(2021, 2, 3)
    want = [
        ("CITY DRIVER", "Kim Placeholder", day, D("12.00"), D("40.00"), D("1.50"), D("1234.56"), D("1246.56")),
        ("CITY DRIVER", "Lee\nLinebreak", day, D("0.00"), D("0.00"), D("0.00"), D("75.25"), D("75.25")),
        ("LONG HAUL", "Max Muster", None, D("0.00"), D("0.00"), D("0.00"), D("10.00"), D("-10.00")),
        ("LONG HAUL", None, dt.date(2021, 3, 9), D("0.00"), None, D("0.00"), D("20.00"), D("20.00")),
    ]
    assert _rows(read_pay_export(spark, str(p))) == sorted(want, key=_key)


def test_round_trip_many_files(spark):
    rows = [("CITY DRIVER" if i % 3 else "LONG HAUL", f"Driver {i:04d}", dt.date(2021, 4, 1 + i % 20),
             D("1.50"), D("8.00"), D("0.00"), D(f"{1000 + i}.25"), D(f"{-5 if i % 7 == 0 else 1000 + i}.75"))
            for i in range(500)]
    path = _path(spark)
    export_pay_report(spark.createDataFrame(rows, COLUMNS), path, partitions=7)
    assert _rows(read_pay_export(spark, path)) == sorted(rows, key=_key)


def test_missing_sections_dates_amounts_and_line_breaks_round_trip(spark):
    day, z = dt.date(2021, 5, 6), D("0.00")
    rows = [
        ("A", "x", day, z, z, z, z, z), (None, "y", day, z, z, z, z, z), (None, "y2", None, z, z, z, z, z),
        ("(none)", "w", day, z, z, z, z, z), ("((none))", "w", day, z, z, z, z, z),
        ("A", "only a name", None, None, None, None, None, None), ("A", None, None, None, None, None, None, None),
        ("B", "two\nlines", day, z, z, z, z, D("-3.20")), ("B", 'quo"ted, comma', day, z, z, z, z, z),
        ("B", "driver", day, z, z, z, z, z),
    ]
    for partitions in (1, 4):
        path = _path(spark)
        export_pay_report(spark.createDataFrame(rows, COLUMNS), path, partitions=partitions)
        assert _rows(read_pay_export(spark, path)) == sorted(rows, key=_key)


def test_record_limit_does_not_split_a_section(spark):
    rows = [("A", f"d{i}", dt.date(2021, 1, 1), D("1.00"), D("0.00"), D("0.00"), D("0.00"), D("1.00")) for i in range(50)]
    spark.conf.set("spark.sql.files.maxRecordsPerFile", 10)
    try:
        path = _path(spark)
        export_pay_report(spark.createDataFrame(rows, COLUMNS), path, partitions=1)
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    assert _rows(read_pay_export(spark, path)) == sorted(rows, key=_key)


# --- byte ranges ---------------------------------------------------------------

def _plain(text):
    """The same reading by the csv module, in one go."""
    out, title = [], None
    blanks = " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85 "
    header = [(h or "").strip() for h in HEADER[:7]]
    for row in csv.reader(io.StringIO(text.removeprefix("﻿"), newline="")):
        cells = [c.strip(blanks) for c in row] + [""] * (8 - len(row))
        if not any(cells) or cells[:7] == header:
            continue
        if cells[0] and not any(cells[1:]):
            title = cells[0]
            continue

        def money(c):
            try:
                return D(c.replace("$", "").replace(",", "")).quantize(D("0.01"))
            except decimal.InvalidOperation:
                return None

        pay_type = None if title in (None, "(none)") else title[1:-1] if re.fullmatch(r"\(\(+none\)+\)", title) else title
        out.append((pay_type, cells[0] or None, cells[1] or None, *map(money, cells[2:7])))
    return sorted(out, key=_key)


def _read(spark, path, split):
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", 1)
    try:
        df = read_pay_export(spark, str(path))
        rows = _rows(df)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    # dates as the plain reader gives them
    return sorted(((r[0], r[1], f"{r[2]:%b} {r[2].day}, {r[2].year}" if r[2] else None, *r[3:]) for r in rows), key=_key)


def _wild(seed, n):
    """Records with quoted commas, doubled quotes and line breaks of both kinds, titles
    (some over two lines), blank and header rows, stray quotes inside fields."""
    rnd = random.Random(seed)

    def quoted(x):
        return '"' + x.replace('"', '""') + '"'

    out = []
    for k in range(n):
        kind = rnd.random()
        if kind < 0.08:
            t = rnd.choice(["CITY", "LONG HAUL", "(none)", "((none))", "two\nline title", 'a "quoted", title'])
            line = (quoted(t) if rnd.random() < 0.3 or not t.isalnum() and '"' in t or "\n" in t or "," in t else t) + "," * 7
        elif kind < 0.12:
            line = rnd.choice(["", ",,,,,,,", "driver ,pay date,subsistance,hours,overtime,other,Net,"])
        else:
            name = rnd.choice(["Kim", "Lee\nLine", "Lee\r\nLine", 'q"uote', 'a, b', "x\n\n\ny", '"', 'say ""', "\nstart", ' pad ', "é漢"])
            name = quoted(name) if any(c in name for c in '",\n') and name != 'q"uote' or rnd.random() < 0.2 else name
            line = ",".join([f"{name}" if rnd.random() < 0.9 else "", rnd.choice(['"Feb 3, 2021"', '"Mar 12, 2020"']), f"{k}.25",
                             quoted(f"{k * 1000 + 1000:,}.00"), "n/a", "0.00", rnd.choice(['"$1,246.56"', "-$3.20", '"9"']), ""])
        out.append(line + rnd.choice(["\n", "\r\n"]))
    text = "".join(out)
    return text[:-1] if rnd.random() < 0.5 and text.endswith("\n") and not text.endswith("\r\n") else text


@pytest.mark.parametrize("seed, split", [(1, 16), (2, 61), (3, 300), (4, 1 << 20), (5, 23)])
def test_ranges_equal_reading_in_one_go(spark, tmp_path, seed, split):
    text = _wild(seed, 120)
    p = tmp_path / "pay.csv"
    p.write_bytes(text.encode())
    assert _read(spark, p, split) == _plain(text)


def test_ranges_within_one_field_and_a_byte_order_mark(spark, tmp_path):
    long = "line of a field\n" * 40
    text = f'﻿TITLE,,,,,,,\n"{long}","Feb 3, 2021",1.00,2.00,3.00,4.00,$5.00,\n"{long}end",,1.00,,,,,\nNEXT,,,,,,,\nKim,,2.00,,,,,'
    p = tmp_path / "pay.csv"
    p.write_bytes(text.encode())
    assert _read(spark, p, 50) == _plain(text)


def test_titles_and_quotes_end_with_their_file(spark, tmp_path):
    (tmp_path / "a.csv").write_text('FIRST,,,,,,,\nKim,,1.00,,,,,\n"Lee\nnever closed,,2.00,,,,,\n')
    (tmp_path / "b.csv").write_text("Max,,3.00,,,,,\nSECOND,,,,,,,\nMax,,4.00,,,,,\n")
    got = {(r[0], r[1].split("\n")[0], r[3]) for r in _read(spark, tmp_path, 20)}
    assert got == {("FIRST", "Kim", D("1.00")), (None, "Max", D("3.00")), ("SECOND", "Max", D("4.00"))} | {g for g in got if g[1] == "Lee"}


def test_a_plain_file_is_read_by_many_tasks(spark, tmp_path):
    p = tmp_path / "pay.csv"
    with p.open("w") as f:
        for k in range(60_000):
            f.write(f"SECTION {k // 1000},,,,,,,\n" if k % 1000 == 0 else f'Driver {k},"Feb 3, 2021",{k}.00,1.00,0.00,0.00,"$1,000.00",\n')
    spark.conf.set("spark.sql.files.maxPartitionBytes", 200_000)
    try:
        df = read_pay_export(spark, str(p))
        assert _ranges(spark, str(p)).select("start").distinct().count() >= p.stat().st_size // 200_000
        assert df.count() == 60_000 - 60
        got = df.groupBy("pay_type").count().collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert {(r.pay_type, r["count"]) for r in got} == {(f"SECTION {k}", 999) for k in range(60)}
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "MapInPandas", "MapInArrow", "SinglePartition"))
