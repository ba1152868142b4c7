"""CSV files with line breaks in quotes, read by byte range."""

import csv
import random

import pytest

from sftforge.sources.csvparts import ends_inside
from sftforge.sources.readers import read_csv_rows

NASTY = ["plain", "", 'say ""twice"" "once"', "a,b", "line\nbreak", "two\r\nbreaks\n\n", '"', '""', ',"', '\n"\n', "é日😀", "x" * 300, 'in"side', " lead", "N/A"]


@pytest.fixture()
def small_ranges(spark):
    key = "spark.sql.files.maxPartitionBytes"
    old = spark.conf.get(key)
    yield lambda n: spark.conf.set(key, str(n))
    spark.conf.set(key, old)


def both(spark, path):
    """Rows read by range, in order, and by one task a file."""
    parts = read_csv_rows(spark, path, multi_line=True, large=0)
    got = parts.orderBy("_ord").collect()
    blocks = {r["_ord"]["block"] for r in got}
    drop = lambda rows: [tuple(r)[:-1] for r in rows]
    whole = read_csv_rows(spark, path, multi_line=True, large=1 << 40)
    assert parts.columns == whole.columns
    return drop(got), drop(whole.orderBy("_ord").collect()), blocks


def test_ends_inside():
    for line, outside, inside in (("a,b", False, True), ('a,"b', True, False), ('b",c', False, False), ('a,"b ""c"" d', True, False),
                                  ('"a","b"', False, False), ('in"side,b', False, False), ('"', True, False), ('""', False, True),
                                  ('"""', True, False), ('x "",y', False, True), ('a,""', False, True), ('"a" b,"c', True, True)):
        assert ends_inside(line.encode(), False) == outside, line
        assert ends_inside(line.encode(), True) == inside, line


@pytest.mark.parametrize("quoting, end", [(csv.QUOTE_MINIMAL, "\n"), (csv.QUOTE_ALL, "\r\n")])
def test_rows_equal_those_written(spark, tmp_dir, small_ranges, quoting, end):
    rnd = random.Random(5)
    rows = [(f"q{i}", rnd.choice(NASTY), rnd.choice(NASTY) * rnd.randint(1, 3)) for i in range(3000)]
    with open(f"{tmp_dir}/a.csv", "w", newline="", encoding="utf-8") as f:
        csv.writer(f, quoting=quoting, lineterminator=end).writerows([("question", "b", "c"), *rows])
    small_ranges(4000)
    got, whole, blocks = both(spark, f"{tmp_dir}/a.csv")
    assert len(blocks) > 8 and got == whole
    missing = lambda v: None if v in ("", "N/A") else v.replace("\r\n", "\n") if end == "\r\n" else v
    assert [tuple(map(lambda v: v or None, r)) for r in got] == [tuple(map(missing, r)) for r in rows]


def test_a_record_over_several_ranges_and_files(spark, tmp_dir, small_ranges):
    long = '"\n,' * 20_000
    for name, rows in (("a", [("1", "short"), ("2", long), ("3", "end")]), ("b", [("4", long), ("5", "x\n")]), ("c", [])):
        with open(f"{tmp_dir}/{name}.csv", "w", newline="") as f:
            csv.writer(f).writerows([("id", "text"), *rows])
    small_ranges(8000)
    got, whole, _ = both(spark, tmp_dir)
    assert got == whole and got == [("1", "short"), ("2", long), ("3", "end"), ("4", long), ("5", "x\n")]


def test_bom_blank_lines_short_rows_and_an_open_quote(spark, tmp_dir, small_ranges):
    with open(f"{tmp_dir}/a.csv", "wb") as f:
        f.write('﻿"id",text\n\n1,a\n2\n\n3,"b""",more\n4," "\n5,"never closed\n6,x\n'.encode())
    small_ranges(16)
    got, whole, _ = both(spark, f"{tmp_dir}/a.csv")
    assert got[:4] == whole[:4] and [r[0] for r in got] == ["1", "2", "3", "4", "5"]
    assert got[4][1] == whole[4][1].rstrip("\n") == "never closed\n6,x"
