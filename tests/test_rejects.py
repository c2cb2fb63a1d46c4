"""Rows that fail, against the strict grammar record by record."""

import random

import pytest

from citeforge.sources.rejects import EXPORT_FIELDS, Layout, loaded, rejected

GOOD = ",".join(f'"{v}"' for v in ["A", "1", "T", "2020", *["x"] * 6, "3", "4", *["y"] * 8])


def fields(**changed):
    values = ["x"] * 20
    values[3], values[10], values[11] = "2020", "", "0"
    for k, v in changed.items():
        values[int(k[1:])] = v
    return ",".join(values)


CASES = {
    GOOD: None,
    fields(): None,
    "": "columns",
    None: "columns",
    GOOD + ",z": "columns",
    GOOD.replace('"T"', '"a ""b"" c"'): None,
    GOOD.replace('"T"', '"line\r\nbreak, comma"'): None,
    GOOD.replace('"T"', '"a "b" c"'): "quoting",
    GOOD.replace('"T"', '"open'): "quoting",
    GOOD.replace('"T"', 'a"b'): "quoting",
    fields(f2="a\nb"): "quoting",
    GOOD + "\n": "quoting",
    GOOD.replace('","', '";"'): "quoting",
    fields(f3="20"): "value",
    fields(f3="1899"): "value",
    fields(f3="2031"): "value",
    fields(f3=" 2020"): "value",
    fields(f3="２０２０"): "value",
    fields(f3=""): None,
    fields(f10="1.5"): "value",
    fields(f11="-1"): "value",
    fields(f5="a\x00b"): "value",
    fields(f5="a\x7f"): "value",
    fields(f5="tab\tis fine"): None,
    fields(f14="w" * 300_000): None,
}


@pytest.mark.parametrize("line", list(CASES), ids=range(len(CASES)))
def test_diagnosis(line):
    assert Layout(EXPORT_FIELDS).diagnose(line) == CASES[line]


def test_blocks_agree_with_records(spark):
    lines = list(CASES) * 3
    random.Random(5).shuffle(lines)
    df = spark.createDataFrame([(i, x, "clash") for i, x in enumerate(lines)], "line_id long, raw_line string, Year string")
    assert dict(map(tuple, rejected(df).collect())) == {i: CASES[x] for i, x in enumerate(lines) if CASES[x]}
    rows = loaded(df)
    assert rows.columns == ["line_id", *EXPORT_FIELDS]
    got = {r["line_id"]: r["Title"] for r in rows.collect()}
    assert set(got) == {i for i, x in enumerate(lines) if CASES[x] is None}
    assert 'a "b" c' in got.values()


def test_merging_records_do_not_hide(spark):
    # One record opens a quote that the next one closes, and a third falls in two.
    a, b = GOOD.replace('"T"', '"T'), GOOD.replace('"A"', 'A"', 1)
    df = spark.createDataFrame([(1, a), (2, b), (3, GOOD + "\n" + GOOD)], "line_id long, raw_line string")
    assert dict(map(tuple, rejected(df).collect())) == {1: "quoting", 2: "quoting", 3: "quoting"}


def test_empty_table(spark):
    df = spark.createDataFrame([], "line_id long, raw_line string")
    assert rejected(df).count() == 0 and loaded(df).count() == 0
