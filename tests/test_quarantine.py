"""Bad records of delimited files are set aside with file and line."""

import os

import pytest
from pyspark.sql.types import DateType, IntegerType, StringType, StructType

from regstar.sources import read_records, write_delimited
from tests.conftest import rows

SCHEMA = StructType().add("code", StringType()).add("n", IntegerType()).add("day", DateType())


def _write(path, *lines, end="\n"):
    path.write_text(end.join(lines) + end, encoding="utf-8")
    return str(path)


def _bad(records):
    return sorted((os.path.basename(r.file), r.line, r.record) for r in records.bad.collect())


def test_bad_records_keep_their_place(spark, tmp_path):
    a = _write(tmp_path / "a.csv", "﻿A,1,2020-01-02", "B,x,2020-01-02", "", "C,3", '"D, d",4,2020-02-30', "E,5,2020-01-02,more", "F,,")
    b = _write(tmp_path / "b.csv", '"G ""g""",7,2020-01-02', "  ", "H,99999999999,2020-01-02", end="\r\n")
    found = read_records(spark, [a, b], SCHEMA, header=False)
    assert sorted((r.code, r.n) for r in found.good.collect()) == [("A", 1), ("F", None), ('G "g"', 7)]
    assert _bad(found) == [
        ("a.csv", 2, "B,x,2020-01-02"), ("a.csv", 4, "C,3"), ("a.csv", 5, '"D, d",4,2020-02-30'),
        ("a.csv", 6, "E,5,2020-01-02,more"), ("b.csv", 3, "H,99999999999,2020-01-02"),
    ]


def test_headers(spark, tmp_path):
    named = _write(tmp_path / "a.csv", "﻿code,n,day", "A,1,2020-01-02", "code,n,day")
    other = _write(tmp_path / "b.csv", "kode,n,day", "B,2,2020-01-02")
    none = _write(tmp_path / "c.csv", "C,3,2020-01-02")
    found = read_records(spark, [named, other, none], SCHEMA, header=True)
    assert sorted(r.code for r in found.good.collect()) == ["A", "B"]
    assert _bad(found) == [("a.csv", 3, "code,n,day"), ("b.csv", 1, "kode,n,day"), ("c.csv", 1, "C,3,2020-01-02")]


def test_lines_are_numbered_over_splits(spark, tmp_path):
    lines = [f"R{i},{i if i % 97 else 'bad'},2020-01-02" for i in range(4000)]
    path = _write(tmp_path / "long.csv", *lines)
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "9000")
    try:
        assert spark.read.text(path).rdd.getNumPartitions() > 3
        found = read_records(spark, path, SCHEMA, header=False)
        assert _bad(found) == [("long.csv", i + 1, lines[i]) for i in range(0, 4000, 97)]
        assert found.good.count() + found.bad.count() == 4000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)


@pytest.mark.parametrize("header", [True, False])
def test_what_is_written_comes_back_without_bad_records(spark, tmp_path, header):
    values = [("a,b", 1, None), ('say "x"', None, None), ("", 3, None), (None, 4, None), (" padded ", 5, None)]
    df = spark.createDataFrame(values, SCHEMA)
    found = read_records(spark, write_delimited(df, str(tmp_path / "t"), header=header), SCHEMA, header=header)
    assert rows(found.good) == rows(df) and found.bad.count() == 0


def test_empty_file(spark, tmp_path):
    (tmp_path / "e.csv").write_text("")
    found = read_records(spark, str(tmp_path / "e.csv"), SCHEMA, header=True)
    assert found.good.count() == 0 and found.bad.count() == 0
