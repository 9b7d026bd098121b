"""Quoted CSV read in splits of any size."""

import random

import pytest

from tagwright.sources import tables
from tagwright.sources.csv_blocks import csv_records

SCHEMA = "id LONG, text STRING, sentiment STRING"


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    cell = lambda: rng.choice([
        None, "", " ", "plain", "a,b", 'say "x"', '"', '""', "two\nlines", "\n\n", "crlf\r\nend\r", "é ▁", "x" * 300, "long\n" * 40,
    ])
    return [(i, cell(), cell()) for i in range(400)]


@pytest.mark.parametrize("size", [64, 257, 5_000, 10_000_000])
def test_round_trip_in_splits(spark, rows, size, tmp_path):
    path = str(tmp_path / "t")
    tables.write_csv(spark.createDataFrame(rows, SCHEMA).coalesce(2), path)
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        got = sorted(map(tuple, tables.read_raw_csv(spark, path).collect()))
        tasks = spark.read.text(path, lineSep="\n").rdd.getNumPartitions()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert got == rows and (tasks > 8 if size < 1000 else tasks >= 1)


def test_files_of_other_hands(spark, tmp_path):
    """No newline at the end, blank lines, a header only, an empty file, a header over two lines."""
    files = {
        "a.csv": "id,text,sentiment\n1,one,pos\n\n2,\"x\ny\",\n3,last,neg",
        "b.csv": "id,text,sentiment\n",
        "c.csv": "",
        "d.csv": "\"id\",\"te\nxt\",sentiment\n4,\"\",\"\"\"q\"\"\"\n",
    }
    for name, text in files.items():
        (tmp_path / name).write_text(text, newline="")
    got = sorted(map(tuple, tables.read_raw_csv(spark, str(tmp_path)).collect()))
    assert got == [(1, "one", "pos"), (2, "x\ny", None), (3, "last", "neg"), (4, "", '"q"')]
    assert csv_records(spark, str(tmp_path / "c.csv")).count() == 0
