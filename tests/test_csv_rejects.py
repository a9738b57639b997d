"""Malformed CSV lines go to a table with file and line; nothing is lost unseen."""

import os
import tempfile

import pytest

from eventweave.sources import read_csv_checked

SCHEMA = "id BIGINT, day DATE, name STRING, `n killed` DOUBLE"
HEADER = "id,day,name,n killed"


def _folder(**files: str) -> str:
    folder = tempfile.mkdtemp(prefix="ew-csv-")
    for name, body in files.items():
        with open(os.path.join(folder, f"{name}.csv"), "w") as f:
            f.write(body)
    return folder


def _read(spark, folder, **kw):
    rejects = tempfile.mkdtemp(prefix="ew-rejects-") + "/r"
    good = read_csv_checked(spark, folder, SCHEMA, rejects, **kw)
    bad = spark.read.parquet(rejects).collect()
    return good, sorted((os.path.basename(r["file"]), r["line"], r["value"]) for r in bad)


def test_bad_lines_are_kept_apart(spark):
    a = f'banner\nsecond, "banner"\n{HEADER}\n1,2001-02-03,"x, y",1.5\nseven,2001-02-03,x,1\n\n2,2001-02-04,,\n3,2001-02-05,x\n4,2001-02-06,x,1,9\n5,nodate,x,1\n'
    b = f" ban\n\n{HEADER.upper()}\n6,2001-02-07,z,2\n7,2001-02-08,z,many"
    good, bad = _read(spark, _folder(a=a, b=b), skip_lines=2)
    assert good.columns == ["id", "day", "name", "n killed"]
    assert sorted((r[0], r[2], r[3]) for r in good.collect()) == [(1, "x, y", 1.5), (2, None, None), (6, "z", 2.0)]
    assert bad == [
        ("a.csv", 5, "seven,2001-02-03,x,1"),
        ("a.csv", 8, "3,2001-02-05,x"),
        ("a.csv", 9, "4,2001-02-06,x,1,9"),
        ("a.csv", 10, "5,nodate,x,1"),
        ("b.csv", 5, "7,2001-02-08,z,many"),
    ]


def test_lines_are_counted_over_splits(spark):
    rows = [f"{i},2001-02-03,{'w' * (i % 50)},{'x' if i % 997 == 0 else i}" for i in range(20_000)]
    folder = _folder(a="\n".join([HEADER, *rows]))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        good, bad = _read(spark, folder)
        assert good.rdd.getNumPartitions() > 4
        assert bad == sorted(("a.csv", i + 2, r) for i, r in enumerate(rows) if i % 997 == 0)
        assert good.count() == len(rows) - len(bad)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@pytest.mark.parametrize("header", ["id,name,day,n killed", "id,day,name", "id,day,name,n killed,more"])
def test_a_wrong_header_raises(spark, header):
    with pytest.raises(ValueError, match="b.csv"):
        _read(spark, _folder(a=f"{HEADER}\n1,2001-02-03,x,1\n", b=f"{header}\n1,2001-02-03,x,1\n"))


def test_empty_files_and_no_header(spark):
    good, bad = _read(spark, _folder(a="", b=f"{HEADER}\n"))
    assert good.count() == 0 and bad == []
    good, bad = _read(spark, _folder(a="1,2001-02-03,x,1\n,,,\nq,,,\n"), header=False)
    assert good.count() == 2 and bad == [("a.csv", 3, "q,,,")]
