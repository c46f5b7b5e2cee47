"""CSV records across lines and splits, against Python's csv module."""

import csv
import io
import random

import pytest

from reelrank.sources.records import read_repaired

NAMES = ("movieId", "userId", "quote", "creationDate", "rating")


def plain(text):
    """What reading row by row gives: rows and rows of a wrong width."""
    rows, bad = [], []
    for row in csv.reader(io.StringIO(text)):
        if not any(row):
            continue
        if len(row) == 1 and rows:
            rows[-1][2] += " " + row[0]
        elif len(row) == 1:
            bad.append(row)
        else:
            rows.append(row)
    return [tuple(r) for r in rows if len(r) == len(NAMES)], bad + [r for r in rows if len(r) != len(NAMES)]


def sample(seed, n=300):
    rng = random.Random(seed)
    out = []
    for k in range(n):
        text = rng.choice(["short", '"a, b"', '"two\nlines"', '"x ""y""\n\n, z\nw"', "é ü"])
        out.append(f"{k},{k % 7},{text},2020-01-02,8")
        for _ in range(rng.choice([0, 0, 0, 1, 3])):
            out.append(rng.choice(["more", "", ",,,,", '"q, r"', '"goes\non"', "é"]))
        if rng.random() < 0.05:
            out.append("1,2,3")
    return "\n".join(out) + "\n"


@pytest.fixture
def split_bytes(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    yield lambda n: spark.conf.set("spark.sql.files.maxPartitionBytes", n)
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def filled(rows):
    return sorted(tuple(x or "" for x in r) for r in rows)


def test_same_rows_at_any_split_size(spark, tmp_path, split_bytes):
    texts = [sample(1), sample(2)]
    for i, t in enumerate(texts):
        (tmp_path / f"{i}.csv").write_text(t)
    good = [r for t in texts for r in plain(t)[0]]
    bad = sum(len(plain(t)[1]) for t in texts)
    assert bad > 5 and any("\n" in r[2] for r in good)
    for n in (10**7, 5000, 700, 60):
        split_bytes(n)
        rows, rejects = read_repaired(spark, str(tmp_path), NAMES)
        assert filled(rows.collect()) == filled(good), n
        assert rejects.count() == bad


def test_header_leading_lines_and_endless_quotes(spark, tmp_path, split_bytes):
    split_bytes(300)
    path = str(tmp_path / "a.csv")
    with open(path, "w") as f:
        f.write("orphan\n" + ",".join(NAMES) + "\n1,2,x,d,5\ny\n2,2,z,d,4\n3,3,\"never " + "closed\n" * 60)
    rows, rejects = read_repaired(spark, path, NAMES, header=True, max_lines=50)
    assert filled(rows.collect()) == [("1", "2", "x y", "d", "5"), ("2", "2", "z", "d", "4")]
    assert sorted(r.line for r in rejects.collect()) == sorted(
        ["orphan", '3,3,"never closed', *["closed"] * 59])
    (tmp_path / "b.csv").write_text("1,2,x,d,5\n" + "go on\n" * 60 + "2,2,z,d,4\n")
    rows, rejects = read_repaired(spark, str(tmp_path / "b.csv"), NAMES, max_lines=50)
    assert filled(rows.collect()) == [("2", "2", "z", "d", "4")] and rejects.count() == 61


def test_empty_file(spark, tmp_path):
    (tmp_path / "e.csv").write_text("\n\n,,\n")
    rows, rejects = read_repaired(spark, str(tmp_path), NAMES)
    assert rows.count() == rejects.count() == 0
