"""CSV sources and sinks."""

import os
import tempfile

import pytest

from reelrank.sources.csv import read_reviews
from reelrank.sources.sinks import write_recommendations, write_table
from reelrank.operators.ratings import prepare_reviews


def test_read_reviews_quoted_and_multiline(spark):
    d = tempfile.mkdtemp(prefix="reelrank-io-")
    path = os.path.join(d, "reviews.csv")
    with open(path, "w") as f:
        f.write('movieId,rating,quote,creationDate,userId\n')
        f.write('10,4.5,"good, really",2020-01-01,7\n')
        f.write('11,3,"two\nlines",2020-01-02,8\n')
        f.write('12,x,"bad rating",2020-01-03,9\n')
    df, _ = read_reviews(spark, path, multiline=True)
    rows = df.collect()
    assert len(rows) == 3 and rows[0].quote == "good, really" and rows[1].quote == "two\nlines"
    typed = prepare_reviews(df, user="userId", item="movieId").collect()
    assert [r.rating for r in typed] == [4.5, 3.0, None]


def test_write_and_read_back(spark):
    d = tempfile.mkdtemp(prefix="reelrank-io-")
    df = spark.createDataFrame([(1, 2, 3.5)], "userId long, itemId long, totalScore double")
    write_recommendations(df, os.path.join(d, "recs"), single_file=True)
    back = spark.read.csv(os.path.join(d, "recs"), header=True, schema="userId long, itemId long, totalScore double")
    assert back.collect() == df.collect()
    write_table(df, os.path.join(d, "tbl"))
    assert spark.read.parquet(os.path.join(d, "tbl")).collect() == df.collect()


def test_read_reviews_by_name_with_rejects(spark):
    d = tempfile.mkdtemp(prefix="reelrank-io-")
    path = os.path.join(d, "raw.csv")
    with open(path, "w") as f:
        f.write('userId,movieId,rating,quote,creationDate,extra\n')
        f.write('7,100,5,good,2020-01-01,x\n')
        f.write('8,11,3,too,many,fields,here,8\n')
        f.write('9,12\n')
    rows, bad = read_reviews(spark, path)
    assert [r.asDict() for r in rows.collect()] == [
        {"movieId": "100", "rating": "5", "quote": "good", "creationDate": "2020-01-01", "userId": "7"}]
    assert sorted(r.line for r in bad.collect()) == ["8,11,3,too,many,fields,here,8", "9,12"]
    with pytest.raises(ValueError, match="colour"):
        read_reviews(spark, path, ("userId", "colour"))


def test_read_lines_without_header(spark):
    d = tempfile.mkdtemp(prefix="reelrank-io-")
    path = os.path.join(d, "lines.txt")
    with open(path, "w") as f:
        f.write("1,2,3.5\n4,5\n")
    names = ("movieId", "userId", "rating")
    rows, bad = read_reviews(spark, path, ("rating", "userId"), names=names)
    assert [tuple(r) for r in rows.collect()] == [("3.5", "2")]
    assert [r.line for r in bad.collect()] == ["4,5"]


def test_write_table_once_sorted_and_filterable(spark):
    from reelrank.session import write_table_once
    df = spark.createDataFrame([(3, 1.0), (1, 2.0), (2, 3.0), (1, 4.0)], "userId long, v double")
    back = write_table_once(df.repartition(2), "t", sort_by=("userId",))
    assert sorted(back.collect()) == sorted(df.collect())
    ckpt = spark.sparkContext.getCheckpointDir().replace("file:", "")
    assert back.inputFiles() and all(ckpt in f.replace("file:", "") for f in back.inputFiles())
    plan = back.filter("userId = 1")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(userId,1)" in plan


def test_one_named_object(spark, tmp_path):
    from reelrank.sources.sinks import write_one_object
    path = str(tmp_path / "out" / "list.csv")
    read = lambda: sorted(r.id for r in spark.read.option("header", True).csv(path).collect())
    write_one_object(spark.range(5).repartition(4), path)
    assert read() == list("01234") and open(path).read().count("id") == 1
    write_one_object(spark.range(2).repartition(2), path)
    assert read() == ["0", "1"]
    failing = spark.range(9).selectExpr("if(id = 7, raise_error('stop'), id) as id")
    for bad, rows in ((failing, 100), (spark.range(9), 4)):
        with pytest.raises(Exception):
            write_one_object(bad, path, rows)
        assert read() == ["0", "1"]  # the old object stays whole
    write_one_object(spark.range(0), path)
    assert read() == []
    assert [p.name for p in (tmp_path / "out").iterdir() if not p.name.endswith(".crc")
            and ".attempt-" not in p.name] == ["list.csv"]


def test_named_parts(spark, tmp_path):
    from reelrank.sources.sinks import write_named_parts
    names = write_named_parts(spark.range(100).repartitionByRange(3, "id"), str(tmp_path / "parts"), "p")
    assert [n.rsplit("/", 1)[1] for n in names] == [f"p-{i:05d}.csv" for i in range(3)]
    rows = [int(r.id) for n in names for r in spark.read.option("header", True).csv(n).collect()]
    assert rows == list(range(100))


def test_write_modes(spark, tmp_path):
    from reelrank.sources.sinks import write_recommendations
    path = str(tmp_path / "recs")
    one = spark.createDataFrame([(1, 2, 3.0)], "userId long, itemId long, totalScore double")
    write_recommendations(one, path, mode="errorifexists", single_file=True)
    with pytest.raises(Exception):
        write_recommendations(one, path, mode="errorifexists")
    write_recommendations(one.union(one), path, mode="overwrite")
    assert spark.read.option("header", True).csv(path).count() == 2
