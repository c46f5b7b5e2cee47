import pytest


@pytest.fixture(scope="session")
def make(spark):
    """Documents from (doc_id, text) pairs, with columns that clash with the
    operators' own names."""
    def build(rows):
        df = spark.createDataFrame(
            [(i, t, "n", 1, "fp", 2.0) for i, t in rows],
            "doc_id long, text string, n string, size int, fp string, score double")
        return df.repartition(3)
    return build


LONG = " ".join(f"w{i % 977}x{i % 13}" for i in range(30_000))
# nulls, empties, repeated rows, repeated ids, a very long text, ties
ODD = [(1, "a b c d e f"), (2, "a b c d e f"), (3, None), (4, ""), (5, " \n\t "), (6, LONG),
       (7, "Don't stop\x0bnow Ünïcode ß ☃ 𝔘 é İ"), (7, "Don't stop\x0bnow Ünïcode ß ☃ 𝔘 é İ"),
       (8, "<|endoftext|>x <|startoftext|> y"), (9, "two  spaces\n\n and　wide"),
       (None, "a b c d e f"), (None, None), (10, "x"), (11, "A B C D E F"), (-5, "unique text here")]


@pytest.fixture(scope="session")
def odd(make):
    return make(ODD)


@pytest.fixture(scope="session")
def none(make):
    return make([(1, "x")]).where("doc_id < 0")
