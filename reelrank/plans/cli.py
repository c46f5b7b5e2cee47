"""Command line over CSV review files (the reference's job entry points).

  python -m reelrank.plans.cli <command> --input reviews.csv --output out/ [options]

commands: prepare, sentiment, als, user-knn, item-knn, two-hop, gd, hybrid.
Review CSVs have a header with movieId, userId, rating and optionally
sentimentResult / quote / creationDate; columns are read by name.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession, functions as F

from reelrank.functions.text import clean_text
from reelrank.operators import factorize as fz
from reelrank.operators import neighbours as nb
from reelrank.operators import prepare as pr
from reelrank.operators import sentiment as se
from reelrank.operators.blend import blend_recommendations
from reelrank.operators.ratings import user_item_ratings
from reelrank.session import apply_plan_conf, cut_lineage, ensure_checkpoint_dir
from reelrank.sources.csv import csv_columns, read_reviews
from reelrank.sources.sinks import write_recommendations, write_table

# Raw review columns the preparation step drops.
RAW_DROP = ("isVerified", "isSuperReviewer", "hasSpoilers", "hasProfanity",
            "userRealm", "reviewId", "score", "userDisplayName")


def load(spark: SparkSession, a, path: str | None = None) -> DataFrame:
    """All columns of a CSV by name; lines that do not parse are written
    under ``<output>_rejects/lines``."""
    path = path or a.input
    names = tuple(csv_columns(spark, path))
    rows, bad = read_reviews(spark, path, names, multiline=a.multiline)
    write_table(bad, f"{a.output}_rejects/lines", fmt="csv")
    return rows


def to_reviews(df: DataFrame) -> DataFrame:
    """userId, itemId, rating, sentimentResult (3.0 if absent), by name."""
    sentiment = F.expr("try_cast(sentimentResult AS DOUBLE)") if "sentimentResult" in df.columns \
        else F.lit(3.0)
    return df.select(F.expr("try_cast(userId AS BIGINT)").alias("userId"),
                     F.expr("try_cast(movieId AS BIGINT)").alias("itemId"),
                     F.expr("try_cast(rating AS DOUBLE)").alias("rating"),
                     sentiment.alias("sentimentResult"))


def _ratings(spark, a, clamp: bool = False) -> DataFrame:
    """Ratings of the rows whose ids and rating are numbers; the others are
    written under ``<output>_rejects/values`` (one rule for all commands)."""
    valid, bad = pr.split_valid_rows(to_reviews(load(spark, a)), ["userId", "itemId", "rating"])
    write_table(bad, f"{a.output}_rejects/values", fmt="csv")
    return cut_lineage(user_item_ratings(valid, weight=a.blend, clamp=clamp))


def cmd_prepare(spark, a) -> None:
    """Drop unused columns, sample a seeded fraction, map ids to dense
    integers (mappings written next to the data), clean the quote text."""
    df = load(spark, a)
    df = df.drop(*[c for c in RAW_DROP if c in df.columns])
    df = pr.sample_fraction(df.withColumn("_k", F.xxhash64(*df.columns)), a.fraction, ["_k"], a.seed).drop("_k")
    df = cut_lineage(df)
    for col in ("userId", "movieId"):
        mapping = pr.index_ids(df, col, method="sorted")
        write_table(mapping, f"{a.output}/{col}_mapping", fmt="csv")
        df = pr.apply_index(df, mapping, col)
    if "quote" in df.columns:
        df = df.withColumn("quote", clean_text("quote"))
    write_table(df, f"{a.output}/reviews", fmt="csv")


def cmd_sentiment(spark, a) -> None:
    """Score each distinct quote once (lexicon trained on --labelled, a CSV
    of text, quality 0/1) and write reviews with sentimentResult."""
    df = load(spark, a)
    lab = load(spark, a, a.labelled).select(
        F.sha2("text", 256).alias("doc_id"), "text",
        F.expr("try_cast(quality AS INT)").alias("quality"))
    lexicon = cut_lineage(se.polarity_lexicon(lab.select("doc_id", "text"), lab.select("doc_id", "quality")))
    # a text is known by its SHA-256 (its 64-bit hash alone would let texts collide)
    key = F.sha2(F.coalesce("quote", F.lit("")), 256)
    texts = df.select(key.alias("doc_id"), F.col("quote").alias("text")).dropDuplicates(["doc_id"])
    scores = se.review_sentiment(texts, se.sentence_scores(texts, lexicon))
    out = (df.drop("sentimentResult").withColumn("doc_id", key)
           .join(scores.select("doc_id", F.col("sentiment").alias("sentimentResult")), "doc_id", "left")
           .drop("doc_id", "quote"))
    write_table(out, a.output, fmt="csv")


def cmd_als(spark, a) -> None:
    write_recommendations(fz.als_recommend(_ratings(spark, a),
                                           a.user, a.top, seed=a.seed), a.output, single_file=True)


def cmd_user_knn(spark, a) -> None:
    write_recommendations(nb.user_knn(_ratings(spark, a), a.user, a.top),
                          a.output, single_file=True)


def cmd_item_knn(spark, a) -> None:
    write_recommendations(nb.item_knn(_ratings(spark, a), a.user, a.top),
                          a.output, single_file=True)


def cmd_two_hop(spark, a) -> None:
    out = nb.two_hop_scores_from_ratings(_ratings(spark, a))
    write_table(out.select(F.col("itemId").alias("movieId1"), "NormalizedScore"), a.output, fmt="csv")


def cmd_gd(spark, a) -> None:
    ratings = _ratings(spark, a, clamp=True)
    write_recommendations(fz.mf_recommend(ratings, a.user, a.top, seed=a.seed), a.output, single_file=True)


def cmd_hybrid(spark, a) -> None:
    ratings = _ratings(spark, a)
    out = blend_recommendations(fz.als_recommend(ratings, a.user, a.top, seed=a.seed),
                                nb.user_knn(ratings, a.user, a.top))
    write_recommendations(out, a.output)


COMMANDS = {"prepare": cmd_prepare, "sentiment": cmd_sentiment, "als": cmd_als,
            "user-knn": cmd_user_knn, "item-knn": cmd_item_knn, "two-hop": cmd_two_hop,
            "gd": cmd_gd, "hybrid": cmd_hybrid}


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="reelrank")
    p.add_argument("command", choices=sorted(COMMANDS))
    p.add_argument("--input", required=True)
    p.add_argument("--output", required=True)
    p.add_argument("--user", type=int, default=26)
    p.add_argument("--top", type=int, default=500)
    p.add_argument("--blend", type=float, default=1.0,
                   help="weight of the rating against sentimentResult (1 = rating only)")
    p.add_argument("--fraction", type=float, default=0.4)
    p.add_argument("--seed", type=int, default=42)
    p.add_argument("--multiline", action="store_true",
                   help="fields may hold quoted line breaks (each file is then one task)")
    p.add_argument("--labelled", help="CSV of text, quality for the sentiment lexicon")
    return p


def run(spark: SparkSession, argv: list[str]) -> None:
    args = parser().parse_args(argv)
    apply_plan_conf(spark)
    ensure_checkpoint_dir(spark)
    COMMANDS[args.command](spark, args)


def main(argv: list[str] | None = None) -> None:
    import sys
    spark = SparkSession.builder.appName("reelrank").getOrCreate()
    run(spark, sys.argv[1:] if argv is None else argv)


if __name__ == "__main__":
    main()
