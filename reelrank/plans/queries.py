"""Named queries over the driver's tables: ``name -> f(spark, sf_dir)``.

Each reads the whole tables; the parameters are the reference's own
(target user 26, top 500, seed 42, rank 10, 10 iterations, lambda 0.1,
rate 0.01).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from reelrank.functions.text import clean_text
from reelrank.operators import factorize as fz
from reelrank.operators import neighbours as nb
from reelrank.operators import prepare as pr
from reelrank.operators import ratings as ra
from reelrank.operators import sentiment as se
from reelrank.operators.blend import blend_recommendations
from reelrank.operators.rank import minmax_scale, topn_per_user
from reelrank.plans.hybrid import hybrid_recommendations
from reelrank.session import ensure_checkpoint_dir, write_table_once
from reelrank.sources.csv import read_reviews
from reelrank.sources.records import read_repaired
from reelrank.sources.sinks import write_one_object, write_table
from reelrank.sources.tables import review_texts, reviews, table

# The reference's job parameters (target user, list length,
# seed, factor rank, sample sizes; GD rank, lambda, rate).
TARGET = 26
TOP_N = 500
SEED = 42
RANK = 10
SAMPLE_FRACTION = 0.4
SAMPLE_ROWS = 10_000
CAP_PER_USER = 5
TOP_PER_USER = 5
BATCH_TOP = 20
PIVOT_ITEMS = 10
MIN_SIMILARITY = 0.05
GD = dict(rank=10, lam=0.1, alpha=0.01, seed=42)
GD_ROUNDS = 10
REVIEW_KEYS = ["userId", "itemId", "doc_id"]

Query = Callable[[SparkSession, str], DataFrame]


def _r(c: str, digits: int = 6):
    return F.round(F.col(c), digits).alias(c)


def _typed_reviews(spark, d) -> DataFrame:
    r = reviews(spark, d)
    return r.select("userId", "itemId", "rating", "sentimentResult", "doc_id",
                    F.col("creationDate").cast("date").cast("string").alias("creationDate"))


def _written(kind: str, build) -> DataFrame:
    """The query's own ratings table, written once as parquet, dealt and
    sorted by user and item: a target-user filter reads few files and row
    groups, and a user with very many ratings has several files."""
    return write_table_once(build().repartitionByRange("userId", "itemId"), f"ratings-{kind}",
                            sort_by=("userId", "itemId"))


def _ratings(spark, d, reuse: bool = False) -> DataFrame:
    """Ratings per (user, item). ``reuse``: the plan reads them several
    times (size checks, target and neighbour branches), so they are
    written once to the checkpoint folder instead of re-deriving them
    from lineitem x orders in every branch (Catalyst pushes each branch's
    filter below the aggregate, so no exchange would be shared)."""
    build = lambda: ra.user_item_ratings(reviews(spark, d))
    return _written("ratings", build) if reuse else build()


def _blended(spark, d, reuse: bool = False) -> DataFrame:
    build = lambda: ra.user_item_ratings(reviews(spark, d), weight=0.5)
    return _written("blended", build) if reuse else build()


def _gd_ratings(spark, d, reuse: bool = False) -> DataFrame:
    build = lambda: ra.user_item_ratings(reviews(spark, d), weight=0.5, clamp=True)
    return _written("gd", build) if reuse else build()


# ------------------------------------------------------------------ queries

def q_prepare_reviews(spark, d):
    return ra.prepare_reviews(reviews(spark, d))


def q_dataset_stats(spark, d):
    return ra.dataset_stats(reviews(spark, d))


def q_user_item_ratings(spark, d):
    return _ratings(spark, d)


def q_blend_rating(spark, d):
    return _blended(spark, d)


def q_seen_items(spark, d):
    return ra.seen_report(_ratings(spark, d))


def q_user_similarity(spark, d):
    return nb.user_similarity(_ratings(spark, d, reuse=True), TARGET).select("userId", _r("dot"), _r("similarity"))


def q_user_knn(spark, d):
    return nb.user_knn(_ratings(spark, d, reuse=True), TARGET, TOP_N).select("userId", "itemId", _r("totalScore"))


def q_user_knn_batch(spark, d):
    """User-KNN for a requested set: the users whose id ends in 26."""
    ratings = _ratings(spark, d, reuse=True)
    users = ratings.filter(F.col("userId") % 100 == TARGET).select("userId").distinct()
    return nb.user_knn_for(ratings, users, TOP_PER_USER).select(
        "userId", "itemId", _r("totalScore"), F.col("rank").cast("long").alias("rank"))


def q_topn_per_user(spark, d):
    top = topn_per_user(_blended(spark, d), TOP_PER_USER, score="rating")
    return top.select("userId", "itemId", "rating", F.col("rank").cast("long").alias("rank"))


def q_item_similarity(spark, d):
    return nb.item_similarity(_ratings(spark, d, reuse=True)).select("item1", "item2", _r("similarity"))


def q_two_hop_scores(spark, d):
    out = nb.two_hop_scores_from_ratings(_ratings(spark, d, reuse=True))
    return out.select("itemId", _r("predictedScore"), "NormalizedScore")


def q_item_knn(spark, d):
    out = nb.item_knn(_blended(spark, d, reuse=True), TARGET, TOP_N)
    return out.select("userId", "itemId", _r("predictedScore"), "totalScore")


def q_unseen_pair_scores(spark, d):
    out = nb.unseen_pair_scores_from_ratings(_blended(spark, d, reuse=True), TARGET)
    out = minmax_scale(out, "predictedScore", upper=5.0, cap=10.0)
    return out.select("itemId", _r("predictedScore"), "NormalizedScore")


def q_pivot_ratings(spark, d, reuse=True):
    ratings = _ratings(spark, d, reuse=True)
    counts = ratings.groupBy("itemId").agg(F.count(F.lit(1)).alias("n"))
    order = [F.col("n").desc(), F.col("itemId")]
    # the PIVOT_ITEMS most rated items (a bounded top-k), numbered 1..k
    top = (counts.orderBy(*order).limit(PIVOT_ITEMS)
           .select("itemId", F.row_number().over(Window.orderBy(*order)).alias("rk")))
    ranked = ratings.join(F.broadcast(top), "itemId", "left")
    wide = ra.pivot_ratings(ranked.withColumn("itemId", F.col("rk")), list(range(1, PIVOT_ITEMS + 1)))
    return wide.select("userId", *[F.col(str(k)).alias(f"r{k}") for k in range(1, PIVOT_ITEMS + 1)])


def q_dedupe_pairs(spark, d):
    r = _typed_reviews(spark, d)
    return pr.dedupe_pairs(r, ["userId", "itemId"],
                           ["creationDate", "rating", "sentimentResult", "doc_id"])


def q_cap_per_user(spark, d):
    ev = table(spark, d, "events")
    return pr.cap_per_user(ev, CAP_PER_USER, "user_id", [F.col("ts"), F.col("event_id")])


def q_split_valid_rows(spark, d):
    ev = table(spark, d, "events")
    valid, rejected = pr.split_valid_rows(ev, ["event_id", "ts", "user_id", "value"])
    return (valid.withColumn("part", F.lit("valid"))
            .unionByName(rejected.withColumn("part", F.lit("rejected"))))


def q_split_rejected_rows(spark, d):
    """The split over all six columns, on events with nulls, NaN and both
    infinities put in by id."""
    ev = table(spark, d, "events")
    k = F.col("event_id")
    ev = ev.withColumns({
        "value": F.when(k % 50 == 0, F.lit(None)).when(k % 50 == 1, F.lit(float("nan")))
        .when(k % 50 == 2, F.lit(float("inf"))).when(k % 50 == 3, F.lit(float("-inf")))
        .otherwise(F.col("value")),
        "user_id": F.when(k % 97 == 5, F.lit(None)).otherwise(F.col("user_id"))})
    valid, rejected = pr.split_valid_rows(ev)
    one = lambda df, part: df.select("event_id", "user_id", F.lit(part).alias("part"))
    return one(valid, "valid").unionByName(one(rejected, "rejected"))


def _scratch(spark, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/csv/{name}-{uuid.uuid4().hex}"


def q_csv_roundtrip(spark, d):
    """Reviews written as CSV with the columns in another order and read by
    name: texts hold commas and quotes."""
    r = _typed_reviews(spark, d).withColumn(
        "quote", F.concat(F.lit('said "no", '), F.col("doc_id").cast("string"), F.lit(', then "yes"')))
    path = _scratch(spark, "reviews")
    write_table(r.select("quote", F.col("userId"), "creationDate", F.col("itemId").alias("movieId"),
                         "rating"), path, fmt="csv")
    rows, _ = read_reviews(spark, path)
    return rows.select(F.col("userId").cast("long").alias("userId"),
                       F.col("movieId").cast("long").alias("itemId"),
                       F.col("rating").cast("double").alias("rating"), "quote", "creationDate")


def q_csv_rejects(spark, d):
    """Lines without a header, every tenth with a field too many and every
    tenth with one too few: parsed rows and rejected lines, none lost."""
    o = table(spark, d, "orders")
    k = F.col("o_orderkey")
    line = F.concat_ws(",", k, F.col("o_custkey"), F.when(k % 10 != 7, F.lit("4.5")),
                       F.when(k % 10 == 3, F.lit("more")))
    path = _scratch(spark, "lines")
    o.select(line.alias("value")).write.text(path)
    names = ("movieId", "userId", "rating")
    rows, bad = read_reviews(spark, path, names, names=names)
    return (rows.select(F.lit("row").alias("kind"), F.concat_ws(",", *names).alias("line"))
            .unionByName(bad.select(F.lit("reject").alias("kind"), "line")))


def q_item_similarity_min(spark, d):
    return (nb.item_similarity(_ratings(spark, d, reuse=True), min_similarity=MIN_SIMILARITY)
            .select("item1", "item2", _r("similarity")))


def q_clean_text_entities(spark, d):
    """``clean_text`` over pages that begin with named, decimal, hexadecimal,
    doubly escaped, bare and unknown references."""
    pages = table(spark, d, "pages")
    n = F.col("page_id") % 26
    head = F.concat(F.lit("caf&eacute; &#"), (n + 97).cast("string"), F.lit(";&#x"), F.hex(n + 65),
                    F.lit("; &#38;amp; &nosuch; &copy &rsquo;&lt;b&gt; "))
    return pages.select("page_id", clean_text(F.concat(head, F.coalesce("html", F.lit("")))).alias("text"))


def q_csv_one_object(spark, d):
    """Items rated per user as one named CSV object that replaces another,
    read back."""
    path = f"{_scratch(spark, 'object')}.csv"
    write_one_object(spark.range(3), path)
    write_one_object(ra.seen_report(_ratings(spark, d)), path)
    return spark.read.schema("userId long, n_seen long").option("header", True).csv(path)


def q_csv_multiline(spark, d):
    """Orders as CSV lines of which some have quoted line breaks, some go on
    in lines of one field (plain or quoted), with blank lines between."""
    o = table(spark, d, "orders")
    k = F.col("o_orderkey")
    head = F.concat_ws(",", k, F.col("o_custkey"))
    end = F.concat(F.lit(","), F.substring(F.col("o_orderdate").cast("string"), 1, 10), F.lit(",8"))
    text = (F.when(k % 10 == 3, F.concat(head, F.lit(',"two\nlines, ""and"" three\n\nof ' + 'them"'), end))
            .when(k % 10 == 5, F.concat(head, F.lit(",plain"), end, F.lit("\ngoes on\n\nand on")))
            .when(k % 10 == 7, F.concat(head, F.lit(',"quoted"'), end, F.lit('\n,,,,\n"over, two\nlines"')))
            .otherwise(F.concat(head, F.lit(",short"), end)))
    path = _scratch(spark, "multiline")
    o.select(text.alias("value")).write.text(path)
    rows, _ = read_repaired(spark, path, ("movieId", "userId", "quote", "creationDate", "rating"))
    return rows


# Markup put before each page in turn, for ``clean_text_markup``.
MARKUP_HEADS = (
    '<a title="1>0">quoted</a> ', "<b a='x>y' >single</b> ", '<i a = "p>q"b=r>spaced</i> ',
    "<p don't>it's</p> ", '<u t=op"en>never</u> shut ', "one<!-- > -- -->two<!---->three<!-->four ",
    "<![CDATA[1 < 2 &amp; 3]]> kept ", "<SCRIPT s='>'>if (a</b) '</scrip>'</script >after ",
    "<style>p > q</STYLE><scripty>plain</scripty> ", "1 < 2 &#99999999999999;and &#0065;&#x41; ")


def q_clean_text_markup(spark, d):
    """``clean_text`` over pages that begin with quoted >, odd comments, CDATA
    and raw text, every seventh ending in a quote and a comment that never close."""
    pages = table(spark, d, "pages")
    heads = F.array(*[F.lit(h) for h in MARKUP_HEADS])
    head = F.element_at(heads, (F.col("page_id") % len(MARKUP_HEADS) + 1).cast("int"))
    tail = F.when(F.col("page_id") % 7 == 3, F.lit('end <u t="open>shut <!-- lost <b>x</b>')).otherwise("")
    return pages.select("page_id", clean_text(
        F.concat(head, F.coalesce("html", F.lit("")), tail)).alias("text"))


def q_seen_pairs(spark, d):
    """Every (user, item) that a user has rated, as rows."""
    return ra.seen_items(_ratings(spark, d))


def q_index_ids(spark, d):
    return pr.index_ids(_ratings(spark, d), "userId", method="sorted")


def q_index_ids_frequency(spark, d):
    return pr.index_ids(reviews(spark, d), "itemId", method="frequency")


def q_sample_fraction(spark, d):
    return pr.sample_fraction(_typed_reviews(spark, d), SAMPLE_FRACTION, REVIEW_KEYS, SEED)


def q_sample_n(spark, d):
    return pr.sample_n(_typed_reviews(spark, d), SAMPLE_ROWS, REVIEW_KEYS, SEED)


def q_train_test_split(spark, d):
    return pr.train_test_split(_ratings(spark, d), ["userId", "itemId"], 0.2, SEED)


def q_clean_text(spark, d):
    pages = table(spark, d, "pages")
    return pages.select("page_id", clean_text("html").alias("text"))


def _lexicon(spark, d):
    return se.polarity_lexicon(table(spark, d, "documents"), table(spark, d, "labels"))


def q_polarity_lexicon(spark, d):
    return _lexicon(spark, d).select("token", F.col("df1").cast("long").alias("df1"),
                                     F.col("df0").cast("long").alias("df0"), _r("polarity", 9))


def q_sentence_scores(spark, d):
    s = se.sentence_scores(review_texts(spark, d), _lexicon(spark, d))
    return s.select("doc_id", F.col("pos").cast("long").alias("pos"),
                    F.col("n_chars").cast("long").alias("n_chars"), "n_tokens",
                    _r("polarity", 9), F.col("class").cast("long").alias("class"), "score", "label")


def _sentiment(spark, d):
    texts = review_texts(spark, d)
    return se.review_sentiment(texts, se.sentence_scores(texts, _lexicon(spark, d)))


def q_review_sentiment(spark, d):
    return _sentiment(spark, d)


# A linear model for ``review_sentiment_scored``: weights are multiples of
# 1/64, so that every engine gets the same sums.
SCORER = dict(tokens=2 / 64, characters=-1 / 64, capitals=-8 / 64, symbols=-16 / 64, bias=28 / 64)


def q_review_sentiment_scored(spark, d):
    """Sentiment by a model of one's own, loaded once per worker."""
    return se.review_sentiment(review_texts(spark, d), scorer=se.LinearScorer(**SCORER))


def q_label_to_score(spark, d):
    return se.label_scores(_sentiment(spark, d), SEED)


def q_scored_reviews(spark, d):
    return se.scored_reviews(_typed_reviews(spark, d), _sentiment(spark, d))


def q_blend_recommendations(spark, d):
    knn = nb.user_knn(_ratings(spark, d, reuse=True), TARGET, TOP_N)
    iknn = nb.item_knn(_blended(spark, d, reuse=True), TARGET, TOP_N)
    return blend_recommendations(knn, iknn).select("userId", "itemId", _r("totalScore"))


def _start_factors(spark, d):
    ratings = _gd_ratings(spark, d, reuse=True)
    return (ratings, fz.mf_init(ratings, "userId", GD["rank"], GD["seed"]),
            fz.mf_init(ratings, "itemId", GD["rank"], GD["seed"]))


def q_mf_loss(spark, d):
    ratings, U, M = _start_factors(spark, d)
    return fz.mf_loss(ratings, U, M, GD["rank"], GD["lam"]).select(
        _r("sse", 5), _r("reg", 5), _r("loss", 5))


def q_mf_gradient_step(spark, d):
    ratings, U, M = _start_factors(spark, d)
    U1, M1 = fz.split_factors(fz.mf_step(fz.stack_factors(U, M), fz.deal_ratings(ratings),
                                         GD["rank"], GD["lam"], GD["alpha"]))

    def longform(df, side):
        return df.select(F.lit(side).alias("side"), F.col("id").cast("long").alias("id"),
                         F.posexplode("features").alias("k", "value")).select(
            "side", "id", F.col("k").cast("long").alias("k"), _r("value", 8))
    return longform(U1, "u").unionByName(longform(M1, "m"))


def q_score_items(spark, d):
    _, U, M = _start_factors(spark, d)
    return fz.score_items(U, M, TARGET).select("userId", "itemId", _r("score"))


def q_mf_recommend_batch(spark, d):
    """The top unseen items of the users whose id ends in 26, from hash-made
    factors."""
    ratings, U, M = _start_factors(spark, d)
    users = ratings.filter(F.col("userId") % 100 == TARGET).select("userId")
    return fz.recommend_for(users, U, M, ratings, BATCH_TOP, positive_only=True)


def q_als_recommend_batch(spark, d):
    """ALS, then the top unseen items of the users whose id ends in 26."""
    ratings = _ratings(spark, d, reuse=True)
    users = ratings.filter(F.col("userId") % 100 == TARGET).select("userId")
    return fz.als_recommend_for(ratings, users, BATCH_TOP, RANK, seed=SEED)


def q_als_recommend(spark, d):
    return fz.als_recommend(_ratings(spark, d, reuse=True), TARGET, TOP_N, RANK, seed=SEED)


def q_als_normal_equations(spark, d):
    """What is left of each user's normal equations after the fit, relative
    to their right side: nothing, as user factors are solved last."""
    return fz.als_residuals(_ratings(spark, d, reuse=True), RANK, seed=SEED).select(
        "userId", F.round("residual", 3).alias("residual"))


def q_als_fit_predict(spark, d):
    return fz.als_fit_predict(_ratings(spark, d, reuse=True), RANK, seed=SEED)


def q_rating_rmse(spark, d):
    return fz.rating_rmse(_ratings(spark, d, reuse=True), 0.2, SEED, RANK)


def q_mf_recommend(spark, d):
    return fz.mf_recommend(_gd_ratings(spark, d), TARGET, TOP_N, GD["rank"], GD_ROUNDS,
                           GD["lam"], GD["alpha"], GD["seed"])


def q_hybrid_recommendations(spark, d):
    return hybrid_recommendations(_ratings(spark, d, reuse=True), TARGET, TOP_N, RANK, seed=SEED)


QUERIES: dict[str, Query] = {
    "prepare_reviews": q_prepare_reviews,
    "dataset_stats": q_dataset_stats,
    "user_item_ratings": q_user_item_ratings,
    "blend_rating": q_blend_rating,
    "seen_items": q_seen_items,
    "user_similarity": q_user_similarity,
    "user_knn": q_user_knn,
    "user_knn_batch": q_user_knn_batch,
    "als_normal_equations": q_als_normal_equations,
    "topn_per_user": q_topn_per_user,
    "item_similarity": q_item_similarity,
    "two_hop_scores": q_two_hop_scores,
    "item_knn": q_item_knn,
    "unseen_pair_scores": q_unseen_pair_scores,
    "pivot_ratings": q_pivot_ratings,
    "dedupe_pairs": q_dedupe_pairs,
    "cap_per_user": q_cap_per_user,
    "split_valid_rows": q_split_valid_rows,
    "split_rejected_rows": q_split_rejected_rows,
    "csv_roundtrip": q_csv_roundtrip,
    "csv_rejects": q_csv_rejects,
    "csv_multiline": q_csv_multiline,
    "csv_one_object": q_csv_one_object,
    "item_similarity_min": q_item_similarity_min,
    "clean_text_entities": q_clean_text_entities,
    "clean_text_markup": q_clean_text_markup,
    "seen_pairs": q_seen_pairs,
    "index_ids": q_index_ids,
    "index_ids_frequency": q_index_ids_frequency,
    "sample_fraction": q_sample_fraction,
    "sample_n": q_sample_n,
    "train_test_split": q_train_test_split,
    "clean_text": q_clean_text,
    "polarity_lexicon": q_polarity_lexicon,
    "sentence_scores": q_sentence_scores,
    "review_sentiment": q_review_sentiment,
    "review_sentiment_scored": q_review_sentiment_scored,
    "label_to_score": q_label_to_score,
    "scored_reviews": q_scored_reviews,
    "blend_recommendations": q_blend_recommendations,
    "mf_loss": q_mf_loss,
    "mf_gradient_step": q_mf_gradient_step,
    "score_items": q_score_items,
    "mf_recommend_batch": q_mf_recommend_batch,
    "als_recommend_batch": q_als_recommend_batch,
    "als_recommend": q_als_recommend,
    "als_fit_predict": q_als_fit_predict,
    "rating_rmse": q_rating_rmse,
    "mf_recommend": q_mf_recommend,
    "hybrid_recommendations": q_hybrid_recommendations,
}
