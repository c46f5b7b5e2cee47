"""Hand-sized inputs with expected values (FIXTURES.md section 3)."""

import math

import pytest
from pyspark.sql import functions as F

from reelrank.functions.scalar import (blend_rating, class_to_label, class_to_score,
                                       round_ratio_half_up)
from reelrank.functions.text import clean_text
from reelrank.operators import neighbours as nb
from reelrank.operators import prepare as pr
from reelrank.operators import sentiment as se
from reelrank.operators.blend import blend_recommendations
from reelrank.operators.rank import minmax_scale


def as_map(rows, key, val):
    return {r[key]: r[val] for r in rows}


def close(a, b, tol=1e-6):
    return abs(a - b) <= tol


def test_user_similarity(R):
    sim = as_map(nb.user_similarity(R, 1).collect(), "userId", "similarity")
    assert close(sim[2], 0.997054) and close(sim[3], 1.0)


def test_user_knn(R):
    out = nb.user_knn(R, 1, 10).collect()
    assert [(r.itemId, round(r.totalScore, 6)) for r in out] == [(3, 4.492636)]
    out = nb.user_knn(R, 3, 10).collect()
    assert [(r.itemId, round(r.totalScore, 6)) for r in out] == [(2, 2.409065)]
    assert {r.userId for r in out} == {3}


def test_user_knn_min_common(R):
    sim = nb.user_similarity(R, 1, min_common=2).collect()
    assert [r.userId for r in sim] == [2]  # u3 shares one item only
    out = nb.user_knn(R, 1, 10, min_common=2).collect()
    assert [(r.itemId, round(r.totalScore, 6)) for r in out] == [(3, 4.985272)]


def test_item_similarity(R):
    pairs = {(r.item1, r.item2): r.similarity for r in nb.item_similarity(R).collect()}
    assert set(pairs) == {(1, 2), (1, 3), (2, 3)}
    assert close(pairs[(1, 2)], 0.984309) and close(pairs[(1, 3)], 0.578355)
    assert close(pairs[(2, 3)], 0.433148)


def test_item_similarity_many_blocks(R):
    """Forcing one item per block and one row per tile side gives the
    same pairs (off-diagonal tiles, several user blocks, partial sums)."""
    a = {(r.item1, r.item2): round(r.similarity, 9) for r in nb.item_similarity(R).collect()}
    b = {(r.item1, r.item2): round(r.similarity, 9)
         for r in nb.item_similarity(R, max_block_items=1, max_tile_rows=1).collect()}
    assert a == b


def test_two_hop_and_scale(R):
    out = {r.itemId: r for r in nb.two_hop_scores(nb.item_similarity(R)).collect()}
    assert close(out[1].predictedScore, 0.676865)
    assert close(out[2].predictedScore, 0.819794)
    assert close(out[3].predictedScore, 0.995632)
    assert [out[i].NormalizedScore for i in (1, 2, 3)] == [0.0, 4.48, 10.0]


def test_item_knn_before_scaling(R):
    assert close(nb.item_knn_scores(R, 1).collect()[0].predictedScore, 1.011503)
    row = nb.item_knn_scores(R, 3).collect()
    assert [(r.itemId, round(r.predictedScore, 6)) for r in row] == [(2, 1.417457)]


def test_unseen_pair_scores_literal(R):
    out = as_map(nb.unseen_pair_scores(nb.item_similarity(R), R, 1).collect(),
                 "itemId", "predictedScore")
    assert close(out[1], 0.578355) and close(out[2], 0.433148)


def test_minmax_constant(spark):
    df = spark.createDataFrame([(1, 2.0), (2, 2.0)], "itemId long, s double")
    assert {r.NormalizedScore for r in minmax_scale(df, "s").collect()} == {5.0}


def test_blend_recommendations(spark):
    l1 = spark.createDataFrame([(1, "x", 4.0), (1, "y", 2.0)], "userId long, itemId string, totalScore double")
    l2 = spark.createDataFrame([(1, "y", 3.0), (1, "z", 1.0)], "userId long, itemId string, totalScore double")
    out = [(r.itemId, r.totalScore) for r in blend_recommendations(l1, l2).collect()]
    assert out == [("y", 2.5), ("x", 2.0), ("z", 0.5)]


def test_blend_rating_clamp(spark):
    df = spark.createDataFrame([(7.0, 3.0), (-1.0, 4.0)], "r double, s double")
    out = [r.b for r in df.select(blend_rating("r", "s", 0.5, clamp=True).alias("b")).collect()]
    assert out == [4.0, 2.0]


def test_class_maps(spark):
    df = spark.createDataFrame([(c,) for c in (0, 1, 2, 3, 4, 9)], "c int")
    rows = df.select(class_to_score("c").alias("s"), class_to_label("c").alias("l")).collect()
    assert [r.s for r in rows] == [1.0, 2.0, 3.0, 4.0, 5.0, 3.0]
    assert [r.l for r in rows[:5]] == ["NEGATIVE", "NEGATIVE", "NEUTRAL", "POSITIVE", "POSITIVE"]


def test_clean_text(spark):
    df = spark.createDataFrame([('<p>a  "b"</p>',), ("x é y",), (None,), ("",),
                                ("<!-- c --><script>var t='</p>';</script>T&amp;lt;&nbsp;x",)], "h string")
    out = [r.c for r in df.select(clean_text("h").alias("c")).collect()]
    assert out == ["a b", "x  y", None, "", "T&lt; x"]


@pytest.mark.parametrize("html,expected", [
    ("caf&eacute; it&#8217;s &#x27;ok&#x27; &#33; &#38;amp; &rsquo;", "caf its 'ok' ! &amp; "),
    ("&amp;lt; &amp;amp;", "&lt; &amp;"),
    ("&copy 2020 &notit; &nosuch; & &#; &#x;", " 2020 it; &nosuch; & &#; &#x;"),
    ("a&#0;b&#128;c&#xD800;d&#1114112;e&#65f&#x41g", "abcdeAfAg"),
    ("&lt&gt &AMP;&ampx", "<> &&x"),
])
def test_character_references(spark, html, expected):
    df = spark.createDataFrame([(html,)], "h string")
    assert df.select(clean_text("h").alias("c")).first().c == expected


@pytest.mark.parametrize("html,expected", [
    ('<a title="1>0">x</a>', "x"),
    ("<b a='x>y' >q</b>", "q"),
    ('<a title = "a>b"c>x<br/>y', "xy"),
    ("<p don't>it's</p>", "it's"),
    ('<a href=it"s>x"</a>', "x"),
    ('<a title="never>x</a> y', "x y"),
    ("a<!-- b > --c -->d<!---->e<!-->f<!--->g<!--h--!>i", "adefgi"),
    ("a <!-- never ends <b>x</b>", "a"),
    ("a<![CDATA[1 < 2 &amp; <b>]]>c &amp; d", "a1 < 2 &amp; <b>c & d"),
    ("a<![CDATA[never", "anever"),
    ("a<SCRIPT src='x>y'>if (a</b) '</scrip>' </script\n x='>'>b", "ab"),
    ("a<style>p > q {}</STYLE>b<scripty>c</scripty>", "abc"),
    ("a<script>never ends <p>x</p>", "a"),
    ("a<template><p>x</p></template>b", "ab"),
    ("<!DOCTYPE html><?xml version='1'?>a<!x>b", "ab"),
    ("1 < 2 > 0 <3 a<b", "1 < 2 > 0 <3 a<b"),
    ("a&#99999999999999999999;b&#x0000000041;c&#00065;", "abAcA"),
    ("a" + "<b x='1' y>" * 3000 + "z", "az"),
    ("a<b " + "\"'" * 20000 + ">z", "az"),
    ("a<b " + "x='" * 20001, "a<b " + "x='" * 20001),
])
def test_markup_tokens(spark, html, expected):
    df = spark.createDataFrame([(html,)], "h string")
    assert df.select(clean_text("h").alias("c")).first().c == expected


def test_every_name_is_decoded(spark):
    from html.entities import html5

    from reelrank.functions.text import decode_references
    df = spark.createDataFrame(list(html5.items()), "name string, text string")
    got = df.select("name", "text", decode_references(F.concat(F.lit("&"), "name")).alias("d"))
    assert [r.name for r in got.collect() if r.d != r.text] == []


def test_tile_plan_follows_the_data_alone():
    from reelrank.operators.item_pairs import block_counts
    assert block_counts(58_000, 2_000, 2048, 1_000_000) == (8, 1)
    assert block_counts(10**10, 10**6, 2048, 1_000_000) == (489, 21)
    assert block_counts(5, 3, 2048, 1_000_000) == (3, 1)


def test_split_valid_rows(spark):
    df = spark.createDataFrame([(1, 1.0), (2, float("nan")), (3, float("inf")), (4, None)],
                               "id int, v double")
    valid, rejected = pr.split_valid_rows(df)
    assert [r.id for r in valid.collect()] == [1]
    assert sorted(r.id for r in rejected.collect()) == [2, 3, 4]


def test_review_sentiment_null_and_empty(spark):
    texts = spark.createDataFrame([(1, None), (2, ""), (3, "..."), (4, "good good. bad.")],
                                  "doc_id long, text string")
    lex = spark.createDataFrame([("good", 1, 0, 1.0), ("bad", 0, 1, -1.0)],
                                "token string, df1 long, df0 long, polarity double")
    out = {r.doc_id: r for r in se.review_sentiment(texts, se.sentence_scores(texts, lex)).collect()}
    assert out[1].sentiment == out[2].sentiment == out[3].sentiment == 3.0
    # sentences: "good good" -> class 4 (score 5), " bad" -> class 0 (score 1)
    assert out[4].sentiment == 3.0 and out[4].n_sentences == 2
    assert out[4].sentiment_longest == 5.0 and out[4].sentiment_first == 5.0
    assert out[4].label_first == "POSITIVE"


@pytest.mark.parametrize("num,den,expected", [(7, 2, 3.5), (121, 40, 3.03), (5, 3, 1.67), (1, 8, 0.13)])
def test_round_ratio_half_up(spark, num, den, expected):
    df = spark.createDataFrame([(num, den)], "a long, b long")
    assert df.select(round_ratio_half_up("a", "b").alias("r")).first().r == expected
    assert math.isclose(expected, round(num / den + 1e-12, 2))


def test_a_model_of_ones_own_scores_sentences(spark):
    texts = spark.createDataFrame([(1, "Good good. BAD BAD BAD! 123. ..."), (2, None), (3, "#x")],
                                  "doc_id long, text string")
    scorer = se.LinearScorer(capitals=-0.25, symbols=-0.2, tokens=0.5)
    got = {(r.doc_id, r.pos): (r["class"], r.score) for r in se.model_sentence_scores(texts, scorer).collect()}
    # "Good good": 1.0 - 0.25; " BAD BAD BAD": 1.5 - 2.25; "#x": 0.5 - 0.2; no letters: none
    assert got == {(1, 0): (4, 5.0), (1, 1): (0, 1.0), (3, 0): (3, 4.0)}
    out = {r.doc_id: r for r in se.review_sentiment(texts, scorer=scorer).collect()}
    assert (out[1].sentiment, out[1].sentiment_longest, out[1].label_first) == (3.0, 1.0, "POSITIVE")
    assert out[2].sentiment == 3.0 and out[3].n_sentences == 1
    with pytest.raises(ValueError):
        se.review_sentiment(texts)


def test_a_model_is_loaded_once_per_worker():
    class Counting(se.LinearScorer):
        loads = 0

        def load(self):
            Counting.loads += 1
            return super().load()

    assert [se._loaded(Counting(tokens=9.0))(["a b"]) for _ in range(3)] == [[4]] * 3
    assert Counting.loads == 1
