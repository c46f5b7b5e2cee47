"""DuckDB SQL giving the same rows as each registered query.

The driver registers the parquet tables as views; every statement
derives the review views itself. Scores are rounded as the Spark
queries round them; ranking compares scores at 9 decimals, then ids.
"""

from __future__ import annotations

from reelrank.functions.hashing import unit_hash_sql
from reelrank.functions.text import SENTENCE, TOKEN
from reelrank.operators.sentiment import CUTS
from reelrank.plans.queries import (BATCH_TOP, CAP_PER_USER, GD, GD_ROUNDS, MIN_SIMILARITY, PIVOT_ITEMS, REVIEW_KEYS,
                                    SAMPLE_FRACTION, SAMPLE_ROWS, SCORER, SEED, TARGET, TOP_N, TOP_PER_USER)


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


REVIEWS = """reviews AS (
  SELECT o_custkey AS userId, l_partkey AS itemId,
         CAST(ceil(l_quantity / 10) AS DOUBLE) AS rating,
         CAST(1 + (l_orderkey * 7 + l_linenumber) % 5 AS DOUBLE) AS sentimentResult,
         (l_orderkey * 7 + l_linenumber) % (SELECT count(*) FROM documents) AS doc_id,
         o_orderdate AS creationDate
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""
TREVIEWS = """treviews AS (
  SELECT userId, itemId, rating, sentimentResult, doc_id,
         CAST(CAST(creationDate AS DATE) AS VARCHAR) AS creationDate FROM reviews)"""
RATINGS = """ratings AS (
  SELECT userId, itemId, avg(rating) AS rating FROM reviews GROUP BY userId, itemId)"""
BRATINGS = """bratings AS (
  SELECT userId, itemId, avg(rating * 0.5 + sentimentResult * 0.5) AS rating
  FROM reviews GROUP BY userId, itemId)"""
GRATINGS = """gratings AS MATERIALIZED (
  SELECT userId, itemId,
         avg(least(greatest(rating, 0.0), 5.0) * 0.5
             + least(greatest(sentimentResult, 0.0), 5.0) * 0.5) AS rating
  FROM reviews GROUP BY userId, itemId)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def q_ctes(src: str, prefix: str) -> list[str]:
    """Column-normalised ratings and item pairs (i < j) over ``src``."""
    return [
        f"""{prefix}norms AS (SELECT itemId, sqrt(sum(rating * rating)) AS norm
  FROM {src} WHERE rating <> 0 GROUP BY itemId)""",
        f"""{prefix}q AS (SELECT r.userId, r.itemId, r.rating / n.norm AS q
  FROM {src} r JOIN {prefix}norms n USING (itemId) WHERE r.rating <> 0)""",
    ]


def pair_ctes(src: str, prefix: str) -> list[str]:
    return q_ctes(src, prefix) + [
        f"""{prefix}pairs AS (SELECT a.itemId AS item1, b.itemId AS item2, sum(a.q * b.q) AS similarity
  FROM {prefix}q a JOIN {prefix}q b ON a.userId = b.userId AND a.itemId < b.itemId
  GROUP BY a.itemId, b.itemId)"""]


def user_knn_ctes() -> list[str]:
    return [
        f"t AS (SELECT itemId, rating AS t_rating FROM ratings WHERE userId = {TARGET})",
        f"""sim AS (SELECT r.userId, sum(r.rating * t.t_rating) AS dot,
         sqrt(sum(t.t_rating * t.t_rating)) AS nt, sqrt(sum(r.rating * r.rating)) AS nn
  FROM ratings r JOIN t USING (itemId) WHERE r.userId <> {TARGET} GROUP BY r.userId)""",
        "sim2 AS (SELECT userId, dot, dot / (nt * nn) AS similarity FROM sim)",
        f"""knn_all AS (SELECT r.itemId, avg(r.rating * s.similarity) AS totalScore
  FROM ratings r JOIN sim2 s USING (userId)
  WHERE r.userId <> {TARGET} AND r.itemId NOT IN (SELECT itemId FROM t) GROUP BY r.itemId)""",
        f"""knn AS (SELECT CAST({TARGET} AS BIGINT) AS userId, itemId, totalScore FROM knn_all
  ORDER BY round(totalScore, 9) DESC, itemId LIMIT {TOP_N})""",
    ]


def scale_sql(src: str, col: str, upper: float, out: str) -> str:
    """least(bround(upper * (x - lo) / (hi - lo), 2), 10); 5 if constant."""
    return f"""(SELECT s.*, CASE WHEN mm.hi = mm.lo THEN CAST(5.0 AS DOUBLE)
    ELSE least(round_even(CAST({upper} AS DOUBLE) * (s.{col} - mm.lo) / (mm.hi - mm.lo), 2), CAST(10.0 AS DOUBLE)) END AS {out}
  FROM {src} s, (SELECT min({col}) AS lo, max({col}) AS hi FROM {src}) mm)"""


def item_knn_ctes() -> list[str]:
    return q_ctes("bratings", "b") + [
        f"seen AS (SELECT DISTINCT itemId FROM bratings WHERE userId = {TARGET})",
        """iraw AS (SELECT a.itemId, sum(a.q * b.q) AS predictedScore
  FROM bq a JOIN bq b ON a.userId = b.userId JOIN seen ON b.itemId = seen.itemId
  WHERE a.itemId NOT IN (SELECT itemId FROM seen) GROUP BY a.itemId)""",
        f"iscaled AS {scale_sql('iraw', 'predictedScore', 5.0, 'totalScore')}",
        f"""iknn AS (SELECT CAST({TARGET} AS BIGINT) AS userId, itemId, predictedScore, totalScore
  FROM iscaled ORDER BY round(totalScore, 9) DESC, itemId LIMIT {TOP_N})""",
    ]


# Written out here, not taken from functions/text.py: what the pages hold.
_MARKUP = (r"(?s)<!--.*?-->", r"(?is)<(script|style|template)\b[^>]*>.*?</(script|style|template)\s*>",
           r"<[!?][^>]*>", r"</?[A-Za-z][^>]*>")
_PAGE_REFERENCES = (
    ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#34;", '"'), ("&#39;", "'"), ("&apos;", "'"),
    ("&nbsp;", " "), ("&#160;", " "), ("&middot;", "\u00b7"), ("&copy;", "\u00a9"), ("&reg;", "\u00ae"),
    ("&hellip;", "\u2026"), ("&mdash;", "\u2014"), ("&ndash;", "\u2013"), ("&laquo;", "\u00ab"),
    ("&raquo;", "\u00bb"))


def stripped_sql(col: str) -> str:
    """Tags gone, the pages' references decoded (the ampersand last; cut
    titles leave it bare)."""
    out = col
    for pattern in _MARKUP:
        out = f"regexp_replace({out}, {lit(pattern)}, '', 'g')"
    for entity, char in _PAGE_REFERENCES:
        out = f"replace({out}, {lit(entity)}, {lit(char)})"
    return f"regexp_replace({out}, '&amp;?', '&', 'g')"


def tidied_sql(col: str) -> str:
    space = (r"[\t\n\x0B\f\r\x1C-\x1F \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
             r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+")
    out = f"trim(regexp_replace({col}, {lit(space)}, ' ', 'g'))"
    return f"regexp_replace(replace({out}, '\"', ''), '[^\\x00-\\x7F]+', '', 'g')"


# What ``clean_text_markup`` puts before the pages, as it reads: written out.
_MARKUP_HEADS_READ = (
    "quoted ", "single ", "spaced ", "it's ", "never shut ", "onetwothreefour ",
    "1 < 2 &amp; 3 kept ", "after ", "plain ", "1 < 2 \ufffdand AA ")


def clean_text_sql(col: str) -> str:
    return tidied_sql(stripped_sql(col))


def lexicon_ctes() -> list[str]:
    return [
        f"""ltoks AS (SELECT DISTINCT doc_id, quality, token FROM (
    SELECT d.doc_id, l.quality, unnest(regexp_extract_all(lower(d.text), {lit(TOKEN)})) AS token
    FROM documents d JOIN labels l USING (doc_id)))""",
        """lcounts AS (SELECT token,
    CAST(sum(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS BIGINT) AS df1,
    CAST(sum(CASE WHEN quality = 0 THEN 1 ELSE 0 END) AS BIGINT) AS df0
  FROM ltoks GROUP BY token)""",
        """ldocs AS (SELECT CAST(sum(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS DOUBLE) AS d1,
    CAST(sum(CASE WHEN quality = 0 THEN 1 ELSE 0 END) AS DOUBLE) AS d0 FROM labels)""",
        """lex AS (SELECT token, df1, df0,
    ln((CAST(df1 AS DOUBLE) + 1.0) / (d1 + 2.0)) - ln((CAST(df0 AS DOUBLE) + 1.0) / (d0 + 2.0)) AS polarity
  FROM lcounts, ldocs WHERE df1 + df0 >= 1)""",
    ]


def sentence_ctes() -> list[str]:
    c = CUTS
    return lexicon_ctes() + [
        f"""sents AS (SELECT doc_id, unnest(s) AS sentence, unnest(generate_series(0, len(s) - 1)) AS pos
  FROM (SELECT doc_id, regexp_extract_all(text, {lit(SENTENCE)}) AS s FROM documents))""",
        f"""stoks AS (SELECT doc_id, pos, length(sentence) AS n_chars,
    unnest(regexp_extract_all(lower(sentence), {lit(TOKEN)})) AS token FROM sents)""",
        """sper AS (SELECT doc_id, pos, n_chars, count(*) AS n_tokens,
    avg(coalesce(lex.polarity, 0.0)) AS polarity
  FROM stoks LEFT JOIN lex USING (token) GROUP BY doc_id, pos, n_chars)""",
        f"""scls AS (SELECT *, CASE WHEN polarity < {c[0]} THEN 0 WHEN polarity < {c[1]} THEN 1
    WHEN polarity <= {c[2]} THEN 2 WHEN polarity <= {c[3]} THEN 3 ELSE 4 END AS class FROM sper)""",
    ] + document_ctes()


def document_ctes() -> list[str]:
    """Scores and labels of ``scls`` (doc_id, pos, n_chars, class), per document."""
    return [
        """sscore AS (SELECT *, CAST(CASE class WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 3 WHEN 3 THEN 4
      WHEN 4 THEN 5 ELSE 3 END AS DOUBLE) AS score,
    CASE WHEN class IN (0, 1) THEN 'NEGATIVE' WHEN class = 2 THEN 'NEUTRAL'
      WHEN class IN (3, 4) THEN 'POSITIVE' END AS label FROM scls)""",
        """sdoc AS (SELECT doc_id, count(*) AS n, CAST(sum(score) AS BIGINT) AS s,
    first(score ORDER BY n_chars DESC, pos) AS longest,
    first(score ORDER BY pos) AS firsts, first(label ORDER BY pos) AS firstl
  FROM sscore GROUP BY doc_id)""",
        """sentiment AS (SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_sentences,
    coalesce(CAST((200 * s + n) // (2 * n) AS DOUBLE) / CAST(100 AS DOUBLE), CAST(3.0 AS DOUBLE)) AS sentiment,
    coalesce(longest, CAST(3.0 AS DOUBLE)) AS sentiment_longest,
    coalesce(firsts, CAST(3.0 AS DOUBLE)) AS sentiment_first,
    coalesce(firstl, 'NEUTRAL') AS label_first
  FROM documents d LEFT JOIN sdoc USING (doc_id))""",
    ]


def scored_ctes() -> list[str]:
    """Sentence classes by the linear model of ``review_sentiment_scored``."""
    c, w = CUTS, SCORER
    return [
        f"""sents AS (SELECT doc_id, unnest(s) AS sentence, unnest(generate_series(0, len(s) - 1)) AS pos
  FROM (SELECT doc_id, regexp_extract_all(text, {lit(SENTENCE)}) AS s FROM documents))""",
        f"""sval AS (SELECT doc_id, pos, length(sentence) AS n_chars, {w['bias']}
    + {w['tokens']} * len(regexp_extract_all(sentence, {lit(TOKEN)})) + {w['characters']} * length(sentence)
    + {w['capitals']} * len(regexp_extract_all(sentence, '[A-Z]'))
    + {w['symbols']} * len(regexp_extract_all(sentence, '[#*$%&]')) AS v
  FROM sents WHERE regexp_matches(sentence, '\\p{{L}}'))""",
        f"""scls AS (SELECT doc_id, pos, n_chars, CASE WHEN v < {c[0]} THEN 0 WHEN v < {c[1]} THEN 1
    WHEN v <= {c[2]} THEN 2 WHEN v <= {c[3]} THEN 3 ELSE 4 END AS class FROM sval)""",
    ] + document_ctes()


def gd_ctes() -> list[str]:
    rank, seed = GD["rank"], GD["seed"]
    return [
        GRATINGS,
        f"""uf AS MATERIALIZED (SELECT u.userId AS id, t.k, {unit_hash_sql(['u.userId', 't.k'], seed)} AS f
  FROM (SELECT DISTINCT userId FROM gratings) u, range({rank}) t(k))""",
        f"""mf AS MATERIALIZED (SELECT i.itemId AS id, t.k, {unit_hash_sql(['i.itemId', 't.k'], seed + 7919)} AS f
  FROM (SELECT DISTINCT itemId FROM gratings) i, range({rank}) t(k))""",
        """pred AS MATERIALIZED (SELECT r.userId, r.itemId, r.rating, sum(uf.f * mf.f) AS dot
  FROM gratings r JOIN uf ON uf.id = r.userId JOIN mf ON mf.id = r.itemId AND mf.k = uf.k
  GROUP BY r.userId, r.itemId, r.rating)""",
        "err AS MATERIALIZED (SELECT userId, itemId, rating - dot AS e FROM pred)",
    ]


def gd_vector_ctes() -> list[str]:
    """Start factors as one list per id (a row each, so that no join can be
    ordered by factor position first), and each rating's error with both."""
    def vectors(key: str, seed: int) -> str:
        return f"""SELECT id, list(f ORDER BY k) AS f FROM (
    SELECT {key} AS id, t.k, {unit_hash_sql([key, 't.k'], seed)} AS f
    FROM (SELECT DISTINCT {key} FROM gratings), range({GD["rank"]}) t(k)) GROUP BY id"""
    return [
        GRATINGS,
        f"vu AS MATERIALIZED ({vectors('userId', GD['seed'])})",
        f"vm AS MATERIALIZED ({vectors('itemId', GD['seed'] + 7919)})",
        """gerr AS MATERIALIZED (
  SELECT r.userId, r.itemId, vu.f AS u, vm.f AS m, r.rating - list_dot_product(vu.f, vm.f) AS e
  FROM gratings r JOIN vu ON vu.id = r.userId JOIN vm ON vm.id = r.itemId)""",
    ]


def gd_rounds_ctes(rounds: int) -> list[str]:
    """``rounds`` descent rounds unrolled: uf{t}, mf{t} -> uf{t+1}, mf{t+1}
    (uf0 = uf, mf0 = mf from ``gd_ctes``)."""
    lam2, alpha = 2.0 * GD["lam"], GD["alpha"]
    ctes = ["uf0 AS (SELECT * FROM uf)", "mf0 AS (SELECT * FROM mf)"]
    for t in range(rounds):
        n = t + 1
        ctes += [
            f"""e{t} AS MATERIALIZED (SELECT r.userId, r.itemId, r.rating - sum(u.f * m.f) AS e
  FROM gratings r JOIN uf{t} u ON u.id = r.userId JOIN mf{t} m ON m.id = r.itemId AND m.k = u.k
  GROUP BY r.userId, r.itemId, r.rating)""",
            f"""ug{t} AS (SELECT p.userId AS id, u.k, avg(-2.0 * p.e * m.f + {lam2} * u.f) AS g
  FROM e{t} p JOIN uf{t} u ON u.id = p.userId JOIN mf{t} m ON m.id = p.itemId AND m.k = u.k
  GROUP BY p.userId, u.k)""",
            f"""mg{t} AS (SELECT p.itemId AS id, m.k, avg(-2.0 * p.e * u.f + {lam2} * m.f) AS g
  FROM e{t} p JOIN uf{t} u ON u.id = p.userId JOIN mf{t} m ON m.id = p.itemId AND m.k = u.k
  GROUP BY p.itemId, m.k)""",
            f"""uf{n} AS MATERIALIZED (SELECT u.id, u.k, u.f - {alpha} * g.g AS f
  FROM uf{t} u JOIN ug{t} g ON g.id = u.id AND g.k = u.k)""",
            f"""mf{n} AS MATERIALIZED (SELECT m.id, m.k, m.f - {alpha} * g.g AS f
  FROM mf{t} m JOIN mg{t} g ON g.id = m.id AND g.k = m.k)""",
        ]
    return ctes


def _oracles() -> dict[str, str]:
    h_reviews = unit_hash_sql(REVIEW_KEYS, SEED)
    h_split = unit_hash_sql(["userId", "itemId"], SEED)
    lam2, alpha, lam = 2.0 * GD["lam"], GD["alpha"], GD["lam"]
    pivot_cols = ",\n  ".join(
        f"coalesce(max(CASE WHEN rk = {k} THEN rating END), CAST(0.0 AS DOUBLE)) AS r{k}"
        for k in range(1, PIVOT_ITEMS + 1))
    return {
        "prepare_reviews": with_(REVIEWS, TREVIEWS) +
        "SELECT userId, itemId, rating, sentimentResult, creationDate FROM treviews",
        "dataset_stats": with_(REVIEWS) +
        "SELECT count(*) AS n_reviews, count(DISTINCT userId) AS n_users, "
        "count(DISTINCT itemId) AS n_items FROM reviews",
        "user_item_ratings": with_(REVIEWS, RATINGS) + "SELECT * FROM ratings",
        "blend_rating": with_(REVIEWS, BRATINGS) + "SELECT * FROM bratings",
        "seen_items": with_(REVIEWS, RATINGS) +
        "SELECT userId, count(DISTINCT itemId) AS n_seen FROM ratings GROUP BY userId",
        "user_similarity": with_(REVIEWS, RATINGS, *user_knn_ctes()) +
        "SELECT userId, round(dot, 6) AS dot, round(similarity, 6) AS similarity FROM sim2",
        "user_knn": with_(REVIEWS, RATINGS, *user_knn_ctes()) +
        "SELECT userId, itemId, round(totalScore, 6) AS totalScore FROM knn",
        "topn_per_user": with_(REVIEWS, BRATINGS) +
        f"""SELECT userId, itemId, rating, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY userId ORDER BY round(rating, 9) DESC, itemId) AS rank
  FROM bratings) WHERE rank <= {TOP_PER_USER}""",
        "item_similarity": with_(REVIEWS, RATINGS, *pair_ctes("ratings", "r")) +
        "SELECT item1, item2, round(similarity, 6) AS similarity FROM rpairs",
        "two_hop_scores": with_(REVIEWS, RATINGS, *pair_ctes("ratings", "r"),
                                """sym AS (SELECT item1 AS i, item2 AS j, similarity AS s FROM rpairs
  UNION ALL SELECT item2 AS i, item1 AS j, similarity AS s FROM rpairs)""",
                                "per AS (SELECT i AS j, sum(s) AS s_total, count(*) AS deg FROM sym GROUP BY i)",
                                """hraw AS (SELECT sym.i AS itemId, sum(sym.s * (per.s_total - sym.s)) AS predictedScore
  FROM sym JOIN per USING (j) GROUP BY sym.i HAVING sum(per.deg - 1) > 0)""",
                                f"hs AS {scale_sql('hraw', 'predictedScore', 10.0, 'NormalizedScore')}") +
        "SELECT itemId, round(predictedScore, 6) AS predictedScore, NormalizedScore FROM hs",
        "item_knn": with_(REVIEWS, BRATINGS, *item_knn_ctes()) +
        "SELECT userId, itemId, round(predictedScore, 6) AS predictedScore, totalScore FROM iknn",
        "unseen_pair_scores": with_(REVIEWS, BRATINGS, *pair_ctes("bratings", "b"),
                                    f"seen AS (SELECT DISTINCT itemId FROM bratings WHERE userId = {TARGET})",
                                    """uraw AS (SELECT item1 AS itemId, sum(similarity) AS predictedScore FROM bpairs
  WHERE item2 NOT IN (SELECT itemId FROM seen) GROUP BY item1)""",
                                    f"us AS {scale_sql('uraw', 'predictedScore', 5.0, 'NormalizedScore')}") +
        "SELECT itemId, round(predictedScore, 6) AS predictedScore, NormalizedScore FROM us",
        "pivot_ratings": with_(REVIEWS, RATINGS,
                               "counts AS (SELECT itemId, count(*) AS n FROM ratings GROUP BY itemId)",
                               f"""top AS (SELECT itemId, row_number() OVER (ORDER BY n DESC, itemId) AS rk
  FROM counts ORDER BY n DESC, itemId LIMIT {PIVOT_ITEMS})""") +
        f"SELECT userId,\n  {pivot_cols}\nFROM ratings LEFT JOIN top USING (itemId) GROUP BY userId",
        "dedupe_pairs": with_(REVIEWS, TREVIEWS) +
        """SELECT userId, itemId, creationDate, rating, sentimentResult, doc_id FROM (
  SELECT *, row_number() OVER (PARTITION BY userId, itemId
    ORDER BY creationDate DESC, rating DESC, sentimentResult DESC, doc_id DESC) AS rn
  FROM treviews) WHERE rn = 1""",
        "cap_per_user": f"""SELECT event_id, ts, user_id, event_type, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events)
WHERE rn <= {CAP_PER_USER}""",
        "split_valid_rows": """SELECT *, CASE WHEN event_id IS NOT NULL AND ts IS NOT NULL
  AND user_id IS NOT NULL AND value IS NOT NULL AND NOT isnan(value) AND NOT isinf(value)
  THEN 'valid' ELSE 'rejected' END AS part FROM events""",
        "index_ids": with_(REVIEWS, RATINGS) +
        """SELECT userId AS userId_original, CAST(dense_rank() OVER (ORDER BY userId) - 1 AS BIGINT) AS userId_index
FROM (SELECT DISTINCT userId FROM ratings)""",
        "index_ids_frequency": with_(REVIEWS) +
        """SELECT itemId AS itemId_original,
  CAST(row_number() OVER (ORDER BY n DESC, itemId) - 1 AS BIGINT) AS itemId_index
FROM (SELECT itemId, count(*) AS n FROM reviews GROUP BY itemId)""",
        "sample_fraction": with_(REVIEWS, TREVIEWS) +
        f"SELECT * FROM treviews WHERE {h_reviews} < {SAMPLE_FRACTION}",
        "sample_n": with_(REVIEWS, TREVIEWS) +
        f"""SELECT * FROM treviews ORDER BY {h_reviews}, userId, itemId, rating, sentimentResult,
  doc_id, creationDate LIMIT {SAMPLE_ROWS}""",
        "train_test_split": with_(REVIEWS, RATINGS) +
        f"SELECT *, CASE WHEN {h_split} < 0.8 THEN 'train' ELSE 'test' END AS split FROM ratings",
        "als_normal_equations": with_(REVIEWS, RATINGS) +
        "SELECT DISTINCT userId, CAST(0 AS DOUBLE) AS residual FROM ratings",
        "user_knn_batch": with_(
            REVIEWS, RATINGS,
            f"""own AS (SELECT userId AS target, itemId, rating AS t FROM ratings
  WHERE userId % 100 = {TARGET})""",
            """sim AS (SELECT target, r.userId, sum(r.rating * t) / (sqrt(sum(t * t)) * sqrt(sum(r.rating * r.rating))) AS s
  FROM ratings r JOIN own USING (itemId) WHERE r.userId <> target GROUP BY target, r.userId)""",
            """sc AS (SELECT target, r.itemId, avg(r.rating * s) AS score FROM ratings r JOIN sim USING (userId)
  WHERE NOT EXISTS (SELECT 1 FROM own o WHERE o.target = sim.target AND o.itemId = r.itemId)
  GROUP BY target, r.itemId)""",
            """ranked AS (SELECT *, row_number() OVER (PARTITION BY target ORDER BY round(score, 9) DESC, itemId) AS rank
  FROM sc)""") +
        f"""SELECT target AS userId, itemId, round(score, 6) AS totalScore, rank FROM ranked
WHERE rank <= {TOP_PER_USER}""",
        "clean_text_entities": f"""SELECT page_id, {tidied_sql(
            "'caf\u00e9 ' || chr((97 + page_id % 26)::INT) || chr((65 + page_id % 26)::INT) || ' &amp; &nosuch; \u00a9 \u2019<b> ' || "
            + stripped_sql("coalesce(html, '')"))} AS text FROM pages""",
        "split_rejected_rows": """WITH e AS (SELECT * REPLACE (
    CASE event_id % 50 WHEN 0 THEN NULL WHEN 1 THEN 'nan'::DOUBLE WHEN 2 THEN 'inf'::DOUBLE
      WHEN 3 THEN '-inf'::DOUBLE ELSE value END AS value,
    CASE WHEN event_id % 97 = 5 THEN NULL ELSE user_id END AS user_id) FROM events)
SELECT event_id, user_id, CASE WHEN event_id IS NOT NULL AND ts IS NOT NULL AND user_id IS NOT NULL
  AND event_type IS NOT NULL AND props IS NOT NULL AND value IS NOT NULL AND NOT isnan(value) AND NOT isinf(value)
  THEN 'valid' ELSE 'rejected' END AS part FROM e""",
        "csv_roundtrip": with_(REVIEWS, TREVIEWS) +
        """SELECT userId, itemId, rating, creationDate,
  'said "no", ' || doc_id || ', then "yes"' AS quote FROM treviews""",
        "csv_rejects": """SELECT CASE WHEN o_orderkey % 10 IN (3, 7) THEN 'reject' ELSE 'row' END AS kind,
  o_orderkey || ',' || o_custkey || CASE WHEN o_orderkey % 10 = 7 THEN '' ELSE ',4.5' END
  || CASE WHEN o_orderkey % 10 = 3 THEN ',more' ELSE '' END AS line FROM orders""",
        "csv_one_object": with_(REVIEWS, RATINGS) +
        "SELECT userId, count(DISTINCT itemId) AS n_seen FROM ratings GROUP BY userId",
        "csv_multiline": """SELECT o_orderkey::VARCHAR AS movieId, o_custkey::VARCHAR AS userId,
  CASE o_orderkey % 10 WHEN 3 THEN 'two' || chr(10) || 'lines, "and" three' || chr(10) || chr(10) || 'of them'
    WHEN 5 THEN 'plain goes on and on' WHEN 7 THEN 'quoted over, two' || chr(10) || 'lines' ELSE 'short' END AS quote,
  left(o_orderdate::VARCHAR, 10) AS creationDate, '8' AS rating FROM orders""",
        "seen_pairs": "SELECT DISTINCT o_custkey AS userId, l_partkey AS itemId"
                      " FROM lineitem JOIN orders ON l_orderkey = o_orderkey",
        "item_similarity_min": with_(REVIEWS, RATINGS, *pair_ctes("ratings", "r")) +
        f"SELECT item1, item2, round(similarity, 6) AS similarity FROM rpairs WHERE similarity >= {MIN_SIMILARITY}",
        "clean_text": f"SELECT page_id, {clean_text_sql('html')} AS text FROM pages",
        "clean_text_markup": f"""SELECT page_id, {tidied_sql(
            "[" + ", ".join(lit(h) for h in _MARKUP_HEADS_READ) + "][(page_id % 10 + 1)::INT] || "
            + stripped_sql("coalesce(html, '')")
            + " || CASE WHEN page_id % 7 = 3 THEN 'end shut ' ELSE '' END")} AS text FROM pages""",
        "polarity_lexicon": with_(*lexicon_ctes()) +
        "SELECT token, df1, df0, round(polarity, 9) AS polarity FROM lex",
        "sentence_scores": with_(*sentence_ctes()) +
        """SELECT doc_id, CAST(pos AS BIGINT) AS pos, CAST(n_chars AS BIGINT) AS n_chars, n_tokens,
  round(polarity, 9) AS polarity, CAST(class AS BIGINT) AS class, score, label FROM sscore""",
        "review_sentiment": with_(*sentence_ctes()) + "SELECT * FROM sentiment",
        "review_sentiment_scored": with_(*scored_ctes()) + "SELECT * FROM sentiment",
        "label_to_score": with_(*sentence_ctes()) +
        f"""SELECT doc_id, lower(label_first) AS label,
  round(CASE lower(label_first) WHEN 'positive' THEN CAST(4.0 AS DOUBLE) + {unit_hash_sql(['doc_id'], SEED)}
    WHEN 'neutral' THEN CAST(2.0 AS DOUBLE) + {unit_hash_sql(['doc_id'], SEED)}
    WHEN 'negative' THEN CAST(0.0 AS DOUBLE) + {unit_hash_sql(['doc_id'], SEED)}
    ELSE CAST(2.5 AS DOUBLE) END, 2) AS labelScore FROM sentiment""",
        "scored_reviews": with_(REVIEWS, TREVIEWS, *sentence_ctes()) +
        """SELECT r.doc_id, r.userId, r.itemId, r.rating,
  coalesce(s.sentiment, CAST(3.0 AS DOUBLE)) AS sentimentResult, r.creationDate
FROM treviews r LEFT JOIN sentiment s USING (doc_id)""",
        "blend_recommendations": with_(REVIEWS, RATINGS, BRATINGS, *user_knn_ctes(), *item_knn_ctes()) +
        """SELECT userId, itemId,
  round((coalesce(knn.totalScore, 0.0) + coalesce(iknn.totalScore, 0.0)) / 2.0, 6) AS totalScore
FROM knn FULL OUTER JOIN iknn USING (userId, itemId)""",
        "mf_loss": with_(REVIEWS, *gd_ctes()) +
        f"""SELECT round(sse, 5) AS sse, round(reg, 5) AS reg, round(sse + reg, 5) AS loss FROM (
  SELECT (SELECT sum(e * e) FROM err) AS sse,
         {lam} * ((SELECT sum(f * f) FROM uf) + (SELECT sum(f * f) FROM mf)) AS reg)""",
        "mf_gradient_step": with_(REVIEWS, *gd_vector_ctes()) +
        f"""SELECT side, id, CAST(k AS BIGINT) AS k, round(value, 8) AS value FROM (
  SELECT 'u' AS side, userId AS id, k, any_value(u[k + 1]) - {alpha} * avg(-2.0 * e * m[k + 1] + {lam2} * u[k + 1]) AS value
  FROM gerr, range({GD["rank"]}) t(k) GROUP BY userId, k
  UNION ALL
  SELECT 'm' AS side, itemId AS id, k, any_value(m[k + 1]) - {alpha} * avg(-2.0 * e * u[k + 1] + {lam2} * m[k + 1]) AS value
  FROM gerr, range({GD["rank"]}) t(k) GROUP BY itemId, k)""",
        "mf_recommend_batch": with_(
            REVIEWS, *gd_vector_ctes(),
            f"""bsc AS (SELECT vu.id AS userId, vm.id AS itemId, list_dot_product(vu.f, vm.f) AS score
  FROM vu, vm WHERE vu.id % 100 = {TARGET}
    AND NOT EXISTS (SELECT 1 FROM gratings g WHERE g.userId = vu.id AND g.itemId = vm.id))""",
            """btop AS (SELECT *, row_number() OVER (
    PARTITION BY userId ORDER BY round(score, 9) DESC, itemId) AS rank FROM bsc WHERE score > 0)""") +
        f"""SELECT userId, itemId, round(least(greatest(score, 0.0), 5.0), 2) AS totalScore, rank
FROM btop WHERE rank <= {BATCH_TOP}""",
        "mf_recommend": with_(REVIEWS, *gd_ctes(), *gd_rounds_ctes(GD_ROUNDS),
                              f"""gsc AS (SELECT m.id AS itemId, sum(m.f * u.f) AS score
  FROM mf{GD_ROUNDS} m JOIN (SELECT k, f FROM uf{GD_ROUNDS} WHERE id = {TARGET}) u USING (k) GROUP BY m.id)""",
                              f"""gtop AS (SELECT itemId, score FROM gsc
  WHERE score > 0 AND itemId NOT IN (SELECT itemId FROM gratings WHERE userId = {TARGET})
  ORDER BY round(score, 9) DESC, itemId LIMIT {TOP_N})""") +
        f"""SELECT CAST({TARGET} AS BIGINT) AS userId, itemId,
  round(least(greatest(score, 0.0), 5.0), 2) AS totalScore FROM gtop""",
        "score_items": with_(REVIEWS, *gd_ctes()) +
        f"""SELECT CAST({TARGET} AS BIGINT) AS userId, mf.id AS itemId,
  round(least(greatest(sum(u.f * mf.f), 0.0), 5.0), 6) AS score
FROM mf JOIN (SELECT k, f FROM uf WHERE id = {TARGET}) u USING (k) GROUP BY mf.id""",
    }


ORACLES = _oracles()
