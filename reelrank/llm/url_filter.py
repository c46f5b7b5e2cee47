"""URL filters: rules first, then a classifier over segmented hosts.

Host labels are often words run together. A unigram model over the words of
the table's own texts splits them by Viterbi; a multinomial naive Bayes model
over the segmented host and path tokens, trained on the urls that a rule has
judged plus seed terms, judges the rest.

Both models are whole tables, of every word and every token, and reach the
urls by joins: the substrings of each distinct host or path part meet the word
counts, the tokens of each url meet the token weights. Nothing is cut to a
size, so the verdict of a url does not depend on how many words there are.

Cases: a null url, or one without ``://``, has an empty host and path, no
rule, and the verdict allow; rows with equal or null ids are
judged each on their own; without judged urls of both classes only the seed
terms speak; ties allow; an empty table gives no rows; extra columns are
ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from reelrank.llm.common import skew_lookup, written

# The rules (verdict, host and path prefix).
RULES = (("block", "net/"), ("allow", "example.net/en/"),
         ("block", "example.com/de/"), ("allow", "org/fr/"))
# Seed terms, of general knowledge: what hosts that blocklists name, or that
# they never do, are often called; each counts as SEED_WEIGHT words of the
# texts and as many tokens of judged urls.
BLOCK_TERMS = ("adult", "casino", "cheap", "farm", "pills", "porn", "spam", "viagra", "win", "x")
ALLOW_TERMS = ("blog", "docs", "edu", "gov", "journal", "library", "news", "science", "wiki", "www")
SEED_WEIGHT = 20
# Log odds above which a url is blocked, and the longest word.
MARGIN, MAX_WORD_LEN = 2.0, 24
_PART = "[a-z]+|[0-9]+"


def host_of(url: str) -> Column:
    """The host with A-Z in lower case; empty without ``://``."""
    rest = F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: str) -> Column:
    """From the host's end up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_for(host: Column, path: Column) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, null without one."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, text in sorted(RULES, key=lambda r: (len(r[1]), r[1])):
        name, _, rest = text.partition("/")
        fits = ((host == name) | F.endswith(host, F.lit("." + name))) \
            & F.startswith(path, F.lit("/" + rest))
        rule = F.when(fits, F.lit(text)).otherwise(rule)
        verdict = F.when(fits, F.lit(what)).otherwise(verdict)
    return rule, verdict


# --- word segmentation -------------------------------------------------------

def word_counts(texts: DataFrame, text: str) -> tuple[DataFrame, float]:
    """(w, n) of every word of two to 24 letters in a text column, seed terms
    added, and what the counts sum to."""
    spark = texts.sparkSession
    words = F.explode(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), r"[^a-z]+"))
    counted = (texts.select(words.alias("w")).where(f"length(w) between 2 and {MAX_WORD_LEN}")
               .groupBy("w").agg(F.count("*").alias("n")))
    seeds = spark.createDataFrame([(t, SEED_WEIGHT) for t in (*BLOCK_TERMS, *ALLOW_TERMS)],
                                  "w string, n long")
    counts = written(counted.union(seeds).groupBy("w").agg(F.sum("n").alias("n")), "url-words")
    return counts, float(counts.agg(F.sum("n")).first()[0] + 1)


def split_name(name: str, counts: dict[tuple[int, int], int], total: float) -> list[str]:
    """The likeliest words of ``name``, of equal ones the longest first word.
    ``counts``: of each known word in it, by place and length; other strings
    cost by their length."""
    n = len(name)
    best, step = [0.0] * (n + 1), [n] * (n + 1)
    for i in range(n - 1, -1, -1):
        best[i], step[i] = -math.inf, i + 1
        for size in range(min(n - i, MAX_WORD_LEN), 0, -1):
            c = counts.get((i, size))
            p = -math.log(total) - 2.5 * size if c is None else math.log(c / total)
            if p + best[i + size] > best[i]:
                best[i], step[i] = p + best[i + size], i + size
    out, i = [], 0
    while i < n:
        out.append(name[i:step[i]])
        i = step[i]
    return out


def _split_task(total: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [split_name(name, {(k["at"], k["size"]): k["n"] for k in known or ()}, total)
                     for name, known in zip(*(c.to_pylist() for c in batch.columns))]
            yield pa.RecordBatch.from_pydict({
                "part": batch.column(0), "words": pa.array(words, pa.list_(pa.string()))})
    return run


def segmented(parts: DataFrame, counts: DataFrame, total: float) -> DataFrame:
    """part, words of every distinct ``part`` (letters), written."""
    length = F.length("part")
    at = F.explode(F.sequence(F.lit(1), length)).alias("at")
    size = F.explode(F.when(length - F.col("at") >= 1, F.sequence(
        F.lit(2), F.least(F.lit(MAX_WORD_LEN), length - F.col("at") + 1)))).alias("size")
    strings = (parts.where(length > 1).select("part", at).select("part", "at", size)
               .withColumn("w", F.substring(F.col("part"), F.col("at"), F.col("size"))))
    uses = strings.groupBy("w").agg(F.count("*").alias("uses"))
    known = skew_lookup(strings, counts.join(uses, "w"), ["w"], "uses", ["part", "at"])
    found = known.where("n is not null").groupBy("part").agg(F.collect_list(F.struct(
        (F.col("at") - 1).alias("at"), "size", "n")).alias("known"))
    return written(parts.join(found, "part", "left").mapInArrow(
        _split_task(total), "part string, words array<string>"), "url-parts")


def url_parts(urls: DataFrame) -> DataFrame:
    """_row, kind, part of each (_row, host, path, rule): runs of letters or
    digits of the host's labels (kind h), without the top-level one and those
    that the rule names, and of the path (kind p)."""
    labels = F.split("host", r"\.")
    named = F.coalesce(F.size(F.split(F.substring_index("rule", "/", 1), r"\.")), F.lit(1))
    named = F.when(F.col("rule").isNull(), 1).otherwise(named)
    own = F.when(F.size(labels) > 1, F.slice(labels, F.lit(1), F.greatest(F.size(labels) - named, F.lit(0)))) \
        .otherwise(labels)
    host = F.flatten(F.transform(own, lambda x: F.regexp_extract_all(x, F.lit(_PART), 0)))
    path = F.regexp_extract_all(F.lower("path"), F.lit(_PART), 0)

    def marked(kind: str, parts: Column) -> Column:
        return F.transform(parts, lambda x: F.struct(F.lit(kind).alias("kind"), x.alias("part")))

    both = F.concat(marked("h", host), marked("p", path))
    return urls.select("_row", F.explode(both).alias("x")).select("_row", "x.*")


def url_tokens(urls: DataFrame, counts: DataFrame, total: float) -> DataFrame:
    """_row, token of every url, written: segmented words, numbers by their
    length, marked by host or path."""
    parts = written(url_parts(urls), "url-part-rows")
    letters = F.col("part").rlike("^[a-z]")
    sizes = parts.where(letters).groupBy("part").agg(F.count("*").alias("uses"))
    words = segmented(sizes.select("part"), counts, total)
    rows = skew_lookup(parts, sizes.join(words, "part"), ["part"], "uses", ["_row"])
    number = F.array(F.concat(F.lit("#"), F.length("part").cast("string")))
    token = F.explode(F.when(letters, F.col("words")).otherwise(number))
    return written(rows.select("_row", "kind", token.alias("t")).select(
        "_row", F.concat("kind", F.lit(":"), "t").alias("token")), "url-tokens")


# --- naive Bayes ---------------------------------------------------------------

def token_weights(tokens: DataFrame, judged: DataFrame) -> DataFrame:
    """token, weight: log odds of block against allow by multinomial counts,
    add one, over every token of the judged urls (_row, verdict) and the
    seeds. Both classes are equally likely beforehand: the share of urls that
    rules block says nothing about those that no rule names."""
    spark = tokens.sparkSession
    seeds = spark.createDataFrame(
        [("h:" + t, SEED_WEIGHT * (v == "block"), SEED_WEIGHT * (v == "allow"))
         for v, terms in (("block", BLOCK_TERMS), ("allow", ALLOW_TERMS)) for t in terms],
        "token string, block long, allow long")
    own = [F.sum(F.when(F.col("verdict") == v, 1).otherwise(0)).alias(v) for v in ("block", "allow")]
    counts = written(tokens.join(judged, "_row").groupBy("token").agg(*own).union(seeds)
                     .groupBy("token").agg(F.sum("block").alias("block"), F.sum("allow").alias("allow")),
                     "url-token-counts")
    sums = counts.agg(F.sum("block").alias("block"), F.sum("allow").alias("allow"),
                      F.count("*").alias("n")).first()
    base = math.log(sums["allow"] + sums["n"] + 1) - math.log(sums["block"] + sums["n"] + 1)
    return counts.select("token", (F.log(F.col("block") + 1) - F.log(F.col("allow") + 1)
                                   + F.lit(base)).alias("weight"))


def log_odds(tokens: DataFrame, weights: DataFrame) -> DataFrame:
    """_row, odds: sums of the weights of each url's tokens; tokens that no
    judged url has say nothing."""
    uses = tokens.groupBy("token").agg(F.count("*").alias("uses"))
    rows = skew_lookup(tokens, weights.join(uses, "token"), ["token"], "uses", ["_row"])
    return rows.groupBy("_row").agg(F.round(F.sum("weight"), 9).alias("odds"))


def judge(pages: DataFrame, texts: DataFrame, id_col: str = "page_id", url: str = "url",
          text: str = "text") -> DataFrame:
    """page_id, host, path, rule, verdict for every row of ``pages``; the
    words for segmentation come from ``texts``."""
    urls = pages.select(F.col(id_col).cast("long").alias("page_id"),
                        host_of(url).alias("host"), path_of(url).alias("path"))
    rule, verdict = rule_for(F.col("host"), F.col("path"))
    urls = written(urls.withColumns({"rule": rule, "verdict": verdict})
                   .withColumn("_row", F.monotonically_increasing_id()), "urls")
    tokens = url_tokens(urls, *word_counts(texts, text))
    weights = token_weights(tokens, urls.where("verdict is not null").select("_row", "verdict"))
    open_urls = tokens.join(urls.where("verdict is null").select("_row"), "_row", "left_semi")
    return (urls.join(log_odds(open_urls, weights), "_row", "left")
            .select("page_id", "host", "path", "rule", F.coalesce(
                "verdict", F.when(F.col("odds") > MARGIN, "block").otherwise("allow")).alias("verdict")))
