"""Quality rules as a bitmask ledger, in SQL functions only.

Every rule is evaluated once per document; the ledger keeps the measurements
and one bit per failed rule. A policy is a versioned mask of the rules that
reject; applying one, or asking what a rule alone removes, reads the ledger
and no text.

Cases: null and empty texts have no words and fail ``few_words``; rows with
equal or null ids are independent; an empty table gives an empty ledger (and
no ablation rows but the policy's own, with zeros); extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from reelrank.llm.common import SPACES

SYMBOLS = "#*$%&|<>"
_WINDOW = 5

# Bit positions are part of the ledger's format: append, never renumber.
RULES: dict[str, str] = {
    "few_words": "n_words < 10",
    "repeats": "100 * n_repeat_words > 20 * n_words",
    "symbols": "10 * n_symbols > 12 * n_words",
    "word_length_low": "word_chars < 2 * n_words",
    "word_length_high": "word_chars > 15 * n_words",
    "repeated_lines": "n_dup_lines >= 3 and 10 * n_dup_lines > 3 * n_lines",
    "shouting": "2 * n_bangs > n_words",
}
# What a version rejects. v1: the base rules alone.
POLICIES: dict[str, tuple[str, ...]] = {
    "v1": ("few_words", "repeats"),
    "v2": tuple(RULES),
}
BASE = "v1"
CURRENT = "v2"


def bit(rule: str) -> int:
    return 1 << list(RULES).index(rule)


def mask(policy: str) -> int:
    return sum(bit(r) for r in POLICIES[policy])


MEASURES = ["n_words", "word_chars", "n_symbols", "n_bangs", "n_lines", "n_dup_lines", "n_repeat_words"]


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` plus n_words, word_chars, n_symbols, n_bangs, n_lines, n_dup_lines,
    n_repeat_words (all long).

    n_repeat_words: words inside 5-word windows that the text holds twice or
    more. Window hashes come first: if all differ, so do the windows.
    Otherwise the windows themselves are sorted with their places;
    neighbours that are equal mark both, and the marked spans are summed."""
    t = F.coalesce(F.col(text), F.lit(""))
    bare = F.translate(t, SPACES, "")
    lines = F.filter(F.split(t, "\n"),
                     lambda x: F.length(F.translate(x, SPACES, "")) > 0)
    out = docs.withColumns({
        "_words": F.filter(F.split(t, r"[\x20\x09-\x0D]+"), lambda w: w != ""),
        "_lines": lines,
        "word_chars": F.length(bare).cast("long"),
        "n_bangs": (F.length(t) - F.length(F.translate(t, "!", ""))).cast("long"),
        "n_symbols": (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("long"),
    })
    out = out.withColumns({
        "n_words": F.size("_words").cast("long"),
        "n_lines": F.size("_lines").cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "_hashes": F.transform("_words", lambda w: F.xxhash64(w)),
    })
    last = F.size("_words") - _WINDOW
    starts = F.sequence(F.lit(0), last)
    out = out.withColumn("_keys", F.when(last >= 1, F.transform(
        starts, lambda i: F.xxhash64(*[F.get("_hashes", i + k) for k in range(_WINDOW)]))))
    repeats = F.size(F.array_distinct("_keys")) < F.size("_keys")
    out = out.withColumn("_sorted", F.when(repeats, F.array_sort(F.transform(
        starts, lambda i: F.struct(
            F.array_join(F.slice("_words", i + 1, _WINDOW), " ").alias("w"), i.alias("i"))))))
    held = F.col("_sorted")

    def same(x: Column, j: Column) -> Column:
        before, after = F.get(held, j - 1)["w"], F.get(held, j + 1)["w"]
        return (before == x["w"]) | (after == x["w"])

    marked = F.filter(held, lambda x, j: F.coalesce(same(x, j), F.lit(False)))
    out = out.withColumn("_places", F.array_sort(F.transform(marked, lambda x: x["i"])))
    places = F.col("_places")
    spans = F.transform(places, lambda p, j: F.least(
        F.lit(_WINDOW), F.coalesce(F.get(places, j + 1) - p, F.lit(_WINDOW))))
    covered = F.aggregate(spans, F.lit(0).cast("long"), lambda a, s: a + s)
    out = out.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long"))
    # through a generator: a later filter on a measurement is not pushed below
    # it, where it would repeat the expressions above once per use
    one = F.struct(*[F.col(c) for c in MEASURES])
    return out.select(*[F.col(c) for c in docs.columns], F.inline(F.array(one)))


def failures() -> Column:
    bits = [F.when(F.expr(e), F.lit(bit(r))).otherwise(F.lit(0)) for r, e in RULES.items()]
    out = bits[0]
    for b in bits[1:]:
        out = out.bitwiseOR(b)
    return out.cast("long")



def ledger(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, the measurements, ``failed`` (one bit per rule)."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return (measure(rows).withColumn("failed", failures())
            .select("doc_id", *MEASURES, "failed"))


def passes(policy: str = CURRENT) -> Column:
    return F.col("failed").bitwiseAND(F.lit(mask(policy))) == 0


def ablation(book: DataFrame, policy: str = CURRENT) -> DataFrame:
    """For each rule of a policy: rule, n_failed, n_only (rejected by it
    alone), n_kept_without (kept if it were dropped). One aggregate."""
    every = mask(policy)
    failed = F.col("failed").bitwiseAND(F.lit(every))
    sums = []
    for r in POLICIES[policy]:
        b = bit(r)
        sums += [F.count_if(failed.bitwiseAND(F.lit(b)) != 0).alias(f"{r}__failed"),
                 F.count_if(failed == b).alias(f"{r}__only"),
                 F.count_if(failed.bitwiseAND(F.lit(every & ~b)) == 0).alias(f"{r}__without")]
    one = book.agg(*sums)
    rows = F.array(*[F.struct(
        F.lit(r).alias("rule"), F.col(f"{r}__failed").alias("n_failed"),
        F.col(f"{r}__only").alias("n_only"), F.col(f"{r}__without").alias("n_kept_without"))
        for r in POLICIES[policy]])
    return one.select(F.inline(rows))


def kept_rows(docs: DataFrame, text: str = "text", policy: str = CURRENT) -> DataFrame:
    """The rows of ``docs`` that a policy keeps, columns as given."""
    rows = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("_doc"),
                       F.col(text).alias("text"))
    return (measure(rows).withColumn("failed", failures()).where(passes(policy))
            .select("_doc.*"))
