"""Spelling variants against edits tried one by one."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from reelrank.llm import variants
from tests.llm.conftest import ODD

SF = "/root/testdata/sf0.001"


def one_edit(a, b):
    """Exactly one insertion, deletion or replacement."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def vocabulary(rows, least=3):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    n = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = run.translate(lower)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= 5 and c >= least}


def brute(n):
    # words at one edit share a string with one character dropped
    by = {}
    for w in n:
        for x in {w, *(w[:i] + w[i + 1:] for i in range(len(w)))}:
            by.setdefault(x, []).append(w)
    near = {w: set() for w in n}
    for ws in by.values():
        for a in ws:
            near[a].update(b for b in ws if b not in near[a] and one_edit(a, b))
    form = {}
    for w, c in n.items():
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 2 * c else None
    out = []
    for w, c in n.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, c, len(near[w]), n.get(form[w])))
    return sorted(out, key=lambda r: r[0])


def random_words(k, alphabet="abé", seed=2, lengths=(5, 9)):
    rng = random.Random(seed)
    words = {"".join(rng.choice(alphabet) for _ in range(rng.randint(*lengths))) for _ in range(k)}
    return {w: rng.choice([3, 4, 6, 8, 8, 20, 100]) for w in words}


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: r[0])


def test_index_finds_every_word_at_one_edit():
    words = sorted(random_words(300)) + ["b" * 40, "b" * 41, "zzzzzzzzzzzzzzzzzzzzzzz"]
    index = variants.SuffixRanks(words)
    length = np.array([len(w) for w in words])
    got = {tuple(x) for x in zip(*index.near(words, np.zeros(len(words), int), length))}
    assert got == {(i, j) for i, a in enumerate(words) for j, b in enumerate(words)
                   if one_edit(a, b)}
    first, last = length // 3, 2 * length // 3
    inside = {(i, j) for i, j in got if any(
        words[i][:p] == words[j][:p] and words[i][p + d:] == words[j][p + e:]
        for d, e in ((0, 1), (1, 0), (1, 1)) for p in range(first[i], last[i] + 1)
        if p + d <= last[i])}
    assert {tuple(x) for x in zip(*index.near(words, first, last))} == inside


def test_suffix_ranks_are_in_order():
    words = ["banana", "bananas", "ananab", "x" * 30, "x" * 31, "a"]
    index = variants.SuffixRanks(words)
    turned = [w[::-1] for w in words]
    suffixes = sorted((t[i:], k) for k, t in enumerate(turned) for i in range(len(t) + 1))
    assert index.string.tolist() == [k for _, k in suffixes]


@pytest.mark.parametrize("part_rows,hot_rows", [(40_000, 20_000), (50, 8)])
def test_near_words_whole_and_in_refined_parts(spark, part_rows, hot_rows):
    n = {**random_words(700), **{"a" * k: 5 for k in (5, 6, 7, 30)},
         **{"sharedhalf" + w: c for w, c in random_words(60, "xyz", 3, (4, 12)).items()}}
    words = spark.createDataFrame(list(n.items()), "word string, n long")
    got = {r["word"]: (r["n_near"], r["best_n"], r["best"])
           for r in variants.near_words(words, part_rows, hot_rows).collect()}
    expected = {}
    for w in n:
        near = [x for x in n if one_edit(w, x)]
        if near:
            best = min(near, key=lambda x: (-n[x], x))
            expected[w] = (len(near), n[best], best)
    assert got == expected


def test_equals_brute_force_on_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    expected = brute(vocabulary(rows))
    assert sum(r[1] is not None for r in expected) > 100
    assert result(variants.spelling_variants(docs)) == expected


def test_roots_follow_chains(spark):
    chain = [(f"w{i}", f"w{i + 1}") for i in range(37)] + [("a", "w3"), ("b", "c")]
    got = dict(map(tuple, variants.roots(
        spark.createDataFrame(chain, "word string, form string")).collect()))
    assert got == {**{f"w{i}": "w37" for i in range(37)}, "a": "w37", "b": "c"}


def test_odd_rows_ties_and_no_rows(spark, make, odd, none):
    ties = [(i, "words worda wordb swords " * k + "Éclair éclair ÉCLAIR" + "q" * 5000)
            for i, k in ((1, 1), (1, 1), (None, 2), (2, 3))]
    rows = [*ODD, *ties, (None, None), (5, "")]
    assert result(variants.spelling_variants(make(rows), least=1)) == brute(vocabulary(rows, 1))
    assert result(variants.spelling_variants(odd)) == brute(vocabulary(ODD))
    assert variants.spelling_variants(none).count() == 0
