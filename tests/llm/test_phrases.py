"""Phrase mining against plain counting."""

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from reelrank.llm import phrases
from tests.llm.conftest import ODD

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def counted(rows):
    """(lang, phrase) -> occurrences, and words per language."""
    f, n = Counter(), Counter()
    for lang, t in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (t or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for m in range(1, 6):
                for i in range(len(words) - m + 1):
                    f[lang, " ".join(words[i:i + m])] += 1
    return f, n


def brute(rows, least, top):
    f, n = counted([("und" if lang is None else lang, t) for lang, t in rows])
    often = {k: a for k, a in f.items() if a >= least}
    out = {}
    for (lang, p), a in often.items():
        w = p.split(" ")
        if len(w) < 2 or any(g == lang and 100 * b >= 100 * a and len(q) > len(p)
                             and f" {p} " in f" {q} " for (g, q), b in often.items()):
            continue
        cuts = []
        for k in range(1, len(w)):
            left, r = f[lang, " ".join(w[:k])], f[lang, " ".join(w[k:])]
            cuts.append((1000 * a * n[lang] // (left * r), k, left, r))
        score, _, left, r = min(cuts)
        out.setdefault(lang, []).append((-score, -a, p.encode(), p, a, left, r, n[lang], score))
    return sorted((lang, i + 1, *x[3:]) for lang, xs in out.items()
                  for i, x in enumerate(sorted(xs)[:top]))


def texts(seed=5, rows=400):
    rng = np.random.default_rng(seed)
    words = ["the", "The", "of", "a", "red", "fox", "ran", "é", "x　y", "b-c", "to", "be"]
    joins = [" ", " ", " ", "  ", "\t", ". ", "\n", ", ", "\x0b", "\r\n", "!?"]
    p = rng.dirichlet(np.ones(len(words)) * 0.7)
    out = []
    for i in range(rows):
        t = "".join(rng.choice(words, p=p) + rng.choice(joins) for _ in range(rng.integers(0, 40)))
        if i % 9 == 0:
            t += " once upon a time there was"
        out.append((i, [None, "en", "fr", ""][i % 4] if i % 3 else "en", t))
    return out + [(None, None, None), (3, "en", ""), (3, "en", None)]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, 1, "z") for i, lang, t in rows],
                                 "doc_id long, text string, lang string, f int, phrase string")


def test_equals_plain_counting(spark):
    rows = texts()
    got = phrases.collocations(frame(spark, rows), least=20, top=9).collect()
    expected = brute([(lang, t) for _, lang, t in rows], 20, 9)
    assert sorted(tuple(r) for r in got) == expected and len(expected) > 20


@pytest.mark.parametrize("share", [0.0, 0.01])
def test_border_failures_are_closed(spark, share):
    rows = texts(6)
    docs = frame(spark, rows)
    found, totals, failures = phrases.frequent_phrases(docs, least=15, share=share)
    assert failures > 0
    f, n = counted([("und" if lang is None else lang, t) for _, lang, t in rows])
    got = {(r["lang"].decode(), r["phrase"].decode()): r["f"] for r in found.collect()}
    assert got == {k: a for k, a in f.items() if a >= 15}
    assert {r["lang"].decode(): r["n"] for r in totals.collect()} == {k: v for k, v in n.items() if v}


def test_longer_phrases_around_failures_are_found(spark):
    # a passage of words that occur nowhere else, repeated in few documents:
    # the sample sees none of it, so each of its words is a failure
    rows = [(i, "en", "a b c d e f. " * 3) for i in range(300)]
    rows += [(1000, "en", "nowhere else do these words stand a b. " * 30)]
    found, _, failures = phrases.frequent_phrases(frame(spark, rows), least=30, share=0.0)
    f, _ = counted([("en", t) for _, _, t in rows])
    got = {r["phrase"].decode(): r["f"] for r in found.collect()}
    assert got == {p: a for (_, p), a in f.items() if a >= 30}
    assert "stand a b" in got and "do these words stand a" in got


def test_a_good_sample_needs_no_second_pass(spark):
    rows = [(i, "en", "one two three four five six. one two") for i in range(400)]
    assert phrases.frequent_phrases(frame(spark, rows), least=100, share=0.5)[2] == 0


class Value:
    def __init__(self, value):
        self.value = value


class Only:
    """A bitmap of a few phrases."""

    def __init__(self, *names):
        self.hashes = [hash_of("en", x) for x in names]

    def has(self, hashes):
        return np.isin(hashes, self.hashes)


EVERY = phrases.Bitmap(8, np.full(1, 255, np.uint8))


def hash_of(lang, phrase):
    words = phrase.encode().split(b" ")
    each = phrases.word_hashes([lang.encode()] * len(words), words)
    out = each[:1]
    for x in each[1:]:
        out = phrases.longer_hash(out, np.array([x]))
    return out[0]


def batch_of(rows):
    return pa.RecordBatch.from_pydict({
        "lang": pa.array([a.encode() for a, _ in rows], pa.binary()),
        "t": pa.array([t.encode() for _, t in rows], pa.binary())})


def by_text(rows, proposed, frequent, failed):
    out = Counter()
    for b in phrases._text_task(*map(Value, (proposed, frequent, failed)))([batch_of(rows)]):
        for lang, p, c in zip(*(x.to_pylist() for x in b.columns)):
            out[lang.decode(), p.decode()] += c
    return out


def by_hash(rows, proposed, level=None):
    out = Counter()
    for b in phrases._hash_task(Value(proposed), level)([batch_of(rows)]):
        for k, c in zip(*(x.to_pylist() for x in b.columns)):
            out[k] += c
    return out


def key_of(lang, p):
    return int(np.array([(int(hash_of(lang, p)) & ~7) | len(p.split(" "))], np.uint64).view(np.int64)[0])


def test_long_texts_are_counted_across_chunks(monkeypatch):
    rows = [("en", t or "") for _, t in ODD] + [("fr", "a b c d e f g " * 50)]
    f, n = counted(rows)
    keys = Counter({key_of(*k): c for k, c in f.items()})
    f.update({(k, ""): v for k, v in n.items() if v})
    for tokens, slices in ((10**6, 10**6), (40, 30), (7, 1), (1000, 100)):
        monkeypatch.setattr(phrases, "CHUNK_TOKENS", tokens)
        monkeypatch.setattr(phrases, "SLICE_BYTES", slices)
        assert by_text(rows, EVERY, EVERY, EVERY) == f
        assert by_hash(rows, EVERY) == keys


def test_passes_count_the_border_and_then_around_failures():
    rows = [("en", "a b c a b c a b d")]
    words = {"a": 3, "b": 3, "c": 2, "d": 1}
    key = lambda x: {key_of("en", p): c for p, c in x.items()}
    assert by_hash(rows, Only("a", "b")) == key({**words, "a b": 3})
    assert by_hash(rows, None, level=1) == key(words)
    assert by_hash(rows, Only("a", "b"), level=2) == key({"a b": 3})
    second = by_text(rows, Only("a", "b"), Only("a", "b", "c", "a b"), Only("c", "a b"))
    assert second == Counter({("en", p): c for p, c in {
        "": 9, "a": 3, "b": 3, "c": 2, "a b": 3, "b c": 2, "c a": 2, "a b c": 2, "b c a": 2,
        "c a b": 2, "a b c a": 2, "b c a b": 2, "c a b c": 1, "a b c a b": 2, "b c a b c": 1,
        "c a b c a": 1, "a b d": 0, "c a b d": 0}.items() if c})


def test_equal_hashes_do_not_change_counts(spark, monkeypatch):
    # every phrase has one of sixteen hashes: most of what is counted by hash
    # is wrong, what is returned is not
    monkeypatch.setattr(phrases, "longer_hash", lambda a, b: (a + b) & np.uint64(0xF0 << 56))
    rows = texts(8)
    batch = [(("und" if lang is None else lang), t or "") for _, lang, t in rows]
    f, n = counted(batch)
    f.update({(k, ""): v for k, v in n.items() if v})
    assert by_text(batch, EVERY, EVERY, EVERY) == f


def test_bitmap_agrees_with_the_tasks_hash(spark):
    keys = [key_of("en", f"w{i} \u00fc{i}") for i in range(500)]
    bitmap = phrases.Bitmap(phrases.bits_for(250))
    bitmap.add(spark.createDataFrame([(k,) for k in keys[::2]], "key long"))
    has = bitmap.has(np.array(keys).view(np.uint64))
    assert has[::2].all() and has[1::2].mean() < 0.05


def test_odd_rows_and_no_rows(spark, odd, none):
    with_lang = odd.selectExpr("*", "cast(null as string) as lang")
    got = phrases.collocations(with_lang, least=3, top=5).collect()
    assert [tuple(r) for r in got] == brute([(None, t) for _, t in ODD], 3, 5)
    assert phrases.collocations(none.selectExpr("*", "'en' as lang"), least=2).count() == 0
