"""Token counts of a unigram tokenizer by count-only Viterbi.

An Aho-Corasick automaton enumerates the vocabulary matches of a word; a
dynamic programme carries the best score and the number of pieces on the way
to it, and no pieces. Ties follow the tokenizer: matches are offered by
start, and only a strictly better score replaces a way, so of equal ways the
one whose last piece starts first (the longest) stays. A position that no
one-character piece covers is offered as unknown at ten below the lowest
score; unknown characters count their UTF-8 bytes if every byte has a piece,
else each run of them one piece.

Cases: null and empty texts have no tokens; rows with equal or null ids are
independent; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

SPACE = "▁"
UNKNOWN_PENALTY = 10.0
CACHE_WORDS = 400_000


@dataclass(frozen=True)
class Vocabulary:
    pieces: tuple[tuple[str, float], ...]
    unknown: int = 0
    byte_fallback: bool = True


def sentencepiece_vocabulary(path: str) -> Vocabulary:
    """Pieces and scores of a SentencePiece model file, as stored."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = tuple((sp.id_to_piece(i), sp.get_score(i)) for i in range(sp.get_piece_size()))
    return Vocabulary(pieces, sp.unk_id(),
                      {f"<0x{b:02X}>" for b in range(256)} <= {p for p, _ in pieces})


class Counter:
    """Counts the tokens of texts; words are remembered (bounded)."""

    def __init__(self, vocabulary: Vocabulary):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for piece, score in vocabulary.pieces:
            if piece:
                # the last score of a repeated piece holds
                self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.unknown = min(s for _, s in vocabulary.pieces) - UNKNOWN_PENALTY
        self.bytes = vocabulary.byte_fallback
        self._seen: dict[str, tuple[int, int]] = {}

    def word(self, word: str) -> tuple[int, int]:
        """(tokens, of them from unknown characters)."""
        got = self._seen.get(word)
        if got is None:
            if len(self._seen) >= CACHE_WORDS:
                self._seen.clear()
            got = self._seen[word] = self._viterbi(word)
        return got

    def _viterbi(self, word: str) -> tuple[int, int]:
        n = len(word)
        by_start: list[list[tuple[int, float]]] = [[] for _ in range(n)]
        for end, (size, score) in self.automaton.iter(word):
            by_start[end + 1 - size].append((size, score))
        best: list[float | None] = [None] * (n + 1)
        # tokens so far, those from unknown characters, whether the last is one
        state = [(0, 0, False)] * (n + 1)
        best[0] = 0.0
        for i in range(n):
            here, (count, unknown, open_run) = best[i], state[i]
            single = False
            for size, score in by_start[i]:
                single |= size == 1
                value = here + score
                j = i + size
                if best[j] is None or value > best[j]:
                    best[j], state[j] = value, (count + 1, unknown, False)
            if not single:
                value = here + self.unknown
                if best[i + 1] is None or value > best[i + 1]:
                    more = (len(word[i].encode("utf-8", "surrogatepass")) if self.bytes
                            else 0 if open_run else 1)
                    best[i + 1] = value
                    state[i + 1] = (count + more, unknown + more, True)
        return state[n][:2]

    def text(self, text: str) -> tuple[int, int]:
        """Spaces become word starts; each word begins with one."""
        if not text:
            return 0, 0
        marked = text.replace(" ", SPACE)
        if marked[0] == SPACE:
            marked = marked[1:]
        tokens = unknown = 0
        for w in marked.split(SPACE):
            t, u = self.word(SPACE + w)
            tokens += t
            unknown += u
        return tokens, unknown


def _count_task(vocabulary):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(vocabulary.value)
        for batch in batches:
            found = [counter.text(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column(0),
                "n_tokens": pa.array([t for t, _ in found], pa.int64()),
                "n_unknown": pa.array([u for _, u in found], pa.int64())})
    return run


def token_counts(docs: DataFrame, vocabulary: Vocabulary, id_col: str = "doc_id",
                 text: str = "text") -> DataFrame:
    """doc_id, n_tokens, n_unknown for every row; no shuffle. The vocabulary
    (tens of thousands of pieces, whatever the input) is broadcast."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text), F.lit("")).alias("t"))
    return rows.mapInArrow(_count_task(shared), "doc_id long, n_tokens long, n_unknown long")
