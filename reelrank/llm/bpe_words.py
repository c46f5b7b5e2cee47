"""Fast exact encoders for the two public BPE vocabularies.

Both tokenizers never merge across certain spaces, so a text is the
concatenation of independently encoded pieces. ``tiktoken`` runs the same
merges several times faster than ``tokenizers``; equality is tested piece
by piece, and pieces outside the plain range go to ``tokenizers`` itself.
"""

from __future__ import annotations

import base64
import json
import os
import re
from array import array

import numpy as np

CACHE_WORDS = 500_000


def _byte_alphabet() -> dict[str, int]:
    """The printable stand-in of each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


class WordEndBPE:
    """BPE with an end-of-word mark (lower case, white space dropped).

    ``words(list of bytes)`` gives for each word ``(ids, decoded)``: its
    ids as little-endian uint32 bytes and its tokens joined by spaces.
    Words hold no ASCII white space; pre-tokens never cross it.
    """

    _PLAIN = re.compile(r"[\x21-\x7eÀ-ɏ]+")

    def __init__(self, path: str):
        import regex
        import tiktoken
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.reference = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.special = [t["content"] for t in spec["added_tokens"]]
        vocab, end = spec["model"]["vocab"], spec["model"]["end_of_word_suffix"]
        self.tokens = [b""] * (max(*vocab.values(), *(t["id"] for t in spec["added_tokens"])) + 1)
        for t, i in vocab.items():
            self.tokens[i] = t.encode()
        for t in spec["added_tokens"]:
            self.tokens[t["id"]] = t["content"].encode()
        # NUL stands for the end mark; words that hold one are not plain
        byte_of, ranks = _byte_alphabet(), {}
        for token, i in vocab.items():
            if token in self.special:
                continue
            ends = token.endswith(end)
            core = token[: -len(end)] if ends else token
            ranks[bytes(byte_of[c] for c in core) + b"\0" * ends] = i
        self._feed = ranks[b"\n"]
        self._fast = tiktoken.Encoding("word-end", pat_str=r"\n|[^\x00\n]+\x00",
                                       mergeable_ranks=ranks, special_tokens={})
        split = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"]
                     if p["type"] == "Split")
        self._split = regex.compile(split)
        if any("<|" not in s for s in self.special):
            raise ValueError("special tokens are told apart by <|")
        self._cache: dict[bytes, tuple[bytes, bytes]] = {}

    def _value(self, ids) -> tuple[bytes, bytes]:
        ids = list(ids)
        return (np.array(ids, "<u4").tobytes(), b" ".join([self.tokens[i] for i in ids]))

    def reference_value(self, word: bytes) -> tuple[bytes, bytes]:
        text = word.decode("utf-8", "replace")
        return self._value(self.reference.encode(text, add_special_tokens=False).ids)

    def _encode(self, words: list[bytes]) -> None:
        cache, texts = self._cache, [w.decode("utf-8", "replace") for w in words]
        plain = []
        for w, t, ok in zip(words, texts, map(self._PLAIN.fullmatch, texts)):
            if ok and "<|" not in t:
                plain.append(w)
            else:
                cache[w] = self.reference_value(w)
        if not plain:
            return
        # every pre-token gets its end mark; words stay apart by line feeds
        marked = self._split.sub(r"\g<0>\0", b"\n".join(plain).decode().lower())
        ids = np.array(self._fast.encode_ordinary(marked), "<u4")
        feeds = np.flatnonzero(ids == self._feed).tolist()
        raw, names = ids.tobytes(), [self.tokens[i] for i in ids.tolist()]
        for w, a, b in zip(plain, [0, *[i + 1 for i in feeds]], [*feeds, len(names)]):
            cache[w] = (raw[4 * a: 4 * b], b" ".join(names[a:b]))

    def words(self, words: list[bytes]) -> dict[bytes, tuple[bytes, bytes]]:
        """A mapping that holds every given word (the cache itself)."""
        need = set(words)
        missing = need.difference(self._cache)
        if len(self._cache) + len(missing) > CACHE_WORDS:
            self._cache.clear()
            missing = need
        if missing:
            self._encode(list(missing))
        return self._cache


class ByteBPE:
    """Byte-level BPE: a text's ids as little-endian uint32 bytes.

    The pre-token pattern looks ahead only to leave the last of several
    white-space characters to the next word. Texts without two of them in a
    row need no look-ahead and take the same pattern without it (faster).
    """

    _RUN = re.compile(r"\s\s")

    def __init__(self, path: str, ranks_path: str, pattern: str):
        import tiktoken

        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        with open(path, encoding="utf-8") as f:
            added = {t["content"]: t["id"] for t in json.load(f)["added_tokens"]}
        self.special = list(added)
        self._full = tiktoken.Encoding("byte", pat_str=pattern, mergeable_ranks=ranks,
                                       special_tokens=added)
        self._fast = tiktoken.Encoding(
            "byte-plain", pat_str=pattern.replace(r"\s+(?!\S)|", ""),
            mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[str]) -> list[bytes]:
        done: dict[str, bytes] = {}
        for t in texts:
            if t not in done:
                if self._RUN.search(t) or any(s in t for s in self.special):
                    ids = self._full.encode(t, allowed_special="all")
                else:
                    ids = self._fast.encode_ordinary(t)
                done[t] = array("I", ids).tobytes()
        return [done[t] for t in texts]


def load(kind: str, path: str):
    """One encoder per Python worker (workers are reused between tasks)."""
    key = (kind, path)
    if key not in _LOADED:
        if kind == "word_end":
            _LOADED[key] = WordEndBPE(path)
        else:
            import public_tokenizers as P
            _LOADED[key] = ByteBPE(path, path.rsplit(".", 1)[0] + ".tiktoken", P.PATTERN)
    return _LOADED[key]


_LOADED: dict = {}
