"""Subword ids of whole texts, tokenizing each distinct word once per worker.

The vocabulary file (the default of ``VOCABULARY``) never merges across white space: its normalizer
and pre-tokenizer treat every run of white space as a border.  So the ids of a
text are the ids of its words, one after the other, and a worker keeps the ids
of the words that it has met (at most ``CACHE_WORDS``; then it begins anew).
"""

from __future__ import annotations

import json
import os
import re
from itertools import repeat

import numpy as np

VOCABULARY = "word_bpe_49k.json"
CACHE_WORDS = 600_000
_JOINED = 400
#: Words that are split at once.
_BLOCK = 1 << 16
#: What the file has to say of borders for words to be split here: letters, single digits, and runs of other characters.
_BORDERS = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
_STEPS = {"normalizer": ["NFC", "Replace", "Lowercase"], "pre_tokenizer": ["Split", "ByteLevel"]}
#: Lower-case letters that neither compose nor change, and what may stand beside them ("<" may begin a special token).
_LETTERS = "a-z\u00df-\u00f6\u00f8-\u00ff"
_OTHER = re.compile(rf"[^!-;=-@\[-`{{-~{_LETTERS}\n]")
_PIECES = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[0-9]|[^{_LETTERS}0-9\n]+|\n")


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _splits(file: dict) -> bool:
    """Whether words have the borders of ``_PIECES`` under a vocabulary file."""
    steps = {k: (file.get(k) or {}).get(f"{k}s" if k == "normalizer" else "pretokenizers", []) for k in _STEPS}
    if any([x.get("type") for x in steps[k]] != v for k, v in _STEPS.items()):
        return False
    replace, (split, level) = steps["normalizer"][1], steps["pre_tokenizer"]
    return (split["pattern"] == {"Regex": _BORDERS} and split["behavior"] == "Removed" and split["invert"] and not level["add_prefix_space"] and not level.get("use_regex", True)
            and replace["pattern"] == {"Regex": "\\s+"} and all("<" in x["content"] for x in file.get("added_tokens", [])))


def _byte_characters() -> dict[int, int]:
    """The character that stands for each byte in a byte-level vocabulary."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    return dict(zip(plain, plain, strict=True)) | {b: 256 + i for i, b in enumerate(sorted(set(range(256)) - set(plain)))}


_CHARACTERS = _byte_characters()


def lowered(text: bytes) -> bytes:
    """``text`` in lower case (ASCII) where the ids stay the same.

    The tokenizer composes characters and then lower-cases them.  A letter can be
    lower-cased before only if no combining mark (U+0300 to U+036F, which begin with these bytes) may follow.
    """
    return text if b"\xcc" in text or b"\xcd" in text else text.lower()


class Subwords:
    """``ids(texts)`` gives the subword ids of UTF-8 texts as one array and the number of ids of each text."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.mark = self.tokenizer.encode("\0", add_special_tokens=False).ids
        with open(path, encoding="utf-8") as f:
            self.splits = _splits(json.load(f))
        self.clear()

    def clear(self) -> None:
        self.known: dict[bytes, int] = {}
        self.flat = np.zeros(1 << 16, np.uint32)
        self.n_flat = 0
        self.begin = np.zeros(1 << 15, np.int64)
        self.length = np.zeros(1 << 15, np.int64)

    def encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of some words, one after the other, and their numbers."""
        found = [self._split(words[i : i + _BLOCK]) if self.splits else self._encode(words[i : i + _BLOCK]) for i in range(0, len(words), _BLOCK)]
        ids, lengths = zip(*found, strict=True) if found else ([np.zeros(0, np.uint32)], [np.zeros(0, np.int64)])
        return np.concatenate(ids), np.concatenate(lengths)

    def _split(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """:meth:`encode` of some words: those of plain characters are split here and each distinct piece is looked up once, the others are encoded."""
        joined = "\n".join([*(w.decode("utf-8", "replace") for w in words), ""])
        ends = np.cumsum([len(w) + 1 for w in joined.split("\n")[:-1]])
        other = np.zeros(len(words), bool)
        if len(ends) != len(words):  # a word with a line feed in it
            return self._encode(words)
        other[np.searchsorted(ends, [m.start() for m in _OTHER.finditer(joined)], side="right")] = True
        rest = np.flatnonzero(other).tolist()
        if rest:
            texts = joined.split("\n")
            joined = "\n".join([*(texts[i] for i in np.flatnonzero(~other).tolist()), ""])
        pieces = _PIECES.findall(joined)
        tokens, known = self.tokenizer.model.tokenize, {"\n": -1}
        known.update((p, i) for i, p in enumerate(dict.fromkeys(p for p in pieces if p != "\n")))
        number = np.fromiter(map(known.__getitem__, pieces), np.int64, len(pieces))
        del known["\n"]
        each = [[t.id for t in tokens(p if p.isascii() else p.encode().decode("latin-1").translate(_CHARACTERS))] for p in known]
        n = np.fromiter(map(len, each), np.int64, len(each))
        flat = np.fromiter((i for x in each for i in x), np.uint32, int(n.sum()))
        breaks = np.flatnonzero(number < 0)
        inside = number[number >= 0]
        some = n[inside]
        lengths = np.zeros(len(words), np.int64)
        lengths[~other] = np.diff(np.concatenate([[0], np.cumsum(some)])[breaks - np.arange(len(breaks))], prepend=0)
        at = np.repeat((np.cumsum(n) - n)[inside] - (np.cumsum(some) - some), some) + np.arange(int(some.sum()))
        if not rest:
            return flat[at], lengths
        ids, lengths[other] = self._encode([words[i] for i in rest])
        owner = np.repeat(other, lengths)
        out = np.empty(len(owner), np.uint32)
        out[owner], out[~owner] = ids, flat[at]
        return out, lengths

    def _encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """:meth:`encode` by the tokenizer: many words a call, parted by a zero character."""
        texts = [w.decode("utf-8", "replace") for w in words]
        if len(self.mark) != 1 or any("\0" in t for t in texts):
            found = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
            return np.array([i for x in found for i in x], np.uint32), np.fromiter(map(len, found), np.int64, len(found))
        joined = [" \0 ".join(texts[i : i + _JOINED]) + " \0" for i in range(0, len(texts), _JOINED)]
        flat = [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(joined, add_special_tokens=False)]
        ids = np.concatenate(flat) if flat else np.zeros(0, np.uint32)
        ends = np.flatnonzero(ids == self.mark[0])
        return np.delete(ids, ends), np.diff(ends, prepend=-1) - 1

    def _place(self, numbers: np.ndarray, ids: np.ndarray, lengths: np.ndarray) -> None:
        while self.n_flat + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.flat[self.n_flat : self.n_flat + len(ids)] = ids
        self.begin[numbers] = self.n_flat + np.cumsum(lengths) - lengths
        self.length[numbers] = lengths
        self.n_flat += len(ids)

    def learn(self, words: list[bytes]) -> None:
        """Adds words that are not known yet."""
        n = len(self.known)
        while n + len(words) > len(self.begin):
            self.begin = np.concatenate([self.begin, np.zeros_like(self.begin)])
            self.length = np.concatenate([self.length, np.zeros_like(self.length)])
        plain = [i for i, w in enumerate(words) if b"\0" not in w]
        self._place(n + np.array(plain, np.int64), *self.encode([words[i] for i in plain]))
        if len(plain) < len(words):
            for i in sorted(set(range(len(words))) - set(plain)):
                self._place(np.array([n + i]), *self.encode([words[i]]))
        self.known.update(zip(words, range(n, n + len(words)), strict=True))

    def _numbers(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.known.get, words, repeat(-1)), np.int64, len(words))

    def ids(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        words, counts = [], [0]
        for t in texts:
            words += lowered(t).split()
            counts.append(len(words))
        ids, lengths = self.word_ids(words)
        edges = np.concatenate([[0], np.cumsum(lengths)])[counts]
        return ids, np.diff(edges)

    def word_ids(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words, one after the other, and how many each has."""
        numbers = self._numbers(words)
        missing = np.flatnonzero(numbers < 0)
        if len(missing):
            absent = [words[i] for i in missing.tolist()]
            fresh = list(dict.fromkeys(absent))
            if len(fresh) + len(self.known) > CACHE_WORDS and self.known:
                self.clear()
                absent, missing = words, slice(None)
                fresh = list(dict.fromkeys(words))
            n = len(self.known)
            self.learn(fresh)
            # words that are all new got their numbers in their order
            numbers[missing] = np.arange(n, n + len(fresh)) if len(fresh) == len(absent) else self._numbers(absent)
        lengths = self.length[numbers]
        ends = np.cumsum(lengths)
        at = np.repeat(self.begin[numbers] - (ends - lengths), lengths)
        at += np.arange(len(at))
        return self.flat[at], lengths


_WORKER: dict[str, Subwords] = {}


def subwords(path: str) -> Subwords:
    """This worker's tokenizer for the file."""
    if path not in _WORKER:
        _WORKER[path] = Subwords(path)
    return _WORKER[path]


def forget() -> None:
    """Lets go of this worker's tokenizers and the words that they know."""
    _WORKER.clear()
