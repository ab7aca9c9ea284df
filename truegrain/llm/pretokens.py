"""A word-level BPE file: its vocabulary, and how it cuts a text into words.

The cut is that of the file's normalizer (NFC, white space, lower case) and of its
pattern (contractions, runs of letters, single digits, runs of other signs). Special
tokens of the file are found in the raw text first, as they are not normalized.
"""

from __future__ import annotations

import json
import re
import unicodedata
from functools import lru_cache

import numpy as np
from tokenizers import Regex, Tokenizer, pre_tokenizers

_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Below this code point a text is its own NFC form and is put in lower case sign by sign.
_PLAIN_END = 0x100
#: Words that a worker remembers; beyond, it begins anew.
REMEMBERED = 600_000
#: White space for ``str.split`` but not for the library.
_SEPARATORS = re.compile("[\x1c-\x1f]")
_SPACE = re.compile("[\t-\r \x85\xa0  -     　]+")


def _class(kinds: str) -> str:
    found = [chr(c) for c in range(_PLAIN_END) if unicodedata.category(chr(c))[0] in kinds]
    return "".join(map(re.escape, found))


def _plain_pattern() -> re.Pattern:
    letters, numbers = _class("L"), _class("N")
    space = r"\t-\r \x85\xa0"
    # Letters first, as most words are; no contraction begins with one.
    return re.compile(f"[{letters}]+|'(?:s|t|re|ve|m|ll|d)|[{numbers}]|[^{space}{letters}{numbers}]+")


_PLAIN_WORDS = _plain_pattern()


def _is_plain(text: str) -> bool:
    try:
        text.encode("latin-1")
        return True
    except UnicodeEncodeError:
        return False


def pieces_of(text: str) -> list[str]:
    """A text cut at white space. No word, and no sign made of several, reaches beyond a piece."""
    if _SEPARATORS.search(text) is None:
        return text.split()
    return [p for p in _SPACE.split(text) if p]


@lru_cache(1)
def _byte_signs() -> list[str]:
    """The printable sign that stands for each byte in byte-level vocabularies."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    signs, extra = {b: chr(b) for b in own}, 256
    for b in range(256):
        if b not in signs:
            signs[b] = chr(extra)
            extra += 1
    return [signs[b] for b in range(256)]


class WordBpe:
    """Vocabulary and merges of a BPE file with word ends and byte-level signs."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        kinds = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
        split = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        if kinds != ["NFC", "Replace", "Lowercase"] or split != _PATTERN or spec["decoder"] is not None:
            raise ValueError(f"{path}: not a lower-case word BPE file without decoder")
        if model["dropout"] or model["unk_token"] or any(t["normalized"] for t in spec["added_tokens"]):
            raise ValueError(f"{path}: dropout, unknown tokens and normalized tokens are not supported")
        self.path = path
        self.vocab: dict[str, int] = model["vocab"]
        self.suffix: str = model["end_of_word_suffix"] or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        if any(_SPACE.search(t) for t in self.special):
            raise ValueError(f"{path}: special tokens with white space are not supported")
        self.tokens = {i: t for t, i in self.vocab.items()} | {i: t for t, i in self.special.items()}
        #: (left id, right id, merged id) by rank.
        self.merges = []
        for merge in model["merges"]:
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            self.merges.append((self.vocab[left], self.vocab[right], self.vocab[left + right]))
        signs = _byte_signs()
        self.byte_ids = [self.vocab[s] for s in signs]
        self.last_byte_ids = [self.vocab[s + self.suffix] for s in signs]
        self._special_cut = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        # The library's own normalizer and pattern, for letters that Python may class otherwise.
        self._normalizer = Tokenizer.from_file(path).normalizer
        self._split = pre_tokenizers.Split(Regex(_PATTERN), "removed", invert=True)

        self._odd: dict[str, list[str]] = {}

    def _by_library(self, piece: str) -> list[str]:
        found = self._odd.get(piece)
        if found is None:
            if len(self._odd) > REMEMBERED:
                self._odd.clear()
            found = [w for w, _ in self._split.pre_tokenize_str(self._normalizer.normalize_str(piece))]
            self._odd[piece] = found
        return found

    def _words(self, text: str) -> list[str]:
        if _is_plain(text):
            return _PLAIN_WORDS.findall(text.lower())
        found: list[str] = []
        for piece in pieces_of(text):
            found += _PLAIN_WORDS.findall(piece.lower()) if _is_plain(piece) else self._by_library(piece)
        return found

    def words(self, text: str) -> list[str]:
        """The words of a text; a special token is a word of its own."""
        if not any(token in text for token in self.special):
            return self._words(text)
        found = []
        for i, part in enumerate(self._special_cut.split(text)):
            found += [part] if i % 2 else self._words(part)
        return found


class Seen(dict):
    """Words by where they stand; a new word takes the next place and waits in ``new``."""

    def __init__(self):
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        self.new.append(word)
        self[word] = place = len(self)
        return place


class WordTable:
    """Ids of the words seen before, kept in one array; ``encode_words`` finds those of new ones."""

    def __init__(self):
        self._forget()

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words one after another, and how many each has."""
        raise NotImplementedError

    def learned(self, words: list[str], ids: np.ndarray, counts: np.ndarray) -> None:
        """Told of new words and their ids, in the order of their places."""

    def _forget(self) -> None:
        self.known = Seen()
        self.flat = np.zeros(1 << 16, np.int32)
        self.ends = np.zeros(1 << 14, np.int64)  # of each word's ids in ``flat``

    def _remember(self, words: list[str]) -> None:
        ids, counts = self.encode_words(words)
        have = len(self.known) - len(words)
        used = int(self.ends[have - 1]) if have else 0
        ends = used + np.cumsum(counts)
        while len(self.flat) < ends[-1]:
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while len(self.ends) < have + len(words):
            self.ends = np.concatenate([self.ends, np.zeros_like(self.ends)])
        self.flat[used : ends[-1]] = ids
        self.ends[have : have + len(words)] = ends
        self.learned(words, ids, counts)

    def places(self, words: list[str]) -> np.ndarray:
        """Where each word stands among those remembered."""
        if len(self.known) > REMEMBERED:
            self._forget()
        found = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
        if self.known.new:
            self._remember(self.known.new)
            self.known.new = []
        return found

    def ids_at(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of remembered words one after another, and how many each has."""
        ends = self.ends[places]
        starts = np.where(places > 0, self.ends[places - 1], 0)
        counts = ends - starts
        total = np.cumsum(counts)
        at = np.arange(total[-1] if len(total) else 0) + np.repeat(starts - (total - counts), counts)
        return self.flat[at], counts


class TextEncoder(WordTable):
    """Ids of whole texts: those of their words, one after another."""

    def __init__(self, bpe: WordBpe):
        self.bpe = bpe
        super().__init__()

    def encode_all(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of whole texts: all ids one after another, how many each has, the places of their
        words, and how many words each has."""
        words = list(map(self.bpe.words, texts))
        places = self.places([w for ws in words for w in ws])
        ids, sizes = self.ids_at(places)
        counts = np.fromiter(map(len, words), np.int64, len(words))
        return ids, sums(sizes, counts), places, counts


def sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of so many values each, one group after another."""
    total = np.concatenate([[0], np.cumsum(values)])
    ends = np.cumsum(counts)
    return total[ends] - total[ends - counts]
