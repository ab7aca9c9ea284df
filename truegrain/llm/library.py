"""Ids by the tokenizers library, each distinct word encoded once in a worker."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
from tokenizers import Tokenizer

from truegrain.llm.pretokens import TextEncoder, WordBpe

#: Words given to the library in one call; the ids of each end with a word-end token.
TOGETHER = 2_000


class LibraryEncoder(TextEncoder):
    """Whole texts as the library encodes them.

    The library never merges across words, so a text's ids are those of its words one
    after another. New words are joined by spaces for a call and parted at the tokens that
    end a word; where that gives another number of words, each is encoded alone.
    """

    def __init__(self, path: str):
        bpe = WordBpe(path)
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.is_end = np.zeros(max(bpe.tokens) + 1, bool)
        for i, token in bpe.tokens.items():
            self.is_end[i] = token.endswith(bpe.suffix) or token in bpe.special
        super().__init__(bpe)

    def _ids(self, text: str) -> np.ndarray:
        # The fast form keeps no offsets; its ids are the same.
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.int64)

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found, counts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for begin in range(0, len(words), TOGETHER):
            some = words[begin : begin + TOGETHER]
            ids = self._ids(" ".join(some))
            cuts = np.flatnonzero(self.is_end[ids]) + 1
            if len(cuts) == len(some) and (not len(cuts) or cuts[-1] == len(ids)):
                found.append(ids)
                counts.append(np.diff(cuts, prepend=0))
            else:
                alone = [self._ids(w) for w in some]
                found += alone
                counts.append(np.array([len(a) for a in alone]))
        return np.concatenate(found), np.concatenate(counts)

    def encode_texts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and how many each has."""
        return self.encode_all(texts)[:2]


@lru_cache(1)
def library_encoder(path: str) -> LibraryEncoder:
    """One encoder for all tasks that a worker runs one after another."""
    return LibraryEncoder(path)
