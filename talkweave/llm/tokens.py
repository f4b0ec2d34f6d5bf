"""Token ids of many texts: each distinct word is encoded once in a worker.

White space never joins words in the tokenizers used here (it is dropped, and no
pattern reaches across it), so the ids of a text are those of its words in turn.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
from tokenizers import Tokenizer

from talkweave.llm import words as W

#: Distinct words kept by a worker; beyond it the store starts anew, with equal results.
KEPT_WORDS = 2_000_000
KEPT_BYTES = 1 << 26
#: Words encoded in one call, set apart by a character that is a token of its own.
CALL_WORDS = 4000
MARK = "\x01"


class WordTokens:
    """The ids of words and the tokenizer that makes them.

    Words are found by hash and then compared with the word itself; one that only
    has the hash of another is looked up by another hash.
    """

    def __init__(self, path: str) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        (self.mark,) = self.tokenizer.encode(MARK, add_special_tokens=False).ids
        self._forget()

    def _forget(self) -> None:
        self.known = np.zeros(0, np.uint64)
        self.place = np.zeros(0, np.int64)
        self.size = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)
        # The bytes of the known words.
        self.words = b""
        self.word_at = np.zeros(0, np.int64)
        self.word_size = np.zeros(0, np.int64)

    def _encode(self, texts: list[str]) -> list[int]:
        return self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)[0].ids

    def _learn(self, hashes: np.ndarray, words: list[bytes]) -> None:
        texts = [word.decode() for word in words]
        parts, sizes = [], []
        for low in range(0, len(texts), CALL_WORDS):
            some = texts[low : low + CALL_WORDS]
            ids = np.array(self._encode([f" {MARK} ".join(some) + f" {MARK}"]), np.uint32)
            ends = np.flatnonzero(ids == self.mark)
            if len(ends) == len(some) and not any(MARK in text for text in some):
                sizes.append(np.diff(ends, prepend=-1) - 1)
                parts.append(ids[ids != self.mark])
            else:
                each = [np.array(self._encode([text]), np.uint32) for text in some]
                sizes.append(np.array([len(ids) for ids in each]))
                parts += each
        size = np.concatenate(sizes)
        place = len(self.ids) + np.cumsum(size) - size
        self.ids = np.concatenate([self.ids, *parts])
        order = np.argsort(np.concatenate([self.known, hashes]), kind="stable")
        self.known = np.concatenate([self.known, hashes])[order]
        self.place = np.concatenate([self.place, place])[order]
        self.size = np.concatenate([self.size, size])[order]
        word_size = np.array([len(word) for word in words], np.int64)
        word_at = len(self.words) + np.cumsum(word_size) - word_size
        self.words += b"".join(words)
        self.word_at = np.concatenate([self.word_at, word_at])[order]
        self.word_size = np.concatenate([self.word_size, word_size])[order]

    def _find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The place of each hash among the known ones, and whether it is there."""
        place = np.searchsorted(self.known, hashes)
        there = place < len(self.known)
        there[there] = self.known[place[there]] == hashes[there]
        return place, there

    def _places(self, data: bytes, words: W.Words, hashes: np.ndarray) -> np.ndarray:
        """The place of each word among the known ones, which take up the new ones."""
        out = np.empty(len(hashes), np.int64)
        start, size, open_ = words.start, words.end - words.start, np.arange(len(hashes))
        keys, taken = hashes, []
        while len(open_):
            unique, example, which = np.unique(keys, return_index=True, return_inverse=True)
            place, there = self._find(unique)
            at = open_[example[~there]]
            if len(at):
                self._learn(unique[~there], [data[a : a + n] for a, n in zip(start[at].tolist(), size[at].tolist())])
                place, _ = self._find(unique)
            found = place[which]
            same = self.word_size[found] == size[open_]
            held = np.flatnonzero(same)
            same[held] = W.same_bytes(data, start[open_[held]], self.words, self.word_at[found[held]], size[open_[held]])
            taken.append((open_[same], keys[same]))
            open_, keys = open_[~same], W.mix(keys[~same] + np.uint64(1))
        # Places are final once no more words are learnt.
        for own, keys in taken:
            out[own] = self._find(keys)[0]
        return out

    def of_chunk(self, chunk: W.Chunk, last: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts of a chunk, each text ended by ``last``, and where each text begins."""
        words = W.split(chunk.data, chunk.offsets)
        if len(self.known) > KEPT_WORDS or len(self.words) > KEPT_BYTES:
            self._forget()
        found = self._places(chunk.data.tobytes(), words, W.word_hashes(chunk.data, words))
        size = self.size[found]
        total = np.concatenate([[0], np.cumsum(size)])
        texts = len(chunk.offsets) - 1
        begin = total[words.first] + np.arange(texts + 1)
        out = np.full(int(begin[-1]), last, np.uint32)
        source = W.spread_ranges(self.place[found], size)
        # Each text before a word adds one id, its end.
        shift = np.repeat(np.arange(texts), np.diff(total[words.first]))
        out[np.arange(len(source)) + shift] = self.ids[source]
        return out, begin


@lru_cache(maxsize=2)
def word_tokens(path: str) -> WordTokens:
    """The store of a tokenizer file, one in each Python worker."""
    return WordTokens(path)
