"""A bounded table of the pieces of distinct words, for vectorised encoding."""

from __future__ import annotations

from itertools import chain, repeat

import numpy as np
import sentencepiece

MARK = "▁"  # the library's mark for a space
WORDS_PER_TABLE = 400_000
CHARS_PER_TABLE = 16_000_000  # of its words; their ids are as many at most, give or take the marks


class PieceTable:
    """Distinct word -> its piece ids, segmented once by the library (which
    puts a mark in front). The ids of all words stand in one array, so the
    ids of a text are gathered by position, not joined word by word. A table
    that passes ``limit`` words, or ``chars`` characters of words, is started
    anew."""

    def __init__(self, model_file: str, limit: int = WORDS_PER_TABLE, chars: int = CHARS_PER_TABLE):
        self.model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        self.limit, self.most_chars = limit, chars
        self._clear()

    def _clear(self) -> None:
        self.row: dict[str, int] = {}
        self.chars = 0
        self.start = np.zeros(1 << 12, np.int64)
        self.length = np.zeros(1 << 12, np.int64)
        self.flat = np.zeros(1 << 14, np.int32)
        self.used = 0

    def rows(self, words: list[str]) -> np.ndarray:
        """The words' rows in the table; words that it lacks are added."""
        if len(self.row) > self.limit or self.chars > self.most_chars:
            self._clear()
        at = np.fromiter(map(self.row.get, words, repeat(-1)), np.int64, len(words))
        missing = np.flatnonzero(at < 0)
        if len(missing):
            lacked = [words[i] for i in missing]
            self._add(list(dict.fromkeys(lacked)))
            at[missing] = [self.row[w] for w in lacked]
        return at

    def _add(self, new: list[str]) -> None:
        ids = self.model.encode(new, num_threads=1)
        if "" in new:  # a mark alone: the library gives nothing for an empty text
            ids[new.index("")] = [self.model.piece_to_id(MARK)]
        first = len(self.row)
        self.row.update(zip(new, range(first, first + len(new))))
        length = np.fromiter(map(len, ids), np.int64, len(ids))
        total = int(length.sum())
        self.start, self.length = (self._room(a, first + len(new))
                                   for a in (self.start, self.length))
        self.flat = self._room(self.flat, self.used + total)
        self.start[first:first + len(new)] = self.used + np.cumsum(length) - length
        self.length[first:first + len(new)] = length
        self.flat[self.used:self.used + total] = np.fromiter(
            chain.from_iterable(ids), np.int32, total)
        self.used += total
        self.chars += sum(map(len, new))
        self.added(new, ids)

    def added(self, new: list[str], ids: list[list[int]]) -> None:
        """What else a table keeps of new words."""

    @staticmethod
    def _room(a: np.ndarray, size: int) -> np.ndarray:
        return a if size <= len(a) else np.concatenate([a, np.zeros(size, a.dtype)])

    def gather(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words in ``rows``, one after another, and their counts."""
        n = self.length[rows]
        before = np.cumsum(n) - n
        at = np.repeat(self.start[rows] - before, n) + np.arange(n.sum())
        return self.flat[at], n
