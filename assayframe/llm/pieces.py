"""Distinct-chunk tables: what a SentencePiece BPE model makes of each distinct marked word.

The model replaces spaces by a marker and puts one before the text. None of its pieces has a
marker behind another character, so no merge crosses from a word into the next marker: a text is
encoded by encoding each marked word alone. ``ChunkTable`` checks that property of a model.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable
from functools import lru_cache

import numpy as np

from assayframe.llm.common import processor

MARK = "▁"
_RUN = re.compile(" +[^ ]*")
KEPT_LENGTH = 48  # longer words are rare; they are worked out anew each time
KEPT_WORDS = 200_000  # a full table is dropped and starts again, which changes no result


def marked_words(text: str) -> list[str]:
    """The marked words of a text, each without its first marker.

    A word is a run of spaces and what follows up to the next space. With the marker that the
    model adds in front, an empty text has no word.
    """
    if not text:
        return []
    if MARK in text:
        text = text.replace(MARK, " ")
    if "  " in text or text[0] == " ":
        return [run[1:] for run in _RUN.findall(" " + text)]
    return text.split(" ")


class ChunkTable:
    """Integers for each distinct marked word, filled on demand, in flat arrays."""

    def __init__(self, work_out: Callable[[list[str]], Iterable[list[int]]], dtype=np.int32):
        self.work_out, self.dtype = work_out, dtype
        self.clear()

    def clear(self) -> None:
        self.index: dict[str, int] = {}
        self.flat = np.zeros(1 << 16, self.dtype)
        self.starts = np.zeros(1 << 12, np.int64)
        self.lengths = np.zeros(1 << 12, np.int64)
        self.used = self.words = 0

    def _add(self, words: list[str]) -> None:
        values = list(self.work_out(words))
        sizes = np.fromiter(map(len, values), np.int64, len(values))
        total, n = int(sizes.sum()), len(values)
        while self.used + total > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while self.words + n > len(self.starts):
            self.starts = np.concatenate([self.starts, np.zeros_like(self.starts)])
            self.lengths = np.concatenate([self.lengths, np.zeros_like(self.lengths)])
        row = slice(self.words, self.words + n)
        self.starts[row] = self.used + np.cumsum(sizes) - sizes
        self.lengths[row] = sizes
        self.flat[self.used : self.used + total] = np.fromiter(
            (v for value in values for v in value), self.dtype, total
        )
        self.index.update(zip(words, range(self.words, self.words + n), strict=True))
        self.used += total
        self.words += n

    def rows(self, words: list[str]) -> np.ndarray:
        """The table's row of each word; unknown words are worked out first."""
        new = sorted(set(words).difference(self.index))
        if new:
            self._add(new)
        return np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))

    def trim(self) -> None:
        """Between slices of texts: let long words go, and all words of a full table."""
        if self.words > KEPT_WORDS or self.used > 8 * KEPT_WORDS:
            self.clear()
        else:
            for word in [w for w in self._recent if len(w) > KEPT_LENGTH]:
                self.index.pop(word, None)

    _recent: tuple[str, ...] = ()

    def joined(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Values of all words of all texts, in order of position.

        Returns the values, each text's number of values, each word's number of values and each
        text's number of words.
        """
        split = [marked_words(t) for t in texts]
        words = [w for part in split for w in part]
        rows = self.rows(words)
        sizes = self.lengths[rows]
        counts = np.fromiter(map(len, split), np.int64, len(split))
        values = self.flat[spans(self.starts[rows], sizes)]
        per_text = sums(sizes, counts)
        self._recent = tuple(w for w in words if len(w) > KEPT_LENGTH)
        self.trim()
        return values, per_text, sizes, counts


def spans(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The positions starts[i] ... starts[i] + sizes[i] - 1, one span after the other."""
    total = int(sizes.sum())
    before = np.cumsum(sizes) - sizes
    return np.repeat(starts - before, sizes) + np.arange(total, dtype=np.int64)


def sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums over consecutive groups of counts[i] values each."""
    ends = np.concatenate([[0], np.cumsum(values)])
    stops = np.cumsum(counts)
    return ends[stops] - ends[stops - counts]


def offsets(counts: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)


def check_marked(sp) -> None:
    """The property that lets words be encoded alone."""
    for piece in sp.id_to_piece(list(range(sp.get_piece_size()))):
        if MARK in piece.lstrip(MARK):
            raise ValueError(f"the piece {piece!r} crosses a marker: encode whole texts instead")


@lru_cache(maxsize=2)
def id_table(model_file: str) -> ChunkTable:
    """Ids of each marked word. A lone marker is the word '' here; the library sees it as no text."""
    sp = processor(model_file)
    check_marked(sp)
    lone = sp.piece_to_id(MARK)
    return ChunkTable(lambda words: [x or [lone] for x in sp.encode(words, num_threads=1)])


@lru_cache(maxsize=2)
def piece_bytes(model_file: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """UTF-8 of every piece (markers are spaces, control pieces nothing): bytes, starts, sizes."""
    sp = processor(model_file)
    parts = []
    for i in range(sp.get_piece_size()):
        if sp.is_control(i):
            parts.append(b"")
        elif sp.is_byte(i):
            parts.append(bytes([int(sp.id_to_piece(i)[3:5], 16)]))
        elif sp.is_unknown(i):
            parts.append(sp.decode([i]).encode())
        else:
            parts.append(sp.id_to_piece(i).replace(MARK, " ").encode())
    sizes = np.array([len(p) for p in parts], np.int64)
    return np.frombuffer(b"".join(parts), np.uint8), np.cumsum(sizes) - sizes, sizes
