"""Token ids of the distinct words of a task, encoded in bulk and gathered for texts."""

from __future__ import annotations

from collections.abc import Callable, Iterable

import numpy as np

MOST_WORDS = 300_000
#: Long texts are cut before a white-space character once a piece has so many characters.
PIECE = 1 << 20


def id_type(largest: int) -> np.dtype:
    """The narrowest type of ids up to `largest`: two bytes, or four."""
    return np.dtype(np.uint16 if largest < 1 << 16 else np.uint32)


class _Numbers(dict):
    def __missing__(self, word: str) -> int:
        self[word] = number = len(self)
        return number


class WordIndex:
    """Numbers words as they are met; `learn` encodes all new ones together."""

    def __init__(self, encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], dtype: np.dtype, most: int = MOST_WORDS):
        self._encode, self._dtype, self._most = encode, dtype, most
        self.forget()

    def forget(self) -> None:
        self._numbers = _Numbers()
        self._start = np.zeros(1, dtype=np.int64)  # ids of word k: _ids[_start[k]:_start[k + 1]]
        self._ids = np.empty(0, dtype=self._dtype)
        self._uses = np.zeros(0, dtype=np.int64)

    def numbers(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self._numbers.__getitem__, words), dtype=np.int32, count=len(words))

    def learn(self) -> None:
        done = len(self._start) - 1
        new = [w for w, _ in zip(reversed(self._numbers), range(len(self._numbers) - done))][::-1]
        if new:
            ids, sizes = self._encode(new)
            self._start = np.concatenate([self._start, self._start[-1] + np.cumsum(sizes)])
            self._ids = np.concatenate([self._ids, ids.astype(self._dtype)])

    def ids(self, numbers: np.ndarray) -> np.ndarray:
        """The ids of all words in a row."""
        begin = self._start[numbers]
        return gather(self._ids, begin, self._start[numbers + 1] - begin)

    def note(self, numbers: np.ndarray) -> None:
        """Count uses of learned words, for `trim`."""
        uses = np.bincount(numbers, minlength=len(self._numbers))
        uses[: len(self._uses)] += self._uses
        self._uses = uses

    def trim(self) -> None:
        """Bound the memory: of too many words keep the half that was used most, by what `note` has
        counted. Earlier numbers are void then."""
        if len(self._numbers) <= self._most:
            return
        uses = np.zeros(len(self._numbers), dtype=np.int64)
        uses[: len(self._uses)] = self._uses
        kept = np.sort(np.argsort(-uses, kind="stable")[: self._most // 2])
        words = list(self._numbers)
        ids, sizes = self.ids(kept), self._start[kept + 1] - self._start[kept]
        self.forget()
        self.numbers([words[k] for k in kept.tolist()])
        self._start = np.concatenate([self._start, np.cumsum(sizes)])
        self._ids = ids
        self._uses = uses[kept] // 2


def gather(flat: np.ndarray, begin: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The slices `flat[begin[k]:begin[k] + sizes[k]]`, one after the other."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.repeat(begin - ends + sizes, sizes) + np.arange(total)]


def pieces(text: str, size: int = PIECE) -> Iterable[str]:
    """The text in pieces that end before a white-space character, where no token spans the cut."""
    at = 0
    while len(text) - at > size:
        end = at + size
        while end < len(text) and not (text[end] in " \n\t" and not text[end - 1].isspace()):
            end += 1
        yield text[at:end]
        at = end
    yield text[at:]
