"""Replay of byte-pair merges over many words at once.

An inverted index leads from the rank of a pair of neighbours to the places where the pair stands.
Ranks are taken in rising order; a merge is applied at all its places at once and only the two
neighbours of each place are looked at again. Words are independent of each other, so the order of
places across words does not matter; within a word places go from left to right. If a merge makes a
pair of lower rank than itself, the rest of its word could be merged in another order than the
lowest-rank-first rule asks for; such words are merged again by that rule alone.
"""

from __future__ import annotations

import heapq
import json

import numpy as np

NEVER = np.int32(2**31 - 1)
#: Places of so many ranks are indexed at a time; later ranks only have their places' ranks noted.
RANKS = 1024


class Merges:
    """Pairs of token ids (`left << 32 | right`) and the ids they make, which also rank the merges."""

    def __init__(self, pairs: np.ndarray, made: np.ndarray):
        order = np.argsort(pairs)
        self._pairs, self._made = pairs[order], made[order].astype(np.int32)
        self._end = int(made.max()) + 1 if len(made) else 0

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The tokens that neighbours make; `NEVER` where they make none."""
        code = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self._pairs, code), len(self._pairs) - 1)
        return np.where(self._pairs[at] == code, self._made[at], NEVER)

    def merge(self, first: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of non-empty words in a row and their number per word, from the ids of their
        bytes in a row and the bytes per word."""
        ids = first.astype(np.int32)
        ends = np.cumsum(sizes)
        n = len(ids)
        after, before = np.arange(1, n + 1, dtype=np.int32), np.arange(-1, n - 1, dtype=np.int32)
        after[ends - 1] = -1
        before[ends - sizes] = -1
        ranks = np.full(n, NEVER)  # of the pair that begins at a place
        left = np.flatnonzero(after >= 0)
        if len(self._pairs):
            ranks[left] = self._rank(ids[left], ids[left + 1])
        doubtful: list[int] = []
        for low in range(0, self._end, RANKS):
            self._replay(low + RANKS, ids, after, before, ranks, doubtful)

        redo = np.unique(np.searchsorted(ends, np.array(doubtful, dtype=np.int64), side="right"))
        alive = ids >= 0
        counts = np.add.reduceat(alive, ends - sizes, dtype=np.int64)
        if not len(redo):
            return ids[alive], counts
        parts = np.split(ids[alive], np.cumsum(counts)[:-1])
        for k in redo.tolist():
            parts[k] = self._lowest_first(first[ends[k] - sizes[k] : ends[k]].astype(np.int32))
            counts[k] = len(parts[k])
        return np.concatenate(parts), counts

    def _replay(self, end: int, ids, after, before, ranks, doubtful: list[int]) -> None:
        """All merges of a rank below `end`."""
        places = np.flatnonzero(ranks < end)
        places = places[np.argsort(ranks[places], kind="stable")]
        present, first = np.unique(ranks[places], return_index=True)
        index: dict[int, np.ndarray | list[int]] = dict(zip(present.tolist(), np.split(places, first[1:])))
        queue = present.tolist()
        while queue:
            rank = heapq.heappop(queue)
            p = index.pop(rank)
            if isinstance(p, list):
                p = np.unique(np.array(p, dtype=np.int64))
            p = p[ranks[p] == rank]
            if not len(p):
                continue
            q = after[p]
            if len(p) > 1 and (p[1:] == q[:-1]).any():
                p = p[_leftmost(p.tolist(), q.tolist())]
                q = after[p]
            r = after[q]
            ids[p], ids[q] = rank, -1
            ranks[p], ranks[q] = NEVER, NEVER
            after[p] = r
            followed = r >= 0
            before[r[followed]] = p[followed]
            # The two pairs that each merge has made.
            lead = before[p]
            touched = np.concatenate([p[followed], lead[lead >= 0]])
            if not len(touched):
                continue
            new = self._rank(ids[touched], ids[after[touched]])
            ranks[touched] = new
            soon = new < end
            if soon.any():
                for place, r in zip(touched[soon].tolist(), new[soon].tolist()):
                    if r <= rank:
                        doubtful.append(place)
                    known = index.get(r)
                    if known is None:
                        index[r] = [place]
                        heapq.heappush(queue, r)
                    elif isinstance(known, list):
                        known.append(place)
                    else:
                        index[r] = [*known.tolist(), place]

    def _lowest_first(self, ids: np.ndarray) -> np.ndarray:
        """One word by the rule itself: merge the leftmost pair of lowest rank until none is left."""
        while len(ids) > 1:
            ranks = self._rank(ids[:-1], ids[1:])
            at = int(ranks.argmin())
            if ranks[at] == NEVER:
                break
            ids = np.concatenate([ids[:at], ranks[at : at + 1], ids[at + 2 :]])
        return ids


def _leftmost(p: list[int], q: list[int]) -> list[int]:
    """Of places in order, those that do not begin with what the one before has taken."""
    kept, taken = [], -1
    for k, (begin, end) in enumerate(zip(p, q)):
        if begin != taken:
            kept.append(k)
            taken = end
    return kept


class FileMerges:
    """The merges of a vocabulary file of the `tokenizers` library whose symbols are bytes.

    Raises `ValueError` for a file with other rules: `usable` tells.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        if model.get("type", "BPE") != "BPE" or any(
            model.get(rule) for rule in ("dropout", "continuing_subword_prefix", "ignore_merges")
        ):
            raise ValueError("not plain byte-pair merges")
        vocabulary, suffix = model["vocab"], model.get("end_of_word_suffix") or ""
        signs = _byte_signs()
        if any(sign + end not in vocabulary for sign in signs for end in ("", suffix)):
            raise ValueError("a byte has no token")
        self._first = np.array([vocabulary[sign] for sign in signs], dtype=np.int32)
        self._last = np.array([vocabulary[sign + suffix] for sign in signs], dtype=np.int32)
        merges = [x.split(" ") if isinstance(x, str) else x for x in model["merges"]]
        codes = np.array([vocabulary[a] << 32 | vocabulary[b] for a, b in merges], dtype=np.int64)
        made = np.array([vocabulary[a + b] for a, b in merges], dtype=np.int64)
        if (np.diff(made) <= 0).any() or len(np.unique(codes)) < len(codes):
            raise ValueError("ids do not follow the order of the merges")
        self._merges = Merges(codes, made)

    @classmethod
    def usable(cls, path: str) -> FileMerges | None:
        try:
            return cls(path)
        except ValueError:
            return None

    def encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of non-empty words in a row, and their number per word."""
        data = [w.encode() for w in words]
        sizes = np.fromiter(map(len, data), dtype=np.int64, count=len(data))
        flat = np.frombuffer(b"".join(data), dtype=np.uint8)
        ids = self._first[flat]
        ends = np.cumsum(sizes) - 1
        ids[ends] = self._last[flat[ends]]
        return self._merges.merge(ids, sizes)


def _byte_signs() -> list[str]:
    """The characters that stand for bytes in such files: visible Latin-1 signs for themselves, the
    other bytes for the characters from 256 on."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b if b in visible else next(others)) for b in range(256)]
