"""Token ids of whole texts by the word-level BPE vocabulary, each distinct word encoded once.

The ids are those of the `tokenizers` library. For plain texts its split can be stated exactly: after
lower-casing, runs of letters, single digits, runs of other signs, and the English contractions,
each encoded by itself. Such texts are cut here, many at a time by the classes of their bytes, so that
only the distinct words become Python texts, and the words that are new to the process are merged
together (see `merges`), by the library where they are very long or the vocabulary has other rules.
All other texts (characters beyond Latin Extended-A, control characters, `İ`, `ŉ`, or a special
token's `<|`) go to the library whole. A Python worker keeps its words from task to task.
"""

from __future__ import annotations

import functools
import os
import re
from collections.abc import Iterable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa

from loanrisk.llm.merges import FileMerges
from loanrisk.llm.word_index import WordIndex, id_type, pieces

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
END_ID = 1
CHARS = 4_000_000
SLICE = 4_000
#: Longer words are left to the library, which merges one word without looking at it whole each time.
LONG = 500
#: New words are merged so many at a time.
MERGED = 100_000

# The characters of plain texts, and what they are to the vocabulary's pattern.
_LOWER = "a-zªµºß-öø-ÿĀ-ňŊ-ſ"
_NUMBER = "0-9²³¹¼½¾"
_SPACE = "\t-\r \x85\xa0"
NOT_PLAIN = re.compile("[^\t-\r -~\xa0-įı-ňŊ-ſ]")  # a single class is searched fast
SPECIAL = "<|"
#: Characters that are cut together.
CUT = 1_000_000

# The classes of lower-case plain characters, of which UTF-8 has at most two bytes.
_SPACES, _LETTERS, _NUMBERS, _OTHERS = range(4)
_KINDS = np.full(0x180, _OTHERS, dtype=np.uint8)
for _kind, _of in ((_LETTERS, _LOWER), (_NUMBERS, _NUMBER), (_SPACES, _SPACE)):
    _KINDS[[ord(x) for x in re.findall(f"[{_of}]", "".join(map(chr, range(0x180))))]] = _kind
_BYTE_KINDS = np.concatenate([_KINDS[:128], np.zeros(128, dtype=np.uint8)])


def cut_words(texts: list[bytes]) -> tuple[pa.Array, np.ndarray]:
    """The words of lower-case plain texts in a row, and their number per text. They are the matches of
    `'s|'t|'re|'ve|'m|'ll|'d|[letters]+|[number]|[^spaces, letters, numbers]+`."""
    data = np.frombuffer(b"\n".join([*texts, b"\n\n"]), dtype=np.uint8)  # white space ends each text
    kinds = _BYTE_KINDS[data]
    wide = np.flatnonzero(data >= 0xC0)
    kinds[wide] = kinds[wide + 1] = _KINDS[(data[wide] & 0x1F).astype(np.int64) << 6 | data[wide + 1] & 0x3F]
    begins = kinds == _NUMBERS
    begins[wide + 1] = False
    begins[0] = True
    begins[1:] |= kinds[1:] != kinds[:-1]
    marks = np.flatnonzero(data == ord("'"))
    marks = marks[begins[marks]]  # a sign inside a run of others is one of them
    first, second = data[marks + 1], data[marks + 2]
    one = np.isin(first, list(b"stmd"))
    two = np.isin(first, list(b"rv")) & (second == ord("e")) | (first == ord("l")) & (second == ord("l"))
    ends = marks + 1 + one + 2 * two
    begins[marks[one | two] + 1] = False
    begins[ends[one | two]] = True
    inside = kinds != _SPACES
    begins &= inside
    # The bytes of words without the white space between them.
    offsets = np.append(np.flatnonzero(begins[inside]), int(inside.sum())).astype(np.int32)
    words = pa.Array.from_buffers(
        pa.string(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(data[inside])]
    )
    sizes = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    bounds = np.concatenate([[0], np.cumsum(sizes + 1)])
    return words, np.diff(np.searchsorted(np.flatnonzero(begins), bounds))


class WordTokens:
    """Encoder with an index of words; `worker_tokens` shares one among the tasks of a process."""

    #: New words are encoded together once the texts that wait for them have so many characters.
    chars = CHARS

    def __init__(self, vocabulary: str = VOCABULARY):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer

        self._library = Tokenizer.from_file(vocabulary)
        self.dtype = id_type(max(self._library.get_vocab(with_added_tokens=True).values()))
        self._merges = FileMerges.usable(vocabulary)
        self._words = WordIndex(self._encode_words, self.dtype)

    def _encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if not self._merges:
            return self._by_library(words)
        long = np.fromiter((len(w) > LONG for w in words), dtype=bool, count=len(words))
        if not long.any():
            parts = [self._merges.encode(words[k : k + MERGED]) for k in range(0, len(words), MERGED)]
            return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
        sizes = np.empty(len(words), dtype=np.int64)
        found = []
        for of, encode in ((~long, self._merges.encode), (long, self._by_library)):
            some = [words[k] for k in np.flatnonzero(of).tolist()]
            ids, sizes[of] = encode(some) if some else (np.empty(0, dtype=self.dtype), 0)
            found.append(ids)
        whole = np.empty(int(sizes.sum()), dtype=self.dtype)
        from_library = np.repeat(long, sizes)
        whole[~from_library], whole[from_library] = found
        return whole, sizes

    def _by_library(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids, sizes = [], []
        for k in range(0, len(words), SLICE):  # the library's results are large objects
            found = [e.ids for e in self._library.encode_batch(words[k : k + SLICE], add_special_tokens=False)]
            part = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
            sizes.append(part)
            ids.append(np.fromiter((i for x in found for i in x), dtype=self.dtype, count=int(part.sum())))
        return np.concatenate(ids), np.concatenate(sizes)

    def _waiting(self, text: str | None) -> tuple[bool, np.ndarray | str]:
        """Whether the text is encoded already, and its ids or else the plain text."""
        if not text:
            return True, np.empty(0, dtype=self.dtype)
        if SPECIAL in text or NOT_PLAIN.search(text):
            return True, np.array(self._library.encode(text, add_special_tokens=False).ids, dtype=self.dtype)
        return False, text

    @staticmethod
    def cut(text: str) -> list[str]:
        """The words of a plain text."""
        return cut_words([text.lower().encode()])[0].to_pylist()

    def _numbers(self, texts: list[str]) -> list[np.ndarray]:
        """The numbers of the words of each plain text."""
        found: list[list[np.ndarray]] = [[] for _ in texts]
        waiting, size = [], 0

        def look_up() -> None:
            words, counts = cut_words([part.lower().encode() for _, part in waiting])
            coded = words.dictionary_encode()
            known = self._words.numbers(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
            numbers = known[coded.indices.to_numpy()]
            for (k, _), some in zip(waiting, np.split(numbers, np.cumsum(counts)[:-1])):
                found[k].append(some)

        for k, text in enumerate(texts):
            for part in pieces(text):
                waiting.append((k, part))
                size += len(part)
                if size >= CUT:
                    look_up()
                    waiting, size = [], 0
        if waiting:
            look_up()
        return [np.concatenate(x) for x in found]

    def encode(self, texts: Iterable[str | None]) -> Iterator[np.ndarray]:
        """The ids of each text without special tokens; null counts as empty."""
        held, size = [], 0
        for text in texts:
            held.append(self._waiting(text))
            size += len(text or "")
            if size >= self.chars:
                yield from self._encoded(held)
                held, size = [], 0
        yield from self._encoded(held)

    def _encoded(self, held: list[tuple[bool, np.ndarray | str]]) -> Iterator[np.ndarray]:
        waiting = self._numbers([text for done, text in held if not done])
        self._words.learn()
        found = map(self._words.ids, waiting)
        ids = [value if done else next(found) for done, value in held]
        if waiting:
            self._words.note(np.concatenate(waiting))
        self._words.trim()  # before the results are handed out: the last may not be waited for
        yield from ids

    def documents(self, texts: Iterable[str | None], end_id: int = END_ID) -> Iterator[np.ndarray]:
        end = np.array([end_id], dtype=id_type(end_id))
        for ids in self.encode(texts):
            yield np.concatenate([ids, end])


@functools.cache
def worker_tokens(vocabulary: str = VOCABULARY) -> WordTokens:
    """The encoder of this process: its words, at most `MOST_WORDS`, outlive a task. An encoder
    must not be used by two iterations at a time, which the one task of a worker does not do."""
    return WordTokens(vocabulary)
