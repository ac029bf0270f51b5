"""Token ids of whole texts by the byte-level BPE vocabulary, each distinct word encoded once.

The ids are those of the `tokenizers` library. The vocabulary's split pattern is restated for plain
texts (see `word_tokens.NOT_PLAIN`), whose words are merged as in `word_tokens`; other texts, and those
with a special token's `<|`, go to the library whole.
"""

from __future__ import annotations

import functools
import re

import numpy as np
import public_tokenizers

from loanrisk.llm.word_index import pieces
from loanrisk.llm.word_tokens import WordTokens

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")

# The classes of the vocabulary's pattern among the characters of plain texts.
_LETTER = "a-zA-ZªµºÀ-ÖØ-öø-ÿĀ-ſ"
_NUMBER = "0-9²³¹¼½¾"
_SPACE = "\t-\r \xa0"
WORD = re.compile(
    f"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTER}]+| ?[{_NUMBER}]+| ?[^{_SPACE}{_LETTER}{_NUMBER}]+"
    f"|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"
)


class ByteTokens(WordTokens):
    """As `WordTokens`, for the byte-level vocabulary: case and white space are kept."""

    chars = 16_000_000

    def __init__(self, vocabulary: str = VOCABULARY):
        super().__init__(vocabulary)

    @staticmethod
    def cut(text: str) -> list[str]:
        return WORD.findall(text)

    def _numbers(self, texts: list[str]) -> list[np.ndarray]:
        return [np.concatenate([self._words.numbers(self.cut(part)) for part in pieces(text)]) for text in texts]


@functools.cache
def worker_tokens(vocabulary: str = VOCABULARY) -> ByteTokens:
    """The encoder of this process (see `word_tokens.worker_tokens`)."""
    return ByteTokens(vocabulary)
