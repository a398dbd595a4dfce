"""Ids of whole texts by the tokenizers library, each distinct word encoded once.

Byte-pair merges never cross the borders at which a tokenizer first splits a text, and certain
spaces always are such borders. So a text's ids are those of its words, one after the other; they
are kept for the words met before, up to a bound. What a word of common Latin letters and signs is
split into comes from the tokenizer's own pattern, and its ids from the library's model; any other
word goes through the library's whole encoder.
"""

from __future__ import annotations

import re
from array import array
from functools import cache
from os.path import commonprefix

import regex
from tokenizers import Tokenizer

#: Distinct words that are remembered; beyond it all are forgotten.
REMEMBERED = 1 << 19

# The patterns by which the two tokenizers split a text.
SPACED_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

#: White space of any kind with a space after it.
_AFTER_SPACE = re.compile(
    rb"(?:[\t-\r \x1c-\x1f]|\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\xaf]|\xe2\x81\x9f|\xe3\x80\x80) "
)
#: ASCII letters and signs after them, which any of the patterns takes as one part each.
_PLAIN = re.compile(rb"([A-Za-z]+)([!-&(-/:-@\[-`{-~]*)")
_SAFE_CUT = re.compile(rb"(?<=[!-~]) ")
#: Characters whose classes and lower case no two Unicode versions disagree on, all composed.
_COMMON = re.compile("[\t\n\r -~¡-¬®-įĲ-ž]*")


def byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies: itself where it is visible,
    else the next unused one from 256 on."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    letters, unused = [], 256
    for byte in range(256):
        letters.append(chr(byte if byte in visible else unused))
        unused += byte not in visible
    return letters


_ASCII_PAIRS = [bytes([c, 32]) for c in (*range(9, 14), *range(28, 33))]
#: Those of two and three bytes that don't begin with E2, with a space.
_LONGER_PAIRS = [b"\xc2\x85 ", b"\xc2\xa0 ", b"\xe1\x9a\x80 ", b"\xe3\x80\x80 "]


def _has_space_before_space(text: bytes) -> bool:
    """Whether there is white space of any kind with a space after it. Plain searches are a tenth of the
    pattern's cost, which is left for texts with an E2 byte."""
    if any(pair in text for pair in _ASCII_PAIRS):
        return True
    if text.isascii():
        return False
    return any(pair in text for pair in _LONGER_PAIRS) or (b"\xe2" in text and bool(_AFTER_SPACE.search(text)))


class _Known(dict):
    """Ids by word; unknown words are encoded when asked for."""

    def __init__(self, encode) -> None:
        super().__init__()
        self.encode = encode

    def __missing__(self, word: bytes) -> bytes:
        ids = self[word] = self.encode(word)
        return ids


class WordEncoder:
    """Encodes texts by one tokenizer file; ``spaced``: words begin with the space before them."""

    def __init__(self, path: str, spaced: bool) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        marks = [t.content.lower().encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.marks, self.mark_start = marks, commonprefix(marks)
        self.tokenize = self.tokenizer.model.tokenize
        self.spaced = spaced
        self.split = regex.compile(SPACED_PATTERN if spaced else WORD_PATTERN).findall
        self.letters = dict(enumerate(byte_letters()))
        self.before = self.letters[32] if spaced else ""
        self.words = _Known(self._later_word)
        self.starts = _Known(self._start)
        self.parts = _Known(self._part)

    def _pack(self, letters: str) -> bytes:
        return array("I", [t.id for t in self.tokenize(letters)]).tobytes()

    def _start(self, word: bytes) -> bytes:
        return self._pack(self.before + word.decode())

    def _part(self, part: bytes) -> bytes:
        return self._pack(part.decode("latin-1").translate(self.letters))

    def _word(self, word: bytes) -> bytes:
        text = word.decode("utf-8", "replace")
        if not _COMMON.fullmatch(text):
            return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        found = self.split(text if self.spaced else text.lower())
        return b"".join([self.parts[x.encode()] for x in found])

    def _later_word(self, word: bytes) -> bytes:
        plain = _PLAIN.fullmatch(word)
        if not plain:
            return self._word(b" " + word if self.spaced else word)
        letters, signs = plain.groups()
        ids = self.starts[letters if self.spaced else letters.lower()]
        return ids + self.parts[signs] if signs else ids

    def _whole(self, text: bytes) -> bytes:
        found = self.tokenizer.encode(text.decode("utf-8", "replace"), add_special_tokens=False)
        return array("I", found.ids).tobytes()

    def ids(self, text: bytes) -> bytes:
        """The ids of a UTF-8 text as little-endian unsigned 32-bit integers.

        The library finds its special marks in a text before it is split, so a text that may hold one goes to
        it whole.
        """
        if self.marks and self.mark_start in text.lower():
            lower = text.lower()
            if any(mark in lower for mark in self.marks):
                return self._whole(text)
        if max(map(len, (self.words, self.starts, self.parts))) > REMEMBERED:
            for known in (self.words, self.starts, self.parts):
                known.clear()
        if not self.spaced:
            return b"".join(map(self.words.__getitem__, text.split()))
        # A space ends what stands before it, if that isn't white space itself.
        first, *later = _SAFE_CUT.split(text) if _has_space_before_space(text) else text.split(b" ")
        return self._word(first) + b"".join(map(self.words.__getitem__, later))


@cache
def encoder_of(path: str, spaced: bool) -> WordEncoder:
    """The encoder of a tokenizer file, with the words it remembers: one in each worker process."""
    return WordEncoder(path, spaced)
