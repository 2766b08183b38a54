"""Exact encoding of whole texts by a public tokenizer file, with words encoded once per worker.

Byte-pair merges never cross the places where a tokenizer's pre-tokenizer cuts,
and both tokenizers used here cut at a single space between two characters that
aren't white space.  So a text is the concatenation of its pieces' ids, and a
worker encodes each different piece once with the ``tokenizers`` library.
"""

from __future__ import annotations

import os
import re
from array import array
from string import punctuation

# The characters that Unicode calls white space, as the tokenizers' \s.
SPACE = "\t\n\x0b\x0c\r \x85\xa0  -     　"
_EXOTIC = re.compile(f"[{SPACE[3:5]}{SPACE[6:]}\x00]")
_UNEVEN = ("  ", " \n", "\n ", "\n\n", "\t", "\x0b", "\x0c", "\r", "\x00")
_CUT = re.compile(f"(?<=[^{SPACE}]) (?=[^{SPACE}])")
#: Letters for which one word is one pre-token and lower-casing and NFC act letter by letter.
_LATIN = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+")
_BEYOND = re.compile("[^\x00-\xff]")


def _byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable Latin-1 stands for itself, other bytes for code points from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(rest)}


def _even(text: str) -> bool:
    """White space is only single spaces and line feeds, each between two other characters."""
    if any(x in text for x in _UNEVEN) or text[:1] in (" ", "\n") or text[-1:] in (" ", "\n"):
        return False
    return text.isascii() or not _EXOTIC.search(text)


class PieceEncoder(dict):
    """Ids of a text as little-endian unsigned 32-bit integers; a mapping from pieces to ids.

    A key is a piece without the space before it; a piece that begins a line
    begins with its line feed, and NUL stands before a piece that is complete as
    it is (where the tokenizer drops white space, neither is needed).  Known pieces are held in two generations of ``limit`` pieces at
    most (the older is dropped when the younger is full), so memory is bounded
    whatever the texts are; pieces above ``longest`` characters aren't held.
    """

    def __init__(self, path: str, limit: int = 500_000, longest: int = 64):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model, self.letters = self.tokenizer.model, _byte_letters()
        self.limit, self.longest, self.old, self.suffixes = limit, longest, {}, {}
        self.lower = self.tokenizer.normalizer is not None  # this file's tokenizer folds case and drops spaces
        self.space = "" if self.lower else self.letters[32]
        self.fast = all(self._word(*w) == self._plain("".join(w)) for w in ((" ", "the", ""), ("", "Été", "."), (" ", "naïveté", ",***"), (" ", "Straße", "!!")))

    def _plain(self, piece: str) -> bytes:
        return array("I", self.tokenizer.encode(piece, add_special_tokens=False).ids).tobytes()

    def _word(self, space: str, word: str, suffix: str) -> bytes:
        """A word and the signs after it are two pre-tokens; the word goes straight to the library's merge model."""
        if self.lower:
            word = word.lower()
        if not word.isascii():
            word = word.encode().decode("latin-1").translate(self.letters)
        ids = array("I", [t.id for t in self.model.tokenize(self.space + word if space else word)]).tobytes()
        return ids + self._suffix(suffix) if suffix else ids

    def _suffix(self, signs: str) -> bytes:
        if signs not in self.suffixes:
            if len(self.suffixes) > 10_000:
                self.suffixes.clear()
            self.suffixes[signs] = self._plain(signs)
        return self.suffixes[signs]

    def __missing__(self, key: str) -> bytes:
        ids = self.old.get(key)
        if ids is None:
            if key.isalpha() and self.fast and (key.isascii() or _LATIN.fullmatch(key)):
                ids = self._word(" ", key, "")
            elif key[:1] == "\n" and self.fast and key[1:].isalpha() and (key.isascii() or _LATIN.fullmatch(key[1:])):
                ids = self._suffix("\n") + self._word("", key[1:], "")  # a line feed is a pre-token of its own
            elif key[:1] == "\x00" or key[:1] == "\n":
                ids = self._plain(key.lstrip("\x00"))
            elif self.fast and (core := key.rstrip(punctuation)).isalpha() and (core.isascii() or _LATIN.fullmatch(core)):
                ids = self[core] + self._suffix(key[len(core) :])
            else:
                ids = self._plain(" " + key)
        if len(key) <= self.longest:
            if len(self) >= self.limit:
                self.old = dict(self)
                self.clear()
            self[key] = ids
        return ids

    def keys_of(self, text: str) -> list[str]:
        if _even(text):
            if self.lower:  # white space only separates, and case folds letter by letter in Latin-1
                if "<|" not in text and (text.isascii() or not _BEYOND.search(text)):
                    text = text.lower()
                return text.replace("\n", " ").split(" ")
            return ("\x00" + text).replace("\n", " \n").split(" ")
        parts = _CUT.split(text) if "\x00" not in text else [text]
        return ["\x00" + parts[0], *["\x00 " + p for p in parts[1:]]]

    def encode(self, text: str) -> bytes:
        if "\x00" in text:
            return self._plain(text)
        return b"".join(map(self.__getitem__, self.keys_of(text)))


_ENCODERS: dict[str, PieceEncoder] = {}


def encoder(path: str) -> PieceEncoder:
    """This worker's encoder for a tokenizer file; workers outlive tasks, and so does its cache."""
    if path not in _ENCODERS:
        _ENCODERS[path] = PieceEncoder(path)
    return _ENCODERS[path]
