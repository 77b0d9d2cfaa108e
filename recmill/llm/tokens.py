"""Token ids of whole texts by a ``tokenizers`` file, remembered word by word."""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Callable, Iterable

REMEMBERED = 250_000  # entries of one generation of a store
WORDS = 400_000  # likewise, of words' ids
MARKS = 10_000  # different closing marks that are remembered
_ODD = re.compile("[\x1c-\x1f]")  # white space to str.split, but not to the tokenizer
_MARKS = ".,;:!?$%&*#"
_LATIN_END = "ɐ"


class Generations:
    """A bounded store of words: a full generation is kept as the old one, and words found there move on."""

    def __init__(self, find: Callable[[list[str]], Iterable[bytes]], size: int):
        self._find, self._size = find, size
        self.young: dict[str, bytes] = {}
        self._old: dict[str, bytes] = {}

    def have(self, words: Iterable[str]) -> dict[str, bytes]:
        """A store that holds all of ``words``."""
        words = set(words)
        new = words.difference(self.young)
        if len(self.young) + len(new) > self._size:
            self._old, self.young = self.young, {}
            new = words
        unknown = [w for w in new if w not in self._old]
        if len(unknown) < len(new):
            self.young.update((w, self._old[w]) for w in new if w in self._old)
        if unknown:
            self.young.update(zip(unknown, self._find(unknown)))
        return self.young


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in byte-level vocabularies: itself if it is printable, else one from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + n) for n, b in enumerate(rest)}


_LETTERS = _byte_letters()


def _is_latin(letters: str) -> bool:
    """Whether they are whole in every normal form, and letters in lower case as well."""
    return letters.isascii() or (max(letters) < _LATIN_END and len(letters.lower()) == len(letters))


class _Words(dict):
    """Ids of words, as bytes; a full store is kept as the old one, and words found there move on."""

    def __init__(self, tokenizer, remembered: int):
        self._tokenizer, self._split, self._size = tokenizer, tokenizer.model.tokenize, remembered
        self._old: dict[str, bytes] = {}
        self._marks: dict[str, bytes] = {}

    def turn(self) -> None:
        """Between texts: make room where the store is full."""
        if len(self) > self._size:
            self._old = dict(self)
            self.clear()

    def one(self, text: str) -> bytes:
        return array("I", self._tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def __missing__(self, word: str) -> bytes:
        found = self._old.get(word)
        if found is None:
            found = self._find(word)
        self[word] = found
        return found

    def _find(self, word: str) -> bytes:
        core = word if word.isalpha() else word.rstrip(_MARKS)
        if not core.isalpha():
            return self.one(word)
        if len(core) < len(word):
            mark = word[len(core) :]
            if mark not in self._marks:
                if len(self._marks) >= MARKS:
                    self._marks.clear()
                self._marks[mark] = self.one(mark)
            return self[core] + self._marks[mark] if _is_latin(core) else self.one(word)
        if not _is_latin(word):
            return self.one(word)
        word = word.lower()
        if not word.isascii():
            word = word.encode().decode("latin-1").translate(_LETTERS)
        return array("I", [token.id for token in self._split(word)]).tobytes()


class WordEncoder:
    """Ids of texts for byte-level tokenizers that never join characters across white space.

    It suits tokenizers that lower-case, and split words into runs of letters, digits and
    other marks: a text's ids are then the ids of its white-space-separated words, and a
    word of Latin letters and closing marks has the ids of its letters and of its marks.
    Such letters go to the vocabulary's model directly. ``encode`` gives exactly what the
    tokenizer gives for the whole text.
    """

    def __init__(self, path: str, remembered: int = WORDS):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._words = _Words(self._tokenizer, remembered)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Native unsigned 32-bit ids of each text."""
        out, known = [], self._words.__getitem__
        for text in texts:
            out.append(self._words.one(text) if _ODD.search(text) else b"".join(map(known, text.split())))
            self._words.turn()
        return out


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """This worker's encoder for ``path``."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]
