"""Token ids by the tokenizers library, remembered per word.

Both vocabularies split a text into words before they merge, and no word reaches over the white space
before it. So a text's ids are the ids of its words in turn, and those of frequent words are looked up.
The memory is bounded: a full one takes no more words, and later new words are encoded each time.
"""

from __future__ import annotations

import os
import re
import struct

import numpy as np

#: Words remembered in each Python worker (about 200 bytes each).
REMEMBERED = 700_000
#: Packs few ids at less cost than an array does.
_PACK = [struct.Struct(f"<{n}I").pack for n in range(16)]
#: Letters of the first 256 code points, then ASCII marks other than the apostrophe: two words to both
#: vocabularies, whose letters need no normalisation but lower case. Anything else goes to the library.
_PLAIN = re.compile(r"([A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff]+)([!-&(-/:-@\[-`{-~]*)")
_LOADED: dict[tuple[str, str], "WordIds"] = {}


class _Odd(Exception):
    """White space other than single blanks and line ends; the library encodes such a text as a whole."""


class WordIds(dict):
    """Word -> its ids as little-endian unsigned 32-bit bytes."""

    most = REMEMBERED

    def __init__(self, path: str):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.merge = self.library.model.tokenize
        self.marks: dict[str, bytes] = {"": b""}
        shown = _visible_bytes()
        # Words that get here have no characters beyond the first 256.
        self.visible = {c: "".join(shown.get(b, chr(b)) for b in chr(c).encode()) for c in range(256)}

    def merged(self, letters: str) -> bytes:
        """Ids of one word, given as it leaves the normaliser."""
        if not letters.isascii() or " " in letters:
            letters = letters.translate(self.visible)
        ids = [t.id for t in self.merge(letters)]
        return _PACK[len(ids)](*ids) if len(ids) < len(_PACK) else np.array(ids, "<u4").tobytes()

    def plain(self, word: str, before: str) -> bytes:
        """Ids of ``before + word``; letters and marks are merged apart."""
        found = _PLAIN.fullmatch(word)
        if found is None:
            return self.whole(before + word)
        letters, marks = found.groups()
        if marks not in self.marks:
            if len(self.marks) > 10_000:
                return self.whole(before + word)
            self.marks[marks] = self.whole(marks)
        return ((marks and self.get(letters)) or self.merged(before + self.normal(letters))) + self.marks[marks]

    def normal(self, letters: str) -> str:
        return letters

    def whole(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        raise NotImplementedError

    def _remember(self, word: str, ids: bytes) -> bytes:
        if len(self) < self.most:
            self[word] = ids
        return ids


class SpacelessIds(WordIds):
    """For vocabularies that drop white space: blanks and line ends only separate words."""

    def __missing__(self, word: str) -> bytes:
        return self._remember(word, self.plain(word, ""))

    def normal(self, letters: str) -> str:
        return letters.lower()

    def encode(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, text.replace("\n", " ").split(" ")))


class SpacedIds(WordIds):
    """For byte-level vocabularies: a blank belongs to the word after it, a line end stands alone.

    Words are remembered with a blank before them. A run of white space is split before its last
    character, so a word that starts with white space is left to the library.
    """

    most = 1_100_000

    def __missing__(self, word: str) -> bytes:
        if not word or word[0].isspace():
            raise _Odd
        return self._remember(word, self.plain(word, " "))

    def _first(self, word: str, before: str) -> bytes:
        key = "\n" + before + word
        ids = self.get(key)
        if ids is None:
            if not word or word[0].isspace():
                raise _Odd
            ids = self._remember(key, self.whole(before + word))
        return ids

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        try:
            parts, before = [], ""
            for line in text.split("\n"):
                words = line.split(" ")
                parts.append(self._first(words[0], before))
                parts.extend(map(self.__getitem__, words[1:]))
                before = "\n"
            return b"".join(parts)
        except _Odd:
            return self.whole(text)


def _visible_bytes() -> dict[int, str]:
    """Byte -> the character that stands for it in byte-level vocabularies: the printable ones of the
    first 256 code points stand for themselves, the others follow from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(256 + k) for k, b in enumerate(hidden)}


def load(path: str, spaced: bool) -> WordIds:
    """The worker's vocabulary at ``path``, which every executor can read."""
    key = (path, spaced)
    if key not in _LOADED:
        _LOADED[key] = (SpacedIds if spaced else SpacelessIds)(path)
    return _LOADED[key]
