"""Ids of whole documents by a BPE tokenizer that drops white space, one lookup per word.

Such a tokenizer splits at white space and drops it, so a text's ids are those
of its words, one after the other.  Texts are cut at blanks and line feeds only; what
other white space or signs a piece holds is the tokenizer's own affair.  Texts
with an added token go to ``tokenizers`` whole.

New words of letters below U+0300 but for U+0130, which no normal form changes, are split by
the tokenizer's pattern and merged with the merges of the same vocabulary; others are encoded by ``tokenizers``.
"""

from __future__ import annotations

import os
import re
from array import array

import numpy as np
import regex

from .byte_tokens import _printable
from .common import Recent

#: A fixed value: the tokenizer's split of a word into units.
_UNITS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")
#: Letters that normal forms may change, and the one below them whose lower case is two characters.
_FAR = re.compile("[^\x00-\u012f\u0131-\u02ff]")
#: Marks that often end a word; a run of them is one unit.
_MARKS = ".,;:!?)\"]"
#: Stands for the end of a word; no byte of UTF-8.
_END = b"\xff"


class WordTokens:
    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = {t.content for t in self.tokenizer.get_added_tokens_decoder().values()}
        self.added = re.compile("|".join(map(re.escape, added)) or r"(?!)")
        #: Ids are kept in two bytes where they fit.
        self.kind = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.code = "H" if self.kind.itemsize == 2 else "I"
        self.unit = self._merges({p: i for p, i in self.tokenizer.get_vocab().items() if p not in added})
        #: Of words in lower case and without far letters, of units that are no letters, and of all other words.
        self.words, self.units, self.others = Recent(self._word, 400_000), Recent(self._unit, 50_000), Recent(self._other, 50_000)

    def _merges(self, vocab: dict[str, int]):
        """A function from bytes to ids, with the end of a word as one more byte: joining it to the byte before comes first, since its ids are below those of merges."""
        import tiktoken

        byte = {c: b for b, c in enumerate(_printable())}
        ranks = {bytes(byte[c] for c in p.removesuffix("</w>")) + (_END if p.endswith("</w>") else b""): i for p, i in vocab.items()}
        return tiktoken.Encoding("words", pat_str=r"\S+", mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_single_piece

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.kind).tobytes()

    def _unit(self, unit: str) -> bytes:
        return array(self.code, self.unit(unit.encode() + _END)).tobytes()

    def _word(self, word: str) -> bytes:
        if word.isalpha():
            return self._unit(word)
        core = word.rstrip(_MARKS)
        if core.isalpha():
            return self.words[core] + self.units[word[len(core) :]]
        return b"".join(map(self.units.__getitem__, _UNITS.findall(word)))

    def _other(self, word: str) -> bytes:
        return self._whole(word) if _FAR.search(word) else self.words[word.lower()]

    def ids(self, text: str | None) -> bytes:
        """The ids of a text as little-endian unsigned integers of ``kind``."""
        if not text:
            return b""
        if "<" in text and self.added.search(text):
            return self._whole(text)
        if text.isascii() or not _FAR.search(text):
            return b"".join(map(self.words.__getitem__, text.lower().replace("\n", " ").split(" ")))
        return b"".join(map(self.others.__getitem__, text.replace("\n", " ").split(" ")))


_made: dict[str, WordTokens] = {}


def word_tokens(path: str) -> WordTokens:
    """One encoder per Python worker and vocabulary."""
    if path not in _made:
        _made[path] = WordTokens(path)
    return _made[path]
