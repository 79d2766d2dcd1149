"""Byte-level BPE ids of whole documents.

Where white space is single blanks and line feeds between words, the tokenizer's
split of a text into units is a plain pattern without look-ahead, and a text is encoded in one
call with the merges of the same vocabulary.  Texts with any other white space, and
those that hold an added token such as ``<|endoftext|>``, go to ``tokenizers`` whole.
"""

from __future__ import annotations

import os
import re
from array import array

import numpy as np

#: White space other than blanks and line feeds, and what shows that those are not single ones between words.
_ODD_SPACE = re.compile("[\\t\\x0b\\x0c\\r\\x1c-\\x1f\\x85\\xa0\\u1680\\u180e\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]")
_RUNS, _ENDS = ("  ", " \n", "\n ", "\n\n"), (" ", "\n")

#: A fixed value: the byte-level tokenizer's split of a text into units, where white space is single.
_UNITS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s"""


class ByteTokens:
    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = {t.content for t in self.tokenizer.get_added_tokens_decoder().values()}
        self.added = re.compile("|".join(map(re.escape, self.special)) or r"(?!)")
        byte = {c: b for b, c in enumerate(_printable())}
        ranks = {bytes(map(byte.__getitem__, piece)): i for piece, i in self.tokenizer.get_vocab().items() if piece not in self.special}
        import tiktoken

        self.units = tiktoken.Encoding("units", pat_str=_UNITS, mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_ordinary

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def ids(self, text: str | None) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        if _ODD_SPACE.search(text) or text.endswith(_ENDS) or any(x in text for x in _RUNS) or self.added.search(text):
            return self._whole(text)
        return array("I", self.units(text)).tobytes()

    def lengths(self) -> np.ndarray:
        """The number of bytes that each id stands for."""
        vocab = self.tokenizer.get_vocab()
        size = np.zeros(max(vocab.values()) + 1, np.int64)
        for piece, i in vocab.items():
            size[i] = len(piece.encode()) if piece in self.special else len(piece)  # one printable character stands for each byte
        return size


def _printable() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies: itself where it is printable, else the next free one from U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


_made: dict[str, ByteTokens] = {}


def byte_tokens(path: str) -> ByteTokens:
    """One encoder per Python worker and vocabulary."""
    if path not in _made:
        _made[path] = ByteTokens(path)
    return _made[path]
