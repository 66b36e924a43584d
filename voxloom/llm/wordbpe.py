"""Ids of a lower-case word BPE vocabulary, as the tokenizers library gives them, word by word.

The vocabulary drops white space and no token spans it, so a text's ids are those of its white-space
pieces in turn; pieces come again and again, so their ids are kept.
"""

from __future__ import annotations

import re
from functools import cache

import numpy as np

from voxloom.llm.common import Kept, quiet_tokenizers

# Letters and numbers among the first 256 code points (fixed values); pieces beyond go through the library whole.
_LETTERS = "a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff"
_NUMBERS = "0-9\xb2\xb3\xb9\xbc-\xbe"
_PARTS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_NUMBERS}]|[^{_LETTERS}{_NUMBERS}]+")
_BEYOND = re.compile("[^\x00-\xff]")
#: White space to Python, but not to the vocabulary's pattern.
_CONTROLS = "\x1c\x1d\x1e\x1f"


def byte_letters() -> dict[int, str]:
    """The printable stand-ins of byte-level vocabularies: printable bytes are themselves, others follow from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(rest)}


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@cache
def word_ids(path: str | None = None) -> WordIds:
    """One for each Python worker, so the pieces met by earlier tasks are known."""
    return WordIds(path)


class WordIds(Kept):
    """``white-space piece -> ids`` as bytes of little-endian unsigned 32-bit numbers."""

    limit = 600_000  # about 120 MB a generation

    def __init__(self, path: str | None = None):
        super().__init__()
        quiet_tokenizers()
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path or default_path())
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.tokens = self.tokenizer.model.tokenize
        self.letters = byte_letters()
        self.packed = [i.to_bytes(4, "little") for i in range(max(self.tokenizer.get_vocab().values()) + 1)]

    def whole(self, text: str) -> bytes:
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def part(self, part: str) -> bytes:
        name = part if part.isascii() and part.isprintable() else "".join(map(self.letters.__getitem__, part.encode()))
        packed = self.packed
        return b"".join([packed[t.id] for t in self.tokens(name)])

    def make(self, piece: str) -> bytes:
        low = piece.lower()
        if piece.isascii() and piece.isalpha():
            return self.part(piece) if low == piece else self[low]
        if _BEYOND.search(piece) or "<|" in piece or len(piece) > 1000:
            return self.whole(piece)
        parts = _PARTS.findall(low)
        # Parts are kept as pieces of their own: a word comes with many signs around it.
        return self.part(low) if parts == [low] else b"".join([self[p] for p in parts])

    def packed_ids(self, text: str) -> bytes:
        if any(c in text for c in _CONTROLS):
            return self.whole(text)
        return b"".join(map(self.__getitem__, text.split()))

    def encode(self, text: str) -> np.ndarray:
        return np.frombuffer(self.packed_ids(text), "<u4")
