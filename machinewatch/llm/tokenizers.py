"""Vocabulary files applied by the ``tokenizers`` library, one distinct piece at a time.

A text is cut where the vocabulary's own pre-tokenizer always cuts, each
distinct piece is encoded once by the library and remembered (a bounded
memo), and the pieces' ids are joined. Texts that hold a special string are
given to the library whole.
"""

from __future__ import annotations

import os
import re
from array import array
from sys import byteorder
from unicodedata import is_normalized

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: Unicode White_Space, as the pre-tokenizers' ``\s`` has it (Python's own also takes U+001C-U+001F).
SPACE = "".join(map(chr, [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
#: Pieces of a byte-level text: a run of other characters with one blank before it, or white space up to that blank.
BYTE_PIECES = re.compile(f" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
#: Pieces where white space is dropped.
WORD_PIECES = re.compile(f"[^{SPACE}]+")
#: ASCII marks; behind letters they are a pre-token of their own.
MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
#: Entries of a memo's generation, and the longest key that is remembered.
MEMO, LONGEST = 300_000, 64


class Memo(dict):
    """A dictionary that computes missing values and holds two generations of at most ``size`` entries."""

    def __init__(self, compute, size: int = MEMO):
        super().__init__()
        self.compute, self.size, self.older = compute, size, {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.compute(key)
            if len(key) > LONGEST:
                return value
        if len(self) >= self.size:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value


def vocabulary_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_letters() -> list[str]:
    """The letter that byte-level vocabularies write for each byte: printable ones for themselves, others from U+0100."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


class Encoder:
    """Ids of a text as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str):
        import json

        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.library = Tokenizer.from_file(path)
        self.specials = [t["content"] for t in spec["added_tokens"]]
        self.byte_level = spec["normalizer"] is None and spec["pre_tokenizer"]["type"] == "ByteLevel"
        self.pieces = (BYTE_PIECES if self.byte_level else WORD_PIECES).findall
        self.letters = dict(enumerate(byte_letters()))
        self.model = self.library.model
        self.memo = Memo(self._piece, 2 * MEMO)

    def _whole(self, text: str) -> bytes:
        return _packed(self.library.encode(text, add_special_tokens=False).ids)

    def _piece(self, piece: str) -> bytes:
        """A piece by the library; a word goes straight to its model, and marks behind a word are another piece."""
        word = piece[1:] if piece[0] == " " else piece
        if word.isalpha():
            if not self.byte_level:
                # Only where lower case and composition are plain is the normalizer left out.
                piece = word.lower()
                if max(word) >= "\u0180" or not piece.isalpha() or not is_normalized("NFC", word):
                    return self._whole(word)
            mapped = piece.encode().decode("latin-1").translate(self.letters)
            return _packed([t.id for t in self.model.tokenize(mapped)])
        head = piece.rstrip(MARKS)
        # In lower case too: a letter that becomes one with a combining mark makes a run with marks behind it.
        if head != piece and (head[1:] if head[:1] == " " else head).lower().isalpha():
            return self.memo[head] + self.memo[piece[len(head):]]
        return self._whole(piece)

    def __call__(self, text: str) -> bytes:
        if any(s in text for s in self.specials):
            return self._whole(text)
        return b"".join(map(self.memo.__getitem__, self.pieces(text)))


def _packed(ids: list[int]) -> bytes:
    return array("I", ids).tobytes() if byteorder == "little" else b"".join(i.to_bytes(4, "little") for i in ids)


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The process's encoder for a vocabulary file; workers keep it between tasks."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]
