"""Token ids of whole texts under a public tokenizer file.

The tokenizer's own rules split at white space first, so a text is the sequence of
its white-space-separated words, and a word's ids are computed once per task and
remembered. Words of Latin-1 letters, digits and punctuation go through the same
rules in Python and the tokenizer's own merge model; all others through the whole
tokenizer. ``tests/llm`` holds the ids against the tokenizer's for whole texts.
"""

from __future__ import annotations

import os
import re
import struct

TOKENIZER = "word_bpe_49k.json"
#: The id that ends each document.
END = 2

# How the tokenizer splits a lower-cased word, for Latin-1 letters.
_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ]+")
_PLAIN = re.compile(r"[!-~À-ÖØ-öø-ÿ]+")


def _byte_names() -> list[str]:
    """The printable stand-in of each byte: itself if printable in Latin-1, else the next free code point."""
    names, free = [], 256
    for byte in range(256):
        if 33 <= byte <= 126 or 161 <= byte <= 255 and byte != 173:
            names.append(chr(byte))
        else:
            names.append(chr(free))
            free += 1
    return names


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class TokenBytes(dict):
    """Word (UTF-8) to its ids as little-endian unsigned 32-bit numbers.

    The first ``limit`` words of a task are kept, frequent ones most likely among
    them; after eight times as many misses the memory starts anew.
    """

    def __init__(self, path: str, limit: int = 500_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.tokenize = self.whole.model.tokenize
        self.names = _byte_names()
        self.pieces: dict[str, bytes] = {}
        self.limit = limit
        self.missed = 0

    def _piece(self, piece: str) -> bytes:
        found = self.pieces.get(piece)
        if found is None:
            named = piece if piece.isascii() else "".join([self.names[b] for b in piece.encode()])
            ids = [token.id for token in self.tokenize(named)]
            found = struct.pack(f"<{len(ids)}I", *ids)
            if len(self.pieces) < self.limit and len(piece) <= 64:
                self.pieces[piece] = found
        return found

    def __missing__(self, word: bytes) -> bytes:
        text = word.decode()
        if word.isalpha():
            ids = self._piece(text.lower())
        # Markup of special tokens is left to the tokenizer.
        elif _PLAIN.fullmatch(text) and "<|" not in text:
            ids = b"".join([self._piece(p) for p in _PIECES.findall(text.lower())])
        else:
            found = self.whole.encode(text, add_special_tokens=False).ids
            ids = struct.pack(f"<{len(found)}I", *found)
        if len(self) < self.limit:
            if len(word) <= 64:
                self[word] = ids
        else:
            self.missed += 1
            if self.missed > 8 * self.limit:
                self.clear()
                self.pieces.clear()
                self.missed = 0
        return ids

    def of(self, text: bytes | None, end: int | None = END) -> bytes:
        ids = b"".join([self[w] for w in (text or b"").split()])
        return ids if end is None else ids + struct.pack("<I", end)
