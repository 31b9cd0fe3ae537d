"""Byte-level BPE ids of whole texts through the tokenizers library, with a cache over words.

The library's byte-level pre-tokenizer cuts a text into parts that are encoded independently. We cut at
places where it always cuts (before a space that precedes a non-space, around other white space, and after
Latin letters that precede white space, a full stop or a comma), look each part up and encode only new parts.
Texts that hold an added token's string, or control characters on which Python and the library disagree
about white space, are encoded as a whole.
"""

from __future__ import annotations

import os
import re

import numpy as np

LETTERS = "A-Za-zÀ-ÖØ-öø-ɏ"
PARTS = re.compile(rf" ?[{LETTERS}]+(?![^\s.,])| ?\S+|\s+(?!\S)|\s+")
WORDS = re.compile(rf" ?[{LETTERS}]+")
#: Cached parts of a Python worker; the cache starts anew beyond, which bounds its memory at some 200 MB.
CACHE_PARTS = 1_000_000


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_alphabet() -> dict[int, str]:
    """The byte-level alphabet: printable bytes stand for themselves, the others follow from 256 on."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return {b: chr(b) if b in own else chr(next(rest)) for b in range(256)}


class Encoder:
    """ids of a text as little-endian unsigned integers of ``dtype`` (bytes)."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        added = [re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.whole = re.compile("|".join([*added, "[\x1c-\x1f]"]))
        self.alphabet = byte_alphabet()
        self.cache: dict[str, bytes] = {}

    def direct(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()

    def part(self, part: str) -> bytes:
        if WORDS.fullmatch(part):  # the pre-tokenizer leaves it whole
            found = self.tokenizer.model.tokenize(part.encode().decode("latin-1").translate(self.alphabet))
            ids = np.array([t.id for t in found], self.dtype).tobytes()
        else:
            ids = self.direct(part)
        self.cache[part] = ids
        return ids

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if self.whole.search(text):
            return self.direct(text)
        if len(self.cache) > CACHE_PARTS:
            self.cache.clear()
        get, new = self.cache.get, self.part
        return b"".join([get(p) or new(p) for p in PARTS.findall(text)])


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per Python worker and file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]
