"""Token ids of whole documents from a public tokenizer file.

``WordEncoder`` gives exactly the ids of ``Tokenizer.encode(text,
add_special_tokens=False)`` for tokenizers like ``word_bpe_49k.json``: lower case,
white space dropped, words of letters split from other signs, byte-level BPE
within each.  Such a text can be cut at blanks, and what lies between repeats a
lot, so its ids are remembered.  A new piece that is letters with at most a tail
of ASCII signs, which the tokenizer splits there and nowhere else, goes straight to
its model; any other goes through the whole tokenizer, as do texts outside the
range where this is certain.
"""

from __future__ import annotations

import os
import re
import string
import sys
from array import array

import numpy as np

from acqlens.llm.common import remembered, working

# Letters whose lower case and normal form need no look at their neighbours.
_UNCERTAIN = re.compile("[^\x00-įı-ɏ‐-‧‰-⁞]")
_TAIL = string.punctuation
_ENCODERS: dict[str, "WordEncoder"] = {}


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def byte_letters() -> dict[int, int]:
    """Byte-level BPE writes byte b as letter b where that is a visible Latin-1
    sign, and the other bytes, in order, as the letters from 256 on."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    return {b: 256 + k for k, b in enumerate(b for b in range(256) if b not in visible)}


class Remembered(dict):
    """A dict that makes what is missing and forgets what was not asked for while
    ``keep`` bytes of other keys and values were made (about 200 for each pair and
    what both hold)."""

    def __init__(self, make, keep: int):
        super().__init__()
        self.make, self.keep, self.before, self.held = make, keep, {}, 0

    def __missing__(self, key):
        value = self.before.pop(key, None)
        if value is None:
            value = self.make(key)
        self.held += 200 + len(key) + len(value)
        if self.held > self.keep:
            self.before = dict(self)
            super().clear()
            self.held = 200 + len(key) + len(value)
        self[key] = value
        return value

    def clear(self) -> None:
        super().clear()
        self.before, self.held = {}, 0


class WordEncoder:
    def __init__(self, path: str, keep: int = 48 << 20):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        # str.split() parts at these signs of ASCII, the tokenizer keeps them
        self.added += ["\x1c", "\x1d", "\x1e", "\x1f"]
        self.letters = byte_letters()
        self.tokenize = self.tokenizer.model.tokenize
        self.lower = remembered("tokens", Remembered(self._lower_chunk, 2 * keep))
        self.any = remembered("tokens", Remembered(self.encode_whole, keep))

    @property
    def vocabulary(self) -> int:
        return self.tokenizer.get_vocab_size()

    def encode_whole(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return np.asarray(ids, "<u4").tobytes()

    def _word(self, word: str) -> bytes:
        if not word.isascii():  # visible ASCII stands for itself
            word = word.encode().decode("latin-1").translate(self.letters)
        ids = array("I", [t.id for t in self.tokenize(word)])
        return ids.tobytes() if ids.itemsize == 4 and sys.byteorder == "little" else np.asarray(ids, "<u4").tobytes()

    def _lower_chunk(self, chunk: str) -> bytes:
        if chunk.isalpha():
            return self._word(chunk)
        body = chunk.rstrip(_TAIL)
        if not body:
            return self._word(chunk)
        if body.isalpha():
            return self.lower[body] + self.lower[chunk[len(body):]]
        return self.encode_whole(chunk)

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers."""
        if any(a in text for a in self.added):
            return self.encode_whole(text)
        if text.isascii() or not _UNCERTAIN.search(text):
            return b"".join(map(self.lower.__getitem__, text.lower().split()))
        return b"".join(map(self.any.__getitem__, text.split()))

    def encode_many(self, texts: list[str]) -> list[bytes]:
        return list(map(self.encode, texts))


def encoder(path: str) -> WordEncoder:
    """One encoder per worker process and file, which tokenizes from now on."""
    working("tokens")
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]
