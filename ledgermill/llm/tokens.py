"""Token ids of whole texts, for use inside tasks.

A byte-pair vocabulary never merges across a single space between two visible characters, so a text
is cut there and each piece is looked up in a cache of packed ids, bounded by bytes. Texts that have other
white space beside a space, or the string of a special token, are encoded in one go.
"""

from __future__ import annotations

import base64
import sys
from functools import lru_cache
from pathlib import Path

import numpy as np

CACHE_BYTES = 64 << 20  # of each of the two caches of an encoder
LONG_PIECE = 1024  # characters; longer pieces are encoded each time
ENTRY_BYTES = 100  # about what a dictionary takes for an entry
# Up to here both libraries are taken to agree on letters, digits and spaces; beyond, only the
# vocabulary's own library is asked.
PLAIN_LIMIT = "ɐ"


class _Pieces(dict):
    """Packed ids (little-endian unsigned 32-bit) by piece; None for one that can't stand alone."""

    def __init__(self, prefix: str, encode):
        self.prefix, self.encode, self.held = prefix, encode, 0

    def __missing__(self, piece: str):
        alone = piece and not piece[0].isspace() and not piece[-1].isspace()
        packed = self.encode(self.prefix + piece) if alone else None
        if len(piece) <= LONG_PIECE:
            size = sys.getsizeof(piece) + sys.getsizeof(packed) + ENTRY_BYTES
            if self.held + size > CACHE_BYTES:
                self.clear()
                self.held = 0
            self.held += size
            self[piece] = packed
        return packed


class Encoder:
    """Encodes with a tokenizer file of the ``tokenizers`` library, no special tokens added.

    ``ranks_file`` optionally names the same vocabulary as merge ranks, which ``tiktoken`` encodes
    several times as fast with the same ids.
    """

    def __init__(self, tokenizer_file: str, ranks_file: str | None, pattern: str | None):
        from tokenizers import Tokenizer

        self.full = Tokenizer.from_file(tokenizer_file)
        self.specials = [t.content for t in self.full.get_added_tokens_decoder().values()]
        self.fast = None
        if ranks_file:
            import tiktoken

            lines = Path(ranks_file).read_bytes().splitlines()
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            self.fast = tiktoken.Encoding(
                "ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}
            )
        self.first, self.rest = _Pieces("", self._encode), _Pieces(" ", self._encode)

    def _encode(self, text: str) -> bytes:
        if self.fast is not None and text and max(text) < PLAIN_LIMIT:
            ids = self.fast.encode_ordinary(text)
        else:
            ids = self.full.encode(text, add_special_tokens=False).ids
        return np.array(ids, dtype="<u4").tobytes()

    def packed(self, text: str) -> bytes:
        """Ids of a text, four little-endian bytes each."""
        if not text:
            return b""
        if any(s in text for s in self.specials):
            ids = self.full.encode(text, add_special_tokens=False).ids
            return np.array(ids, dtype="<u4").tobytes()
        head, *tail = text.split(" ")
        found = [self.first[head], *map(self.rest.__getitem__, tail)]
        return self._encode(text) if None in found else b"".join(found)


@lru_cache(maxsize=4)
def encoder(tokenizer_file: str, ranks_file: str | None = None, pattern: str | None = None):
    """One encoder a Python worker and vocabulary."""
    return Encoder(tokenizer_file, ranks_file, pattern)
