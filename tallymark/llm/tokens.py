"""Token ids of whole texts with a public tokenizer, encoded once per distinct chunk.

A text is cut where the tokenizer's own splitting always cuts, so that the ids of the
chunks, put together, are the ids of the text.  Chunks repeat, and a task keeps the ids
of recent ones in two generations of bounded size.  A new chunk of a byte-level tokenizer
is cut once more behind the word it begins with, whose ids are often known from a chunk
with other marks behind it.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Callable, Iterable
from functools import lru_cache

import public_tokenizers
from tokenizers import Tokenizer

#: Chunks kept per generation, and the longest that is kept.
CACHED_CHUNKS, CACHED_LENGTH = 400_000, 64

# White space as the tokenizers see it: \s without the four separators that only Python counts.
_WHITE, _DARK = r"[^\S\x1c-\x1f]", r"[\S\x1c-\x1f]"
# A word in Latin letters and what follows it; letters are one piece for the tokenizers, up to a mark, digit or blank.
_WORD = re.compile(r"( ?[A-Za-zÀ-ÖØ-öø-ÿ]+)([\s0-9!-&(-/:-@\[-`{-~].*)?", re.DOTALL)
_BYTE_LEVEL = re.compile(rf" ?{_DARK}+|{_WHITE}+(?!{_DARK})|{_WHITE}+")


class ChunkCache:
    """Results by chunk: the older generation is dropped when the newer one is full."""

    def __init__(self, make: Callable[[str], bytes], chunks: int = CACHED_CHUNKS):
        self.make, self.chunks = make, chunks
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def __call__(self, chunks: list[str]) -> list[bytes]:
        found = list(map(self.new.get, chunks))
        if None in found:
            for i, ids in enumerate(found):
                if ids is None:
                    found[i] = self.one(chunks[i])
        return found

    def clear(self) -> None:
        self.new, self.old = {}, {}

    def one(self, chunk: str) -> bytes:
        ids = self.new.get(chunk)
        if ids is None:
            ids = self.old.get(chunk)
            if ids is None:
                ids = self.make(chunk)
            if len(chunk) <= CACHED_LENGTH:
                if len(self.new) >= self.chunks:
                    self.old, self.new = self.new, {}
                self.new[chunk] = ids
        return ids


def _byte_signs() -> dict[int, str]:
    """How byte-level vocabularies write each byte: printable ones as they are, the others by the signs from 256 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + n) for n, b in enumerate(others)}


_BYTE_SIGNS = _byte_signs()


def load(name: str) -> Tokenizer:
    """A public tokenizer by file name, without truncation and padding."""
    tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def packed(ids: Iterable[int]) -> bytes:
    """Ids as little-endian unsigned 32-bit integers."""
    listed = list(ids)
    return struct.pack(f"<{len(listed)}I", *listed)


def special_pattern(tokenizer: Tokenizer) -> re.Pattern:
    """Finds the special tokens, which the library takes out of a text before it splits it."""
    contents = sorted((t.content for t in tokenizer.get_added_tokens_decoder().values()), key=len, reverse=True)
    return re.compile("(" + "|".join(map(re.escape, contents)) + ")")


class Encoder:
    """Ids of whole texts as the library gives them, packed."""

    def __init__(self, name: str, chunks: int = CACHED_CHUNKS):
        self.library = load(name)
        self.special = special_pattern(self.library)
        self.normalize = self.library.normalizer.normalize_str if self.library.normalizer else None
        self.split, self.merge = self.library.pre_tokenizer.pre_tokenize_str, self.library.model.tokenize
        spec = self.library.pre_tokenizer.__getstate__()
        byte_level = b'"use_regex":true' in spec
        # The other kind drops white space, so any of it ends a chunk.
        self.chunks = _BYTE_LEVEL.findall if byte_level else lambda text: text.encode().split()
        self.plain_bytes = byte_level and self.normalize is None and b'"add_prefix_space":false' in spec
        self.cache = ChunkCache(self._ids, chunks)

    def _ids(self, chunk) -> bytes:
        """The library's steps one by one, which spares what else it notes of a short text."""
        text = chunk if isinstance(chunk, str) else chunk.decode()
        word = _WORD.fullmatch(text) if self.plain_bytes else None
        if word is not None:
            if word[2]:
                return self.cache.one(word[1]) + self.cache.one(word[2])
            # One piece: its bytes, as the vocabulary writes them, go straight to the merges.
            return packed(token.id for token in self.merge(text.encode().decode("latin-1").translate(_BYTE_SIGNS)))
        if self.normalize is not None:
            text = self.normalize(text)
        return packed(token.id for part, _ in self.split(text) for token in self.merge(part))

    def encode(self, text: str) -> bytes:
        if "<|" not in text:
            return b"".join(self.cache(self.chunks(text)))
        parts = []
        for part in self.special.split(text):
            if self.special.fullmatch(part):
                parts.append(packed([self.library.token_to_id(part)]))
            else:
                parts += self.cache(self.chunks(part))
        return b"".join(parts)


@lru_cache(maxsize=4)
def encoder(name: str, chunks: int = CACHED_CHUNKS) -> Encoder:
    """One encoder per worker process and tokenizer."""
    return Encoder(name, chunks)
