"""BPE encoding as a bounded-lookahead transducer, and incremental decoding.

Merges never cross the end of a pre-token, and what follows a place changes the tokens
before it only through a chain of merges: the token on its right side was taken by an
earlier merge, so its left neighbour stays free for a later one, and so on.  Rules in
such a chain have rising ranks, and each one's right part is the left part of the one
before, so the longest chain of the merge list bounds how far back any text can reach.
That is the sufficient lookahead: tokens that end so many symbols before the end of what
has been read are final, are emitted, and are forgotten.  A pre-token of any length thus
needs a window of bounded size.

Normalising and splitting into pre-tokens follow the tokenizer file; the merges here are
done by its merge list.  Decoding goes token by token and keeps only the bytes of an
unfinished character.

Defined cases: a null text is empty and has no ids; special tokens written out in a text
get their ids, as in the library.
"""

from __future__ import annotations

import codecs
import json
from collections.abc import Iterable, Iterator
from functools import lru_cache

import public_tokenizers

from tallymark.llm.tokens import ChunkCache, load, packed, special_pattern

END = "</w>"
_NEVER = 1 << 60


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    out, extra = [""] * 256, 0
    for byte in range(256):
        out[byte] = chr(byte if byte in plain else 256 + extra)
        extra += byte not in plain
    return out


def sufficient_lookahead(merges: list[tuple[str, str]]) -> int:
    """Symbols after which what was read can no longer change: the longest chain, and the token that starts it."""
    length = lambda token: len(token.removesuffix(END)) or 1
    reach: dict[str, int] = {}
    longest = 0
    for left, right in reversed(merges):
        chain = length(left) + reach.get(left, 0)
        reach[right] = max(reach.get(right, 0), chain)
        longest = max(longest, chain)
    return longest + max((length(a + b) for a, b in merges), default=1)


class Merges:
    """The vocabulary and merge list of a tokenizer file."""

    def __init__(self, name: str):
        with open(public_tokenizers.path(name), encoding="utf-8") as file:
            model = json.load(file)["model"]
        self.ids: dict[str, int] = model["vocab"]
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.rank = {pair: i for i, pair in enumerate(pairs)}
        self.joined = [a + b for a, b in pairs]
        self.end = model.get("end_of_word_suffix") or ""
        self.lookahead = sufficient_lookahead(pairs)

    def apply(self, symbols: list[str]) -> list[str]:
        """Lowest rank first, leftmost among equals, until no pair merges."""
        rank, joined = self.rank.get, self.joined
        ranks = [rank(pair, _NEVER) for pair in zip(symbols, symbols[1:])]  # noqa: B905
        while ranks:
            best = min(ranks)
            if best == _NEVER:
                break
            at = ranks.index(best)
            symbols[at : at + 2] = [joined[best]]
            del ranks[at]
            if at:
                ranks[at - 1] = rank((symbols[at - 1], symbols[at]), _NEVER)
            if at < len(ranks):
                ranks[at] = rank((symbols[at], symbols[at + 1]), _NEVER)
        return symbols


class Transducer:
    """Tokens of one pre-token whose symbols arrive piece by piece."""

    def __init__(self, merges: Merges):
        self.merges = merges
        self.window = 4 * merges.lookahead
        self.waiting: list[str] = []

    def push(self, symbols: str) -> list[str]:
        """Tokens that have become final.  The last symbol may still turn out to end the word, so it waits."""
        final: list[str] = []
        for start in range(0, len(symbols), self.window):
            self.waiting += symbols[start : start + self.window]
            if len(self.waiting) > self.window:
                final += self._stable()
        return final

    def _stable(self) -> list[str]:
        known = self.waiting[:-1]
        tokens = self.merges.apply(list(known))
        at, n, limit = 0, 0, len(known) - self.merges.lookahead
        while at + len(tokens[n]) <= limit:
            at += len(tokens[n])
            n += 1
        self.waiting = self.waiting[at:]
        return tokens[:n]

    def finish(self) -> list[str]:
        """The tokens left when the pre-token ends."""
        tokens, self.waiting = self.waiting, []
        if tokens:
            tokens[-1] += self.merges.end
        return self.merges.apply(tokens)


class BpeEncoder:
    """Ids of whole texts by the transducer, packed as little-endian 32-bit integers."""

    def __init__(self, name: str):
        self.merges = Merges(name)
        rules = load(name)
        self.normalize, self.split = rules.normalizer.normalize_str, rules.pre_tokenizer.pre_tokenize_str
        self.special, self.special_id = special_pattern(rules), rules.token_to_id
        self.cache = ChunkCache(self._ids)

    def _ids(self, chunk: bytes) -> bytes:
        tokens: list[str] = []
        for symbols, _ in self.split(self.normalize(chunk.decode())):
            transducer = Transducer(self.merges)
            tokens += transducer.push(symbols)
            tokens += transducer.finish()
        return packed(map(self.merges.ids.__getitem__, tokens))

    def encode(self, text: bytes) -> bytes:
        # White space separates pre-tokens and leaves none of its own.
        if b"<|" not in text:
            return b"".join(self.cache(text.split()))
        parts = []
        for part in self.special.split(text.decode()):
            if self.special.fullmatch(part):
                parts.append(packed([self.special_id(part)]))
            else:
                parts += self.cache(part.encode().split())
        return b"".join(parts)


class TextDecoder:
    """Bytes of tokens to text, character by character; an unfinished character waits for the next token."""

    def __init__(self, vocabulary: dict[int, str], end: str = END):
        self.tokens, self.end = vocabulary, end
        self.byte = {c: i for i, c in enumerate(byte_alphabet())}
        self.state = codecs.getincrementaldecoder("utf-8")("replace")

    def push(self, ids: Iterable[int]) -> Iterator[str]:
        for i in ids:
            token = self.tokens[i]
            ends = bool(self.end) and token.endswith(self.end)
            body = token.removesuffix(self.end) if ends else token
            try:
                raw = bytes(self.byte[c] for c in body)
            except KeyError:  # a special token is its own text
                raw = body.encode()
            yield self.state.decode(raw) + (" " if ends else "")

    def finish(self) -> str:
        return self.state.decode(b"", final=True)


class TokenDecoder:
    """What the library's decode gives for a file without a decoder: the vocabulary's tokens, joined by spaces."""

    def __init__(self, tokens: list[str]):
        self.tokens, self.started = tokens, False

    def push(self, ids: Iterable[int]) -> str:
        text = " ".join(map(self.tokens.__getitem__, ids))
        if self.started and text:
            text = " " + text
        self.started = self.started or bool(text)
        return text


@lru_cache(maxsize=2)
def encoder(name: str) -> BpeEncoder:
    """One encoder per worker process and tokenizer."""
    return BpeEncoder(name)


@lru_cache(maxsize=2)
def token_list(name: str) -> list[str]:
    """Token strings by id, special tokens included."""
    by_id = {i: t for t, i in load(name).get_vocab(with_added_tokens=True).items()}
    return [by_id.get(i, "") for i in range(max(by_id) + 1)]
