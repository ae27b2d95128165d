"""Exact encoding of texts by cached pieces, for byte-level tokenizers that split words at spaces.

In such a tokenizer a pre-token never reaches across a space that stands before a visible
character: the space opens the next pre-token. So a text may be cut at these spaces and its pieces
encoded one by one. Each worker keeps what it has encoded; a piece is first looked up, then built
from its pre-tokens, and only pre-tokens not held go to the library. A pre-token that opens
with a space is kept as the piece it would be alone, so it is held once. A text that holds one of
the vocabulary's special strings is encoded whole.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from typing import Any

import regex
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel

#: The pre-token pattern of byte-level BPE vocabularies (a fixed value).
PRE_TOKEN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
#: Spaces before a character that is surely no white space, and spaces before any other.
CUT = re.compile("(?<!\\A) (?=[!-~¡-ɏ])")
OTHER = re.compile("\\A | (?![!-~¡-ɏ])")
#: Characters that all Unicode versions class alike.
PLAIN = re.compile("[\t\n\r -~¡-ɏ]*")


def byte_letters() -> dict[int, str]:
    """Byte (as Latin-1 character) -> the letter byte-level vocabularies write it with: itself if
    printable, else the next one from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = [b for b in range(256) if b not in shown]
    return {b: chr(256 + rest.index(b)) if b in rest else chr(b) for b in range(256)}


class _Cache(dict):
    """Computes what is missing. At ``limit`` entries they become the older of two generations, from which
    what is still used moves on; so its size is bounded and it follows a change of content."""

    def __init__(self, compute: Callable[[str], Any], limit: int, known: dict | None = None):
        super().__init__(known or {})
        self.compute, self.limit, self.known, self.older = compute, limit + len(known or {}), known or {}, {}

    def __missing__(self, key: str):
        found = self.older.get(key)
        if found is None:
            found = self.compute(key)
        if len(self) >= self.limit:
            self.older = dict(self)
            self.clear()
            self.update(self.known)
        self[key] = found
        return found


class Encoder:
    """``of(text)``: the joined values of the text's pieces.

    ``value`` turns the ids of a pre-token into what is kept, ``joined`` adds such values up.
    ``known`` holds values of frequent pre-tokens. Memory is bounded by ``limit`` entries a cache and generation.
    """

    def __init__(self, path: str, value: Callable, joined: Callable, limit: int = 700_000, known: dict | None = None):
        self.library = Tokenizer.from_file(path)
        if self.library.normalizer is not None or not isinstance(self.library.pre_tokenizer, ByteLevel):
            raise ValueError("pieces are exact for byte-level vocabularies without normalizer only")
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.letters, self.value, self.joined = byte_letters(), value, joined
        known = known or {}
        # pieces without their leading space; pre-tokens that have none
        self.pieces = _Cache(self.spaced, limit,
                             {t[1:]: v for t, v in known.items() if t[0] == " " and t.strip()})
        self.bare = _Cache(self.pre_token, limit // 4, {t: v for t, v in known.items() if t[0] != " "})

    def pre_token(self, token: str):
        spelled = token.encode().decode("latin-1").translate(self.letters)
        return self.value([t.id for t in self.library.model.tokenize(spelled)])

    def whole(self, text: str):
        return self.value(self.library.encode(text, add_special_tokens=False).ids)

    def spaced(self, word: str):
        """The piece made of a space and the word; letters of the first 128 characters are one pre-token."""
        if word.isascii() and word.isalpha():
            return self.value([t.id for t in self.library.model.tokenize(self.letters[32] + word)])
        return self.piece(" " + word)

    def piece(self, piece: str):
        if not PLAIN.fullmatch(piece):
            return self.whole(piece)
        tokens = PRE_TOKEN.findall(piece)
        if len(tokens) == 1:
            return self.pre_token(piece)
        return self.joined([self.pieces[t[1:]] if t[0] == " " and t[1:].strip() else self.bare[t] for t in tokens])

    def of(self, text: str):
        if any(s in text for s in self.special):
            return self.whole(text)
        head, *rest = CUT.split(text) if OTHER.search(text) else text.split(" ")
        return self.joined([self.piece(head), *map(self.pieces.__getitem__, rest)])


_ENCODERS: dict[tuple, Encoder] = {}


def worker_encoder(kind: str, path: str, value: Callable, joined: Callable, known: dict | None = None) -> Encoder:
    """One encoder per worker process and kind; later tasks find its caches warm."""
    key = (kind, path, len(known or ()))
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(path, value, joined, known=known)
    return _ENCODERS[key]
