"""Token ids of a public tokenizer, remembered per pre-token.

The vocabulary is byte-level BPE and the library cuts a text into pre-tokens before any merge. Texts made of plain
letters, digits, signs, single blanks and single line feeds are cut here by the same rule, and the model of the
tokenizers library merges each different pre-token once for as long as it is remembered. Any other text is cut before
blanks that follow a character other than white space, where no pre-token crosses, and only the words that aren't
plain go through the whole library. What is remembered lies in two generations of GENERATION entries: a full one
becomes the old one, and what is asked for again moves to the new one. That changes the time, never the ids.
"""

from __future__ import annotations

import os
import re

import numpy as np

GENERATION = 300_000
PIECE_CHARS = 64
LONG_CHARS = 4096

# The library's pre-tokens, in the ranges in which Unicode's letters, digits and signs are settled. Fixed values.
PLAIN = re.compile(
    r"'(?:s|t|re|ve|m|ll|d)| ?[A-Za-zÀ-ÖØ-öø-ʯ]+| ?[0-9]+| ?[!-/:-@\[-`{-~]+|\n(?=[!-~À-ÖØ-öø-ʯ])"
)

_encoders: dict[str, Encoder] = {}


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class _Memory(dict):
    """Two generations of what was found for short strings."""

    def __init__(self, find):
        super().__init__()
        self.find = find
        self.old: dict[str, bytes] = {}

    def __missing__(self, text: str) -> bytes:
        ids = self.old.get(text)
        if ids is None:
            ids = self.find(text)
        if len(text) <= PIECE_CHARS:
            if len(self) >= GENERATION:
                self.old.clear()
                self.old.update(self)
                self.clear()
            self[text] = ids
        return ids


class _Merges:
    """The ids of a pre-token, by the tokenizer's model."""

    def __init__(self, tokenizer):
        self.model = tokenizer.model
        printable = set(tokenizer.pre_tokenizer.alphabet())
        rest = iter(sorted(printable - {chr(b) for b in range(256)}))  # for bytes without a character, in byte order
        self.to_chars = {b: chr(b) if chr(b) in printable else next(rest) for b in range(256)}
        self.blank, self.feed = self.to_chars[32], self.to_chars[10]

    def __call__(self, piece: str) -> bytes:
        if piece.isascii():
            chars = piece.replace(" ", self.blank).replace("\n", self.feed)
        else:
            chars = piece.encode().decode("latin-1").translate(self.to_chars)
        return b"".join([token.id.to_bytes(4, "little") for token in self.model.tokenize(chars)])


class Encoder:
    """Ids as little-endian unsigned 32-bit bytes. Strings of special tokens in a text are ordinary text."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.merges = _Merges(self.tokenizer)
        self.known = _Memory(self.merges)
        self._bytes: list[bytes] | None = None

    def decode(self, ids: list[int]) -> str:
        """The text that was encoded to the ids."""
        if self._bytes is None:
            to_byte = {char: byte for byte, char in self.merges.to_chars.items()}
            vocabulary = self.tokenizer.get_vocab()
            self._bytes = [b""] * (max(vocabulary.values()) + 1)
            for token, nr in vocabulary.items():
                self._bytes[nr] = bytes(to_byte[char] for char in token)
        return b"".join([self._bytes[nr] for nr in ids]).decode()

    def encode(self, text: str | None) -> bytes:
        """The ids of a whole text; null and empty texts have none."""
        if not text:
            return b""
        ids = self._plain(text)
        return b"".join(map(self._part, self._parts(text))) if ids is None else ids

    def _plain(self, text: str) -> bytes | None:
        pieces = PLAIN.findall(text)
        if len("".join(pieces)) != len(text):
            return None
        return b"".join(map(self.known.__getitem__, pieces))

    def _part(self, part: str) -> bytes:
        ids = self._plain(part)
        if ids is None:
            ids = np.array(self.tokenizer.encode(part, add_special_tokens=False).ids, dtype="<u4").tobytes()
        return ids

    def _parts(self, text: str):
        """A text in stretches of plain words and stretches of others, some LONG_CHARS long at most where blanks allow it.

        A cut lies before a blank that follows a character other than white space.
        """
        held, plain, size = [], True, 0
        first = True
        for word in text.split(" "):
            # a word after white space, or ending in it, stays with what is before it
            joined = not first and (not held[-1] or held[-1][-1].isspace())
            fits = bool(word) and len("".join(PLAIN.findall(word))) == len(word)
            if not first and not joined and (fits != plain or size > LONG_CHARS):
                yield "".join(held)
                held, size, plain = [], 0, fits
            elif first:
                plain = fits
            else:
                plain = plain and fits
            held.append(word if first else " " + word)
            size += len(held[-1])
            first = False
        yield "".join(held)


def encoder(path: str) -> Encoder:
    """One encoder for each worker process and vocabulary file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]
