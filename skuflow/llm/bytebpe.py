"""Byte-level BPE over pre-tokens: whole tokens are looked up, the rest merged.

A byte-level BPE splits a text into pre-tokens and merges the bytes of each one
alone, so a text's tokens are those of its pre-tokens. For every vocabulary
string it is proven once, on the driver, whether it encodes alone as one token:
merges are greedy by rank, and not every entry is reached from its own bytes. A
pre-token equal to a proven string then is that one token; any other one is
merged, by the library's model, and remembered.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import regex
from tokenizers import Tokenizer

# fixed value: the pre-tokens of a byte-level pre-tokenizer
PRE_TOKENS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# fixed value: bytes that a byte-level vocabulary writes as themselves; the others follow from 256 on
PLAIN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
SLICE = 1 << 16        # characters of a text that are split at a time, about
REMEMBER = 1 << 18     # merged pre-tokens that a worker keeps
LONG = 64              # characters of a pre-token that is never kept


def byte_letters() -> list[str]:
    """The letter of every byte in a byte-level vocabulary."""
    others = iter(range(0x100, 0x200))
    plain = set(PLAIN)
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


def unnamed(text: str) -> bool:
    """Whether a character is one that this Python's Unicode tables do not name: libraries with
    other tables may class it differently, so such a text goes to the library's own splitter."""
    return any(unicodedata.category(c) == "Cn" for c in set(text) if c > "\u0377")


# a space between two words: no pre-token goes on beyond the character before it
_GAP = re.compile(r"(?<=\S) (?=\S)")


def slices(text: str, size: int = SLICE) -> Iterator[str]:
    """``text`` in parts of about ``size`` characters that begin at the space before a word.

    A part without such a space stays whole, whatever its length.
    """
    at = 0
    while len(text) - at > size:
        gap = _GAP.search(text, at + size)
        if gap is None:
            break
        yield text[at:gap.start()]
        at = gap.start()
    yield text[at:]


class ByteBPE:
    """One tokenizer file (its JSON text), with the proven strings if they are given."""

    def __init__(self, spec: str, whole: frozenset[str] | None = None):
        known = json.loads(spec)
        pre, model = known.get("pre_tokenizer") or {}, known.get("model") or {}
        if known.get("normalizer") or pre.get("type") != "ByteLevel" or not pre.get("use_regex", True) \
                or pre.get("add_prefix_space") or model.get("type") != "BPE" or model.get("ignore_merges") \
                or model.get("continuing_subword_prefix") or model.get("end_of_word_suffix") or model.get("dropout"):
            raise ValueError("not a plain byte-level BPE: its pre-tokens are not merged byte by byte and alone")
        added = known.get("added_tokens") or []
        if any(a.get("lstrip") or a.get("rstrip") or a.get("single_word") for a in added):
            raise ValueError("added tokens that take in their surroundings are not split off here")
        self.library = Tokenizer.from_str(spec)
        self.library.no_padding()
        self.library.no_truncation()
        self.model, self.split = self.library.model, regex.compile(PRE_TOKENS).findall
        names = sorted({a["content"] for a in added}, key=lambda s: (-len(s), s))
        self.added = re.compile("|".join(map(re.escape, names))) if names else None
        self.letters = dict(enumerate(byte_letters()))
        self.bytes_of = {v: k for k, v in self.letters.items()}
        self.vocab: dict[str, int] = model["vocab"]
        self.whole = self.proven() if whole is None else whole
        self.sizes = _Sizes(self)
        self.lists = _Lists(self)

    def spelled(self, piece: str) -> str:
        return piece.encode("utf-8").decode("latin-1").translate(self.letters)

    def entry_bytes(self, entry: str) -> bytes:
        return bytes(map(self.bytes_of.__getitem__, entry))

    def proven(self) -> frozenset[str]:
        """Every vocabulary entry that is valid text and encodes alone as itself, as text."""
        out = []
        for entry, i in self.vocab.items():
            found = self.model.tokenize(entry)
            if len(found) == 1 and found[0].id == i:
                try:
                    out.append(self.entry_bytes(entry).decode("utf-8"))
                except (UnicodeDecodeError, KeyError):
                    continue  # part of a character: no pre-token equals it
        return frozenset(out)

    def merged(self, piece: str) -> list[int]:
        return [t.id for t in self.model.tokenize(self.spelled(piece))]

    def pieces(self, text: str) -> Iterator[list[str]]:
        """The pre-tokens of ``text``, a slice at a time."""
        if not text.isascii() and unnamed(text):
            yield [text[a:b] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(text)]
        else:
            for part in slices(text):
                yield self.split(part)

    def count(self, text: str) -> int:
        """Tokens of ``text``; an added token's string inside it is that one token."""
        n, parts = 0, [text]
        if self.added is not None:
            parts = self.added.split(text)
            n = len(parts) - 1
        whole, size = self.whole, self.sizes.__getitem__
        for part in parts:
            for pieces in self.pieces(part):
                rest = [p for p in pieces if p not in whole]
                n += len(pieces) - len(rest) + sum(map(size, rest))
        return n

    def ids(self, text: str) -> np.ndarray:
        """Token ids of ``text``, strings of added tokens as plain text."""
        known = self.lists.__getitem__
        parts = [np.fromiter(chain.from_iterable(map(known, p)), np.int32) for p in self.pieces(text)]
        return np.concatenate(parts) if parts else np.zeros(0, np.int32)


class _Remembered(dict):
    def __init__(self, bpe: ByteBPE):
        super().__init__()
        self.bpe = bpe

    def __missing__(self, piece: str):
        value = self.of(piece)
        if len(piece) <= LONG:
            if len(self) >= REMEMBER:
                self.clear()
            self[piece] = value
        return value


class _Sizes(_Remembered):
    def of(self, piece: str) -> int:
        return len(self.bpe.merged(piece))


class _Lists(_Remembered):
    def of(self, piece: str) -> list[int]:
        if piece in self.bpe.whole:
            return [self.bpe.vocab[self.bpe.spelled(piece)]]
        return self.bpe.merged(piece)


@lru_cache(maxsize=2)
def loaded(spec: str, whole: frozenset[str]) -> ByteBPE:
    """The tokenizer of this worker process."""
    return ByteBPE(spec, whole)


def plain_text(raw: bytes | None) -> str:
    return "" if raw is None else bytes(raw).decode("utf-8", "replace")
