"""Byte-pair encoders over public vocabulary files, and a vectorised decoder.

Both encoders return ids as little-endian unsigned 32-bit bytes and agree with
the ``tokenizers`` library on the same file (``add_special_tokens=False``,
truncation and padding unused).  The merge loop itself runs in ``tiktoken``,
which takes the vocabulary of the same file as ranks; texts that hold the
string of a special token go through ``tokenizers``.
"""

from __future__ import annotations

import functools
import json
import re
import sys
import unicodedata
from array import array

import numpy as np
import regex

#: Letters, digits and so on as a byte-level split takes them (fixed by the vocabulary file).
BYTE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: The split of the lower-case vocabulary with word ends (fixed by the vocabulary file).
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


@functools.cache
def _char_bytes() -> dict[str, int]:
    """The printable character that stands for each byte in vocabulary files, reversed."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    table = {chr(b): b for b in plain}
    for n, b in enumerate(b for b in range(256) if b not in set(plain)):
        table[chr(256 + n)] = b
    return table


def _as_bytes(token: str) -> bytes:
    table = _char_bytes()
    return bytes(table[c] for c in token)


def pack_ids(ids: list[int]) -> bytes:
    out = array("I", ids)
    if sys.byteorder == "big":
        out.byteswap()
    return out.tobytes()


class _Encoder:
    """What both vocabularies share."""

    def __init__(self, path: str):
        self.path = path
        spec = json.load(open(path, encoding="utf-8"))  # noqa: SIM115
        self.vocab: dict[str, int] = spec["model"]["vocab"]
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.special_ids = {t["content"]: t["id"] for t in spec["added_tokens"]}

    @functools.cached_property
    def library(self):
        """Loaded by those who need it, as are merge ranks: a worker that only decodes holds neither."""
        from tokenizers import Tokenizer

        out = Tokenizer.from_file(self.path)
        out.no_truncation()
        out.no_padding()
        return out

    def by_library(self, text: str) -> bytes:
        return pack_ids(self.library.encode(text, add_special_tokens=False).ids)


class ByteEncoder(_Encoder):
    """Byte-level vocabulary: lossless, no normalisation."""

    def __init__(self, path: str):
        super().__init__(path)
        size = max([*self.vocab.values(), *self.special_ids.values()]) + 1
        pieces = [b""] * size
        for t, i in self.vocab.items():
            pieces[i] = _as_bytes(t)
        for t, i in self.special_ids.items():
            pieces[i] = t.encode()
        self._lens = np.array([len(p) for p in pieces], np.int64)
        self._starts = np.cumsum(self._lens) - self._lens
        self._flat = np.frombuffer(b"".join(pieces), np.uint8)

    @functools.cached_property
    def _fast(self):
        import tiktoken

        ranks = {_as_bytes(t): i for t, i in self.vocab.items() if t not in self.special_ids}
        return tiktoken.Encoding("byte", pat_str=BYTE_PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> bytes:
        if any(s in text for s in self.special):
            return self.by_library(text)
        return pack_ids(self._fast.encode_ordinary(text))

    def encode_plain(self, text: str) -> list[int]:
        """Ids of a text in which strings of special tokens are ordinary text."""
        return self._fast.encode_ordinary(text)

    @property
    def lengths(self) -> np.ndarray:
        """Bytes of each id's token."""
        return self._lens

    @property
    def _narrow(self) -> bool:
        return self._lens.size <= 1 << 16

    def narrow(self, ids: bytes) -> bytes:
        """Ids in two bytes each, if the vocabulary allows it."""
        return np.frombuffer(ids, "<u4").astype("<u2").tobytes() if self._narrow else ids

    def widen(self, ids: bytes) -> bytes:
        return np.frombuffer(ids, "<u2").astype("<u4").tobytes() if self._narrow else ids

    def decode(self, ids: bytes) -> str:
        """As ``decode(ids, skip_special_tokens=False)``; ids outside the vocabulary add nothing."""
        x = np.frombuffer(ids, "<u4").astype(np.int64)
        x = x[x < self._lens.size]
        lens = self._lens[x]
        ends = np.cumsum(lens)
        if not ends.size:
            return ""
        take = np.repeat(self._starts[x] - (ends - lens), lens) + np.arange(ends[-1])
        return self._flat[take].tobytes().decode("utf-8", "replace")


class WordEncoder(_Encoder):
    """Lower-case vocabulary with word ends.

    Nothing that this vocabulary's normaliser or split looks at crosses white
    space, so a text's ids are those of its white-space-separated words, each of
    which is encoded once and kept in a memo of at most ``memo_words`` words.
    In the ranks the word end is the byte 0xFF, which UTF-8 never holds.
    """

    def __init__(self, path: str, memo_words: int = 500_000):
        import tiktoken

        super().__init__(path)
        end = "</w>"
        ranks: dict[bytes, int] = {}
        for t, i in self.vocab.items():
            if t not in self.special_ids:
                ranks[_as_bytes(t[: -len(end)]) + b"\xff" if t.endswith(end) and t != end else _as_bytes(t)] = i
        self._pieces = tiktoken.Encoding("word", pat_str=r"[^\n]+", mergeable_ranks=ranks, special_tokens={})._core_bpe
        self._split = regex.compile(WORD_PATTERN)
        self._plain = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\sa-z0-9]+")
        outer, limit = self, memo_words

        class Memo(dict):
            def __missing__(self, word: str) -> bytes:
                if len(self) >= limit:
                    self.clear()
                self[word] = out = outer._word(word)
                return out

        class Pieces(dict):
            def __missing__(self, piece: str) -> bytes:
                if len(self) >= limit:
                    self.clear()
                self[piece] = out = pack_ids(outer._pieces.encode_single_piece(piece.encode() + b"\xff"))
                return out

        self._memo, self._piece = Memo(), Pieces()

    #: White space to Python alone; such texts go through the library.
    _ODD = re.compile("[\x1c-\x1f]")

    def _word(self, word: str) -> bytes:
        if "<|" in word:
            return self.by_library(word)
        if word.isascii():
            pieces = self._plain.findall(word.lower())
        else:
            pieces = self._split.findall("".join([c.lower() for c in unicodedata.normalize("NFC", word)]))
        return self._piece[pieces[0]] if len(pieces) == 1 else b"".join([self._piece[p] for p in pieces])

    def encode(self, text: str) -> bytes:
        if self._ODD.search(text):
            return self.by_library(text)
        return b"".join(map(self._memo.__getitem__, text.split()))


def resolve(path: str) -> str:
    """A vocabulary file by path, or by name among the public tokenizers that are installed."""
    if "/" in path:
        return path
    import public_tokenizers

    return public_tokenizers.path(path)


@functools.lru_cache(maxsize=4)
def byte_encoder(path: str) -> ByteEncoder:
    return ByteEncoder(resolve(path))


@functools.lru_cache(maxsize=4)
def word_encoder(path: str) -> WordEncoder:
    return WordEncoder(resolve(path))
