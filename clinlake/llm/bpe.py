"""Byte-level BPE by forced-boundary splitting.

A merge can only make a token of the vocabulary, so two neighbouring bytes that occur next to each other in no
token are never merged: between them lies a certain cut. Pre-tokens are cut there, and each fragment is encoded
on its own and remembered, since fragments recur far more often than texts do; the ids of a text are those of
its fragments one after another.

The vocabulary is read from a ``tokenizers`` JSON file, whose path is a parameter and must be readable on every
executor. Added tokens in a text are tokens, as the library takes them.

Defined results: a null or empty text has no ids; ids outside the vocabulary decode to nothing.
"""

from __future__ import annotations

import json
import unicodedata
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pandas as pd
import regex
import tiktoken
from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the pre-token rule of the byte-level vocabulary.
PRE_TOKEN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: Words, and fragments of words, remembered at most by one worker, and their longest; a full memory starts anew.
REMEMBERED, REMEMBERED_LENGTH = 300_000, 64
LONG_FRAGMENT = 256

#: Texts of code points below this are cut by table, others and those with an apostrophe by the rule itself.
_TABLE_END = 0x250
_OTHER, _LETTER, _NUMBER, _BLANK = range(4)


def _byte_alphabet() -> dict[str, int]:
    """The printable stand-in of each byte: itself where it shows, else the next free code point from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


def _kind(code: int) -> int:
    c = chr(code)
    if regex.fullmatch(r"\s", c):
        return _BLANK
    return {"L": _LETTER, "N": _NUMBER}.get(unicodedata.category(c)[0], _OTHER)


def _remember(known: dict, key: str | bytes, ids: Iterable[int]) -> None:
    if len(known) >= REMEMBERED:
        known.clear()
    if len(key) <= REMEMBERED_LENGTH:
        known[key] = ids


class BytePairEncoder:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        alphabet = _byte_alphabet()
        as_bytes = {token: bytes(map(alphabet.__getitem__, token)) for token in spec["model"]["vocab"] if all(c in alphabet for c in token)}
        vocab = {as_bytes[token]: i for token, i in spec["model"]["vocab"].items() if token in as_bytes}
        self.added = {a["content"]: a["id"] for a in spec["added_tokens"]}
        self.single = [vocab[bytes([b])] for b in range(256)]
        #: left id << 32 | right id -> rank of their merge, and the merged id by rank
        self.ranks: dict[int, int] = {}
        self.merged: list[int] = []
        for pair in spec["model"]["merges"]:
            left, right = (as_bytes[t] for t in (pair if isinstance(pair, list) else pair.split(" ")))
            self.ranks[vocab[left] << 32 | vocab[right]] = len(self.merged)
            self.merged.append(vocab[left + right])
        #: (a, b): some token has byte b right after byte a.
        self.joined: set[tuple[int, int]] = set()
        for token in vocab:
            self.joined.update(zip(token, token[1:], strict=False))
        self.bytes_of = {i: t for t, i in vocab.items()} | {i: c.encode() for c, i in self.added.items()}
        self._added_rule = regex.compile("|".join(map(regex.escape, self.added))) if self.added else None
        self._rule = regex.compile(PRE_TOKEN)
        self._kinds = np.array([_kind(c) for c in range(_TABLE_END)], dtype=np.uint8)
        self._words: dict[str, array] = {}
        self._fragments: dict[bytes, list[int]] = {}

    def pre_tokens(self, text: str) -> list[str]:
        if not text:
            return []
        codes = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
        if codes.max() >= _TABLE_END or "'" in text:
            return self._rule.findall(text)
        kinds = self._kinds[codes]
        n = len(codes)
        starts = np.empty(n + 1, dtype=bool)
        starts[0] = starts[n] = True
        starts[1:n] = kinds[1:] != kinds[:-1]
        # The last blank of a run stands alone before a word, and a space there belongs to the word.
        before_word = np.flatnonzero((kinds[:-1] == _BLANK) & (kinds[1:] != _BLANK))
        starts[before_word] = True
        starts[before_word[codes[before_word] == 0x20] + 1] = False
        cuts = np.flatnonzero(starts).tolist()
        return [text[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]

    def fragments(self, piece: bytes) -> list[bytes]:
        """The piece cut wherever no token has the two bytes next to each other."""
        joined = self.joined
        if all(map(joined.__contains__, zip(piece, piece[1:], strict=False))):
            return [piece]
        cuts = [k for k, pair in enumerate(zip(piece, piece[1:], strict=False), 1) if pair not in joined]
        return [piece[a:b] for a, b in zip([0, *cuts], [*cuts, len(piece)], strict=True)]

    def _encode_word(self, word: str) -> array:
        ids = array("I")
        parts = self.fragments(word.encode())
        if len(parts) == 1:
            ids.extend(self.encode_fragment(parts[0]))
        else:
            for part in parts:
                found = self._fragments.get(part)
                if found is None:
                    found = self.encode_fragment(part)
                    _remember(self._fragments, part, found)
                ids.extend(found)
        _remember(self._words, word, ids)
        return ids

    def encode_fragment(self, fragment: bytes) -> list[int]:
        """The ids of bytes without a certain cut: the merge of lowest rank, leftmost first, until none is left."""
        ids = [self.single[b] for b in fragment]
        if len(ids) > LONG_FRAGMENT:
            return self._encode_long(ids)
        get, none = self.ranks.get, len(self.merged)
        ranks = [get(a << 32 | b, none) for a, b in zip(ids, ids[1:], strict=False)]
        while ranks:
            best = min(ranks)
            if best == none:
                break
            k = ranks.index(best)
            ids[k : k + 2] = [self.merged[best]]
            del ranks[k]
            if k:
                ranks[k - 1] = get(ids[k - 1] << 32 | ids[k], none)
            if k < len(ranks):
                ranks[k] = get(ids[k] << 32 | ids[k + 1], none)
        return ids

    def _encode_long(self, ids: list[int]) -> list[int]:
        """The same merges from a queue, for a fragment too long to be searched once a merge."""
        n, get = len(ids), self.ranks.get
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        alive = [True] * n
        queue = [(rank, k) for k in range(n - 1) if (rank := get(ids[k] << 32 | ids[k + 1])) is not None]
        heapify(queue)
        while queue:
            rank, k = heappop(queue)
            right = after[k]
            if not alive[k] or right >= n or get(ids[k] << 32 | ids[right]) != rank:
                continue
            ids[k], alive[right], after[k] = self.merged[rank], False, after[right]
            if after[k] < n:
                before[after[k]] = k
                if (rank := get(ids[k] << 32 | ids[after[k]])) is not None:
                    heappush(queue, (rank, k))
            if before[k] >= 0 and (rank := get(ids[before[k]] << 32 | ids[k])) is not None:
                heappush(queue, (rank, before[k]))
        return [i for i, a in zip(ids, alive, strict=True) if a]

    def encode(self, text: str | None) -> array:
        """The ids of a whole text."""
        ids = array("I")
        if not text:
            return ids
        known, encode_word = self._words, self._encode_word
        for part, added in self._parts(text):
            if added is not None:
                ids.append(added)
                continue
            for word in self.pre_tokens(part):
                found = known.get(word)
                ids.extend(encode_word(word) if found is None else found)
        return ids

    def _parts(self, text: str) -> Iterable[tuple[str, int | None]]:
        """The text between added tokens, with None, and the added tokens, with their id."""
        at = 0
        if self._added_rule is not None and any(a in text for a in self.added):
            for match in self._added_rule.finditer(text):
                if match.start() > at:
                    yield text[at : match.start()], None
                yield match[0], self.added[match[0]]
                at = match.end()
        if at < len(text):
            yield text[at:], None

    def decode(self, ids: Iterable[int]) -> str:
        return b"".join([self.bytes_of.get(i, b"") for i in ids]).decode("utf-8", "replace")


class LibraryEncoder(BytePairEncoder):
    """The same ids, with words not yet remembered encoded by the tiktoken library from the same vocabulary."""

    def __init__(self, path: str):
        super().__init__(path)
        added = set(self.added.values())
        vocabulary = {token: i for i, token in self.bytes_of.items() if i not in added}
        self._library = tiktoken.Encoding("own", pat_str=PRE_TOKEN, mergeable_ranks=vocabulary, special_tokens={})

    def _encode_word(self, word: str) -> array:
        ids = array("I", self._library.encode_ordinary(word))
        _remember(self._words, word, ids)
        return ids


@lru_cache(maxsize=2)
def encoder(path: str) -> BytePairEncoder:
    """One encoder per worker and vocabulary."""
    return BytePairEncoder(path)


@lru_cache(maxsize=2)
def library_encoder(path: str) -> LibraryEncoder:
    """One per worker and vocabulary, for operators that need ids but are not about encoding."""
    return LibraryEncoder(path)


def encoded(text: Column, path: str) -> Column:
    """The ids of a text column as array<int>."""

    @F.pandas_udf("array<int>")
    def of_texts(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = encoder(path)
        for series in texts:
            yield pd.Series([np.frombuffer(own.encode(t), dtype=np.uint32).astype(np.int32) for t in series], dtype=object)

    return of_texts(text)


def decoded(ids: Column, path: str) -> Column:
    """The text of an id column; null ids are empty."""

    @F.pandas_udf("string")
    def of_ids(lists: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = encoder(path)
        for series in lists:
            yield pd.Series([own.decode(() if i is None else i) for i in series], dtype=object)

    return of_ids(ids)
