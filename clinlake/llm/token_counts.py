"""Token counts by overlap resynchronisation.

A text of at most ``CHUNK`` characters is encoded at once. A longer one is cut into chunks that overlap, and each
chunk is encoded by itself, with offsets; so the memory a text needs beside its own is that of two chunks. Neighbours
are spliced at a position where both cut the text between two pre-tokens and where that cut is proven:

* The pre-token rule looks at nothing before the place it starts from, and at most ``LOOK_AHEAD`` characters behind the
  end of what it takes. So from a common cut on, two scans go on alike until the end of the shorter one comes near.
* A cut of the left chunk is that of the whole text when all that could still change it lies in the chunk: the rule's
  look-ahead, and an added token that starts in what it looks at (the longest one's length).

Pre-tokens are encoded by the library, once each as long as a worker remembers their counts. Where a text has a character
whose class may differ between versions of Unicode, the library cuts it as well, whole chunks at a time.

Tokens never reach over a cut between pre-tokens, so the left chunk gives the tokens up to the splice and the right one
those behind it. Where no proven cut is common to both (one pre-token fills the overlap), the overlap is doubled; where
it would fill the left chunk, that chunk is encoded again from its proven start to twice its length.

The plan has no shuffle: a document is counted by the task that reads it.

Defined results: a null or empty text has no tokens and no bytes; rows with a null doc_id and repeated rows are counted
one by one; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import json
import re
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer, processors

from clinlake.llm.bpe import library_encoder

#: Characters of a chunk, and of the overlap of two at first.
CHUNK, OVERLAP = 16_384, 256
#: The pre-token rule looks this far behind the end of a match: two characters of a contraction, one after blanks.
LOOK_AHEAD = 3
#: Pre-tokens remembered at most by one worker, and their longest; a full memory starts anew.
REMEMBERED, REMEMBERED_LENGTH = 400_000, 64
#: Characters below this are letters, digits, blanks or none in every version of Unicode.
_SETTLED = chr(0x250)

TOKEN_LIMIT = 1024


class _Chunk:
    """The part of a text from start to end: where its pre-tokens start, and the tokens before each of those places."""

    def __init__(self, start: int, end: int, lengths: list[int], tokens: list[int]):
        self.end = end
        self.cuts = [*accumulate(lengths, initial=start)]
        self._before = [*accumulate(tokens, initial=0)]

    def has(self, cut: int) -> bool:
        at = bisect_left(self.cuts, cut)
        return at < len(self.cuts) and self.cuts[at] == cut

    def before(self, cut: int) -> int:
        """Tokens before a cut."""
        return self._before[bisect_left(self.cuts, cut)]


class TokenCounter:
    """Counts as the ``tokenizers`` library does with a byte-level BPE file."""

    def __init__(self, path: str, chunk: int = CHUNK, overlap: int = OVERLAP):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        rule = spec.get("pre_tokenizer") or {}
        own_rule = rule.get("type") == "ByteLevel" and rule.get("use_regex", True) and not rule.get("add_prefix_space")
        plain = not any(a["lstrip"] or a["rstrip"] or a["single_word"] for a in spec["added_tokens"])
        if not own_rule or not plain or spec.get("normalizer"):
            raise ValueError(f"{path}: cuts are proven only for byte-level pre-tokens, no normaliser and plain added tokens")
        self.guard = LOOK_AHEAD + max((len(a["content"]) for a in spec["added_tokens"]), default=0)
        if not self.guard < overlap < chunk:
            raise ValueError("the overlap must be longer than the guard and shorter than the chunk")
        self.chunk, self.overlap = chunk, overlap
        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.no_truncation()
        self._tokenizer.no_padding()
        # Offsets then hold the blank that belongs to a token; ids stay as they are.
        self._tokenizer.post_processor = processors.ByteLevel(trim_offsets=False)
        self._pre_tokens = library_encoder(path).pre_tokens
        added = sorted((a["content"] for a in spec["added_tokens"]), key=len, reverse=True)
        self._added = re.compile(f"({'|'.join(map(re.escape, added))})") if added else None
        self._known: dict[str, int] = {}
        #: How often a pair of chunks had no proven common cut.
        self.widened = 0

    def _learn(self, word: str) -> int:
        n = len(self._tokenizer.encode(word, add_special_tokens=False))
        if len(self._known) >= REMEMBERED:
            self._known.clear()
        if len(word) <= REMEMBERED_LENGTH:
            self._known[word] = n
        return n

    def _words(self, text: str) -> list[str] | None:
        """The pre-tokens and added tokens of a text, or None where only the library can tell."""
        if not text.isascii() and max(text) >= _SETTLED:
            return None
        if self._added is None or not self._added.search(text):
            return self._pre_tokens(text)
        # Every second part of the split is an added token.
        return [word for k, part in enumerate(self._added.split(text)) for word in ([part] if k % 2 else self._pre_tokens(part))]

    def _tokens(self, words: list[str]) -> list[int]:
        known, learn = self._known, self._learn
        return [n if (n := known.get(word)) is not None else learn(word) for word in words]

    def count(self, text: str) -> int:
        """The tokens of a text."""
        if len(text) > self.chunk:
            return self.count_long(text)
        words = self._words(text)
        return len(self._tokenizer.encode(text, add_special_tokens=False)) if words is None else sum(self._tokens(words))

    def _encoded(self, text: str, start: int, end: int) -> _Chunk:
        words = self._words(text[start:end])
        if words is not None:
            return _Chunk(start, end, list(map(len, words)), self._tokens(words))
        found = self._tokenizer.encode(text[start:end], add_special_tokens=False)
        first = np.flatnonzero(np.diff(np.array(found.word_ids, dtype=np.int64), prepend=-1)).tolist()
        offsets = found.offsets
        at = [offsets[k][0] for k in first]
        return _Chunk(start, end, np.diff([*at, end - start]).tolist(), np.diff([*first, len(found)]).tolist())

    def count_long(self, text: str) -> int:
        """The tokens of one text, chunk by chunk."""
        total = proven = 0
        left = self._encoded(text, 0, min(self.chunk, len(text)))
        while left.end < len(text):
            overlap, cut = self.overlap, None
            while cut is None:
                if overlap < left.end - proven:
                    end = min(left.end + self.chunk - self.overlap, len(text))
                    right = self._encoded(text, left.end - overlap, end)
                    cut = self._common_cut(left, right, proven)
                if cut is None:
                    self.widened += 1
                    overlap *= 2
                    if overlap >= left.end - proven:
                        left = self._encoded(text, proven, min(left.end + max(self.chunk, left.end - proven), len(text)))
                        break
            if cut is not None:
                total += left.before(cut) - left.before(proven)
                left, proven = right, cut
        return total + left.before(len(text)) - left.before(proven)

    def _common_cut(self, left: _Chunk, right: _Chunk, proven: int) -> int | None:
        """The first cut of both behind a proven one that nothing outside the left chunk can change."""
        for cut in right.cuts:
            if cut > left.end - self.guard:
                return None
            if cut > proven and left.has(cut):
                return cut
        return None


@lru_cache(maxsize=2)
def counter(path: str) -> TokenCounter:
    """One per worker and file."""
    return TokenCounter(path)


def token_count(text: Column, path: str) -> Column:
    """The number of tokens of a text column as long, null texts being empty."""

    @F.pandas_udf("long")
    def of_texts(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = counter(path)
        for series in texts:
            yield pd.Series(list(map(own.count, series)), dtype="int64")

    return of_texts(F.coalesce(text, F.lit("")))


def token_counts(docs: DataFrame, path: str, limit: int = TOKEN_LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit (more tokens than the limit) of every row."""
    n_bytes = F.octet_length(F.coalesce(F.col("text"), F.lit(""))).cast("long")
    counted = docs.select("doc_id", n_bytes.alias("n_bytes"), token_count(F.col("text"), path).alias("n_tokens"))
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
