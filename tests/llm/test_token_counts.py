"""Counts by overlapping chunks against the library's count of the whole text."""

import random
from functools import lru_cache

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from clinlake.llm import token_counts
from clinlake.llm.queries.token_counts import op11_token_counts

SF_DIR = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    own = Tokenizer.from_file(PATH)
    return lambda text: len(own.encode(text, add_special_tokens=False).ids)


def test_random_texts_in_small_chunks(library):
    rng = random.Random(11)
    parts = [*"ab'sS  \n\t\r1²éßÀ٣中😀́_#!", "<|endoftext|>", "<|endof", "text|>", "'ll", "'re", "the ", "    ", "supercalifragilistic"]
    counters = [token_counts.TokenCounter(PATH, chunk, overlap) for chunk, overlap in ((18, 17), (24, 17), (60, 20), (200, 40))]
    for k in range(2000):
        # Every other text is one whose characters all versions of Unicode know.
        text = "".join(p for p in rng.choices(parts, k=rng.randint(0, 160)) if k % 2 or p < "\u0250")
        for own in counters:
            assert own.count_long(text) == library(text), repr(text)
            assert own.count(text) == library(text), repr(text)
    assert all(own.widened for own in counters)


@pytest.mark.parametrize(
    "text",
    ["a" * 50_000, "ab" * 20_000, " " * 40_000 + "x", "x" + " " * 40_000, "\n " * 20_000, "中" * 30_000, "é" * 20_000, "<|endoftext|>" * 4_000, "'ll" * 15_000,
     "word " * 10_000 + "a" * 40_000 + " word" * 10_000, "x " * 9_000 + "<|endoftext|" + "y " * 9_000],
    ids=lambda text: repr(text[:8]),
)
def test_long_texts(library, text):
    own = token_counts.counter(PATH)
    assert list(map(own.count, [text, "", text[:70]])) == [library(text), 0, library(text[:70])]


def test_an_added_token_over_the_end_of_a_chunk(library):
    """Two blanks before it are one pre-token, but two if the token is cut off."""
    for lead in range(30):
        text = "a" * lead + "  <|endoftext|>" + " b" * 30
        for chunk in range(18, 40):
            assert small_chunks(chunk).count_long(text) == library(text)


@lru_cache(maxsize=None)
def small_chunks(chunk):
    return token_counts.TokenCounter(PATH, chunk, 17)


def test_memory_starts_anew(library, monkeypatch):
    monkeypatch.setattr(token_counts, "REMEMBERED", 3)
    own = token_counts.TokenCounter(PATH)
    text = "one two three four one two " + "w" * 100
    assert own.count(text) == library(text) and len(own._known) <= 3


def test_one_giant_word_widens_until_it_fits(library):
    own = token_counts.TokenCounter(PATH, 64, 17)
    text = "one two " + "abc" * 700 + " three"
    assert own.count_long(text) == library(text)
    assert own.widened > 3


def test_other_pre_tokens_are_refused():
    with pytest.raises(ValueError, match="proven"):
        token_counts.TokenCounter(public_tokenizers.path("word_bpe_49k.json"))


def test_odd_rows(spark, library):
    rows = [(1, None, 5), (2, "", 5), (2, "", 5), (None, "a b", 5), (3, "é" * 20_000, 5), (4, "x " * 1024, 5), (5, "x " * 512, 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    found = token_counts.token_counts(docs, PATH)
    expected = [(i, len((t or "").encode()), library(t or ""), library(t or "") > 1024) for i, t, _ in rows]
    assert sorted(map(tuple, found.collect()), key=str) == sorted(expected, key=str)
    assert token_counts.token_counts(docs.limit(0), PATH).count() == 0


def test_query_against_the_library(spark, library):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    found = op11_token_counts(spark, SF_DIR)
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
    rows = found.collect()
    assert {r.doc_id for r in rows} == texts.keys() and len(rows) == len(texts)
    for r in rows:
        n = library(texts[r.doc_id])
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(texts[r.doc_id].encode()), n, n > 1024)
