"""The encoder against the tokenizers library."""

import hashlib
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from clinlake.llm import bpe
from clinlake.llm.queries.bpe import VOCABULARY, op9_bpe_round_trip

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def same(library, text):
    expected = library.encode(text, add_special_tokens=False).ids
    own = bpe.encoder(VOCABULARY)
    assert list(own.encode(text)) == expected, text
    assert list(bpe.library_encoder(VOCABULARY).encode(text)) == expected, text
    assert own.decode(expected) == library.decode(expected, skip_special_tokens=False)


@pytest.mark.parametrize("text", ["", " ", "\n\n a", "don't 'll x", "<|endoftext|>a <|endoftext|><|endo", "a" * 3000, "ab" * 900, "é" * 700, "中文字 ab", "\x85\xa0 x"])
def test_same_ids(library, text):
    same(library, text)


def test_random_texts(library):
    rng = random.Random(5)
    parts = [*"ab'sS  \n\t\r1²éßÀ٣中😀́_#!", "<|endoftext|>", "'ll", "the ", "  "]
    for _ in range(800):
        same(library, "".join(rng.choices(parts, k=rng.randint(0, 40))))


def test_fragments_end_where_no_token_goes_on():
    own = bpe.encoder(VOCABULARY)
    for piece in (b"abc\x00\xffde", "thé中".encode(), b""):
        parts = own.fragments(piece)
        assert b"".join(parts) == piece
        assert all((a[-1], b[0]) not in own.joined for a, b in zip(parts, parts[1:], strict=False))


def test_memory_starts_anew(monkeypatch, library):
    monkeypatch.setattr(bpe, "REMEMBERED", 3)
    own = bpe.BytePairEncoder(VOCABULARY)
    text = "one two three four five six one two ünë\x00ü"
    assert list(own.encode(text)) == library.encode(text, add_special_tokens=False).ids
    assert len(own._words) <= 3


def test_columns(spark):
    frame = spark.createDataFrame([(1, "a b<|endoftext|>", 3), (2, None, 4), (3, "", 5)], "doc_id long, text string, ids int")
    ids = frame.select("doc_id", bpe.encoded(frame["text"], VOCABULARY).alias("x"))
    back = {r.doc_id: r.t for r in ids.select("doc_id", bpe.decoded(ids["x"], VOCABULARY).alias("t")).collect()}
    assert back == {1: "a b<|endoftext|>", 2: "", 3: ""}


def test_query_against_the_library(spark, library):
    def sha256(text):
        return hashlib.sha256(text.encode()).hexdigest()

    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    found = {r.doc_id: r[1:] for r in op9_bpe_round_trip(spark, SF_DIR).collect()}
    assert found.keys() == texts.keys()
    for doc_id, text in texts.items():
        ids = library.encode(text, add_special_tokens=False).ids
        assert found[doc_id] == (len(ids), sha256(",".join(map(str, ids))), sha256(library.decode(ids, skip_special_tokens=False)))
