"""Quality rules: odd texts against plain counts, shared lines, what is kept."""

import random
import re
from collections import Counter

import pytest

from clinlake.llm import quality


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[k : k + 8]) for k in range(len(words) - 7)]
    often = Counter(windows)
    covered = {p for k, w in enumerate(windows) if often[w] > 1 for p in range(k, k + 8)}
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered), failed


def texts():
    rng = random.Random(1)
    odd = [None, "", " \n\t ", "one", "a " * 50, "x y z\n" * 9, "\x0b\x0c a\r\nb", "# <$> é中 &", " ".join(f"w{k}" for k in range(20000)), "w " * 30000]
    parts = [*"abcde#<", "\n", " ", "  ", "the", "of", " ", "a b c d e f g h "]
    return odd + [" ".join(rng.choices(parts, k=rng.randint(0, 120))) for _ in range(150)]


def test_measures(spark):
    rows = list(enumerate(texts()))
    docs = spark.createDataFrame([(i, t, "s", 3) for i, t in rows], "doc_id long, text string, source string, n_words int")
    found = {r["_doc"].doc_id: r for r in quality.measures(docs).collect()}
    for i, t in rows:
        r = found[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == plain(t), repr(t)[:80]


def body(k):
    return "\n".join(" ".join(f"w{k}x{n}y{m}" for m in range(12)) for n in range(4))


@pytest.fixture(scope="module")
def docs(spark):
    shared = "Shared   LINE of the host, all rights reserved"
    rows = [(k, body(k) + "\n" + shared, "en", "a", 0) for k in range(30)] + [(100 + k, body(100 + k), "en", "a", 0) for k in range(30)]
    rows += [(200 + k, body(200 + k) + "\n" + shared.lower(), "en", "b", 0) for k in range(5)]  # too few documents of this host
    rows += [(300, body(300), "en", "c", 0)] * 40  # one text, however often
    rows += [(400, "\n".join([shared] * 8), "en", "a", 0), (500, None, None, None, None), (None, body(9), None, None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


def test_shared_lines(docs):
    lines = quality.shared_lines(docs).collect()
    assert [(r["_host"], r.n_documents) for r in lines] == [("a", 31)]


def test_kept_documents(docs):
    kept = quality.kept_documents(docs)
    assert kept.columns == docs.columns
    rows = kept.collect()
    assert Counter(r.doc_id for r in rows) == Counter([*range(30), *range(100, 130), *range(200, 205), *[300] * 40, None])
    for r in rows:
        if r.doc_id is not None and r.doc_id < 30:
            assert r.text == body(r.doc_id) and r.n_chars == len(r.text)
    assert quality.kept_documents(docs.limit(0)).count() == 0


def test_a_depleted_document_is_rejected(docs):
    rows = {r["_doc"].doc_id: r for r in quality.judged(docs).collect()}
    assert not rows[400].kept and rows[400].words_left == 0
    assert rows[5].words_left == rows[5].n_words - 8 and rows[5].kept


def test_no_python(docs):
    assert "Python" not in quality.kept_documents(docs)._jdf.queryExecution().executedPlan().toString()


def test_near_copies_keep_their_lines(spark):
    """50 copies of a text, one of its ten lines edited in each, on a host with 300 texts and a line that 60 of them share."""
    notice = "all rights reserved by this host"
    lines = [" ".join(f"c{n}y{m}" for m in range(12)) for n in range(10)] + [notice]
    copies = [[f"edit {k} " + line if n == k % 10 else line for n, line in enumerate(lines)] for k in range(50)]
    rows = [(k, "\n".join(copy), "h") for k, copy in enumerate(copies)]
    rows += [(100 + k, body(100 + k) + ("\n" + notice if k < 60 else ""), "h") for k in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    assert {r["_doc"].doc_id for r in quality.judged(docs).filter("kept").collect()} == {k for k, _, _ in rows}
    kept = {r.doc_id: r.text for r in quality.kept_documents(docs).collect()}
    assert kept == {k: text.removesuffix("\n" + notice) for k, text, _ in rows}


def test_the_limit_does_not_grow_with_the_host(spark):
    """120 of 9,000 texts share a line: below two per cent, but above the absolute limit; 60 share another one."""
    rows = [(k, " ".join(f"w{k}x{m}" for m in range(24)) + ("\nshared by many" if k < 120 else "\nshared by fewer" if k < 180 else ""), "big") for k in range(9000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    assert [r.n_documents for r in quality.shared_lines(docs).collect()] == [120]
    kept = {r.doc_id: r.text for r in quality.kept_documents(docs).collect()}
    assert not any("many" in t for t in kept.values()) and sum("fewer" in t for t in kept.values()) == 60
