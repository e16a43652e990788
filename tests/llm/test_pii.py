"""Personal data: base rules against plain regexes, the model on data it was not trained on."""

import hashlib
import random
import re

import numpy as np
import pyarrow.parquet as pq
import pytest

from clinlake.llm import pii, tagger
from clinlake.llm.queries.pii import op10_personal_data

SF_DIR = "/root/testdata/sf0.001"
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def valid(kind, found):
    digits = re.sub("[^0-9]", "", found)
    if kind == "ip":
        return all(int(p) <= 255 for p in found.split("."))
    if kind == "card":
        return 14 <= len(digits) <= 19 and sum(sum(divmod(int(d) * (1 + k % 2), 10)) for k, d in enumerate(digits[::-1])) % 10 == 0
    return kind == "email" or 10 <= len(digits) <= 15


def by_definition(text):
    found = []
    for order, (kind, rule) in enumerate(PLAIN.items()):
        found += [(m.start(), order, m.end()) for m in re.finditer(rule, text) if valid(kind, m[0])]
    return sorted(found)


@pytest.fixture(scope="module")
def pieces():
    texts = pq.read_table(f"{SF_DIR}/documents.parquet", columns=["text"])["text"].to_pylist()
    return [t[k : k + pii.PIECE_CHARS] for t in texts for k in range(0, min(len(t), 4000), 400)]


@pytest.fixture(scope="module")
def model(spark, pieces):
    return pii.fit(spark.createDataFrame(list(enumerate(pieces[::2])), "doc_id long, text string"))


def test_base_rules_on_random_texts():
    rng = random.Random(4)
    parts = [*"a1.@+-() 9é\n", "4111 1111 1111 1111", "1.2.3.4", "256", "x@y.zz", "+1 (555) 123-4567", "0001", "@@", "..", "٣"]
    for _ in range(6000):
        text = "".join(rng.choices(parts, k=rng.randint(0, 14)))
        assert pii.base_spans(text) == by_definition(text), text


def test_base_rules_take_long_runs():
    for text in ("a" * 300000 + "@", "1" * 300000, "1." * 100000, "+" * 100000, "@" * 100000):
        pii.base_spans(text)


def test_gradients():
    own, rng = tagger.Tagger(3, 1), np.random.default_rng(0)
    for name in ("emit", "bias", "transitions"):
        setattr(own, name, getattr(own, name).astype(float))
    x, y = rng.integers(0, tagger.N_SYMBOLS, (6, 4)), rng.integers(0, 3, (6, 4))
    _, grads = own._loss_gradients(x, y)
    for parameter, gradient in list(zip(own._parameters(), grads, strict=True))[4:]:
        place = np.unravel_index(np.abs(gradient).argmax(), gradient.shape)
        parameter[place] += 1e-5
        above, _ = own._loss_gradients(x, y)
        parameter[place] -= 2e-5
        below, _ = own._loss_gradients(x, y)
        parameter[place] += 1e-5
        assert (above - below) / 2e-5 == pytest.approx(gradient[place], rel=1e-3)


def test_decoding_is_the_best_path_and_quiet_windows_have_none(model):
    rng = np.random.default_rng(3)
    e = rng.normal(0, 2, (4, 5, 60)).astype(np.float32)
    e[:, 0] += 1.5
    tags, paths = model.decode(e), np.array(np.meshgrid(*[range(5)] * 4)).reshape(4, -1)
    for w in range(e.shape[2]):
        scores = sum(e[t, paths[t], w] for t in range(4)) + sum(model.transitions[paths[t], paths[t + 1]] for t in range(3))
        assert scores.max() == pytest.approx(sum(e[t, tags[t, w], w] for t in range(4)) + sum(model.transitions[tags[t, w], tags[t + 1, w]] for t in range(3)), rel=1e-5)
    assert not tags[:, model.quiet(e)].any()


def test_held_out_accuracy(model, pieces):
    rng = np.random.default_rng(99)
    rows = [pii.example(p, rng) for p in pieces[1:801:2]]
    x, y = (np.stack(part, axis=1) for part in zip(*rows, strict=True))
    found = model.decode(model.emissions(x))
    assert (found == y).mean() > 0.96
    assert ((found == y) & (y > 0)).sum() / (y > 0).sum() > 0.85


def test_windows_are_reconciled(model):
    phone = "+44 (555) 123-4567"
    filler = "the words go on and on here "
    for lead in range(200, 260, 7):
        text = (filler * 20)[:lead] + " " + phone + " " + filler * 12
        tags = pii.tagged([text], model)[0]
        assert tags is not None
        start = text.index(phone)
        assert (tags[start : start + len(phone)] == 4).mean() > 0.6


def test_added_spans(model):
    text = "write to john.smith (at) mail dot com or call (555) 123-4567 today, not on 2024-01-02 at 10:11:12"
    added = {text[s:e] for _, s, e, base in pii.spans([text], model)[0] if not base}
    assert added <= {"john.smith (at) mail dot com", "(555) 123-4567"} and added


def test_query(spark):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    rows = op10_personal_data(spark, SF_DIR).collect()
    assert {r.doc_id for r in rows} == texts.keys()
    for r in rows:
        base = by_definition(texts[r.doc_id])
        joined = [f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in base]
        assert r.base_sha256 == hashlib.sha256(",".join(joined).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(b[1] == k for b in base) for k in range(4)]
        assert set(joined) <= set(r.spans.split(",")) | {""}


def test_edge_cases(spark, model):
    frame = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (2, "", "x"), (3, "x " * 100000 + "a@b.cc", "x")], "doc_id long, text string, spans string")
    rows = frame.select("doc_id", pii.found_spans(frame["text"], model).alias("s")).collect()
    assert sorted((r.doc_id, len(r.s)) for r in rows) == [(1, 0), (2, 0), (2, 0), (3, 1)]
    assert frame.limit(0).select(pii.found_spans(frame["text"], model)).count() == 0


def test_all_items_of_a_run():
    def added(text, kind):
        return [text[s:e] for s, _, e in pii._added(text, 0, len(text), pii.KINDS.index(kind), pii._cover([]))]

    cards = ["4111 1111 1111 1111", "5500-0000-0000-0004", "3782.822463.10005"]
    assert added(" ".join(cards[:2]), "card") == cards[:2]
    assert added(", ".join(cards), "card") == cards
    assert added("999.1.1.1 10 . 0 . 0 . 1", "ip") == ["10 . 0 . 0 . 1"]
    assert added("a at b.example, c (at) d dot org", "email") == ["a at b.example", "c (at) d dot org"]
    long = "x" * 300 + " at " + "y" * 200 + " dot org"
    assert added(long, "email") == [long]


def test_added_spans_keep_clear_of_base_spans():
    text = "10 . 0 . 0 . 1 and 10 . 0 . 0 . 2"
    for base in ([(0, 1, 14)], [(3, 0, 4), (0, 2, 2)], [(13, 1, 16)]):
        assert [text[s:e] for s, _, e in pii._added(text, 0, len(text), 1, pii._cover(base))] == ["10 . 0 . 0 . 2"]
    many = "1.2.3.4 " * 50_000
    assert not list(pii._added(many, 0, len(many), 1, pii._cover(pii.base_spans(many))))
