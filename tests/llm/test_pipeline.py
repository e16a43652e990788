"""Each stage of the pipeline against a plain version, on its own input."""

import numpy as np
import pytest

import corpus_pipeline
from clinlake.llm import bpe, quality, secrets, simhash
from clinlake.llm.queries.bpe import VOCABULARY

SF_DIR = "/root/testdata/sf0.01"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def outcomes(spark, tmp_path_factory):
    """Rows into and out of every stage, by name."""
    docs, found = spark.read.parquet(f"{SF_DIR}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp(name) / "rows")
        stage(spark, docs, SF_DIR).write.parquet(path)
        before, docs = docs.collect(), spark.read.parquet(path)
        found[name] = (before, docs.collect(), docs.columns)
    return found


def test_stages_return_document_columns(outcomes):
    assert [outcomes[name][2] for name, _ in corpus_pipeline.STAGES[:-1]] == [COLUMNS] * 4


def test_quality_keeps_what_the_verdict_keeps(spark, outcomes):
    before, after, _ = outcomes["quality_rules"]
    rows = quality.judged(spark.createDataFrame(before), COLUMNS).collect()
    kept = {r["_doc"].doc_id: r for r in rows if r.kept}
    assert {r.doc_id for r in after} == kept.keys() and len(after) == len(kept)
    for r in after:
        source, gone = kept[r.doc_id]["_doc"], set(kept[r.doc_id]["_removed"] or ())
        assert r.text == "\n".join(line for k, line in enumerate(source.text.split("\n")) if k not in gone)
        assert r.n_chars == len(r.text) and (r.lang, r.source) == (source.lang, source.source)


def test_toxic_documents_go_and_clean_ones_stay(spark, outcomes):
    before, after, _ = outcomes["toxicity"]
    toxic = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    kept = {r.doc_id for r in after}
    assert kept <= {r.doc_id for r in before} and {r for r in after} <= {r for r in before}
    clean = [r.doc_id for r in before if toxic.get(r.doc_id) == 0]
    bad = [r.doc_id for r in before if toxic.get(r.doc_id) == 1]
    assert sum(d in kept for d in clean) >= 0.98 * len(clean)
    assert sum(d in kept for d in bad) <= 0.3 * len(bad)


def test_one_document_of_each_group_stays(outcomes):
    before, after, _ = outcomes["near_duplicates"]
    prints = {r.doc_id: simhash.fingerprint(r.text) for r in before}
    label = {d: d for d in prints}
    changed = True
    while changed:
        changed = False
        for a, p in prints.items():
            low = min(label[b] for b, q in prints.items() if (p ^ q).bit_count() <= 2)
            if low < label[a]:
                label[a], changed = low, True
    assert sorted(r.doc_id for r in after) == sorted(set(label.values()))
    assert {r for r in after} <= {r for r in before}


def test_secrets_are_replaced(outcomes):
    before, after, _ = outcomes["secrets"]
    redacted = {r.doc_id: r for r in after}
    assert len(after) == len(before)
    for r in before:
        spans = secrets.scanner().spans(r.text)
        assert redacted[r.doc_id].text == secrets.redact(r.text, spans)
        assert redacted[r.doc_id].n_chars == len(redacted[r.doc_id].text)
        assert not [s for s in secrets.scanner().spans(redacted[r.doc_id].text) if s[0] != "assign"]


def test_packing_holds_every_token(outcomes):
    before, after, _ = outcomes["packing"]
    own = bpe.library_encoder(VOCABULARY)
    pieces = {}
    for r in after:
        pieces.setdefault(r.doc_id, []).append((r.start, np.frombuffer(r.ids, dtype="<u4").tolist()))
    assert {d: [i for _, part in sorted(p) for i in part] for d, p in pieces.items()} == {r.doc_id: [*own.encode(r.text), 1] for r in before}


def test_odd_documents_pass_all_stages(spark):
    rows = [
        (1, None, None, None, None, "x"), (2, "", "en", "s", 0, "x"), (2, "", "en", "s", 0, "x"), (None, "word " * 30, "en", "s", 150, "x"),
        (3, " ".join(f"w{k}" for k in range(30000)), "en", None, 1, "x"), (3, " ".join(f"w{k}" for k in range(30000)), "en", None, 1, "x"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, _key string")
    for case in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            case = stage(spark, case, SF_DIR)
        assert {r.doc_id for r in case.collect()} <= {1, 2, 3, None}
