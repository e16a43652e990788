"""The clause grammar, and held-out accuracy."""

import zlib

import numpy as np
import pytest

from clinlake.llm import toxicity
from clinlake.llm.queries.toxicity import op4_toxicity

SF_DIR = "/root/testdata/sf0.01"
MODEL = toxicity.ToxicityModel({"idiot": 5.0, "lowei*": 4.0})


@pytest.mark.parametrize(
    ("text", "outcome"),
    [
        ("You are an idiot.", "insult at target"),
        ("what an IDIOT", "insult"),
        ("so loweischaft hier", "insult"),
        ("not an idiot", "denied"),
        ("not that I mind but what an idiot", "insult"),
        ("she wrote: nothing. he said idiot", "reported"),
        ("I will kill you", "threat at target"),
        ("never kill anyone", "denied"),
        ("You sit. Idiot", "insult"),
    ],
)
def test_outcome_of_a_clause(text, outcome):
    sums = MODEL.sums(text)
    assert [o for o, s in zip(toxicity.OUTCOMES, sums, strict=True) if s] == [outcome]


def test_strongest_arc_counts_once_a_clause():
    assert MODEL.sums("idiot loweix idiot. idiot")[toxicity.OUTCOMES.index("insult")] == pytest.approx(np.log1p(10.0))


def test_clean_and_empty_texts_score_the_bias():
    assert MODEL.score("") == MODEL.score("nothing to see") < 0.5 < MODEL.score("you idiot")


def test_held_out_accuracy(spark):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    rows = op4_toxicity(spark, SF_DIR).collect()
    assert len(rows) == spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in rows)
    held = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    assert sum(p == t for p, t in held) / len(held) > 0.9
    assert sum(p for p, t in held if t) / sum(t for _, t in held) > 0.5


def test_edge_cases(spark):
    docs = spark.createDataFrame([(1, None, 1), (1, None, 1), (None, "you idiot", 1), (3, "x " * 100000, 1)], "doc_id long, text string, toxic int")
    labels = spark.createDataFrame([(1, None), (None, 1), (3, 0), (3, 0)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    assert model.lexicon == {}
    assert docs.select(toxicity.scored(docs["text"], model)).count() == 4
    assert toxicity.fit(docs.limit(0), labels.limit(0)).weights.tolist() == toxicity.PRIOR.tolist()
