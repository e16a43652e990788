"""Neighbours on Hilbert curves against brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from clinlake.llm import curves
from clinlake.llm.queries.curves import op5_hilbert_neighbours

SF_DIR = "/root/testdata/sf0.01"


@pytest.mark.parametrize(("dimensions", "bits"), [(1, 5), (2, 4), (3, 3)])
def test_the_curve_visits_every_cell_and_moves_to_a_neighbour(dimensions, bits):
    cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dimensions), axis=-1).reshape(-1, dimensions)
    keys = curves.hilbert_keys(cells, bits)
    assert sorted(keys) == list(range(len(cells)))
    steps = np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(1)
    assert (steps == 1).all()


def brute_force(rows, queries, k=10):
    found = {}
    for q in queries:
        vector = dict(rows)[q]
        near = sorted((math.dist(vector, v), i) for i, v in rows if i != q)[:k]
        found[q] = near
    return found


def test_recall_and_exact_scores(spark):
    rows = [(r.vec_id, list(map(float, r.embedding))) for r in spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()]
    expected = brute_force(rows, [i for i, _ in rows if i % 100 == 0])
    found = {}
    for r in op5_hilbert_neighbours(spark, SF_DIR).collect():
        found.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert found.keys() == expected.keys()
    vectors, hits = dict(rows), 0
    for q, near in expected.items():
        own = sorted(found[q])
        assert [r for r, _, _ in own] == list(range(1, 11))
        assert all(s == pytest.approx(math.dist(vectors[q], vectors[i]), rel=1e-12) for _, i, s in own)
        assert [(s, i) for _, i, s in own] == sorted((s, i) for _, i, s in own)
        hits += len({i for _, i, _ in own} & {i for _, i in near})
    assert hits >= 0.9 * 10 * len(expected)


def test_copies_ties_and_bad_vectors(spark):
    hot = [1.0, 2.0]
    rows = [(i, hot) for i in range(0, 400)] + [(1000 + i, [float(i), 0.5]) for i in range(30)]
    bad = [(2000, None), (2100, [0.0, 0.0]), (2200, [None, 1.0]), (2300, [float("nan"), 1.0]), (2400, [float("inf"), 1.0]), (2500, [1.0]), (None, hot)]
    frame = spark.createDataFrame([(i, v, 1.0) for i, v in [*rows, *rows[:5], *bad]], "vec_id long, embedding array<float>, score double")
    found = {}
    for r in curves.nearest(frame, F.col("vec_id") % 100 == 0).collect():
        found.setdefault(r.query_id, []).append((r["rank"], r.score, r.vec_id))
    expected = brute_force(rows, [0, 100, 200, 300, 1000])
    assert {q: [(s, i) for _, s, i in sorted(v)] for q, v in found.items()} == expected


def test_few_and_no_rows(spark):
    frame = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0])], "vec_id long, embedding array<float>")
    rows = curves.nearest(frame, F.col("vec_id") == 0).collect()
    assert [(r.query_id, r["rank"], r.vec_id) for r in rows] == [(0, 1, 1)]
    assert curves.nearest(frame.limit(0), F.col("vec_id") == 0).count() == 0
    assert curves.nearest(frame, F.col("vec_id") == 9).count() == 0


def test_doubles_stay_doubles(spark):
    floats = curves.usable(spark.createDataFrame([(0, [1.0])], "vec_id long, embedding array<float>"))
    assert floats.select(*curves._same(floats)).schema["embedding"].dataType.simpleString() == "array<float>"
    rng = np.random.default_rng(2)
    rows = [(i, [*map(float, v)]) for i, v in enumerate(rng.normal(size=(40, 3)))] + [(100, [-0.0, 1.0, 0.1]), (101, [0.0, 1.0, 0.1])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = {}
    for r in curves.nearest(frame, F.col("vec_id") % 100 == 0).collect():
        found.setdefault(r.query_id, []).append((r["rank"], r.score, r.vec_id))
    assert {q: [(pytest.approx(s, rel=1e-14), i) for _, s, i in sorted(v)] for q, v in found.items()} == brute_force(rows, [0, 100])
