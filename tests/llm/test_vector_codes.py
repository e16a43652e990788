"""Codes against a plain Lloyd iteration over all parts."""

import hashlib
import math
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from clinlake.llm import vector_codes
from clinlake.llm.integer_vectors import integer_vectors
from clinlake.llm.queries.vector_codes import op13_vector_codes

SF_DIR = "/root/testdata/sf0.01"


def plain(rows, parts=16, entries=64, rounds=2):
    """vec_id, code, error, label_error and digest of the codebooks, by loops over Python integers."""
    kept = [(i, [math.floor(256 * float(c)) for c in v], label) for i, v, label in rows]
    width = len(kept[0][1]) // parts
    smallest = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    codes, errors, books = [""] * len(kept), [0] * len(kept), []
    for p in range(parts):
        own = [tuple(v[p * width : (p + 1) * width]) for _, v, _ in kept]
        book = [v[p * width : (p + 1) * width] for _, v, _ in smallest]

        def nearest(part, book=book):
            return min((sum((a - b) ** 2 for a, b in zip(part, entry, strict=True)), e) for e, entry in enumerate(book))

        for _ in range(rounds):
            found = {part: nearest(part) for part in set(own)}
            members = {}
            for part in own:
                members.setdefault(found[part][1], []).append(part)
            for e, of_entry in members.items():
                book[e] = [sum(column) // len(of_entry) for column in zip(*of_entry, strict=True)]
        found = {part: nearest(part) for part in set(own)}
        for k, part in enumerate(own):
            codes[k] += f"{found[part][1]:02x}"
            errors[k] += found[part][0]
        books.append(book)
    by_label = Counter()
    for (_, _, label), error in zip(kept, errors, strict=True):
        by_label[label] += error
    digest = hashlib.sha256(",".join(str(c) for book in books for entry in book for c in entry).encode()).hexdigest()
    return sorted([(i, c, e, by_label[label], digest) for (i, _, label), c, e in zip(kept, codes, errors, strict=True)], key=str)


def found(frame, **sizes):
    return sorted(map(tuple, vector_codes.coded(frame, **sizes).collect()), key=str)


def frame(spark, rows):
    return spark.createDataFrame([(*r, 0, 0, "x") for r in rows], "vec_id long, embedding array<float>, label int, error int, row int, _whole string")


def vectors(n, width, seed=7):
    rng = np.random.default_rng(seed)
    return [(i, v.tolist(), int(i % 5) if i % 7 else None) for i, v in enumerate(rng.normal(size=(n, width)).astype(np.float32))]


def test_many_rounds_and_salts(spark, monkeypatch):
    monkeypatch.setattr(vector_codes, "OWNER_MEMBERS", 7)
    rows = vectors(400, 12)
    for rounds in (1, 2, 5):
        assert found(frame(spark, rows), parts=4, entries=9, rounds=rounds) == plain(rows, 4, 9, rounds)


def test_hot_repeated_and_bad_vectors(spark):
    rows = vectors(100, 32)
    hot = [(1000 + i, rows[50][1], 1) for i in range(300)]
    again = [rows[3], rows[3], (3, rows[4][1], 2), (None, rows[5][1], None)]
    bad = [(-1, None, 1), (-2, [None] * 32, 1), (-3, [float("nan")] * 32, 1), (-4, [float("inf")] * 32, 1), (-5, [1.0] * 16, 1), (-6, [1.0] * 31, 1), (-7, [], 1)]
    good = [*rows, *hot, *again]
    assert found(frame(spark, [*good, *bad])) == plain(good)


def test_ties_and_few_vectors(spark):
    for rows in ([(5, [0.5] * 16, 1)], [(5, [0.0] * 16, 1), (4, [0.0] * 16, 1), (6, [1.0] * 16, None)]):
        assert found(frame(spark, rows)) == plain(rows)
    assert found(frame(spark, [])) == []


def test_huge_components(spark):
    rows = [(1, [1e30] * 16, 1), (2, [-1e30] * 16, 1), (3, [0.5] * 16, 1), (4, [3e6] * 16, 2), (5, [2e6] * 16, 2)]
    result = {r[0]: r for r in found(frame(spark, rows), entries=2)}
    assert result[1][2] is None and result[3][3] is None and len(result[5][1]) == 32


def test_only_members_that_change_entry_are_shuffled(spark):
    rows, length = integer_vectors(frame(spark, vectors(50, 16)), F.struct("vec_id", "label"), 256)
    rows = rows.withColumn("row", F.monotonically_increasing_id())
    assigned, _ = vector_codes.lloyd(rows, length)
    plan = assigned._jdf.queryExecution().executedPlan().toString()
    assert "lloyd-assigned" in plan and "lloyd-arrived" in plan and "Exchange" not in plan


def test_query(spark):
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()]
    assert sorted(map(tuple, op13_vector_codes(spark, SF_DIR).collect()), key=str) == plain(rows)
