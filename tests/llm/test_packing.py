"""Packing against best fit piece by piece, and the places of all pieces."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from clinlake.llm import packing
from clinlake.llm.queries.bpe import VOCABULARY
from clinlake.llm.queries.packing import op3_best_fit_packing

SF_DIR = "/root/testdata/sf0.001"


def rooms_by_definition(counts, window):
    rooms = []
    for size in sorted(counts, reverse=True):
        for _ in range(counts[size]):
            fitting = [r for r in rooms if r >= size]
            room = min(fitting, default=window)
            if fitting:
                rooms.remove(room)
            rooms.append(room - size)
    return sorted(rooms)


@pytest.mark.parametrize("seed", range(30))
def test_the_plan_is_best_fit_decreasing(seed):
    rng = random.Random(seed)
    window = rng.choice([16, 37, 64])
    counts = {size: rng.choice([0, 1, 2, 7, 40]) for size in rng.sample(range(1, window + 1), rng.randint(1, 14))}
    plan = packing.best_fit_decreasing(counts, window)
    used = defaultdict(list)
    for k, (size, first_rank, first, each, offset) in enumerate(plan):
        end = next((p[1] for p in plan[k + 1 :] if p[0] == size), counts[size])
        for behind in range(end - first_rank):
            used[first + behind // each].append((offset + behind % each * size, size))
    for spans in used.values():
        at = 0
        for offset, size in sorted(spans):
            assert offset == at
            at += size
    assert sorted(window - sum(s for _, s in spans) for spans in used.values()) == rooms_by_definition(counts, window)
    assert sorted(used) == list(range(len(used)))


def check_places(rows):
    by_sequence = defaultdict(list)
    for r in rows:
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for spans in by_sequence.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= packing.WINDOW
    return by_sequence


def test_query_holds_every_id_once(spark):
    library = Tokenizer.from_file(VOCABULARY)
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    rows = op3_best_fit_packing(spark, SF_DIR).collect()
    sequences = check_places(rows)
    total = sum(r.length for r in rows)
    assert total > 0.97 * packing.WINDOW * (len(sequences) - 1)
    pieces = defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
    assert pieces.keys() == texts.keys()
    for doc_id, text in texts.items():
        ids = np.array([*library.encode(text, add_special_tokens=False).ids, 1], dtype="<u4")
        at = 0
        for r in sorted(pieces[doc_id], key=lambda r: r.start):
            assert (r.start, r.doc_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(ids[at : at + r.length].tobytes()))
            at += r.length
        assert at == len(ids)


def test_edge_cases(spark):
    rows = [(1, "", 9), (1, "", 9), (2, None, 9), (None, "a", 9), (3, "word " * 9000, 9)] + [(k, "the same text", 9) for k in range(500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _salt int")
    placed = packing.place(packing.pieces(docs, VOCABULARY)).collect()
    check_places(placed)
    assert sum(r.start == 0 for r in placed) == len(rows)
    assert all(len(r.ids) == 4 * r.length for r in placed)
    assert packing.place(packing.pieces(docs.limit(0), VOCABULARY)).count() == 0


def test_groups_follow_the_count_of_a_length(spark, monkeypatch):
    monkeypatch.setattr(packing, "SALTS", 2)
    monkeypatch.setattr(packing, "GROUP_ROWS", 50)
    docs = spark.createDataFrame([(None, "the same text") for _ in range(700)] + [(k, "word " * 5000) for k in range(6)], "doc_id long, text string")
    placed = packing.place(packing.pieces(docs, VOCABULARY)).collect()
    sequences = check_places(placed)
    assert sum(r.doc_id is None for r in placed) == 700 and sum(r.length == packing.WINDOW for r in placed) == 12
    assert sum(r.length for r in placed) > packing.WINDOW * (len(sequences) - 1) * 0.9
