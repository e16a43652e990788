"""SimHash near-duplicates against all pairs."""

import random

import pytest
import xxhash

from clinlake.llm import simhash
from clinlake.llm.components import smallest_in_component


def by_definition(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[k : k + 3]) for k in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64(s, seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def reachable(prints, radius):
    """Smallest position reachable over all pairs within the radius."""
    label = list(range(len(prints)))
    changed = True
    while changed:
        changed = False
        for i, a in enumerate(prints):
            for j, b in enumerate(prints):
                if (a ^ b).bit_count() <= radius and label[j] < label[i]:
                    label[i] = label[j]
                    changed = True
    return label


@pytest.mark.parametrize("text", ["", " \n ", "One", "one TWO", "a b c", "Ä b\x0bc d", "x " * 200, None])
def test_fingerprint(text):
    assert simhash.fingerprint(text or "") == by_definition(text)


@pytest.mark.parametrize("radius", [1, 2])
def test_a_pair_within_the_radius_agrees_in_some_table(radius):
    rng = random.Random(1)
    tables = simhash.masks(radius)
    assert len(tables) == 2 ** (radius + 1) - 1
    for _ in range(2000):
        flipped = sum(1 << b for b in rng.sample(range(64), radius))
        assert any(not flipped & mask for mask in tables)


def test_links_join_what_all_pairs_join(spark):
    rng = random.Random(2)
    base = [rng.getrandbits(64) for _ in range(25)]
    prints = list(dict.fromkeys(base + [b ^ sum(1 << k for k in rng.sample(range(64), rng.randint(1, 4))) for b in base for _ in range(5)]))
    frame = spark.createDataFrame([(simhash._signed(p),) for p in prints], "fp long")
    found = {r.node: r.smallest for r in smallest_in_component(simhash.links(frame)).collect()}
    mine = [found.get(simhash._signed(p), simhash._signed(p)) for p in prints]
    expected = reachable(prints, simhash.RADIUS)
    assert [mine.index(m) for m in mine] == [expected.index(e) for e in expected]


def test_components_of_documents(spark):
    rng = random.Random(3)
    words = ["".join(rng.choices("abcdef", k=4)) for _ in range(60)]
    texts = [" ".join(rng.choices(words, k=80)) for _ in range(12)]
    texts += [t + " end" for t in texts[:6]] + [texts[0], texts[0].upper(), "", None, "  ", "one", texts[1] * 400]
    rows = [(100 - i, t, "clash", 7) for i, t in enumerate(texts)] + [(100, texts[0], "clash", 7), (None, texts[0], "clash", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string, component_id int")
    order = sorted((r for r in rows if r[0] is not None), key=lambda r: r[0])
    prints = [by_definition(r[1]) for r in order]
    expected = {r[0]: order[k][0] for r, k in zip(order, reachable(prints, 2), strict=True)}
    found = simhash.components(docs).collect()
    assert len(found) == len(rows)
    assert {r.doc_id: r.component_id for r in found if r.doc_id is not None} == expected
    assert {r.component_id for r in found if r.doc_id is None} == {expected[100]}
    kept = simhash.one_per_component(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(expected.values()))


def test_chain_hub_and_empty_graph(spark):
    chain = [(i, i + 1) for i in range(200)]
    hub = [(1000, 1000 + i) for i in range(1, 300)] + [(5, 5), (None, 3)]
    edges = spark.createDataFrame(chain + hub + chain, "a long, b long")
    found = {r.node: r.smallest for r in smallest_in_component(edges).collect()}
    assert found == {i: 0 for i in range(1, 201)} | {1000 + i: 1000 for i in range(1, 300)}
    assert smallest_in_component(edges.limit(0)).count() == 0
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.components(empty).count() == 0
    assert simhash.one_per_component(empty).count() == 0
