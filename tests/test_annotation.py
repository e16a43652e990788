"""Detector calls and normalised responses."""

import json
import random

import pytest
from pyspark.sql import functions as F

from clinlake.operators import annotation as A
from clinlake.plans.annotations import annotate_rows, annotation_tables, write_annotation_tables
from workload.detectors import NUMBERS, pattern_detector


def entity(number, text, traits=(), attributes=(), **concepts):
    return {
        "Id": number, "Text": text, "Category": "C", "Type": "T", "Score": 0.5, "BeginOffset": 0, "EndOffset": 1,
        "Traits": [{"Name": n, "Score": s} for n, s in traits], "Attributes": list(attributes), **concepts,
    }


ATTRIBUTE = {"Id": 9, "Text": "a", "Type": "D", "Score": 0.25, "BeginOffset": 1, "EndOffset": 2}
CONCEPTS = [{"Code": "I1", "Description": "d", "Score": 0.5}, {"Code": "I1", "Description": "d", "Score": 0.5}]


@pytest.fixture(scope="module")
def responses(spark):
    rows = [
        (1, "detect_entities_v2", 0, {"Entities": [
            entity(0, "first", [("N", 0.5), ("N", 0.5)], [ATTRIBUTE, ATTRIBUTE | {"Category": "X", "RelationshipScore": 0.75}]),
            entity(0, "second", [("N", 0.5), ("S", 0.5)]),
            entity(1, "other"),
        ]}),
        (1, "infer_icd10_cm", 2, {"Entities": [entity(0, "icd", ICD10CMConcepts=CONCEPTS), entity(2, "new")]}),
        (1, "detect_phi", 1, {"Entities": []}),
        (2, "infer_snomed_ct", 4, {"Entities": [entity(0, "s", SNOMEDCTConcepts=CONCEPTS[:1], ICD10CMConcepts=CONCEPTS)]}),
        (2, "infer_rx_norm", 3, {}),
        (3, "infer_rx_norm", 3, {"Entities": [entity(None, "n"), entity(None, "m", RxNormConcepts=CONCEPTS[:1])]}),
    ]
    return spark.createDataFrame(
        [(n, api, o, json.dumps(r)) for n, api, o, r in rows] + [(4, "detect_phi", 1, None), (5, "detect_phi", 1, "{broken")],
        "row_number long, api string, api_ord int, response_json string",
    )


def test_first_entity_of_an_id_stays(responses):
    rows = {(r.row_number, r.api, r.Id, r.Text) for r in A.entities(responses).collect()}
    assert rows == {
        (1, "detect_entities_v2", 0, "first"), (1, "detect_entities_v2", 1, "other"),
        (1, "infer_icd10_cm", 0, "icd"), (1, "infer_icd10_cm", 2, "new"),
        (2, "infer_snomed_ct", 0, "s"), (3, "infer_rx_norm", None, "n"),
    }
    per_row = {(r.row_number, r.Id, r.Text) for r in A.entities(responses, scope="row").collect()}
    assert per_row == {(1, 0, "first"), (1, 1, "other"), (1, 2, "new"), (2, 0, "s"), (3, None, "n")}


def test_traits_and_attributes(responses):
    assert {(r.EntityId, r.TraitName, r.TraitScore) for r in A.traits(responses).collect()} == {(0, "N", 0.5), (0, "S", 0.5)}
    assert A.traits(responses).count() == 2
    (row,) = A.attributes(responses).collect()
    assert (row.AttributeId, row.AttributeCategory, row.RelationshipScore, row.RelationshipType) == (9, "", "", "")


def test_concepts_come_from_their_own_api_and_repeat(responses):
    assert [r.ICDCode for r in A.icd10_concepts(responses).collect()] == ["I1", "I1"]
    assert [(r.row_number, r.SNOMEDScore) for r in A.snomed_concepts(responses).collect()] == [(2, 0.5)]
    assert [(r.row_number, r.EntityId) for r in A.rxnorm_concepts(responses).collect()] == [(3, None)]


def test_scope_is_checked(responses):
    with pytest.raises(ValueError):
        A.traits(responses, scope="all")


def test_only_row_scope_shuffles(responses):
    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    assert "Exchange" not in plan(A.attributes(responses)) and "Python" not in plan(A.attributes(responses))
    row_plan = plan(A.attributes(responses, scope="row"))
    assert row_plan.count("Exchange hashpartitioning") == 1 and "WindowGroupLimit" in row_plan


def test_metadata_joins_inner(spark, responses):
    rows = spark.createDataFrame([(1, "x")], "row_number long, name string")
    assert {r.name for r in A.attach_row_metadata(responses, rows).collect()} == {"x"}


def failing():
    def detect(text):
        if "bad" in text:
            raise RuntimeError("refused")
        return {"Entities": [{"Text": text}]}

    return detect


def test_annotate_keeps_going_after_a_failure(spark):
    df = spark.createDataFrame([(1, "bad", "m"), (2, "7 8", "n"), (3, "", "o"), (4, None, "p")], "k int, t string, extra string")
    found = A.annotate(df, "k", "t", {"numbers": pattern_detector(NUMBERS), "failing": failing}, keep=["extra"])
    rows = {(r.k, r.api): r for r in found.collect()}
    assert set(rows) == {(1, "numbers"), (1, "failing"), (2, "numbers"), (2, "failing")}
    assert rows[1, "failing"].error == "RuntimeError: refused" and rows[1, "failing"].response_json is None
    assert rows[2, "numbers"].api_ord == 0 and rows[2, "failing"].extra == "n"
    assert [e["Text"] for e in json.loads(rows[2, "numbers"].response_json)["Entities"]] == ["7", "8"]


def test_detected_entities(spark):
    df = spark.createDataFrame([(1, "a1b22"), (2, "none"), (3, "")], "case_hub_id int, case_interpretation string")
    rows = {r.case_hub_id: r.detected_entities for r in A.detected_entities(df, "case_hub_id", "case_interpretation", pattern_detector(NUMBERS)).collect()}
    assert rows == {1: ["1", "22"], 2: []}


def test_flow_from_rows_to_tables(spark):
    rows = spark.createDataFrame([("b 2", "x"), ("a 1", None)], "Text string, name string")
    numbered, responses = annotate_rows(rows, {"detect_entities_v2": pattern_detector("[ab] [0-9]")}, ["Text"])
    found = annotation_tables(responses, numbered)["entities"]
    assert {(r.row_number, r.Text, r.row_Text, r.name) for r in found.collect()} == {(1, "a 1", "a 1", None), (2, "b 2", "b 2", "x")}


def counting(calls):
    def open_client():
        def detect(text):
            with open(calls, "a") as log:
                log.write("x")
            if "bad" in text:
                raise RuntimeError("refused")
            return {"Entities": [{"Id": 1, "Text": "t"}]}

        return detect

    return open_client


def test_each_text_is_detected_once_and_failures_are_kept(spark, tmp_path):
    spark.sql(f"CREATE DATABASE paid LOCATION '{tmp_path}/paid'")
    calls = tmp_path / "calls"
    rows = spark.createDataFrame([("good",), ("bad",), ("fine",)], "note string")
    numbered, responses = annotate_rows(rows, {"detect_phi": counting(str(calls))}, ["note"])
    assert write_annotation_tables(responses, numbered, "paid") == ["comprehend_entities", "comprehend_failures"]
    assert annotation_tables(responses, numbered)["entities"].count() == 2
    assert calls.read_text() == "xxx"
    failed = spark.table("paid.comprehend_failures").collect()
    assert [(r.note, r.api, r.error) for r in failed] == [("bad", "detect_phi", "RuntimeError: refused")]


def test_tables_are_appended_and_empty_ones_left_out(spark, responses, tmp_path):
    spark.sql(f"CREATE DATABASE ann LOCATION '{tmp_path}/ann'")
    rows = responses.select("row_number").distinct().withColumn("case", F.concat(F.lit("k"), "row_number"))
    only_icd = responses.filter("api = 'infer_icd10_cm'")
    assert write_annotation_tables(only_icd, rows, "ann") == ["comprehend_entities", "comprehend_icd_concepts"]
    write_annotation_tables(responses, rows, "ann")
    assert spark.table("ann.comprehend_icd_concepts").count() == 4
    assert {r.case for r in spark.table("ann.comprehend_icd_concepts").collect()} == {"k1"}
    assert not spark.catalog.tableExists("ann.comprehend_nothing")


def test_what_a_table_needs_is_joined_rather_than_the_response(spark, responses):
    rows = spark.createDataFrame([(1, "a"), (3, "c")], "row_number long, kind string")
    makers = [A.entities, A.traits, A.attributes, A.icd10_concepts, A.snomed_concepts, A.rxnorm_concepts]
    for make in makers:
        after = make(A.attach_row_metadata(responses, rows))
        before = make(responses, rows=rows)
        assert before.columns == after.columns
        assert sorted(map(repr, before.collect())) == sorted(map(repr, after.collect()))
        plan = before._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and "Sort [" not in plan
        above, *below = plan.split("Exchange")
        assert "from_json" not in above and "from_json" in "".join(below)
    both = A.traits(responses, scope="row", rows=rows)
    assert sorted(map(repr, both.collect())) == sorted(map(repr, A.traits(A.attach_row_metadata(responses, rows), scope="row").collect()))


def test_annotation_files_are_compressed_and_bounded(spark, tmp_path, monkeypatch):
    from clinlake.sources import writers

    monkeypatch.setattr(writers, "LINES_PER_FILE", 10)
    rows = spark.range(30).coalesce(1).selectExpr("id as row_number", "'x' as api", "concat('{', id, '}') as response_json")
    writers.write_annotations_json(rows, str(tmp_path / "r"))
    files = list((tmp_path / "r" / "api=x").glob("*.json.gz"))
    assert len(files) == 3
    assert spark.read.json(str(tmp_path / "r")).count() == 30


def test_only_responses_with_repeats_are_sorted(spark):
    attributes = [ATTRIBUTE | {"Id": i % 3, "Text": t, "Category": str(i)} for i in range(6) for t in ("a", None)]
    documents = [{"Entities": [entity(n, "e", attributes=attributes), entity(n, "f", attributes=attributes)]} for n in (0, None)]
    documents.append({"Entities": [None, entity(1, "e", attributes=[*attributes[:3], None])]})
    df = spark.createDataFrame([(i, "a", 0, json.dumps(d)) for i, d in enumerate(documents)],
                               "row_number long, api string, api_ord int, response_json string")
    found = A.attributes(df)
    rows = sorted((r.row_number, r.AttributeId, r.AttributeText or "", r.AttributeCategory) for r in found.collect() if r.AttributeId is not None)
    repeated = [(i, t, str(i)) for i in range(3) for t in ("", "a")]
    assert rows == [(n, *r) for n in (0, 1) for r in repeated] + [(2, 0, "", "0"), (2, 0, "a", "0"), (2, 1, "a", "1")]
    assert [(r.row_number, r.AttributeCategory) for r in found.filter("AttributeId is null").collect()] == [(2, "")]
    assert "xxhash64" in found._jdf.queryExecution().optimizedPlan().toString()


def test_repeats_are_settled_by_hash_and_by_key_alike(spark, monkeypatch):
    rng = random.Random(5)
    values = [None, 0.0, -0.0, float("nan"), 0.5]
    rows = [(n, [(rng.choice([None, 1, 2]), rng.choice([None, "", "a", "b"]), rng.choice(values)) for _ in range(size)])
            for n, size in enumerate([0, 1, 2, 5, 9, 64, 65, 200] * 3)]
    df = spark.createDataFrame(rows, "n int, _items array<struct<a:bigint,b:string,c:double>>")
    key = {"a": "{}.a", "b": "{}.b", "c": "{}.c"}
    by_hash = A._repeats(key)
    assert "array_position" in by_hash
    monkeypatch.setattr(A, "HELD_AGAINST", -1)
    by_key = A._repeats(key)
    of_one_hash = by_hash.replace("x -> xxhash64(", "x -> 0L * hash(")
    found = df.selectExpr("n", "_items", f"{by_hash} as h", f"{by_key} as k", f"{of_one_hash} as o").collect()
    for r in found:
        seen, first = set(), []
        for item in r._items:
            own = tuple("nan" if v != v else v for v in item)
            first.append(own not in seen)
            seen.add(own)
        expected = None if all(first) else first
        assert (r.h, r.k) == (expected, expected)
        assert r.o == expected or (expected is None and (r.o is None or all(r.o)))


def test_tables_that_have_rows_are_found_without_a_pass_over_all(spark, tmp_path, monkeypatch):
    def passed(*_):
        raise AssertionError("aggregated")

    responses = spark.createDataFrame([(1, "detect_phi", 1, '{"Entities":[{"Id":1,"Traits":[{"Name":"n","Score":0.5}]}]}'), (2, "infer_rx_norm", 3, "{}")],
                                      "row_number long, api string, api_ord int, response_json string")
    database = f"found_{tmp_path.name.replace('-', '_')}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{tmp_path}/d'")
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "row_number long, case_hub_id string")
    monkeypatch.setattr(type(rows), "agg", passed)
    assert write_annotation_tables(responses, rows, database, scope="row") == ["comprehend_entities", "comprehend_traits"]
    assert [tuple(r) for r in spark.table(f"{database}.comprehend_traits").select("row_number", "EntityId", "TraitName", "case_hub_id").collect()] == [(1, 1, "n", "a")]
