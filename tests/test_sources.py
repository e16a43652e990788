"""Readers, writers, row numbering and the landing and stage flows."""

import datetime
import os
import json

import pyarrow.parquet as pq
import pytest

from clinlake.operators import rows as R
from clinlake.plans.landing import DELIMITED_TABLES, ingest_all, ingest_resources
from clinlake.plans.staging import stage_resources
from clinlake.session import INFER_SHREDDING, stored, working_folder, working_scope
from clinlake.sources import readers, writers
from clinlake.sources.schemas import RESOURCES

TEXT = 'line 1\nline "2" | x, y '


@pytest.fixture
def database(spark, tmp_path):
    names = []

    def create(name):
        full = f"{name}_{abs(hash(tmp_path)) % 10**9}"
        spark.sql(f"CREATE DATABASE {full} LOCATION '{tmp_path}/{full}'")
        names.append(full)
        return full

    return create


@pytest.mark.parametrize("delimiter", ["|", ","])
def test_delimited_round_trip(spark, tmp_path, delimiter):
    df = spark.createDataFrame([("1", TEXT), ("2", '{"a":"b,c","d":""}')], "id string, t string")
    writers.write_csv(df, str(tmp_path / "d"), delimiter)
    back = readers.read_delimited(spark, str(tmp_path / "d"), delimiter, multi_line=True)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
    assert {f.dataType.simpleString() for f in back.schema} == {"string"}


def test_typed_reader_infers_or_takes_a_schema(spark, tmp_path):
    (tmp_path / "x.csv").write_text('n,t\n1,"say ""hi"""\n2,b\n')
    assert readers.read_delimited_typed(spark, str(tmp_path)).dtypes == [("n", "int"), ("t", "string")]
    assert readers.read_delimited_typed(spark, str(tmp_path), "n long, t string").first().t == 'say "hi"'


def test_json_documents_one_per_file(spark, tmp_path):
    (tmp_path / "a.json").write_text('{\n "id": "1", "gender": "f", "other": {"x": 1}\n}')
    (tmp_path / "b.json").write_text('[{"id": "2"},\n {"id": "3", "gender": "m"}]')
    (tmp_path / "c.json").write_text("{broken")
    rows = readers.read_json_documents(spark, str(tmp_path), RESOURCES["Patient"]).cache().collect()
    assert {(r.id, r.gender) for r in rows} == {("1", "f"), ("2", None), ("3", "m"), (None, None)}
    assert [r._corrupt_record for r in rows if r.id is None] == ["{broken"]


def test_snapshot_date_from_the_file_name(spark, tmp_path):
    (tmp_path / "ORDERS_20240105_0.csv").write_text("a\n1\n")
    (tmp_path / "orders.csv").write_text("a\n2\n")
    (tmp_path / "ORDERS_20241399.csv").write_text("a\n3\n")
    rows = readers.with_snapshot_date(readers.read_csv_plain(spark, str(tmp_path)), "orders").collect()
    assert {(r.a, r.timecolumn) for r in rows} == {("1", datetime.date(2024, 1, 5)), ("2", None), ("3", None)}


def test_union_of_databases_is_by_name(spark, database):
    a, b = database("a"), database("b")
    writers.replace_table(spark.createDataFrame([(1, "x")], "i int, t string"), a, "t")
    writers.replace_table(spark.createDataFrame([("y", 2), ("y", 2)], "t string, i int"), b, "t")
    rows = readers.read_from_databases(spark, [a, b], "t").collect()
    assert sorted(map(tuple, rows)) == [(1, "x"), (2, "y"), (2, "y")]


def test_append_aligns_by_name_and_adds_columns(spark, database):
    db = database("app")
    writers.append_or_create(spark.createDataFrame([(1, "x")], "i int, t string"), db, "t")
    writers.append_or_create(spark.createDataFrame([("n", 2)], "extra string, I int"), db, "t")
    assert spark.table(f"{db}.t").columns == ["i", "t", "extra"]
    assert sorted(map(tuple, spark.table(f"{db}.t").collect())) == [(1, "x", None), (2, None, "n")]


def test_copy_layer_refuses_one_database(spark, database):
    db = database("one")
    with pytest.raises(ValueError):
        writers.copy_layer(spark, db, db, ["t"])


def test_csv_is_one_file_per_task(spark, tmp_path):
    writers.write_csv(spark.range(100).repartition(4), str(tmp_path / "m"))
    assert len(list((tmp_path / "m").glob("part-*"))) == 4
    assert readers.read_csv_plain(spark, str(tmp_path / "m")).count() == 100


@pytest.mark.parametrize(("kept", "given"), [("bigint", "double"), ("date", "timestamp"), ("int", "bigint"), ("double", "string"), ("decimal(5,2)", "decimal(6,2)"), ("array<int>", "array<bigint>")])
def test_an_append_that_would_lose_values_is_refused(spark, database, kept, given):
    db = database("keep")
    writers.replace_table(spark.sql(f"select 1 as k, cast(null as {kept}) as n"), db, "t")
    with pytest.raises(TypeError, match="n "):
        writers.append_or_create(spark.sql(f"select 2 as k, cast(null as {given}) as n, 'x' as added"), db, "t")
    assert spark.table(f"{db}.t").count() == 1


@pytest.mark.parametrize(("kept", "given"), [("bigint", "int"), ("double", "float"), ("string", "bigint"), ("decimal(22,2)", "bigint"), ("int", "void")])
def test_an_append_may_widen(spark, database, kept, given):
    db = database("widen")
    writers.replace_table(spark.sql(f"select 1 as k, cast(null as {kept}) as n"), db, "t")
    writers.append_or_create(spark.sql(f"select 2 as k, cast(null as {given}) as n"), db, "t")
    assert spark.table(f"{db}.t").count() == 2


def test_raw_keeps_whole_documents(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "a.json").write_text('{"id":"1","gender":"f","birthDate":"2001-01-01","name":[{"family":"X"}]}')
    (tmp_path / "sub" / "b.json").write_text('[{"id":"2","deceasedBoolean":true},\n {"id":3,"name":[]}]')
    (tmp_path / "c.json").write_text("[]")
    rows = readers.read_json_documents(spark, str(tmp_path), RESOURCES["Patient"])
    found = rows.selectExpr("id", "variant_get(_document, '$.name[0].family', 'string') as family", "variant_get(_document, '$.birthDate', 'string') as born")
    assert {tuple(r) for r in found.collect()} == {("1", "X", "2001-01-01"), ("2", None, None), ("3", None, None)}


def test_ddl_values_and_select(spark, database):
    table = f"{database('ddl')}.t"
    for _ in range(2):
        writers.create_table(spark, table, "id int, name string, value int")
    writers.insert_values(spark, table, [(1, "ABC", 100), (2, "XYZ", 200)])
    writers.register_view(spark.table(table), "ddl_view")
    writers.insert_select(spark, table, "ddl_view", "name", ["ABC", "it's"])
    assert sorted(r.id for r in spark.table(table).collect()) == [1, 1, 2]


def test_ingest_all_reports_each_table(spark, database, tmp_path):
    db = database("raw")
    base = str(tmp_path / "landing")
    writers.write_csv(spark.createDataFrame([("1", TEXT)], "id string, t string"), f"{base}/case_data", "|")
    writers.write_csv(spark.createDataFrame([("1",), ("2",)], "id string"), f"{base}/patient_match_hub", ",")
    outcomes = {r.name: r for r in ingest_all(spark, base, db, multi_line=["case_data"]).collect()}
    assert set(outcomes) == set(DELIMITED_TABLES)
    assert (outcomes["case_data"].rows, outcomes["case_data"].error) == (1, None)
    assert outcomes["patient_match_hub"].rows == 2
    assert "Path does not exist" in outcomes["doctor_data"].error
    assert spark.table(f"{db}.case_data").first().t == TEXT


def test_resources_land_and_stage(spark, database, tmp_path):
    raw, stage = database("raw"), database("stage")
    base = tmp_path / "fhir"
    (base / "Medication").mkdir(parents=True)
    (base / "Medication" / "m.json").write_text(json.dumps({"id": "m1", "code": {"coding": [{"code": "c"}]}}, indent=1))
    outcomes = {r.name: r for r in ingest_resources(spark, str(base), raw, ["Medication", "Location"]).collect()}
    assert outcomes["medication"].rows == 1 and outcomes["location"].error
    assert [r.name for r in stage_resources(spark, raw, stage, ["medication", "unheard"]).collect()] == ["medication"]
    assert [(r.main_id, r.item_code) for r in spark.table(f"{stage}.medication").collect()] == [("m1", "c")]


@pytest.mark.parametrize("order", [["k"], None])
def test_row_numbers_are_whole_and_ordered(spark, order):
    df = spark.range(1000, numPartitions=7).selectExpr("(id * 37) % 1000 as k", "'v' as v")
    numbered = R.with_row_number(df, order).collect()
    assert sorted(r._row_number for r in numbered) == list(range(1, 1001))
    if order:
        assert all(r._row_number == r.k + 1 for r in numbered)


def test_row_numbers_spread_a_hot_key(spark):
    df = spark.range(4000, numPartitions=4).selectExpr("if(id % 3 = 0, 7, id) as k", "'same' as v")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
    try:
        numbered = R.with_row_number(df, ["k"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert numbered.select("_row_number").distinct().count() == 4000
    hot = [r._row_number for r in numbered.filter("k = 7").collect()]
    assert max(hot) - min(hot) == len(hot) - 1
    stored = numbered.inputFiles()
    per_file = [spark.read.parquet(f).filter("k = 7").count() for f in stored]
    assert sum(n > 0 for n in per_file) > 1 and max(per_file) < len(hot)


def test_render_rows(spark):
    df = spark.createDataFrame([(1, None, 2)], "a int, b string, _row_number int")
    assert R.render_rows(df).first().text == "a: 1\nb: None\n_row_number: 2"


def test_sum_as_integer(spark):
    df = spark.createDataFrame([("1",), ("x",), (None,), ("41",)], "t string")
    assert R.sum_as_integer(df, "t", "s").first().s == 42


def test_counted_needs_no_job_of_its_own(spark, tmp_path):
    frame, observation = R.counted(spark.range(12))
    frame.write.parquet(str(tmp_path / "c"))
    assert observation.get["rows"] == 12


def test_first_per_key_limits_before_the_shuffle(spark):
    df = spark.range(90).selectExpr("id % 3 as k", "100 - id as o")
    first = R.first_per_key(df, ["k"], ["o"])
    assert sorted(map(tuple, first.collect())) == [(0, 13), (1, 12), (2, 11)]
    assert "WindowGroupLimit" in first._jdf.queryExecution().executedPlan().toString()


def test_row_texts_and_annotation_files(spark, tmp_path):
    writers.write_row_text(spark.createDataFrame([(1, 1)], "a int, _row_number int"), str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).first().text == "a: 1\n_row_number: 1"
    responses = spark.createDataFrame([(1, "x", "{}"), (1, "y", "{}")], "row_number int, api string, response_json string")
    writers.write_annotations_json(responses, str(tmp_path / "r"))
    assert {p.name for p in (tmp_path / "r").iterdir() if p.is_dir()} == {"api=x", "api=y"}


def test_working_folder_is_the_shared_one(spark):
    base = spark.conf.get("spark.checkpoint.dir", None) or working_folder(spark, "a").split("/clinlake/")[0]
    first, second = working_folder(spark, "p"), working_folder(spark, "p")
    assert first.startswith(base) and first != second


def test_a_scope_leaves_nothing_behind(spark):
    with working_scope(spark):
        rows = stored(spark.range(3), "scoped")
        assert rows.count() == 3
        folder = rows.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
        assert os.path.isdir(folder)
    assert not os.path.exists(folder)


def test_landed_documents_are_stored_whole(spark, tmp_path, database):
    raw = database("whole")
    documents = ['{"id":"a","code":{"text":"x","coding":[{"code":"c"}]},"more":{"deep":[1,{"k":true}]}}', '{"id":"b"}']
    spark.createDataFrame([(d,) for d in documents], "value string").write.text(f"{tmp_path}/in/Medication")
    before = spark.conf.get(INFER_SHREDDING)
    ingest_resources(spark, f"{tmp_path}/in", raw, ["Medication"], multi_line=False)
    assert spark.conf.get(INFER_SHREDDING) == before
    files = list((tmp_path / raw / "medication").glob("*.parquet"))
    stored = {c.path for f in files for c in pq.ParquetFile(f).schema if c.path.startswith("_document")}
    assert stored == {"_document.value", "_document.metadata"}
    rows = spark.table(f"{raw}.medication").selectExpr("id", "to_json(_document) as d").collect()
    assert {r.id: json.loads(r.d) for r in rows} == {"a": json.loads(documents[0]), "b": json.loads(documents[1])}
