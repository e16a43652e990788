"""Replacement, appends and batches that fail; the registry of paths; stored responses."""

import json
import os
import uuid

import pytest
from pyspark.sql import functions as F

from clinlake.operators import json_columns as J
from clinlake.operators import path_registry
from clinlake.plans.annotations import annotate_texts, write_annotation_tables
from clinlake.sources import batches, readers, writers


@pytest.fixture
def database(spark):
    name = f"d_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {name}")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def failing(df, column="b"):
    return df.withColumn(column, F.when(F.col("a") < 0, F.col(column)).otherwise(F.raise_error("no").cast(df.schema[column].dataType)))


def rows(spark, database, name="t"):
    return sorted(tuple(r) for r in spark.table(f"{database}.{name}").collect())


def test_a_replacement_that_fails_keeps_the_table(spark, database):
    first = spark.createDataFrame([(1, "x"), (2, "y")], "a int, b string")
    writers.replace_table(first, database, "t")
    for frame in (failing(first), failing(first).withColumn("c", F.lit(1))):
        with pytest.raises(Exception, match="no"):
            writers.replace_table(frame, database, "t")
        assert rows(spark, database) == [(1, "x"), (2, "y")]
    assert [t.name for t in spark.catalog.listTables(database)] == ["t"]


def test_replacements_one_after_the_other(spark, database):
    for k in range(4):
        writers.replace_table(spark.createDataFrame([(k, "x")], "a int, b string"), database, "t")
        assert rows(spark, database) == [(k, "x")]
    writers.replace_table(spark.table(f"{database}.t").withColumn("a", F.col("a") + 1), database, "t")
    assert rows(spark, database) == [(4, "x")]
    writers.replace_table(spark.createDataFrame([("q",)], "z string"), database, "t")
    writers.replace_table(spark.createDataFrame([("r",)], "z string"), database, "t", "json")
    assert rows(spark, database) == [("r",)]
    folders = os.listdir(spark.sql(f"DESCRIBE DATABASE {database}").filter("info_name = 'Location'").first().info_value.removeprefix("file:"))
    assert len([f for f in folders if f.startswith("t")]) <= 3


def test_a_refused_append_changes_nothing(spark, database):
    writers.replace_table(spark.createDataFrame([(1,)], "a int"), database, "t")
    with pytest.raises(TypeError, match="a double into int"):
        writers.append_or_create(spark.createDataFrame([(1.5, "new")], "a double, c string"), database, "t")
    assert spark.table(f"{database}.t").columns == ["a"] and rows(spark, database) == [(1,)]


def committed(spark, database, name):
    return sorted(tuple(r) for r in batches.read_committed(spark, database, name).collect())


def test_batches(spark, database):
    def frames(k, bad=False):
        left = spark.createDataFrame([(k, "x"), (k + 1, "y")], "a int, b string")
        return {"left": left, "right": failing(left) if bad else left}

    assert batches.append_batch(frames(0), database, "it's 0")
    assert not batches.append_batch(frames(50), database, "it's 0")
    with pytest.raises(Exception, match="no"):
        batches.append_batch(frames(10, bad=True), database, "1")
    assert spark.table(f"{database}.left").count() == 4
    assert committed(spark, database, "left") == committed(spark, database, "right") == [(0, "x"), (1, "y")]
    # The repeated batch has other rows, none of the left table, and a column more.
    empty = frames(0)["left"].filter("a < 0")
    assert batches.append_batch({"left": empty, "right": spark.createDataFrame([("z", 5, 1)], "b string, a int, c int")}, database, "1")
    assert committed(spark, database, "left") == [(0, "x"), (1, "y")]
    assert committed(spark, database, "right") == [(0, "x", None), (1, "y", None), (5, "z", 1)]
    with pytest.raises(TypeError):
        batches.append_batch({"left": frames(0)["left"], "right": spark.createDataFrame([(1.5,)], "a double")}, database, "2")
    assert spark.table(f"{database}.left").count() == 2 and not batches.is_committed(spark, database, "2")


def test_annotation_tables_are_one_batch(spark, database):
    response = json.dumps({"Entities": [{"Id": 1, "Text": "t", "Traits": [{"Name": "N", "Score": 0.5}]}]})
    responses = spark.createDataFrame([(1, "detect_phi", 0, response)], "row_number long, api string, api_ord int, response_json string")
    source = spark.createDataFrame([(1, "k")], "row_number long, case_id string")
    for _ in range(2):
        write_annotation_tables(responses, source, database, batch="b1")
    assert batches.read_committed(spark, database, "comprehend_entities").count() == 1
    assert batches.read_committed(spark, database, "comprehend_traits").count() == 1
    write_annotation_tables(responses.filter("false"), source, database, batch="b2")
    assert batches.read_committed(spark, database, "comprehend_entities").count() == 1


def documents(spark, *texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, doc string")


def test_a_batch_walks_only_shapes_not_yet_seen(spark, database):
    first = documents(spark, '{"a":1,"b":{"c":"x"}}', '{"a":2,"b":{"c":"y"}}', '{"a":"reference=P/1"}')
    path_registry.register(first, ["doc"], database, "r")
    later = documents(spark, '{"a":7,"b":{"c":"q"}}', '{"a":"reference=P/2"}', '{"0":5,"a":1}', "{x=1, y=2}")
    unseen = {r["shape"] for r in path_registry.unseen_shapes(later, ["doc"], database, "r").collect()}
    assert unseen == {'{"0":true,"a":true}', '{"x":true, "y":true}'}
    sources = path_registry.register(later, ["doc"], database, "r")
    assert [(s.path, s.batch) for s in sources] == [("doc_a", 0), ("doc_a_P", 0), ("doc_b_c", 0), ("doc_0", 1), ("doc_x", 1), ("doc_y", 1)]
    assert path_registry.register(later, ["doc"], database, "r") == sources
    assert path_registry.unseen_shapes(later, ["doc"], database, "r").count() == 0
    assert spark.table(f"{database}.r_paths").count() == 6


def test_names_stay_over_batches(spark, database):
    frame = "id int, a string, b string"
    first = spark.createDataFrame([(1, "{}", '{"x":1}')], frame)
    sources = path_registry.register(first, ["a", "b"], database, "r")
    assert J.flatten_to_columns(first, ["a", "b"], sources).columns == ["id", "b_x"]
    # A later path of the earlier column that gives the same name but for case comes after it in names.
    later = spark.createDataFrame([(2, '{"x":5}', '{"x":1,"X":2}')], frame)
    wide = J.flatten_to_columns(later, ["a", "b"], path_registry.register(later, ["a", "b"], database, "r"))
    assert wide.columns == ["id", "a_x", "b_X_2", "b_x"]
    assert wide.first() == (2, "5", "2", "1")


def test_texts_whose_shape_is_no_json_are_looked_at_in_every_batch(spark, database):
    odd = documents(spark, '{"a":1, b=2}', "{a", '{"k":"\\u00e9"}')
    for _ in range(2):
        found = path_registry.register(odd, ["doc"], database, "r")
        assert {s.path for s in found} == {s.path for s in J.find_sources(odd, ["doc"])}


def counting(folder, refuse=""):
    def open_client():
        def detect(text):
            (folder / uuid.uuid4().hex).write_text(text)
            if refuse and refuse in text:
                raise ValueError("refused")
            return {"Entities": [{"Id": 0, "Text": text}]}

        return detect

    return open_client


def test_each_text_is_called_once_over_all_runs(spark, database, tmp_path):
    first = spark.createDataFrame([(1, "a"), (2, "a"), (3, "bad"), (4, ""), (5, None)], "k long, text string")
    second = first.unionByName(spark.createDataFrame([(6, "a"), (7, "c")], "k long, text string"))
    detectors = {"one": counting(tmp_path, "bad"), "two": counting(tmp_path)}

    def run(frame, version="v"):
        found = annotate_texts(frame, "k", "text", detectors, database, "responses", version)
        return sorted((r.k, r.api, r.api_ord, r.error is None) for r in found.collect())

    assert run(first) == [(k, api, n, (k, api) != (3, "one")) for k in (1, 2, 3) for n, api in enumerate(("one", "two"))]
    calls = sorted(p.read_text() for p in tmp_path.iterdir())
    assert calls == ["a", "a", "bad", "bad"]
    assert len(run(second)) == 10
    # The new text by both, and the failed call again.
    assert len(list(tmp_path.iterdir())) == 4 + 3
    run(second, "w")
    assert len(list(tmp_path.iterdir())) == 7 + 6
    assert run(first.limit(0)) == []
