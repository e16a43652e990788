"""Reshaped driver tables."""

from workload import shapes


def test_rows_are_spread_before_they_are_reshaped(spark, tmp_path, monkeypatch):
    orders = (
        "id as o_orderkey, id % 7 as o_custkey, 'F' as o_orderstatus, 'high' as o_orderpriority, "
        "date'2020-01-01' as o_orderdate, 1.0D as o_totalprice"
    )
    spark.range(400).selectExpr(*orders.split(", ")).coalesce(1).write.parquet(f"{tmp_path}/orders.parquet")
    monkeypatch.setattr(shapes, "PART_BYTES", 100)
    made = shapes.responses.__wrapped__(spark, str(tmp_path))
    assert made.rdd.getNumPartitions() > spark.sparkContext.defaultParallelism
    exchanged = made._jdf.queryExecution().optimizedPlan().toString().split("Repartition", 1)[1]
    assert "response_json" not in exchanged
    assert shapes.responses(spark, str(tmp_path)).count() == 2000


def test_the_entries_of_all_maps_come_from_one_flattening(spark, monkeypatch):
    from workload.queries import json_flatten_map

    rows = [(1, '{"a":1,"b":{"c":"x"}}', None), (2, None, '[{"v":"y"}]'), (3, None, None)]
    frame = spark.createDataFrame(rows, "event_id long, meta string, identifier string")
    monkeypatch.setattr(shapes, "nested_json", lambda spark, sf_dir: frame)
    made = json_flatten_map(spark, "")
    assert sorted(map(tuple, made.collect())) == [
        (1, "meta", "meta_a", "1"), (1, "meta", "meta_b_c", "x"), (2, "identifier", "identifier_0_v", "y"),
    ]
    assert "Union" not in made._jdf.queryExecution().optimizedPlan().toString()


def test_most_of_a_response_is_made_once_an_order(spark, tmp_path):
    rows = [(1, 1, "F", 'hi"gh'), (2, 2, None, None), (3, 5, "F", "x"), (4, None, "F", "x")]
    spark.createDataFrame(rows, "o_orderkey long, o_custkey long, o_orderstatus string, o_orderpriority string") \
        .write.parquet(f"{tmp_path}/orders.parquet")
    made = shapes.responses.__wrapped__(spark, str(tmp_path))
    found = {(r.row_number, r.api_ord): r.response_json for r in made.collect()}
    assert len(found) == 20
    dose = '{"Id":%d,"Text":"dose","Category":"MED","Type":"DOSAGE","Score":0.50,"RelationshipScore":0.75,"RelationshipType":"DOSAGE","BeginOffset":%d,"EndOffset":%d}'
    assert found[1, 2] == (
        '{"Entities":[{"Id":0,"Text":"hi\\"gh 0","Category":"F","Type":"t2","Score":0.25,"BeginOffset":0,"EndOffset":5,"Traits":['
        '{"Name":"NEGATION","Score":0.5},{"Name":"SIGN","Score":0.0},{"Name":"NEGATION","Score":0.5}],"Attributes":[' + dose % (0, 0, 1) +
        ',{"Id":0,"Text":"route","Type":"F","Score":0.25,"BeginOffset":0,"EndOffset":2}],"ICD10CMConcepts":['
        '{"Code":"I1-0","Description":"hi\\"gh 0","Score":0.250},{"Code":"I","Description":"second","Score":0.125}]}]}'
    )
    assert found[2, 0].endswith(
        ',{"Id":1,"Type":"t0","Score":0.125,"BeginOffset":10,"EndOffset":15,"Attributes":[' + dose % (1, 1, 2) +
        ',{"Id":1,"Text":"route","Score":0.25,"BeginOffset":1,"EndOffset":3}]}]}'
    )
    assert (found[3, 4], found[4, 4]) == ('{"Entities":[]}', "{}")
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert "NEGATION" in plan.split("Generate", 1)[1]
