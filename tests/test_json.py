"""Lenient parsing and flattening of JSON text columns."""

import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from clinlake.functions import variant as V
from clinlake.operators import json_columns as J
from clinlake.plans.statements import medication_statements
from clinlake.session import keep_last_duplicate_key


def long_rows(spark, text, name="c"):
    df = spark.createDataFrame([(0, text)], f"i int, `{name}` string")
    return {(r.path, r.value) for r in J.flatten_long(df, ["i"], [name]).collect()}


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ('{"a":1}', '{"a":1}'),
        ('"{""reference"":""Patient/p1""}"', '{"reference":"Patient/p1"}'),
        ("{reference=Patient/p1, display=x}", '{"display":"x","reference":"Patient/p1"}'),
        ("[{a=1}, {a=2}]", '[{"a":"1"},{"a":"2"}]'),
        ('{"a":""}', '{"a":""}'),
        ('{"a":1,"a":2}', '{"a":2}'),
        ("12", "12"),
        ('"12"', "12"),
        ('{"a":1} junk', None),
        ('{"a":1}{"b":2}', None),
        ('{"a":1}]', None),
        ("1, 2", None),
        ("{outer={inner=1}}", None),
        ("{a", None),
        ("null", None),
        (" ", None),
        (None, None),
        ('"plain words"', None),
    ],
)
def test_parse_json_lenient(spark, text, expected):
    keep_last_duplicate_key(spark)
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(F.to_json(V.parse_json_lenient("t")).alias("r")).first().r == expected


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ('{"reference":"Medication/3f41"}', {("c_reference", "Medication/3f41")}),
        ('[{"system":"s","value":"v"}]', {("c_0_system", "s"), ("c_0_value", "v")}),
        ('{"r":"reference=Medication/m1"}', {("c_r_Medication", "m1")}),
        ('["reference=Medication/m1"]', {("c_0", "reference=Medication/m1")}),
        ('{"t":"2024-05-23T10:11:23.000-03:00","u":["2024-05-23T10:11:23Z"]}',
         {("c_t", "2024-05-23 10:11:23"), ("c_u_0", "2024-05-23T10:11:23Z")}),
        ('{"p":"start=2024-05-23T10:11:23Z, end"}', {("c_p", "2024-05-23 10:11:23")}),
        ('{"a b-c":{"d":true},"e":null,"f":{},"g":[]}', {("c_a_b_c_d", "true"), ("c_e", None)}),
        ('{"extension":[{"url":"urn:x:a","valueString":"1"},{"url":"http://h/b","valueObject":{"k":1}},{"url":"urn:x:n"}]}',
         {("c_extension_url_a", "1"), ("c_extension_url_b", '{"k":1}')}),
        ('{"extension":[{"url":"urn:x:a","valueString":"1"},{"url":"urn:x:a","valueString":"2"}]}', {("c_extension_url_a", "2")}),
        ('{"extension":["q"]}', {("c_extension_0", "q")}),
        ('{"x_y":1,"x":{"y":2}}', {("c_x_y", "1")}),
        ("12", {("c_value", "12")}),
        ("{a", set()),
    ],
)
def test_flatten_long(spark, text, expected):
    assert long_rows(spark, text) == expected


def test_extension_column_has_no_prefix(spark):
    text = '[{"url":"urn:x:documentId","valueString":"d1"}]'
    assert long_rows(spark, text, "extension") == {("extension_url_documentId", "d1")}
    assert long_rows(spark, text, "meta") == {("meta_0_url", "urn:x:documentId"), ("meta_0_valueString", "d1")}


def test_documents_deeper_than_the_default_are_flattened_whole(spark):
    document = {"leaf": 1}
    for _ in range(3 * V.DEFAULT_DEPTH):
        document = {"k": document}
    path = "c" + "_k" * (3 * V.DEFAULT_DEPTH) + "_leaf"
    df = spark.createDataFrame([(json.dumps(document),)], "c string")
    assert J.flatten_to_columns(df, ["c"]).columns == [path]
    assert long_rows(spark, json.dumps(document)) == {(path, "1")}


def test_maps_hold_what_long_rows_hold(spark):
    df = spark.createDataFrame([(0, '{"a":{"b":{"c":1}},"d":[2]}', None), (1, "{broken", '{"x":""}')], "i int, c string, `d e` string")
    rows = {r.i: r for r in J.flatten_to_map(df, ["c", "d e"]).collect()}
    assert rows[0].c == {"c_a_b_c": "1", "c_d_0": "2"} and rows[0]["d e"] is None
    assert rows[1].c is None and rows[1]["d e"] == {"d_e_x": ""}


scalars = st.one_of(st.text("abc xyz", max_size=6), st.integers(-1000, 1000), st.booleans())
documents = st.dictionaries(st.from_regex("[a-z]{1,3}[0-9]", fullmatch=True), st.one_of(scalars, st.lists(scalars, max_size=3)), max_size=4)


def expected_leaves(document):
    for key, value in document.items():
        items = [(f"c_{key}_{i}", v) for i, v in enumerate(value)] if isinstance(value, list) else [(f"c_{key}", value)]
        for path, v in items:
            yield path, v if isinstance(v, str) else json.dumps(v)


@settings(max_examples=6, deadline=None)
@given(rows=st.lists(documents, min_size=1, max_size=5))
def test_flatten_agrees_with_brute_force(spark, rows):
    df = spark.createDataFrame([(i, json.dumps(d)) for i, d in enumerate(rows)], "i int, c string")
    long = {(r.i, r.path, r.value) for r in J.flatten_long(df, ["i"], ["c"]).collect()}
    assert long == {(i, p, v) for i, d in enumerate(rows) for p, v in expected_leaves(d)}
    wide = J.flatten_to_columns(df, ["c"])
    assert {(r["i"], p, v) for r in wide.collect() for p, v in r.asDict().items() if p != "i" and v is not None} == long


def test_flatten_to_columns_with_given_sources_runs_no_job(spark):
    df = spark.createDataFrame([(1, '{"a":1,"b":2}', "k")], "i int, c string, plain string")
    sources = [J.Source("c", f"c_{key}", f"c{V.KEY_STEP}{key}", "member", None) for key in "bz"]
    wide = J.flatten_to_columns(df, ["c", "absent"], sources)
    assert wide.columns == ["i", "plain", "c_b", "c_z"]
    assert tuple(wide.first()) == (1, "k", "2", None)


WIDE_CASES = [
    '{"a":{"b":1},"t":"2024-05-23T10:11:23Z","r":"reference=Patient/p1"}',
    '{"a":"{text}","t":["2024-05-23T10:11:23Z"],"r":"reference=Group/g1"}',
    '{"a":[],"r":"plain reference=","extension":[{"url":"urn:x:k","valueString":"1"}]}',
    '{"a":[1,{"extension":[{"url":"urn:x:k","valueString":"2"},{"url":"urn:y:k","valueInteger":3}]}],"r":{"x":null}}',
    '{"x_y":1,"x":{"y":2},"x.y":3}',
    '{"extension":{"z":1},"a":["{b}","[c]"]}',
    "{k=v, t=2024-05-23T10:11:23Z}",
    "5",
    None,
]


@pytest.mark.parametrize("more", [[], ['{"quote\'\\"key":1}']])
@pytest.mark.parametrize("name", ["c", "extension"])
def test_wide_is_the_pivot_of_long(spark, name, more):
    """Both ways of projecting (the second case has a key no location can name) agree with the long rows."""
    df = spark.createDataFrame(list(enumerate(WIDE_CASES + more)), f"i int, `{name}` string")
    long = {(r.i, r.path): r.value for r in J.flatten_long(df, ["i"], [name]).collect() if r.value is not None}
    wide = J.flatten_to_columns(df, [name])
    assert set(wide.columns) - {"i"} == {r.path for r in J.discover_keys(df, [name]).collect()}
    found = {(r["i"], p): v for r in wide.collect() for p, v in r.asDict().items() if p != "i" and v is not None}
    assert found == long


def test_discover_keys_finds_all_columns(spark):
    df = spark.createDataFrame([('{"a":1}', '{"b":{"c":2}}'), ('{"z":1}', None)], "x string, y string")
    found = {tuple(r) for r in J.discover_keys(df, ["x", "y"]).collect()}
    assert found == {("x", "x_a"), ("x", "x_z"), ("y", "y_b_c")}


def test_table_without_json_columns_stays(spark):
    df = spark.createDataFrame([(1, "2024-05-23T10:11:23Z", "null")], "i int, dateasserted string, S string")
    assert J.flatten_to_columns(df, ["absent"]).columns == df.columns
    row = medication_statements(df).first()
    assert row.asDict() == {"i": 1, "dateasserted": "2024-05-23 10:11:23", "s": None, "dateasserted_normalized": "2024-05-23 10:11:23"}


def test_wide_names_are_distinct_without_case(spark, tmp_path):
    rows = [("p", '{"start":1,"aB":2,"ab":3}')]
    df = spark.createDataFrame(rows, "effectiveperiod_start string, effectiveperiod string")
    wide = J.flatten_to_columns(df, ["effectiveperiod"])
    assert wide.columns == ["effectiveperiod_start", "effectiveperiod_aB", "effectiveperiod_ab_2", "effectiveperiod_start_2"]
    wide.write.parquet(str(tmp_path / "w"))
    assert tuple(spark.read.parquet(str(tmp_path / "w")).first()) == ("p", "2", "3", "1")
    assert J.distinct_names(["a", "A", "a_2", "a"]) == ["a", "A_3", "a_2", "a_4"]


def test_common_fields(spark):
    df = spark.createDataFrame([('"{""id"":""a"",""text"":{""k"":1}}"',), ("{id=3}",)], "c string")
    rows = J.common_fields(df, "c").collect()
    assert (rows[0].c_id, rows[0].c_text, rows[0].c_status) == ("a", '{"k":1}', None)
    assert rows[1].c_id is None


def test_extension_columns(spark):
    df = spark.createDataFrame([(1, '[{"url":"urn:x:b","valueInteger":3},{"url":"urn:x:a-1","valueString":"v"}]'), (2, "{a")], "i int, e string")
    assert [r.asDict() for r in J.extension_columns(df, "e").orderBy("i").collect()] == [
        {"i": 1, "extension_url_a_1": "v", "extension_url_b": "3"},
        {"i": 2, "extension_url_a_1": None, "extension_url_b": None},
    ]


def test_flattening_plan_has_no_python_and_no_shuffle(spark):
    df = spark.createDataFrame([(1, '{"a":1}')], "i int, c string")
    plan = J.flatten_to_columns(df, ["c"])._jdf.queryExecution().executedPlan().toString()
    assert "EvalPython" not in plan and "Exchange" not in plan


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("{a={b={c={d={e=5}}}}}", {"a": {"b": {"c": {"d": {"e": "5"}}}}}),
        ("{text=one, two, route={code=1, display=x, y}}", {"text": "one, two", "route": {"code": "1", "display": "x, y"}}),
        ("{a=x=y, b={c=p=q}}", {"a": "x=y", "b": {"c": "p=q"}}),
        ("[{a=[x, y z,w], b=[]}, {c={}, d=}]", [{"a": ["x", "y z", "w"], "b": []}, {"c": {}, "d": ""}]),
        ("{a=[[x, y], [{z=1}], w]}", {"a": [["x", "y"], [{"z": "1"}], "w"]}),
        ('{a={b=5" \\ pipe}}', {"a": {"b": '5" \\ pipe'}}),
        ("{a={b=line\nbreak\tx}}", {"a": {"b": "line\nbreak\tx"}}),
        ('{a=[{"j":"k, l","n":5}], b=x}', {"a": [{"j": "k, l", "n": 5}], "b": "x"}),
        ('"{a={b=""q"" r}}"', {"a": {"b": '"q" r'}}),
        ('{"a":{"b":"x=1, y=2"}}', {"a": {"b": "x=1, y=2"}}),
        ("{a=1, b=2}", {"a": "1", "b": "2"}),
        ("{a={b=1}}, x=2}", None),
        ("{a=[x}]", None),
        ("{a={b=\u0001}}", None),
        ("", None),
        (None, None),
    ],
)
def test_nested_key_value(spark, text, expected):
    df = spark.createDataFrame([(text,)], "t string")
    found = df.select(F.to_json(V.parse_json_lenient("t", nested=True)).alias("r")).first().r
    assert (None if found is None else json.loads(found)) == expected


def printed(value):
    if isinstance(value, dict):
        return "{" + ", ".join(f"{k}={printed(v)}" for k, v in value.items()) + "}"
    return "[" + ", ".join(map(printed, value)) + "]" if isinstance(value, list) else value


words = st.text("ab \\'.:=-é", min_size=1, max_size=6).map(str.strip).filter(bool)
quoting = st.text('ab"\\,', min_size=1, max_size=4).filter(lambda t: '""' not in t)  # a doubled quote is one quote
cells = st.recursive(
    words,
    lambda inner: st.lists(inner, max_size=3) | st.dictionaries(st.sampled_from(["q"]), quoting, max_size=1) | st.dictionaries(st.sampled_from(["k", "l2", "m_n"]), inner, max_size=3),
    max_leaves=12,
).filter(lambda v: isinstance(v, dict))


@settings(max_examples=25, deadline=None)
@given(st.lists(cells, min_size=1, max_size=30))
def test_nested_key_value_agrees_with_what_was_printed(spark, values):
    # Flat text is read as before, by the repair of flat pairs.
    values = [{"k": v} for v in values]
    df = spark.createDataFrame([(i, printed(v)) for i, v in enumerate(values)], "i int, t string")
    rows = df.select("i", F.to_json(V.parse_json_lenient("t", nested=True)).alias("r")).collect()
    assert {r.i: r.r and json.loads(r.r) for r in rows} == dict(enumerate(values))


def leaves_by_walking(spark, texts):
    """The distinct leaves when every document is walked."""
    documents = spark.createDataFrame([("c", t) for t in texts], "column string, text string")
    return set(J._sources_at(documents.select("column", V.parse_json_lenient("text").alias("_document")), 6).drop("level").collect())


def leaves_by_shapes(spark, texts):
    return set(J.leaves_of(spark.createDataFrame([(t,) for t in texts], "c string"), ["c"]).drop("level").collect())


ODD_DOCUMENTS = [
    '{"a":"x","b":[1,-2.5e3,true,null,"s"],"c":{}}', '{"a, 5":"b:1,","d\\"=e":1}', '{"url":"urn:x:y","u":{"url":5}}', '"text"', "12", "true", "null", "[]",
    '{"r":"reference=Patient/12, display=x"}', '{"r":"reference=Patient/13"}', '{"r":"reference=Group/1"}', '{"r":"x reference= Kind / 7 ,y"}', '{"r":"reference=nothing"}',
    '{"r":"reference=A/1, reference=B/2"}', '{"r":["reference=A/1"]}', '{"extension":[{"url":"a/b:n1","valueX":1},{"url":"q","other":1},{"valueY":1}]}',
    '{"extension":[{"url":"","valueX":1}]}', '{"extension":[1]}', '{"extension":[{"url":null,"valueX":1},{"url":7,"valueX":{"a":1}}]}', '{"a":01}', '{"a":.5}', '{"a":1x}',
    '{"a":tru}', '{"a":"\\u00e9","b":"\\q"}', '{"a":"\\u00e9","b":1}', '{"a":"x\ny","b":1}', '{"a":1} junk', '{"a":1', '{"a":"b', "{a=1, b=x}", "{a={b=1}}", '{"a":1, b=2}',
    '[{"code":{"x":1}, code=5, display=due}]', '"{""a"":""b"",""c"":""""}"', '{"a":""}', '{""a"":""b""}', '"{a=1}"', '{"a":"x=1"', "{a=\u0001}", '{"a":"\u0001"}', '{"a":1,"a":{"b":2}}',
    '{"k":"v", "n" : 5 , "l" : [ 1 , "x" ] }', '{"reference=A/1":1}', '{"a":1e400}', '{"a":NaN}', '{"a":"reference=A/\\"1"}',
]


@pytest.mark.parametrize("text", ODD_DOCUMENTS)
def test_a_shape_has_the_leaves_of_its_document(spark, text):
    assert leaves_by_shapes(spark, [text]) == leaves_by_walking(spark, [text])


shaped = st.text('{}[]",:=ab1 \\\u0001\né/', max_size=14) | st.recursive(
    st.sampled_from(["reference=A/1", "reference=B/2, x", "a, b", 'q"r', "x=y", "", "é"]) | st.integers(-3, 3) | st.booleans() | st.none() | st.floats(allow_nan=False),
    lambda inner: st.lists(inner, max_size=3) | st.dictionaries(st.sampled_from(["a", "url", "valueX", "extension", "b c", 'q"'], ), inner, max_size=3),
    max_leaves=8,
).map(json.dumps)


@settings(max_examples=15, deadline=None)
@given(st.lists(shaped, min_size=1, max_size=40))
def test_shapes_have_the_leaves_of_all_documents(spark, texts):
    assert leaves_by_shapes(spark, texts) == leaves_by_walking(spark, texts)


def test_as_many_shapes_as_rows(spark):
    texts = [json.dumps({f"k{i}": {"x": i}}) for i in range(300)]
    df = spark.createDataFrame([(t,) for t in texts], "c string")
    assert J.document_shapes(df, ["c"]).count() == 300
    assert leaves_by_shapes(spark, texts) == leaves_by_walking(spark, texts)


def test_documents_of_one_shape_are_walked_once(spark):
    df = spark.createDataFrame([(json.dumps({"a": f"t{i}", "b": [i, None], "r": f"reference=P/{i}"}),) for i in range(500)], "c string")
    assert J.document_shapes(df, ["c"]).count() == 1


def test_nested_texts_are_flattened_without_a_walk_for_their_depth(spark, monkeypatch):
    def walked(*_):
        raise AssertionError("walked")

    monkeypatch.setattr(J, "_sources_at", walked)
    deep = "{a={b={c={d={e={f={g={h=x}}}}}}}}"
    assert long_rows_nested(spark, deep) == {("c_a_b_c_d_e_f_g_h", "x")}
    assert long_rows_nested(spark, '{"a":"]}]}","b":{"c":[{"d":"{["}]}}') == {("c_a", "]}]}"), ("c_b_c_0_d", "{[")}
    assert long_rows_nested(spark, '["{{{{{{{{"]') == {("c_0", "{{{{{{{{")}
    assert long_rows_nested(spark, None) == long_rows_nested(spark, "[]") == long_rows_nested(spark, "{a") == set()


def long_rows_nested(spark, text):
    df = spark.createDataFrame([(0, text)], "i int, c string")
    return {(r.path, r.value) for r in J.flatten_long(df, ["i"], ["c"], nested=["c"]).collect()}


def test_brackets_bound_the_levels(spark):
    texts = ['{"a":[[1,{"b":"{[{[\\""}]],"c":{}}', "[]", "12", '"[[["']
    df = spark.createDataFrame([(t,) for t in texts], "c string").select("c", V.parse_json_strict("c").alias("d"))
    found = df.select("c", V.bracket_skeleton("d").alias("s")).select("c", "s", V.nesting("s").alias("n"))
    assert {(r.c, r.s, r.n) for r in found.collect()} == {
        (texts[0], "{[[{}]]{}}", 4), (texts[1], "[]", 1), (texts[2], "", 0), (texts[3], "", 0),
    }


@pytest.mark.parametrize("text", ['1,"$end-of-document$"', '1,"$end-of-document$",2', '{"a":"$end-of-document$"}'])
def test_text_with_the_end_mark(spark, text):
    df = spark.createDataFrame([(text,)], "c string").select(V.parse_json_lenient("c").cast("string").alias("v"))
    assert df.first().v == (text if text.startswith("{") else None)
    assert "not contains(t, '$end-of-document$') or" in V._parse_strict("t")  # the rest is not looked at otherwise


def test_names_keep_word_characters_only(spark):
    assert long_rows(spark, '{"a-b":1,"\u00e9_Z9":2,"\U0001f600.x":3}') == {("c_a_b", "1"), ("c___Z9", "2"), ("c___x", "3")}


def test_the_first_form_of_a_document_is_parsed_without_lambdas(spark):
    texts = ['{"a":1}', '"{""a"":1}"', '"{""a"":1}', '{"a":""x""}', "{a=1}", '"{a=1}"', '"a=1"', '""', '"', " null ", "", None, "{a", "12",
             '"12"', '{"a":1} x', '1,"$end-of-document$"', '1,"$end-of-document$",2', "[{a=1}, {b={c=2}}]", '{"a":1}]', " [1] "]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, `c d` string")
    for nested in ([], ["c d"]):
        steps = V.document_steps({"_document_0": "c d"}, nested)
        assert all("->" not in sql for step in steps[:-1] for sql in step.values())
        frame = df.withColumn("w", V.parse_json_lenient("c d", bool(nested)))
        for step in steps:
            frame = frame.selectExpr("*", *[f"{sql} as {name}" for name, sql in step.items()])
        found = frame.selectExpr("i", "to_json(w) as w", "to_json(_document_0) as d").collect()
        assert [(r.i, r.d) for r in found] == [(r.i, r.w) for r in found]
        assert found[1].d == '{"a":1}'
