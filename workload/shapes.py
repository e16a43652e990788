"""Driver tables reshaped, row by row, into resources, statements, texts and responses.

Nothing is grouped or joined here: every shape is a projection of one table, so it grows with the
table and has no hot key. Forms that differ between rows are chosen by a key, never filtered by it.
A shape is stored in the shared working folder when a session first uses it, and read from there by
every query: operators then run over stored nested tables, as they do on landed data.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from clinlake.session import split_large_methods, working_folder

_stored: dict[tuple[str, str, str], str] = {}

# Bytes of a table's files that one task reshapes.
PART_BYTES = 2 << 20


def stored(shape: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @functools.wraps(shape)
    def read(spark: SparkSession, sf_dir: str) -> DataFrame:
        key = (spark.sparkContext.applicationId, sf_dir, shape.__name__)
        if key not in _stored:
            path = working_folder(spark, shape.__name__)
            shape(spark, sf_dir).write.option("compression", "zstd").parquet(path)
            _stored[key] = path
        return spark.read.parquet(_stored[key])

    return read


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table in parts of equal size, as many as it needs.

    Tables come as files of any number and size. Their own rows are spread, which are narrow: what a shape makes of them is
    many times wider, and is written where it is made.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/{name}.parquet")
    size = path.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(path).getLength()
    return table(spark, sf_dir, name).repartition(max(spark.sparkContext.defaultParallelism, -(-size // PART_BYTES)))


def _extensions(key: str, standard: str) -> str:
    def one(url: str, integer: str = "null", string: str = "null", boolean: str = "null") -> str:
        return (
            f"named_struct('url', '{url}', 'valueInteger', cast({integer} as bigint), "
            f"'valueString', cast({string} as string), 'valueBoolean', cast({boolean} as boolean))"
        )

    prefix = "urn:omop:normalizedConcept:"
    return "array(" + ", ".join([
        one("urn:other", string="'unrelated'"),
        one(prefix + "id", integer=key),
        one(prefix + "code", string=f"concat('c', {key})"),
        one(prefix + "name", string=f"concat('name ', {key})"),
        one(prefix + "name", string="'second name'"),
        one(prefix + "vocabularyId", string="'RxNorm'"),
        one(prefix + "standard", string=standard),
        one(prefix + "classification:cancer", boolean=f"{key} % 2 = 0"),
        one(prefix + "domain", string="'Drug'"),
        one(prefix + "class", string=f"concat('k', {key} % 10)"),
    ]) + ")"


def _coding(i: str) -> str:
    standard = "case when o_orderstatus != 'P' then 'S' end"
    return (
        f"named_struct('system', concat('sys-', {i}), 'code', cast(o_custkey + {i} as string), "
        f"'display', concat(o_orderstatus, '-', {i}), "
        f"'extension', case when {i} < 3 then {_extensions(f'(o_custkey + {i})', standard)} end)"
    )


@stored
def medication(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as medications: 0-3 codings (NULL array for none) and 0-4 ingredients (empty for none).

    The third coding has no extensions; the third ingredient has no codings and the fourth no concept.
    """
    def ingredient(j: int) -> str:
        codings = f"array(_coding_{j}, _coding_{j + 1})" if j < 3 else "null"
        concept = f"named_struct('text', concat('ingredient ', o_custkey, '-', {j}), 'coding', {codings})" if j < 4 else "null"
        return f"named_struct('itemCodeableConcept', {concept})"

    split_large_methods(spark)
    # The same three codings are in the medication and in its ingredients: each is made once a row, by compiled expressions.
    coded = spread(spark, sf_dir, "orders").selectExpr("*", *[f"{_coding(str(i))} as _coding_{i}" for i in (1, 2, 3)])
    return coded.selectExpr(
        "concat('med-', o_orderkey) as id",
        "named_struct('text', o_orderpriority, 'coding', case when o_orderkey % 4 > 0 then "
        "slice(array(_coding_1, _coding_2, _coding_3), 1, int(o_orderkey % 4)) end) as code",
        f"slice(array({', '.join(ingredient(j) for j in (1, 2, 3, 4))}), 1, int(o_custkey % 5)) as ingredient",
    )


@stored
def condition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(spark, sf_dir, "orders").selectExpr(
        "concat('cond-', o_orderkey) as id",
        "named_struct('text', o_orderpriority, 'coding', array(named_struct('code', o_orderstatus))) as code",
        "named_struct('text', o_orderstatus) as clinicalStatus",
        "named_struct('source', concat('clerk-', o_custkey % 100)) as meta",
        "named_struct('reference', concat('Patient/', o_custkey)) as subject",
    )


@stored
def observation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(spark, sf_dir, "events").selectExpr(
        "concat('obs-', event_id) as id",
        "array(named_struct('text', event_type), named_struct('text', 'laboratory')) as category",
        "named_struct('text', concat('test ', event_type)) as code",
        "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss\") as effectiveDateTime",
        "case when user_id % 3 > 0 then named_struct('reference', concat('Encounter/', user_id)) end as encounter",
        "array(named_struct('system', 'lab', 'value', cast(event_id as string)), "
        "named_struct('system', 'site', 'value', cast(user_id as string))) as identifier",
        "named_struct('status', 'generated') as text",
        "array(named_struct('coding', array(named_struct('code', event_type), named_struct('code', 'N'))), "
        "named_struct('coding', array(named_struct('code', 'H')))) as interpretation",
        "named_struct('reference', concat('Patient/', user_id)) as subject",
        "named_struct('code', 'mg', 'system', 'ucum', 'unit', 'mg/L', 'value', value) as valueQuantity",
        "case when event_type = 'error' then 'invalid' end as valueString",
    )


@stored
def procedure(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(spark, sf_dir, "lineitem").selectExpr(
        "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) as id",
        "named_struct('text', concat('procedure ', l_partkey)) as code",
        "named_struct('reference', concat('Encounter/', l_orderkey)) as encounter",
        "named_struct('coding', array(named_struct('code', l_returnflag, 'display', l_linestatus), "
        "named_struct('code', 'line', 'display', cast(l_linenumber as string)))) as category",
        "array(named_struct('value', cast(l_suppkey as string))) as identifier",
        "named_struct('reference', concat('Patient/', l_suppkey)) as subject",
        "named_struct('status', 'additional') as text",
    )


@stored
def patient(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(spark, sf_dir, "customer").selectExpr(
        "concat('pat-', c_custkey) as id",
        "case when c_mktsegment = 'BUILDING' then null when c_custkey % 2 = 0 then 'female' else 'male' end as gender",
    )


@stored
def practitioner(spark: SparkSession, sf_dir: str) -> DataFrame:
    address = (
        "named_struct('city', concat('city ', s_nationkey, {n}), 'country', concat('nation ', s_nationkey), "
        "'district', 'd{n}', 'line', array(s_name, 'floor {n}'), 'postalCode', cast(s_suppkey as string), "
        "'state', 's{n}', 'use', 'work')"
    )
    return spread(spark, sf_dir, "supplier").selectExpr(
        "concat('prac-', s_suppkey) as id",
        f"array({address.format(n=1)}, {address.format(n=2)}) as address",
        "array(named_struct('family', s_name, 'suffix', array('MD', 'PhD'), 'use', 'official')) as name",
        "array(named_struct('value', concat('555-', s_suppkey))) as telecom",
    )


@stored
def encounter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(spark, sf_dir, "conversations").selectExpr(
        "concat('enc-', conv_id, '-', turn) as id",
        "named_struct('display', role) as class",
        "array(named_struct('condition', named_struct('reference', concat('Condition/', conv_id)))) as diagnosis",
        "named_struct('dischargeDisposition', named_struct('text', 'home')) as hospitalization",
        "array(named_struct('value', concat('v', turn), 'assigner', named_struct('display', 'desk'))) as identifier",
        "array(named_struct('location', named_struct('reference', concat('Location/', turn)))) as location",
        "named_struct('source', 'chat') as meta",
        "array(named_struct('individual', named_struct('reference', concat('Practitioner/', role))), "
        "named_struct('individual', named_struct('reference', concat('Practitioner/', conv_id)))) as participant",
        "named_struct('start', concat('t', turn), 'end', concat('t', turn + 1)) as period",
        "'Encounter' as resourceType",
        "case when turn = 0 then 'planned' else 'finished' end as status",
        "named_struct('reference', concat('Patient/', conv_id)) as subject",
        "named_struct('status', 'generated') as text",
        "array(named_struct('text', text)) as type",
    )


@stored
def timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event times in five forms, one of which is no timestamp."""
    return spread(spark, sf_dir, "events").selectExpr(
        "event_id",
        "case event_id % 5 "
        "when 0 then date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSS'-03:00'\") "
        "when 1 then date_format(ts, \"yyyy-MM-dd HH:mm:ss.SSSSSS' UTC'\") "
        "when 2 then date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss'Z'\") "
        "when 3 then date_format(ts, 'yyyy-MM-dd HH:mm:ss') "
        "else concat('Take 2.5 mg TABLET at ', event_id) end as effectivedatetime",
        "case when user_id % 7 = 0 then 'null' when user_id % 7 = 1 then '' when user_id % 7 = 2 then null "
        "else date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss'+0100'\") end as dateasserted",
    )


@stored
def references(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(spark, sf_dir, "events").selectExpr(
        "event_id",
        "case event_id % 5 when 0 then concat('Patient/', user_id) "
        "when 1 then concat('reference=Medication/', event_id, '/x, display=', event_type) "
        "when 2 then concat('http://host/', user_id) when 3 then event_type else null end as ref",
        "concat('Medication/', event_id) as medicationreference_reference",
        "case when user_id % 2 = 0 then concat('Patient/', user_id) else concat('Group/', user_id) end "
        "as subject_reference",
        "concat('PractitionerRole/', event_type) as informationsource_reference",
    )


@stored
def concept_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines as reason text: extension JSON inside key=value text; some concepts lack fields."""

    def ext(name: str, field: str, value: str) -> str:
        return f"""'{{"url":"urn:omop:normalizedConcept:{name}","{field}":', {value}, '}},'"""

    return spread(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        "concat('[{coding=[{extension=[', "
        + ext("id", "valueInteger", "l_partkey") + ", "
        + ext("code", "valueString", "'\"C', l_suppkey, '\"'") + ", "
        + ext("name", "valueString", "'\"part ', l_partkey, '\"'") + ", "
        + ext("vocabularyId", "valueString", "'\"SNOMED\"'") + ", "
        + ext("domain", "valueString", "'\"', l_returnflag, '\"'") + ", "
        + ext("class", "valueString", "'\"', l_linestatus, '\"'") + ", "
        + ext("classification:cancer", "valueBoolean", "if(l_linenumber % 2 = 0, 'true', 'false')") + ", "
        + "'], code=', l_orderkey, ', display= part ', l_partkey, ' }], ', "
        + "if(l_returnflag = 'A', concat('text=reason ', l_suppkey), 'note'), '}]') as reasoncode",
    )


@stored
def dosage_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines as dosage text: key=value form, JSON form, and a form with ``null`` in the usual places."""
    pairs = (
        "concat('[{text=Take ', l_linenumber, ' mg, patientInstruction=with food ', l_suppkey, "
        "', additionalInstruction=[{text=note ', l_partkey, ', display=see ', l_orderkey, '}], "
        "timing={repeat={frequency=', l_linenumber, ', period=', l_suppkey, ', periodUnit=', l_returnflag, '}}, "
        "asNeededBoolean=', if(l_linestatus = 'F', 'false', 'null'), ', "
        "route={code=', l_partkey, ', system=snomed, display=Oral ', l_linestatus, '}, "
        "doseQuantity={value=', l_suppkey, '.5, unit=mg}}]')"
    )
    json = (
        "concat('[{\"text\": \"Take ', l_linenumber, '\", \"patientInstruction\": \"with food ', l_suppkey, "
        "'\", \"frequency\": ', l_linenumber, ', \"period\": ', l_suppkey, ', \"periodUnit\": \"d\", "
        "\"asNeededBoolean\": true, \"display\": \"Oral ', l_linestatus, '\", \"value\": ', l_suppkey, "
        "'.25, \"unit\": \"ml\"}]')"
    )
    nulls = (
        "concat('{text=null, patientInstruction=null, _patientInstruction=q, route={code=null, display=null}, "
        "doseQuantity={unit=null}, value=', l_linenumber, ', unit=drop}')"
    )
    return spread(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        f"case l_partkey % 3 when 0 then {pairs} when 1 then {json} else {nulls} end as dosage",
    )


@stored
def narratives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(spark, sf_dir, "pages").selectExpr(
        "page_id", "concat('{status=generated, ', replace(html, '<div', 'div=<div'), '}') as text"
    )


@stored
def lenient_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as JSON, quote-wrapped JSON, key=value text, JSON with junk behind it, and broken text."""
    document = "to_json(named_struct('id', event_id, 'kind', event_type, 'user', user_id))"
    return spread(spark, sf_dir, "events").selectExpr(
        "event_id",
        f"case event_id % 5 when 0 then {document} "
        f"when 1 then concat('\"', replace({document}, '\"', '\"\"'), '\"') "
        "when 2 then concat('{id=', event_id, ', kind=', event_type, ', user=', user_id, '}') "
        f"when 3 then concat({document}, ' junk') "
        "else concat('{', event_type) end as doc",
    )


@stored
def nested_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as two JSON columns with objects, arrays, extensions, references and timestamps."""
    return spread(spark, sf_dir, "events").selectExpr(
        "event_id",
        "to_json(named_struct("
        "'source', event_type, "
        "'lastUpdated', date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSS'-03:00'\"), "
        "'tag', array(named_struct('code', event_type, 'user', user_id), named_struct('code', 'T', 'user', null)), "
        "'by', concat('reference=Patient/', user_id, ', display=x'), "
        "'a-b', named_struct('c', named_struct('d', event_id)), "
        "'extension', array("
        "named_struct('url', 'urn:x:kind', 'valueString', event_type, 'valueInteger', null), "
        "named_struct('url', 'http://x/seq', 'valueString', null, 'valueInteger', event_id)), "
        "'flags', array(user_id % 2 = 0, true))) as meta",
        "case when user_id % 4 = 0 then null else concat('[{\"system\":\"', event_type, '\",\"value\":\"', "
        "event_id, '\",\"empty\":\"\",\"none\":null,\"list\":[]}]') end as identifier",
    )


@stored
def nested_key_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as dosage cells: nested key=value text five levels deep, flat key=value text, and JSON."""
    nested = (
        "concat('[{text=Take ', o_custkey, ' mg, then rest = more, route={code=', o_custkey, ', display=Oral, by \"', o_orderstatus, "
        "'\"}, timing={repeat={bounds={start=', date_format(o_orderdate, 'yyyy-MM-dd'), '}}}, note=[', o_orderpriority, "
        "', [', o_orderstatus, ', {deep=yes}]], none=[], asNeeded=null}, {text=, extension=[{\"url\":\"urn:x:rank\",\"valueInteger\":', "
        "o_orderkey, '}]}]')"
    )
    flat = "concat('{text=Take ', o_custkey, ', unit=', o_orderstatus, '}')"
    json = "concat('{\"text\":\"a=b, {c=', o_custkey, '}\",\"n\":', o_orderkey, '}')"
    return spread(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", f"case o_orderkey % 4 when 0 then {flat} when 1 then {json} else {nested} end as dosage"
    )


@stored
def extension_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event types and users as an extension array; entries without url or value are to be dropped."""
    return spread(spark, sf_dir, "events").selectExpr(
        "event_id",
        "concat('[{\"url\":\"urn:x:documentId\",\"valueString\":\"d', event_id, '\"},"
        "{\"url\":\"http://x/count\",\"valueInteger\":', user_id, '},"
        "{\"valueString\":\"no url\"},{\"url\":\"urn:x:none\"},"
        "{\"url\":\"urn:x:', event_type, '\",\"valueBoolean\":true}]') as ext",
    )


@stored
def statements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as medication statements with all fifteen JSON text columns."""
    return spread(spark, sf_dir, "orders").selectExpr(
        "concat('st-', o_orderkey) as id",
        "case o_orderstatus when 'F' then 'completed' when 'O' then '' else 'null' end as Status",
        "date_format(o_orderdate, \"yyyy-MM-dd'T'HH:mm:ss.SSS'-03:00'\") as effectivedatetime",
        "case when o_custkey % 3 = 0 then 'null' else date_format(o_orderdate, \"yyyy-MM-dd HH:mm:ss.SSSSSS' UTC'\") end "
        "as dateasserted",
        "concat('{\"source\":\"', o_orderpriority, '\",\"lastUpdated\":\"', "
        "date_format(o_orderdate, \"yyyy-MM-dd'T'HH:mm:ss'Z'\"), '\"}') as meta",
        "concat('{status=generated, div=<div xmlns=\"h\"><p>Take ', o_orderkey, '</p></div>}') as text",
        "concat('[{\"url\":\"urn:x:documentId\",\"valueString\":\"d', o_orderkey, '\"},"
        "{\"url\":\"urn:x:rank\",\"valueInteger\":', o_custkey, '}]') as extension",
        "concat('\"[{\"\"system\"\":\"\"s\"\",\"\"value\"\":\"\"', o_orderkey, '\"\"}]\"') as identifier",
        "concat('{\"coding\":[{\"code\":\"', o_custkey, '\",\"extension\":[{\"url\":\"urn:omop:normalizedConcept:id\","
        "\"valueInteger\":', o_orderkey, '}]},{\"code\":\"x\"}],\"text\":\"\"}') as medicationcodeableconcept",
        "concat('{\"reference\":\"Medication/', o_orderkey, '\",\"display\":\"null\"}') as medicationreference",
        "concat('\"{\"\"reference\"\":\"\"Patient/', o_custkey, '\"\"}\"') as subject",
        "concat('{\"r\":\"reference=Encounter/', o_orderkey, '\"}') as context",
        "concat('{start=', date_format(o_orderdate, \"yyyy-MM-dd'T'HH:mm:ss'Z'\"), ', end=open}') as effectiveperiod",
        "concat('{reference=', if(o_custkey % 2 = 0, 'PractitionerRole/', 'Organization/'), o_custkey, '}') "
        "as informationsource",
        "case when o_custkey % 4 = 0 then 'null' when o_custkey % 4 = 1 then ' ' when o_custkey % 4 = 2 then '{a' "
        "else cast(o_custkey as string) end as derivedfrom",
        "concat('[{\"code\":{\"x\":1}, code=', o_custkey, ', display=due ', o_orderkey, '}]') as reasoncode",
        "concat('[{\"reference\":\"Condition/', o_orderkey, '\"}]') as reasonreference",
        "concat('[{\"text\":\"note ', o_orderkey, '\",\"n\":[1,[true,{\"deep\":', o_custkey, '}]]}]') as note",
        "concat('[{text=Take ', o_custkey % 9, ' mg, doseQuantity={value=', o_custkey, '.5, unit=mg}}]') as dosage",
    )


@stored
def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as annotation responses, one per api; 0-4 entities each, whose Ids and traits repeat."""
    apis = "'detect_entities_v2', 'detect_phi', 'infer_icd10_cm', 'infer_rx_norm', 'infer_snomed_ct'"
    count = "int(o_custkey % 5)"

    # Most of an entity is the same for all apis: that text is made once an order, and only joined for each api.
    def before(k: int) -> str:
        text = f"to_json(named_struct('Id', {k} % 3, 'Text', concat(o_orderpriority, ' ', {k}), 'Category', o_orderstatus))"
        return f"case when {count} > {k} then rtrim('}}', {text}) end as before_{k}"

    def after(k: int) -> str:
        text = (
            f"to_json(named_struct('BeginOffset', {k} * 10, 'EndOffset', {k} * 10 + 5, "
            f"'Traits', case when {k} != 1 then array(named_struct('Name', 'NEGATION', 'Score', 0.5), "
            f"named_struct('Name', 'SIGN', 'Score', {k} / 4.0D), named_struct('Name', 'NEGATION', 'Score', 0.5)) end, "
            "'Attributes', array("
            f"named_struct('Id', {k}, 'Text', 'dose', 'Category', 'MED', 'Type', 'DOSAGE', 'Score', 0.5, "
            f"'RelationshipScore', 0.75, 'RelationshipType', 'DOSAGE', 'BeginOffset', {k}, 'EndOffset', {k} + 1), "
            f"named_struct('Id', {k} % 2, 'Text', 'route', 'Category', null, 'Type', o_orderstatus, 'Score', 0.25, "
            f"'RelationshipScore', null, 'RelationshipType', null, 'BeginOffset', {k}, 'EndOffset', {k} + 2))))"
        )
        return f"case when {count} > {k} then {_inside(text)} end as after_{k}"

    def concepts(k: int, field: str, code: str) -> str:
        text = (
            f"to_json(named_struct('{field}', array(named_struct('Code', concat('{code}', o_custkey, '-', {k}), "
            f"'Description', concat(o_orderpriority, ' ', {k}), 'Score', 0.25), "
            f"named_struct('Code', '{code}', 'Description', 'second', 'Score', 0.125))))"
        )
        return f"concat(',', {_inside(text)})"

    def entity(k: int) -> str:
        own = (
            f"case api_ord when 2 then {concepts(k, 'ICD10CMConcepts', 'I')} when 3 then {concepts(k, 'RxNormConcepts', 'R')} "
            f"when 4 then {concepts(k, 'SNOMEDCTConcepts', 'S')} else '' end"
        )
        typed = f"',\"Type\":\"t', api_ord, '\",\"Score\":', ({k} + api_ord) / 8.0D, ','"
        return f"case when {count} > {k} then concat(before_{k}, {typed}, after_{k}, {own}, '}}') end"

    split_large_methods(spark)
    places = range(4)
    found = f"slice(array({', '.join(entity(k) for k in places)}), 1, {count})"
    return (
        spread(spark, sf_dir, "orders")
        .selectExpr("*", *[before(k) for k in places], *[after(k) for k in places])
        .selectExpr("*", f"posexplode(array({apis})) as (api_ord, api)")
        .selectExpr(
            "o_orderkey as row_number",
            "api",
            "api_ord",
            f"coalesce(concat('{{\"Entities\":[', array_join({found}, ','), ']}}'), '{{}}') as response_json",
        )
    )


def _inside(text: str) -> str:
    """SQL for the members of a JSON object whose first is named and whose last is an array, without its braces."""
    return f"trim(both '{{}}' from {text})"


@stored
def annotated_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(spark, sf_dir, "orders").selectExpr(
        "o_orderkey as row_number", "o_custkey as case_hub_id", "o_orderpriority as case_type_name"
    )
