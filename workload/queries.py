"""The registered queries: each runs an operator over whole driver tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clinlake.functions import text as T
from clinlake.functions import variant as V
from clinlake.operators import annotation as A
from clinlake.operators import concepts as C
from clinlake.operators import fhir
from clinlake.operators import json_columns as J
from clinlake.operators import rows as R
from clinlake.operators import text_columns as TC
from clinlake.plans.annotations import annotate_rows, annotate_texts, annotation_tables, write_annotation_tables
from clinlake.plans.landing import DELIMITED_TABLES, ingest_all, ingest_new, ingest_resources
from clinlake.plans.staging import stage_resource, stage_resources
from clinlake.plans.statements import append_statements
from clinlake.plans.statements import medication_statements as wide_statements
from clinlake.session import keep_last_duplicate_key, working_folder
from clinlake.sources import batches, readers, writers
from clinlake.sources.schemas import RESOURCES
from workload import shapes
from workload.detectors import NUMBERS, WORDS_IN_CAPITALS, failing_detector, identified, pattern_detector

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = function
    return function


def _joined(*columns: str) -> dict:
    return {c: F.array_join(c, "|", "NULL") for c in columns}


def new_database(spark: SparkSession, purpose: str) -> str:
    """A database of its own, stored in the shared working folder."""
    name = f"{purpose}_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{working_folder(spark, purpose)}'")
    return name


# -- nested resources ----------------------------------------------------------------------------


@query
def medication_concepts(spark, sf_dir):
    return C.medication_concepts(shapes.medication(spark, sf_dir))


@query
def medication_flat(spark, sf_dir):
    flat = fhir.project_medication(shapes.medication(spark, sf_dir))
    return flat.withColumns(_joined("ingredient_coding_codes", "ingredient_texts"))


@query
def concepts_first_coding(spark, sf_dir):
    return C.concepts_first_coding(shapes.medication(spark, sf_dir))


@query
def concepts_first_ingredient(spark, sf_dir):
    return C.concepts_first_ingredient(shapes.medication(spark, sf_dir))


@query
def concepts_first_combined(spark, sf_dir):
    return C.concepts_first_combined(shapes.medication(spark, sf_dir))


@query
def coding_concepts_standard(spark, sf_dir):
    return C.coding_concepts(shapes.medication(spark, sf_dir))


@query
def ingredient_concepts(spark, sf_dir):
    return C.ingredient_concepts(shapes.medication(spark, sf_dir))


@query
def explode_items(spark, sf_dir):
    """Ingredients per medication, with the medications that have none."""
    rows = fhir.explode_items(shapes.medication(spark, sf_dir), ["id"], F.col("ingredient"), "item", keep_empty=True)
    return rows.select("id", F.col("item.itemCodeableConcept.text").alias("ingredient_text"))


@query
def project_condition(spark, sf_dir):
    return fhir.project_condition(shapes.condition(spark, sf_dir))


@query
def project_observation(spark, sf_dir):
    rows = fhir.project_observation(shapes.observation(spark, sf_dir))
    codes = F.array_join(F.flatten("interpretation_coding").getField("code"), "|")
    return rows.withColumns(
        _joined("category_text", "identifier_system", "identifier_value") | {"interpretation_coding": codes}
    )


@query
def project_procedure(spark, sf_dir):
    rows = fhir.project_procedure(shapes.procedure(spark, sf_dir))
    return rows.withColumns(_joined("category_coding_code", "category_coding_display", "identifier_value"))


@query
def project_patient(spark, sf_dir):
    return fhir.project_patient(shapes.patient(spark, sf_dir))


@query
def project_practitioner(spark, sf_dir):
    rows = fhir.project_practitioner(shapes.practitioner(spark, sf_dir))
    flat = ["address_city", "country", "district", "postalCode", "state", "use", "name_family", "name_use", "phone_number"]
    return rows.withColumns(
        _joined(*flat) | {c: F.array_join(F.flatten(c), "|") for c in ("line", "name_suffix")}
    )


@query
def project_encounter(spark, sf_dir):
    rows = fhir.project_encounter(shapes.encounter(spark, sf_dir))
    return rows.withColumns(_joined(
        "diagnosis_condition_reference",
        "identifier_assigner_display",
        "identifier_value",
        "location_location_reference",
        "participant_individual_reference",
        "type_text",
    ))


@query
def stage_dispatch(spark, sf_dir):
    return stage_resource(shapes.patient(spark, sf_dir), "Patient")


# -- text ----------------------------------------------------------------------------------------


@query
def timestamp_normalize(spark, sf_dir):
    return TC.normalize_timestamp_columns(shapes.timestamps(spark, sf_dir))


@query
def reference_parse(spark, sf_dir):
    parsed = T.parse_reference(F.col("ref"))
    return shapes.references(spark, sf_dir).select(
        "event_id", parsed.getField("type").alias("ref_type"), parsed.getField("id").alias("ref_id")
    )


@query
def reference_ids(spark, sf_dir):
    return TC.reference_ids(shapes.references(spark, sf_dir)).drop("ref")


@query
def urn_key_value(spark, sf_dir):
    events = shapes.table(spark, sf_dir, "events")
    url = F.when(F.col("user_id") % 3 == 0, F.lit("")).otherwise(F.concat(F.lit("urn:x:doc-"), F.col("event_type")))
    pair = T.urn_key_value(url, F.col("event_id").cast("string"))
    return events.select("event_id", pair.getField("key").alias("key"), pair.getField("value").alias("value"))


@query
def concept_fields_from_text(spark, sf_dir):
    return TC.concept_fields(shapes.concept_texts(spark, sf_dir)).drop("reasoncode")


@query
def dosage_fields_from_text(spark, sf_dir):
    return TC.dosage_fields(shapes.dosage_texts(spark, sf_dir)).drop("dosage")


@query
def div_text(spark, sf_dir):
    return shapes.narratives(spark, sf_dir).select("page_id", T.div_text(F.col("text")).alias("text_div_cleaned"))


@query
def null_tokens(spark, sf_dir):
    customers = shapes.table(spark, sf_dir, "customer").selectExpr(
        "c_custkey",
        "case c_custkey % 4 when 0 then '' when 1 then 'null' when 2 then null else c_name end as c_name",
        "if(c_nationkey = 3, 'null', c_mktsegment) as c_mktsegment",
        "c_acctbal",
    )
    return TC.null_tokens(customers)


@query
def lowercase_columns(spark, sf_dir):
    orders = shapes.table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey as OrderKey", "o_custkey as orderkey", "o_orderstatus as O_Status", "o_orderpriority as Priority"
    )
    return TC.lowercase_columns(orders.drop("Priority"))


# -- JSON ----------------------------------------------------------------------------------------


@query
def json_parse_lenient(spark, sf_dir):
    keep_last_duplicate_key(spark)
    parsed = shapes.lenient_json(spark, sf_dir).select("event_id", V.parse_json_lenient("doc").alias("v"))
    return parsed.select(
        "event_id",
        *[F.try_variant_get("v", f"$.{field}", "string").alias(f"doc_{field}") for field in ("id", "kind", "user")],
    )


@query
def json_flatten_long(spark, sf_dir):
    return J.flatten_long(shapes.nested_json(spark, sf_dir), ["event_id"], ["meta", "identifier"])


@query
def json_nested_key_value(spark, sf_dir):
    """The leaves of cells whose pairs hold objects and arrays."""
    return J.flatten_long(shapes.nested_key_values(spark, sf_dir), ["o_orderkey"], ["dosage"], nested=["dosage"])


@query
def json_flatten_map(spark, sf_dir):
    """The entries of the maps, a row each."""
    maps = J.flatten_to_map(shapes.nested_json(spark, sf_dir), ["meta", "identifier"])
    # All maps of a row in one array: a frame for each column would flatten every document once more.
    entries = ", ".join(
        f"transform(coalesce(map_entries({c}), array()), e -> named_struct('column', '{c}', 'path', e.key, 'value', e.value))"
        for c in ("meta", "identifier")
    )
    rows = maps.select("event_id", F.explode_outer(F.expr(f"concat({entries})")).alias("_entry"))
    return rows.filter("_entry is not null").select("event_id", "_entry.*")


@query
def json_discover_keys(spark, sf_dir):
    return J.discover_keys(shapes.nested_json(spark, sf_dir), ["meta", "identifier"])


@query
def json_flatten_wide(spark, sf_dir):
    return J.flatten_to_columns(shapes.nested_json(spark, sf_dir), ["meta", "identifier"])


@query
def json_common_fields(spark, sf_dir):
    rows = shapes.table(spark, sf_dir, "events").selectExpr(
        "event_id",
        "case when event_id % 3 = 0 then concat('\"{\"\"id\"\":\"\"', event_id, '\"\"}\"') else "
        "to_json(named_struct('id', event_id, 'status', event_type, 'text', named_struct('k', user_id))) end as doc",
    )
    return J.common_fields(rows, "doc").drop("doc")


@query
def json_clean_text(spark, sf_dir):
    return shapes.lenient_json(spark, sf_dir).select("event_id", V.clean_json_text(F.col("doc")).alias("cleaned"))


@query
def json_extension_columns(spark, sf_dir):
    return J.extension_columns(shapes.extension_json(spark, sf_dir), "ext")


@query
def json_shape_probe(spark, sf_dir):
    return J.probe_json_shape(shapes.lenient_json(spark, sf_dir), ["doc"])


@query
def medication_statements(spark, sf_dir):
    return wide_statements(shapes.statements(spark, sf_dir))


# -- annotation ----------------------------------------------------------------------------------


@query
def annotate_text(spark, sf_dir):
    """Responses of two detectors over whole documents, summed up per document and api."""
    documents = shapes.table(spark, sf_dir, "documents")
    detectors = {"numbers": pattern_detector(NUMBERS), "capitals": pattern_detector(WORDS_IN_CAPITALS)}
    responses = A.annotate(documents, "doc_id", "text", detectors)
    found = F.from_json("response_json", "struct<Entities:array<struct<Text:string>>>").getField("Entities")
    return responses.select(
        "doc_id", "api", "api_ord", "error",
        F.size(found).cast("long").alias("n_entities"),
        F.array_join(found.getField("Text"), "|").alias("texts"),
    )


@query
def detected_entities(spark, sf_dir):
    documents = shapes.table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = A.detected_entities(documents, "doc_id", "text", pattern_detector(NUMBERS))
    return rows.select("doc_id", "text", F.array_join("detected_entities", "|").alias("detected_entities"), "error")


@query
def annotation_entities(spark, sf_dir):
    return A.entities(shapes.responses(spark, sf_dir), rows=shapes.annotated_rows(spark, sf_dir))


@query
def annotation_entities_per_row(spark, sf_dir):
    """De-duplicated over all apis of a source row."""
    return A.entities(shapes.responses(spark, sf_dir), scope="row", rows=shapes.annotated_rows(spark, sf_dir))


@query
def annotation_traits(spark, sf_dir):
    return A.traits(shapes.responses(spark, sf_dir), rows=shapes.annotated_rows(spark, sf_dir))


@query
def annotation_traits_per_row(spark, sf_dir):
    return A.traits(shapes.responses(spark, sf_dir), scope="row", rows=shapes.annotated_rows(spark, sf_dir))


@query
def annotation_attributes(spark, sf_dir):
    return A.attributes(shapes.responses(spark, sf_dir), rows=shapes.annotated_rows(spark, sf_dir))


@query
def annotation_icd10(spark, sf_dir):
    return A.icd10_concepts(shapes.responses(spark, sf_dir), rows=shapes.annotated_rows(spark, sf_dir))


@query
def annotation_snomed(spark, sf_dir):
    return A.snomed_concepts(shapes.responses(spark, sf_dir), rows=shapes.annotated_rows(spark, sf_dir))


@query
def annotation_rxnorm(spark, sf_dir):
    return A.rxnorm_concepts(shapes.responses(spark, sf_dir), rows=shapes.annotated_rows(spark, sf_dir))


@query
def annotation_table_rows(spark, sf_dir):
    """Rows of each annotation table after the whole flow has written them."""
    database = new_database(spark, "annotations")
    rows = shapes.annotated_rows(spark, sf_dir)
    written = write_annotation_tables(shapes.responses(spark, sf_dir), rows, database)
    counts = [
        spark.table(f"{database}.{name}").agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("case_hub_id").alias("n_cases"))
        .withColumn("table_name", F.lit(name))
        for name in written
    ]
    result = counts[0]
    for frame in counts[1:]:
        result = result.unionByName(frame)
    return result


@query
def annotation_flow(spark, sf_dir):
    """Documents numbered, rendered, annotated and normalised: entities with their source row."""
    rows = shapes.table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    numbered, responses = annotate_rows(rows, {"detect_entities_v2": pattern_detector(NUMBERS)}, ["doc_id"])
    entities = annotation_tables(responses, numbered.drop("text"))["entities"]
    return entities.select("row_number", "doc_id", "lang", "Id", F.col("Text").alias("entity_text"))


@query
def annotation_failures(spark, sf_dir):
    """Calls that failed, with their source row; the other detector's responses are there all the same."""
    rows = shapes.table(spark, sf_dir, "documents").select("doc_id", "text")
    detectors = {"detect_entities_v2": pattern_detector(NUMBERS), "detect_phi": failing_detector("@")}
    numbered, responses = annotate_rows(rows, detectors, ["doc_id"])
    failed = annotation_tables(responses, numbered.drop("text"))["failures"]
    return failed.select("row_number", "doc_id", "api", "api_ord", "error")


@query
def annotation_reuse(spark, sf_dir):
    """Texts of two runs, the second with the first one's again: entities, and the calls that each text took over both."""
    documents = shapes.table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    database = new_database(spark, "annotated")
    detectors = {"detect_entities_v2": identified(pattern_detector(NUMBERS))}
    annotate_texts(documents.filter("lang = 'en'"), "doc_id", "text", detectors, database, "responses", "v1")
    responses = annotate_texts(documents, "doc_id", "text", detectors, database, "responses", "v1")
    calls = spark.table(f"{database}.responses").groupBy("digest").agg(F.countDistinct("response_json").alias("calls"))
    entities = F.size(F.from_json("response_json", "struct<Entities:array<struct<Id:int>>>")["Entities"]).alias("n_entities")
    texts = documents.select("doc_id", F.sha2("text", 256).alias("digest")).join(calls, "digest")
    return responses.select("doc_id", "api", entities).join(texts, "doc_id").select("doc_id", "api", "n_entities", "calls")


# -- rows ----------------------------------------------------------------------------------------


@query
def row_number(spark, sf_dir):
    orders = shapes.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return R.with_row_number(orders, ["o_orderstatus", "o_orderkey"])


@query
def render_rows(spark, sf_dir):
    customers = shapes.table(spark, sf_dir, "customer").selectExpr(
        "c_custkey", "c_name", "if(c_nationkey = 3, null, c_mktsegment) as c_mktsegment"
    )
    return R.render_rows(R.with_row_number(customers, ["c_custkey"]))


@query
def cast_sum(spark, sf_dir):
    texts = shapes.table(spark, sf_dir, "orders").selectExpr(
        "case when o_orderstatus = 'P' then concat(o_custkey, 'x') else cast(o_custkey + 3000000000 as string) end as case_hub_id"
    )
    return R.sum_as_integer(texts, "case_hub_id", "total")


@query
def row_count(spark, sf_dir):
    return shapes.table(spark, sf_dir, "lineitem").agg(F.count(F.lit(1)).alias("n_rows"))


@query
def distinct_rows(spark, sf_dir):
    return shapes.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_returnflag").distinct()


@query
def filter_eq(spark, sf_dir):
    return shapes.table(spark, sf_dir, "orders").filter(F.col("o_orderstatus") == "F").select("o_orderkey", "o_orderstatus")


@query
def filter_in(spark, sf_dir):
    customers = shapes.table(spark, sf_dir, "customer")
    return customers.filter(F.col("c_mktsegment").isin("BUILDING", "MACHINERY")).select("c_custkey", "c_mktsegment")


@query
def limit_rows(spark, sf_dir):
    """The ten dearest orders."""
    orders = shapes.table(spark, sf_dir, "orders").orderBy(F.desc("o_totalprice"), "o_orderkey")
    return orders.select("o_orderkey", "o_totalprice").limit(10)


# -- sources and sinks ---------------------------------------------------------------------------


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shapes.table(spark, sf_dir, "documents").select("doc_id", "text", "lang")


@query
def csv_roundtrip_pipe(spark, sf_dir):
    path = working_folder(spark, "pipe")
    writers.write_csv(_documents(spark, sf_dir), path, "|")
    return readers.read_delimited(spark, path).withColumn("doc_id", F.col("doc_id").cast("long"))


@query
def csv_roundtrip_comma(spark, sf_dir):
    """All-text ingest of one pipe and one comma table, read back from the raw database."""
    base = working_folder(spark, "landing")
    writers.write_csv(_documents(spark, sf_dir), f"{base}/documents", "|")
    writers.write_csv(_documents(spark, sf_dir), f"{base}/documents_match", ",")
    database = new_database(spark, "raw")
    tables = {"documents": "|", "documents_match": ",", "absent": "|"}
    ingest_all(spark, base, database, tables)
    both = readers.read_table(spark, database, "documents").withColumn("source_table", F.lit("pipe")).unionByName(
        readers.read_table(spark, database, "documents_match").withColumn("source_table", F.lit("comma"))
    )
    return both.withColumn("doc_id", F.col("doc_id").cast("long"))


@query
def csv_roundtrip_escaped(spark, sf_dir):
    path = working_folder(spark, "escaped")
    writers.write_csv(_documents(spark, sf_dir), path)
    return readers.read_delimited_typed(spark, path, "doc_id bigint, text string, lang string")


@query
def csv_plain(spark, sf_dir):
    path = working_folder(spark, "plain")
    writers.write_csv(shapes.table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment"), path)
    return readers.read_csv_plain(spark, path)


@query
def json_documents_roundtrip(spark, sf_dir):
    path = working_folder(spark, "documents")
    shapes.observation(spark, sf_dir).write.json(path)
    landed = readers.read_json_documents(spark, path, RESOURCES["Observation"], multi_line=False)
    return fhir.project_observation(landed).select("id", "code_text", "effectiveDateTime", "valueQuantity_value", "valueString")


@query
def medication_flow(spark, sf_dir):
    """Medication documents landed to raw, staged, and read from the stage table."""
    base = working_folder(spark, "fhir")
    landed = shapes.medication(spark, sf_dir).write.option("maxRecordsPerFile", writers.LINES_PER_FILE)
    landed.json(f"{base}/Medication", compression="gzip")
    raw, stage = new_database(spark, "raw"), new_database(spark, "stage")
    ingest_resources(spark, base, raw, ["Medication", "Location"], multi_line=False)
    stage_resources(spark, raw, stage, ["medication"])
    return readers.read_table(spark, stage, "medication")


@query
def snapshot_date(spark, sf_dir):
    orders = shapes.table(spark, sf_dir, "orders")
    name = F.when(F.col("o_orderstatus") == "P", F.lit("other.csv")).otherwise(
        F.concat(F.lit("ORDERS_"), F.date_format("o_orderdate", "yyyyMMdd"), F.lit("_0.csv"))
    )
    return orders.select("o_orderkey", readers.snapshot_date(name, "orders").cast("string").alias("timecolumn"))


@query
def snapshot_files(spark, sf_dir):
    """Snapshot dates from the names of the files that the rows are read from, one file a year."""
    parts, landing = working_folder(spark, "years"), working_folder(spark, "snapshots")
    orders = shapes.table(spark, sf_dir, "orders").selectExpr("o_orderkey", "o_orderstatus", "year(o_orderdate) as y")
    orders.repartition("y").write.partitionBy("y").option("header", True).option("sep", "|").csv(parts)
    source = spark._jvm.org.apache.hadoop.fs.Path(parts)
    system = source.getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(spark._jvm.org.apache.hadoop.fs.Path(landing))
    for year in system.listStatus(source):
        if not year.isDirectory():
            continue
        files = [f.getPath() for f in system.listStatus(year.getPath()) if f.getPath().getName().endswith(".csv")]
        for n, file in enumerate(files):
            name = f"ORDERS_{year.getPath().getName()[2:]}0131_{n}.csv"
            system.rename(file, spark._jvm.org.apache.hadoop.fs.Path(f"{landing}/{name}"))
    read = readers.read_delimited_typed(spark, landing, "o_orderkey bigint, o_orderstatus string", "|")
    return readers.with_snapshot_date(read, "orders").withColumn("timecolumn", F.col("timecolumn").cast("string"))


@query
def csv_flow(spark, sf_dir):
    """Delimited tables landed to raw and copied to stage."""
    base = working_folder(spark, "extracts")
    writers.write_csv(shapes.table(spark, sf_dir, "customer").select("c_custkey", "c_name"), f"{base}/client_data", "|")
    writers.write_csv(shapes.table(spark, sf_dir, "supplier").select("s_suppkey", "s_name"), f"{base}/patient_match_hub", ",")
    raw, stage = new_database(spark, "raw"), new_database(spark, "stage")
    ingest_all(spark, base, raw, {"client_data": "|", "patient_match_hub": ","})
    writers.copy_layer(spark, raw, stage, ["client_data", "patient_match_hub"])
    clients = readers.read_table(spark, stage, "client_data").selectExpr("c_custkey as key", "c_name as name")
    return clients.unionByName(readers.read_table(spark, stage, "patient_match_hub").selectExpr("s_suppkey as key", "s_name as name"))


def _write_documents(documents: DataFrame, path: str) -> None:
    """A file of its own for each value of ``file``: a document, or an array of all that have it."""
    grouped = documents.groupBy("file").agg(F.collect_list("document").alias("_all"))
    text = F.when(F.size("_all") == 1, F.to_json(F.get("_all", F.lit(0)))).otherwise(F.to_json("_all"))
    grouped.select("file", text.alias("value")).write.partitionBy("file").text(path)


@query
def raw_document_copy(spark, sf_dir):
    """Fields that no projection names, read back from raw: documents landed one per file, and as arrays."""
    base, raw = working_folder(spark, "whole"), new_database(spark, "raw")
    frames = {
        "Patient": ("customer", "c_nationkey", "struct(concat('p', c_custkey) as id, 'male' as gender, struct(c_name as family) as name)"),
        "Location": ("supplier", "s_nationkey", "struct(concat('l', s_suppkey) as id, s_name as name, array(struct(s_name as family)) as name2)"),
        "PractitionerRole": ("nation", "n_nationkey", "struct(concat('r', n_nationkey) as id, true as active, struct(n_name as family) as name)"),
    }
    for kind, (name, file, document) in frames.items():
        _write_documents(shapes.table(spark, sf_dir, name).selectExpr(f"{file} as file", f"{document} as document"), f"{base}/{kind}")
    ingest_resources(spark, base, raw, list(frames))
    paths = {"Patient": "$.name.family", "Location": "$.name2[0].family", "PractitionerRole": "$.name.family"}
    return reduce(DataFrame.unionByName, [
        readers.read_table(spark, raw, kind.lower()).selectExpr(
            f"'{kind}' as resource", "id", f"variant_get(_document, '{path}', 'string') as family"
        )
        for kind, path in paths.items()
    ])


@query
def landing_increment(spark, sf_dir):
    """Files of two tables that come in two waves, each landed once; a run between the waves and one after find nothing new."""
    base, database = working_folder(spark, "increments"), new_database(spark, "increments")
    customers, orders = (shapes.table(spark, sf_dir, name) for name in ("customer", "orders"))
    waves = [
        {"case_data": customers.select("c_custkey", "c_name"), "patient_match_hub": orders.filter("o_orderstatus = 'F'").select("o_orderkey")},
        {"case_data": customers.select("c_custkey", "c_mktsegment"), "patient_match_hub": orders.filter("o_orderstatus != 'F'").select("o_orderkey")},
    ]
    for number, wave in enumerate(waves):
        for name, rows in wave.items():
            writers.write_csv(rows, f"{base}/{name}/wave={number}", DELIMITED_TABLES[name])
        for _ in range(2):
            ingest_new(spark, base, database)
    cases = batches.read_committed(spark, database, "case_data")
    keys = batches.read_committed(spark, database, "patient_match_hub")
    return cases.withColumn("o_orderkey", F.lit(None).cast("string")).unionByName(keys, allowMissingColumns=True)


@query
def statement_flow(spark, sf_dir):
    """Statements of two databases made wide and appended; the second batch has a key that the first had not."""
    orders = shapes.table(spark, sf_dir, "orders")
    first, second, target = (new_database(spark, name) for name in ("first", "second", "wide"))
    keys = {"F": "named_struct('versionId', cast(o_custkey as string))", "O": "named_struct('versionId', cast(o_custkey as string))"}
    later = "named_struct('versionId', cast(o_custkey as string), 'tag', o_orderpriority)"
    for status, database in (("F", first), ("O", second)):
        batch = orders.filter(F.col("o_orderstatus") == status).selectExpr("o_orderkey as statementid", f"to_json({keys[status]}) as meta")
        writers.replace_table(batch, database, "statements")
    append_statements(spark, [first, second], "statements", target, "statements")
    for status, database in (("P", first), ("X", second)):
        batch = orders.filter(F.col("o_orderstatus") == status).selectExpr("o_orderkey as statementid", f"to_json({later}) as meta")
        writers.replace_table(batch, database, "statements")
    append_statements(spark, [first, second], "statements", target, "statements")
    return spark.table(f"{target}.statements")


@query
def union_databases(spark, sf_dir):
    """One table in two databases, the second without one of the columns."""
    orders = shapes.table(spark, sf_dir, "orders")
    first, second = new_database(spark, "first"), new_database(spark, "second")
    writers.replace_table(orders.filter("o_orderstatus = 'F'").select("o_orderkey", "o_orderstatus", "o_custkey"), first, "t")
    writers.replace_table(orders.filter("o_orderstatus != 'F'").select("o_orderstatus", "o_orderkey"), second, "t")
    return readers.read_from_databases(spark, [first, second], "t")


@query
def table_replace(spark, sf_dir):
    """The second write replaces the first, columns included."""
    orders = shapes.table(spark, sf_dir, "orders")
    database = new_database(spark, "replace")
    writers.replace_table(orders.select("o_orderkey"), database, "t")
    writers.replace_table(orders.select("o_orderkey", "o_orderpriority"), database, "t")
    return readers.read_table(spark, database, "t")


@query
def append_or_create(spark, sf_dir):
    """The second write has a column more and one less, in another order."""
    customers = shapes.table(spark, sf_dir, "customer")
    database = new_database(spark, "append")
    writers.append_or_create(customers.select("c_custkey", "c_name"), database, "t")
    writers.append_or_create(customers.selectExpr("c_mktsegment", "c_custkey as C_CUSTKEY"), database, "t")
    return readers.read_table(spark, database, "t")


@query
def append_rerun(spark, sf_dir):
    """Batches of two tables: one written twice, one that fails between the tables and is run again, and one that is not."""
    orders = shapes.table(spark, sf_dir, "orders")
    database = new_database(spark, "rerun")

    def batch(status: str, failing: bool = False) -> dict[str, DataFrame]:
        own = orders.filter(F.col("o_orderstatus") == status)
        total = F.assert_true(F.lit(False)).cast("double") if failing else F.col("o_totalprice")
        return {"keys": own.select("o_orderkey", "o_custkey"), "totals": own.select("o_orderkey", total.alias("total"))}

    for status, failing in (("F", False), ("F", False), ("O", True), ("O", False), ("P", True)):
        try:
            batches.append_batch(batch(status, failing), database, f"status {status}")
        except Exception:
            if not failing:
                raise
    keys, totals = (batches.read_committed(spark, database, name) for name in ("keys", "totals"))
    return keys.join(totals, "o_orderkey", "full_outer").select("o_orderkey", "o_custkey", "total")


@query
def copy_layer(spark, sf_dir):
    raw, stage = new_database(spark, "raw"), new_database(spark, "stage")
    for name in ("customer", "supplier"):
        writers.replace_table(shapes.table(spark, sf_dir, name), raw, name)
    writers.copy_layer(spark, raw, stage, ["customer", "supplier"])
    customers = readers.read_table(spark, stage, "customer").selectExpr("c_custkey as key", "c_name as name")
    return customers.unionByName(readers.read_table(spark, stage, "supplier").selectExpr("s_suppkey as key", "s_name as name"))


@query
def single_csv(spark, sf_dir):
    path = working_folder(spark, "single")
    writers.write_csv(shapes.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority"), path)
    return readers.read_csv_plain(spark, path)


@query
def annotations_json(spark, sf_dir):
    path = working_folder(spark, "responses")
    writers.write_annotations_json(shapes.responses(spark, sf_dir), path)
    stored = spark.read.schema("row_number long, api_ord int, response_json string, api string").json(path)
    found = F.from_json("response_json", "struct<Entities:array<struct<Id:bigint>>>").getField("Entities")
    return stored.select("row_number", "api", "api_ord", F.size(found).cast("long").alias("n_entities"))


@query
def row_text(spark, sf_dir):
    path = working_folder(spark, "texts")
    numbered = shapes.table(spark, sf_dir, "supplier").selectExpr("s_suppkey", "s_name", "s_suppkey + 1 as _row_number")
    writers.write_row_text(numbered, path)
    return spark.read.parquet(path)


@query
def ddl_insert_select(spark, sf_dir):
    database = new_database(spark, "ddl")
    table = f"{database}.case_data"
    writers.create_table(spark, table, "case_hub_id bigint, case_type_name string")
    writers.insert_values(spark, table, [(-1, "ABC"), (-2, "XYZ")])
    view = f"{database}_view"
    writers.register_view(
        shapes.table(spark, sf_dir, "customer").selectExpr("c_custkey as case_hub_id", "c_mktsegment as case_type_name"), view
    )
    writers.insert_select(spark, table, view, "case_type_name", ["BUILDING", "MACHINERY"])
    return spark.table(table)
