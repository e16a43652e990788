"""Text annotation: calling detectors over a table, and normalising their responses.

A response table has ``row_number, api, api_ord, response_json``, one row per source row and api, as
``annotate`` writes it. The tables made from it read only the parts of the response they need. With a column
``response`` from ``parsed_responses`` instead of the text, nothing is parsed again.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinlake.operators.rows import first_per_key
from clinlake.sources.schemas import ANNOTATION_RESPONSE

# Detector names in the order their findings take precedence.
APIS = ["detect_entities_v2", "detect_phi", "infer_icd10_cm", "infer_rx_norm", "infer_snomed_ct"]

# Rows whose responses a task holds before it hands them on.
ROWS_AT_ONCE = 64

# Items of a response up to which the first of each hash is looked up for every item.
HELD_AGAINST = 64

Detector = Callable[[str], Mapping]


def annotate(
    df: DataFrame,
    key: str,
    text: str,
    detectors: Mapping[str, Callable[[], Detector]],
    keep: Sequence[str] = (),
) -> DataFrame:
    """Call every detector on every non-empty text.

    ``detectors`` maps an api name to a function that opens a client and returns the detector; it runs
    once per task. A failing call gives a row with ``error`` and no response, and the others go on.
    Columns in ``keep`` are repeated on every response of their row.
    """
    names = list(detectors)
    carried = [key, *keep]

    def call(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        clients = [detectors[api]() for api in names]
        for batch in batches:
            for first in range(0, len(batch), ROWS_AT_ONCE):
                rows = batch.iloc[first : first + ROWS_AT_ONCE].reset_index(drop=True)
                results = [_call(detect, row_text) for row_text in rows["_text"] for detect in clients]
                out = rows.loc[rows.index.repeat(len(clients)), carried].reset_index(drop=True)
                out["api"] = names * len(rows)
                out["api_ord"] = list(range(len(names))) * len(rows)
                out["response_json"] = [response for response, _ in results]
                out["error"] = [error for _, error in results]
                yield out

    kept_types = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in carried)
    source = df.filter(F.col(text) != "").select(*carried, F.col(text).alias("_text"))
    return source.mapInPandas(call, f"{kept_types}, api string, api_ord int, response_json string, error string")


def _call(detect: Detector, text: str) -> tuple[str | None, str | None]:
    try:
        return json.dumps(detect(text)), None
    except Exception as e:
        return None, f"{type(e).__name__}: {e}"


def detected_entities(df: DataFrame, key: str, text: str, detector: Callable[[], Detector]) -> DataFrame:
    """Key, text, the array of entity texts found in it, and the error of a failed call; rows with empty text are left out."""
    responses = annotate(df, key, text, {"detect": detector}, keep=[text])
    found = F.from_json("response_json", "struct<Entities:array<struct<Text:string>>>").getField("Entities")
    return responses.select(key, text, found.getField("Text").alias("detected_entities"), "error")


def parsed_responses(responses: DataFrame) -> DataFrame:
    """The response table with its text parsed, as column ``response``."""
    parsed = F.from_json("response_json", ANNOTATION_RESPONSE).alias("response")
    return responses.select(*[c for c in responses.columns if c != "response_json"], parsed)


def failures(responses: DataFrame) -> DataFrame:
    """row_number, api, api_ord and error of the calls that failed."""
    return responses.filter(F.col("error").isNotNull()).select("row_number", "api", "api_ord", "error")


def _entities(responses: DataFrame, fields: str) -> Column:
    """The response's entities, with at least the given fields."""
    if "response" in responses.columns:
        return F.col("response.Entities")
    return F.from_json("response_json", f"struct<Entities:array<struct<{fields}>>>").getField("Entities")


def _rest(responses: DataFrame) -> list[str]:
    return [c for c in responses.columns if c not in ("response_json", "response")]


def _with_rows(found: DataFrame, rows: DataFrame | None) -> DataFrame:
    """``found`` with its source rows, if any; what a table needs of a response is joined rather than the response."""
    return found if rows is None else attach_row_metadata(found, rows)


def _repeats(key: Mapping[str, str]) -> str:
    """SQL for an array with, by place in ``_items``, whether an item is the first of its key; NULL where no key repeats.

    Keys that differ in their hash differ, so most responses are settled by their hashes. Of the others each item is held
    against the first one of its hash, and all are sorted by key where there are very many, or two keys of one hash.
    """
    keys = ", ".join(f"{value.format('x')}" for value in key.values())
    named = ", ".join(f"'{name}', {value.format('x')}" for name, value in key.items())
    placed = f"sort_array(transform(_items, (x, i) -> named_struct('key', named_struct({named}), 'place', i)))"
    first = "transform(s, (x, i) -> named_struct('place', x.place, 'first', not (get(s, i - 1).key <=> x.key)))"
    by_key = f"get(transform(array({placed}), s -> transform(sort_array({first}), x -> x.first)), 0)"
    place = "int(array_position(h, get(h, i)) - 1)"
    same = " and ".join(f"{value.format('y')} <=> {value.format('x')}" for value in key.values())
    flag = f"case when {place} = i then true when exists(array(get(_items, {place})), y -> {same}) then false end"
    by_hash = f"get(transform(array(transform(_items, (x, i) -> {flag})), f -> case when forall(f, v -> v is not null) then f end), 0)"
    return (
        f"get(transform(array(transform(_items, x -> xxhash64({keys}))), h -> case when cardinality(array_distinct(h)) < cardinality(h) "
        f"then coalesce(case when cardinality(h) <= {HELD_AGAINST} then {by_hash} end, {by_key}) end), 0)"
    )


def _items(
    responses: DataFrame,
    fields: str,
    items: str,
    key: Mapping[str, str],
    values: Mapping[str, str],
    scope: str,
    rows: DataFrame | None = None,
) -> DataFrame:
    """One row per item of the responses' ``Entities``, the first of each key only.

    ``fields`` are the entity fields to parse, ``items`` makes an array of items of them, in order. ``key`` and ``values``
    are the columns of an item, as SQL in which ``{}`` stands for it. With ``scope="api"`` a key counts within one response and
    repeats are found inside the row; with ``scope="row"`` it counts over all responses of a source row, which takes a shuffle.
    """
    if scope not in ("api", "row"):
        raise ValueError(f"scope must be 'api' or 'row', not {scope!r}")
    rest = _rest(responses)
    parsed = _entities(responses, fields)
    found = responses.select(*rest, parsed.alias("_found")).select(*rest, F.expr(items).alias("_items"))
    if scope == "api":
        found = found.select("*", F.expr(_repeats(key)).alias("_first"))
    found = _with_rows(found, rows)
    rest = [c for c in found.columns if c not in ("_items", "_first")]
    own = [c for c in found.columns if c != "_items"]
    # The outer form keeps the optimizer from computing items twice.
    each = found.select(*own, F.posexplode_outer("_items").alias("_place", "_item")).filter("_place is not null")
    columns = [F.expr(value.format("_item")).alias(name) for name, value in (key | values).items()]
    if scope == "api":
        return each.filter("coalesce(get(_first, _place), true)").select(*rest, *columns)
    placed = each.select(*rest, *columns, F.col("_place").alias("place"))
    return first_per_key(placed, ["row_number", *key], ["api_ord", "place"]).drop("place")


def entities(responses: DataFrame, scope: str = "api", rows: DataFrame | None = None) -> DataFrame:
    """One row per entity; the first of a repeated Id stays."""
    rest = ["Text", "Category", "Type", "Score", "BeginOffset", "EndOffset"]
    # Of whole fields, which is compiled; only these are read of a parsed response.
    items = "arrays_zip(" + ", ".join(f"_found.{c}" for c in ["Id", *rest]) + ")"
    fields = "Id:bigint,Text:string,Category:string,Type:string,Score:double,BeginOffset:bigint,EndOffset:bigint"
    return _items(responses, fields, items, {"Id": "{}.Id"}, {c: f"{{}}.{c}" for c in rest}, scope, rows)


def _parts(field: str) -> str:
    """SQL for the items of all entities' ``field``, as array<struct<id, part>>."""
    each = f"transform(coalesce(e.{field}, array()), p -> named_struct('id', e.Id, 'part', p))"
    return f"flatten(transform(_found, e -> {each}))"


def traits(responses: DataFrame, scope: str = "api", rows: DataFrame | None = None) -> DataFrame:
    """One row per trait of an entity; the first of a repeated (EntityId, TraitName, TraitScore) stays."""
    fields = "Id:bigint,Traits:array<struct<Name:string,Score:double>>"
    key = {"EntityId": "{}.id", "TraitName": "{}.part.Name", "TraitScore": "{}.part.Score"}
    return _items(responses, fields, _parts("Traits"), key, {}, scope, rows)


def attributes(responses: DataFrame, scope: str = "api", rows: DataFrame | None = None) -> DataFrame:
    """One row per attribute of an entity; category and relationship are ``''`` when they are absent.

    The first of a repeated (EntityId, AttributeId, AttributeText) stays.
    """
    # The score is kept as text because an absent one is ''.
    fields = (
        "Id:bigint,Attributes:array<struct<Id:bigint,Text:string,Category:string,Type:string,Score:double,"
        "RelationshipScore:string,RelationshipType:string,BeginOffset:bigint,EndOffset:bigint>>"
    )
    key = {"EntityId": "{}.id", "AttributeId": "{}.part.Id", "AttributeText": "{}.part.Text"}
    values = {
        "AttributeCategory": "coalesce({}.part.Category, '')",
        "AttributeType": "{}.part.Type",
        "Score": "{}.part.Score",
        "RelationshipScore": "coalesce({}.part.RelationshipScore, '')",
        "RelationshipType": "coalesce({}.part.RelationshipType, '')",
        "BeginOffset": "{}.part.BeginOffset",
        "EndOffset": "{}.part.EndOffset",
    }
    return _items(responses, fields, _parts("Attributes"), key, values, scope, rows)


def _scored_concepts(responses: DataFrame, api: str, field: str, prefix: str, rows: DataFrame | None = None) -> DataFrame:
    """Concepts of one api, one row each, repeats kept."""
    fields = f"Id:bigint,{field}:array<struct<Code:string,Description:string,Score:double>>"
    parsed = _entities(responses, fields)
    own = responses.filter(F.col("api") == api).select(*_rest(responses), parsed.alias("_entities"))
    found = _with_rows(own, rows)
    rest = [c for c in found.columns if c != "_entities"]
    return (
        found.select(*rest, F.explode_outer("_entities").alias("_entity"))
        .select(*rest, F.col("_entity.Id").alias("EntityId"), F.explode(f"_entity.{field}").alias("_concept"))
        .select(
            *rest,
            "EntityId",
            F.col("_concept.Code").alias(f"{prefix}Code"),
            F.col("_concept.Description").alias(f"{prefix}Description"),
            F.col("_concept.Score").alias(f"{prefix}Score"),
        )
    )


def icd10_concepts(responses: DataFrame, rows: DataFrame | None = None) -> DataFrame:
    return _scored_concepts(responses, "infer_icd10_cm", "ICD10CMConcepts", "ICD", rows)


def snomed_concepts(responses: DataFrame, rows: DataFrame | None = None) -> DataFrame:
    return _scored_concepts(responses, "infer_snomed_ct", "SNOMEDCTConcepts", "SNOMED", rows)


def rxnorm_concepts(responses: DataFrame, rows: DataFrame | None = None) -> DataFrame:
    return _scored_concepts(responses, "infer_rx_norm", "RxNormConcepts", "RxNorm", rows)


def attach_row_metadata(annotations: DataFrame, rows: DataFrame, on: str = "row_number") -> DataFrame:
    """Add the source row's columns to its annotations; annotations without a source row are dropped.

    Join responses, or what is taken from each, rather than the tables made from them: there are at most a
    handful per row, so no key is hot. The tables' functions take the rows for that, and then join only what they
    have taken from a response. The rows are hashed, as the narrow side: responses, which are wide, are not sorted.
    """
    return annotations.join(rows.hint("shuffle_hash"), on, "inner")


# Output table of each operator, in the order they are written.
ANNOTATION_TABLES: dict[str, Callable[[DataFrame], DataFrame]] = {
    "entities": entities,
    "traits": traits,
    "attributes": attributes,
    "icd_concepts": icd10_concepts,
    "snomed_concepts": snomed_concepts,
    "rxnorm_concepts": rxnorm_concepts,
}

# Tables whose rows are de-duplicated, and so take a scope.
SCOPED_TABLES = {"entities", "traits", "attributes"}
