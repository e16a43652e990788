"""Oracle SQL: the same results from the flat driver tables, without nested values, JSON or patterns
wherever the table holds the answer directly."""

from __future__ import annotations

STAMP = "'%Y-%m-%d %H:%M:%S'"

# Concept columns of coding number {i} of an order, as the medication shape gives them.
_CONCEPT = [
    ("id", "o_custkey + {i}"),
    ("code", "'c' || (o_custkey + {i})"),
    ("name", "'name ' || (o_custkey + {i})"),
    ("vocabulary_id", "'RxNorm'"),
    ("standard", "CASE WHEN o_orderstatus <> 'P' THEN 'S' END"),
    ("{cancer}", "(o_custkey + {i}) % 2 = 0"),
    ("domain", "'Drug'"),
    ("class", "'k' || ((o_custkey + {i}) % 10)"),
]


def _concept(i: str, present: str, prefix: str = "", cancer: str = "cancer") -> str:
    return ", ".join(
        f"CASE WHEN {present} THEN {value.format(i=i)} END AS {prefix}{name.format(cancer=cancer)}"
        for name, value in _CONCEPT
    )


_FULL = "classification_cancer"
_CODES = "orders, (VALUES (1), (2), (3)) n(i) WHERE i <= o_orderkey % 4"
_INGREDIENTS = "orders, (VALUES (1), (2), (3), (4)) n(j) WHERE j <= o_custkey % 5"
_INGREDIENT_TEXT = "CASE WHEN j < 4 THEN 'ingredient ' || o_custkey || '-' || j END"
_FIRST_INGREDIENT_TEXT = "CASE WHEN o_custkey % 5 > 0 THEN 'ingredient ' || o_custkey || '-1' END"

# Entities of the response shape: order, api and entity number.
_APIS = (
    "(VALUES (0, 'detect_entities_v2'), (1, 'detect_phi'), (2, 'infer_icd10_cm'), (3, 'infer_rx_norm'), "
    "(4, 'infer_snomed_ct')) a(api_ord, api)"
)
_ENTITY = f"orders, {_APIS}, (VALUES (0), (1), (2), (3)) e(k) WHERE k < o_custkey % 5"
_ROW = (
    "o_orderkey AS row_number, api, api_ord, o_custkey AS case_hub_id, o_orderpriority AS case_type_name"
)


def _scored(api_ord: int, code: str, prefix: str) -> str:
    return f"""
        SELECT {_ROW}, CAST(k % 3 AS BIGINT) AS EntityId,
               CASE c WHEN 1 THEN '{code}' || o_custkey || '-' || k ELSE '{code}' END AS {prefix}Code,
               CASE c WHEN 1 THEN o_orderpriority || ' ' || k ELSE 'second' END AS {prefix}Description,
               CAST(CASE c WHEN 1 THEN 0.25 ELSE 0.125 END AS DOUBLE) AS {prefix}Score
        FROM (SELECT * FROM {_ENTITY}) x, (VALUES (1), (2)) n(c) WHERE api_ord = {api_ord}"""


_TRAITS = f"""
    SELECT *, row_number() OVER (PARTITION BY row_number, api, EntityId, TraitName, TraitScore ORDER BY api_ord, k, t) AS rn_api,
           row_number() OVER (PARTITION BY row_number, EntityId, TraitName, TraitScore ORDER BY api_ord, k, t) AS rn_row
    FROM (SELECT {_ROW}, k, t, CAST(k % 3 AS BIGINT) AS EntityId,
                 CASE WHEN t = 1 THEN 'SIGN' ELSE 'NEGATION' END AS TraitName,
                 CAST(CASE WHEN t = 1 THEN k / 4.0 ELSE 0.5 END AS DOUBLE) AS TraitScore
          FROM (SELECT * FROM {_ENTITY}) x, (VALUES (0), (1), (2)) n(t) WHERE k <> 1)"""
_ENTITIES = f"""
    SELECT {_ROW}, CAST(k % 3 AS BIGINT) AS Id, o_orderpriority || ' ' || k AS Text, o_orderstatus AS Category,
           't' || api_ord AS Type, CAST((k + api_ord) / 8.0 AS DOUBLE) AS Score,
           CAST(k * 10 AS BIGINT) AS BeginOffset, CAST(k * 10 + 5 AS BIGINT) AS EndOffset,
           row_number() OVER (PARTITION BY o_orderkey, api, k % 3 ORDER BY k) AS rn_api,
           row_number() OVER (PARTITION BY o_orderkey, k % 3 ORDER BY api_ord, k) AS rn_row
    FROM {_ENTITY}"""
_ATTRIBUTES = f"""
    SELECT {_ROW}, CAST(k % 3 AS BIGINT) AS EntityId,
           CAST(CASE WHEN t = 0 THEN k ELSE k % 2 END AS BIGINT) AS AttributeId,
           CASE WHEN t = 0 THEN 'dose' ELSE 'route' END AS AttributeText,
           CASE WHEN t = 0 THEN 'MED' ELSE '' END AS AttributeCategory,
           CASE WHEN t = 0 THEN 'DOSAGE' ELSE o_orderstatus END AS AttributeType,
           CAST(CASE WHEN t = 0 THEN 0.5 ELSE 0.25 END AS DOUBLE) AS Score,
           CASE WHEN t = 0 THEN '0.75' ELSE '' END AS RelationshipScore,
           CASE WHEN t = 0 THEN 'DOSAGE' ELSE '' END AS RelationshipType,
           CAST(k AS BIGINT) AS BeginOffset, CAST(k + 1 + t AS BIGINT) AS EndOffset,
           row_number() OVER (PARTITION BY o_orderkey, api, k % 3, CASE WHEN t = 0 THEN k ELSE k % 2 END, t ORDER BY k) AS rn
    FROM (SELECT * FROM {_ENTITY}) x, (VALUES (0), (1)) n(t)"""

_NESTED_LEAVES = [
    ("meta", "meta_source", "event_type"),
    ("meta", "meta_lastUpdated", f"strftime(ts, {STAMP})"),
    ("meta", "meta_tag_0_code", "event_type"),
    ("meta", "meta_tag_0_user", "CAST(user_id AS VARCHAR)"),
    ("meta", "meta_tag_1_code", "'T'"),
    ("meta", "meta_by_Patient", "CAST(user_id AS VARCHAR)"),
    ("meta", "meta_a_b_c_d", "CAST(event_id AS VARCHAR)"),
    ("meta", "meta_extension_url_kind", "event_type"),
    ("meta", "meta_extension_url_seq", "CAST(event_id AS VARCHAR)"),
    ("meta", "meta_flags_0", "CASE WHEN user_id % 2 = 0 THEN 'true' ELSE 'false' END"),
    ("meta", "meta_flags_1", "'true'"),
    ("identifier", "identifier_0_system", "event_type"),
    ("identifier", "identifier_0_value", "CAST(event_id AS VARCHAR)"),
    ("identifier", "identifier_0_empty", "''"),
    ("identifier", "identifier_0_none", "CAST(NULL AS VARCHAR)"),
]
_HAS_IDENTIFIER = "user_id % 4 <> 0"

_DOSAGE = [
    # column, key=value form, JSON form, form with nulls
    ("patient_instruction", "'with food ' || l_suppkey", "'with food ' || l_suppkey", "'q'"),
    ("text_extracted", "'Take ' || l_linenumber || ' mg'", "'Take ' || l_linenumber", "NULL"),
    ("route_display", "'Oral ' || l_linestatus", "'Oral ' || l_linestatus", "NULL"),
    ("route_code", "CAST(l_partkey AS VARCHAR)", "NULL", "NULL"),
    ("route_system", "'snomed'", "NULL", "NULL"),
    ("dose_value", "l_suppkey || '.5'", "l_suppkey || '.25'", "CAST(l_linenumber AS VARCHAR)"),
    ("dose_unit", "'mg'", "'ml'", "NULL"),
    ("timing_period", "CAST(l_suppkey AS VARCHAR)", "CAST(l_suppkey AS VARCHAR)", "NULL"),
    ("timing_period_unit", "l_returnflag", "'d'", "NULL"),
    ("additional_instruction_text", "'note ' || l_partkey", "'Take ' || l_linenumber", "NULL"),
    ("additional_instruction_display", "'see ' || l_orderkey", "NULL", "NULL"),
    ("timing_frequency", "CAST(l_linenumber AS VARCHAR)", "CAST(l_linenumber AS VARCHAR)", "NULL"),
    ("as_needed", "CASE WHEN l_linestatus = 'F' THEN 'false' END", "'true'", "NULL"),
]

_ORDER_STAMP = f"strftime(o_orderdate, {STAMP})"
_STATEMENT = {
    "id": "'st-' || o_orderkey",
    "status": "CASE WHEN o_orderstatus = 'F' THEN 'completed' END",
    "effectivedatetime": _ORDER_STAMP,
    "effectivedatetime_normalized": _ORDER_STAMP,
    "dateasserted": f"CASE WHEN o_custkey % 3 <> 0 THEN {_ORDER_STAMP} END",
    "dateasserted_normalized": f"CASE WHEN o_custkey % 3 <> 0 THEN {_ORDER_STAMP} END",
    "meta_source": "o_orderpriority",
    "meta_lastupdated": _ORDER_STAMP,
    "text_div_cleaned": "'Take ' || o_orderkey",
    "extension_url_documentid": "'d' || o_orderkey",
    "extension_url_rank": "CAST(o_custkey AS VARCHAR)",
    "identifier_0_system": "'s'",
    "identifier_0_value": "CAST(o_orderkey AS VARCHAR)",
    "medicationcodeableconcept_coding_0_code": "CAST(o_custkey AS VARCHAR)",
    "medicationcodeableconcept_coding_1_code": "'x'",
    "medicationcodeableconcept_extension_url_id": "CAST(o_orderkey AS VARCHAR)",
    "medicationcodeableconcept_text": "CAST(NULL AS VARCHAR)",
    "medicationreference_display": "CAST(NULL AS VARCHAR)",
    "medicationid": "CAST(o_orderkey AS VARCHAR)",
    "patientid": "CAST(o_custkey AS VARCHAR)",
    "practitionerid": "CASE WHEN o_custkey % 2 = 0 THEN CAST(o_custkey AS VARCHAR) END",
    "context_r_encounter": "CAST(o_orderkey AS VARCHAR)",
    "effectiveperiod_start": _ORDER_STAMP,
    "effectiveperiod_end": "'open'",
    "derivedfrom_value": "CASE WHEN o_custkey % 4 = 3 THEN CAST(o_custkey AS VARCHAR) END",
    "reasoncode_0_code": "CAST(o_custkey AS VARCHAR)",
    "reasoncode_0_display": "'due ' || o_orderkey",
    **{f"reasoncode_{c}": "CAST(NULL AS VARCHAR)" for c in (
        "omop_concept_id", "omop_code", "omop_name", "omop_vocabulary", "omop_domain", "omop_class",
        "cancer_classification", "text_main",
    )},
    "reasoncode_code_main": "CAST(o_custkey AS VARCHAR)",
    "reasoncode_display_main": "'due ' || o_orderkey",
    "reasonreference_0_reference": "'Condition/' || o_orderkey",
    "note_0_text": "'note ' || o_orderkey",
    "note_0_n_0": "'1'",
    "note_0_n_1_0": "'true'",
    "note_0_n_1_1_deep": "CAST(o_custkey AS VARCHAR)",
    **{f"dosage_{c}": "CAST(NULL AS VARCHAR)" for c in (
        "patient_instruction", "route_display", "route_code", "route_system", "timing_period",
        "timing_period_unit", "additional_instruction_text", "additional_instruction_display",
        "timing_frequency", "as_needed",
    )},
    "dosage_text_extracted": "'Take ' || (o_custkey % 9) || ' mg'",
    "dosage_dose_value": "o_custkey || '.5'",
    "dosage_dose_unit": "'mg'",
}

ORACLES: dict[str, str] = {
    # -- nested resources
    "medication_concepts": f"""
        SELECT 'med-' || o_orderkey AS main_id, 'code' AS source_type, 'sys-' || i AS system,
               CAST(o_custkey + i AS VARCHAR) AS item_code, o_orderstatus || '-' || i AS display,
               {_concept('i', 'i < 3')}
        FROM {_CODES}
        UNION ALL
        SELECT 'med-' || o_orderkey, 'ingredient', CASE WHEN j < 3 THEN 'sys-' || j END,
               CASE WHEN j < 3 THEN CAST(o_custkey + j AS VARCHAR) END, {_INGREDIENT_TEXT},
               {_concept('j', 'j < 3')}
        FROM {_INGREDIENTS}""",
    "medication_flat": f"""
        SELECT 'med-' || o_orderkey AS id, o_orderpriority AS code_text,
               CASE WHEN o_orderkey % 4 > 0 THEN 'sys-1' END AS first_coding_system,
               CASE WHEN o_orderkey % 4 > 0 THEN CAST(o_custkey + 1 AS VARCHAR) END AS first_coding_code,
               CASE WHEN o_orderkey % 4 > 0 THEN o_orderstatus || '-1' END AS first_coding_display,
               {_FIRST_INGREDIENT_TEXT} AS ingredient_text,
               CASE WHEN o_custkey % 5 > 0 THEN CAST(o_custkey + 1 AS VARCHAR) END AS ingredient_coding_code,
               CASE WHEN o_custkey % 5 > 0 THEN o_orderstatus || '-1' END AS ingredient_coding_display,
               CASE o_custkey % 5 WHEN 0 THEN '' WHEN 1 THEN concat_ws('|', o_custkey + 1, o_custkey + 2)
                    ELSE concat_ws('|', o_custkey + 1, o_custkey + 2, o_custkey + 2, o_custkey + 3) END
                    AS ingredient_coding_codes,
               coalesce((SELECT string_agg(coalesce({_INGREDIENT_TEXT}, 'NULL'), '|' ORDER BY j)
                         FROM (VALUES (1), (2), (3), (4)) n(j) WHERE j <= o_custkey % 5), '') AS ingredient_texts
        FROM orders""",
    "concepts_first_coding": f"""
        SELECT 'med-' || o_orderkey AS id, {_concept('1', 'o_orderkey % 4 > 0', 'normalized_concept_', _FULL)}
        FROM orders""",
    "concepts_first_ingredient": f"""
        SELECT 'med-' || o_orderkey AS id, {_FIRST_INGREDIENT_TEXT} AS ingredient_name,
               {_concept('1', 'o_custkey % 5 > 0', 'ingredient_concept_', _FULL)}
        FROM orders""",
    "concepts_first_combined": f"""
        SELECT 'med-' || o_orderkey AS id, {_concept('1', 'o_orderkey % 4 > 0', 'medication_concept_', _FULL)},
               {_FIRST_INGREDIENT_TEXT} AS ingredient_name,
               {_concept('1', 'o_custkey % 5 > 0', 'ingredient_concept_', _FULL)}
        FROM orders""",
    "coding_concepts_standard": f"""
        SELECT 'med-' || o_orderkey AS id, 'sys-' || i AS coding_system, CAST(o_custkey + i AS VARCHAR) AS coding_code,
               o_orderstatus || '-' || i AS coding_display, {_concept('i', 'i < 3', 'normalized_concept_', _FULL)}
        FROM {_CODES} AND i < 3 AND o_orderstatus <> 'P'""",
    "ingredient_concepts": f"""
        SELECT 'med-' || o_orderkey AS id, {_INGREDIENT_TEXT} AS ingredient_name,
               {_concept('j', 'j < 3', 'ingredient_concept_', _FULL)}
        FROM {_INGREDIENTS}""",
    "explode_items": f"""
        SELECT 'med-' || o_orderkey AS id, {_INGREDIENT_TEXT} AS ingredient_text FROM {_INGREDIENTS}
        UNION ALL SELECT 'med-' || o_orderkey, NULL FROM orders WHERE o_custkey % 5 = 0""",
    "project_condition": """
        SELECT 'cond-' || o_orderkey AS id, o_orderpriority AS code_text, o_orderstatus AS clinical_status_text,
               'clerk-' || (o_custkey % 100) AS meta_source, 'Patient/' || o_custkey AS subject_reference
        FROM orders""",
    "project_observation": """
        SELECT 'obs-' || event_id AS id, event_type || '|laboratory' AS category_text, 'test ' || event_type AS code_text,
               strftime(ts, '%Y-%m-%dT%H:%M:%S') AS "effectiveDateTime",
               CASE WHEN user_id % 3 > 0 THEN 'Encounter/' || user_id END AS encounter_reference,
               'lab|site' AS identifier_system, event_id || '|' || user_id AS identifier_value,
               'generated' AS text_status, event_type || '|N|H' AS interpretation_coding,
               'Patient/' || user_id AS subject_reference, 'mg' AS "valueQuantity_code", 'ucum' AS "valueQuantity_system",
               'mg/L' AS "valueQuantity_unit", value AS "valueQuantity_value",
               CASE WHEN event_type = 'error' THEN 'invalid' END AS "valueString"
        FROM events""",
    "project_procedure": """
        SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS id, 'procedure ' || l_partkey AS code_text,
               'Encounter/' || l_orderkey AS encounter_reference, l_returnflag || '|line' AS category_coding_code,
               l_linestatus || '|' || l_linenumber AS category_coding_display, CAST(l_suppkey AS VARCHAR) AS identifier_value,
               'Patient/' || l_suppkey AS subject_reference, 'additional' AS text_status
        FROM lineitem""",
    "project_patient": """
        SELECT 'pat-' || c_custkey AS id,
               CASE WHEN c_mktsegment = 'BUILDING' THEN NULL WHEN c_custkey % 2 = 0 THEN 'female' ELSE 'male' END AS gender
        FROM customer""",
    "project_practitioner": """
        SELECT 'prac-' || s_suppkey AS id, 'city ' || s_nationkey || '1|city ' || s_nationkey || '2' AS address_city,
               'nation ' || s_nationkey || '|nation ' || s_nationkey AS country, 'd1|d2' AS district,
               s_name || '|floor 1|' || s_name || '|floor 2' AS line, s_suppkey || '|' || s_suppkey AS "postalCode",
               's1|s2' AS state, 'work|work' AS use, s_name AS name_family, 'MD|PhD' AS name_suffix,
               'official' AS name_use, '555-' || s_suppkey AS phone_number
        FROM supplier""",
    "project_encounter": """
        SELECT 'enc-' || conv_id || '-' || turn AS id, role AS display,
               'Condition/' || conv_id AS diagnosis_condition_reference, 'home' AS discharge_disposition_text,
               'desk' AS identifier_assigner_display, 'v' || turn AS identifier_value,
               'Location/' || turn AS location_location_reference, 'chat' AS meta_source,
               'Practitioner/' || role || '|Practitioner/' || conv_id AS participant_individual_reference,
               't' || turn AS period_start, 't' || (turn + 1) AS period_end, 'Encounter' AS resource_type,
               CASE WHEN turn = 0 THEN 'planned' ELSE 'finished' END AS status, 'Patient/' || conv_id AS subject_reference,
               'generated' AS text_status, text AS type_text
        FROM conversations""",
    "stage_dispatch": """
        SELECT 'pat-' || c_custkey AS id,
               CASE WHEN c_mktsegment = 'BUILDING' THEN NULL WHEN c_custkey % 2 = 0 THEN 'female' ELSE 'male' END AS gender
        FROM customer""",
    # -- text
    "timestamp_normalize": f"""
        SELECT event_id, e AS effectivedatetime, e AS effectivedatetime_normalized, d AS dateasserted, d AS dateasserted_normalized
        FROM (SELECT event_id,
                     CASE WHEN event_id % 5 < 4 THEN strftime(ts, {STAMP}) ELSE 'Take 2.5 mg TABLET at ' || event_id END AS e,
                     CASE WHEN user_id % 7 > 2 THEN strftime(ts, {STAMP}) END AS d
              FROM events)""",
    "reference_parse": """
        SELECT event_id, CASE event_id % 5 WHEN 0 THEN 'Patient' WHEN 1 THEN 'Medication' END AS ref_type,
               CASE event_id % 5 WHEN 0 THEN CAST(user_id AS VARCHAR) WHEN 1 THEN event_id || '/x' END AS ref_id
        FROM events""",
    "reference_ids": """
        SELECT event_id, CAST(event_id AS VARCHAR) AS medicationid,
               CASE WHEN user_id % 2 = 0 THEN CAST(user_id AS VARCHAR) END AS patientid, event_type AS practitionerid
        FROM events""",
    "urn_key_value": """
        SELECT event_id, CASE WHEN user_id % 3 <> 0 THEN 'doc_' || event_type END AS key,
               CASE WHEN user_id % 3 <> 0 THEN CAST(event_id AS VARCHAR) END AS value
        FROM events""",
    "concept_fields_from_text": """
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
               CAST(l_partkey AS VARCHAR) AS reasoncode_omop_concept_id, 'C' || l_suppkey AS reasoncode_omop_code,
               'part ' || l_partkey AS reasoncode_omop_name, 'SNOMED' AS reasoncode_omop_vocabulary,
               l_returnflag AS reasoncode_omop_domain, l_linestatus AS reasoncode_omop_class,
               CASE WHEN l_linenumber % 2 = 0 THEN 'true' ELSE 'false' END AS reasoncode_cancer_classification,
               CAST(l_orderkey AS VARCHAR) AS reasoncode_code_main, 'part ' || l_partkey AS reasoncode_display_main,
               CASE WHEN l_returnflag = 'A' THEN 'reason ' || l_suppkey END AS reasoncode_text_main
        FROM lineitem""",
    "dosage_fields_from_text": "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, " + ", ".join(
        f"CASE l_partkey % 3 WHEN 0 THEN {pairs} WHEN 1 THEN {json} ELSE {nulls} END AS dosage_{name}"
        for name, pairs, json, nulls in _DOSAGE
    ) + " FROM lineitem",
    "div_text": r"""
        SELECT page_id, CASE WHEN regexp_matches(html, '<div[^>]*>(.*?)</div>') THEN
               trim(regexp_replace(regexp_extract(html, '<div[^>]*>(.*?)</div>', 1), '<[^>]+>', '', 'g'), e' \t\r\n') END
               AS text_div_cleaned
        FROM (SELECT page_id, replace(html, '<div', 'div=<div') AS marked, html FROM pages)""",
    "null_tokens": """
        SELECT c_custkey, CASE WHEN c_custkey % 4 = 3 THEN c_name END AS c_name,
               CASE WHEN c_nationkey <> 3 THEN c_mktsegment END AS c_mktsegment, c_acctbal
        FROM customer""",
    "lowercase_columns": """
        SELECT o_orderkey AS orderkey, o_custkey AS orderkey_2, o_orderstatus AS o_status FROM orders""",
    # -- JSON
    "json_parse_lenient": """
        SELECT event_id, CASE WHEN event_id % 5 < 3 THEN CAST(event_id AS VARCHAR) END AS doc_id,
               CASE WHEN event_id % 5 < 3 THEN event_type END AS doc_kind,
               CASE WHEN event_id % 5 < 3 THEN CAST(user_id AS VARCHAR) END AS doc_user
        FROM events""",
    "json_flatten_long": " UNION ALL ".join(
        f"SELECT event_id, '{column}' AS \"column\", '{path}' AS path, {value} AS value FROM events"
        + (f" WHERE {_HAS_IDENTIFIER}" if column == "identifier" else "")
        for column, path, value in _NESTED_LEAVES
    ),
    "json_nested_key_value": " UNION ALL ".join(
        f"SELECT o_orderkey, 'dosage' AS \"column\", '{path}' AS path, {value} AS value FROM orders WHERE o_orderkey % 4 {form}"
        for form, path, value in [
            ("= 0", "dosage_text", "'Take ' || o_custkey"),
            ("= 0", "dosage_unit", "o_orderstatus"),
            ("= 1", "dosage_text", "'a=b, {c=' || o_custkey || '}'"),
            ("= 1", "dosage_n", "CAST(o_orderkey AS VARCHAR)"),
            ("> 1", "dosage_0_text", "'Take ' || o_custkey || ' mg, then rest = more'"),
            ("> 1", "dosage_0_route_code", "CAST(o_custkey AS VARCHAR)"),
            ("> 1", "dosage_0_route_display", "'Oral, by \"' || o_orderstatus || '\"'"),
            ("> 1", "dosage_0_timing_repeat_bounds_start", "strftime(o_orderdate, '%Y-%m-%d')"),
            ("> 1", "dosage_0_note_0", "o_orderpriority"),
            ("> 1", "dosage_0_note_1_0", "o_orderstatus"),
            ("> 1", "dosage_0_note_1_1_deep", "'yes'"),
            ("> 1", "dosage_0_asNeeded", "'null'"),
            ("> 1", "dosage_1_text", "''"),
            ("> 1", "dosage_extension_url_rank", "CAST(o_orderkey AS VARCHAR)"),
        ]
    ),
    "json_flatten_map": " UNION ALL ".join(
        f"SELECT event_id, '{column}' AS \"column\", '{path}' AS path, {value} AS value FROM events"
        + (f" WHERE {_HAS_IDENTIFIER}" if column == "identifier" else "")
        for column, path, value in _NESTED_LEAVES
    ),
    "json_discover_keys": " UNION ALL ".join(
        f"SELECT '{column}' AS \"column\", '{path}' AS path" for column, path, _ in _NESTED_LEAVES
    ),
    "json_flatten_wide": "SELECT event_id, " + ", ".join(
        (f"CASE WHEN {_HAS_IDENTIFIER} THEN {value} END" if column == "identifier" else value) + f' AS "{path}"'
        for column, path, value in _NESTED_LEAVES
    ) + " FROM events",
    "json_common_fields": """
        SELECT event_id, CAST(event_id AS VARCHAR) AS doc_id, CASE WHEN event_id % 3 > 0 THEN event_type END AS doc_status,
               CASE WHEN event_id % 3 > 0 THEN '{"k":' || user_id || '}' END AS doc_text,
               CAST(NULL AS VARCHAR) AS "doc_resourceType", CAST(NULL AS VARCHAR) AS doc_value,
               CAST(NULL AS VARCHAR) AS doc_display, CAST(NULL AS VARCHAR) AS doc_code
        FROM events""",
    "json_clean_text": """
        SELECT event_id, CASE WHEN event_id % 5 IN (0, 1) THEN d WHEN event_id % 5 = 3 THEN d || ' junk'
               WHEN event_id % 5 = 2 THEN '{id=' || event_id || ', kind=' || event_type || ', user=' || user_id || '}'
               ELSE '{' || event_type END AS cleaned
        FROM (SELECT *, '{"id":' || event_id || ',"kind":"' || event_type || '","user":' || user_id || '}' AS d FROM events)""",
    "json_extension_columns": """
        SELECT event_id, 'd' || event_id AS "extension_url_documentId", CAST(user_id AS VARCHAR) AS extension_url_count,
               """ + ", ".join(
        f"CASE WHEN event_type = '{t}' THEN 'true' END AS extension_url_{t}"
        for t in ("click", "signup", "view", "purchase", "error")
    ) + " FROM events",
    "json_shape_probe": """
        SELECT 'doc' AS "column", count(*) AS "values", count(*) FILTER (WHERE event_id % 5 < 2) AS standard_json,
               count(*) FILTER (WHERE event_id % 5 < 2) > 0 AS has_standard_json
        FROM events""",
    "medication_statements": "SELECT " + ", ".join(f"{v} AS {k}" for k, v in _STATEMENT.items()) + " FROM orders",
    # -- annotation
    "annotate_text": """
        SELECT doc_id, api, api_ord, CAST(NULL AS VARCHAR) AS error, CAST(len(found) AS BIGINT) AS n_entities,
               array_to_string(found, '|') AS texts
        FROM (SELECT doc_id, 'numbers' AS api, 0 AS api_ord, regexp_extract_all(text, '[0-9]+') AS found FROM documents WHERE text <> ''
              UNION ALL
              SELECT doc_id, 'capitals', 1, regexp_extract_all(text, '[A-Z][A-Z]+') FROM documents WHERE text <> '')""",
    "detected_entities": """
        SELECT doc_id, text, array_to_string(regexp_extract_all(text, '[0-9]+'), '|') AS detected_entities,
               CAST(NULL AS VARCHAR) AS error
        FROM documents WHERE text <> ''""",
    "annotation_entities": f"SELECT * EXCLUDE (rn_api, rn_row) FROM ({_ENTITIES}) WHERE rn_api = 1",
    "annotation_entities_per_row": f"SELECT * EXCLUDE (rn_api, rn_row) FROM ({_ENTITIES}) WHERE rn_row = 1",
    "annotation_traits": f"SELECT * EXCLUDE (rn_api, rn_row, k, t) FROM ({_TRAITS}) WHERE rn_api = 1",
    "annotation_traits_per_row": f"SELECT * EXCLUDE (rn_api, rn_row, k, t) FROM ({_TRAITS}) WHERE rn_row = 1",
    "annotation_attributes": f"SELECT * EXCLUDE (rn) FROM ({_ATTRIBUTES}) WHERE rn = 1",
    "annotation_icd10": _scored(2, "I", "ICD"),
    "annotation_rxnorm": _scored(3, "R", "RxNorm"),
    "annotation_snomed": _scored(4, "S", "SNOMED"),
    "annotation_table_rows": " UNION ALL ".join(
        f"SELECT 'comprehend_{name}' AS table_name, count(*) AS n_rows, count(DISTINCT case_hub_id) AS n_cases FROM ({rows})"
        for name, rows in [
            ("entities", f"SELECT * FROM ({_ENTITIES}) WHERE rn_api = 1"),
            ("traits", f"SELECT * FROM ({_TRAITS}) WHERE rn_api = 1"),
            ("attributes", f"SELECT * FROM ({_ATTRIBUTES}) WHERE rn = 1"),
            ("icd_concepts", _scored(2, "I", "ICD")),
            ("snomed_concepts", _scored(4, "S", "SNOMED")),
            ("rxnorm_concepts", _scored(3, "R", "RxNorm")),
        ]
    ),
    "annotation_flow": r"""
        SELECT row_number, doc_id, lang, CAST(i - 1 AS BIGINT) AS Id, found[i] AS entity_text
        FROM (SELECT *, unnest(range(1, len(found) + 1)) AS i
              FROM (SELECT row_number, doc_id, lang, regexp_extract_all('doc_id: ' || doc_id || e'\nlang: ' || lang ||
                           e'\ntext: ' || text || e'\n_row_number: ' || row_number, '[0-9]+') AS found
                    FROM (SELECT *, row_number() OVER (ORDER BY doc_id) AS row_number FROM documents)))""",
    "annotation_failures": """
        SELECT row_number, doc_id, 'detect_phi' AS api, 1 AS api_ord, 'ValueError: refused' AS error
        FROM (SELECT doc_id, text, row_number() OVER (ORDER BY doc_id) AS row_number FROM documents)
        WHERE contains(text, '@')""",
    # -- rows
    "row_number": """
        SELECT o_orderkey, o_orderstatus, row_number() OVER (ORDER BY o_orderstatus, o_orderkey) AS _row_number
        FROM orders""",
    "render_rows": r"""
        SELECT _row_number, 'c_custkey: ' || c_custkey || e'\nc_name: ' || c_name || e'\nc_mktsegment: ' ||
               CASE WHEN c_nationkey = 3 THEN 'None' ELSE c_mktsegment END || e'\n_row_number: ' || _row_number AS text
        FROM (SELECT *, row_number() OVER (ORDER BY c_custkey) AS _row_number FROM customer)""",
    "cast_sum": "SELECT CAST(sum(o_custkey + 3000000000) AS DECIMAL(38,0)) AS total FROM orders WHERE o_orderstatus <> 'P'",
    "row_count": "SELECT count(*) AS n_rows FROM lineitem",
    "distinct_rows": "SELECT DISTINCT l_orderkey, l_returnflag FROM lineitem",
    "filter_eq": "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'F'",
    "filter_in": "SELECT c_custkey, c_mktsegment FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')",
    "limit_rows": "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10",
    # -- sources and sinks
    "csv_roundtrip_pipe": "SELECT doc_id, text, lang FROM documents",
    "csv_roundtrip_comma": """
        SELECT doc_id, text, lang, source_table FROM documents, (VALUES ('pipe'), ('comma')) s(source_table)""",
    "csv_roundtrip_escaped": "SELECT doc_id, text, lang FROM documents",
    "csv_plain": "SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, c_mktsegment FROM customer",
    "json_documents_roundtrip": """
        SELECT 'obs-' || event_id AS id, 'test ' || event_type AS code_text,
               strftime(ts, '%Y-%m-%dT%H:%M:%S') AS "effectiveDateTime", value AS "valueQuantity_value",
               CASE WHEN event_type = 'error' THEN 'invalid' END AS "valueString"
        FROM events""",
    "snapshot_date": """
        SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN strftime(o_orderdate, '%Y-%m-%d') END AS timecolumn
        FROM orders""",
    "snapshot_files": """
        SELECT o_orderkey, o_orderstatus, strftime(o_orderdate, '%Y') || '-01-31' AS timecolumn FROM orders""",
    "csv_flow": """
        SELECT CAST(c_custkey AS VARCHAR) AS key, c_name AS name FROM customer
        UNION ALL SELECT CAST(s_suppkey AS VARCHAR), s_name FROM supplier""",
    "raw_document_copy": """
        SELECT 'Patient' AS resource, 'p' || c_custkey AS id, c_name AS family FROM customer
        UNION ALL SELECT 'Location', 'l' || s_suppkey, s_name FROM supplier
        UNION ALL SELECT 'PractitionerRole', 'r' || n_nationkey, n_name FROM nation""",
    "statement_flow": """
        SELECT o_orderkey AS statementid, CAST(o_custkey AS VARCHAR) AS meta_versionid,
               CASE WHEN o_orderstatus = 'P' THEN o_orderpriority END AS meta_tag
        FROM orders""",
    "union_databases": """
        SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus = 'F' THEN o_custkey END AS o_custkey FROM orders""",
    "table_replace": "SELECT o_orderkey, o_orderpriority FROM orders",
    "append_or_create": """
        SELECT c_custkey, c_name, CAST(NULL AS VARCHAR) AS c_mktsegment FROM customer
        UNION ALL SELECT c_custkey, NULL, c_mktsegment FROM customer""",
    "append_rerun": "SELECT o_orderkey, o_custkey, o_totalprice AS total FROM orders WHERE o_orderstatus IN ('F', 'O')",
    "annotation_reuse": """
        SELECT doc_id, 'detect_entities_v2' AS api, CAST(len(regexp_extract_all(text, '[0-9]+')) AS INTEGER) AS n_entities,
               CAST(1 AS BIGINT) AS calls
        FROM documents WHERE text <> ''""",
    "landing_increment": """
        SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(NULL AS VARCHAR) AS c_mktsegment, CAST(NULL AS VARCHAR) AS o_orderkey
        FROM customer
        UNION ALL SELECT CAST(c_custkey AS VARCHAR), NULL, c_mktsegment, NULL FROM customer
        UNION ALL SELECT NULL, NULL, NULL, CAST(o_orderkey AS VARCHAR) FROM orders""",
    "copy_layer": """
        SELECT c_custkey AS key, c_name AS name FROM customer UNION ALL SELECT s_suppkey, s_name FROM supplier""",
    "single_csv": "SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderpriority FROM orders",
    "annotations_json": f"""
        SELECT o_orderkey AS row_number, api, api_ord, CAST(o_custkey % 5 AS BIGINT) AS n_entities FROM orders, {_APIS}""",
    "row_text": r"""
        SELECT s_suppkey + 1 AS _row_number,
               's_suppkey: ' || s_suppkey || e'\ns_name: ' || s_name || e'\n_row_number: ' || (s_suppkey + 1) AS text
        FROM supplier""",
    "ddl_insert_select": """
        SELECT -1 AS case_hub_id, 'ABC' AS case_type_name UNION ALL SELECT -2, 'XYZ'
        UNION ALL SELECT c_custkey, c_mktsegment FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')""",
}
ORACLES["medication_flow"] = ORACLES["medication_concepts"]
