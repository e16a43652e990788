"""Lenient JSON parsing and flattening, as expressions over ``variant`` values.

Flattening stays inside the row: each level replaces the containers of an array of entries by their
members, so a document becomes an array of (path, text) without a generator, a shuffle or a UDF.
Expressions with nested lambdas are built as SQL text: it states them directly and reaches the parser in
one call.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from clinlake.functions.text import TIMESTAMP_OR_PAIR_PATTERN

DEFAULT_DEPTH = 6

# Top-level fields offered by the fast path.
COMMON_FIELDS = ["id", "resourceType", "status", "text", "value", "display", "code"]

# Placed after the document, so that text following the document's end shows as a parse failure: the
# parser itself ignores it.
_END_MARK = "$end-of-document$"
# A key=value pair and its JSON form.
_KEY_VALUE = r"(\w+)=([^,}]+)"
_KEY_VALUE_AS_JSON = '"$1":"$2"'

_JSON_START = r'^[\[\s]*(\{\s*["}]|["\]0-9-]|true|false|null)'


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _let_sql(name: str, value: str, body: str) -> str:
    """Evaluate ``value`` once for all uses of ``name`` in ``body``."""
    return f"get(transform(array({value}), {name} -> {body}), 0)"


def _scalar(node: str, path: str = "$") -> str:
    return f"try_variant_get({node}, '{path}', 'string')"


# -- parsing -------------------------------------------------------------------------------------


def clean_json_text(text: Column) -> Column:
    """Drop one leading and one trailing quote, trim, and turn doubled quotes into single ones."""
    bare = F.regexp_replace(F.regexp_replace(text, '^"', ""), '"$', "")
    return F.replace(F.trim(bare), F.lit('""'), F.lit('"'))


def repair_key_value(text: Column) -> Column:
    """``{k=v}`` as ``{"k":"v"}``; flat objects and arrays of flat objects become JSON."""
    return F.regexp_replace(text, _KEY_VALUE, _KEY_VALUE_AS_JSON)


# Around values of nested key=value text while it is rewritten; text that holds them is not read.
_VALUE_START, _VALUE_END = "\u0001", "\u0002"
_PAIR_START = r"([{,]\s*)(\w+)="
# A scalar goes on until the next pair of its object, or the object's end; it holds no brackets.
_SCALAR_PAIR = _PAIR_START + r"\s*+(?![{\[])([^{}\[\]\x01\x02]*?)\s*(?=,\s*\w+=|\})"
_CONTAINER_PAIR = _PAIR_START + r"\s*(?=[{\[])"
# A bare scalar in an array, between commas.
_BARE_ITEM = r'([\[,]\s*)(?![\s"])([^{}\[\],"]+?)(?=\s*[,\]])'


def _json_string(value: str) -> str:
    for plain, code in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        value = f"replace({value}, {literal(plain)}, {literal(code)})"
    return f"concat('\"', {value}, '\"')"


def _nested_key_value(text: str) -> str:
    """SQL for key=value text of any depth as JSON text; what it cannot make sense of is no JSON afterwards.

    Brackets are structure throughout, so pairs are told apart by what stands before and behind them, at every depth
    in the same pass. Values are marked first, then the text is cut at the marks: values are escaped, and in the structure
    between them bare array items are put in quotes.
    """
    scalars = f"regexp_replace({text}, {literal(_SCALAR_PAIR)}, {literal(f'$1"$2":{_VALUE_START}$3{_VALUE_END}')})"
    marked = f"regexp_replace({scalars}, {literal(_CONTAINER_PAIR)}, {literal('$1"$2":')})"
    marks = literal(f"[{_VALUE_START}{_VALUE_END}]")
    items = f"regexp_replace(v, {literal(_BARE_ITEM)}, {literal(f'$1{_VALUE_START}$2{_VALUE_END}')})"
    in_structure = f"array_join(transform(split({items}, {marks}), (w, j) -> if(j % 2 = 1, {_json_string('w')}, w)), '')"
    parts = f"transform(split({marked}, {marks}), (v, i) -> if(i % 2 = 1, {_json_string('v')}, {in_structure}))"
    return f"case when not regexp_like({text}, {marks}) then array_join({parts}, '') end"


def repair_nested_key_value(column: str) -> Column:
    """``{a=x, b={c=[d, e]}}`` in ``column`` as ``{"a":"x","b":{"c":["d","e"]}}``, to any depth.

    JSON inside it stays, but for numbers and words in arrays, which become strings as all scalars of key=value text do.
    Keys are words after ``{`` or a comma. Scalars have no blanks at their ends. A value of an object goes on
    to the next pair, so it may hold commas and ``=``, but not a comma followed by a word and ``=``; an array's item ends
    at a comma and holds no quotes. Brackets inside values are structure. Text with unbalanced brackets gives no JSON.
    """
    return F.expr(_let_sql("t", quoted(column), _nested_key_value("t")))


def _parse_strict(text: str) -> str:
    # Most text that is no JSON shows it at the start; testing that is far cheaper than a failed parse.
    likely = f"case when regexp_like({text}, {literal(_JSON_START)}) then {text} end"
    # Only text that holds the mark itself can have it in second place and go on.
    whole = (
        f"{_scalar('doc', '$[1]')} = '{_END_MARK}' and "
        f"(not contains({text}, '{_END_MARK}') or try_variant_get(doc, '$[2]', 'variant') is null)"
    )
    return _let_sql(
        "doc",
        f"try_parse_json(concat('[', {likely}, ',\"{_END_MARK}\"]'))",
        f"case when {whole} then try_variant_get(doc, '$[0]', 'variant') end",
    )


# Text whose pairs hold objects or arrays.
_NESTED_PAIR = r"=\s*[{\[]"


_WRAPPED = "(length(t) > 1 and startswith(t, '\"') and endswith(t, '\"'))"


def _trimmed(text: str) -> str:
    return f"trim(both ' \\t\\n\\r' from {text})"


def _parse_lenient(text: str, nested: bool = False, first: bool = True) -> str:
    """SQL for the document in ``text``; without ``first``, for what is left to try after ``document_steps`` tried it."""
    bare = f"if({_WRAPPED}, substr(t, 2, length(t) - 2), t)"
    single = "replace(b, '\"\"', '\"')"
    flat = _let_sql("s", f"regexp_replace({single}, {literal(_KEY_VALUE)}, {literal(_KEY_VALUE_AS_JSON)})", _parse_strict("s"))
    key_value = flat
    if nested:
        deep = _let_sql("s", _let_sql("r", single, _nested_key_value("r")), _parse_strict("s"))
        # The flat repair would take the beginning of a container for a text.
        key_value = f"if(regexp_like(t, {literal(_NESTED_PAIR)}), coalesce({deep}, {flat}), coalesce({flat}, {deep}))"
    whole = f"case when not {_WRAPPED} then {_parse_strict('t')} end, " if first else ""
    doubled = f"{_WRAPPED} or contains(t, '\"\"')" if first else f"not {_WRAPPED} and contains(t, '\"\"')"
    attempts = (
        f"coalesce({whole}"
        f"case when {doubled} then {_let_sql('s', single, _parse_strict('s'))} end, "
        f"case when contains(t, '=') then {key_value} end)"
    )
    return _let_sql("t", _trimmed(text), f"case when t != '' and t != 'null' then {_let_sql('b', bare, attempts)} end")


def document_steps(documents: Mapping[str, str], nested: Sequence[str] = ()) -> list[dict[str, str]]:
    """Projections to make one after the other, by name: the last gives what ``parse_json_lenient`` gives of each column.

    ``documents`` has the text column of each name. The first form of a text, which most can be read in, is parsed by plain
    expressions: these are compiled, lambda functions are not.
    """
    steps: list[dict[str, str]] = [{}, {}, {}, {}]
    for name, column in documents.items():
        t, tried, parsed = f"_trimmed{name}", f"_tried{name}", f"_parsed{name}"
        wrapped = _WRAPPED.replace("(t", f"({t}")
        steps[0][t] = _trimmed(f"cast({quoted(column)} as string)")
        unwrapped = f"replace(substr({t}, 2, length({t}) - 2), '\"\"', '\"')"
        steps[1][tried] = f"case when {t} != '' and {t} != 'null' then if({wrapped}, {unwrapped}, {t}) end"
        steps[2][parsed] = (
            f"case when regexp_like({tried}, {literal(_JSON_START)}) "
            f"then try_parse_json(concat('[', {tried}, ',\"{_END_MARK}\"]')) end"
        )
        steps[3][name] = (
            f"case when {_scalar(parsed, '$[1]')} = '{_END_MARK}' and (not contains({tried}, '{_END_MARK}') "
            f"or try_variant_get({parsed}, '$[2]', 'variant') is null) then try_variant_get({parsed}, '$[0]', 'variant') "
            f"when {tried} is not null then {_parse_lenient(t, column in nested, first=False)} end"
        )
    return steps


def parse_json_strict(column: str) -> Column:
    """The text in ``column`` as a variant; NULL unless all of it is one JSON document."""
    return F.expr(_let_sql("t", quoted(column), _parse_strict("t")))


def parse_json_lenient(column: str, nested: bool = False) -> Column:
    """JSON, quote-wrapped JSON with doubled quotes, or key=value text, as a variant.

    NULL, blank, ``null`` and text that cannot be read give NULL. Attempts, in order: the text itself
    (unwrapped first when it is in quotes), with doubled quotes undone, with key=value pairs repaired. Pairs are
    those of flat objects; with ``nested`` their values may be objects and arrays too, see ``repair_nested_key_value``.
    Repeated keys need ``session.keep_last_duplicate_key``.
    """
    return F.expr(_parse_lenient(quoted(column), nested))


# -- shapes --------------------------------------------------------------------------------------
# The shape of a document is its text with every scalar replaced by one mark. Only scalars that JSON allows are
# replaced, so that a shape is JSON exactly where its document is. What names columns stays: keys, the urls of
# extensions, and the type in a text that refers to a resource.

_STRING = r'"(?:[^"\\\x00-\x1f]|\\["\\/bfnrt])*+"'
_OTHER_THAN_REFERENCE = r'"(?:(?!reference=)(?:[^"\\\x00-\x1f]|\\["\\/bfnrt]))*+"'
_ANY_STRING = r'"(?:[^"\\]|\\(?s:.))*+"'
_LITERAL = r"(?:-?(?:0|[1-9][0-9]*)(?:\.[0-9]+)?(?:[eE][+-]?[0-9]+)?(?=[\s,}\]]|$)|(?:true|false|null)(?![A-Za-z0-9_]))"
_MARK = "\u0001"
#: A reference is told apart by the type alone, if nothing else in its text is one.
_REFERENCE_TEXT = r'"reference=(\w+)/[^"\\\x00-\x1f/,= ]+(?:,(?:(?!reference=)[^"\\\x00-\x1f])*)?"(?!\s*:)'


def _kept_or_scalar(scalar: str) -> str:
    """What is kept is in the groups: urls, keys, and in the end strings that are neither these nor scalars to replace."""
    return rf'("url"\s*:\s*(?:{_STRING}|{_LITERAL})|{_ANY_STRING}\s*:)|{scalar}|{_LITERAL}|({_ANY_STRING})'


def _shape(text: str) -> str:
    """SQL for the shape of JSON text. The mark goes before what is kept as well, and is taken away there again."""
    plain = f"regexp_replace({text}, {literal(_kept_or_scalar(_STRING))}, {literal(_MARK + '$1$2')})"
    short = f"regexp_replace({text}, {literal(_REFERENCE_TEXT)}, {literal('"reference=$1/x"')})"
    referring = f"regexp_replace({short}, {literal(_kept_or_scalar(_OTHER_THAN_REFERENCE))}, {literal(_MARK + '$1$2')})"
    marked = f"if(contains({text}, 'reference='), {referring}, {plain})"
    return f"replace(replace({marked}, {literal(_MARK + '"')}, '\"'), {literal(_MARK)}, 'true')"


def shape_of(column: str) -> Column:
    """struct<shape, more> of lenient JSON text in ``column``; NULL where there is no document.

    The shape is that of the first form of the text that can be JSON: the text itself, with doubled quotes undone, or with
    flat key=value pairs repaired. ``more`` says that another form is left to try should the shape turn out not to be JSON.
    """
    wrapped = "(length(t) > 1 and startswith(t, '\"') and endswith(t, '\"'))"
    bare = f"if({wrapped}, substr(t, 2, length(t) - 2), t)"
    single = "replace(b, '\"\"', '\"')"
    repaired = f"regexp_replace({single}, {literal(_KEY_VALUE)}, {literal(_KEY_VALUE_AS_JSON)})"

    def form(shape: str, more: str) -> str:
        return f"named_struct('shape', {shape}, 'more', {more})"

    def if_json(text: str, more: str) -> str:
        # An equals sign outside strings is never JSON.
        no_pairs = f"not contains(s, '=') or not contains(regexp_replace(s, {literal(_ANY_STRING)}, ''), '=')"
        return _let_sql("s", _shape(text), f"case when {no_pairs} then {form('s', more)} end")

    def started(text: str, body: str) -> str:
        return f"case when regexp_like({text}, {literal(_JSON_START)}) then {body} end"

    pairs, doubled = "contains(t, '=')", "contains(t, '\"\"')"
    first = f"case when not {wrapped} then {started('t', if_json('t', f'{pairs} or {doubled}'))} end"
    second = f"case when {wrapped} or {doubled} then {_let_sql('u', single, started('u', if_json('u', pairs)))} end"
    third = f"case when {pairs} then {_let_sql('u', repaired, started('u', form(_shape('u'), 'false')))} end"
    forms = f"if(contains(t, {literal(_MARK)}), {form('t', 'true')}, coalesce({first}, {second}, {third}))"
    trimmed = f"trim(both ' \\t\\n\\r' from cast({quoted(column)} as string))"
    return F.expr(_let_sql("t", trimmed, f"case when t != '' and t != 'null' then {_let_sql('b', bare, forms)} end"))


# -- flattening ----------------------------------------------------------------------------------
# All documents of a row are flattened together, in one array of entries
# struct<column, path, node, text, role, level>. ``node`` is NULL once ``text`` is final. Roles:
#   root       the whole document
#   member     member of an object
#   extension  member of an object under the key "extension"
#   item       array element
#   value      value of an extension


def _object(node: str) -> str:
    return f"try_variant_get({node}, '$', 'map<string,variant>')"


def _array(node: str) -> str:
    return f"try_variant_get({node}, '$', 'array<variant>')"


def _entry(path: str, node: str, role: str, text: str = "cast(null as string)", level: str = "e.level + 1") -> str:
    return (
        f"named_struct('column', e.column, 'path', {path}, 'node', {node}, 'text', {text}, "
        f"'role', {role}, 'level', {level})"
    )


def root_entries(columns: Sequence[str], nested: Sequence[str] = ()) -> Column:
    """The documents of the given text columns, parsed, as the first array of entries.

    Columns listed in ``nested`` may hold nested key=value text.
    """

    def documents(names: Sequence[str], deep: bool) -> str:
        texts = ", ".join(f"named_struct('column', {literal(c)}, 'text', cast({quoted(c)} as string))" for c in names)
        return f"transform(array({texts}), e -> {_root(_parse_lenient('e.text', deep))})"

    parts = [
        documents(names, deep)
        for deep in (False, True)
        if (names := [c for c in columns if (c in nested) == deep])
    ]
    return F.expr(_documents(f"concat({', '.join(parts)})" if len(parts) > 1 else parts[0]))


def root_entry(column: str, node: str) -> Column:
    """The document in column ``node`` of the JSON column that ``column`` names, as an array of at most one entry."""
    entry = f"named_struct('column', {quoted(column)})"
    return F.expr(_documents(f"transform(array({entry}), e -> {_root(quoted(node))})"))


def _root(node: str) -> str:
    return _entry("e.column", node, "if(e.column = 'extension', 'extension', 'root')", level="0")


def _documents(entries: str) -> str:
    return f"filter({entries}, e -> e.node is not null and not is_variant_null(e.node))"


def _extension_pairs(node: str) -> str:
    """array<struct<name, text>> of an extension array that holds objects only; NULL for anything else.

    An extension gives its first ``value*`` field under the last part of its url; one without either is
    dropped.
    """
    url = _scalar("try_element_at(x, 'url')")
    value_key = "get(filter(map_keys(x), k -> startswith(k, 'value')), 0)"
    pair = (
        f"named_struct('name', substring_index(substring_index({url}, ':', -1), '/', -1), "
        f"'text', {_scalar(f'try_element_at(x, {value_key})')})"
    )
    usable = f"filter(xs, x -> {url} != '' and {value_key} is not null)"
    return _let_sql(
        "xs",
        f"transform({_array(node)}, x -> {_object('x')})",
        f"case when forall(xs, x -> x is not null) then transform({usable}, x -> {pair}) end",
    )


def next_level(entries: str, located: bool = False) -> Column:
    """Column ``entries`` with each container replaced by its members, in order.

    With ``located``, paths keep where each step goes (see ``KEY_STEP`` and ``ITEM_STEP``), and an
    extension's value has its array's path and the extension's name as text.
    """
    key_step, item_step = (literal(KEY_STEP), literal(ITEM_STEP)) if located else ("'_'", "'_'")
    member = _entry(
        f"concat(e.path, {key_step}, m.key)", "m.value", "if(m.key = 'extension', 'extension', 'member')"
    )
    item = _entry(f"concat(e.path, {item_step}, i)", "x", "'item'")
    # The extension array that is the whole column "extension" gives names without a prefix.
    name = "concat(if(e.path = 'extension', '', concat(e.column, '_')), 'extension_url_', x.name)"
    extension = (
        _entry("e.path", "cast(null as variant)", "'value'", "x.name")
        if located
        else _entry(name, "cast(null as variant)", "'value'", "x.text")
    )
    scalar = _entry("e.path", "cast(null as variant)", "e.role", _scalar("e.node"), "e.level")
    children = (
        f"case when e.node is null then array(e) else coalesce("
        f"transform(map_entries({_object('e.node')}), m -> {member}), "
        f"case when e.role = 'extension' then transform({_extension_pairs('e.node')}, x -> {extension}) end, "
        f"transform({_array('e.node')}, (x, i) -> {item}), "
        f"array({scalar})) end"
    )
    # Rows whose entries are all final pass through the remaining levels as they are.
    return F.expr(_let_sql(
        "s",
        quoted(entries),
        f"if(exists(s, e -> e.node is not null), flatten(transform(s, e -> {children})), s)",
    ))


def _reference(text: str) -> tuple[str, str, str]:
    """What follows ``reference=`` in ``text``, and the type and id in that, called ``r``."""
    blanks = "both ' \\t\\n\\r' from"
    return (
        f"trim({blanks} substring_index(get(split({text}, 'reference='), 1), ',', 1))",
        f"trim({blanks} substring_index(r, '/', 1))",
        f"trim({blanks} substr(r, instr(r, '/') + 1))",
    )


def leaf_entries(entries: str) -> Column:
    """Column ``entries`` as array<struct<column, path, text, open, level>>; a path may repeat.

    ``open`` marks an entry that still is a container; its text is JSON.
    """
    stamp = literal(TIMESTAMP_OR_PAIR_PATTERN)
    # Timestamps and references are cleaned in members of objects; timestamps also in a whole document.
    cleaned = _let_sql(
        "raw",
        f"coalesce(e.text, {_scalar('e.node')})",
        "if(e.role != 'item' and e.role != 'value' and contains(raw, ':') "
        f"and regexp_like(raw, {stamp}), regexp_replace(raw, {stamp}, '$1$3 $2$4'), raw)",
    )
    leaf = (
        "named_struct('column', e.column, "
        "'path', if(e.path = e.column, concat(e.path, '_value'), e.path), "
        f"'text', {cleaned}, "
        "'member', e.role = 'member' or e.role = 'extension', "
        f"'size', coalesce(cardinality({_object('e.node')}), cardinality({_array('e.node')})), 'level', e.level)"
    )
    leaves = f"filter(transform({quoted(entries)}, e -> {leaf}), e -> coalesce(e.size, 1) > 0)"

    target, kind, ident = _reference("e.text")
    plain = "named_struct('path', e.path, 'text', e.text)"
    named = (
        f"if(instr(r, '/') > 0 and {kind} != '' and {ident} != '', "
        f"named_struct('path', concat(e.path, '_', {kind}), 'text', {ident}), {plain})"
    )
    resolved = _let_sql(
        "p",
        f"if(e.member and contains(e.text, 'reference='), {_let_sql('r', target, named)}, {plain})",
        "named_struct('column', e.column, 'path', regexp_replace(p.path, '\\\\W', '_'), "
        "'text', p.text, 'open', e.size is not null, 'level', e.level)",
    )
    return F.expr(f"transform({leaves}, e -> {resolved})")


def depth_reached(entries: str) -> Column:
    """struct<level, open> of located entries: the deepest level, and whether a container is left."""
    size = f"coalesce(cardinality({_object('e.node')}), cardinality({_array('e.node')}))"
    return F.expr(
        f"named_struct('level', array_max(transform({quoted(entries)}, e -> e.level)), "
        f"'open', exists({quoted(entries)}, e -> coalesce({size}, 0) > 0))"
    )


# A string, or what is neither string nor bracket, in JSON as a variant prints it.
_NO_BRACKETS = r'"(?:[^"\\]++|\\(?s:.))*+"|[^{}\[\]"]++'


def bracket_skeleton(document: str) -> Column:
    """The brackets of the parsed document in column ``document``, in order; empty for a scalar."""
    return F.expr(f"regexp_replace(to_json({quoted(document)}), {literal(_NO_BRACKETS)}, '')")


def nesting(skeleton: str) -> Column:
    """How many brackets of a skeleton are open at once, at most."""
    step = "if(c in ('{', '['), 1, -1)"
    return F.expr(
        f"aggregate(split({quoted(skeleton)}, ''), named_struct('open', 0, 'most', 0), "
        f"(a, c) -> named_struct('open', a.open + {step}, 'most', greatest(a.most, a.open + {step})), a -> a.most)"
    )


# Steps of a located path: into an object member, and into an array element.
KEY_STEP = "\u0001k"
ITEM_STEP = "\u0001i"


def located_leaves(entries: str) -> Column:
    """Located ``entries`` as array<struct<column, location, kind, name, level>>.

    Kinds: ``member`` and ``item`` are scalars, ``reference`` a member whose text refers to a resource of
    type ``name``, ``extension`` a value of the extension called ``name``, ``open`` a container.
    """
    target, kind, ident = _reference("text")
    resource = _let_sql("r", target, f"if(instr(r, '/') > 0 and {ident} != '', nullif({kind}, ''), null)")
    named = _let_sql(
        "text",
        f"coalesce(e.text, {_scalar('e.node')})",
        "case when e.role = 'value' then text "
        f"when (e.role = 'member' or e.role = 'extension') and contains(text, 'reference=') then {resource} end",
    )
    size = f"coalesce(cardinality({_object('e.node')}), cardinality({_array('e.node')}))"
    leaf = (
        f"named_struct('column', e.column, 'location', e.path, 'role', e.role, 'name', {named}, "
        f"'size', {size}, 'level', e.level)"
    )
    kinds = (
        "case when e.size > 0 then 'open' when e.role = 'value' then 'extension' "
        "when e.name is not null then 'reference' when e.role = 'item' then 'item' else 'member' end"
    )
    return F.expr(
        f"transform(filter(transform({quoted(entries)}, e -> {leaf}), e -> coalesce(e.size, 1) > 0), "
        f"e -> named_struct('column', e.column, 'location', e.location, 'kind', {kinds}, "
        "'name', if(e.size > 0, null, e.name), 'level', e.level))"
    )


def located_name() -> Column:
    """The column name a located leaf gives, from its fields."""
    step = literal("\u0001[ki]")
    return F.expr(
        "regexp_replace(case "
        "when kind = 'extension' then concat(if(location = 'extension', '', concat(`column`, '_')), 'extension_url_', name) "
        f"when kind = 'reference' then concat(regexp_replace(location, {step}, '_'), '_', name) "
        "when location = `column` then concat(`column`, '_value') "
        f"else regexp_replace(location, {step}, '_') end, '[^a-zA-Z0-9_]', '_')"
    )


def variant_path(steps: Sequence[str | int]) -> str | None:
    """The path expression of object keys and array places; None when a key cannot be written in one."""
    path = "$"
    for step in steps:
        if isinstance(step, int):
            path += f"[{step}]"
        elif step and "'" not in step and "\u0001" not in step:
            path += f"['{step}']"
        elif step and '"' not in step and "\u0001" not in step:
            path += f'["{step}"]'
        else:
            return None
    return path


def scalar_at(document: str, path: str) -> str:
    """SQL for the text at a path, which is JSON when a container is there."""
    return f"try_variant_get({quoted(document)}, {literal(path)}, 'string')"


def unless_container(value: str, document: str, path: str) -> str:
    """SQL for ``value``, the text at a path, or NULL when that is a container's JSON."""
    at = f"try_variant_get({quoted(document)}, {literal(path)}, "
    return (
        f"case when startswith({value}, '{{') and {at}'map<string,variant>') is not null then null "
        f"when startswith({value}, '[') and {at}'array<variant>') is not null then null else {value} end"
    )


def cleaned_stamp(value: str) -> str:
    """SQL for ``value`` with a timestamp, or a pair with one, normalised."""
    stamp = literal(TIMESTAMP_OR_PAIR_PATTERN)
    return (
        f"case when contains({value}, ':') and regexp_like({value}, {stamp}) "
        f"then regexp_replace({value}, {stamp}, '$1$3 $2$4') else {value} end"
    )


def reference_parts(value: str) -> str:
    """SQL for struct<kind, ident> of ``reference=kind/ident`` in ``value``; NULL when there is none."""
    target, kind, ident = _reference(value)
    parts = (
        f"case when instr(r, '/') > 0 and {kind} != '' and {ident} != '' "
        f"then named_struct('kind', {kind}, 'ident', {ident}) end"
    )
    return f"case when contains({value}, 'reference=') then {_let_sql('r', target, parts)} end"


def extension_pairs_at(document: str, paths: Sequence[str]) -> str:
    """SQL for the (name, text) pairs of all extension arrays at the paths, in order."""
    arrays = [
        _extension_pairs(f"try_variant_get({quoted(document)}, {literal(p)}, 'variant')") for p in paths
    ]
    return "concat(" + ", ".join(f"coalesce({a}, array())" for a in arrays) + ")"


def last_named(pairs: str, name: str) -> str:
    """SQL for the text of the last pair called ``name``."""
    return f"try_element_at(filter({quoted(pairs)}, x -> x.name = {literal(name)}), -1).text"


def last_per_path(entries: str) -> Column:
    """Column of ``leaf_entries`` with only the last entry of each (column, path).

    Repeats are found by sorting; a row without them, the usual case, skips the sort.
    """
    keys = "transform(s, e -> concat(e.column, '/', e.path))"
    last = _let_sql("keys", keys, "filter(s, (e, i) -> not (get(keys, i + 1) <=> keys[i]))")
    placed = (
        f"transform({quoted(entries)}, (e, i) -> named_struct("
        "'column', e.column, 'path', e.path, 'place', i, 'text', e.text))"
    )
    return F.expr(_let_sql(
        "s",
        placed,
        f"if(cardinality(array_distinct({keys})) = cardinality(s), s, " + _let_sql("s", "array_sort(s)", last) + ")",
    ))


def path_values(leaves: str, column: str, paths: Sequence[str]) -> Column:
    """The texts of one JSON column's paths, in the order of ``paths``; NULL where a path is absent."""
    own = f"filter({quoted(leaves)}, e -> e.column = {literal(column)})"
    wanted = ", ".join(literal(p) for p in paths)
    return F.expr(_let_sql(
        "m",
        _let_sql("own", own, "map_from_arrays(own.path, own.text)"),
        f"transform(array({wanted}), p -> try_element_at(m, p))",
    ))


def path_map(leaves: str, column: str) -> Column:
    """One JSON column's paths and texts as a map; NULL where the column has none."""
    own = f"filter({quoted(leaves)}, e -> e.column = {literal(column)})"
    return F.expr(_let_sql("own", own, "case when cardinality(own) > 0 then map_from_arrays(own.path, own.text) end"))


# -- fields --------------------------------------------------------------------------------------


def common_field(text: Column, field: str) -> Column:
    """One top-level field of cleaned JSON text, read only where the text mentions the field."""
    mentioned = text.contains(f'"{field}"') | text.contains(f"{field}=")
    return F.when(mentioned, F.get_json_object(text, f"$.{field}"))


def extension_map(parsed: str) -> Column:
    """Top-level extension array in column ``parsed`` as map<name, text>; the last of a name stays."""
    keys = "transform(s, e -> e.name)"
    last = _let_sql("keys", keys, "filter(s, (e, i) -> not (get(keys, i + 1) <=> keys[i]))")
    placed = (
        f"transform({_extension_pairs(quoted(parsed))}, (e, i) -> named_struct("
        "'name', concat('extension_url_', regexp_replace(e.name, '[^a-zA-Z0-9_]', '_')), 'place', i, 'text', e.text))"
    )
    sorted_last = _let_sql("s", f"array_sort({placed})", last)
    return F.expr(_let_sql("u", sorted_last, "map_from_arrays(u.name, u.text)"))
