"""JSON functions (J1-J6) over a JSON text column (or a struct column, which
is turned into JSON text first).

The searches (J1, J2, J5) cut a document's text into tokens. In JSON a string
before a colon is a field name and the token after the colon begins its value,
at whatever depth; so the fields of a document, in its own order and with
repeated names, are the neighbours of its colons. That needs no depth known
beforehand, no pass over the data while the plan is built, and no shuffle: a
document's hits are found in its own row.

A text that is not JSON is a reject. The searches stop on one, unless the
caller hands them an ``Observation``: then they leave it out and count it
(``n_documents``, ``n_rejects``), and ``json_rejects`` returns the rejects
themselves. A document with repeated names is not one.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera import fixed as FX
from tessera.operators.common import qcol

# A JSON string literal, matched possessively so long strings cannot make
# the regex engine recurse deeply.
_STRING_LITERAL = r'"(?:[^"\\]++|\\.)*+"'


#: Strings, brackets, commas and colons, and everything between them.
_TOKEN = _STRING_LITERAL + r"|[{}\[\]:,]|[^\s{}\[\]:,\"]++"

#: The opening quote of a string value (no field name) that begins with a bracket.
_BRACKET_STRING = r'(?<!\\)"(?=[{\[](?:[^"\\]++|\\.)*+"(?!:))'


def json_text(df: DataFrame, col: str) -> Column:
    """The column as JSON text (structs, maps and arrays go through to_json)."""
    dt = df.schema[col].dataType
    if isinstance(dt, T.StringType):
        return qcol(col)
    if isinstance(dt, T.VariantType):
        return F.to_json(qcol(col))
    return F.to_json(qcol(col))


def schema_depth(dt: T.DataType) -> int:
    """Nesting depth of a typed value: the walk levels its JSON text needs."""
    if isinstance(dt, T.StructType):
        return 1 + max([schema_depth(f.dataType) for f in dt.fields] or [0])
    if isinstance(dt, T.ArrayType):
        return 1 + schema_depth(dt.elementType)
    if isinstance(dt, T.MapType):
        return 1 + schema_depth(dt.valueType)
    return 0


def max_depth(df: DataFrame, col: str) -> int:
    """Deepest nesting of objects/arrays over all documents.

    For a typed column (struct, array, map) the schema gives it with no data
    pass. For JSON text it is one aggregate over the text (the result is a
    single number): string literals are removed, then the running bracket
    depth is folded over what remains.
    """
    dt = df.schema[col].dataType
    if isinstance(dt, (T.StructType, T.ArrayType, T.MapType)):
        return schema_depth(dt)
    brackets = F.regexp_replace(F.regexp_replace(json_text(df, col), _STRING_LITERAL, ""),
                                r"[^\[\]{}]", "")
    depth = F.aggregate(
        F.split(brackets, ""),
        F.struct(F.lit(0).alias("d"), F.lit(0).alias("m")),
        lambda acc, ch: F.struct(
            (acc["d"] + F.when(ch.isin("{", "["), 1).when(ch.isin("}", "]"), -1).otherwise(0)).alias("d"),
            F.greatest(acc["m"], acc["d"] + F.when(ch.isin("{", "["), 1).otherwise(0)).alias("m")),
        lambda acc: acc["m"])
    row = df.agg(F.max(depth).alias("m")).first()
    return int(row["m"] or 0)


def json_valid(text: Column) -> Column:
    """Whether a text is JSON (field names may repeat); NULL for NULL."""
    return F.when(text.isNotNull(), F.get_json_object(text, "$").isNotNull())


def json_rejects(df: DataFrame, col: str, keep: Iterable[str] = ()) -> DataFrame:
    """The rows whose text is not JSON: ``<keep...>, text``."""
    text = json_text(df, col)
    return df.where(~json_valid(text)).select(*[qcol(k) for k in keep], text.alias("text"))


def _string(token: Column) -> Column:
    """The text that a string token stands for."""
    plain = F.substr(token, F.lit(2), F.length(token) - 2)
    escaped = F.from_json(F.concat(F.lit("["), token, F.lit("]")), "array<string>")[0]
    return F.when(F.instr(token, "\\") > 0, escaped).otherwise(plain)


def _documents(df: DataFrame, col: str, keep: list[str], rejects: Observation | None) -> DataFrame:
    """``<keep...>, __text``: the documents' JSON text, rewritten by the
    parser in the documents' own order."""
    text = json_text(df, col)
    out = df.select(*[qcol(k) for k in keep], text.alias("__raw"), F.get_json_object(text, "$").alias("__text"))
    bad = F.col("__raw").isNotNull() & F.col("__text").isNull()
    if rejects is None:
        stop = F.raise_error(F.concat(F.lit("not JSON: "), F.substr("__raw", F.lit(1), F.lit(200)))).cast("string")
        return out.withColumn("__text", F.when(bad, stop).otherwise(F.col("__text")))
    return out.observe(rejects, F.count(F.lit(1)).alias("n_documents"), F.count_if(bad).alias("n_rejects")).where(~bad)


def _fields(docs: DataFrame, keep: list[str], text: Column) -> DataFrame:
    """``<keep...>, __fields``: every field of a document at any depth, as
    ``struct<k: name token, v: first token of the value>`` in document order."""
    tokens = docs.select(*[qcol(k) for k in keep], F.regexp_extract_all(text, F.lit(_TOKEN), F.lit(0)).alias("__tokens"))
    at = lambda i, n: F.get("__tokens", i + n)
    pairs = F.transform("__tokens", lambda t, i: F.when(at(i, 1) == ":", F.struct(t.alias("k"), at(i, 2).alias("v"))))
    return tokens.select(*[qcol(k) for k in keep], F.array_compact(pairs).alias("__fields"))


def _text_of(docs: DataFrame) -> Column:
    """The text of documents that are objects or arrays."""
    return F.when(~F.ltrim("__raw").startswith('"'), F.col("__text"))


def json_find(df: DataFrame, col: str, key: str, keep: Iterable[str] = (),
              rejects: Observation | None = None) -> DataFrame:
    """Every string value stored under object field ``key`` at any depth:
    ``<keep...>, value`` (one row per occurrence, in document order within a
    document). Values of other types and array elements are skipped."""
    keep = list(keep)
    docs = _documents(df, col, keep, rejects)
    fields = _fields(docs, keep, _text_of(docs))
    hits = F.filter("__fields", lambda f: f["v"].startswith('"') & (_string(f["k"]) == F.lit(key)))
    return (fields.select(*[qcol(k) for k in keep], F.explode(hits).alias("__hit"))
            .select(*[qcol(k) for k in keep], _string(F.col("__hit.v")).alias("value")))


def json_strings(df: DataFrame, col: str, keep: Iterable[str] = (),
                 rejects: Observation | None = None) -> DataFrame:
    """Every string value of an object field at any depth, in document
    order: ``<keep...>, key, value``."""
    keep = list(keep)
    docs = _documents(df, col, keep, rejects)
    fields = _fields(docs, keep, _text_of(docs))
    hits = F.filter("__fields", lambda f: f["v"].startswith('"'))
    return (fields.select(*[qcol(k) for k in keep], F.explode(hits).alias("__hit"))
            .select(*[qcol(k) for k in keep], _string(F.col("__hit.k")).alias("key"), _string(F.col("__hit.v")).alias("value")))


def json_path(key: str) -> str:
    """The path of a top-level field, whatever characters its name has."""
    return "$['" + key.replace("'", "\\'") + "']"


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once per row. Named twice in one
    expression it may be computed twice, and in a lambda once per element."""
    return F.transform(F.array(value), use)[0]


def _marked(text: Column) -> Column:
    """JSON text as the parser rewrites it, with a dot before string values
    that begin with a bracket: taken out without their quotes, they then
    differ from objects and arrays. Field names stay as they are."""
    return F.when(text.contains('"{') | text.contains('"['),
                  F.regexp_replace(text, _BRACKET_STRING, '".')).otherwise(text)


def json_count(col: Column, array_key: str, member: str) -> Column:
    """How many elements of the top-level array ``array_key`` have a field
    ``member`` (a JSON null counts, a missing field does not); 0 when the
    array is absent, NULL for a text that is not JSON (see ``json_rejects``).
    ``col`` is JSON text.

    A document is rewritten once and parsed once, as an array of maps. Where
    the name is repeated, absent or holds something else too, the array is
    taken out by its path and its elements are looked at one by one."""
    name, bad = json.dumps(array_key, ensure_ascii=False) + ":", array_key + "?"
    maps = T.StructType().add(array_key, T.ArrayType(T.MapType(T.StringType(), T.StringType()))).add(bad, T.StringType())

    def size(elements: Column) -> Column:
        return F.coalesce(F.array_size(elements), F.lit(0))

    def of_maps(parsed: Column, text: Column) -> Column:
        n = size(F.filter(parsed[array_key], lambda x: F.map_contains_key(x, member)))
        return F.when(parsed[bad].isNull(), n).otherwise(one_by_one(text))

    def one_by_one(text: Column) -> Column:
        elements = lambda array: F.from_json(F.when(array.startswith("["), array), "array<string>")
        array = lambda marked: F.get_json_object(marked, json_path(array_key))
        has = lambda x: x.startswith("{") & F.array_contains(F.json_object_keys(x), member)
        return size(F.filter(_once(_once(_marked(text), array), elements), has))

    def valid(raw: Column, text: Column) -> Column:
        upto = lambda n: F.octet_length(F.substring_index(text, name, n))
        parsed = F.from_json(text, maps, {"columnNameOfCorruptRecord": bad})
        n = (F.when((upto(1) < F.octet_length(text)) & (upto(2) == F.octet_length(text)), _once(parsed, lambda p: of_maps(p, text)))
             .otherwise(one_by_one(text)))
        # A document that is a string comes without its quotes, too.
        return F.when(text.isNotNull(), F.when(F.ltrim(raw, F.lit(" \t\r\n")).startswith("{"), n).otherwise(0))

    rewritten = lambda raw: _once(F.get_json_object(raw, "$"), lambda text: valid(raw, text))
    return _once(col, lambda raw: F.when(raw.isNull(), 0).otherwise(rewritten(raw)))


def variant_text(v: Column) -> Column:
    """Text of a JSON value: strings as themselves, objects as ``struct``,
    arrays as ``array`` (the reference's type names), other scalars as JSON."""
    kind = F.schema_of_variant(v)
    return (F.when(v.isNull(), F.lit(None).cast("string"))
            .when(kind.startswith("OBJECT"), F.lit(FX.STRUCT_TYPE_NAME))
            .when(kind.startswith("ARRAY"), F.lit(FX.ARRAY_TYPE_NAME))
            .when(kind == "STRING", F.variant_get(v, "$", "string"))
            .otherwise(F.to_json(v)))


def json_field(col: Column, path: str) -> Column:
    """The text of the value at a JSON path such as ``$.lines[0].l_tax``
    (composites collapse to ``struct`` / ``array``); NULL when missing, and
    for a text that is not JSON. Where names repeat the first counts."""
    v, text = F.try_parse_json(col), F.get_json_object(col, path)
    named = F.when(text.startswith("{"), FX.STRUCT_TYPE_NAME).when(text.startswith("["), FX.ARRAY_TYPE_NAME).otherwise(text)
    return F.when(v.isNotNull(), variant_text(F.try_variant_get(v, path, "variant"))).otherwise(named)


def json_children(df: DataFrame, col: str, array_key: str, index: int, member: str,
                  keep: Iterable[str] = (), rejects: Observation | None = None) -> DataFrame:
    """All values of field ``member`` at any depth under
    ``array_key[index]``, in document order, as text (objects and arrays
    as ``struct`` / ``array``, and their own ``member`` fields are found too);
    NULL when fewer than two. ``<keep...>, member_values`` with one row per
    document, made within its own row."""
    keep = list(keep)
    docs = _documents(df, col, keep, rejects)
    whole = F.get_json_object("__text", json_path(array_key))
    element = F.get_json_object("__text", f"{json_path(array_key)}[{index}]")
    # A string element comes without its quotes: it is not in the array so.
    fields = _fields(docs, keep, F.when(F.instr(whole, element) > 0, element))
    value = lambda v: (F.when(v.startswith('"'), _string(v)).when(v == "{", FX.STRUCT_TYPE_NAME)
                       .when(v == "[", FX.ARRAY_TYPE_NAME).otherwise(F.to_json(F.try_parse_json(v))))
    found = F.transform(F.filter("__fields", lambda f: _string(f["k"]) == F.lit(member)), lambda f: value(f["v"]))
    return (fields.select(*[qcol(k) for k in keep], found.alias("member_values"))
            .withColumn("member_values", F.when(F.size("member_values") >= 2, F.col("member_values"))))


def json_array_rows(df: DataFrame, col: str, path: str, element_schema: T.DataType | str,
                    keep: Iterable[str] = ()) -> DataFrame:
    """The JSON array at ``path`` as rows, each element parsed with
    ``element_schema`` and its fields spread into columns."""
    keep = list(keep)
    if isinstance(element_schema, str):
        element_schema = T.DataType.fromDDL(element_schema)
    arr = F.from_json(F.get_json_object(json_text(df, col), path), T.ArrayType(element_schema))
    out = df.select(*[qcol(k) for k in keep], F.explode(arr).alias("__e"))
    if isinstance(element_schema, T.StructType):
        return out.select(*[qcol(k) for k in keep], "__e.*")
    return out.select(*[qcol(k) for k in keep], F.col("__e").alias("value"))
