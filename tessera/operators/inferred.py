"""The fields of JSON documents as their values show them (N1, S10), where
``fields`` goes by a schema that a reader has inferred.

A reader settles a field that holds numbers here and objects there on one type
and no longer tells how often each occurs. Here every value of every document
is counted by its place and kind, so missing fields, nulls and conflicting
kinds are numbers, and a type is derived from them in which no value is lost.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.jsonops import json_text, max_depth

OBJECT, ARRAY, TEXT, INTEGER, FRACTION, BOOLEAN, NULL = "object", "array", "text", "integer", "fraction", "boolean", "null"
REJECT = "reject"
DOCUMENT, ITEM = "$", "[]"

_SEEN = "array<struct<parent:string,path:string,kind:string>>"


#: Kinds by the first word of a variant's type, decimals without a fraction
#: taken as BIGINT; other numbers are fractions.
_KINDS = {"OBJECT": OBJECT, "ARRAY": ARRAY, "STRING": TEXT, "BOOLEAN": BOOLEAN, "VOID": NULL, "BIGINT": INTEGER}


def _kind(value: Column) -> Column:
    word = F.regexp_extract(F.regexp_replace(F.schema_of_variant(value), r"^DECIMAL\(\d+,0\)", "BIGINT"), "^[A-Z]+", 0)
    names = F.create_map(*[F.lit(x) for pair in _KINDS.items() for x in pair])
    return F.when(value.isNull(), REJECT).otherwise(F.coalesce(F.try_element_at(names, word), F.lit(FRACTION)))


def _step(key: Column) -> Column:
    """What a member adds to its parent's path; a name that is no plain word
    stands in quotes."""
    quoted = F.concat(F.lit('."'), F.regexp_replace(key, r'(["\\])', r"\\$1"), F.lit('"'))
    return F.when(key.isNull(), ITEM).when(key.rlike(r"^\w+$"), F.concat(F.lit("."), key)).otherwise(quoted)


def json_kinds(df: DataFrame, col: str, depth: int | None = None) -> DataFrame:
    """Every place in the documents of a JSON column and the kinds of the
    values there: ``parent, path, kind, n_values``.

    Paths start at ``$``, the document; ``.name`` leads to a member of an
    object and ``[]`` to the items of an array. Kinds are object, array, text,
    integer, fraction, boolean, null; at ``$`` also reject, for texts that are
    no JSON or name a member twice. NULL texts are left out. Numbers count by
    value: ``1.0`` is an integer.

    Each level of nesting is one explode, without a shuffle; ``depth`` levels
    are walked, by default those of the deepest document, which one pass over
    the text finds. A value is counted in the row of its first descendant, so
    all levels come out of one scan; one row per place, kind and task is
    shuffled.
    """
    tvf = df.sparkSession.tvf
    text = json_text(df, col)
    depth = max_depth(df, col) if depth is None else depth
    root = F.struct(F.lit(None).cast("string").alias("parent"), F.lit(DOCUMENT).alias("path"), _kind(F.col("value")).alias("kind"))
    rows = (df.where(text.isNotNull()).select(F.try_parse_json(text).alias("value"))
            .select("value", F.lit(DOCUMENT).alias("path"), F.array(root).cast(_SEEN).alias("seen")))
    for _ in range(depth):
        inner = tvf.variant_explode_outer(F.col("value").outer()).toDF("pos", "key", "inner")
        rows = rows.lateralJoin(inner)
        deeper = F.concat("path", _step(F.col("key")))
        here = F.array(F.struct(F.col("path").alias("parent"), deeper.alias("path"), _kind(F.col("inner")).alias("kind"))).cast(_SEEN)
        none = F.array().cast(_SEEN)
        rows = rows.select(
            F.col("inner").alias("value"), F.when(F.col("pos").isNotNull(), deeper).otherwise(F.col("path")).alias("path"),
            F.concat(F.when(F.coalesce("pos", F.lit(0)) == 0, F.col("seen")).otherwise(none),
                     F.when(F.col("pos").isNotNull(), here).otherwise(none)).alias("seen"))
    return (rows.select(F.explode("seen").alias("s")).groupBy("s.parent", "s.path", "s.kind")
            .agg(F.count(F.lit(1)).alias("n_values")))


def json_field_profile(df: DataFrame, col: str, depth: int | None = None) -> DataFrame:
    """One row per place in the documents (``json_kinds``): ``parent, path,
    n_values, n_null, n_missing`` (objects at the parent's place without the
    member; NULL for items and the document), ``kinds`` (kind and number of
    values, by kind) and ``conflict``: values of several kinds, nulls aside
    and numbers taken as one kind."""
    kinds = json_kinds(df, col, depth)
    n, kind = F.col("n_values"), F.col("kind")
    distinct = F.array_distinct(F.transform(F.filter("kinds", lambda k: k["kind"] != NULL),
                                            lambda k: F.when(k["kind"] == FRACTION, INTEGER).otherwise(k["kind"])))
    # An object counts for its own place and, under the same parent as its
    # members, for theirs: one scan serves both.
    member_of = F.struct(F.col("parent"), F.col("path"), kind.alias("kind"), n.alias("n_values"), F.lit(None).cast("bigint").alias("objects"))
    holder = F.struct(F.col("path").alias("parent"), F.lit(None).cast("string").alias("path"), kind.alias("kind"), n.alias("n_values"), n.alias("objects"))
    places = (kinds.select(F.explode(F.when(kind == OBJECT, F.array(member_of, holder)).otherwise(F.array(member_of))).alias("r"))
              .groupBy("r.parent", "r.path")
              .agg(F.sum("r.n_values").alias("n_values"), F.coalesce(F.sum(F.when(F.col("r.kind") == NULL, F.col("r.n_values"))), F.lit(0)).alias("n_null"),
                   F.sum("r.objects").alias("objects"),
                   F.array_sort(F.collect_list(F.struct("r.kind", "r.n_values"))).alias("kinds"))  # at most eight
              .withColumn("n_objects", F.max("objects").over(Window.partitionBy("parent"))).where("path is not null"))
    member = F.col("path") != F.concat("parent", F.lit(ITEM))
    return (places
            .select("parent", "path", "n_values", "n_null",
                    F.when(member, F.col("n_objects") - F.col("n_values")).alias("n_missing"),
                    "kinds", (F.size(distinct) > 1).alias("conflict")))


_SCALARS = {TEXT: T.StringType(), BOOLEAN: T.BooleanType()}


def document_type(fields: Iterable[Row]) -> T.DataType:
    """The type that holds every value of the documents whose
    ``json_field_profile`` rows are given, for ``from_json``: a place with
    conflicting kinds is a VARIANT, one with only nulls a string, whole
    numbers bigint. The rows (one per place) come to the driver, as any
    schema does; members are in the order of their names."""
    by_parent: dict[str | None, list[Row]] = {}
    for r in fields:
        by_parent.setdefault(r["parent"], []).append(r)

    def of(row: Row) -> T.DataType:
        kinds = {k["kind"] for k in row["kinds"]} - {NULL, REJECT}
        if not kinds:
            return T.StringType()
        if kinds <= {INTEGER, FRACTION}:
            return T.LongType() if kinds == {INTEGER} else T.DoubleType()
        if len(kinds) > 1:
            return T.VariantType()
        kind, inner = kinds.pop(), by_parent.get(row["path"], [])
        if kind == ARRAY:
            return T.ArrayType(of(inner[0]) if inner else T.StringType())
        if kind == OBJECT:
            return T.StructType([T.StructField(_name(row["path"], r["path"]), of(r)) for r in sorted(inner, key=lambda r: r["path"])])
        return _SCALARS[kind]

    top = by_parent.get(None, [])
    return of(top[0]) if top else T.StructType([])


def _name(parent: str, path: str) -> str:
    step = path[len(parent) + 1:]
    if not step.startswith('"'):
        return step
    out, quoted = [], iter(step[1:-1])
    for c in quoted:
        out.append(next(quoted) if c == "\\" else c)
    return "".join(out)


def typed_documents(df: DataFrame, col: str, keep: Iterable[str] = (), depth: int | None = None) -> DataFrame:
    """The documents of a JSON text column as a typed column ``doc`` beside
    ``keep``, of the type their own values give (``document_type``)."""
    of = document_type(json_field_profile(df, col, depth).collect())
    return df.select(*keep, F.from_json(json_text(df, col), of).alias("doc"))
