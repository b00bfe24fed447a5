"""Schema flattening (N1) with the field rules F1-F3, F9 and the schema
JSON output (S10).

The walk over the schema runs on the driver and touches metadata only.
The statistics of every table come from one scan and one global aggregate
with partial aggregation per task (array tables through higher-order
functions over the arrays, never an explode), so nothing but one row per
task crosses the shuffle.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera import fixed as FX
from tessera.operators.common import is_object_id, qcol, table_namer

ROOT, ONE_TO_ONE, ONE_TO_MANY = "root", FX.RELATION_ONE_TO_ONE, FX.RELATION_ONE_TO_MANY

FIELD_SCHEMA = ("table_name string, path string, relation string, parent string, "
                "field_name string, field_type string, nullable boolean")
PROFILE_SCHEMA = FIELD_SCHEMA + ", n_rows bigint, n_null bigint, len_min bigint, len_max bigint"


@dataclass
class Leaf:
    name: str
    type: str
    nullable: bool
    expr: Column
    is_text: bool
    rel: tuple[str, ...] = ()   # field names from the row (or array element)
    oid: bool = False           # an ObjectId: read its ``oid``


@dataclass
class TableSpec:
    name: str
    path: str
    relation: str
    parent: str | None
    frame: tuple[str, ...]          # array paths exploded to reach the rows
    present: list[Column]           # embedded structs that must be non-NULL
    fields: list[Leaf] = field(default_factory=list)
    present_rel: list[tuple[str, ...]] = field(default_factory=list)


def type_name(dt: T.DataType) -> str:
    """the type as Spark's own short text (``bigint``, ``string``...).
    ObjectIds read as ``objectid``."""
    if is_object_id(dt):
        return "objectid"
    return dt.simpleString()


def walk(schema: T.StructType, root_name: str, id_column: str = "_id") -> list[TableSpec]:
    """N1 walk: the tables a nested schema splits into.

    * a scalar (or ObjectId, or the ``_id`` struct) is a field of its table;
    * a struct becomes a 1_1 child table named after the field and leaves
      its parent;
    * an array of structs becomes a 1_n child table; an array of scalars a
      1_n child with one ``value`` field; a map a 1_n child ``key, value``.
    Child tables recurse to any depth. When a name is taken, the child is
    named after its whole path (``lines_tags``), numbered if that is taken.
    """
    tables: list[TableSpec] = []
    new_name = table_namer()

    def visit(st: T.StructType, spec: TableSpec, base: Column | None, path: str,
              base_rel: tuple[str, ...] = ()):
        tables.append(spec)
        for f in st.fields:
            col = qcol(f.name) if base is None else base.getField(f.name)
            rel = base_rel + (f.name,)
            fpath = f.name if not path else f"{path}.{f.name}"
            dt = f.dataType
            if is_object_id(dt):
                spec.fields.append(Leaf(f.name, "objectid", f.nullable, col.getField("oid"), True,
                                        rel, True))
            elif isinstance(dt, T.StructType) and f.name != id_column:
                child = TableSpec(new_name(f.name, fpath), fpath, ONE_TO_ONE, spec.name,
                                  spec.frame, spec.present + [col], [],
                                  spec.present_rel + [rel])
                visit(dt, child, col, fpath, rel)
            elif isinstance(dt, (T.ArrayType, T.MapType)):
                frame = spec.frame + (fpath,)
                child = TableSpec(new_name(f.name, fpath), fpath, ONE_TO_MANY, spec.name, frame, [])
                elem = F.col("__e")
                if isinstance(dt, T.MapType):
                    tables.append(child)
                    child.fields.append(Leaf("key", type_name(dt.keyType), False,
                                             elem.getField("key"), _texty(dt.keyType), ("key",)))
                    child.fields.append(Leaf("value", type_name(dt.valueType), dt.valueContainsNull,
                                             elem.getField("value"), _texty(dt.valueType),
                                             ("value",)))
                elif isinstance(dt.elementType, T.StructType) and not is_object_id(dt.elementType):
                    visit(dt.elementType, child, elem, fpath, ())
                else:
                    tables.append(child)
                    et = dt.elementType
                    child.fields.append(Leaf("value", type_name(et), dt.containsNull,
                                             elem.getField("oid") if is_object_id(et) else elem,
                                             _texty(et), (), is_object_id(et)))
            else:
                spec.fields.append(Leaf(f.name, type_name(dt), f.nullable, col, _texty(dt), rel))

    root = TableSpec(new_name(root_name, root_name), "", ROOT, None, (), [])
    visit(schema, root, None, "")
    return tables


def _texty(dt: T.DataType) -> bool:
    return isinstance(dt, T.StringType) or is_object_id(dt)


def schema_fields(df: DataFrame, name: str, id_column: str = "_id") -> DataFrame:
    """N1 without statistics: one row per field of every table of the walk
    (``FIELD_SCHEMA``). Built from the schema only, no data pass."""
    rows = [(t.name, t.path, t.relation, t.parent, f.name, f.type, f.nullable)
            for t in walk(df.schema, name, id_column) for f in t.fields]
    return df.sparkSession.createDataFrame(rows, FIELD_SCHEMA)


def _at(base: Column | None, rel: tuple[str, ...], oid: bool = False) -> Column:
    """``base.a.b`` (``base`` None = the row's own columns)."""
    c = base
    for i, r in enumerate(rel):
        c = qcol(r) if c is None else c.getField(r)
    if oid:
        c = c.getField("oid")
    return c


def _elements(schema: T.StructType, frame: tuple[str, ...]) -> Column:
    """All elements reached by the array (or map) paths of ``frame``, as one
    array per document: nested levels are flattened with ``transform`` -
    no explode, no shuffle."""
    elems = None
    prev = None
    for k, p in enumerate(frame):
        is_map = _is_map_path(schema, frame[:k + 1])
        if prev is None:
            src = _at(None, tuple(p.split(".")))
            elems = F.map_entries(src) if is_map else src
        else:
            rel = tuple(p[len(prev) + 1:].split("."))
            step = (lambda x, rel=rel: F.map_entries(_at(x, rel))) if is_map else \
                (lambda x, rel=rel: _at(x, rel))
            # flatten() is NULL if any inner array is: drop NULL ones first.
            elems = F.flatten(F.filter(F.transform(elems, _one_arg(step)),
                                       lambda a: a.isNotNull()))
        prev = p
    return elems


def _one_arg(fn):
    return lambda x: fn(x)


# One-argument closures: PySpark passes the element index to a lambda that
# takes a second (even defaulted) parameter.
def _present_of(rels: tuple[tuple[str, ...], ...]):
    def present(x: Column) -> Column:
        c = F.lit(True)
        for p in rels:
            c = c & _at(x, p).isNotNull()
        return c
    return present


def _null_of(f: Leaf):
    return lambda x: _at(x, f.rel, f.oid).isNull()


def _length_of(f: Leaf):
    return lambda x: F.length(_at(x, f.rel, f.oid))


def _size0(arr: Column) -> Column:
    return F.coalesce(F.size(arr), F.lit(0)).cast("bigint")


def field_profile(df: DataFrame, name: str, id_column: str = "_id") -> DataFrame:
    """Every field of every table the document schema splits into, with
    its statistics over that table's rows:

    ``table_name, path, relation, parent, field_name, field_type, nullable,
    n_rows, n_null, len_min, len_max`` (lengths for text fields only).

    One scan and one global aggregate for all tables: root and embedded
    struct fields are plain conditional aggregates; the rows of an array
    table are the array's elements (nested arrays flattened), counted and
    measured with ``size`` / ``filter`` / ``transform`` / ``array_min`` /
    ``array_max`` inside the same aggregate, so no array is exploded.
    """
    tables = walk(df.schema, name, id_column)
    aggs, meta = [], []
    for ti, t in enumerate(tables):
        if not t.fields:
            continue
        if not t.frame:
            cond = F.lit(True)
            for p in t.present_rel:
                cond = cond & _at(None, p).isNotNull()
            aggs.append(F.count(F.when(cond, 1)).alias(f"__r{ti}"))
            for f in t.fields:
                i = len(aggs)
                v = _at(None, f.rel, f.oid)
                ln = F.length(v) if f.is_text else F.lit(None).cast("int")
                aggs += [F.count(F.when(cond & v.isNull(), 1)).alias(f"__a{i}"),
                         F.min(F.when(cond, ln)).cast("bigint").alias(f"__a{i + 1}"),
                         F.max(F.when(cond, ln)).cast("bigint").alias(f"__a{i + 2}")]
                meta.append((t, f, ti, i))
            continue
        elems = _elements(df.schema, t.frame)
        if t.present_rel:
            elems = F.filter(elems, _present_of(tuple(t.present_rel)))
        aggs.append(F.sum(_size0(elems)).alias(f"__r{ti}"))
        for f in t.fields:
            i = len(aggs)
            nulls = F.sum(_size0(F.filter(elems, _null_of(f))))
            if f.is_text:
                lens = F.transform(elems, _length_of(f))
                lo, hi = F.min(F.array_min(lens)), F.max(F.array_max(lens))
            else:
                lo = hi = F.lit(None).cast("int")
            aggs += [nulls.alias(f"__a{i}"), lo.cast("bigint").alias(f"__a{i + 1}"),
                     hi.cast("bigint").alias(f"__a{i + 2}")]
            meta.append((t, f, ti, i))
    if not meta:
        return df.sparkSession.createDataFrame([], PROFILE_SCHEMA)
    one = df.agg(*aggs)
    structs = [F.struct(
        F.lit(t.name).alias("table_name"), F.lit(t.path).alias("path"),
        F.lit(t.relation).alias("relation"), F.lit(t.parent).cast("string").alias("parent"),
        F.lit(f.name).alias("field_name"), F.lit(f.type).alias("field_type"),
        F.lit(f.nullable).alias("nullable"),
        F.coalesce(F.col(f"__r{ti}"), F.lit(0)).cast("bigint").alias("n_rows"),
        F.coalesce(F.col(f"__a{i}"), F.lit(0)).cast("bigint").alias("n_null"),
        F.col(f"__a{i + 1}").alias("len_min"), F.col(f"__a{i + 2}").alias("len_max"))
        for t, f, ti, i in meta]
    return one.select(F.explode(F.array(*structs)).alias("r")).select("r.*")


def _is_map_path(schema: T.StructType, frame: tuple[str, ...]) -> bool:
    dt: T.DataType = schema
    for p in frame[-1].split("."):
        while isinstance(dt, T.ArrayType):
            dt = dt.elementType
        dt = dt[p].dataType  # type: ignore[index]
    return isinstance(dt, T.MapType)


def scalar_fields(fields: DataFrame) -> DataFrame:
    """fields that take part in scalar value matching: everything but
    arrays and untyped ``""`` fields. ObjectIds are matched as text."""
    return fields.where(~F.col("field_type").startswith("array") & (F.col("field_type") != ""))


def array_fields(fields: DataFrame) -> DataFrame:
    """array-typed fields (array value matching)."""
    return fields.where(F.col("field_type").startswith("array"))


def schema_json(df: DataFrame, name: str) -> DataFrame:
    """One row ``name, schema_json`` with the collection name placed
    first in Spark's schema JSON; ``write.text`` it to keep a copy."""
    doc = {"name": name}
    doc.update(json.loads(df.schema.json()))
    return df.sparkSession.createDataFrame([(name, json.dumps(doc, indent=2))],
                                           "name string, schema_json string")
