"""Scalar column functions (F4, F5, F8, F10): all built from Spark SQL
expressions and higher-order functions, so they stay in generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators.common import is_object_id


def object_id_text(col: Column, dtype: T.DataType) -> Column:
    """an ObjectId (``struct<oid>``) as its hex text, a string as itself,
    anything else as NULL.

    The reference turns other types into ``""``, which then equals an empty
    string; NULL never matches anything.
    """
    if is_object_id(dtype):
        return col.getField("oid")
    if isinstance(dtype, T.StringType):
        return col
    return F.lit(None).cast("string")


def array_text(col: Column, dtype: T.ArrayType) -> Column:
    """the text of the string / ObjectId elements of an array; elements
    of any other type are skipped (NULL elements too)."""
    elem = dtype.elementType
    if is_object_id(elem) or isinstance(elem, T.StringType):
        return F.filter(F.transform(col, lambda x: object_id_text(x, elem)),
                        lambda x: x.isNotNull())
    return F.when(col.isNotNull(), F.array().cast("array<string>"))


def drop_element(col: Column, n: int | Column) -> Column:
    """the array without its ``n``-th element (0-based)."""
    n = F.lit(n) if isinstance(n, int) else n
    return F.filter(col, lambda x, i: i != n)


def nested_path(*parts: str) -> str:
    """F8: the dotted path ``parent.child`` used for nested selection."""
    return ".".join(p for p in parts if p)


def collapse_ids_expr(col: Column, dtype: T.DataType) -> tuple[Column, bool]:
    """Rewrite every ObjectId inside ``col`` to its text (N5, per column).

    Returns the new expression and whether anything changed. Structs are
    rebuilt only when they hold an ObjectId somewhere; a NULL struct stays
    NULL. Keys and values of maps are rewritten too.
    """
    if is_object_id(dtype):
        return col.getField("oid"), True
    if isinstance(dtype, T.StructType):
        parts, changed = [], False
        for f in dtype.fields:
            e, c = collapse_ids_expr(col.getField(f.name), f.dataType)
            parts.append(e.alias(f.name))
            changed |= c
        if not changed:
            return col, False
        return F.when(col.isNull(), F.lit(None)).otherwise(F.struct(*parts)), True
    if isinstance(dtype, T.ArrayType):
        probe, changed = collapse_ids_expr(F.lit(None).cast(dtype.elementType), dtype.elementType)
        if not changed:
            return col, False
        return F.transform(col, lambda x: collapse_ids_expr(x, dtype.elementType)[0]), True
    if isinstance(dtype, T.MapType):
        in_keys, in_values = (collapse_ids_expr(F.lit(None).cast(t), t)[1] for t in (dtype.keyType, dtype.valueType))
        if in_values:
            col = F.transform_values(col, lambda _, v: collapse_ids_expr(v, dtype.valueType)[0])
        if in_keys:
            col = F.transform_keys(col, lambda k, _: collapse_ids_expr(k, dtype.keyType)[0])
        return col, in_keys or in_values
    return col, False
