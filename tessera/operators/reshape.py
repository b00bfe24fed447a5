"""Document <-> table shape changes (N2-N7) and renames.

All of them are projections, ``explode`` generators and filters: narrow
operations that run inside whole-stage code generation, with no shuffle.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, replace
from itertools import chain, count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.values import collapse_ids_expr
from tessera.operators.common import is_object_id, path_col, qcol, table_namer


def collapse_ids(df: DataFrame) -> DataFrame:
    """Every ObjectId (``struct<oid>``), at any depth and inside arrays,
    becomes its hex text, so id columns stay columns and can be matched."""
    out = []
    for f in df.schema.fields:
        e, _ = collapse_ids_expr(qcol(f.name), f.dataType)
        out.append(e.alias(f.name))
    return df.select(*out)


def root_table(df: DataFrame, order: Iterable[str] | None = None) -> DataFrame:
    """The top-level scalar columns (ObjectIds as text); structs, arrays
    and maps go to child tables. F11: ``order`` lists the columns to keep,
    in that order (exact names; the reference matches by substring)."""
    keep = []
    for f in df.schema.fields:
        if is_object_id(f.dataType):
            keep.append(qcol(f.name).getField("oid").alias(f.name))
        elif not isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType)) or f.name == "_id":
            keep.append(qcol(f.name))
    out = df.select(*keep)
    if order is not None:
        out = out.select(*[qcol(c) for c in order])
    return out


def _key_columns(df: DataFrame, key: str | Iterable[str] | None, taken: set[str]) -> list[tuple[str, Column]]:
    """The parent's key for a child table: the names it gets there and its
    columns. A name that is ``taken`` (case ignored) is prefixed ``parent_``
    until it is free; names given are added to ``taken``."""
    out = []
    for k in [] if key is None else [key] if isinstance(key, str) else key:
        own = k in df.columns
        c = qcol(k) if own else path_col(k)
        if own and is_object_id(df.schema[k].dataType):
            c = c.getField("oid")
        name = k if own else k.replace(".", "_")
        while name.casefold() in taken:
            name = f"parent_{name}"
        taken.add(name.casefold())
        out.append((name, c.alias(name)))
    return out


def _struct_rows(df: DataFrame, field: str, key: str | Iterable[str] | None) -> tuple[DataFrame, list[str]]:
    """N2, and the names of the key columns it wrote."""
    dt = df.schema[field].dataType
    if not isinstance(dt, T.StructType):
        raise TypeError(f"{field} is not a struct")
    keys = _key_columns(df, key, {f.name.casefold() for f in dt.fields})
    rows = (df.where(qcol(field).isNotNull())
            .select(*[c for _, c in keys], *[qcol(field).getField(f.name).alias(f.name) for f in dt.fields]))
    return rows, [n for n, _ in keys]


def _array_rows(df: DataFrame, field: str, key: str | Iterable[str] | None) -> tuple[DataFrame, list[str], str]:
    """N3, the names of the parent key columns it wrote and that of the
    position."""
    dt = df.schema[field].dataType
    source = qcol(field)
    if isinstance(dt, T.MapType):
        source, elements = F.map_entries(source), {"key": "key", "value": "value"}
    elif not isinstance(dt, T.ArrayType):
        raise TypeError(f"{field} is not an array or map")
    elif is_object_id(dt.elementType):
        elements = {"value": "oid"}
    elif isinstance(dt.elementType, T.StructType):
        elements = {f.name: f.name for f in dt.elementType.fields}
    else:
        elements = {"value": None}
    taken = {n.casefold() for n in elements}
    keys = _key_columns(df, key, taken)
    position = next(n for n in chain([f"{field}_pos"], (f"{field}_pos_{i}" for i in count(2))) if n.casefold() not in taken)
    element = next(n for n in chain(["element"], (f"element_{i}" for i in count(2))) if n.casefold() not in taken | {position.casefold()})
    rows = df.select(*[c for _, c in keys], F.posexplode(source).alias(position, element))
    fields = [(qcol(element) if sub is None else qcol(element).getField(sub)).alias(n) for n, sub in elements.items()]
    return rows.select(*[qcol(n) for n, _ in keys], qcol(position), *fields), [n for n, _ in keys], position


def split_struct(df: DataFrame, field: str, key: str | list[str] | None = "_id") -> DataFrame:
    """An embedded struct as its own table, one row per document that
    has it (1_1): ``<key>, <struct fields>``. A key name that clashes with a
    struct field is prefixed ``parent_``."""
    return _struct_rows(df, field, key)[0]


def split_array(df: DataFrame, field: str, key: str | list[str] | None = "_id",
                position: bool = True, parent_key: bool = True) -> DataFrame:
    """An embedded array as its own table, one row per element (1_n).

    Columns: the parent ``key`` (unless ``parent_key=False``, the reference's
    shape, which loses it), ``<field>_pos`` (0-based, unless
    ``position=False``; numbered if an element has a field of that name) and
    the element's fields, or one ``value`` column for arrays of scalars, or
    ``key, value`` for maps. Documents whose array is NULL or empty produce no
    row.
    """
    rows, _, place = _array_rows(df, field, key if parent_key else None)
    return rows if position else rows.drop(place)


@dataclass(frozen=True)
class SplitTable:
    """One table of a collection. ``keys`` tell its rows apart; ``link`` pairs
    its columns with those of ``parent`` that they repeat."""
    name: str
    df: DataFrame
    path: str
    relation: str
    keys: tuple[str, ...]
    parent: str | None = None
    link: tuple[tuple[str, str], ...] = ()


def split_collections(collections: Mapping[str, DataFrame], keys: Mapping[str, str | Iterable[str] | None] | None = None) -> list[SplitTable]:
    """N6 for several collections: the tables of each, parents first, under
    names that are different over all of them. Collections keep their names;
    a child is named after its field, else after its path, else (of several
    collections) after collection and path, else with a number.

    Each split hands on the names of the key columns it wrote, so a child at
    any depth carries the whole key of its parent row: the document's key (one
    or more columns) and the positions of the arrays on the way."""
    name_of = table_namer()
    roots = {name: name_of(name, name) for name in collections}
    out: list[SplitTable] = []

    def visit(cur: DataFrame, table: SplitTable, collection: str) -> None:
        inner = [f for f in cur.schema.fields if f.name not in table.keys
                 and isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType)) and f.name != "_id"]
        nested = {f.name for f in inner}
        out.append(replace(table, df=cur.select(*[qcol(k) for k in table.keys], *[
            qcol(c) for c in cur.columns if c not in nested and c not in table.keys])))
        for f in sorted(inner, key=lambda f: not isinstance(f.dataType, T.StructType)):
            path = f"{table.path}.{f.name}" if table.path else f.name
            if isinstance(f.dataType, T.StructType):
                rows, written = _struct_rows(cur, f.name, table.keys)
                own, relation = tuple(written), "1_1"
            else:
                rows, written, position = _array_rows(cur, f.name, table.keys)
                own, relation = (*written, position), "1_n"
            whole = [path] if len(collections) == 1 else [path, f"{collection}.{path}"]
            child = SplitTable(name_of(f.name, *whole), rows, path, relation, own, table.name,
                               tuple(zip(written, table.keys, strict=True)))
            visit(rows, child, collection)

    for name, df in collections.items():
        df = collapse_ids(df)
        if not df.columns:
            out.append(SplitTable(roots[name], df, "", "root", ()))
            continue
        key = (keys or {}).get(name)
        if key is None:
            key = "_id" if "_id" in df.columns else df.columns[0]
        own = _key_columns(df, key, set())
        outside = [(n, c) for n, c in own if n not in df.columns]
        visit(df.select("*", *[c for _, c in outside]), SplitTable(roots[name], df, "", "root", tuple(n for n, _ in own)), name)
    return out


def documents_to_tables(df: DataFrame, name: str, key: str | Iterable[str] | None = None,
                        tables: Iterable[str] | None = None) -> dict[str, DataFrame]:
    """A collection as relational tables: ``{name: root}`` plus one table
    per embedded struct / array at any depth (N5 collapses ObjectIds first).

    Children carry the key of their parent and, below arrays, the positions
    of every array on the way, so each child row points at exactly one
    parent row. ``key`` may be several columns, or nested paths. ``tables``
    keeps only the named tables (S13). Each table is a lazy projection/explode
    of the same scan; nothing is materialised.
    """
    wanted = None if tables is None else set(tables)
    return {t.name: t.df for t in split_collections({name: df}, {name: key}) if wanted is None or t.name in wanted}


def table_to_documents(df: DataFrame, as_json: bool = False) -> DataFrame:
    """One flat document per row, names and types kept (keys and links
    are not carried, as in the reference). ``as_json=True`` gives one
    ``json`` text column instead."""
    if as_json:
        return df.select(F.to_json(F.struct(*[qcol(c) for c in df.columns])).alias("json"))
    return df.select(*[qcol(c) for c in df.columns])


# --- renames (F6, F7) -----------------------------------------------------------

def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """rename columns (old -> new); names not in the frame are ignored."""
    present = {k: v for k, v in mapping.items() if k in df.columns and k != v}
    return df.withColumnsRenamed(present) if present else df


def rename_cascade(tables: Mapping[str, DataFrame], renames: Mapping[str, Mapping[str, str]],
                   primary_keys: Mapping[str, str] | None = None,
                   edges: DataFrame | None = None):
    """apply per-table renames to the tables, their primary keys and both
    ends of every link ``(from_table, from_field, to_table, to_field)``.

    The rename list is the user's edit of the schema (bounded by the number
    of columns), so it joins to the edges as a broadcast.
    """
    new_tables = {t: rename_columns(df, renames.get(t, {})) for t, df in tables.items()}
    new_pks = None
    if primary_keys is not None:
        new_pks = {t: renames.get(t, {}).get(k, k) for t, k in primary_keys.items()}
    new_edges = None
    if edges is not None:
        spark = edges.sparkSession
        rows = [(t, o, n) for t, m in renames.items() for o, n in m.items()]
        rn = spark.createDataFrame(rows, "r_table string, r_old string, r_new string")
        e = edges
        for side in ("from", "to"):
            t, f = f"{side}_table", f"{side}_field"
            e = (e.join(F.broadcast(rn), (F.col(t) == F.col("r_table")) & (F.col(f) == F.col("r_old")),
                        "left")
                 .withColumn(f, F.coalesce(F.col("r_new"), F.col(f)))
                 .drop("r_table", "r_old", "r_new"))
        new_edges = e
    return new_tables, new_pks, new_edges
