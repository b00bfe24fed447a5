"""Composite migrations: M2 (documents -> relational tables) and M4
(relational tables -> documents).

Every table is a lazy projection or explode of its source; the writes run
on the executors, and the only driver work is DDL and one orphan count per
link (a single-row aggregate each).
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera import fixed as FX
from tessera.operators import relations as RL
from tessera.operators.common import qcol
from tessera.operators.reshape import rename_columns, split_collections, table_to_documents
from tessera.session import ensure_checkpoint_dir
from tessera.sources import batches as BT
from tessera.sources import jdbc as JD
from tessera.sources.sinks import write_documents


@dataclass
class JdbcTarget:
    url: str
    properties: Mapping[str, str] | None = None
    text_type: str | None = None     # default: the database's type for long texts
    key_type: str = FX.KEY_COLUMN_TYPE
    batchsize: int = FX.INSERT_BATCH_ROWS
    num_partitions: int | None = None
    add_foreign_keys: bool = True
    schema: str | None = None        # existing schema to write into
    new_schema: str | None = None    # S11: create a fresh schema named after this
    schema_keyword: str = "SCHEMA"   # "DATABASE" for MySQL
    batch: str | None = None         # write all tables once, as this batch


@dataclass
class CatalogTarget:
    """Tables in a fresh Spark-catalog database named after ``database``
    (S11: ``database``, else ``database_0``, ``database_1``, ...). Spark
    tables hold no constraints, so the primary key is kept as the table
    property ``primary_key`` and each link as ``foreign_key.<field>`` =
    ``<table>.<field>`` (read back by ``profile_catalog_tables``); the fields
    of a composite key are a JSON list there."""
    database: str
    fmt: str = "parquet"
    location: str | None = None


@dataclass
class PathTarget:
    """Tables as files (``<path>/<table>``) in any Spark format."""
    path: str
    fmt: str = "parquet"
    mode: str = "errorifexists"


def orphan_counts(tables: Mapping[str, DataFrame], edges: Iterable[tuple[str, str, str, str]]) -> DataFrame:
    """R8 for a list of links: ``from_table, from_field, to_table, to_field,
    n_orphans`` (child rows whose key has no parent); the fields of a
    composite key are joined by commas."""
    return RL.check_links(tables, edges).select(
        "from_table", F.array_join("from_fields", ",").alias("from_field"),
        "to_table", F.array_join("to_fields", ",").alias("to_field"), "n_orphans")


def load_order(tables: Iterable[str], links: Iterable[RL.Link | Sequence]) -> tuple[list[str], list[list[str]]]:
    """The tables so that each comes after those it refers to, and the cycles:
    groups of tables that refer to each other (or one to itself), in which no
    such order exists. A cycle's tables stay together, in the order given,
    after all that any of them needs. The link graph is as large as the
    schema."""
    tables = list(tables)
    needs: dict[str, list[str]] = {t: [] for t in tables}
    for link in map(RL.Link.of, links):
        if link.from_table in needs and link.to_table in needs:
            needs[link.from_table].append(link.to_table)

    def reached(start: str) -> set[str]:
        seen, todo = set(), list(needs[start])
        while todo:
            t = todo.pop()
            if t not in seen:
                seen.add(t)
                todo += needs[t]
        return seen

    reach = {t: reached(t) for t in tables}
    groups: list[list[str]] = []
    for t in tables:
        if not any(t in g for g in groups):
            groups.append([t] + [o for o in tables if o != t and o in reach[t] and t in reach[o]])
    order: list[str] = []
    while groups:
        ready = next(g for g in groups if all(n in order or n in g for t in g for n in needs[t]))
        order += ready
        groups.remove(ready)
    cycles: list[list[str]] = []
    for t in order:
        if t in reach[t] and not any(t in c for c in cycles):
            cycles.append([o for o in order if o == t or (o in reach[t] and t in reach[o])])
    return order, cycles


@dataclass
class Migration:
    """What ``plan_migration`` makes of collections: the tables in load order,
    their keys and links under the new names, and the cycles among them."""
    tables: dict[str, DataFrame]
    primary_keys: dict[str, tuple[str, ...]]
    links: list[RL.Link]
    cycles: list[list[str]]


def plan_migration(collections: Mapping[str, DataFrame], keys: Mapping[str, str | Sequence[str]] | None = None,
                   tables: Iterable[str] | None = None, renames: Mapping[str, Mapping[str, str]] | None = None,
                   primary_keys: Mapping[str, str | Sequence[str]] | None = None,
                   edges: Iterable[RL.Link | Sequence] = (), orders: Mapping[str, Sequence[str]] | None = None,
                   embedded_links: bool = False) -> Migration:
    """The tables of several linked collections for one target (N2-N6), with
    the user's choice of tables (S13), column order (F11), renames of columns,
    keys and both ends of links (F6, F7). With ``embedded_links`` every child
    table is linked to the row of its parent, and tables without a primary key
    get the columns that tell their rows apart."""
    wanted = None if tables is None else set(tables)
    split = [t for t in split_collections(collections, keys) if wanted is None or t.name in wanted]
    names = {t.name for t in split}
    links = [RL.Link.of(e) for e in edges]
    own_keys = {t: (k,) if isinstance(k, str) else tuple(k) for t, k in (primary_keys or {}).items() if t in names}
    if embedded_links:
        links += [RL.Link(t.name, tuple(c for c, _ in t.link), t.parent, tuple(p for _, p in t.link)) for t in split if t.parent in names]
        own_keys = {t.name: t.keys for t in split if t.keys} | own_keys
    frames = {}
    for t in split:
        order = (orders or {}).get(t.name)
        frames[t.name] = t.df if order is None else t.df.select(*[qcol(c) for c in dict.fromkeys([*(k for k in t.keys if k not in order), *order])])
    links = [k.checked(frames) for k in links]

    def new(t: str, fields: Iterable[str]) -> tuple[str, ...]:
        return tuple((renames or {}).get(t, {}).get(f, f) for f in fields)

    frames = {t: rename_columns(df, (renames or {}).get(t, {})) for t, df in frames.items()}
    links = [RL.Link(k.from_table, new(k.from_table, k.from_fields), k.to_table, new(k.to_table, k.to_fields)) for k in links]
    order, cycles = load_order(frames, links)
    return Migration({t: frames[t] for t in order}, {t: new(t, k) for t, k in own_keys.items()}, links, cycles)


def migrate_collections(collections: Mapping[str, DataFrame], target: JdbcTarget | PathTarget | CatalogTarget,
                        keys: Mapping[str, str | Sequence[str]] | None = None, tables: Iterable[str] | None = None,
                        renames: Mapping[str, Mapping[str, str]] | None = None,
                        primary_keys: Mapping[str, str | Sequence[str]] | None = None,
                        edges: Iterable[RL.Link | Sequence] = (), orders: Mapping[str, Sequence[str]] | None = None,
                        embedded_links: bool = False, strict: bool = True, materialize: bool = False) -> dict[str, DataFrame]:
    """M2 for several collections and the links between them: split all
    (``plan_migration``), check every link on the data in one job (R8), then
    write the tables into one target, parents first (S8 with S14/F12, or
    files). Constraints are added after all tables are loaded, so tables that
    refer to each other in a cycle can be loaded too.

    ``edges`` are ``(from_table, from_field, to_table, to_field)`` under the
    old names, with lists of fields for composite keys. With ``strict`` a link
    with orphans raises before anything is written. Returns the tables (lazy)
    by name, in load order.

    Every table (and the link check) reads its documents again. For a plain
    columnar scan that is cheap - each table reads only its own columns. When
    the documents come out of costly upstream work (joins, parsing),
    ``materialize=True`` writes them once with ``checkpoint()`` into the
    shared ``spark.checkpoint.dir`` and cuts the lineage there.
    """
    spark = next(iter(collections.values())).sparkSession
    if materialize:
        ensure_checkpoint_dir(spark)
        collections = {n: df.checkpoint(eager=True) for n, df in collections.items()}
    plan = plan_migration(collections, keys, tables, renames, primary_keys, edges, orders, embedded_links)
    if plan.links and strict:
        bad = orphan_counts(plan.tables, plan.links).where(F.col("n_orphans") > 0).collect()
        if bad:
            raise ValueError(f"links with orphan rows: {[tuple(r) for r in bad]}")
    if isinstance(target, PathTarget):
        for t, df in plan.tables.items():
            df.write.format(target.fmt).mode(target.mode).save(f"{target.path.rstrip('/')}/{t}")
        return plan.tables
    if isinstance(target, CatalogTarget):
        db = write_catalog_tables(plan.tables, target, plan.primary_keys, plan.links)
        return {t: spark.table(f"`{db}`.`{t}`") for t in plan.tables}
    schema = target.schema
    if target.new_schema:
        schema = JD.create_schema(spark, target.url, target.new_schema, target.schema_keyword,
                                  target.properties)
    quote, type_of = JD.quoter(spark, target.url), JD.type_namer(spark, target.url)
    text_type = target.text_type or type_of(T.StringType())
    linked: dict[str, set[str]] = {}
    for k in plan.links:
        linked.setdefault(k.from_table, set()).update(k.from_fields)
        linked.setdefault(k.to_table, set()).update(k.to_fields)
    types = {t: JD.target_column_types(JD.to_writable(df), plan.primary_keys.get(t), linked.get(t, ()), text_type,
                                       target.key_type, type_of=type_of) for t, df in plan.tables.items()}
    if target.batch is not None:
        if not BT.write_tables_once(plan.tables, target.url, target.batch, plan.primary_keys, types, target.batchsize,
                                    target.num_partitions, target.properties, schema):
            return plan.tables
    else:
        for t, df in plan.tables.items():
            JD.write_table(df, target.url, t, plan.primary_keys.get(t), types[t], batchsize=target.batchsize,
                           num_partitions=target.num_partitions, properties=target.properties, schema=schema)
    if target.add_foreign_keys and plan.links:
        others = {(k.to_table, k.to_fields): None for k in plan.links if k.to_fields != plan.primary_keys.get(k.to_table)}
        JD.execute_ddl(spark, target.url, [
            JD.unique_sql(t, fields, schema, quote) for t, fields in others] + [
            JD.foreign_key_sql(k.from_table, k.from_fields, k.to_table, k.to_fields, schema=schema, quote=quote) for k in plan.links],
            target.properties)
    return plan.tables


def migrate_documents(docs: DataFrame, name: str, target: JdbcTarget | PathTarget | CatalogTarget,
                      key: str | Sequence[str] | None = None, tables: Iterable[str] | None = None,
                      renames: Mapping[str, Mapping[str, str]] | None = None,
                      primary_keys: Mapping[str, str | Sequence[str]] | None = None,
                      edges: Iterable[RL.Link | Sequence] = (), strict: bool = True,
                      materialize: bool = False, **options) -> dict[str, DataFrame]:
    """M2 for one collection: ``migrate_collections`` of ``{name: docs}``."""
    return migrate_collections({name: docs}, target, None if key is None else {name: key}, tables, renames, primary_keys,
                               edges, strict=strict, materialize=materialize, **options)


def write_catalog_tables(tables: Mapping[str, DataFrame], target: CatalogTarget,
                         primary_keys: Mapping[str, str | Sequence[str]] | None = None,
                         links: Iterable[RL.Link | Sequence] = ()) -> str:
    """S8/S14 for Spark catalogs: create a fresh database (S11) and every
    table in it with ``writeTo().create()``, keeping the primary key and the
    links as table properties. Returns the database name."""
    spark = next(iter(tables.values())).sparkSession
    db = JD.create_target_database(spark, target.database, target.location)
    links = [RL.Link.of(k) for k in links]
    for t, df in tables.items():
        w = df.writeTo(f"`{db}`.`{t}`").using(target.fmt)
        pk = (primary_keys or {}).get(t)
        if pk:
            w = w.tableProperty("primary_key", declared(pk))
        for k in links:
            if k.from_table == t:
                w = w.tableProperty(f"foreign_key.{declared(k.from_fields)}", f"{k.to_table}.{declared(k.to_fields)}")
        w.create()
    return db


def declared(fields: str | Sequence[str]) -> str:
    """Fields as table properties hold them: one name as it is, several as
    JSON."""
    fields = [fields] if isinstance(fields, str) else list(fields)
    return fields[0] if len(fields) == 1 else json.dumps(fields)


def migrate_tables(sources: Mapping[str, DataFrame], path: str, fmt: str = "json",
                   mode: str = "errorifexists", as_json_text: bool = False, batch: str | None = None) -> dict[str, str]:
    """M4: every table becomes a collection of flat documents (N7 + S9)
    under ``<path>/<table>``. Keys and links are not carried, as in the
    reference. ``sources`` come from S3 (``read_table``) or any reader. With
    ``batch`` each collection gets the documents once, under that name, however
    often the migration is started (``write_documents_once``)."""
    out = {}
    for t, df in sources.items():
        p = f"{path.rstrip('/')}/{t}"
        docs, kind = table_to_documents(df, as_json=as_json_text), "text" if as_json_text else fmt
        if batch is not None:
            BT.write_documents_once(docs, p, batch, kind)
        else:
            write_documents(docs, p, fmt=kind, mode=mode)
        out[t] = p
    return out


def read_jdbc_tables(spark: SparkSession, url: str, tables: Mapping[str, str | None],
                     num_partitions: int | None = None,
                     properties: Mapping[str, str] | None = None) -> dict[str, DataFrame]:
    """S13 + S3: the named tables (name -> partition column or None)."""
    return {t: JD.read_table(spark, url, t, pc, num_partitions, properties=properties)
            for t, pc in tables.items()}
