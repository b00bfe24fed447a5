"""Relational sources and sinks over JDBC.

Rows always move through Spark's JDBC data source: reads are split into
``num_partitions`` range queries on a numeric column, writes go out from
every partition in ``batchsize`` batches. Only schema work - catalog
metadata (tables, columns, keys) and DDL (CREATE TABLE with its primary
key, ALTER TABLE ... FOREIGN KEY) - uses one driver-side JDBC connection;
those statements carry names, never rows.
"""

from __future__ import annotations

import datetime
import math
from collections.abc import Callable, Iterable, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera import fixed as FX
from tessera.operators.common import qcol


Quote = Callable[[str], str]


def quote(name: str) -> str:
    """ANSI identifier quoting (keeps the case of names)."""
    return '"' + name.replace('"', '""') + '"'


def qualified(table: str, schema: str | None = None, quote: Quote = quote) -> str:
    """``"schema"."table"`` (or just ``"table"``)."""
    return f"{quote(schema)}.{quote(table)}" if schema else quote(table)


def _dialect(spark: SparkSession, url: str):
    return spark.sparkContext._jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(url)


def quoter(spark: SparkSession, url: str) -> Quote:
    """How the database behind ``url`` quotes identifiers, by Spark's dialect
    for it; no connection is made."""
    dialect = _dialect(spark, url)
    return lambda name: dialect.quoteIdentifier(name)


def type_namer(spark: SparkSession, url: str) -> Callable[[T.DataType], str]:
    """The column type of the database behind ``url`` for a Spark type, by
    Spark's dialect for it (nested types as text)."""
    jvm, dialect = spark.sparkContext._jvm, _dialect(spark, url)

    def name(dt: T.DataType) -> str:
        if isinstance(dt, (T.StructType, T.ArrayType, T.MapType)):
            dt = T.StringType()
        own = jvm.org.apache.spark.sql.types.DataType.fromJson(dt.json())
        for found in (dialect.getJDBCType(own), jvm.org.apache.spark.sql.execution.datasources.jdbc.JdbcUtils.getCommonJDBCType(own)):
            if found.isDefined():
                return found.get().databaseTypeDefinition()
        raise ValueError(f"no column type for {dt.simpleString()} at {url.split(':')[1]}")

    return name


@contextmanager
def connection(spark: SparkSession, url: str, properties: Mapping[str, str] | None = None):
    """A driver-side JDBC connection for metadata and DDL only."""
    jvm = spark.sparkContext._jvm
    props = jvm.java.util.Properties()
    for k, v in (properties or {}).items():
        props.setProperty(k, str(v))
    conn = jvm.java.sql.DriverManager.getConnection(url, props)
    try:
        yield conn
    finally:
        conn.close()


def execute_ddl(spark: SparkSession, url: str, statements: Iterable[str],
                properties: Mapping[str, str] | None = None) -> None:
    """Run DDL statements in order; the first failure raises (the reference
    swallows them)."""
    with connection(spark, url, properties) as conn:
        st = conn.createStatement()
        try:
            for s in statements:
                st.execute(s)
        finally:
            st.close()


# --- reads (S3) -------------------------------------------------------------------

def read_table(spark: SparkSession, url: str, table: str, partition_column: str | None = None,
               num_partitions: int | None = None, lower_bound: int | str | None = None,
               upper_bound: int | str | None = None, properties: Mapping[str, str] | None = None,
               quoted: bool = True, fetchsize: int = 10000, schema: str | None = None) -> DataFrame:
    """S3: a whole table as a DataFrame.

    With ``partition_column`` the read is split into ``num_partitions``
    range queries run by the executors in parallel; missing bounds (of
    numbers, dates or times) are fetched with one ``min/max`` query (a single
    row). Without it the table
    is read by one task, which only suits small tables.
    """
    props = dict(properties or {})
    props.setdefault("fetchsize", str(fetchsize))
    q = quoter(spark, url)
    name = qualified(table, schema, q) if quoted else table
    if partition_column is None:
        return spark.read.jdbc(url, name, properties=props)
    pc = q(partition_column) if quoted else partition_column
    if lower_bound is None or upper_bound is None:
        b = (spark.read.format("jdbc").option("url", url)
             .option("query", f"SELECT MIN({pc}) AS lo, MAX({pc}) AS hi FROM {name}")
             .options(**props).load().first())
        if b[0] is None or b[1] is None:  # no value to split by
            return spark.read.jdbc(url, name, properties=props)
        lower_bound, upper_bound = (_bound(b[0], 0) if lower_bound is None else lower_bound,
                                    _bound(b[1], 1) if upper_bound is None else upper_bound)
    n = num_partitions or spark.sparkContext.defaultParallelism
    return (spark.read.format("jdbc").options(**props)
            .options(url=url, dbtable=name, partitionColumn=pc, lowerBound=str(lower_bound),
                     upperBound=str(upper_bound), numPartitions=str(n)).load())


def _bound(value, past: int) -> int | str:
    """A bound as the JDBC source takes it: numbers whole, dates and times as
    text. Bounds only shape the ranges; rows beyond them are read too."""
    if isinstance(value, (datetime.date, datetime.datetime)):
        return str(value)
    return math.floor(value) + past


def read_query(spark: SparkSession, url: str, query: str,
               properties: Mapping[str, str] | None = None) -> DataFrame:
    return (spark.read.format("jdbc").option("url", url).option("query", query)
            .options(**(properties or {})).load())


# --- catalog metadata (S4-S7, for M3) --------------------------------------------

def _rows(rs, cols):
    out = []
    while rs.next():
        out.append(tuple(rs.getString(c) if kind == "s" else rs.getInt(c) for c, kind in cols))
    rs.close()
    return out


def _pattern(name: str, escape: str) -> str:
    """A table name as a metadata pattern that fits it alone."""
    for c in (escape, "_", "%"):
        if c:
            name = name.replace(c, escape + c)
    return name


def list_tables(spark: SparkSession, url: str, schema: str | None = None,
                properties: Mapping[str, str] | None = None) -> DataFrame:
    """``table_name`` of every base table of the connected database (the
    connection's catalog), in ``schema`` if given."""
    sc = spark.sparkContext
    kinds = sc._gateway.new_array(sc._jvm.java.lang.String, 1)
    kinds[0] = "TABLE"
    with connection(spark, url, properties) as conn:
        rs = conn.getMetaData().getTables(conn.getCatalog(), schema, "%", kinds)
        rows = _rows(rs, [("TABLE_NAME", "s")])
    return spark.createDataFrame(rows, "table_name string")


def table_columns(spark: SparkSession, url: str, tables: Iterable[str] | None = None,
                  schema: str | None = None, properties: Mapping[str, str] | None = None) -> DataFrame:
    """``table_name, position, field_name, field_type, size, nullable``;
    ``nullable`` is the JDBC code as text (0 no, 1 yes, 2 unknown), as the
    reference reports it."""
    with connection(spark, url, properties) as conn:
        tables = None if tables is None else list(tables)
        md = conn.getMetaData()
        names = [_pattern(t, md.getSearchStringEscape()) for t in tables] if tables is not None else ["%"]
        found = [r for name in names for r in _rows(md.getColumns(conn.getCatalog(), schema, name, "%"), [
            ("TABLE_NAME", "s"), ("ORDINAL_POSITION", "i"), ("COLUMN_NAME", "s"),
            ("TYPE_NAME", "s"), ("COLUMN_SIZE", "i"), ("NULLABLE", "s")])]
    wanted = None if tables is None else set(tables)  # some drivers have no escape
    rows = list(dict.fromkeys(r for r in found if wanted is None or r[0] in wanted))
    return spark.createDataFrame(
        rows, "table_name string, position int, field_name string, field_type string, "
              "size int, nullable string")


def declared_primary_keys(spark: SparkSession, url: str, tables: Iterable[str],
                          schema: str | None = None,
                          properties: Mapping[str, str] | None = None) -> DataFrame:
    """``table_name, primary_key (array, key order), last_key``.
    ``last_key`` is the reference's value: only the last column of a
    composite key survives there."""
    rows = []
    with connection(spark, url, properties) as conn:
        md = conn.getMetaData()
        for t in tables:
            rows += _rows(md.getPrimaryKeys(conn.getCatalog(), schema, t),
                          [("TABLE_NAME", "s"), ("COLUMN_NAME", "s"), ("KEY_SEQ", "i")])
    df = spark.createDataFrame(rows, "table_name string, column_name string, key_seq int")
    return (df.groupBy("table_name")
            .agg(F.transform(F.array_sort(F.collect_list(F.struct("key_seq", "column_name"))),
                             lambda s: s["column_name"]).alias("primary_key"))
            .select("table_name", "primary_key", F.element_at("primary_key", -1).alias("last_key")))


def declared_links(spark: SparkSession, url: str, tables: Iterable[str], schema: str | None = None,
                   properties: Mapping[str, str] | None = None) -> list[tuple[str, tuple[str, ...], str, tuple[str, ...]]]:
    """The declared foreign keys, each with all its fields in order:
    ``(from_table, from_fields, to_table, to_fields)``."""
    out = []
    with connection(spark, url, properties) as conn:
        md = conn.getMetaData()
        for t in tables:
            rows = _rows(md.getImportedKeys(conn.getCatalog(), schema, t),
                         [("KEY_SEQ", "i"), ("FK_NAME", "s"), ("FKTABLE_NAME", "s"), ("FKCOLUMN_NAME", "s"),
                          ("PKTABLE_NAME", "s"), ("PKCOLUMN_NAME", "s")])
            keys: list[list[tuple]] = []
            for seq, name, *ends in rows:  # by key, then by field
                same = [k for k in keys if name is not None and k[0][1] == name and k[0][4] == ends[2]]
                if same and seq > 1:
                    same[0].append((seq, name, *ends))
                elif seq > 1 and name is None and keys:
                    keys[-1].append((seq, name, *ends))
                else:
                    keys.append([(seq, name, *ends)])
            for k in keys:
                k.sort()
                out.append((k[0][2], tuple(x[3] for x in k), k[0][4], tuple(x[5] for x in k)))
    return out


def declared_foreign_keys(spark: SparkSession, url: str, tables: Iterable[str],
                          schema: str | None = None,
                          properties: Mapping[str, str] | None = None) -> DataFrame:
    """``from_table, from_field, to_table, to_field`` of declared keys,
    one row per field."""
    rows = [(ft, a, tt, b) for ft, ff, tt, tf in declared_links(spark, url, tables, schema, properties) for a, b in zip(ff, tf, strict=True)]
    return spark.createDataFrame(
        rows, "from_table string, from_field string, to_table string, to_field string")


# --- writes (S8, S11, S14, F12) ---------------------------------------------------

#: A type for texts of any length.
TEXT_TYPE = "CLOB"


def sql_type(dt: T.DataType, text_type: str = TEXT_TYPE) -> str:
    """A portable SQL type for a Spark type (nested types as text)."""
    if isinstance(dt, T.StringType):
        return text_type
    if isinstance(dt, T.LongType):
        return "BIGINT"
    if isinstance(dt, (T.IntegerType, T.ShortType, T.ByteType)):
        return "INTEGER"
    if isinstance(dt, (T.DoubleType, T.FloatType)):
        return "DOUBLE"
    if isinstance(dt, T.DecimalType):
        return f"DECIMAL({dt.precision},{dt.scale})"
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        return "TIMESTAMP"
    if isinstance(dt, T.DateType):
        return "DATE"
    if isinstance(dt, T.BooleanType):
        return "BOOLEAN"
    if isinstance(dt, T.BinaryType):
        return "BLOB"
    return text_type


def target_column_types(df: DataFrame, primary_key: str | Iterable[str] | None = None,
                        fk_columns: Iterable[str] = (), text_type: str = TEXT_TYPE,
                        key_type: str = FX.KEY_COLUMN_TYPE,
                        object_ids: Iterable[str] = (),
                        type_of: Callable[[T.DataType], str] | None = None) -> dict[str, str]:
    """the SQL type of every column of a target table.

    ObjectId columns (``object_ids``, text after N5) -> ``key_type``;
    text-like columns (string, struct, array) -> ``key_type`` when they are
    the primary key or a foreign-key source, else ``text_type``; other
    types map to their SQL equivalent. Deviations from the reference: the
    foreign-key sources are matched by (table, column), not by name across
    all tables, and a string primary key becomes ``key_type`` instead of
    the invalid type name ``string``.
    """
    fks = set(fk_columns) | set([primary_key] if isinstance(primary_key, str) else primary_key or ())
    oids = set(object_ids)
    out = {}
    for f in df.schema.fields:
        texty = isinstance(f.dataType, (T.StringType, T.StructType, T.ArrayType, T.MapType))
        if f.name in oids:
            out[f.name] = key_type
        elif texty and f.name in fks:
            out[f.name] = key_type
        elif texty:
            out[f.name] = text_type
        else:
            out[f.name] = type_of(f.dataType) if type_of else sql_type(f.dataType, text_type)
    return out


def create_table_sql(table: str, columns: Mapping[str, str], primary_key: str | Iterable[str] | None = None,
                     not_null: Iterable[str] = (), schema: str | None = None, quote: Quote = quote) -> str:
    """``CREATE TABLE t (col type, ..., PRIMARY KEY (...))``."""
    pk = [primary_key] if isinstance(primary_key, str) else list(primary_key or [])
    nn = set(not_null) | set(pk)
    cols = [f"{quote(c)} {t}{' NOT NULL' if c in nn else ''}" for c, t in columns.items()]
    if pk:
        cols.append(f"PRIMARY KEY ({', '.join(quote(c) for c in pk)})")
    return f"CREATE TABLE {qualified(table, schema, quote)} ({', '.join(cols)})"


def foreign_key_sql(from_table: str, from_field: str | Iterable[str], to_table: str, to_field: str | Iterable[str],
                    schema: str | None = None, quote: Quote = quote) -> str:
    """R8 as DDL: ``ALTER TABLE ... ADD FOREIGN KEY ... REFERENCES ...``."""
    ends = [", ".join(quote(x) for x in ([f] if isinstance(f, str) else f)) for f in (from_field, to_field)]
    return (f"ALTER TABLE {qualified(from_table, schema, quote)} ADD FOREIGN KEY ({ends[0]}) "
            f"REFERENCES {qualified(to_table, schema, quote)} ({ends[1]})")


def unique_sql(table: str, fields: Iterable[str], schema: str | None = None, quote: Quote = quote) -> str:
    """``ALTER TABLE ... ADD UNIQUE (...)``: what a foreign key may refer to
    besides a primary key."""
    return f"ALTER TABLE {qualified(table, schema, quote)} ADD UNIQUE ({', '.join(quote(f) for f in fields)})"


def to_writable(df: DataFrame) -> DataFrame:
    """Nested columns become JSON text so any database can store them."""
    cols = []
    for f in df.schema.fields:
        c = qcol(f.name)
        if isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType)):
            c = F.to_json(c)
        cols.append(c.alias(f.name))
    return df.select(*cols)


def write_table(df: DataFrame, url: str, table: str, primary_key: str | Iterable[str] | None = None,
                column_types: Mapping[str, str] | None = None, create: bool = True,
                batchsize: int = FX.INSERT_BATCH_ROWS, num_partitions: int | None = None,
                properties: Mapping[str, str] | None = None, isolation: str = "READ_COMMITTED",
                schema: str | None = None) -> None:
    """S8 (+S14, F12): create the table with its primary key, then insert
    every row from the executors in ``batchsize`` batches.

    ``num_partitions`` caps the concurrent connections (coalesce, no
    shuffle). A failing statement raises instead of being swallowed.
    """
    out = to_writable(df)
    q, type_of = quoter(df.sparkSession, url), type_namer(df.sparkSession, url)
    if create:
        types = dict(column_types or target_column_types(out, primary_key, text_type=type_of(T.StringType()), type_of=type_of))
        execute_ddl(df.sparkSession, url, [create_table_sql(table, types, primary_key, schema=schema, quote=q)],
                    properties)
    if num_partitions is not None and out.rdd.getNumPartitions() > num_partitions:
        out = out.coalesce(num_partitions)
    props = dict(properties or {})
    props["batchsize"] = str(batchsize)
    props["isolationLevel"] = isolation
    out.write.jdbc(url, qualified(table, schema, q), mode="append", properties=props)


def free_database_name(spark: SparkSession, base: str) -> str:
    """``base`` if no such database exists in the Spark catalog, else the
    first free ``base_0``, ``base_1``, ... (catalog metadata only)."""
    if not spark.catalog.databaseExists(base):
        return base
    i = 0
    while spark.catalog.databaseExists(f"{base}_{i}"):
        i += 1
    return f"{base}_{i}"


def create_target_database(spark: SparkSession, base: str, location: str | None = None) -> str:
    """Create and return a fresh database named after ``base``."""
    name = free_database_name(spark, base)
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE `{name}`{loc}")
    return name


def free_schema_name(spark: SparkSession, url: str, base: str,
                     properties: Mapping[str, str] | None = None) -> str:
    """S11 for JDBC targets: ``base`` if the database has no schema (or
    catalog, as MySQL calls databases) of that name, else the first free
    ``base_0``, ``base_1``, ... Case-insensitive, from catalog metadata."""
    with connection(spark, url, properties) as conn:
        md = conn.getMetaData()
        taken = {r[0].lower() for r in _rows(md.getSchemas(), [("TABLE_SCHEM", "s")]) if r[0]}
        taken |= {r[0].lower() for r in _rows(md.getCatalogs(), [("TABLE_CAT", "s")]) if r[0]}
    if base.lower() not in taken:
        return base
    i = 0
    while f"{base}_{i}".lower() in taken:
        i += 1
    return f"{base}_{i}"


def create_schema(spark: SparkSession, url: str, base: str, keyword: str = "SCHEMA",
                  properties: Mapping[str, str] | None = None) -> str:
    """Create a fresh schema (``keyword="DATABASE"`` for MySQL) and
    return its name."""
    name = free_schema_name(spark, url, base, properties)
    execute_ddl(spark, url, [f"CREATE {keyword} {quoter(spark, url)(name)}"], properties)
    return name
