"""Writes that take effect once (S8, S9): a batch is staged by the executors
and then published in one step under its name.

Spark runs a task again when its executor is lost, also after the task's rows
have reached the database, and a job that failed half way is started again as a
whole. Rows written straight into a target are then there twice. Here

* for databases (``write_tables_once``) every task writes its rows, marked
  with its partition and attempt, into staging tables; one transaction moves
  one attempt of every partition into all target tables and enters the batch
  into the table ``BATCHES``. A task's rows are one transaction, so an attempt
  is there whole or not at all;
* for folders (``write_documents_once``) files are written into a staging
  folder, which is renamed to ``<path>/batch=<name>``.

Nobody sees a part of a batch, and a batch that is published already is left
as it is, also where two jobs publish it at the same time.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator, Mapping

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tessera import fixed as FX
from tessera.sources import jdbc as JD
from tessera.sources.sinks import write_documents

BATCHES = "tessera_batches"
PART, ATTEMPT = "tessera_part", "tessera_attempt"


def _marked(df: DataFrame) -> DataFrame:
    """The rows with their task's partition and attempt."""
    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        for b in batches:
            marks = [pa.array([v] * b.num_rows, pa.int64()) for v in (task.partitionId(), task.taskAttemptId())]
            yield pa.RecordBatch.from_arrays([*b.columns, *marks], [*b.schema.names, PART, ATTEMPT])

    schema = T.StructType([*df.schema.fields, T.StructField(PART, T.LongType()), T.StructField(ATTEMPT, T.LongType())])
    return df.mapInArrow(mark, schema)


def _exists(spark: SparkSession, url: str, table: str, schema: str | None, properties: Mapping[str, str] | None) -> bool:
    with JD.connection(spark, url, properties) as conn:
        found = conn.getMetaData().getTables(conn.getCatalog(), schema, None, None)
        while found.next():
            if found.getString("TABLE_NAME").casefold() == table.casefold():
                return True
    return False


def published(spark: SparkSession, url: str, batch: str, properties: Mapping[str, str] | None = None,
              schema: str | None = None) -> bool:
    """Whether a database holds the batch."""
    if not _exists(spark, url, BATCHES, schema, properties):
        return False
    name = JD.qualified(BATCHES, schema, JD.quoter(spark, url))
    with JD.connection(spark, url, properties) as conn:
        ask = conn.prepareStatement(f"SELECT COUNT(*) FROM {name} WHERE batch_id = ?")
        ask.setString(1, batch)
        rows = ask.executeQuery()
        rows.next()
        return rows.getLong(1) > 0


def stage_table(df: DataFrame, url: str, table: str, columns: Mapping[str, str], batchsize: int = FX.INSERT_BATCH_ROWS,
                num_partitions: int | None = None, properties: Mapping[str, str] | None = None, schema: str | None = None) -> None:
    """Write the rows into the (existing) staging table ``table``."""
    rows = _marked(df if num_partitions is None else df.coalesce(num_partitions))
    JD.write_table(rows, url, table, column_types=columns, create=False, batchsize=batchsize, properties=properties, schema=schema)


def publish_sql(staged: str, target: str, columns: Iterable[str], quote: Callable[[str], str]) -> str:
    """The statement that moves one attempt of every partition (all attempts
    of a partition hold the same rows)."""
    cols, part, attempt = [quote(c) for c in columns], quote(PART), quote(ATTEMPT)
    return (f"INSERT INTO {target} ({', '.join(cols)}) SELECT {', '.join('s.' + c for c in cols)} FROM {staged} s JOIN "
            f"(SELECT {part} AS p, MIN({attempt}) AS a FROM {staged} GROUP BY {part}) k ON s.{part} = k.p AND s.{attempt} = k.a")


def write_tables_once(tables: Mapping[str, DataFrame], url: str, batch: str,
                      primary_keys: Mapping[str, str | Iterable[str]] | None = None,
                      column_types: Mapping[str, Mapping[str, str]] | None = None, batchsize: int = FX.INSERT_BATCH_ROWS,
                      num_partitions: int | None = None, properties: Mapping[str, str] | None = None,
                      schema: str | None = None) -> bool:
    """Append tables, in load order, to a database as one batch: all of their
    rows or none. Target tables that are missing are created first. Returns
    False, and writes nothing, where the batch is published already.

    Staging tables have names of their own for each call, so what a failed job
    left behind is never read; this call drops its own. Partitions must come
    out alike when computed again (no random split): store such input first.
    """
    spark = next(iter(tables.values())).sparkSession
    if published(spark, url, batch, properties, schema):
        return False
    q, type_of = JD.quoter(spark, url), JD.type_namer(spark, url)
    full = lambda t: JD.qualified(t, schema, q)
    if not _exists(spark, url, BATCHES, schema, properties):
        JD.execute_ddl(spark, url, [f"CREATE TABLE {full(BATCHES)} (batch_id VARCHAR(255) NOT NULL, PRIMARY KEY (batch_id))"], properties)
    staged: dict[str, str] = {}
    try:
        moves = []
        for t, df in tables.items():
            pk = (primary_keys or {}).get(t)
            out = JD.to_writable(df)
            types = dict((column_types or {}).get(t) or JD.target_column_types(out, pk, text_type=type_of(T.StringType()), type_of=type_of))
            if not _exists(spark, url, t, schema, properties):
                JD.execute_ddl(spark, url, [JD.create_table_sql(t, types, pk, schema=schema, quote=q)], properties)
            name = f"tessera_{uuid.uuid4().hex[:20]}"
            marks = {c: type_of(T.LongType()) for c in (PART, ATTEMPT)}
            JD.execute_ddl(spark, url, [JD.create_table_sql(name, types | marks, schema=schema, quote=q)], properties)
            staged[t] = name
            stage_table(out, url, name, types | marks, batchsize, num_partitions, properties, schema)
            moves.append(publish_sql(full(name), full(t), out.columns, q))
        return _publish(spark, url, batch, moves, full(BATCHES), properties, schema)
    finally:
        JD.execute_ddl(spark, url, [f"DROP TABLE {full(n)}" for n in staged.values()], properties)


def _publish(spark: SparkSession, url: str, batch: str, moves: list[str], batches: str,
             properties: Mapping[str, str] | None, schema: str | None) -> bool:
    with JD.connection(spark, url, properties) as conn:
        conn.setAutoCommit(False)
        try:
            # The batch first: its key holds back a second job until this one
            # is through.
            enter = conn.prepareStatement(f"INSERT INTO {batches} (batch_id) VALUES (?)")
            enter.setString(1, batch)
            enter.executeUpdate()
            st = conn.createStatement()
            for sql in moves:
                st.executeUpdate(sql)
            conn.commit()
            return True
        except Exception:
            conn.rollback()
            if published(spark, url, batch, properties, schema):
                return False  # another job has been faster
            raise


def write_documents_once(df: DataFrame, path: str, batch: str, fmt: str = "json", **options) -> bool:
    """Append documents to a folder as one batch, in ``<path>/batch=<batch>``;
    readers of ``path`` see the batches as the column ``batch``. Returns False
    where the batch is there already. The rename is one step on file systems
    that have one (HDFS, mounted folders), not on object stores."""
    spark = df.sparkSession
    if not batch or batch.startswith((".", "_")) or any(c in batch for c in '/\\:=%"\'*?{}[]#'):
        raise ValueError(f"batch name {batch!r} cannot name a folder")
    hadoop, conf = spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()
    base = path.rstrip("/")
    staging, final = (hadoop.Path(f"{base}/{n}") for n in (f"_staging/{batch}-{uuid.uuid4().hex}", f"batch={batch}"))
    fs = final.getFileSystem(conf)
    if fs.exists(final):
        return False
    try:
        write_documents(df, staging.toString(), fmt, **options)
        files = hadoop.FileContext.getFileContext(fs.getUri(), conf)
        try:
            files.rename(fs.makeQualified(staging), fs.makeQualified(final),
                         spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 0))
        except Exception:
            if fs.exists(final):
                return False  # another job has been faster
            raise
        return True
    finally:
        fs.delete(staging, True)
