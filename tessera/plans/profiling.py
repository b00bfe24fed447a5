"""Composite profiling entry points: M1 (documents), M3 (JDBC tables) and
the nested report N8.

M1 runs two data actions whose results are bounded by the schema (the list
of unique columns per collection, and the final report); everything else
stays a lazy DataFrame.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera import fixed as FX
from tessera.operators import fields as FL
from tessera.operators import relations as RL
from tessera.operators.common import union_all
from tessera.operators.reshape import collapse_ids
from tessera.sources import jdbc as JD


@dataclass
class Profile:
    fields: DataFrame        # one row per field of every table, with keys and links
    primary_keys: DataFrame  # table_name, primary_key
    foreign_keys: DataFrame  # from_table, from_field, to_table, to_field
    edges: DataFrame         # R9: from, fromPort, to, toPort
    matches: DataFrame       # R1-R4 raw matches
    unique: dict[str, list[str]]

    def tables(self) -> DataFrame:
        return tables_report(self.fields)

    def report_json(self) -> DataFrame:
        return report_json(self.tables())


def profile_documents(collections: Mapping[str, DataFrame], n_samples: int | None = None,
                      order_by: Mapping[str, str] | None = None, mode: str = "text",
                      reset_pk: bool = True, overrides: Mapping[str, str] | None = None,
                      with_stats: bool = False, id_column: str = RL.ID,
                      tables: list[str] | None = None) -> Profile:
    """M1: S1 -> N5 -> N1 -> A3 -> S12 -> R1-R4 -> R5 -> R6/R7/R10 -> N8.

    ``collections`` maps names to document DataFrames in the order the
    reference would visit them (that order ranks the matches); ``tables``
    keeps only the named ones (S13). With ``with_stats`` the field rows also
    carry N1's counts and lengths.
    """
    wanted = None if tables is None else set(tables)
    cols = {n: collapse_ids(df) for n, df in collections.items() if wanted is None or n in wanted}
    # Keys of the report are the columns matching can use (A3 on those).
    unique = RL.unique_key_lists(cols, id_column=id_column, mode=mode)
    matches = RL.match_sample(cols, unique, order_by, n_samples, mode, id_column=id_column)
    fks = RL.assign_foreign_keys(matches)
    pks = RL.assign_primary_keys(matches, list(cols), reset_pk=reset_pk, overrides=overrides,
                                 foreign_keys=fks, id_column=id_column)
    profile = FL.field_profile if with_stats else FL.schema_fields
    flds = union_all([profile(df, n, id_column).withColumn("collection", F.lit(n)) for n, df in cols.items()])
    spark = flds.sparkSession
    places = spark.createDataFrame(
        [(n, t.name, f.name, i) for n, df in cols.items() for t in FL.walk(df.schema, n, id_column) for i, f in enumerate(t.fields)],
        "collection string, table_name string, field_name string, position int")
    flds = flds.join(F.broadcast(places), ["collection", "table_name", "field_name"])
    # Links and keys belong to the collections' root tables only, as in the
    # reference; embedded tables keep the default key.
    root = F.col("relation") == F.lit(FL.ROOT)
    f = (flds.join(fks.withColumn("__root", F.lit(True)),
                   (flds["table_name"] == fks["from_table"]) & (flds["field_name"] == fks["from_field"])
                   & root, "left")
         .drop("from_table", "from_field", "__root")
         .withColumnRenamed("to_table", "ref_table").withColumnRenamed("to_field", "ref_field"))
    f = (f.join(pks.withColumn("__is_root", F.lit(True)), "table_name", "left")
         .withColumn("primary_key", F.when(root & F.col("__is_root"), F.col("primary_key"))
                     .otherwise(F.lit(id_column)))
         .drop("__is_root"))
    return Profile(f, pks, fks, RL.link_edges(fks), matches, unique)


def tables_report(fields: DataFrame) -> DataFrame:
    """One row per table, ``name, primaryKey, path, relation, fields``
    where ``fields`` is an array of ``struct<name, type, nullable,
    length<min,max>, relationship<tableName, fieldName>>``. Missing links
    print as ``""`` in this report only."""
    has_len = "len_min" in fields.columns
    lo = F.coalesce(F.col("len_min"), F.lit(0)) if has_len else F.lit(0).cast("bigint")
    hi = F.coalesce(F.col("len_max"), F.lit(0)) if has_len else F.lit(0).cast("bigint")
    item = F.struct(
        F.col("field_name").alias("name"), F.col("field_type").alias("type"),
        F.col("nullable").cast("string").alias("nullable"),
        F.struct(lo.alias("min"), hi.alias("max")).alias("length"),
        F.struct(F.coalesce("ref_table", F.lit("")).alias("tableName"),
                 F.coalesce("ref_field", F.lit("")).alias("fieldName")).alias("relationship"))
    # Fields stay in schema order; tables of one name and different
    # collections stay apart.
    keys = [F.col(c) for c in ("collection", "path", "relation") if c in fields.columns]
    place = F.col("position") if "position" in fields.columns else F.lit(0)
    return (fields.groupBy(F.col("table_name").alias("name"), F.col("primary_key").alias("primaryKey"), *keys)
            .agg(F.transform(F.array_sort(F.collect_list(F.struct(place.alias("position"), item.alias("item")))),
                             lambda x: x["item"]).alias("fields")))


def report_json(tables: DataFrame, status: str = FX.REPORT_STATUS,
                message: str = FX.REPORT_MESSAGE) -> DataFrame:
    """The whole report as one JSON text ``{status, message, tables: [...]}``.
    One row; its size is bounded by the number of tables and fields."""
    return tables.agg(F.to_json(F.struct(
        F.lit(status).alias("status"), F.lit(message).alias("message"),
        F.array_sort(F.collect_list(F.struct(*[F.col(c) for c in tables.columns]))).alias("tables")
    )).alias("report"))


KEY_COUNTS = ["n_rows", "key_nulls", "key_duplicates"]
LINK_COUNTS = ["ref_nulls", "ref_orphans", "ref_duplicates"]


def declared_profile(columns: DataFrame, keys: Mapping[str, Sequence[str]], links: Iterable[RL.Link | Sequence],
                     tables: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """The columns of some tables (``table_name, field_name, ...``) with the
    key and the links declared for them: ``primary_key`` (all its fields),
    ``primary_key_last`` (the reference's value), ``ref_table``, ``ref_field``;
    one row per column and link it takes part in.

    With ``tables`` the declarations are verified on the rows (A3, R8), in one
    aggregation per table with a key and one join of all links' distinct keys:
    ``n_rows, key_nulls, key_duplicates`` of the declared key, and per link
    ``ref_nulls``, ``ref_orphans`` (child rows without a parent) and
    ``ref_duplicates`` (parent rows beyond the first of their key).
    """
    spark = columns.sparkSession
    links = [RL.Link.of(k) for k in links]
    pk = spark.createDataFrame([(t, list(k)) for t, k in keys.items()], "table_name string, primary_key array<string>")
    ends = "from_table string, from_fields array<string>, to_table string, to_fields array<string>"
    declared = spark.createDataFrame([(k.from_table, list(k.from_fields), k.to_table, list(k.to_fields)) for k in links], ends)
    if tables is not None:
        if keys:
            counts = RL.check_keys(tables, keys)
            pk = pk.join(counts.select("table_name", "n_rows", F.col("n_null").alias("key_nulls"), F.col("n_duplicates").alias("key_duplicates")), "table_name")
        if links:
            counts = RL.check_links(tables, links)
            declared = declared.join(counts.select(
                "from_table", "from_fields", "to_table", "to_fields", F.col("n_null").alias("ref_nulls"),
                F.col("n_orphans").alias("ref_orphans"), F.col("n_parent_duplicates").alias("ref_duplicates")),
                ["from_table", "from_fields", "to_table", "to_fields"])
        for name, added in (("pk", KEY_COUNTS), ("declared", LINK_COUNTS)):
            df = pk if name == "pk" else declared
            for c in added:
                if c not in df.columns:
                    df = df.withColumn(c, F.lit(None).cast("long"))
            pk, declared = (df, declared) if name == "pk" else (pk, df)
    pair = F.explode(F.arrays_zip("from_fields", "to_fields")).alias("f")
    per_field = declared.select("*", pair).select(
        F.col("from_table").alias("table_name"), F.col("f.from_fields").alias("field_name"), F.col("to_table").alias("ref_table"),
        F.col("f.to_fields").alias("ref_field"), *[c for c in LINK_COUNTS if tables is not None])
    return (columns.join(pk, "table_name", "left").join(per_field, ["table_name", "field_name"], "left")
            .select(*columns.columns, "primary_key", F.try_element_at("primary_key", F.lit(-1)).alias("primary_key_last"), "ref_table", "ref_field",
                    *[c for c in KEY_COUNTS + LINK_COUNTS if tables is not None]))


def profile_tables(spark: SparkSession, url: str, tables: list[str] | None = None,
                   schema: str | None = None, properties: Mapping[str, str] | None = None,
                   verify: bool = False) -> DataFrame:
    """M3: S4 -> S13 -> S5/S6/S7: one row per column of the chosen tables of a
    JDBC database with its declared key and links:
    ``table_name, position, field_name, field_type, size, nullable,
    primary_key, primary_key_last, ref_table, ref_field``. Catalog metadata
    only, unless ``verify`` asks for the counts of ``declared_profile``; links
    to tables that are not chosen are then not verified.
    """
    names = tables or [r["table_name"] for r in JD.list_tables(spark, url, schema, properties).collect()]
    columns = JD.table_columns(spark, url, names, schema, properties)
    keys = {r["table_name"]: r["primary_key"] for r in JD.declared_primary_keys(spark, url, names, schema, properties).collect()}
    links = JD.declared_links(spark, url, names, schema, properties)
    if not verify:
        return declared_profile(columns, keys, links)
    frames = {t: JD.read_table(spark, url, t, schema=schema, properties=properties) for t in names}
    return declared_profile(columns, keys, [k for k in links if k[2] in frames], frames)


def profile_catalog_tables(spark: SparkSession, database: str,
                           tables: list[str] | None = None, verify: bool = False) -> DataFrame:
    """M3 for a Spark-catalog database: one row per column with its key and
    links, as ``profile_tables`` gives for JDBC. Keys and links come from
    the ``primary_key`` / ``foreign_key.<fields>`` table properties that
    ``CatalogTarget`` writes; ``verify`` checks them on the rows."""
    names = tables or [t.name for t in spark.catalog.listTables(database)]
    rows, keys, links, frames = [], {}, [], {}
    for t in names:
        frames[t] = spark.table(f"`{database}`.`{t}`")
        for r in spark.sql(f"SHOW TBLPROPERTIES `{database}`.`{t}`").collect():
            if r["key"] == "primary_key":
                keys[t] = _fields(r["value"])
            elif r["key"].startswith("foreign_key."):
                to, fields = r["value"].split(".", 1)
                links.append((t, _fields(r["key"].removeprefix("foreign_key.")), to, _fields(fields)))
        rows += [(t, i + 1, f.name, f.dataType.simpleString(), "1" if f.nullable else "0") for i, f in enumerate(frames[t].schema.fields)]
    columns = spark.createDataFrame(rows, "table_name string, position int, field_name string, field_type string, nullable string")
    if not verify:
        return declared_profile(columns, keys, links)
    return declared_profile(columns, keys, [k for k in links if k[2] in frames], frames)


def _fields(declared: str) -> list[str]:
    return json.loads(declared) if declared.startswith("[") else [declared]
