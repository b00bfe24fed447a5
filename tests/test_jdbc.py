"""JDBC sources and sinks against embedded Derby (bundled with Spark).

Embedded Derby lives inside the driver JVM, so these tests only run on a
local master; on a cluster the same functions take a server URL.
"""
import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import bag
from tessera.plans import migration as MG
from tessera.plans.profiling import profile_catalog_tables, profile_tables
from tessera.sources import derived as D
from tessera.sources import jdbc as JD


@pytest.fixture()
def derby(spark):
    d = tempfile.mkdtemp(prefix="tessera-derby-")
    return f"jdbc:derby:{d}/db;create=true"


def test_write_read_round_trip(spark, tables, derby):
    JD.write_table(tables["region"], derby, "region", "r_regionkey")
    JD.write_table(tables["nation"], derby, "nation", "n_nationkey", batchsize=7)
    JD.execute_ddl(spark, derby, [JD.foreign_key_sql("nation", "n_regionkey", "region", "r_regionkey")])
    back = JD.read_table(spark, derby, "nation", "n_nationkey", num_partitions=3)
    assert back.rdd.getNumPartitions() == 3
    assert bag(back) == bag(tables["nation"])
    prof = {(r.table_name, r.field_name): r for r in profile_tables(spark, derby).collect()}
    assert prof[("nation", "n_regionkey")].ref_table == "region"
    assert prof[("nation", "n_nationkey")].primary_key_last == "n_nationkey"
    assert prof[("region", "r_name")].nullable == "1"
    assert {r.table_name for r in JD.list_tables(spark, derby).collect()} == {"region", "nation"}


def test_documents_to_tables_to_documents(spark, tables, derby):
    docs = D.with_object_id(D.order_documents(tables["orders"], tables["lineitem"]), "o_orderkey")
    MG.migrate_documents(docs, "orders", MG.JdbcTarget(derby), primary_keys={"orders": "_id"},
                         edges=[("lines", "_id", "orders", "_id")])
    src = MG.read_jdbc_tables(spark, derby, {"orders": None, "lines": "lines_pos"}, 2)
    out = tempfile.mkdtemp(prefix="tessera-docs-")
    paths = MG.migrate_tables(src, out, mode="overwrite")
    lines = spark.read.json(paths["lines"])
    assert lines.count() == tables["lineitem"].count()
    orders = spark.read.json(paths["orders"])
    want = tables["orders"].select(F.hex("o_orderkey").alias("_id"))
    assert bag(orders.select("_id")) == bag(want)
    fks = JD.declared_foreign_keys(spark, derby, ["lines"]).collect()
    assert [tuple(r) for r in fks] == [("lines", "_id", "orders", "_id")]


def test_strict_orphan_check_raises(spark, derby):
    docs = spark.createDataFrame([("a", [(1,)])], "_id string, items array<struct<x:int>>")
    with pytest.raises(ValueError):
        MG.migrate_documents(docs, "d", MG.JdbcTarget(derby),
                             edges=[("items", "x", "d", "_id")])


def test_column_types_rule(spark):
    df = spark.createDataFrame([], "_id string, name string, ref string, n bigint, s struct<a:int>")
    types = JD.target_column_types(df, "_id", ["ref"], text_type="CLOB", object_ids=[])
    assert types == {"_id": "VARCHAR(255)", "name": "CLOB", "ref": "VARCHAR(255)",
                     "n": "BIGINT", "s": "CLOB"}
    sql = JD.create_table_sql("t", {"a": "INTEGER", "b": "CLOB"}, "a")
    assert sql == 'CREATE TABLE "t" ("a" INTEGER NOT NULL, "b" CLOB, PRIMARY KEY ("a"))'


def test_free_database_name(spark):
    name = JD.create_target_database(spark, "tessera_target")
    assert JD.free_database_name(spark, "tessera_target") != "tessera_target" or name != "tessera_target"
    spark.sql(f"DROP DATABASE IF EXISTS `{name}`")


def test_fresh_schema_and_catalog_target(spark, tables, derby):
    docs = D.customer_documents(tables["customer"])
    MG.migrate_documents(docs, "customer", MG.JdbcTarget(derby, new_schema="shop"), key="c_custkey",
                         primary_keys={"customer": "c_custkey"})
    MG.migrate_documents(docs, "customer", MG.JdbcTarget(derby, new_schema="shop"), key="c_custkey")
    assert JD.free_schema_name(spark, derby, "shop") == "shop_1"
    back = JD.read_table(spark, derby, "profile", schema="shop_0")
    assert back.count() == tables["customer"].count()
    out = MG.migrate_documents(docs, "customer", MG.CatalogTarget("tessera_mig"), key="c_custkey",
                               primary_keys={"customer": "c_custkey"})
    assert bag(out["profile"]) == bag(tables["customer"].select("c_custkey", "c_name", "c_acctbal",
                                                                "c_mktsegment"))
    props = {r.key: r.value for r in spark.sql(
        "SHOW TBLPROPERTIES tessera_mig.customer").collect()}
    assert props.get("primary_key") == "c_custkey"


def test_catalog_round_trip_keeps_keys_and_links(spark, tables):
    docs = D.with_object_id(D.order_documents(tables["orders"], tables["lineitem"]), "o_orderkey")
    MG.migrate_documents(docs, "orders", MG.CatalogTarget("tessera_links"),
                         primary_keys={"orders": "_id"}, edges=[("lines", "_id", "orders", "_id")])
    db = [d.name for d in spark.catalog.listDatabases() if d.name.startswith("tessera_links")][-1]
    prof = {(r.table_name, r.field_name): r for r in profile_catalog_tables(spark, db).collect()}
    assert prof[("orders", "_id")].primary_key_last == "_id"
    assert (prof[("lines", "_id")].ref_table, prof[("lines", "_id")].ref_field) == ("orders", "_id")
    assert prof[("lines", "l_tax")].field_type == "double"


def test_unknown_link_end_is_reported(spark, derby):
    docs = spark.createDataFrame([("a", [(1,)])], "_id string, items array<struct<x:int>>")
    with pytest.raises(ValueError, match="not a column"):
        MG.migrate_documents(docs, "d", MG.JdbcTarget(derby), edges=[("items", "x", "other", "_id")])
