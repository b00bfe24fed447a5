"""Migrations of several linked collections: order, cycles, links, keys."""
import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import bag
from tessera.operators import relations as RL
from tessera.plans import migration as MG
from tessera.sources import jdbc as JD


@pytest.fixture()
def school(spark):
    """Students refer to classes by name, classes to mentors by id."""
    mentor = spark.createDataFrame([("m1", "Ada", ["x"]), ("m2", "Bo", None)], "_id string, name string, subjects array<string>")
    classes = spark.createDataFrame([("c1", "m1", "3A", [("mon", 8), ("tue", 9)]), ("c2", "m2", "3B", [])],
                                    "_id string, mentor string, name string, hours array<struct<day:string,hour:int>>")
    students = spark.createDataFrame([("s1", "3A", "Al"), ("s2", "3B", "Cy"), ("s3", "3A", "Di")], "_id string, class string, full_name string")
    return {"students": students, "classes": classes, "mentor": mentor}


EDGES = [("students", "class", "classes", "name"), ("classes", "mentor", "mentor", "_id")]


def test_parents_load_first_and_cycles_are_found():
    links = [("c", "x", "b", "y"), ("b", "x", "a", "y"), ("d", "x", "e", "y"), ("e", "x", "d", "y"), ("e", "x", "c", "y"), ("f", "boss", "f", "id"), ("z", "x", "nowhere", "y")]
    order, cycles = MG.load_order(["d", "f", "c", "e", "b", "a", "z"], links)
    at = order.index
    assert at("a") < at("b") < at("c") < at("e") and sorted(order) == list("abcdefz")
    assert sorted(map(sorted, cycles)) == [["d", "e"], ["f"]]
    assert MG.load_order([], []) == ([], [])


def test_linked_collections_to_one_folder(spark, school):
    out = tempfile.mkdtemp(prefix="tessera-school-")
    done = MG.migrate_collections(school, MG.PathTarget(out), edges=EDGES, renames={"classes": {"name": "title"}},
                                  primary_keys={"classes": "name"}, orders={"students": ["full_name", "class"]})
    assert list(done).index("mentor") < list(done).index("classes") < list(done).index("students")
    assert set(done) == {"mentor", "subjects", "classes", "hours", "students"}
    assert spark.read.parquet(f"{out}/classes").columns == ["_id", "mentor", "title"]
    assert spark.read.parquet(f"{out}/students").columns == ["_id", "full_name", "class"]
    assert bag(spark.read.parquet(f"{out}/hours")) == [("c1", 0, "mon", 8), ("c1", 1, "tue", 9)]


def test_an_orphan_in_any_collection_stops_the_migration(spark, school):
    school["students"] = school["students"].union(spark.createDataFrame([("s4", "9Z", "Ed")], school["students"].schema))
    out = tempfile.mkdtemp(prefix="tessera-school-")
    with pytest.raises(ValueError, match="'students', 'class', 'classes', 'name', 1"):
        MG.migrate_collections(school, MG.PathTarget(f"{out}/x"), edges=EDGES)
    with pytest.raises(ValueError, match="not a column"):
        MG.migrate_collections(school, MG.PathTarget(f"{out}/x"), edges=[("students", "class", "rooms", "_id")])
    MG.migrate_collections(school, MG.PathTarget(f"{out}/x"), edges=EDGES, strict=False)
    assert spark.read.parquet(f"{out}/x/students").count() == 4


def test_linked_collections_to_a_database(spark, school):
    url = f"jdbc:derby:{tempfile.mkdtemp(prefix='tessera-derby-')}/db;create=true"
    MG.migrate_collections(school, MG.JdbcTarget(url), edges=EDGES, primary_keys={"classes": "name"}, embedded_links=True)
    links = JD.declared_links(spark, url, ["students", "classes", "hours", "subjects", "mentor"])
    assert sorted(links) == [("classes", ("mentor",), "mentor", ("_id",)), ("hours", ("_id",), "classes", ("_id",)),
                             ("students", ("class",), "classes", ("name",)), ("subjects", ("_id",), "mentor", ("_id",))]
    assert JD.read_table(spark, url, "students").count() == 3


def test_embedded_links_carry_composite_keys(spark):
    docs = spark.createDataFrame([(1, "x", [([7, 8],)]), (1, "y", [([9],), ([],)])], "a int, b string, rows array<struct<cells:array<int>>>")
    plan = MG.plan_migration({"docs": docs}, {"docs": ["a", "b"]}, embedded_links=True, renames={"docs": {"b": "bb"}, "rows": {"b": "doc_b"}})
    assert plan.primary_keys == {"docs": ("a", "bb"), "rows": ("a", "doc_b", "rows_pos"), "cells": ("a", "b", "rows_pos", "cells_pos")}
    assert RL.Link("cells", ("a", "b", "rows_pos"), "rows", ("a", "doc_b", "rows_pos")) in plan.links
    counts = RL.check_links(plan.tables, plan.links).collect()
    assert len(counts) == 2 and not any(r.n_orphans or r.n_parent_duplicates or r.n_null for r in counts)
    keys = {r.table_name: r for r in RL.check_keys(plan.tables, plan.primary_keys).collect()}
    assert [keys[t].n_rows for t in ("docs", "rows", "cells")] == [2, 3, 3] and not any(r.n_duplicates or r.n_null for r in keys.values())
    url = f"jdbc:derby:{tempfile.mkdtemp(prefix='tessera-derby-')}/db;create=true"
    MG.migrate_collections({"docs": docs}, MG.JdbcTarget(url), {"docs": ["a", "b"]}, embedded_links=True)
    assert sorted(JD.declared_links(spark, url, ["rows", "cells"])) == [
        ("cells", ("a", "b", "rows_pos"), "rows", ("a", "b", "rows_pos")), ("rows", ("a", "b"), "docs", ("a", "b"))]


def test_links_and_keys_are_counted_on_rows(spark):
    parent = spark.createDataFrame([(1, 1.0), (1, 1.0), (2, -0.0), (None, 3.0)], "k long, d double")
    child = spark.createDataFrame([("1", 1, 0), (" 1", 1, 1), ("2", 0, 0), ("7", 9, 0), ("7", None, 0), (None, 9, 0)], "s string, n int, z int")
    tables = {"p": parent, "c": child, "none": parent.where("false")}
    rows = {(tuple(r.from_fields), r.to_table, tuple(r.to_fields)): (r.n_rows, r.n_null, r.n_orphans, r.n_orphan_keys, r.n_parent_duplicates)
            for r in RL.check_links(tables, [("c", "s", "p", "k"), ("c", ["s", "n"], "p", ["k", "d"]), ("c", "n", "p", "d"), ("c", "n", "none", "d"), ("none", "k", "p", "k")]).collect()}
    assert rows[("s",), "p", ("k",)] == (6, 1, 3, 2, 1)
    assert rows[("s", "n"), "p", ("k", "d")] == (6, 2, 2, 2, 1)
    assert rows[("n",), "p", ("d",)] == (6, 1, 2, 1, 1)
    assert rows[("n",), "none", ("d",)] == (6, 1, 5, 3, 0)
    assert rows[("k",), "p", ("k",)] == (0, 0, 0, 0, 1)
    keys = {r.table_name: tuple(r)[2:] for r in RL.check_keys(tables, {"p": "k", "c": ["s", "n"], "none": "k"}).collect()}
    assert keys == {"p": (4, 1, 2, 1), "c": (6, 2, 4, 0), "none": (0, 0, 0, 0)}
    with pytest.raises(ValueError, match="same number"):
        RL.check_links(tables, [("c", ["s", "n"], "p", "k")])


def test_orphan_rows_by_both_ways(spark):
    child = spark.range(5000).select(F.when(F.col("id") < 4000, 1).otherwise(F.col("id") % 50).alias("k"), "id")
    parent = spark.createDataFrame([(i,) for i in range(1, 40)], "p long")
    few, many = (RL.check_foreign_keys(child, parent, "k", "p", broadcast_keys=n) for n in (10**6, 0))
    assert bag(few) == bag(many) == bag(child.where("k = 0 OR k >= 40"))
    assert "BroadcastHashJoin" in few._jdf.queryExecution().toString()


def test_names_and_types_follow_the_database(spark):
    mysql, derby = "jdbc:mysql://h/db", "jdbc:derby:memory:x"
    q = JD.quoter(spark, mysql)
    assert JD.foreign_key_sql("a", ["x", "y"], "b", ["u", "v"], "s", q) == \
        "ALTER TABLE `s`.`a` ADD FOREIGN KEY (`x`, `y`) REFERENCES `s`.`b` (`u`, `v`)"
    df = spark.createDataFrame([], "id string, t string, n bigint, b boolean, d double, x binary")
    types = JD.target_column_types(df, ["id"], text_type=JD.type_namer(spark, mysql)(df.schema["t"].dataType), type_of=JD.type_namer(spark, mysql))
    assert JD.create_table_sql("t", types, ["id"], quote=q).startswith("CREATE TABLE `t` (`id` VARCHAR(255) NOT NULL, `t` LONGTEXT, `n` BIGINT, ")
    assert JD.type_namer(spark, derby)(df.schema["t"].dataType) == "CLOB"


def test_long_texts_dates_and_odd_names_in_a_database(spark):
    url = f"jdbc:derby:{tempfile.mkdtemp(prefix='tessera-derby-')}/db;create=true"
    df = spark.sql("SELECT id, repeat('x', 50000) AS t, date_add(DATE'2020-01-01', cast(id as int)) AS d, "
                   "timestamp_micros(id * 1000000) AS at FROM range(20)")
    JD.write_table(df, url, "a_b", "id")
    JD.write_table(df.limit(1).select("id"), url, "aXb", "id")
    for column in ("d", "at", "id"):
        back = JD.read_table(spark, url, "a_b", column, 3)
        assert back.rdd.getNumPartitions() == 3 and back.count() == 20 and back.agg(F.min(F.length("t"))).first()[0] == 50000
    assert {r.table_name for r in JD.table_columns(spark, url, ["a_b"]).collect()} == {"a_b"}
    assert JD.read_table(spark, url, "aXb", "id", 2).count() == 1


def test_declared_keys_are_verified_on_rows(spark):
    from tessera.plans.profiling import profile_catalog_tables, profile_tables
    a = spark.createDataFrame([(1, "x"), (1, "y"), (2, "x"), (2, "x")], "k int, c string")
    b = spark.createDataFrame([(10, 1, "x"), (11, 1, "z"), (12, None, "x"), (13, 9, "y")], "id int, k int, c string")
    db = MG.write_catalog_tables({"a": a, "b": b}, MG.CatalogTarget("tessera_verify"), {"a": ("k", "c"), "b": "id"},
                                 [("b", ("k", "c"), "a", ("k", "c")), ("b", "k", "a", "k")])
    rows = {(r.table_name, r.field_name, r.ref_field, tuple(r[-3:])) for r in profile_catalog_tables(spark, db, verify=True).collect()}
    assert ("a", "k", None, (None,) * 3) in rows
    assert {r for r in rows if r[0] == "b"} == {("b", "id", None, (None,) * 3), ("b", "k", "k", (1, 2, 1)), ("b", "c", "c", (1, 2, 1)), ("b", "k", "k", (1, 1, 2))}
    keys = {r.table_name: (list(r.primary_key), r.primary_key_last, r.n_rows, r.key_nulls, r.key_duplicates)
            for r in profile_catalog_tables(spark, db, verify=True).collect()}
    assert keys == {"a": (["k", "c"], "c", 4, 0, 1), "b": (["id"], "id", 4, 0, 0)}
    assert "n_rows" not in profile_catalog_tables(spark, db).columns
    url = f"jdbc:derby:{tempfile.mkdtemp(prefix='tessera-derby-')}/db;create=true"
    JD.write_table(a.distinct(), url, "a", ["k", "c"], {"k": "INTEGER", "c": "VARCHAR(9)"})
    JD.write_table(b.where("id = 10"), url, "b", "id", {"id": "INTEGER", "k": "INTEGER", "c": "VARCHAR(9)"})
    JD.execute_ddl(spark, url, [JD.foreign_key_sql("b", ["k", "c"], "a", ["k", "c"])])
    prof = {(r.table_name, r.field_name): r for r in profile_tables(spark, url, verify=True).collect()}
    assert len(prof) == 5 and prof["b", "c"].ref_field == "c" and prof["b", "c"].ref_orphans == 0
    assert (prof["a", "k"].n_rows, prof["a", "k"].key_duplicates, prof["a", "k"].primary_key_last) == (3, 0, "c")


def test_report_keeps_collections_apart_and_fields_in_order(spark):
    from tessera.plans.profiling import profile_documents
    a = spark.sql("SELECT '1' AS _id, named_struct('z', 1, 'b', 2, 'a', 3) AS detail")
    b = spark.sql("SELECT '1' AS _id, named_struct('y', 1, 'x', 2) AS detail")
    tables = {(r.collection, r.name): [f["name"] for f in r.fields] for r in profile_documents({"p": a, "q": b}).tables().collect()}
    assert tables == {("p", "p"): ["_id"], ("p", "detail"): ["z", "b", "a"], ("q", "q"): ["_id"], ("q", "detail"): ["y", "x"]}
