"""Batches that take effect once: a database (embedded Derby) and folders."""
import tempfile

import pytest

from conftest import bag
from tessera.plans import migration as MG
from tessera.sources import batches as B
from tessera.sources import jdbc as JD


@pytest.fixture()
def derby(spark):
    d = tempfile.mkdtemp(prefix="tessera-derby-")
    return f"jdbc:derby:{d}/db;create=true"


def test_a_batch_is_written_once(spark, tables, derby):
    nation = tables["nation"].repartition(4, "n_nationkey")
    both = {"region": tables["region"], "nation": nation}
    assert B.write_tables_once(both, derby, "first")
    assert not B.write_tables_once(both, derby, "first")
    back = JD.read_table(spark, derby, "nation")
    assert bag(back) == bag(nation) and B.published(spark, derby, "first") and not B.published(spark, derby, "second")
    assert B.write_tables_once({"nation": nation}, derby, "second")
    assert JD.read_table(spark, derby, "nation").count() == 2 * nation.count()
    left = {r.table_name for r in JD.list_tables(spark, derby).collect()}
    assert left == {"region", "nation", B.BATCHES}


def test_rows_of_a_repeated_task_are_moved_once(spark, tables, derby, monkeypatch):
    # Every task's rows reach the staging table twice, as when executors are
    # lost after their tasks have written.
    stage = B.stage_table

    def twice(*args, **kwargs):
        stage(*args, **kwargs)
        stage(*args, **kwargs)

    monkeypatch.setattr(B, "stage_table", twice)
    nation = tables["nation"].repartition(4, "n_nationkey")
    assert B.write_tables_once({"nation": nation}, derby, "b", {"nation": "n_nationkey"})
    assert bag(JD.read_table(spark, derby, "nation")) == bag(nation)


def test_a_failed_batch_leaves_nothing(spark, tables, derby):
    region, nation = tables["region"], tables["nation"]
    repeated = nation.union(nation)  # against the primary key, found while publishing
    keys = {"nation": "n_nationkey"}
    with pytest.raises(Exception):
        B.write_tables_once({"region": region, "nation": repeated}, derby, "b", keys)
    assert JD.read_table(spark, derby, "region").count() == 0 and not B.published(spark, derby, "b")
    assert B.write_tables_once({"region": region, "nation": nation}, derby, "b", keys)
    assert JD.read_table(spark, derby, "region").count() == region.count()


def test_migrations_as_batches(spark, derby):
    docs = spark.createDataFrame([("a", [("x", 1), ("y", 2)]), ("b", [])], "_id string, items array<struct<n:string, k:int>>")
    for _ in range(2):
        MG.migrate_documents(docs, "d", MG.JdbcTarget(derby, batch="load-1"), embedded_links=True)
    tables = MG.read_jdbc_tables(spark, derby, {"d": None, "items": None})
    assert bag(tables["d"]) == [("a",), ("b",)] and tables["items"].count() == 2
    out = tempfile.mkdtemp(prefix="tessera-batches-")
    for name in ("one", "one", "two"):
        MG.migrate_tables(tables, out, batch=name)
    back = spark.read.json(f"{out}/items")
    assert {r["batch"]: r["count"] for r in back.groupBy("batch").count().collect()} == {"one": 2, "two": 2}


def test_names_that_are_no_folder(spark, tables):
    for bad in ("", "a/b", "_x", ".x", "a=b"):
        with pytest.raises(ValueError):
            B.write_documents_once(tables["region"], "/tmp/none", bad)
