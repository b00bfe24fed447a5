import json

from pyspark.sql import functions as F

from tessera.operators import fields as FL

BOOK_SCHEMA = ("_id string, author string, language string, pages int, published_date string, "
               "publisher struct<founded:int, location:string, name:string>, title string")


def test_book_schema_splits_into_book_and_publisher(spark):
    docs = spark.createDataFrame(
        [("1", "A", "en", 100, "2001", (1900, "NY", "P1"), "T1"),
         ("2", "B", "fr", 200, "2002", None, "T2")], BOOK_SCHEMA)
    rows = FL.schema_fields(docs, "book").collect()
    tables = {}
    for r in rows:
        tables.setdefault((r.table_name, r.relation, r.parent), []).append((r.field_name, r.field_type))
    assert tables == {
        ("book", "root", None): [("_id", "string"), ("author", "string"), ("language", "string"),
                                 ("pages", "int"), ("published_date", "string"), ("title", "string")],
        ("publisher", "1_1", "book"): [("founded", "int"), ("location", "string"), ("name", "string")],
    }


def test_field_profile_counts(spark):
    docs = spark.createDataFrame(
        [("1", "A", "en", 100, "2001", (1900, "NY", "P1"), "T1"),
         ("2", None, "fr", 200, "2002", None, "T2")], BOOK_SCHEMA)
    prof = {(r.table_name, r.field_name): r for r in FL.field_profile(docs, "book").collect()}
    assert prof[("book", "author")].n_rows == 2 and prof[("book", "author")].n_null == 1
    assert prof[("publisher", "name")].n_rows == 1
    assert (prof[("book", "language")].len_min, prof[("book", "language")].len_max) == (2, 2)
    assert prof[("book", "pages")].len_min is None


def test_object_id_arrays_maps_and_depth(spark):
    schema = ("_id struct<oid:string>, tags array<string>, m map<string,int>, "
              "items array<struct<x:int, sub:array<struct<y:string>>>>")
    docs = spark.createDataFrame(
        [(("ab",), ["a", "b"], {"k": 1}, [(1, [("p",), ("q",)]), (2, [])]),
         (("cd",), None, None, None)], schema)
    prof = {(r.table_name, r.field_name): r for r in FL.field_profile(docs, "d").collect()}
    assert prof[("d", "_id")].field_type == "objectid"
    assert prof[("tags", "value")].n_rows == 2
    assert prof[("m", "key")].n_rows == 1
    assert prof[("items", "x")].n_rows == 2
    assert prof[("sub", "y")].n_rows == 2 and prof[("sub", "y")].len_max == 1


def test_schema_json_has_name_first(spark):
    df = spark.createDataFrame([], "a int")
    text = FL.schema_json(df, "book").collect()[0].schema_json
    doc = json.loads(text)
    assert list(doc)[0] == "name" and doc["name"] == "book" and doc["type"] == "struct"


def test_empty_collections(spark):
    from pyspark.sql import types as T
    from tessera.operators import reshape as R
    from tessera.plans.profiling import profile_documents
    empty = spark.createDataFrame([], T.StructType([]))
    assert FL.field_profile(empty, "book").count() == 0
    assert list(R.documents_to_tables(empty, "book")) == ["book"]
    pks = {r.table_name: r.primary_key for r in
           profile_documents({"book": empty, "type": empty}).primary_keys.collect()}
    assert pks == {"book": "_id", "type": "_id"}
