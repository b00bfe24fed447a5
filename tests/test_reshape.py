from pyspark.sql import functions as F

from conftest import bag
from tessera.functions import values as V
from tessera.operators import fields
from tessera.operators import reshape as R
from tessera.sources import derived as D


def test_split_then_rejoin_is_lineitem(spark, tables):
    docs = D.order_documents(tables["orders"], tables["lineitem"])
    lines = R.split_array(docs, "lines", "o_orderkey")
    back = lines.select(F.col("o_orderkey").alias("l_orderkey"),
                        *[c for c in tables["lineitem"].columns if c != "l_orderkey"])
    assert bag(back) == bag(tables["lineitem"])


def test_root_keeps_orders_without_lines(spark, tables):
    docs = D.order_documents(tables["orders"], tables["lineitem"])
    tabs = R.documents_to_tables(docs, "orders", key="o_orderkey")
    assert set(tabs) == {"orders", "lines"}
    assert tabs["orders"].count() == tables["orders"].count()
    no_lines = tables["orders"].join(tables["lineitem"],
                                     tables["orders"].o_orderkey == tables["lineitem"].l_orderkey,
                                     "left_anti").count()
    assert docs.where(F.col("lines").isNull()).count() == no_lines


def test_split_struct_and_reference_shape(spark, tables):
    cd = D.customer_documents(tables["customer"])
    prof = R.split_struct(cd, "profile", "c_custkey")
    assert bag(prof) == bag(tables["customer"].select("c_custkey", "c_name", "c_acctbal", "c_mktsegment"))
    docs = D.order_documents(tables["orders"], tables["lineitem"])
    ref_shape = R.split_array(docs, "lines", None, position=False, parent_key=False)
    assert ref_shape.columns == D.LINE_FIELDS


def test_collapse_ids_nested(spark):
    df = spark.createDataFrame([(("a1",), [("b1",), ("b2",)], (1, ("c1",))), (None, None, None)],
                               "_id struct<oid:string>, refs array<struct<oid:string>>, "
                               "s struct<n:int, r:struct<oid:string>>")
    out = R.collapse_ids(df)
    assert out.schema.simpleString() == "struct<_id:string,refs:array<string>,s:struct<n:int,r:string>>"
    rows = out.collect()
    assert rows[0]["refs"] == ["b1", "b2"] and rows[0]["s"]["r"] == "c1"
    assert rows[1]["s"] is None


def test_rename_then_inverse_is_identity(spark, tables):
    m = {"n_nationkey": "id", "n_name": "name"}
    inv = {v: k for k, v in m.items()}
    once = R.rename_columns(tables["nation"], m)
    assert once.columns == ["id", "name", "n_regionkey"]
    assert bag(R.rename_columns(once, inv)) == bag(tables["nation"])


def test_rename_cascade_edges_and_keys(spark):
    edges = spark.createDataFrame([("b", "a_ref", "a", "id")],
                                  "from_table string, from_field string, to_table string, to_field string")
    tabs = {"a": spark.createDataFrame([(1,)], "id int"), "b": spark.createDataFrame([(1,)], "a_ref int")}
    t, pks, e = R.rename_cascade(tabs, {"a": {"id": "a_id"}, "b": {"a_ref": "a_fk"}}, {"a": "id"}, edges)
    assert pks == {"a": "a_id"}
    assert [tuple(r) for r in e.collect()] == [("b", "a_fk", "a", "a_id")]
    assert t["a"].columns == ["a_id"]


def test_column_order(spark, tables):
    out = R.root_table(tables["nation"], order=["n_name", "n_nationkey"])
    assert out.columns == ["n_name", "n_nationkey"]


def test_value_functions(spark):
    df = spark.createDataFrame([([("x",), None, ("y",)], [1, 2, 3])],
                               "ids array<struct<oid:string>>, n array<int>")
    dt = df.schema["ids"].dataType
    row = df.select(V.array_text(F.col("ids"), dt).alias("t"),
                    V.drop_element(F.col("n"), 1).alias("d"),
                    V.array_text(F.col("n"), df.schema["n"].dataType).alias("e")).first()
    assert row.t == ["x", "y"] and row.d == [1, 3] and row.e == []
    assert V.nested_path("a", "", "b") == "a.b"


def test_documents_to_tables_keeps_every_table_when_names_clash(spark):
    df = spark.sql("""SELECT 1 AS _id, array(named_struct('a', 1), named_struct('a', 2)) AS orders,
                      named_struct('y', 1, 'tags', array('p', 'q', 'r')) AS profile, array('s') AS tags,
                      named_struct('z', 5) AS profile_tags""")
    out = R.documents_to_tables(df, "orders")
    assert len(out) == 6
    assert out["orders"].columns == ["_id"] and out["orders_2"].count() == 2
    assert sorted(t.count() for t in out.values()) == [1, 1, 1, 1, 2, 3]
    specs = fields.walk(df.schema, "orders")
    assert len({t.name for t in specs}) == len(specs) == 6


def test_probe_a_element_ids_do_not_hide_the_document_key(spark):
    df = spark.createDataFrame([("d1", [("x", ["p", "q"])]), ("d2", [("x", ["p"])])],
                               "_id string, subs array<struct<_id:string, tags:array<string>>>")
    out = R.documents_to_tables(df, "docs")
    assert out["subs"].columns == ["parent__id", "subs_pos", "_id"]
    assert bag(out["tags"]) == [("d1", 0, 0, "p"), ("d1", 0, 1, "q"), ("d2", 0, 0, "p")]


def test_probe_b_nested_arrays_of_one_name(spark):
    df = spark.createDataFrame([(1, [([7, 8],), ([9],)])], "_id int, a array<struct<a:array<int>>>")
    split = R.split_collections({"docs": df})
    assert [t.name for t in split] == ["docs", "a", "a_a"]
    assert split[2].keys == ("_id", "a_pos", "a_pos_2") and split[2].link == (("_id", "_id"), ("a_pos", "a_pos"))
    assert bag(split[2].df) == [(1, 0, 0, 7), (1, 0, 1, 8), (1, 1, 0, 9)]


def test_probe_c_ids_in_maps(spark):
    df = spark.sql("SELECT 1 AS _id, map('a', named_struct('oid', 'x1'), 'b', named_struct('oid', 'x2')) AS m, "
                   "map(named_struct('oid', 'k'), 1) AS n")
    assert R.collapse_ids(df).schema.simpleString() == "struct<_id:int,m:map<string,string>,n:map<string,int>>"
    out = R.documents_to_tables(df, "docs")
    assert bag(out["m"]) == [(1, 0, "a", "x1"), (1, 1, "b", "x2")] and bag(out["n"]) == [(1, 0, "k", 1)]


def test_composite_and_nested_keys_reach_every_level(spark):
    df = spark.createDataFrame([(1, "x", ("k1",), [([("deep",)],)])],
                               "a int, b string, s struct<id:string>, rows array<struct<cells:array<struct<b:string>>>>")
    split = {t.name: t for t in R.split_collections({"docs": df}, {"docs": ["a", "b", "s.id"]})}
    assert split["docs"].df.columns == ["a", "b", "s_id"]
    assert split["s"].df.columns == ["a", "b", "s_id", "id"]
    assert split["cells"].df.columns == ["a", "parent_b", "s_id", "rows_pos", "cells_pos", "b"]
    assert split["cells"].link == (("a", "a"), ("parent_b", "b"), ("s_id", "s_id"), ("rows_pos", "rows_pos"))
    assert bag(split["cells"].df) == [(1, "x", "k1", 0, 0, "deep")]


def test_every_child_row_has_one_parent_row(spark):
    df = spark.createDataFrame([(i, [(j, [(j, [k]) for k in range(j)]) for j in range(3)]) for i in range(4)],
                               "_id int, l array<struct<_id:int, l:array<struct<l_pos:int, l:array<int>>>>>")
    split = {t.name: t for t in R.split_collections({"docs": df})}
    assert [len(t.keys) for t in split.values()] == [1, 2, 3, 4]
    for t in split.values():
        assert t.df.select(*t.keys).distinct().count() == t.df.count()
        if t.parent:
            parent = split[t.parent].df.select(*[F.col(p).alias(c) for c, p in t.link])
            assert t.df.join(parent, [c for c, _ in t.link]).count() == t.df.count()


def test_tables_of_two_collections_have_different_names(spark):
    a = spark.sql("SELECT 1 AS _id, array(1) AS tags, named_struct('x', 1) AS b")
    b = spark.sql("SELECT 1 AS _id, array(1) AS tags")
    assert [t.name for t in R.split_collections({"a": a, "b": b})] == ["a", "a_b", "tags", "b", "b_tags"]
