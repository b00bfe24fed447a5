from pyspark.sql import functions as F

from conftest import SF_MID
from tessera.operators import profile as P
from tessera.sources.documents import read_table_files


def test_unique_columns_keys_at_sf001(spark):
    t = read_table_files(spark, SF_MID, ["region", "nation", "customer", "supplier", "part",
                                         "orders", "lineitem", "events"])
    got = {(r.table_name, r.column_name) for r in P.unique_columns_of(t).collect()}
    expected = {("region", "r_regionkey"), ("region", "r_name"), ("nation", "n_nationkey"),
                ("nation", "n_name"), ("customer", "c_custkey"), ("customer", "c_name"),
                ("supplier", "s_suppkey"), ("supplier", "s_name"), ("supplier", "s_acctbal"),
                ("part", "p_partkey"), ("orders", "o_orderkey"), ("events", "event_id"),
                ("events", "ts")}
    assert got == expected


def test_null_rules(spark):
    df = spark.createDataFrame([(1, 1, None), (2, None, None), (3, 3, 5)],
                               "a int, b int, c int")
    ignore = {r.column_name for r in P.unique_columns(df, "t").collect()}
    group = {r.column_name for r in P.unique_columns(df, "t", nulls="group").collect()}
    assert ignore == {"a"}
    # b: values {1, 3} + one NULL = 3 rows; c: {5} + NULL twice -> not unique
    assert group == {"a", "b"}


def test_strategies_agree(spark, tables):
    a = P.distinct_counts(tables["orders"], table_name="orders")
    b = P.distinct_counts(tables["orders"], table_name="orders", strategy="expand")
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_prefilter_keeps_keys(spark, tables):
    a = {r.column_name for r in P.unique_columns(tables["customer"], "customer").collect()}
    b = {r.column_name for r in P.unique_columns(tables["customer"], "customer",
                                                  prefilter=True).collect()}
    assert a == b and {"c_custkey", "c_name"} <= a


def test_id_column_reported_without_test(spark):
    df = spark.createDataFrame([("x", 1), ("x", 2)], "_id string, v int")
    got = {r.column_name for r in P.unique_columns(df, "t").collect()}
    assert got == {"_id", "v"}


def test_nested_unique_books(spark):
    # struct<books:array<struct<_id:int>>>, the nested sample shape
    df = spark.createDataFrame([([(1,), (2,)],), ([(3,)],)],
                               "books array<struct<_id:int>>")
    got = {r.column_name for r in P.nested_unique_columns(df, "shelf").collect()}
    assert got == {"books._id"}


def test_nested_unique_struct_first_field(spark):
    df = spark.createDataFrame([(1, ("a", 1)), (2, ("b", 1))],
                               "k int, hd struct<id_hd:string, n:int>")
    got = {r.column_name for r in P.nested_unique_columns(df, "t").collect()}
    # hd is unique, its first sub-field too, so hd is pruned.
    assert got == {"k", "hd.id_hd"}


def test_prune_keys(spark):
    keys = spark.createDataFrame([("t", "a"), ("t", "a.b"), ("t", "c"), ("t", "cc"), ("u", "a")],
                                 "table_name string, column_name string")
    got = sorted(map(tuple, P.prune_keys(keys).collect()))
    assert got == [("t", "a.b"), ("t", "c"), ("t", "cc"), ("u", "a")]


def test_length_stats_and_empty(spark, tables):
    got = {r.column_name: (r.len_min, r.len_max)
           for r in P.length_stats(tables["region"], "region").collect()}
    names = [r.r_name for r in tables["region"].collect()]
    assert got == {"r_name": (min(map(len, names)), max(map(len, names)))}
    empty = spark.createDataFrame([], "s string")
    assert [tuple(r) for r in P.length_stats(empty, "e").collect()] == [("e", "s", 0, 0)]


def test_sample_values(spark, tables):
    got = P.sample_values(tables["nation"], "n_name", "n_nationkey", 3).collect()
    assert [r.n_nationkey for r in got] == [0, 1, 2]


def test_row_counts(spark, tables):
    got = {r.table_name: r.n_rows for r in P.row_counts(tables).collect()}
    assert got["lineitem"] == tables["lineitem"].count()
    assert got["region"] == 5


def test_smallest_unique_column_sets_match_a_full_search(spark):
    from itertools import combinations
    import random
    rng = random.Random(4)
    rows = [(rng.randint(0, 6), rng.choice("abcd"), rng.choice([0.0, -0.0, 1.5]), i // 3, rng.choice([None, 1]), 7) for i in range(60)]
    df = spark.createDataFrame(rows, "a int, b string, c double, d long, e int, f int")
    rows = [(a, b, c + 0.0, d, e, f) for a, b, c, d, e, f in rows]
    expected = set()
    for k in range(1, 6):
        for some in combinations(range(6), k):
            if 4 not in some and len({tuple(r[i] for i in some) for r in rows}) == len(rows) and not any(set(u) <= set(some) for u in expected):
                expected.add(some)
    twice = df.unionByName(df)
    got = {t: set() for t in ("t", "twice", "empty")}
    for r in P.unique_column_sets({"t": df, "twice": twice}, max_size=5, slices=[2]).collect():
        got[r.table_name].add(tuple("abcdef".index(c) for c in r.columns))
    assert got["t"] == expected and not got["twice"]
    assert P.unique_column_sets({"t": df}, max_size=5, slices=[]).count() == len(expected)


def test_distinct_counts_by_every_strategy(spark):
    df = spark.sql("""SELECT id % 3 AS i, cast(id % 4 AS string) AS s, if(id % 2 = 0, 0.0D, -0.0D) AS z, date_add(DATE'2020-01-01', cast(id % 5 AS int)) AS d,
        timestamp_micros(id % 6) AS t, cast(id % 7 AS decimal(9,2)) AS n, cast(cast(id % 8 AS string) AS binary) AS b, id % 2 = 0 AS f,
        nullif(id % 9, 0) AS g, named_struct('x', id % 10) AS st, cast(NULL AS int) AS nothing, cast('NaN' AS double) AS nan FROM range(1000)""")
    by = {s: sorted(map(tuple, P.distinct_counts(df, strategy=s).collect())) for s in ("per_column", "long", "expand", "auto")}
    assert by["per_column"] == by["long"] == by["expand"] == by["auto"]
    assert P.distinct_counts(df.where("false"), strategy="long").where("n_rows + n_distinct + n_null > 0").count() == 0


def test_one_scan_of_a_row_source(spark, tables, tmp_path):
    tables["orders"].write.json(str(tmp_path / "o"))
    source = spark.read.json(str(tmp_path / "o"))
    assert not P.is_columnar(source) and P.is_columnar(tables["orders"].where("o_orderkey > 3").select("o_custkey"))
    assert not P.is_columnar(tables["orders"].groupBy("o_custkey").count())
    plan = P.distinct_counts(source)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_nothing_is_dropped_on_an_estimate(spark):
    df = spark.range(5000).select("id", (F.col("id") % 4999).alias("almost"), (F.col("id") % 5).alias("few"))
    assert P.sliced_candidates(df, ["id", "almost", "few"], 1) == ["id"]
    assert "id" in P.sliced_candidates(df, ["id", "almost", "few"])
