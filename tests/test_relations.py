from pyspark.sql import functions as F

from tessera.operators import relations as RL
from tessera.plans.profiling import profile_documents, report_json


def mentor_classes_students(spark):
    mentor = spark.createDataFrame([("m1", "Alice"), ("m2", "Bob")], "_id string, name string")
    classes = spark.createDataFrame([("c1", "m1", "Math"), ("c2", "m1", "Art"), ("c3", "m2", "Bio")],
                                    "_id string, mentor string, name string")
    students = spark.createDataFrame(
        [("s1", "Math", "Ann"), ("s2", "Art", "Ben"), ("s3", "Math", "Cid"), ("s4", "Bio", "Dan")],
        "_id string, class string, full_name string")
    return {"mentor": mentor, "classes": classes, "students": students}


def test_relationship_report_golden(spark):
    prof = profile_documents(mentor_classes_students(spark))
    links = {tuple(r) for r in prof.edges.collect()}
    assert links == {("classes", "mentor", "mentor", "_id"), ("students", "class", "classes", "name")}
    pks = {r.table_name: r.primary_key for r in prof.primary_keys.collect()}
    assert pks == {"mentor": "_id", "classes": "_id", "students": "_id"}
    report = report_json(prof.tables()).first().report
    assert '"tableName":"mentor"' in report and '"status":"200"' in report


def test_primary_keys_without_reset(spark):
    prof = profile_documents(mentor_classes_students(spark), reset_pk=False)
    pks = {r.table_name: r.primary_key for r in prof.primary_keys.collect()}
    assert pks == {"mentor": "_id", "classes": "name", "students": "_id"}


def test_primary_key_override(spark):
    prof = profile_documents(mentor_classes_students(spark), overrides={"students": "full_name"})
    pks = {r.table_name: r.primary_key for r in prof.primary_keys.collect()}
    assert pks["students"] == "full_name"


def test_text_rule_ignores_integers(spark, tables):
    m = RL.match_sample({"nation": tables["nation"], "customer": tables["customer"]})
    assert m.count() == 0


def test_array_matching(spark):
    orders = spark.createDataFrame([("o1",), ("o2",)], "oid string")
    cust = spark.createDataFrame([("c1", ["o1", "o2"]), ("c2", [])], "cid string, orders array<string>")
    m = RL.match_summary(RL.match_sample({"orders": orders, "cust": cust}))
    assert {(r.from_table, r.from_field, r.to_table, r.to_field) for r in m.collect()} == \
        {("cust", "orders", "orders", "oid")}


def test_inclusion_scores(spark):
    a = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    b = spark.createDataFrame([(1,), (1,), (2,), (9,)], "ref int")
    got = {(r.from_table, r.from_field, r.to_table, r.to_field): (r.matched_values, r.distinct_values)
           for r in RL.match_inclusion({"a": a, "b": b}).collect()}
    assert got == {("b", "ref", "a", "k"): (2, 3)}


def test_orphans_equal_anti_join(spark, tables):
    o, li = tables["orders"], tables["lineitem"]
    got = RL.check_foreign_keys(o, li, "o_orderkey", "l_orderkey").count()
    expected = o.join(li, o.o_orderkey == li.l_orderkey, "left_anti").count()
    assert got == expected > 0
    assert RL.check_foreign_keys(o, tables["customer"], "o_custkey", "c_custkey").count() == 0


def test_count_orphans_equals_anti_join_rows(spark, tables):
    o, li = tables["orders"], tables["lineitem"]
    n = RL.count_orphans(o, li, "o_orderkey", "l_orderkey").first().n_orphans
    assert n == RL.check_foreign_keys(o, li, "o_orderkey", "l_orderkey").count()
    # A hot child key: every row points at one missing parent.
    hot = spark.range(1000).select(F.lit(7).alias("k"))
    par = spark.createDataFrame([(1,), (2,)], "k int")
    assert RL.count_orphans(hot, par, "k", "k").first().n_orphans == 1000


def test_profile_table_subset(spark):
    prof = profile_documents(mentor_classes_students(spark), tables=["mentor", "classes"])
    assert {tuple(r) for r in prof.edges.collect()} == {("classes", "mentor", "mentor", "_id")}
    assert {r.table_name for r in prof.primary_keys.collect()} == {"mentor", "classes"}


def test_every_document_can_be_referenced(spark):
    from pyspark.sql import functions as F
    a = spark.range(100).select(F.format_string("k%02d", "id").alias("u"))
    b = spark.range(50, 100).select(F.lit("x").alias("pad"), F.format_string("k%02d", "id").alias("fk"))
    got = RL.assign_foreign_keys(RL.match_sample({"A": a, "B": b}, {"A": ["u"]})).collect()
    assert [tuple(r) for r in got] == [("B", "fk", "A", "u")]
    assert RL.match_sample({"A": a, "B": b}, {"A": ["u"]}, n=10).count() == 0


def test_orphans_compare_numbers_by_value(spark):
    child = spark.createDataFrame([(5,), (6,), (None,)], "`k.k` int")
    for kind, orphans in (("double", [6]), ("decimal(10,2)", [6]), ("bigint", [6]), ("string", [6])):
        parent = spark.createDataFrame([("5",), ("5",)], "p string").selectExpr(f"cast(p as {kind}) AS p")
        assert [r[0] for r in RL.check_foreign_keys(child, parent, "k.k", "p").collect()] == orphans
        assert RL.count_orphans(child, parent, "k.k", "p").first()[0] == 1
