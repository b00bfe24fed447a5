from pyspark.sql import functions as F

from tessera.functions import jsonops as J

DOCS = [
    (1, '{"a":"x","b":{"a":"y","c":[{"a":"z"},"w",1]},"n":null,"s":"q\\"{[","d":{"a":7}}'),
    (2, '{"a":5,"l":[{"a":"p","m":{"a":"r"}},{"a":"t"}],"e":[]}'),
    (3, '"just text"'),
]


def test_find_and_strings(spark):
    df = spark.createDataFrame(DOCS, "id int, j string")
    assert J.max_depth(df, "j") == 4
    found = sorted(tuple(r) for r in J.json_find(df, "j", "a", ["id"]).collect())
    assert found == [(1, "x"), (1, "y"), (1, "z"), (2, "p"), (2, "r"), (2, "t")]
    strs = sorted(tuple(r) for r in J.json_strings(df, "j", ["id"]).collect())
    assert (1, "s", 'q"{[') in strs and (1, "a", "x") in strs and len(strs) == 7


def test_count_field_children_rows(spark):
    df = spark.createDataFrame(DOCS, "id int, j string")
    got = {r.id: r for r in df.select(
        "id", J.json_count(F.col("j"), "l", "a").alias("n"),
        J.json_field(F.col("j"), "$.l[0].a").alias("f"),
        J.json_field(F.col("j"), "$.l[0]").alias("g"),
        J.json_field(F.col("j"), "$.l").alias("h"),
        J.json_field(F.col("j"), "$.a").alias("i")).collect()}
    assert (got[2].n, got[2].f, got[2].g, got[2].h, got[2].i) == (2, "p", "struct", "array", "5")
    assert (got[1].n, got[1].f, got[1].i) == (0, None, "x")
    kids = {r.id: r.member_values for r in J.json_children(df, "j", "l", 0, "a", ["id"]).collect()}
    assert kids == {1: None, 2: ["p", "r"], 3: None}
    rows = J.json_array_rows(df, "j", "$.l", "a string", ["id"]).collect()
    assert sorted(tuple(r) for r in rows) == [(2, "p"), (2, "t")]


def test_typed_documents_use_schema_depth(spark):
    df = spark.createDataFrame([(1, ("x", [("y",)]))], "id int, doc struct<a:string, l:array<struct<a:string>>>")
    assert J.max_depth(df, "doc") == 3
    assert sorted(r.value for r in J.json_find(df, "doc", "a", ["id"]).collect()) == ["x", "y"]


def test_children_include_container_members(spark):
    df = spark.createDataFrame([(1, '{"l":[{"a":{"a":"x"},"b":[{"a":[1]}]}]}')], "id int, j string")
    got = J.json_children(df, "j", "l", 0, "a", ["id"]).first().member_values
    # a (object) then its a ("x"), then b[0].a (array), in document order
    assert got == ["struct", "x", "array"]


def test_json_count_of_keys_with_dots(spark):
    from pyspark.sql import functions as F
    from tessera.functions.jsonops import json_count
    df = spark.createDataFrame([('{"a.b": [{"x.y": 1}, {"z": 2}]}',)], "j string")
    assert df.select(json_count(F.col("j"), "a.b", "x.y")).first()[0] == 1


HARD = [
    (1, '{"z":{"m":"1"},"a":{"m":"2"},"m":"3"}'), (2, '{"m":"x","m":"y","l":[{"m":"p","m":"q","m":{"m":"r"}}]}'),
    (3, '{"k\\u0065y":"a\\"b\\\\","key":": {\\"m\\": \\"no\\"}","m":"\\u00e9\\ud83d\\ude00"}'), (4, '{"l":["{\\"m\\":\\"no\\",\\"n\\":{\\"m\\":\\"no\\"}}"]}'),
    (5, '"{\\"m\\":\\"no\\"}"'), (6, None), (7, '[{"m":"in array"}, {"l":[{"m":1.50,"n":{"m":null}}]}]'), (8, "{}"),
    (9, '{"l":[{"m":null,"b":{"m":1.50},"c":[{"m":1e3},{"m":true},{"m":"s"},{"m":[{"m":2}]}]}]}'), (10, '{"' + 'd":{"' * 300 + 'm":"deep"' + "}" * 301),
]
BAD = [(20, '{"m":"1"'), (21, "not json"), (22, ""), (23, '{"m":"1",}')]


def test_document_order_and_repeated_names(spark):
    df = spark.createDataFrame(HARD, "id int, j string").coalesce(1)
    found = {}
    for r in J.json_find(df, "j", "m", ["id"]).collect():
        found.setdefault(r.id, []).append(r.value)
    assert found == {1: ["1", "2", "3"], 2: ["x", "y", "p", "q", "r"], 3: ["é\U0001f600"], 7: ["in array"], 9: ["s"], 10: ["deep"]}
    assert [r.value for r in J.json_find(df, "j", "key", ["id"]).collect()] == ['a"b\\', ': {"m": "no"}']
    assert [(r.key, r.value) for r in J.json_strings(df.where("id = 3"), "j").collect()] == \
        [("key", 'a"b\\'), ("key", ': {"m": "no"}'), ("m", "é\U0001f600")]
    kids = {r.id: r.member_values for r in J.json_children(df, "j", "l", 0, "m", ["id"]).collect()}
    assert len(kids) == len(HARD) and {i: v for i, v in kids.items() if v} == {
        2: ["p", "q", "struct", "r"], 9: ["null", "1.5", "1000", "true", "s", "array", "2"]}
    counts = df.select("id", J.json_count(F.col("j"), "l", "m").alias("n"), J.json_field(F.col("j"), "$.m").alias("m"),
                       J.json_field(F.col("j"), "$.l").alias("l")).collect()
    assert {r.id: r.n for r in counts} == {1: 0, 2: 1, 3: 0, 4: 0, 5: 0, 6: 0, 7: 0, 8: 0, 9: 1, 10: 0}
    assert {r.id: (r.m, r.l) for r in counts}[2] == ("x", "array")


def test_rejects_are_counted_and_returned(spark):
    import pytest
    from pyspark.sql import Observation
    df = spark.createDataFrame(HARD + BAD, "id int, j string")
    clean = df.where("id < 20")
    for search in (lambda d, o: J.json_find(d, "j", "m", ["id"], o), lambda d, o: J.json_strings(d, "j", ["id"], o),
                   lambda d, o: J.json_children(d, "j", "l", 0, "m", ["id"], o)):
        seen = Observation()
        assert sorted(map(str, search(df, seen).collect())) == sorted(map(str, search(clean, None).collect()))
        assert seen.get == {"n_documents": 14, "n_rejects": 4}
        with pytest.raises(Exception, match="not JSON"):
            search(df, None).collect()
    assert sorted(r.id for r in J.json_rejects(df, "j", ["id"]).collect()) == [20, 21, 22, 23]
    assert {r[0] for r in df.where("id >= 20").select(J.json_count(F.col("j"), "l", "m")).collect()} == {None}


def test_searches_need_no_job_and_no_shuffle(spark):
    df = spark.createDataFrame(HARD, "id int, j string")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("planning", "planning")
    plans = [J.json_find(df, "j", "m", ["id"]), J.json_strings(df, "j", ["id"]), J.json_children(df, "j", "l", 0, "m", ["id"])]
    shown = [p._jdf.queryExecution().executedPlan().toString() for p in plans]
    assert not tracker.getJobIdsForGroup("planning") and not any("Exchange" in s for s in shown)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


LOOKALIKES = [
    (1, r'{"l":[{"m":1},"{\"m\":1}"]}', 1), (2, '{"l":["{\'m\':1}"]}', 0), (3, r'{"l":"[{\"m\":1}]"}', 0), (4, r'{"l":" [{\"m\":1}]"}', 0),
    (5, '{"l":{"m":1}}', 0), (6, r'"{\"l\":[{\"m\":1}]}"', 0), (7, '{"l":[{"m":1}],"l":[{"m":1},{"m":2}]}', 1), (8, '[{"l":[{"m":1}]}]', 0),
    (9, '{"l":[{"m":null},null,3,"x","",[{"m":1}],{"n":{"m":1}},{}, {"m":1,"m":2}]}', 2), (10, '{"l?":1,"l":[{"m":1}]}', 1),
    (11, r' {"a":"x\"l\":","b":{"l":[{"m":1}]},"l":[{"m":1},"{\"m\":1}"]}', 1), (12, '{"a":1}', 0), (13, None, 0), (14, '{"l":[', None),
]


def test_json_count_tells_objects_from_strings(spark):
    df = spark.createDataFrame([d[:2] for d in LOOKALIKES], "id int, j string")
    for ansi in ("true", "false"):
        spark.conf.set("spark.sql.ansi.enabled", ansi)
        try:
            got = {r.id: r.n for r in df.select("id", J.json_count(F.col("j"), "l", "m").alias("n")).collect()}
        finally:
            spark.conf.unset("spark.sql.ansi.enabled")
        assert got == {i: n for i, _, n in LOOKALIKES}
    named = spark.createDataFrame([(r'{"[l":[{"{m":1,"a\"{m":2},{"a\"{m":"[3"},"{\"{m\":1}"]}',)], "j string")
    assert named.select(J.json_count(F.col("j"), "[l", "{m"), J.json_count(F.col("j"), "[l", 'a"{m')).first()[:] == (1, 2)


def test_json_count_grows_with_the_text(spark):
    import time
    n = 30_000
    element = '{"m":1,"n":"some text"}'
    texts = [f'{{"l":[{",".join([element] * n)}]}}', f'{{"l":["x",{",".join([element] * n)}]}}']
    df = spark.createDataFrame([(t,) for t in texts], "j string")
    began = time.monotonic()
    assert [r[0] for r in df.select(J.json_count(F.col("j"), "l", "m")).collect()] == [n, n]
    # Linear: about a second. With the array read again for each element: minutes.
    assert time.monotonic() - began < 20
