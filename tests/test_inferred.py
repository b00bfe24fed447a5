import json
from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from tessera.operators import inferred as I


def brute(texts):
    """Counts of (parent, path, kind), by plain recursion."""
    seen = Counter()

    def visit(parent, path, v):
        kind = {dict: "object", list: "array", str: "text", int: "integer", float: "fraction", bool: "boolean", type(None): "null"}[type(v)]
        seen[parent, path, kind] += 1
        if kind == "object":
            for k, w in v.items():
                plain = k.isascii() and k.replace("_", "a").isalnum()
                visit(path, f"{path}.{k}" if plain else path + '."' + k.replace("\\", "\\\\").replace('"', '\\"') + '"', w)
        elif kind == "array":
            for w in v:
                visit(path, path + "[]", w)

    for t in texts:
        if t is None:
            continue
        try:
            v = json.loads(t)
        except ValueError:
            seen[None, "$", "reject"] += 1
        else:
            visit(None, "$", v)
    return seen


def counted(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "j string")
    return Counter({(r.parent, r.path, r.kind): r.n_values for r in I.json_kinds(df, "j").collect()})


TEXTS = ['{"a":[1,2.5,"x",null,true,{"b":[]},[[]]],"c.d":{"e":[]},"q\\"r":1}', "[1,[2]]", "5", '"s"', "null", "{}", "[]",
         "not json", "", None, '{"a":{"b":"deep"}}', '{"a":123456789012345678901}', "[" * 40 + "]" * 40, '{"":{"":1}}', '{"$":1,"[]":2,"ä":3}']


def test_kinds_equal_plain_recursion(spark):
    assert counted(spark, TEXTS) == brute(TEXTS)
    assert counted(spark, []) == Counter()


values = st.recursive(st.none() | st.booleans() | st.integers(-2**40, 2**40) | st.text(max_size=4),
                      lambda v: st.lists(v, max_size=3) | st.dictionaries(st.sampled_from(["a", "b", "c d", "x.y"]), v, max_size=3), max_leaves=12)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(values, min_size=1, max_size=6))
def test_kinds_of_any_documents(spark, docs):
    texts = [json.dumps(d) for d in docs]
    assert counted(spark, texts) == brute(texts)


def test_profile_and_type(spark):
    texts = ['{"a":1,"b":{"c":"x"},"l":[{"k":1}]}', '{"a":2.5,"b":7,"l":[]}', '{"a":null,"l":[{"k":null,"m":true}],"only":null}', '{"a":1,"a":2}']
    df = spark.createDataFrame(list(enumerate(texts)), "id int, j string")
    got = {r.path: r for r in I.json_field_profile(df, "j").collect()}
    assert (got["$.a"].n_values, got["$.a"].n_null, got["$.a"].n_missing, got["$.a"].conflict) == (3, 1, 0, False)
    assert (got["$.b"].n_missing, got["$.b"].conflict) == (1, True)
    assert got["$.l[]"].n_missing is None and got["$.l[].m"].n_missing == 1
    assert [tuple(k) for k in got["$"].kinds] == [("object", 3), ("reject", 1)] and got["$"].conflict
    assert I.document_type([r for r in got.values() if r.path != "$"] + [got["$"]]) == T.StructType.fromDDL(
        "a double, b variant, l array<struct<k bigint, m boolean>>, only string")
    docs = {r.id: r.doc for r in I.typed_documents(df.where("id < 3"), "j", ["id"]).selectExpr(
        "id", "struct(doc.a, to_json(doc.b) as b, doc.l) as doc").collect()}
    assert (docs[0].a, docs[0].b, docs[1].b, docs[2].l[0].m) == (1.0, '{"c":"x"}', "7", True)
