"""Operators against plain-Python brute force on seeded random fixtures."""
import json
import random

from pyspark.sql import functions as F

from tessera.functions import jsonops as J
from tessera.operators import profile as P
from tessera.operators import relations as RL

KEYS = ["a", "b", "c", "name", "x"]


def _rand_json(rng, depth=0):
    r = rng.random()
    if depth > 4 or r < 0.35:
        return rng.choice([rng.choice(["p", "q", "", "a{b", 'x"y']), rng.randint(-3, 3), None, True, 1.5])
    if r < 0.7:
        return {rng.choice(KEYS) + str(i % 2): _rand_json(rng, depth + 1) for i in range(rng.randint(0, 4))}
    return [_rand_json(rng, depth + 1) for _ in range(rng.randint(0, 3))]


def _strings(v, out):
    if isinstance(v, dict):
        for k, x in v.items():
            if isinstance(x, str):
                out.append((k, x))
            _strings(x, out)
    elif isinstance(v, list):
        for x in v:
            _strings(x, out)
    return out


def test_json_strings_and_find_match_python_walk(spark):
    rng = random.Random(7)
    docs = [(i, json.dumps(_rand_json(rng))) for i in range(300)]
    df = spark.createDataFrame(docs, "id int, j string")
    got = sorted(tuple(r) for r in J.json_strings(df, "j", ["id"]).collect())
    want = sorted((i, k, v) for i, j in docs for k, v in _strings(json.loads(j), []))
    assert got == want
    got_a = sorted(tuple(r) for r in J.json_find(df, "j", "a0", ["id"]).collect())
    assert got_a == sorted((i, v) for i, k, v in want if k == "a0")


def test_unique_columns_match_python(spark):
    rng = random.Random(11)
    rows = [(i, rng.randint(0, 50), rng.choice([None, i]), rng.choice(["u", "v"]) + str(i), i % 7)
            for i in range(60)]
    df = spark.createDataFrame(rows, "a int, b int, c int, d string, e int")
    cols = df.columns
    want = set()
    for j, c in enumerate(cols):
        vals = [r[j] for r in rows]
        if None not in vals and len(set(vals)) == len(vals):
            want.add(c)
    assert {r.column_name for r in P.unique_columns(df, "t").collect()} == want


def test_inclusion_matches_python(spark):
    rng = random.Random(5)
    t1 = [(i, f"k{i}") for i in range(40)]
    t2 = [(rng.randint(0, 60), rng.choice([f"k{rng.randint(0, 50)}", "zz"])) for _ in range(80)]
    a = spark.createDataFrame(t1, "id int, code string")
    b = spark.createDataFrame(t2, "ref int, code_ref string")
    got = {(r.from_table, r.from_field, r.to_table, r.to_field): (r.matched_values, r.distinct_values)
           for r in RL.match_inclusion({"a": a, "b": b}).collect()}
    want = {}
    ref_int, ref_txt = {r[0] for r in t1}, {r[1] for r in t1}
    d_int, d_txt = {r[0] for r in t2}, {r[1] for r in t2}
    if d_int & ref_int:
        want[("b", "ref", "a", "id")] = (len(d_int & ref_int), len(d_int))
    if d_txt & ref_txt:
        want[("b", "code_ref", "a", "code")] = (len(d_txt & ref_txt), len(d_txt))
    # b's columns are not unique, so nothing points into b.
    assert got == want


NESTED = ("_id string, name string, addr struct<city:string, zip:int>, "
          "items array<struct<sku:string, qty:int, tags:array<string>>>, scores array<int>")


def _rand_doc(rng, i):
    addr = None if rng.random() < 0.3 else (rng.choice(["A", "B", None]), rng.randint(1, 9))
    items = None if rng.random() < 0.2 else [
        (rng.choice(["s1", "s2", None]), rng.randint(0, 5),
         None if rng.random() < 0.3 else [rng.choice(["x", "y"]) for _ in range(rng.randint(0, 3))])
        for _ in range(rng.randint(0, 3))]
    scores = None if rng.random() < 0.2 else [rng.randint(0, 3) for _ in range(rng.randint(0, 4))]
    return (f"d{i}", rng.choice(["n", None]), addr, items, scores)


def test_documents_to_tables_match_python(spark):
    from tessera.operators import reshape as R
    rng = random.Random(3)
    docs = [_rand_doc(rng, i) for i in range(200)]
    df = spark.createDataFrame(docs, NESTED)
    tabs = R.documents_to_tables(df, "d")
    assert set(tabs) == {"d", "addr", "items", "tags", "scores"}
    rows = lambda t: sorted(tuple(r) for r in tabs[t].collect())
    assert rows("d") == sorted((d[0], d[1]) for d in docs)
    assert rows("addr") == sorted((d[0],) + tuple(d[2]) for d in docs if d[2] is not None)
    assert rows("items") == sorted((d[0], p, it[0], it[1]) for d in docs
                                   for p, it in enumerate(d[3] or []))
    assert rows("tags") == sorted((d[0], p, q, tag) for d in docs for p, it in enumerate(d[3] or [])
                                  for q, tag in enumerate(it[2] or []))
    assert rows("scores") == sorted((d[0], p, v) for d in docs for p, v in enumerate(d[4] or []))


def test_field_profile_matches_python(spark):
    from tessera.operators import fields as FL
    rng = random.Random(4)
    docs = [_rand_doc(rng, i) for i in range(200)]
    df = spark.createDataFrame(docs, NESTED)
    prof = {(r.table_name, r.field_name): (r.n_rows, r.n_null, r.len_min, r.len_max)
            for r in FL.field_profile(df, "d").collect()}

    def stats(vals, text):
        lens = [len(v) for v in vals if v is not None] if text else []
        return (len(vals), sum(v is None for v in vals),
                min(lens) if lens else None, max(lens) if lens else None)

    addrs = [d[2] for d in docs if d[2] is not None]
    items = [it for d in docs for it in (d[3] or [])]
    tags = [t for it in items for t in (it[2] or [])]
    scores = [v for d in docs for v in (d[4] or [])]
    assert prof[("d", "name")] == stats([d[1] for d in docs], True)
    assert prof[("addr", "city")] == stats([a[0] for a in addrs], True)
    assert prof[("addr", "zip")] == stats([a[1] for a in addrs], False)
    assert prof[("items", "sku")] == stats([it[0] for it in items], True)
    assert prof[("tags", "value")] == stats(tags, True)
    assert prof[("scores", "value")] == stats(scores, False)
