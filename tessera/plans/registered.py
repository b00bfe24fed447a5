"""The registered queries (one per operator group of the survey) and their
DuckDB oracles.

Every query reads whole tables from ``sf_dir`` (or documents Spark derives
from them) and returns a DataFrame whose column names equal the oracle's.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import combinations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tessera.functions import jsonops as J
from tessera.functions import values as V
from tessera.operators import fields as FL
from tessera.operators import inferred as IN
from tessera.operators import profile as P
from tessera.operators import relations as RL
from tessera.operators import reshape as R
from tessera.operators.common import union_all
from tessera.plans import migration as MG
from tessera.plans import profiling as PR
from tessera.session import scratch_path
from tessera.sources import derived as D
from tessera.sources import sinks as SK
from tessera.sources import documents as S
from tessera.sources.documents import TEST_TABLES, read_table_files

KEY_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]
COUNT_TABLES = ["customer", "orders", "part", "supplier"]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def wrap(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return wrap


def _tables(spark, sf_dir, names):
    return read_table_files(spark, sf_dir, names)




# Column lists of the test tables, used to spell out the oracles.
TABLE_COLUMNS = {
    "region": ["r_regionkey", "r_name"],
    "nation": ["n_nationkey", "n_name", "n_regionkey"],
    "customer": ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"],
    "supplier": ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"],
    "part": ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"],
    "orders": ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
               "o_orderpriority"],
    "lineitem": ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                 "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
                 "l_shipdate"],
    "events": ["event_id", "ts", "user_id", "event_type", "value", "props"],
    "documents": ["doc_id", "text", "lang", "source", "n_chars"],
    "embeddings": ["vec_id", "embedding", "label"],
    "pages": ["page_id", "url", "html"],
    "benchmark": ["item_id", "text"],
    "labels": ["doc_id", "quality", "toxic"],
    "conversations": ["conv_id", "turn", "role", "text"],
}


def _distinct_sql(table: str, cols: list[str], source: str | None = None) -> str:
    src = source or table
    return "\nUNION ALL\n".join(
        f"SELECT '{table}' AS table_name, '{c}' AS column_name, count(*) AS n_rows, "
        f"count(DISTINCT {c}) AS n_distinct, (count(*) - count({c})) AS n_null FROM {src}"
        for c in cols)


# --- A1 ---------------------------------------------------------------------

@register("row_counts", "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in TEST_TABLES))
def q_row_counts(spark, sf_dir):
    return P.row_counts(_tables(spark, sf_dir, TEST_TABLES))


# --- A2 ---------------------------------------------------------------------

@register("distinct_counts", "\nUNION ALL\n".join(
    _distinct_sql(t, TABLE_COLUMNS[t]) for t in COUNT_TABLES))
def q_distinct_counts(spark, sf_dir):
    t = _tables(spark, sf_dir, COUNT_TABLES)
    return union_all([P.distinct_counts(t[n], table_name=n) for n in COUNT_TABLES])


_ALL_COMPARABLE = {t: [c for c in cols if not (t == "embeddings" and c == "embedding")]
                   for t, cols in TABLE_COLUMNS.items()}


@register("distinct_counts_all", "\nUNION ALL\n".join(
    _distinct_sql(t, _ALL_COMPARABLE[t]) for t in TEST_TABLES))
def q_distinct_counts_all(spark, sf_dir):
    # A2 over every key-eligible column of all 14 tables (arrays excluded, F3).
    t = _tables(spark, sf_dir, TEST_TABLES)
    return union_all([P.distinct_counts(t[n], table_name=n) for n in TEST_TABLES])


# --- A3 ---------------------------------------------------------------------

@register("unique_columns", f"""
SELECT table_name, column_name, n_rows, n_distinct FROM (
{chr(10).join(['UNION ALL ' + _distinct_sql(t, TABLE_COLUMNS[t]) if i else _distinct_sql(t, TABLE_COLUMNS[t])
               for i, t in enumerate(KEY_TABLES)])}
) WHERE n_distinct = n_rows""")
def q_unique_columns(spark, sf_dir):
    return P.unique_columns_of(_tables(spark, sf_dir, KEY_TABLES))


def _column_sets_sql(size: int) -> str:
    """Every set of up to ``size`` columns whose combinations are as many as
    the rows, without those that contain another one."""
    rows = [f"SELECT '{t}' AS table_name, {list(some)} AS columns, count(*) AS n_rows, count(DISTINCT ({', '.join(some)})) AS n_distinct FROM {t}"
            for t in KEY_TABLES for k in range(1, size + 1) for some in combinations(TABLE_COLUMNS[t], k)]
    return ("WITH counted AS (" + "\nUNION ALL ".join(rows) + "), sets AS (SELECT * FROM counted WHERE n_rows = n_distinct)\n"
            "SELECT table_name, columns, n_rows FROM sets a WHERE NOT EXISTS (SELECT 1 FROM sets b WHERE b.table_name = a.table_name "
            "AND len(b.columns) < len(a.columns) AND list_has_all(a.columns, b.columns))")


@register("unique_column_sets", _column_sets_sql(2))
def q_unique_column_sets(spark, sf_dir):
    return P.unique_column_sets({n: S.spread(t) for n, t in _tables(spark, sf_dir, KEY_TABLES).items()}, max_size=2)


_NULLED_ORDERS_SQL = ("(SELECT *, nullif(o_orderkey, 0) AS o_orderkey_n, "
                      "nullif(nullif(o_orderkey, 0), 1) AS o_orderkey_nn FROM orders)")
_NULLED_COLS = TABLE_COLUMNS["orders"] + ["o_orderkey_n", "o_orderkey_nn"]


def nulled_orders(orders: DataFrame) -> DataFrame:
    """orders plus a key copy with one NULL and one with two NULLs."""
    return orders.select(
        "*", F.nullif("o_orderkey", F.lit(0)).alias("o_orderkey_n"),
        F.nullif(F.nullif("o_orderkey", F.lit(0)), F.lit(1)).alias("o_orderkey_nn"))


@register("unique_columns_null_group", f"""
SELECT table_name, column_name, n_rows, n_distinct FROM (
{_distinct_sql('orders', _NULLED_COLS, _NULLED_ORDERS_SQL)}
) WHERE n_distinct + (CASE WHEN n_null > 0 THEN 1 ELSE 0 END) = n_rows""")
def q_unique_columns_null_group(spark, sf_dir):
    orders = _tables(spark, sf_dir, ["orders"])["orders"]
    return P.unique_columns(nulled_orders(orders), "orders", nulls="group")




# --- documents derived from the tables --------------------------------------

def order_docs(spark, sf_dir) -> DataFrame:
    t = _tables(spark, sf_dir, ["orders", "lineitem"])
    return D.order_documents(t["orders"], t["lineitem"])


def customer_docs(spark, sf_dir) -> DataFrame:
    return D.customer_documents(_tables(spark, sf_dir, ["customer"])["customer"])


_LINE_TYPES = {"l_linenumber": "int", "l_partkey": "bigint", "l_suppkey": "bigint",
               "l_quantity": "double", "l_extendedprice": "double", "l_discount": "double",
               "l_tax": "double", "l_returnflag": "string", "l_linestatus": "string",
               "l_shipdate": "timestamp_ntz"}
_ORDER_TYPES = {"o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string",
                "o_totalprice": "double", "o_orderdate": "timestamp_ntz",
                "o_orderpriority": "string"}
_LINES_OF_ORDERS = "(SELECT * FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders))"


def _profile_sql(table, path, relation, parent, types, src, nullable=True):
    parent_sql = "CAST(NULL AS VARCHAR)" if parent is None else f"'{parent}'"
    out = []
    for c, ty in types.items():
        ln = (f"CAST(min(length({c})) AS BIGINT), CAST(max(length({c})) AS BIGINT)"
              if ty == "string" else "CAST(NULL AS BIGINT), CAST(NULL AS BIGINT)")
        lo, hi = ln.split("), ")[0] + ")", ln.split("), ")[1]
        out.append(f"SELECT '{table}' AS table_name, '{path}' AS path, '{relation}' AS relation, "
                   f"{parent_sql} AS parent, '{c}' AS field_name, '{ty}' AS field_type, "
                   f"{str(nullable).lower()} AS nullable, count(*) AS n_rows, "
                   f"(count(*) - count({c})) AS n_null, "
                   f"{lo} AS len_min, {hi} AS len_max FROM {src}")
    return "\nUNION ALL\n".join(out)


# --- N1 -----------------------------------------------------------------------

@register("field_profile",
          _profile_sql("orders", "", "root", None, _ORDER_TYPES, "orders")
          + "\nUNION ALL\n"
          + _profile_sql("lines", "lines", "1_n", "orders", _LINE_TYPES, _LINES_OF_ORDERS))
def q_field_profile(spark, sf_dir):
    return FL.field_profile(order_docs(spark, sf_dir), "orders")


# --- N2, N3, N4/N5/F4 ---------------------------------------------------------

@register("split_struct",
          "SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer")
def q_split_struct(spark, sf_dir):
    return R.split_struct(customer_docs(spark, sf_dir), "profile", "c_custkey")


@register("split_array", f"""
SELECT l_orderkey AS o_orderkey,
       CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY
            {', '.join(D.LINE_FIELDS)}) - 1 AS INTEGER) AS lines_pos,
       {', '.join(D.LINE_FIELDS)}
FROM {_LINES_OF_ORDERS}""")
def q_split_array(spark, sf_dir):
    return R.split_array(order_docs(spark, sf_dir), "lines", "o_orderkey")


@register("split_array_scalars", """
SELECT vec_id, CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS embedding_pos,
       unnest(embedding) AS value
FROM embeddings""")
def q_split_array_scalars(spark, sf_dir):
    emb = _tables(spark, sf_dir, ["embeddings"])["embeddings"]
    return R.split_array(emb, "embedding", "vec_id")


@register("root_table", """
SELECT hex(o_orderkey) AS _id, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
       o_orderpriority
FROM orders""")
def q_root_table(spark, sf_dir):
    docs = D.with_object_id(order_docs(spark, sf_dir), "o_orderkey")
    return R.root_table(R.collapse_ids(docs))


@register("array_text", """
SELECT page_id, string_split(url, '/') AS parts,
       list_filter(string_split(url, '/'), lambda x, i: i != 2) AS parts_but_second
FROM pages""")
def q_array_text(spark, sf_dir):
    pages = _tables(spark, sf_dir, ["pages"])["pages"]
    ids = pages.select("page_id", F.transform(F.split("url", "/"),
                                              lambda x: F.struct(x.alias("oid"))).alias("ids"))
    dt = ids.schema["ids"].dataType
    parts = V.array_text(F.col("ids"), dt)
    return ids.select("page_id", parts.alias("parts"),
                      V.drop_element(parts, 1).alias("parts_but_second"))


# --- S2 -----------------------------------------------------------------------

@register("projected_paths", """
SELECT c_custkey, c_name AS profile_c_name, c_acctbal AS profile_c_acctbal FROM customer""")
def q_projected_paths(spark, sf_dir):
    return S.read_paths(customer_docs(spark, sf_dir),
                        ["c_custkey", "profile.c_name", "profile.c_acctbal"])


# --- A4/A5, A6, A7 --------------------------------------------------------------

@register("nested_unique_columns", """
WITH top AS (
  SELECT 'c_custkey' AS column_name, count(DISTINCT c_custkey) = count(*) AS u FROM customer
  UNION ALL SELECT 'c_nationkey', count(DISTINCT c_nationkey) = count(*) FROM customer
  UNION ALL SELECT 'profile', count(DISTINCT struct_pack(c_name, c_acctbal, c_mktsegment))
                               = count(*) FROM customer),
sub AS (
  SELECT 'profile.c_name' AS column_name, count(DISTINCT c_name) = count(*) AS u FROM customer
  UNION ALL SELECT 'profile.c_acctbal', count(DISTINCT c_acctbal) = count(*) FROM customer
  UNION ALL SELECT 'profile.c_mktsegment', count(DISTINCT c_mktsegment) = count(*) FROM customer),
keys AS (
  SELECT column_name FROM top WHERE u
  UNION ALL
  SELECT column_name FROM sub WHERE u AND (SELECT u FROM top WHERE column_name = 'profile'))
SELECT 'customer' AS table_name, column_name FROM keys
WHERE column_name NOT IN (SELECT split_part(column_name, '.', 1) FROM keys
                          WHERE column_name LIKE '%.%')""")
def q_nested_unique_columns(spark, sf_dir):
    return P.nested_unique_columns(customer_docs(spark, sf_dir), "customer")


_TEXT_COLUMNS = {"part": ["p_name", "p_brand", "p_type"],
                 "customer": ["c_name", "c_mktsegment"],
                 "documents": ["text", "lang", "source"]}


@register("length_stats", "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, '{c}' AS column_name, "
    f"CAST(coalesce(min(length({c})), 0) AS BIGINT) AS len_min, "
    f"CAST(coalesce(max(length({c})), 0) AS BIGINT) AS len_max FROM {t}"
    for t, cs in _TEXT_COLUMNS.items() for c in cs))
def q_length_stats(spark, sf_dir):
    t = _tables(spark, sf_dir, list(_TEXT_COLUMNS))
    # Text columns only: doubles print differently in each engine.
    return union_all([P.length_stats(t[n], n, include_double=False) for n in _TEXT_COLUMNS])


@register("sample_values", """
SELECT c_custkey, c_name AS value FROM customer ORDER BY c_custkey LIMIT 10""")
def q_sample_values(spark, sf_dir):
    return P.sample_values(customer_docs(spark, sf_dir), "profile.c_name", "c_custkey", 10)


# --- R1-R10: value matching and keys -------------------------------------------

def link_collections(spark, sf_dir) -> dict[str, DataFrame]:
    """nation, customer (with its nation's name as text) and supplier, with
    integer keys cast to text so the reference's text-only rule can link
    them."""
    t = _tables(spark, sf_dir, ["nation", "customer", "supplier"])
    s = lambda c: F.col(c).cast("string").alias(c)
    names = t["nation"].select(F.col("n_nationkey").alias("c_nationkey"),
                               F.col("n_name").alias("c_nation"))
    return {
        "nation": t["nation"].select(s("n_nationkey"), "n_name", s("n_regionkey")),
        "customer": t["customer"].join(names, "c_nationkey", "left").select(
            s("c_custkey"), "c_name", "c_nation", s("c_nationkey"), "c_acctbal", "c_mktsegment"),
        "supplier": t["supplier"].select(s("s_suppkey"), "s_name", s("s_nationkey"), "s_acctbal"),
    }


LINK_SPEC = [
    ("nation", "SELECT CAST(n_nationkey AS VARCHAR) AS n_nationkey, n_name, "
               "CAST(n_regionkey AS VARCHAR) AS n_regionkey FROM nation",
     [("n_nationkey", "text"), ("n_name", "text"), ("n_regionkey", "text")]),
    ("customer", "SELECT CAST(c.c_custkey AS VARCHAR) AS c_custkey, c.c_name, n.n_name AS c_nation, "
                 "CAST(c.c_nationkey AS VARCHAR) AS c_nationkey, c.c_acctbal, c.c_mktsegment "
                 "FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey",
     [("c_custkey", "text"), ("c_name", "text"), ("c_nation", "text"), ("c_nationkey", "text"),
      ("c_acctbal", "other"), ("c_mktsegment", "text")]),
    ("supplier", "SELECT CAST(s_suppkey AS VARCHAR) AS s_suppkey, s_name, "
                 "CAST(s_nationkey AS VARCHAR) AS s_nationkey, s_acctbal FROM supplier",
     [("s_suppkey", "text"), ("s_name", "text"), ("s_nationkey", "text"), ("s_acctbal", "other")]),
]

ARRAY_SPEC = [
    ("orders", "SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) "
               "AS o_custkey, o_orderstatus, o_orderpriority FROM orders",
     [("o_orderkey", "text"), ("o_custkey", "text"), ("o_orderstatus", "text"),
      ("o_orderpriority", "text")]),
    ("cust_orders", "SELECT CAST(o_custkey AS VARCHAR) AS c_custkey, "
                    "list(CAST(o_orderkey AS VARCHAR)) AS order_keys FROM orders GROUP BY o_custkey",
     [("c_custkey", "text"), ("order_keys", "array")]),
]


def array_collections(spark, sf_dir) -> dict[str, DataFrame]:
    """orders and customers holding the array of their order keys (text)."""
    orders = _tables(spark, sf_dir, ["orders"])["orders"]
    s = lambda c: F.col(c).cast("string").alias(c)
    co = D.customer_order_keys(orders)
    return {
        "orders": orders.select(s("o_orderkey"), s("o_custkey"), "o_orderstatus", "o_orderpriority"),
        "cust_orders": co.select(s("c_custkey"),
                                 F.col("order_keys").cast("array<string>").alias("order_keys")),
    }


def _match_ctes(spec, n=None) -> str:
    """DuckDB CTEs ``vals``, ``uniq``, ``samples`` and ``matches`` for the
    matching of ``spec`` (text rule), over all or the first ``n`` documents."""
    ctes = [f"{t}_c AS ({sql})" for t, sql, _ in spec]
    vals, uniq, samples = [], [], []
    for tp, (t, _, cols) in enumerate(spec):
        for cp, (c, kind) in enumerate(cols):
            if kind == "text":
                vals.append(f"SELECT '{t}' AS t, {tp} AS t_pos, '{c}' AS f, {c} AS v FROM {t}_c")
                uniq.append(f"SELECT '{t}' AS t, '{c}' AS f FROM {t}_c "
                            f"HAVING count(DISTINCT {c}) = count(*)")
            elif kind == "array":
                vals.append(f"SELECT '{t}' AS t, {tp} AS t_pos, '{c}' AS f, unnest({c}) AS v "
                            f"FROM {t}_c")
        key = cols[0][0]
        texts = [(cp, c) for cp, (c, kind) in enumerate(cols) if kind == "text"]
        top = (f"(SELECT *, row_number() OVER (ORDER BY {key}) - 1 AS doc FROM {t}_c "
               f"ORDER BY {key}{f' LIMIT {n}' if n else ''})")
        for cp, c in texts:
            samples.append(
                f"SELECT '{t}' AS to_table, {tp} AS to_pos, CAST(doc AS INTEGER) AS doc, "
                f"'{c}' AS to_field, {-cp} AS u_rank, {c} AS value FROM {top} "
                f"WHERE EXISTS (SELECT 1 FROM uniq WHERE t = '{t}' AND f = '{c}')")
    ctes.append("vals AS (" + " UNION ALL ".join(vals) + ")")
    ctes.append("uniq AS (" + " UNION ALL ".join(uniq) + ")")
    ctes.append("samples AS (" + " UNION ALL ".join(samples) + ")")
    ctes.append("matches AS (SELECT DISTINCT v.t AS from_table, v.f AS from_field, s.to_table, "
                "s.to_field, s.doc, v.t_pos AS from_pos, s.to_pos, s.u_rank FROM vals v "
                "JOIN samples s ON v.v = s.value AND v.t <> s.to_table WHERE v.v IS NOT NULL)")
    ctes.append("fks AS (SELECT from_table, from_field, "
                "arg_max(to_table, CAST(to_pos AS BIGINT) * 1000000000000000 + CAST(doc AS BIGINT) * 1000 + u_rank + 500) AS to_table, "
                "arg_max(to_field, CAST(to_pos AS BIGINT) * 1000000000000000 + CAST(doc AS BIGINT) * 1000 + u_rank + 500) AS to_field "
                "FROM matches GROUP BY from_table, from_field)")
    return "WITH " + ",\n".join(ctes)


def _summary_sql(spec, n=None):
    return (_match_ctes(spec, n) + "\nSELECT from_table, from_field, to_table, to_field, "
            "count(DISTINCT doc) AS matched_samples FROM matches "
            "GROUP BY from_table, from_field, to_table, to_field")


def _pks_cte(spec) -> str:
    names = " UNION ALL ".join(f"SELECT '{t}' AS table_name" for t, _, _ in spec)
    return f""",
tabs AS ({names}),
chosen AS (SELECT to_table AS table_name,
                  arg_max(to_field, CAST(doc AS BIGINT) * 1000000 + from_pos * 1000
                                    + u_rank + 500) AS pk
           FROM matches GROUP BY to_table),
pks AS (SELECT t.table_name,
               CASE WHEN coalesce(c.pk, '_id') IN (SELECT to_field FROM fks) THEN '_id'
                    ELSE coalesce(c.pk, '_id') END AS primary_key
        FROM tabs t LEFT JOIN chosen c ON t.table_name = c.table_name)"""


def _pk_sql(spec):
    return _match_ctes(spec) + _pks_cte(spec) + "\nSELECT table_name, primary_key FROM pks"


@register("match_scalar_sample", _summary_sql(LINK_SPEC, 10))
def q_match_scalar_sample(spark, sf_dir):
    return RL.match_summary(RL.match_sample(link_collections(spark, sf_dir), n=10))


@register("match_scalar", _summary_sql(LINK_SPEC))
def q_match_scalar(spark, sf_dir):
    return RL.match_summary(RL.match_sample(link_collections(spark, sf_dir)))


@register("match_array", _summary_sql(ARRAY_SPEC))
def q_match_array(spark, sf_dir):
    return RL.match_summary(RL.match_sample(array_collections(spark, sf_dir)))


@register("assign_foreign_keys", _match_ctes(LINK_SPEC) + "\nSELECT * FROM fks")
def q_assign_foreign_keys(spark, sf_dir):
    return RL.assign_foreign_keys(RL.match_sample(link_collections(spark, sf_dir)))


@register("link_edges", _match_ctes(LINK_SPEC) + """
SELECT from_table AS "from", from_field AS "fromPort", to_table AS "to", to_field AS "toPort"
FROM fks""")
def q_link_edges(spark, sf_dir):
    return RL.link_edges(RL.assign_foreign_keys(RL.match_sample(link_collections(spark, sf_dir))))


@register("primary_keys", _pk_sql(LINK_SPEC))
def q_primary_keys(spark, sf_dir):
    cols = link_collections(spark, sf_dir)
    matches = RL.match_sample(cols)
    return RL.assign_primary_keys(matches, list(cols))


INCLUSION_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]
_INT_COLUMNS = {"r_regionkey", "n_nationkey", "n_regionkey", "c_custkey", "c_nationkey",
                "s_suppkey", "s_nationkey", "p_partkey", "p_size", "o_orderkey", "o_custkey",
                "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"}
_TEXT_KEYS = {"r_name", "n_name", "c_name", "c_mktsegment", "s_name", "p_name", "p_brand",
              "p_type", "o_orderstatus", "o_orderpriority", "l_returnflag", "l_linestatus"}


def _inclusion_sql():
    vals, uniq = [], []
    for t in INCLUSION_TABLES:
        for c in TABLE_COLUMNS[t]:
            if c in _INT_COLUMNS:
                fam, v = "int", f"CAST(CAST({c} AS BIGINT) AS VARCHAR)"
            elif c in _TEXT_KEYS:
                fam, v = "text", c
            else:
                continue
            vals.append(f"SELECT DISTINCT '{t}' AS t, '{c}' AS f, '{fam}' AS fam, {v} AS v "
                        f"FROM {t} WHERE {c} IS NOT NULL")
            uniq.append(f"SELECT '{t}' AS t, '{c}' AS f FROM {t} "
                        f"HAVING count(DISTINCT {c}) = count(*)")
    return f"""WITH vals AS ({' UNION ALL '.join(vals)}),
uniq AS ({' UNION ALL '.join(uniq)}),
ref AS (SELECT v.* FROM vals v JOIN uniq u ON v.t = u.t AND v.f = u.f),
pairs AS (SELECT d.t AS from_table, d.f AS from_field, r.t AS to_table, r.f AS to_field,
                 count(*) AS matched_values
          FROM vals d JOIN ref r ON d.fam = r.fam AND d.v = r.v AND d.t <> r.t
          GROUP BY d.t, d.f, r.t, r.f),
totals AS (SELECT t AS from_table, f AS from_field, count(*) AS distinct_values
           FROM vals GROUP BY t, f)
SELECT p.from_table, p.from_field, p.to_table, p.to_field, p.matched_values,
       t.distinct_values, p.matched_values / t.distinct_values AS coverage
FROM pairs p JOIN totals t ON p.from_table = t.from_table AND p.from_field = t.from_field"""


@register("match_inclusion", _inclusion_sql())
def q_match_inclusion(spark, sf_dir):
    return RL.match_inclusion(_tables(spark, sf_dir, INCLUSION_TABLES))


@register("orphans", """
SELECT 'orders.o_orderkey -> lineitem.l_orderkey' AS check_name, o_orderkey AS child_key
FROM orders o WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)
UNION ALL
SELECT 'orders.o_custkey -> customer.c_custkey', o_custkey
FROM orders o WHERE NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = o.o_custkey)""")
def q_orphans(spark, sf_dir):
    t = _tables(spark, sf_dir, ["orders", "lineitem", "customer"])
    a = RL.check_foreign_keys(t["orders"], t["lineitem"], "o_orderkey", "l_orderkey").select(
        F.lit("orders.o_orderkey -> lineitem.l_orderkey").alias("check_name"),
        F.col("o_orderkey").alias("child_key"))
    b = RL.check_foreign_keys(t["orders"], t["customer"], "o_custkey", "c_custkey").select(
        F.lit("orders.o_custkey -> customer.c_custkey").alias("check_name"),
        F.col("o_custkey").alias("child_key"))
    return a.unionByName(b)


@register("rename_columns", """
SELECT n_nationkey AS nation_id, n_name, n_regionkey AS region_ref, 0 AS n_orphans
FROM nation n WHERE EXISTS (SELECT 1 FROM region r WHERE r.r_regionkey = n.n_regionkey)""")
def q_rename_columns(spark, sf_dir):
    t = _tables(spark, sf_dir, ["nation", "region"])
    edges = spark.createDataFrame(
        [("nation", "n_regionkey", "region", "r_regionkey")],
        "from_table string, from_field string, to_table string, to_field string")
    renames = {"nation": {"n_nationkey": "nation_id", "n_regionkey": "region_ref"},
               "region": {"r_regionkey": "region_id"}}
    tabs, pks, new_edges = R.rename_cascade(t, renames, {"nation": "n_nationkey",
                                                        "region": "r_regionkey"}, edges)
    # The edge list is the schema graph: one row per foreign key.
    e = new_edges.collect()[0]
    child, parent = tabs[e["from_table"]], tabs[e["to_table"]]
    orphans = RL.check_foreign_keys(child, parent, e["from_field"], e["to_field"])
    kept = child.join(parent.select(F.col(e["to_field"]).alias("__k")),
                      F.col(e["from_field"]) == F.col("__k"), "left_semi")
    # One number, attached as a scalar subquery (no join).
    n_orph = orphans.agg(F.count(F.lit(1)).cast("int")).scalar()
    return kept.select(pks["nation"], "n_name", e["from_field"], n_orph.alias("n_orphans"))


# --- J1-J6: JSON text ---------------------------------------------------------

def customer_json(spark, sf_dir) -> DataFrame:
    return D.as_json_text(customer_docs(spark, sf_dir), keep=["c_custkey"])


def as_document(df: DataFrame, keep: list[str]) -> DataFrame:
    """The whole row as one typed document column ``doc`` next to ``keep``."""
    return df.select(*keep, F.struct(*df.columns).alias("doc"))


def order_json(spark, sf_dir) -> DataFrame:
    return D.as_json_text(order_docs(spark, sf_dir), keep=["o_orderkey"])


@register("json_find", "SELECT c_custkey, c_name AS value FROM customer")
def q_json_find(spark, sf_dir):
    return J.json_find(customer_json(spark, sf_dir), "json", "c_name", keep=["c_custkey"])


@register("json_find_typed", "SELECT c_custkey, c_name AS value FROM customer")
def q_json_find_typed(spark, sf_dir):
    # Same search on the typed document: the walk depth comes from the schema.
    docs = as_document(customer_docs(spark, sf_dir), ["c_custkey"])
    return J.json_find(docs, "doc", "c_name", keep=["c_custkey"])


@register("json_strings", """
SELECT c_custkey, 'c_name' AS key, c_name AS value FROM customer
UNION ALL SELECT c_custkey, 'c_mktsegment', c_mktsegment FROM customer""")
def q_json_strings(spark, sf_dir):
    return J.json_strings(customer_json(spark, sf_dir), "json", keep=["c_custkey"])


@register("json_rejects", """
SELECT p.page_id, CASE WHEN p.page_id % 3 = 0 THEN 'reject' ELSE 'found' END AS kind, CASE WHEN p.page_id % 3 = 0 THEN left(x.t, length(x.t) - 1) ELSE p.url END AS text
FROM pages p, (SELECT page_id, '{"id":' || page_id || ',"at":{"url":"' || url || '","id":' || page_id || '}}' AS t FROM pages) x WHERE x.page_id = p.page_id
UNION ALL SELECT page_id, 'found', 'again' FROM pages WHERE page_id % 3 = 1""")
def q_json_rejects(spark, sf_dir):
    # Pages as JSON text: every third is cut off, every third names a field
    # twice, which is legal.
    pages = _tables(spark, sf_dir, ["pages"])["pages"]
    head = F.concat(F.lit('{"id":'), "page_id", F.lit(',"at":{"url":"'), "url", F.lit('"'))
    tail = F.concat(F.lit(',"id":'), "page_id", F.lit("}}"))
    again = F.when(F.col("page_id") % 3 == 1, F.lit(',"url":"again"')).otherwise("")
    text = F.concat(head, again, tail)
    docs = pages.select("page_id", text.alias("t")).select(
        "page_id", F.when(F.col("page_id") % 3 == 0, F.expr("left(t, length(t) - 1)")).otherwise(F.col("t")).alias("json"))
    found = J.json_find(docs, "json", "url", ["page_id"], Observation())
    return (found.select("page_id", F.lit("found").alias("kind"), F.col("value").alias("text"))
            .unionByName(J.json_rejects(docs, "json", ["page_id"]).select("page_id", F.lit("reject").alias("kind"), "text")))


@register("json_count", """
SELECT o.o_orderkey, count(l.l_orderkey) AS n_lines
FROM orders o LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey GROUP BY o.o_orderkey""")
def q_json_count(spark, sf_dir):
    docs = order_json(spark, sf_dir)
    return docs.select("o_orderkey", J.json_count(F.col("json"), "lines", "l_tax")
                       .cast("bigint").alias("n_lines"))


@register("json_field", "SELECT event_id, json_extract_string(props, '$.k') AS k FROM events")
def q_json_field(spark, sf_dir):
    ev = _tables(spark, sf_dir, ["events"])["events"]
    return ev.select("event_id", J.json_field(F.col("props"), "$.k").alias("k"))


_LINE_ORDER = ", ".join(f"l.{c}" for c in D.LINE_FIELDS)


@register("json_field_nested", f"""
WITH first_line AS (
  SELECT l.l_orderkey, first(l.l_returnflag ORDER BY {_LINE_ORDER}) AS first_flag
  FROM lineitem l GROUP BY l.l_orderkey)
SELECT o.o_orderkey, f.first_flag,
       CASE WHEN f.l_orderkey IS NULL THEN NULL ELSE 'struct' END AS first_kind,
       CASE WHEN f.l_orderkey IS NULL THEN NULL ELSE 'array' END AS lines_kind
FROM orders o LEFT JOIN first_line f ON f.l_orderkey = o.o_orderkey""")
def q_json_field_nested(spark, sf_dir):
    docs = order_json(spark, sf_dir)
    j = F.col("json")
    return docs.select("o_orderkey",
                       J.json_field(j, "$.lines[0].l_returnflag").alias("first_flag"),
                       J.json_field(j, "$.lines[0]").alias("first_kind"),
                       J.json_field(j, "$.lines").alias("lines_kind"))


@register("json_children", f"""
WITH first_order AS (SELECT o_custkey, min(o_orderkey) AS ok FROM orders GROUP BY o_custkey),
vals AS (
  SELECT f.o_custkey, list(l.l_returnflag ORDER BY {_LINE_ORDER}) AS v, count(*) AS n
  FROM first_order f JOIN lineitem l ON l.l_orderkey = f.ok GROUP BY f.o_custkey)
SELECT c.c_custkey, CASE WHEN v.n >= 2 THEN v.v END AS member_values
FROM customer c LEFT JOIN vals v ON v.o_custkey = c.c_custkey""")
def q_json_children(spark, sf_dir):
    t = _tables(spark, sf_dir, ["customer", "orders", "lineitem"])
    docs = as_document(D.customer_order_documents(t["customer"], t["orders"], t["lineitem"]),
                       ["c_custkey"])
    return J.json_children(docs, "doc", "orders", 0, "l_returnflag", keep=["c_custkey"])


@register("json_array_rows", f"""
SELECT l_orderkey AS o_orderkey, {', '.join(D.LINE_FIELDS)} FROM {_LINES_OF_ORDERS}""")
def q_json_array_rows(spark, sf_dir):
    docs = order_docs(spark, sf_dir)
    elem = docs.schema["lines"].dataType.elementType
    text = D.as_json_text(docs, keep=["o_orderkey"])
    return J.json_array_rows(text, "json", "$.lines", elem, keep=["o_orderkey"])


# --- N1, S10 from the values ---------------------------------------------------

def mixed_line_json(spark, sf_dir) -> DataFrame:
    """Every line as JSON text in which ``v`` is a number, a text, null, an
    array, an object or missing, by the line's part."""
    lines = S.spread(_tables(spark, sf_dir, ["lineitem"])["lineitem"])
    return lines.select(F.expr("""concat('{"id":', l_orderkey, CASE l_partkey % 6
        WHEN 0 THEN concat(',"v":', l_suppkey) WHEN 1 THEN concat(',"v":"', l_returnflag, '"') WHEN 2 THEN ',"v":null'
        WHEN 3 THEN concat(',"v":[', l_linenumber, ',"x",{"w":true}]')
        WHEN 4 THEN concat(',"v":{"w":', l_suppkey, ',"z":[[1.5],[],[null]]}') ELSE '' END, '}')""").alias("json"))


_KINDS_SQL = r"""
WITH lines AS (
  SELECT '{"id":' || l_orderkey || CASE l_partkey % 6
    WHEN 0 THEN ',"v":' || l_suppkey WHEN 1 THEN ',"v":"' || l_returnflag || '"' WHEN 2 THEN ',"v":null'
    WHEN 3 THEN ',"v":[' || l_linenumber || ',"x",{"w":true}]'
    WHEN 4 THEN ',"v":{"w":' || l_suppkey || ',"z":[[1.5],[],[null]]}' ELSE '' END || '}' AS json FROM lineitem),
docs AS (SELECT 'events' AS collection, props AS json FROM events WHERE props IS NOT NULL
         UNION ALL SELECT 'lines', json FROM lines),
nodes AS (
  SELECT d.collection, regexp_replace(t.fullkey, '\[\d+\]', '[]', 'g') AS path,
         CASE WHEN t.parent IS NULL THEN NULL ELSE regexp_replace(t.path, '\[\d+\]', '[]', 'g') END AS parent,
         CASE t.type WHEN 'OBJECT' THEN 'object' WHEN 'ARRAY' THEN 'array' WHEN 'VARCHAR' THEN 'text' WHEN 'NULL' THEN 'null'
                     WHEN 'BOOLEAN' THEN 'boolean' WHEN 'DOUBLE' THEN 'fraction' ELSE 'integer' END AS kind
  FROM docs d, json_tree(d.json) t),
kinds AS (SELECT collection, parent, path, kind, count(*) AS n FROM nodes GROUP BY ALL)
SELECT k.collection, k.parent, k.path, sum(k.n)::BIGINT AS n_values, coalesce(sum(k.n) FILTER (k.kind = 'null'), 0)::BIGINT AS n_null,
       CASE WHEN k.path <> k.parent || '[]' THEN (first(o.n) - sum(k.n))::BIGINT END AS n_missing,
       string_agg(k.kind || ':' || k.n, ',' ORDER BY k.kind) AS kinds,
       count(DISTINCT CASE k.kind WHEN 'null' THEN NULL WHEN 'fraction' THEN 'integer' ELSE k.kind END) > 1 AS conflict
FROM kinds k LEFT JOIN kinds o ON o.collection = k.collection AND o.path = k.parent AND o.kind = 'object'
GROUP BY k.collection, k.parent, k.path"""


@register("json_field_profile", _KINDS_SQL)
def q_json_field_profile(spark, sf_dir):
    events = S.spread(_tables(spark, sf_dir, ["events"])["events"])
    parts = [IN.json_field_profile(df, col).select(F.lit(name).alias("collection"), "*")
             for name, df, col in (("events", events, "props"), ("lines", mixed_line_json(spark, sf_dir), "json"))]
    shown = F.transform("kinds", lambda k: F.concat_ws(":", k["kind"], k["n_values"]))
    return union_all(parts).withColumn("kinds", F.array_join(shown, ","))


# --- M1: profile a document database -----------------------------------------

def profile_collections(spark, sf_dir) -> dict[str, DataFrame]:
    """customer documents (with an embedded profile and the nation's name)
    and nation documents, keys as text."""
    t = _tables(spark, sf_dir, ["customer", "nation"])
    s = lambda c: F.col(c).cast("string").alias(c)
    names = t["nation"].select(F.col("n_nationkey").alias("c_nationkey"),
                               F.col("n_name").alias("c_nation"))
    cust = t["customer"].join(names, "c_nationkey", "left").select(
        s("c_custkey"), "c_nation", s("c_nationkey"),
        F.struct("c_name", "c_acctbal", "c_mktsegment").alias("profile"))
    nation = t["nation"].select(s("n_nationkey"), "n_name", s("n_regionkey"))
    return {"customer": cust, "nation": nation}


PROFILE_SPEC = [
    ("customer", "SELECT CAST(c.c_custkey AS VARCHAR) AS c_custkey, n.n_name AS c_nation, "
                 "CAST(c.c_nationkey AS VARCHAR) AS c_nationkey "
                 "FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey",
     [("c_custkey", "text"), ("c_nation", "text"), ("c_nationkey", "text"), ("profile", "other")]),
    ("nation", "SELECT CAST(n_nationkey AS VARCHAR) AS n_nationkey, n_name, "
               "CAST(n_regionkey AS VARCHAR) AS n_regionkey FROM nation",
     [("n_nationkey", "text"), ("n_name", "text"), ("n_regionkey", "text")]),
]
_PROFILE_FIELDS = [("customer", "c_custkey", "string", True), ("customer", "c_nation", "string", True),
                   ("customer", "c_nationkey", "string", True), ("profile", "c_name", "string", False),
                   ("profile", "c_acctbal", "double", False), ("profile", "c_mktsegment", "string", False),
                   ("nation", "n_nationkey", "string", True), ("nation", "n_name", "string", True),
                   ("nation", "n_regionkey", "string", True)]


def _profile_documents_sql() -> str:
    vals = ", ".join(f"('{t}', '{f}', '{ty}', {str(r).lower()})" for t, f, ty, r in _PROFILE_FIELDS)
    return (_match_ctes(PROFILE_SPEC) + _pks_cte(PROFILE_SPEC) + f""",
flds AS (SELECT * FROM (VALUES {vals}) AS v(table_name, field_name, field_type, is_root))
SELECT f.table_name, f.field_name, f.field_type,
       CASE WHEN f.is_root THEN k.to_table END AS ref_table,
       CASE WHEN f.is_root THEN k.to_field END AS ref_field,
       CASE WHEN f.is_root THEN p.primary_key ELSE '_id' END AS primary_key
FROM flds f
LEFT JOIN fks k ON f.is_root AND k.from_table = f.table_name AND k.from_field = f.field_name
LEFT JOIN pks p ON f.is_root AND p.table_name = f.table_name""")


@register("profile_documents", _profile_documents_sql())
def q_profile_documents(spark, sf_dir):
    prof = PR.profile_documents(profile_collections(spark, sf_dir))
    return prof.fields.select("table_name", "field_name", "field_type", "ref_table", "ref_field",
                              "primary_key")


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The smoke query: M1 over customer and nation documents."""
    return q_profile_documents(spark, sf_dir)


# --- S1, N7/S9, M2, M4: writes and read-backs under the checkpoint folder -------

@register("read_documents", """
SELECT c_custkey, c_name, c_acctbal, CAST(c_nationkey AS BIGINT) AS c_nationkey FROM customer""")
def q_read_documents(spark, sf_dir):
    out = scratch_path(spark, "customer-docs")
    SK.write_documents(customer_docs(spark, sf_dir), out, fmt="json")
    back = S.read_documents(spark, out, fmt="json")
    return back.select("c_custkey", F.col("profile.c_name").alias("c_name"),
                       F.col("profile.c_acctbal").alias("c_acctbal"), "c_nationkey")


@register("table_to_documents", "SELECT * FROM nation")
def q_table_to_documents(spark, sf_dir):
    nation = _tables(spark, sf_dir, ["nation"])["nation"]
    out = scratch_path(spark, "nation-json")
    R.table_to_documents(nation, as_json=True).write.text(out)
    return S.read_documents(spark, out, fmt="json", schema=nation.schema)


@register("migrate_tables", """
SELECT 'region' AS table_name, CAST(r_regionkey AS BIGINT) AS id, r_name AS name FROM region
UNION ALL SELECT 'nation', CAST(n_nationkey AS BIGINT), n_name FROM nation""")
def q_migrate_tables(spark, sf_dir):
    src = _tables(spark, sf_dir, ["region", "nation"])
    paths = MG.migrate_tables(src, scratch_path(spark, "tables-to-docs"))
    r = S.read_documents(spark, paths["region"])
    n = S.read_documents(spark, paths["nation"])
    return (r.select(F.lit("region").alias("table_name"), F.col("r_regionkey").alias("id"),
                     F.col("r_name").alias("name"))
            .unionByName(n.select(F.lit("nation").alias("table_name"),
                                  F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"))))


_RENAMED_LINE_FIELDS = [("tax" if c == "l_tax" else c) for c in D.LINE_FIELDS]


@register("migrate_documents", f"""
SELECT hex(l_orderkey) AS _id,
       CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY
            {', '.join(D.LINE_FIELDS)}) - 1 AS INTEGER) AS lines_pos,
       {', '.join(c if c != 'l_tax' else 'l_tax AS tax' for c in D.LINE_FIELDS)}
FROM {_LINES_OF_ORDERS}""")
def q_migrate_documents(spark, sf_dir):
    docs = D.with_object_id(order_docs(spark, sf_dir), "o_orderkey")
    out = scratch_path(spark, "docs-to-tables")
    # The documents come out of a join and a grouping: materialize them once.
    MG.migrate_documents(docs, "orders", MG.PathTarget(out), primary_keys={"orders": "_id"},
                         edges=[("lines", "_id", "orders", "_id")],
                         renames={"lines": {"l_tax": "tax"}}, materialize=True)
    return spark.read.parquet(f"{out}/lines")


# --- more shapes: struct + scalar-array children, maps ---------------------------

def customer_order_key_docs(spark, sf_dir) -> DataFrame:
    """customer documents with their sorted order keys (NULL when none)."""
    t = _tables(spark, sf_dir, ["customer", "orders"])
    return D.customer_documents(t["customer"]).join(D.customer_order_keys(t["orders"]),
                                                     "c_custkey", "left")


_CUSTOMER_ROOT_TYPES = {"c_custkey": "bigint", "c_nationkey": "int"}
_PROFILE_TYPES = {"c_name": "string", "c_acctbal": "double", "c_mktsegment": "string"}
_ORDER_KEYS_OF_CUSTOMERS = ("(SELECT o_orderkey AS value FROM orders "
                            "WHERE o_custkey IN (SELECT c_custkey FROM customer))")


@register("field_profile_nested",
          _profile_sql("customer", "", "root", None, _CUSTOMER_ROOT_TYPES, "customer")
          + "\nUNION ALL\n"
          + _profile_sql("profile", "profile", "1_1", "customer", _PROFILE_TYPES, "customer")
          + "\nUNION ALL\n"
          # collect_list never holds NULL, so the element is declared non-null.
          + _profile_sql("order_keys", "order_keys", "1_n", "customer", {"value": "bigint"},
                         _ORDER_KEYS_OF_CUSTOMERS, nullable=False))
def q_field_profile_nested(spark, sf_dir):
    return FL.field_profile(customer_order_key_docs(spark, sf_dir), "customer")


@register("split_map", """
SELECT e.event_id, CAST(0 AS INTEGER) AS props_pos, k.key AS key,
       CAST(json_extract(e.props, '$.' || k.key) AS INTEGER) AS value
FROM events e, (SELECT unnest(json_keys(props)) AS key, event_id FROM events) k
WHERE k.event_id = e.event_id""")
def q_split_map(spark, sf_dir):
    ev = _tables(spark, sf_dir, ["events"])["events"]
    m = ev.select("event_id", F.from_json("props", "map<string,int>").alias("props"))
    return R.split_array(m, "props", "event_id")



# --- N6: three levels of nesting, every table --------------------------------------

_ORDERS_OF_CUSTOMERS = ("(SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS orders_pos "
                        "FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer))")


@register("documents_to_tables", f"""
WITH o AS {_ORDERS_OF_CUSTOMERS},
l AS (SELECT l.*, o.o_custkey, o.orders_pos,
             row_number() OVER (PARTITION BY l_orderkey ORDER BY {', '.join(D.LINE_FIELDS)}) - 1 AS lines_pos
      FROM lineitem l JOIN o ON l.l_orderkey = o.o_orderkey)
SELECT 'customer' AS table_name, c_custkey, CAST(NULL AS INTEGER) AS orders_pos, CAST(NULL AS INTEGER) AS lines_pos,
       CAST(c_nationkey AS BIGINT) AS number, c_mktsegment AS text, c_acctbal AS amount FROM customer
UNION ALL SELECT 'orders', o_custkey, CAST(orders_pos AS INTEGER), NULL, o_orderkey, o_orderpriority, o_totalprice FROM o
UNION ALL SELECT 'lines', o_custkey, CAST(orders_pos AS INTEGER), CAST(lines_pos AS INTEGER), l_partkey, l_returnflag, l_extendedprice FROM l""")
def q_documents_to_tables(spark, sf_dir):
    # Every table of customer -> order -> line documents, each row with the
    # whole key of its document and the positions above it.
    t = _tables(spark, sf_dir, ["customer", "orders", "lineitem"])
    split = R.documents_to_tables(D.customer_order_documents(t["customer"], t["orders"], t["lineitem"]), "customer", "c_custkey")
    shown = {"customer": ["c_nationkey", "c_mktsegment", "c_acctbal"], "orders": ["o_orderkey", "o_orderpriority", "o_totalprice"],
             "lines": ["l_partkey", "l_returnflag", "l_extendedprice"]}
    return _long_form(split, ["c_custkey", "orders_pos", "lines_pos"], shown, "c_custkey bigint, orders_pos int, lines_pos int")


def _long_form(tables: dict[str, DataFrame], keys: list[str], shown: dict[str, list[str]], key_types: str) -> DataFrame:
    """All tables below each other: table_name, the keys (NULL where a table
    has none) and one number, text and amount of each."""
    types = dict(x.split() for x in key_types.split(", "))
    return union_all([df.select(
        F.lit(t).alias("table_name"), *[(F.col(k) if k in df.columns else F.lit(None)).cast(types[k]).alias(k) for k in keys],
        F.col(shown[t][0]).cast("bigint").alias("number"), F.col(shown[t][1]).alias("text"), F.col(shown[t][2]).alias("amount"))
        for t, df in tables.items()])


# --- M2 over several linked collections -----------------------------------------------

@register("migrate_collections", f"""
SELECT 'customers' AS table_name, c_custkey AS id, CAST(NULL AS INTEGER) AS lines_pos, CAST(c_nationkey AS BIGINT) AS number,
       CAST(NULL AS VARCHAR) AS text, CAST(NULL AS DOUBLE) AS amount FROM customer
UNION ALL SELECT 'profile', c_custkey, NULL, CAST(NULL AS BIGINT), c_name, c_acctbal FROM customer
UNION ALL SELECT 'orders', o_orderkey, NULL, o_custkey, o_orderstatus, o_totalprice FROM orders
UNION ALL SELECT 'lines', l_orderkey, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY {', '.join(D.LINE_FIELDS)}) - 1 AS INTEGER),
       l_partkey, l_returnflag, l_extendedprice FROM {_LINES_OF_ORDERS}""")
def q_migrate_collections(spark, sf_dir):
    # Customers and orders with their lines, two collections linked by the
    # customer's key, into one folder: root and child tables of both.
    t = _tables(spark, sf_dir, ["customer", "orders", "lineitem"])
    out = scratch_path(spark, "linked-collections")
    done = MG.migrate_collections(
        {"orders": D.order_documents(t["orders"], t["lineitem"]), "customers": D.customer_documents(t["customer"])}, MG.PathTarget(out),
        keys={"orders": "o_orderkey", "customers": "c_custkey"}, edges=[("orders", "o_custkey", "customers", "c_custkey")],
        renames={"orders": {"o_orderkey": "id", "o_custkey": "customer"}, "customers": {"c_custkey": "id"}, "lines": {"o_orderkey": "id"}, "profile": {"c_custkey": "id"}},
        orders={"orders": ["o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus"]}, embedded_links=True, materialize=True)
    back = {name: spark.read.parquet(f"{out}/{name}") for name in done}
    none = F.lit(None)
    back["customers"] = back["customers"].select("id", "c_nationkey", none.cast("string").alias("none"), none.cast("double").alias("nothing"))
    back["profile"] = back["profile"].select("id", none.cast("bigint").alias("none"), "c_name", "c_acctbal")
    shown = {"customers": ["c_nationkey", "none", "nothing"], "profile": ["none", "c_name", "c_acctbal"],
             "orders": ["customer", "o_orderstatus", "o_totalprice"], "lines": ["l_partkey", "l_returnflag", "l_extendedprice"]}
    return _long_form(back, ["id", "lines_pos"], shown, "id bigint, lines_pos int")


# --- R8: orphan rows of a large child ------------------------------------------------------

@register("orphan_lines", """
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_extendedprice FROM lineitem l
WHERE l.l_orderkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = l.l_orderkey AND o.o_orderstatus <> 'F')""")
def q_orphan_lines(spark, sf_dir):
    # Lines whose order is not among those that are still open.
    t = _tables(spark, sf_dir, ["orders", "lineitem"])
    open_orders = t["orders"].where("o_orderstatus <> 'F'")
    return RL.check_foreign_keys(t["lineitem"], open_orders, "l_orderkey", "o_orderkey").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")


# --- M3 over a Spark catalog, verified on the rows ----------------------------------------

M3_TABLES = {"customer": TABLE_COLUMNS["customer"], "orders": TABLE_COLUMNS["orders"], "lineitem": TABLE_COLUMNS["lineitem"], "open_orders": TABLE_COLUMNS["orders"]}
M3_KEYS = {"customer": ("c_custkey",), "orders": ("o_orderkey",), "lineitem": ("l_orderkey", "l_linenumber"), "open_orders": ("o_orderpriority", "o_custkey")}
M3_LINKS = [("orders", ("o_custkey",), "customer", ("c_custkey",)), ("lineitem", ("l_orderkey",), "open_orders", ("o_orderkey",)),
            ("orders", ("o_orderkey", "o_orderstatus"), "open_orders", ("o_orderkey", "o_orderstatus"))]
_OPEN_ORDERS_SQL = "(SELECT * FROM orders WHERE o_orderstatus <> 'F')"


def _m3_sql() -> str:
    source = lambda t: _OPEN_ORDERS_SQL if t == "open_orders" else t
    rows, ctes = [], []
    for t, cols in M3_TABLES.items():
        key = ", ".join(M3_KEYS[t])
        ctes.append(f"key_{t} AS (SELECT count(*) AS n_rows, count(*) FILTER ({' OR '.join(f'{c} IS NULL' for c in M3_KEYS[t])}) AS key_nulls, "
                    f"count(*) - count(DISTINCT ({key})) AS key_duplicates FROM {source(t)})")
    for i, (ft, ff, tt, tf) in enumerate(M3_LINKS):
        same = " AND ".join(f"c.{a} = p.{b}" for a, b in zip(ff, tf, strict=True))
        ctes.append(f"link_{i} AS (SELECT count(*) FILTER ({' OR '.join(f'c.{a} IS NULL' for a in ff)}) AS ref_nulls, "
                    f"count(*) FILTER ({' AND '.join(f'c.{a} IS NOT NULL' for a in ff)} AND p.{tf[0]} IS NULL) AS ref_orphans, "
                    f"(SELECT count(*) - count(DISTINCT ({', '.join(tf)})) FROM {source(tt)}) AS ref_duplicates "
                    f"FROM {source(ft)} c LEFT JOIN (SELECT DISTINCT {', '.join(tf)} FROM {source(tt)}) p ON {same})")
    for t, cols in M3_TABLES.items():
        for c in cols:
            links = [(f"link_{i}", tt, tf[ff.index(c)]) for i, (ft, ff, tt, tf) in enumerate(M3_LINKS) if ft == t and c in ff] or [(None, None, None)]
            for link, tt, tf in links:
                key = "[" + ", ".join(f"'{k}'" for k in M3_KEYS[t]) + "]"
                counts = ", ".join((f"{link}.{x}" if link else "CAST(NULL AS BIGINT)") + f" AS {x}" for x in ("ref_nulls", "ref_orphans", "ref_duplicates"))
                rows.append(f"SELECT '{t}' AS table_name, CAST({cols.index(c) + 1} AS INTEGER) AS position, '{c}' AS field_name, "
                            f"CASE (SELECT any_value(data_type) FROM information_schema.columns WHERE table_name = '{'orders' if t == 'open_orders' else t}' AND column_name = '{c}') "
                            "WHEN 'INTEGER' THEN 'int' WHEN 'BIGINT' THEN 'bigint' WHEN 'VARCHAR' THEN 'string' WHEN 'DOUBLE' THEN 'double' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' END AS field_type, "
                            f"'1' AS nullable, {key} AS primary_key, '{M3_KEYS[t][-1]}' AS primary_key_last, "
                            f"{f"'{tt}'" if tt else 'CAST(NULL AS VARCHAR)'} AS ref_table, {f"'{tf}'" if tf else 'CAST(NULL AS VARCHAR)'} AS ref_field, "
                            f"key_{t}.n_rows, key_{t}.key_nulls, key_{t}.key_duplicates, {counts} FROM key_{t}" + (f", {link}" if link else ""))
    return "WITH " + ",\n".join(ctes) + "\n" + "\nUNION ALL ".join(rows)


@register("profile_tables", _m3_sql())
def q_profile_tables(spark, sf_dir):
    # Tables in a fresh catalog database under the shared checkpoint folder,
    # with keys and links declared, composite ones too, of which some do not
    # hold: the profile says on how many rows.
    t = _tables(spark, sf_dir, ["customer", "orders", "lineitem"])
    t["open_orders"] = t["orders"].where("o_orderstatus <> 'F'")
    db = MG.write_catalog_tables({n: t[n] for n in M3_TABLES}, MG.CatalogTarget("tessera_m3", location=scratch_path(spark, "m3-db")), M3_KEYS, M3_LINKS)
    return PR.profile_catalog_tables(spark, db, list(M3_TABLES), verify=True)
