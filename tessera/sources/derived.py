"""Nested document collections derived from the flat test tables.

The reference works on document collections; the test data is relational.
These builders nest the tables the way a document store would hold them, so
every registered query still reads the given tables and grows with them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.common import qcol

LINE_FIELDS = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
               "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


def order_documents(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """orders + ``lines: array<struct<lineitem columns but l_orderkey>>``.

    Lines are grouped per order (one shuffle of lineitem on ``l_orderkey``;
    the join then reuses that partitioning and shuffles only orders) and
    sorted by their fields so the array order is deterministic. Orders with
    no line keep ``lines = NULL``. Nesting is the point here: a document holds
    all lines of its order, as a document store would.
    """
    lines = (lineitem.groupBy("l_orderkey")
             .agg(F.array_sort(F.collect_list(F.struct(*LINE_FIELDS))).alias("lines")))
    return orders.join(lines, orders.o_orderkey == lines.l_orderkey, "left").drop("l_orderkey")


def customer_documents(customer: DataFrame) -> DataFrame:
    """``c_custkey, c_nationkey, profile: struct<c_name, c_acctbal, c_mktsegment>``."""
    return customer.select(
        "c_custkey", "c_nationkey",
        F.struct("c_name", "c_acctbal", "c_mktsegment").alias("profile"))


def customer_order_keys(orders: DataFrame) -> DataFrame:
    """``c_custkey, order_keys: array<bigint>`` (sorted) from orders."""
    return (orders.groupBy(F.col("o_custkey").alias("c_custkey"))
            .agg(F.array_sort(F.collect_list("o_orderkey")).alias("order_keys")))


def with_object_id(df: DataFrame, key: str, id_name: str = "_id") -> DataFrame:
    """Replace ``key`` by an ObjectId-shaped ``_id: struct<oid: string>`` whose
    text is the hex form of the key, placed first."""
    rest = [qcol(c) for c in df.columns if c != key]
    return df.select(F.struct(F.hex(qcol(key)).alias("oid")).alias(id_name), *rest)


def as_json_text(df: DataFrame, keep: list[str] | None = None, name: str = "json") -> DataFrame:
    """One JSON text column per document (``to_json(struct(*))``), optionally
    next to some plain columns."""
    keep = keep or []
    return df.select(*[qcol(k) for k in keep],
                     F.to_json(F.struct(*[qcol(c) for c in df.columns])).alias(name))


def customer_order_documents(customer: DataFrame, orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """customer + ``orders: array<struct<order columns, lines>>`` sorted by
    order key: three levels of nesting (customer, order, line)."""
    docs = order_documents(orders, lineitem)
    per_cust = (docs.groupBy(F.col("o_custkey").alias("c_custkey"))
                .agg(F.array_sort(F.collect_list(F.struct(
                    *[c for c in docs.columns if c != "o_custkey"]))).alias("orders")))
    return customer.join(per_cust, "c_custkey", "left")
