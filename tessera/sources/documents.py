"""Document and table scans.

Reads stay lazy and declarative so Catalyst prunes columns (also nested
ones) and pushes filters into the file scan.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TEST_TABLES = ("region nation customer supplier part orders lineitem events "
               "documents embeddings pages benchmark labels conversations").split()


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Round-robin a scan over the cluster when it yields fewer partitions
    than there are cores (a file with one row group is one task however
    large the work after it). Scans that already have enough splits - any
    large input - are returned unchanged, so this never adds a shuffle at
    scale; so are inputs whose plan already has an exchange. Filters and
    column pruning still reach the scan below it."""
    target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    try:
        # Planning only. An input that already shuffles (or broadcasts) is
        # spread by that shuffle; asking it for its partitions would run it.
        if "Exchange" in df._jdf.queryExecution().executedPlan().toString():
            return df
    except Exception:  # noqa: BLE001 - no plan access: leave the input alone
        return df
    if df.rdd.getNumPartitions() < target:
        return df.repartition(target)
    return df


def read_table_files(spark: SparkSession, base_dir: str,
                     names: Iterable[str] | None = None,
                     fmt: str = "parquet", spread_small: bool = False) -> dict[str, DataFrame]:
    """Load only the named tables (all test tables when ``names`` is None).
    ``spread_small`` applies ``spread`` to scans narrower than the cluster."""
    wanted = list(names) if names is not None else list(TEST_TABLES)
    out = {}
    for n in wanted:
        df = spark.read.format(fmt).load(f"{base_dir.rstrip('/')}/{n}.{fmt}")
        out[n] = spread(df) if spread_small else df
    return out


def read_documents(spark: SparkSession, path: str, fmt: str = "json",
                   schema=None, sampling_ratio: float | None = None,
                   multi_line: bool = False, **options) -> DataFrame:
    """Load a collection with an inferred (or given) nested schema.

    ``fmt`` is any Spark data source: ``json``, ``parquet``, ``orc`` or
    ``mongodb`` when that connector is on the classpath (its URI then goes
    in ``options``). For JSON, pass ``schema`` at scale: inference is an
    extra full pass unless ``sampling_ratio`` bounds it.
    """
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "json":
        if sampling_ratio is not None:
            reader = reader.option("samplingRatio", sampling_ratio)
        reader = reader.option("multiLine", multi_line)
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.load(path)


def read_paths(df: DataFrame, paths: Iterable[str]) -> DataFrame:
    """Projected read of (possibly nested) paths such as ``lines.l_tax``.

    Each output column is named after its path with ``.`` replaced by ``_``
    so nested names never clash. Nested schema pruning keeps the scan to
    just those leaves.
    """
    cols: list[Column] = []
    for p in paths:
        cols.append(F.col(p).alias(p.replace(".", "_")))
    return df.select(*cols)


def sample_rows(df: DataFrame, n: int = 10, order_by: Iterable[str] | str | None = None) -> DataFrame:
    """The first ``n`` documents under a fixed order.

    The reference takes the first 10 in storage order, which Spark does not
    define; an explicit order makes the sample reproducible. Spark plans
    ``orderBy().limit()`` as a per-partition top-k plus a merge of
    ``n * partitions`` rows, so this never sorts the whole input.
    """
    if order_by is None:
        order_by = [df.columns[0]]
    elif isinstance(order_by, str):
        order_by = [order_by]
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in order_by]).limit(n)
