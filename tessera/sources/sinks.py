"""Document sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_documents(df: DataFrame, path: str, fmt: str = "json", mode: str = "errorifexists",
                    partition_by: list[str] | None = None, **options) -> None:
    """One document per row into ``path`` (``json``, ``parquet``, ``orc``,
    or ``mongodb`` when its connector is installed, with the target in
    ``options``). Executors write their partitions in parallel; no row
    passes through the driver."""
    w = df.write.format(fmt).mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    for k, v in options.items():
        w = w.option(k, v)
    w.save(path)


def write_schema_json(schema_df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write the ``schema_json`` text of ``fields.schema_json`` (one file
    per collection in the reference; here one text dataset)."""
    schema_df.select("schema_json").coalesce(1).write.mode(mode).text(path)
