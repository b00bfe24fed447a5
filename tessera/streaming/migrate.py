"""Document -> table migration (M2) over a stream of arriving documents.

The reference migrates a collection once. When documents keep arriving,
the same split (N2-N6) runs per micro-batch with Structured Streaming:
``readStream`` over a folder of document files, ``foreachBatch`` writes each
batch's root and child tables by appending to ``<out>/<table>``. Progress
and the set of files already read live in the query checkpoint, which must
sit in the shared checkpoint folder, so a restarted query resumes where it
stopped and a lost executor only re-runs its tasks.

Writes are idempotent per batch: each batch writes to ``<table>/batch=<id>``
with overwrite, so a batch replayed after a failure replaces its own output
instead of duplicating it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tessera.operators.reshape import documents_to_tables
from tessera.session import ensure_checkpoint_dir


def stream_documents_to_tables(spark: SparkSession, source_dir: str, schema: T.StructType,
                               name: str, out_dir: str, key: str | None = None,
                               fmt: str = "json", out_fmt: str = "parquet",
                               checkpoint: str | None = None,
                               max_files_per_trigger: int | None = None,
                               trigger_once: bool = False) -> StreamingQuery:
    """Start a streaming query that splits every new document file under
    ``source_dir`` into ``name`` + child tables under ``out_dir``.

    ``schema`` is required: a stream cannot infer it. Returns the running
    query (``processAllAvailable()`` / ``stop()`` it).
    """
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    docs = reader.load(source_dir)
    base = out_dir.rstrip("/")

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        for table, df in documents_to_tables(batch, name, key).items():
            (df.write.format(out_fmt).mode("overwrite")
             .save(f"{base}/{table}/batch={batch_id}"))

    ckpt = checkpoint or (ensure_checkpoint_dir(spark).rstrip("/") + f"/streams/{name}")
    writer = docs.writeStream.foreachBatch(write_batch).option("checkpointLocation", ckpt)
    writer = writer.trigger(availableNow=True) if trigger_once else writer
    return writer.start()
