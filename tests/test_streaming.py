import os
import tempfile

from pyspark.sql import functions as F

from conftest import bag
from tessera.sources import derived as D
from tessera.streaming.migrate import stream_documents_to_tables


def test_stream_of_documents_becomes_tables(spark, tables):
    docs = D.with_object_id(D.order_documents(tables["orders"], tables["lineitem"]), "o_orderkey")
    src = tempfile.mkdtemp(prefix="tessera-src-")
    out = tempfile.mkdtemp(prefix="tessera-out-")
    ckpt = tempfile.mkdtemp(prefix="tessera-ck-")
    # Two arrivals of documents.
    docs.where(F.col("o_custkey") % 2 == 0).write.mode("overwrite").json(os.path.join(src, "a"))
    docs.where(F.col("o_custkey") % 2 == 1).write.mode("overwrite").json(os.path.join(src, "b"))
    q = stream_documents_to_tables(spark, os.path.join(src, "*"), docs.schema, "orders", out,
                                   checkpoint=ckpt, max_files_per_trigger=1)
    q.processAllAvailable()
    q.stop()
    lines = spark.read.parquet(os.path.join(out, "lines")).drop("batch")
    assert lines.count() == tables["lineitem"].count()
    roots = spark.read.parquet(os.path.join(out, "orders")).drop("batch")
    assert bag(roots.select("_id")) == bag(tables["orders"].select(F.hex("o_orderkey").alias("_id")))
