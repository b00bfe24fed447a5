"""Session helpers: building a local session for tests/bench and finding the
shared checkpoint folder.

On a cluster the session is built by the caller; the library only reads its
settings. ``spark.checkpoint.dir`` must name a shared (HDFS/S3/ABFS) folder
there. A private folder is chosen only for ``local`` masters, where no
other machine has to reach it.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "tessera") -> SparkSession:
    """A ``local[cpus]`` session with the settings the tests and bench use."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="tessera-warehouse-"))
        .config("spark.driver.extraJavaOptions",
                f"-Dderby.stream.error.file={tempfile.gettempdir()}/tessera-derby.log")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder named by ``spark.checkpoint.dir``.

    If it is unset and the master is local (tests, bench), a private folder
    is created and registered. On a cluster an unset value is an error: a
    machine-local folder would be lost with its executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return sc.getCheckpointDir() or current
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a shared folder "
            "(for example an HDFS or object-store path) before running")
    path = tempfile.mkdtemp(prefix="tessera-ckpt-")
    sc.setCheckpointDir(path)
    try:
        spark.conf.set("spark.checkpoint.dir", path)
    except Exception:  # noqa: BLE001 - core confs may be read-only at runtime
        pass
    return sc.getCheckpointDir() or path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the checkpoint folder for written tables.

    Written tables cut lineage the same way ``checkpoint()`` does and live in
    the same shared folder, so they survive executor loss.
    """
    base = ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/tessera-tables/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the scratch folder and read it back: cuts the lineage
    and fixes a result that several jobs read."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_scratch(spark: SparkSession) -> None:
    """Delete the tables this application wrote with ``scratch_path``. For
    the end of a job: results that still read them must be stored first."""
    base = ensure_checkpoint_dir(spark)
    folder = spark._jvm.org.apache.hadoop.fs.Path(
        f"{base.rstrip('/')}/tessera-tables/{spark.sparkContext.applicationId}")
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
