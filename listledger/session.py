"""Session helpers: building a session for tests and local runs, table loading,
and the reliable checkpoint folder used to cut lineage in iterative jobs."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "listledger") -> SparkSession:
    """A local session with the settings the tests and the bench use.

    On a cluster the session comes from the platform; nothing here is needed there.
    """
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # pages are large rows: keep Arrow batches to the Python parsers small
        .config("spark.sql.execution.arrow.maxRecordsPerBatch", "256")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for reliable checkpoints.

    Read from the session (``spark.checkpoint.dir`` or a folder already set on the
    context). Only a session whose master is ``local`` (one machine, tests) may do
    without: it gets a scratch folder. On a cluster a missing setting is an
    error, since a machine-local folder would be seen by one executor only.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        conf_dir = tempfile.mkdtemp(prefix="listledger-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the checkpoint folder, for written intermediate tables."""
    import uuid

    base = checkpoint_dir(spark)
    path = f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(jpath)  # gone with the application
    return path


def drop_written(spark: SparkSession, path: str) -> None:
    """Delete an intermediate table that nothing reads any more."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jpath, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Cut the lineage of ``df``: write it once as parquet below the shared
    checkpoint folder and read it back.

    One computation (``Dataset.checkpoint`` computes a plan twice unless it is
    cached first), columnar re-reads, and the files outlive a lost executor.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def drop_table(df: DataFrame) -> None:
    """Delete the files of a table that ``materialize`` wrote, once nothing reads it any more."""
    folders = {f.rsplit("/", 1)[0] for f in df.inputFiles()}
    for path in folders:
        drop_written(df.sparkSession, path)
