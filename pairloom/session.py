"""Session defaults and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int = 8, app: str = "pairloom", **conf: str) -> SparkSession:
    """Session for tests and benchmarks on one machine."""
    settings = {
        "spark.driver.host": "127.0.0.1",
        "spark.driver.bindAddress": "127.0.0.1",
        "spark.driver.memory": "12g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.shuffle.partitions": str(cores),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "128k",
        "spark.pairloom.read.partitions": str(cores),  # the sample tables have one row group each
        # call-site capture costs more than planning when a loop builds many plans
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **conf,
    }
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder for checkpoints and intermediate tables.

    It is the one the cluster names in ``spark.checkpoint.dir``.  Only a local
    session without that setting gets a temporary folder.
    """
    context = spark.sparkContext
    current = context._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named is None:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="pairloom-")
    context.setCheckpointDir(named)
    return context._jsc.sc().getCheckpointDir().get()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def settle(frame: DataFrame, name: str = "settled") -> tuple[DataFrame, str]:
    """Cut the lineage by writing a table to the shared folder and reading it back."""
    spark = frame.sparkSession
    path = scratch_path(spark, name)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path), path


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Remove a table that ``settle`` wrote and nothing reads any more."""
    if not path.startswith(shared_folder(spark)):
        raise ValueError(f"{path} is not in the shared folder")
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def table_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of the files of a written table."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(target).getLength()


def bounded_rows(frame: DataFrame, limit: int, what: str) -> list:
    """Collect a table whose size has an upper bound, and refuse anything larger."""
    rows = frame.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"{what} has more than {limit} rows")
    return rows
