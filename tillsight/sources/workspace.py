"""The folder shared by driver and executors for tables written on the way."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"
#: Of the tables that hold every order.
COMPRESSION = "zstd"
_own: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """Folder named by the session; a new one under /tmp in local mode only."""
    named = spark.conf.get(SETTING, None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError(f"set {SETTING} to a folder all executors can reach")
    return _own.setdefault(spark.sparkContext.applicationId, tempfile.mkdtemp(prefix="tillsight-"))


def run_folder(spark: SparkSession) -> str:
    """Where everything written on the way by this application lies; it owns the folder."""
    return f"{shared_folder(spark).rstrip('/')}/tillsight/{spark.sparkContext.applicationId}"


def clear(spark: SparkSession) -> None:
    """Remove what this application has written on the way.

    Frames that still read from it fail afterwards, so call this when results are written.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(run_folder(spark))
    path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing has used before."""
    return f"{run_folder(spark)}/{name}-{uuid.uuid4().hex}"


def written(rows: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write the rows once and go on from the files.

    The result has a known size, costs nothing to read twice, and does not
    change when an executor is lost.
    """
    path = new_path(rows.sparkSession, name)
    rows.write.mode("errorifexists").option("compression", compression).parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)
