"""Intermediate tables in the folder that all executors share.

The folder is the one named in ``spark.checkpoint.dir`` (or set on the SparkContext). Only a local session
without such a setting gets a temporary folder of its own; a cluster without one is an error, since a
machine-local folder would be lost with its executor. Staged tables lie in a folder of the application there, which
Hadoop deletes when the application ends.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_SETTING = "spark.checkpoint.dir"
_MARKED: set[str] = set()


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of the session."""
    sc = spark.sparkContext
    named = sc.getConf().get(_SETTING) or spark.conf.get(_SETTING, None) or sc.getCheckpointDir()
    if not named:
        if not sc.master.startswith("local"):
            raise RuntimeError(f"set {_SETTING} to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="spotweave-")
        sc.setCheckpointDir(named)
    return named.rstrip("/")


def _run_dir(spark: SparkSession) -> str:
    """The folder of this application in the shared one; it goes when the application ends."""
    path = f"{shared_dir(spark)}/spotweave-{spark.sparkContext.applicationId}"
    if path not in _MARKED:
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        fs.mkdirs(at)
        fs.deleteOnExit(at)
        _MARKED.add(path)
    return path


def new_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nothing uses yet, for as long as the application runs."""
    return f"{_run_dir(spark)}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as a table into the shared folder and read it back: its lineage ends there.

    A lost executor costs a later stage only the re-reading of its own input files.
    """
    path = new_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: The most that is ever broadcast by a hint of ours.
BROADCAST_BYTES = 64 << 20


def broadcast_if_small(df: DataFrame, max_rows: int, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``max_rows`` rows and ``max_bytes`` bytes, else ``df`` as it is.

    ``df`` should be a staged table, since it's read for this. Values of variable length count by their text.
    """
    wide = [f.name for f in df.schema.fields if not isinstance(f.dataType, (T.NumericType, T.BooleanType, T.DateType, T.TimestampType))]
    width = sum((F.coalesce(F.octet_length(F.col(f"`{n}`").cast("string")), F.lit(0)).cast("long") for n in wide), F.lit(8 * len(df.columns)).cast("long"))
    rows, size = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(width), F.lit(0))).first()
    return F.broadcast(df) if rows <= max_rows and size <= max_bytes else df
