"""Tables written to the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

#: Bytes of rows that go to a Python worker at once, and where the session says so.
BATCH, _BATCH_KEY = "8m", "spark.sql.execution.arrow.maxBytesPerBatch"


#: For Parquet with images or bricks: a reader decodes up to 4096 rows of a row group at once. Limits in bytes count what
#: is compressed already, of which an empty image has next to nothing, so a row group gets so many rows at most.
ROW_GROUPS = {"parquet.block.row.count.limit": "64"}


def in_frames(df: DataFrame, fn: Callable, schema: str) -> DataFrame:
    """df.mapInPandas for rows that hold images or bricks: a worker gets BATCH bytes at once, whatever the number of rows.

    Spark's own limit of 64 MB would be held several times over by each of an executor's workers. A limit that the
    session has set itself is kept.
    """
    conf = df.sparkSession.conf
    if conf.get(_BATCH_KEY, None) is None:
        conf.set(_BATCH_KEY, BATCH)
    return df.mapInPandas(fn, schema)


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share, from the session's spark.checkpoint.dir.

    Where it is unset, one process on one machine (a local master) gets a folder of its own; on a cluster that
    would be a folder that other machines never see, so there it is an error.
    """
    sc = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not found:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="spark-"))
        found = sc.getCheckpointDir()
    return found.rstrip("/")


def fresh_path(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/{uuid.uuid4().hex}"


def spill(df: DataFrame) -> DataFrame:
    """df written to the shared folder and read back: lineage ends here and survives a lost executor."""
    path = fresh_path(df.sparkSession)
    images = any(f.dataType.typeName() == "binary" for f in df.schema)
    df.write.options(compression="zstd", **ROW_GROUPS if images else {}).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
