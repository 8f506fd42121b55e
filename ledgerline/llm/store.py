"""Tables and files that the operators publish between their steps.

Everything goes below the folder that ``spark.checkpoint.dir`` names, which
the driver and all executors share, so a lost executor costs a task and not
the step. The folder of a call is removed when the driver's JVM ends.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.common import estimated_bytes
from ..session import ensure_checkpoint_dir


def column(name: str):
    """A column by its exact name, which may hold dots and backticks."""
    return F.col("`" + name.replace("`", "``") + "`")


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder name in the shared folder, deleted with the session."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(hadoop_path)
    fs.deleteOnExit(hadoop_path)
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet into the shared folder and read back."""
    spark = df.sparkSession
    path = new_folder(spark, name) + "/table"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shard_count(df: DataFrame, bytes_per_shard: int = 32 << 20, least: int = 12) -> int:
    """Number of reducers for a table of this size: grows with the input, so
    that what one reducer holds does not. Spark estimates exabytes where it
    does not know a size (rows that come from no file); such a table gets the
    session's number of shuffle partitions."""
    size = estimated_bytes(df)
    if size is None or size >= 1 << 56:
        return max(least, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return max(least, -(-size // bytes_per_shard))
