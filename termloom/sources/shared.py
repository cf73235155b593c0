"""Working tables in the folder that driver and executors share."""

import math
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A side of a join may be broadcast up to this many narrow rows (an id, a term of at
# most 50 characters and a few numbers: some 20 MB).  Larger sides are shuffled.
BROADCAST_ROWS = 200_000

# Rows that one task groups or sorts; known larger numbers are dealt out to so many more tasks.
TASK_ROWS = 250_000
MAX_TASKS = 16_384

_fallback: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Where the setting is absent, a session whose only machine is this one gets a temporary
    folder, kept for the session; on a cluster it is an error, as executors could not
    read such a folder.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder
    if not re.fullmatch(r"local(\[.*\])?", context.master):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    if context.applicationId not in _fallback:
        _fallback[context.applicationId] = tempfile.mkdtemp(prefix="termloom-")
    return _fallback[context.applicationId]


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other call gets."""
    app = spark.sparkContext.applicationId
    return f"{shared_folder(spark).rstrip('/')}/{app}/{name}-{uuid.uuid4().hex[:12]}"


def release(spark: SparkSession) -> None:
    """Delete all working tables of this application."""
    context = spark.sparkContext
    folder = f"{shared_folder(spark).rstrip('/')}/{context.applicationId}"
    path = context._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Later steps start from the files, so a lost executor costs a re-read rather than
    the whole lineage, and the planner sees the real size.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def rows_up_to_limit(df: DataFrame, limit: int = BROADCAST_ROWS) -> int:
    """Number of rows, counted no further than one beyond ``limit``."""
    return df.limit(limit + 1).count()


def broadcast_within(df: DataFrame, rows: int, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast a side known to have at most ``rows`` rows, if that is few enough."""
    return F.broadcast(df) if rows <= limit else df


def dealt_by(df: DataFrame, column: str, rows: int) -> DataFrame:
    """``df`` dealt out by a column to as many tasks as ``rows`` need; few rows stay where they are.

    Grouping by this and further columns then needs no other shuffle.
    """
    tasks = min(MAX_TASKS, math.ceil(rows / TASK_ROWS))
    return df.repartition(tasks, column) if tasks > 1 else df


def spread_rows(df: DataFrame) -> DataFrame:
    """Deal rows out when the input has fewer splits than the session has cores.

    That is so for a small input, by the planner's estimate of its size; asking for the
    number of partitions would run its shuffles.  A large input has many splits already
    and is left as it is: its text is never shuffled.
    """
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    split = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(
        spark.conf.get("spark.sql.files.maxPartitionBytes")
    )
    return df.repartition(2 * cores) if size < cores * split else df
