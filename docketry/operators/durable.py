"""Results that outlive lost executors, and row numbers that no group's size concentrates."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, which all executors share.

    Only a session on one machine may lack that setting; it gets a temporary folder. Anywhere else that is an error, because the
    executors would each write to a disk of their own.
    """
    given = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if given:
        return given.rstrip("/")
    master = spark.sparkContext.master
    if master == "local" or master.startswith("local["):
        return os.path.join(tempfile.gettempdir(), "docketry-checkpoints")
    raise RuntimeError(f"spark.checkpoint.dir is not set, and the executors of {master} share no folder without it")


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written to and read back from the shared folder, so lost executors cost no rerun of what was before."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def written(df: DataFrame) -> tuple[DataFrame, str]:
    """``df`` as a table in the shared folder, and its folder, which the caller may :func:`delete` once nothing reads it.

    For loops, in which checkpoints are not enough: a checkpoint hands on the size that the planner guessed for it, and guesses for joins of guesses
    grow to numbers of exponentially many digits. A table has its real size.
    """
    folder = f"{shared_folder(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder), folder


def delete(spark: SparkSession, folder: str) -> None:
    """Removes a folder of any file system that Spark reads."""
    where = spark._jvm.org.apache.hadoop.fs.Path(folder)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def numbered(df: DataFrame, key: str, order: list[str], name: str) -> DataFrame:
    """``df`` with its rows' number (from 1) within their key, by the order columns, as ``name``.

    A window over the key would put all rows of a key into one task. Instead rows are range-partitioned by key and order, so a large
    key lies in several partitions; each is numbered by itself and the counts of a key's earlier partitions are added. Rows that are equal in key
    and order are numbered in any order.
    """
    ranged = df.repartitionByRange(key, *order).withColumn("__part", F.spark_partition_id())
    ranged = checkpointed(ranged)  # so that both uses see the same ranges
    counts = ranged.groupBy(F.col(key).alias("__key"), F.col("__part").alias("__p")).agg(F.count("*").alias("__n"))
    earlier = F.sum("__n").over(Window.partitionBy("__key").orderBy("__p").rowsBetween(Window.unboundedPreceding, -1))  # a row for each partition of a key
    counts = counts.select("__key", "__p", F.coalesce(earlier, F.lit(0)).alias("__before"))
    own = F.row_number().over(Window.partitionBy(key, "__part").orderBy(*order))
    rows = ranged.withColumn("__own", own).join(counts, F.col(key).eqNullSafe(F.col("__key")) & (F.col("__part") == F.col("__p")))
    return rows.select(*df.columns, (F.col("__own") + F.col("__before")).cast("int").alias(name))
