"""Written intermediate tables.

A frozen table cuts lineage, survives the loss of executors and is read back
with the statistics of a file scan. It lives below the shared folder that the
cluster names in ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession


_JOB = "cohortline.job"


def shared_folder(spark: SparkSession) -> str:
    """The folder for intermediate tables, read from the session.

    Without ``spark.checkpoint.dir`` it is the warehouse, which executors share
    as well; a cluster must then name a warehouse that they reach.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    return (configured or spark.conf.get("spark.sql.warehouse.dir")).rstrip("/")


def new_path(spark: SparkSession, kind: str = "table") -> str:
    """A fresh path in the shared folder, below that of the job that runs."""
    job = spark.sparkContext.getLocalProperty(_JOB)
    folder = f"{shared_folder(spark)}/cohortline" + (f"/{job}" if job else "")
    return f"{folder}/{kind}-{uuid.uuid4().hex}"


@contextmanager
def own_tables(spark: SparkSession) -> Iterator[None]:
    """A job whose frozen tables go when it ends; what it returns must not read them.

    Threads started with ``inheritable_thread_target`` belong to the job.
    """
    context, name = spark.sparkContext, f"job-{uuid.uuid4().hex}"
    outer = context.getLocalProperty(_JOB)
    inner = f"{outer}/{name}" if outer else name
    context.setLocalProperty(_JOB, inner)
    try:
        yield
    finally:
        context.setLocalProperty(_JOB, outer)
        path = context._jvm.org.apache.hadoop.fs.Path(f"{shared_folder(spark)}/cohortline/{inner}")
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def freeze(df: DataFrame) -> DataFrame:
    """Write ``df`` once and return it as a scan of the written table."""
    spark = df.sparkSession
    path = new_path(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def at_once(spark: SparkSession, *parts: Callable[[], DataFrame]) -> list[DataFrame]:
    """Build independent tables side by side, so that their jobs share the cluster."""
    start = inheritable_thread_target(spark)
    with ThreadPool(len(parts)) as pool:
        return [p.get() for p in [pool.apply_async(start(part)) for part in parts]]
