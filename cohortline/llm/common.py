"""Small helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortline.plans.durable import new_path, own_tables

# Largest table, in serialised bytes, that an operator broadcasts.
BROADCAST_BYTES = 64 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z and leave every other character alone."""
    plain = F.length(text) == F.octet_length(text)
    return F.when(plain, F.lower(text)).otherwise(
        F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    )


def crc_remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus`` (null ids count as empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus


def settle(df: DataFrame) -> DataFrame:
    """Write ``df`` once and return the written table, without keeping what was shuffled for it."""
    return _settled(df, new_path(df.sparkSession))


def _settled(df: DataFrame, path: str) -> DataFrame:
    spark, name = df.sparkSession, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)
    return spark.read.schema(df.schema).parquet(path)


def settled_alone(spark: SparkSession, build: Callable[[], DataFrame]) -> DataFrame:
    """``settle`` for a table whose own written tables go as soon as it is there."""
    path = new_path(spark)
    with own_tables(spark):
        return _settled(build(), path)


def small_enough(df: DataFrame, row_bytes: int) -> bool:
    """Whether a written table of rows of at most ``row_bytes`` may be broadcast."""
    return df.count() * row_bytes <= BROADCAST_BYTES
