"""Intensity statistics of the image under the mask."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def intensity_features(masked: DataFrame) -> DataFrame:
    """Mean, population deviation, extremes and exact median per volume.

    Values are bytes, so a volume shrinks to a histogram of at most 256 rows
    on the map side; everything else is taken from the histogram.
    """
    bins = masked.groupBy("volume_id", "value").agg(F.count("*").alias("n"))
    stats = bins.groupBy("volume_id").agg(
        F.sum("n").alias("cells"),
        F.expr("sum(value * n)").alias("s1"),
        F.expr("sum(cast(value AS BIGINT) * value * n)").alias("s2"),
        F.min("value").alias("least"),
        F.max("value").alias("most"),
        F.expr("percentile(value, 0.5, n)").alias("middle"),
    )
    return stats.select(
        "volume_id",
        F.expr("cast(s1 AS DOUBLE) / cells").alias("mean_intensity"),
        F.expr(
            "sqrt(cast(cast(cells AS DECIMAL(19, 0)) * cast(s2 AS DECIMAL(19, 0))"
            " - cast(s1 AS DECIMAL(19, 0)) * cast(s1 AS DECIMAL(19, 0)) AS DOUBLE)) / cells"
        ).alias("std_intensity"),
        F.col("least").cast("double").alias("min_intensity"),
        F.col("most").cast("double").alias("max_intensity"),
        F.col("middle").cast("double").alias("median_intensity"),
    )
