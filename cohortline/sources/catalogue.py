"""Catalogue of image series."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortline.plans.ordering import row_index
from cohortline.plans.skew import attach


def tagged_union(tables: Mapping[str, DataFrame], tag: str = "Dataset") -> DataFrame:
    """Union tables by name, each marked with its own name."""
    marked = [df.withColumn(tag, F.lit(name)) for name, df in tables.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), marked)


def first_series(
    catalogue: DataFrame,
    order: Sequence[str],
    base: str = "",
    subject: str = "Subject ID",
    modality: str = "Modality",
    dataset: str = "Dataset",
    location: str = "File Location",
) -> DataFrame:
    """Path of the first series of every (subject, modality), for all at once.

    An aggregate keeps one row per key on the map side, so a subject with many
    series does not travel whole.
    """
    first = catalogue.groupBy(subject, modality).agg(
        F.min_by(F.struct(dataset, location), F.struct(*order)).alias("__first")
    )
    return first.select(
        subject,
        modality,
        F.concat_ws(
            "/", F.lit(base or None), F.col("__first")[dataset], F.col("__first")[location]
        ).alias("path"),
    )


def series_of(cohort: DataFrame, series: DataFrame, subject: str = "Subject ID") -> DataFrame:
    """Series of the cohort's subjects; both sides are unique per subject and modality."""
    return series.join(cohort.select(subject), subject, "inner")


def slice_order(files: DataFrame, series: str = "series_id", file: str = "file_name") -> DataFrame:
    """Position ``z`` of each file in its series, by text order of the file names.

    Works on the two name columns only; a very long series is cut into slabs.
    """
    return row_index(files.select(series, file), [series], [file], "z")


def first_file(frames: DataFrame, series: str = "series_id", file: str = "file_name") -> DataFrame:
    """Only the frames of the first file of each series."""
    firsts = frames.groupBy(series).agg(F.min(file).alias("__first_file"))
    return (
        attach(frames, firsts, [series])
        .filter(F.col(file) == F.col("__first_file"))
        .drop("__first_file")
    )
