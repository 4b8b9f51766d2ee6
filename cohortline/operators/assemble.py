"""Joins of tables and features, summaries and metric tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortline.functions.scalars import display_name, percent
from cohortline.plans.skew import attach


def join_label(features: DataFrame, labels: DataFrame, key: str, label: str) -> DataFrame:
    """Features of labelled rows: a left join and a null filter, which is an inner join.

    Repeated keys multiply on either side.
    """
    known = labels.select(key, label).filter(F.col(label).isNotNull())
    return attach(features, known, [key], "inner")


def join_features(
    records: DataFrame, features: DataFrame, key: str, label: str = "death_2years"
) -> DataFrame:
    """All records; those without features get nulls. The label of the records wins."""
    return attach(records, features.drop(label), [key], "left")


def summarise(df: DataFrame, name: str, label: str) -> DataFrame:
    """One row: labelled rows, number of features, share of positives."""
    return df.agg(
        F.count(label).alias("observations"),
        percent(F.avg(label)).alias("percent_positive"),
    ).select(
        display_name(F.lit(name)).alias("dataset"),
        "observations",
        F.lit(len(df.columns) - 2).alias("n_features"),
        "percent_positive",
    )


def summarise_all(datasets: Mapping[str, DataFrame], label: str) -> DataFrame:
    return reduce(
        DataFrame.unionByName, [summarise(df, name, label) for name, df in datasets.items()]
    )


def pivot_metrics(metrics: DataFrame, columns: Sequence[tuple[str, str]]) -> DataFrame:
    """Long metrics to one row per dataset; ``columns`` are the (model, metric) pairs.

    Conditional aggregates: one pass, no distinct scan for the pivot values.
    """
    return metrics.groupBy("dataset").agg(
        *[
            F.max(
                F.when((F.col("model") == model) & (F.col("metric") == metric), F.col("value"))
            ).alias(f"{model}_{metric}")
            for model, metric in columns
        ]
    )


def join_model_metrics(first: DataFrame, second: DataFrame) -> DataFrame:
    """Natural inner join of two metric tables, one row per dataset each."""
    shared = [c for c in first.columns if c in second.columns]
    return first.join(second, shared, "inner")
