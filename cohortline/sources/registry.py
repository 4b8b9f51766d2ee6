"""Named datasets, opened only when asked for."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from cohortline.operators.assemble import join_features

Registry = Mapping[str, Callable[[], DataFrame]]


def study_datasets(spark: SparkSession, root: str) -> dict[str, Callable[[], DataFrame]]:
    """The five study datasets below ``root``; the feature table may be many files."""

    def table(name: str) -> Callable[[], DataFrame]:
        return lambda: spark.read.parquet(f"{root}/{name}")

    tables = {
        n: table(n) for n in ("clinical1", "clinical2", "clinical_joined", "image_features")
    }
    tables["full_data"] = lambda: join_features(
        tables["clinical_joined"](), tables["image_features"](), "patient_id"
    )
    return tables


def open_dataset(registry: Registry, name: str) -> DataFrame:
    if name not in registry:
        raise KeyError(f"unknown dataset {name!r}; known: {sorted(registry)}")
    return registry[name]()
