"""Running totals and positions in a global or per-group order.

A plain window sends a whole group to one task. Here the rows are cut into
range slabs, the slabs are totalled, and each slab is finished on its own.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortline.plans.durable import freeze


def running_sums(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    sums: Mapping[str, Column],
) -> DataFrame:
    """Add inclusive running totals of ``sums`` along ``order`` in each group.

    ``group`` and ``order`` together must identify a row. The slab totals hold
    at most one row per group and slab, so the only window over a whole group
    runs over as many rows as there are slabs.
    """
    group, order = list(group), list(order)
    slabs = freeze(
        df.withColumns({f"__v_{name}": value for name, value in sums.items()})
        .repartitionByRange(*group, *order)
        .withColumn("__slab", F.spark_partition_id())
    )
    totals = slabs.groupBy(*group, "__slab").agg(
        *[F.sum(f"__v_{name}").alias(f"__t_{name}") for name in sums]
    )
    earlier = (
        Window.partitionBy(*(group or [F.lit(0)]))
        .orderBy("__slab")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = totals.select(
        *group,
        "__slab",
        *[
            F.coalesce(F.sum(f"__t_{name}").over(earlier), F.lit(0)).alias(f"__o_{name}")
            for name in sums
        ],
    )
    inside = (
        Window.partitionBy(*group, "__slab")
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    # Rows without a group value are a group, so nulls must meet.
    names = [*group, "__slab"]
    theirs = offsets.select(*[F.col(c).alias(f"__g_{c}") for c in names], *[f"__o_{n}" for n in sums])
    same = [slabs[c].eqNullSafe(theirs[f"__g_{c}"]) for c in names]
    placed = slabs.join(theirs, reduce(and_, same))
    return placed.select(
        *df.columns,
        *[
            (F.sum(f"__v_{name}").over(inside) + F.col(f"__o_{name}")).alias(name)
            for name in sums
        ],
    )


def row_index(
    df: DataFrame, group: Sequence[str], order: Sequence[str], name: str = "idx"
) -> DataFrame:
    """Add the zero-based position of every row in its group."""
    counted = running_sums(df, group, order, {name: F.lit(1).cast("long")})
    return counted.withColumn(name, F.col(name) - 1)
