"""Grey-level co-occurrence of masked, rescaled slices, in sparse form.

Rows are the mask cells only. Pairs of two background cells are never formed:
their number is the number of pairs in the slice less the rest.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The step (dy, dx) of each angle at distance 1.
STEPS = {0: (0, 1), 45: (1, 1), 90: (1, 0), 135: (1, -1)}

TEXTURES = ["contrast", "correlation", "dissimilarity", "homogeneity", "energy"]


def cooccurrence(masked: DataFrame) -> DataFrame:
    """Unordered level pairs per slice and angle: ``(lo, hi, pairs, total)``.

    Input rows are ``(volume_id, z, y, x, level, height, width)``. One shuffle
    on the slice, whose size is bounded by the image, serves every step. A
    slice and angle without any pair in range keeps one row with null levels.
    """
    ends = []
    for angle, (dy, dx) in STEPS.items():
        for role, fy, fx in (("first", "y", "x"), ("second", f"y - {dy}", f"x - ({dx})")):
            # The pair is named by the place of its first cell.
            ends.append(
                f"named_struct('angle', {angle}, 'role', '{role}', 'fy', {fy}, 'fx', {fx}, "
                f"'valid', {fy} >= 0 AND {fx} >= 0 AND {fx} < width "
                f"AND {fy} + {dy} < height AND {fx} + ({dx}) >= 0 AND {fx} + ({dx}) < width)"
            )
    by_slice = masked.select(
        "volume_id", "z", "y", "x", "level", "height", "width"
    ).repartition("volume_id", "z")
    pairs = (
        by_slice.select("*", F.explode(F.expr(f"array({', '.join(ends)})")).alias("e"))
        .groupBy("volume_id", "z", "height", "width", "e.angle", "e.fy", "e.fx", "e.valid")
        .agg(
            F.max(F.expr("CASE WHEN e.role = 'first' THEN level ELSE 0 END")).alias("i"),
            F.max(F.expr("CASE WHEN e.role = 'second' THEN level ELSE 0 END")).alias("j"),
        )
    )
    cases = " ".join(
        f"WHEN {angle} THEN (height - {dy}) * (width - {abs(dx)})"
        for angle, (dy, dx) in STEPS.items()
    )
    return pairs.groupBy(
        "volume_id",
        "z",
        "angle",
        F.expr(f"cast(CASE angle {cases} END AS BIGINT)").alias("total"),
        F.expr("CASE WHEN valid THEN least(i, j) END").alias("lo"),
        F.expr("CASE WHEN valid THEN greatest(i, j) END").alias("hi"),
    ).agg(F.count_if("valid").alias("pairs"))


def pair_properties(counts: DataFrame) -> DataFrame:
    """The five texture properties per slice and angle.

    Moments are whole numbers, so a slice without variation is recognised
    exactly; its correlation is 1.
    """
    seen = "(CASE WHEN hi > 0 THEN pairs ELSE 0 END)"
    sums = counts.groupBy("volume_id", "z", "angle", "total").agg(
        *[
            F.expr(f"cast(sum({e}) AS {t})").alias(n)
            for n, t, e in (
                ("formed", "BIGINT", seen),
                ("s1", "BIGINT", f"{seen} * (lo + hi)"),
                ("s2", "BIGINT", f"{seen} * (lo * lo + hi * hi)"),
                ("s11", "BIGINT", f"{seen} * lo * hi"),
                ("sd", "BIGINT", f"{seen} * (hi - lo)"),
                ("sdd", "BIGINT", f"{seen} * (hi - lo) * (hi - lo)"),
                ("sh", "DOUBLE", f"{seen} / (1.0D + (hi - lo) * (hi - lo))"),
                ("sq", "BIGINT", f"{seen} * {seen} * (CASE WHEN lo = hi THEN 4 ELSE 2 END)"),
            )
        ]
    )
    sums = sums.withColumns(
        {
            "plain": F.expr("total - coalesce(formed, 0)"),
            **{c: F.coalesce(c, F.lit(0)) for c in ("s1", "s2", "s11", "sd", "sdd", "sh", "sq")},
        }
    )
    up = "(4 * cast(total AS DECIMAL(19, 0)) * s11 - cast(s1 AS DECIMAL(19, 0)) * s1)"
    down = "(2 * cast(total AS DECIMAL(19, 0)) * s2 - cast(s1 AS DECIMAL(19, 0)) * s1)"
    some = "total > 0"
    return sums.select(
        "volume_id",
        "z",
        "angle",
        F.expr(f"CASE WHEN {some} THEN sdd / total ELSE 0D END").alias("contrast"),
        F.expr(
            f"CASE WHEN {some} AND {down} > 0 "
            f"THEN cast({up} AS DOUBLE) / cast({down} AS DOUBLE) ELSE 1D END"
        ).alias("correlation"),
        F.expr(f"CASE WHEN {some} THEN sd / total ELSE 0D END").alias("dissimilarity"),
        F.expr(f"CASE WHEN {some} THEN (sh + plain) / total ELSE 0D END").alias("homogeneity"),
        F.expr(
            f"CASE WHEN {some} THEN sqrt(cast(sq + 4 * plain * plain AS DOUBLE)) / (2 * total) "
            "ELSE 0D END"
        ).alias("energy"),
    )


def texture_features(masked: DataFrame) -> DataFrame:
    """Mean over the angles of a slice, then over the slices that hold mask."""
    per_slice = (
        pair_properties(cooccurrence(masked))
        .groupBy("volume_id", "z")
        .agg(*[F.avg(c).alias(c) for c in TEXTURES])
    )
    return per_slice.groupBy("volume_id").agg(*[F.avg(c).alias(c) for c in TEXTURES])
