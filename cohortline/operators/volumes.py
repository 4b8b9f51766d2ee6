"""Image volumes as slice rows and sparse voxel rows.

A slice row is ``(volume_id, z, height, width, pixels)`` with row-major pixels.
Dense work stays inside the slice row; only voxels under a mask become rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortline.functions.scalars import let, to_byte
from cohortline.plans.durable import freeze
from cohortline.plans.skew import attach

VOXEL = ["volume_id", "z", "y", "x"]


def _scaled(pixel: Column, peak: Column) -> Column:
    return to_byte(
        F.when(peak != 0, pixel.cast("double") / peak.cast("double") * 255)
    )


def normalise_slices(slices: DataFrame) -> DataFrame:
    """Scale each one-frame file to 0..255 by its own largest pixel. No shuffle."""

    def by_own_peak(pixels: Column) -> Column:
        peak = F.array_max(pixels)
        return let(peak, lambda top: F.transform(pixels, lambda p: _scaled(p, top)))

    return slices.withColumn("pixels", let(F.col("pixels"), by_own_peak))


def normalise_files(frames: DataFrame, file: Sequence[str]) -> DataFrame:
    """Scale the frames of a file by the largest pixel of the whole file."""
    peaks = frames.groupBy(*file).agg(F.max(F.array_max("pixels")).alias("__peak"))
    scaled = let(
        F.col("__peak"), lambda top: F.transform("pixels", lambda p: _scaled(p, top))
    )
    return attach(frames, peaks, file).withColumn("pixels", scaled).drop("__peak")


def with_depth(slices: DataFrame) -> DataFrame:
    """Add the number of slices of the volume to each slice row.

    The counts are read from the narrow columns and broadcast behind a size
    check, so pixel rows do not move.
    """
    depths = slices.groupBy("volume_id").agg(F.count("*").cast("int").alias("depth"))
    return attach(slices, depths, ["volume_id"])


def to_voxels(slices: DataFrame, positive_only: bool = False) -> DataFrame:
    """One row per pixel; other columns of the slice row are kept."""
    others = [c for c in slices.columns if c not in ("pixels", "volume_id", "z")]
    cells = slices.select("volume_id", "z", *others, F.posexplode("pixels").alias("__pos", "value"))
    if positive_only:
        cells = cells.filter(F.col("value") > 0)
    return cells.select(
        "volume_id",
        "z",
        F.expr("__pos div width").cast("int").alias("y"),
        F.expr("__pos % width").cast("int").alias("x"),
        "value",
        *others,
    )


def halved(size: str) -> Column:
    """Half an axis length, ties to even, never empty."""
    return F.greatest(F.bround(F.col(size) / 2, 0).cast("int"), F.lit(1))


def _reached(i: str, n: str, m: str) -> Column:
    """Output positions that input position ``i`` contributes to, with weights.

    An axis of ``n`` cells is sampled at ``m`` cells, end points aligned. All
    weights are whole numbers over the common denominator ``m - 1``.
    """
    gap = f"greatest({n} - 1, 1)"
    low = f"((({i} - 1) * ({m} - 1) - pmod(({i} - 1) * ({m} - 1), {gap})) div {gap}) + 1"
    high = f"((({i} + 1) * ({m} - 1) + pmod(-({i} + 1) * ({m} - 1), {gap})) div {gap}) - 1"
    inner = f"sequence(greatest({low}, 0), least({high}, {m} - 1))"
    weight = f"({m} - 1) - abs(o * ({n} - 1) - {i} * ({m} - 1))"
    return F.expr(
        f"""
        CASE WHEN {m} = 1 THEN
            CASE WHEN {i} = 0 THEN array(named_struct('o', 0L, 'w', 1L)) END
        WHEN greatest({low}, 0) <= least({high}, {m} - 1) THEN
            transform({inner}, o -> named_struct('o', cast(o AS BIGINT), 'w', cast({weight} AS BIGINT)))
        END
        """
    )


def resample_mask(voxels: DataFrame) -> DataFrame:
    """Linear resampling of a sparse mask to half of each axis.

    Input rows need ``depth, height, width``; output rows carry those of the
    new grid. Zero voxels add nothing, so only positive ones are touched, and
    each reaches about one output cell. Sums are whole numbers, so the result
    does not depend on the order of addition.
    """
    # Long arithmetic from here on.
    sized = voxels.select(
        "volume_id",
        *[F.col(c).cast("long").alias(c) for c in ("z", "y", "x", "value")],
        *[F.col(c).cast("long").alias(c) for c in ("depth", "height", "width")],
        halved("depth").cast("long").alias("mz"),
        halved("height").cast("long").alias("my"),
        halved("width").cast("long").alias("mx"),
    )
    spread = (
        sized.withColumn("tz", F.explode(_reached("z", "depth", "mz")))
        .withColumn("ty", F.explode(_reached("y", "height", "my")))
        .withColumn("tx", F.explode(_reached("x", "width", "mx")))
    )
    summed = (
        spread.withColumn("part", F.expr("value * tz.w * ty.w * tx.w"))
        .groupBy(
            "volume_id",
            F.col("tz.o").cast("int").alias("z"),
            F.col("ty.o").cast("int").alias("y"),
            F.col("tx.o").cast("int").alias("x"),
        )
        .agg(F.sum("part").alias("part"), *[F.max(c).alias(c) for c in ("mz", "my", "mx")])
    )
    return summed.select(
        *VOXEL,
        _rounded("part", "mz", "my", "mx").alias("mask"),
        F.col("mz").cast("int").alias("depth"),
        F.col("my").cast("int").alias("height"),
        F.col("mx").cast("int").alias("width"),
    ).filter(F.col("mask") > 0)


def _rounded(part: str, *sizes: str) -> Column:
    """Half-up rounding of ``part`` over the product of the axis denominators."""
    over = "*".join(f"greatest({s} - 1, 1)" for s in sizes)
    return F.expr(f"cast((2 * {part} + {over}) div (2 * {over}) AS INT)")


def sample_image(targets: DataFrame, slices: DataFrame) -> DataFrame:
    """Linear resampling of an image, only at the wanted cells of the new grid.

    ``targets`` are rows ``(volume_id, z, y, x, depth, height, width)`` on the
    new grid; ``slices`` are the image slices. The wanted cells of an output
    slice travel as one row to the one or two image slices that feed it. Image
    slices that feed none are dropped by their names before pixels move. The
    four in-plane neighbours are read inside the slice row.
    """
    depths = slices.groupBy("volume_id").agg(F.count("*").cast("long").alias("cz"))
    wanted = targets.groupBy("volume_id", "z").agg(
        F.collect_list(F.struct("y", "x")).alias("cells"),
        F.max("depth").cast("long").alias("mz"),
    )
    feeds = (
        attach(wanted, depths, ["volume_id"])
        .withColumn("at", F.expr("z * (cz - 1)"))
        .withColumn("gap", F.expr("greatest(mz - 1, 1)"))
        .withColumn(
            "feed",
            F.explode(
                F.expr(
                    """
                    filter(array(
                        named_struct('z', at div gap, 'w', gap - at % gap),
                        named_struct('z', at div gap + 1, 'w', at % gap)), f -> f.w > 0)
                    """
                )
            ),
        )
        .select(
            "volume_id",
            F.col("z").alias("oz"),
            F.col("feed.z").cast("int").alias("z"),
            F.col("feed.w").alias("wz"),
            "mz",
            "cells",
        )
    )
    feeds = freeze(feeds)
    needed = feeds.select("volume_id", "z").distinct()
    planes = attach(slices, needed, ["volume_id", "z"]).select(
        "volume_id",
        "z",
        "pixels",
        F.col("height").cast("long").alias("height"),
        F.col("width").cast("long").alias("width"),
        halved("height").cast("long").alias("my"),
        halved("width").cast("long").alias("mx"),
    )
    in_plane = F.expr(
        """
        transform(cells, c -> named_struct('y', c.y, 'x', c.x, 'part',
            aggregate(
                array(
                    named_struct('dy', 0, 'dx', 0), named_struct('dy', 0, 'dx', 1),
                    named_struct('dy', 1, 'dx', 0), named_struct('dy', 1, 'dx', 1)),
                0L,
                (acc, d) -> acc + coalesce(
                    (CASE WHEN d.dy = 0
                        THEN greatest(my - 1, 1) - (c.y * (height - 1)) % greatest(my - 1, 1)
                        ELSE (c.y * (height - 1)) % greatest(my - 1, 1) END)
                    * (CASE WHEN d.dx = 0
                        THEN greatest(mx - 1, 1) - (c.x * (width - 1)) % greatest(mx - 1, 1)
                        ELSE (c.x * (width - 1)) % greatest(mx - 1, 1) END)
                    * get(pixels, cast(
                        ((c.y * (height - 1)) div greatest(my - 1, 1) + d.dy) * width
                        + (c.x * (width - 1)) div greatest(mx - 1, 1) + d.dx AS INT)),
                    0L))))
        """
    )
    parts = (
        feeds.join(planes, ["volume_id", "z"])
        .select("volume_id", "oz", "wz", "mz", "my", "mx", F.inline(in_plane))
        .groupBy("volume_id", F.col("oz").alias("z"), "y", "x")
        .agg(
            F.sum(F.col("part") * F.col("wz")).alias("part"),
            *[F.max(c).alias(c) for c in ("mz", "my", "mx")],
        )
    )
    return parts.select(*VOXEL, _rounded("part", "mz", "my", "mx").alias("value"))


def halved_grid(slices: DataFrame) -> DataFrame:
    """Every cell of the halved grid of each volume, as ``sample_image`` targets."""
    sizes = slices.groupBy("volume_id").agg(
        F.count("*").alias("depth"), F.max("height").alias("height"), F.max("width").alias("width")
    )
    new = sizes.select("volume_id", *[halved(c).alias(c) for c in ("depth", "height", "width")])
    # One row per output slice first, so that cells are made slice by slice.
    planes = new.withColumn("z", F.explode(F.expr("sequence(0, depth - 1)"))).repartition(
        "volume_id", "z"
    )
    return planes.withColumn("y", F.explode(F.expr("sequence(0, height - 1)"))).withColumn(
        "x", F.explode(F.expr("sequence(0, width - 1)"))
    )


def resample_linear(slices: DataFrame) -> DataFrame:
    """Every cell of a volume resampled to half of each axis."""
    return sample_image(halved_grid(slices), slices)


def mask_image(mask: DataFrame, slices: DataFrame) -> DataFrame:
    """Resampled image values under the resampled mask, one row per mask cell."""
    return mask.join(sample_image(mask, slices), VOXEL)


def rescale_masked(masked: DataFrame) -> DataFrame:
    """Add ``level``: the masked image stretched to 0..255 over its volume.

    The image is zero outside the mask, so a volume with background has
    minimum 0, which is why background cells need no rows. A flat volume
    becomes all 0.
    """
    bounds = masked.groupBy("volume_id").agg(
        F.min("value").alias("__least"),
        F.max("value").alias("__high"),
        F.count("*").alias("__cells"),
        F.max(F.expr("cast(depth AS BIGINT) * height * width")).alias("__grid"),
    )
    bounds = bounds.select(
        "volume_id",
        F.when(F.col("__cells") < F.col("__grid"), F.lit(0))
        .otherwise(F.col("__least"))
        .alias("__low"),
        "__high",
    )
    stretch = F.expr(
        "cast((value - __low) AS DOUBLE) / nullif(cast((__high - __low) AS DOUBLE), 0) * 255"
    )
    return (
        attach(masked, bounds, ["volume_id"])
        .withColumn("level", to_byte(stretch))
        .drop("__low", "__high")
    )
