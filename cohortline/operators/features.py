"""The feature row of an image volume."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortline.functions.codes import IMAGE_FEATURES
from cohortline.operators import components, intensity, surface, texture, volumes
from cohortline.plans.durable import at_once, freeze


def shape_features(mask: DataFrame) -> DataFrame:
    """Nine shape features per volume, from mask voxels on the original grid."""
    runs, diameter = at_once(
        mask.sparkSession,
        lambda: components.label_runs(mask),
        lambda: surface.maximum_diameter(surface.boundary_faces(mask)),
    )
    sizes = components.volume_shape(
        components.component_shape(components.component_moments(runs))
    )
    joined = (
        sizes.join(surface.surface_area(mask), "volume_id", "left")
        .join(diameter, "volume_id", "left")
        .fillna(0.0, ["surface_area", "maximum_diameter"])
    )
    return surface.derived_ratios(joined)


def volume_features(image: DataFrame, mask: DataFrame) -> DataFrame:
    """All 19 features per volume, from normalised image and mask slices.

    Shape is measured on the original grid; intensity and texture on the
    halved one. The intermediate voxel tables hold mask cells only and are
    written once for all that read them.
    """
    voxels = freeze(volumes.to_voxels(volumes.with_depth(mask), positive_only=True))

    def masked_cells() -> DataFrame:
        small = freeze(volumes.resample_mask(voxels))
        return volumes.rescale_masked(freeze(volumes.mask_image(small, image)))

    shape, masked = at_once(voxels.sparkSession, lambda: shape_features(voxels), masked_cells)
    rows = shape.join(intensity.intensity_features(masked), "volume_id", "left").join(
        texture.texture_features(masked), "volume_id", "left"
    )
    return rows.select("volume_id", *[F.col(c).cast("double").alias(c) for c in IMAGE_FEATURES])
