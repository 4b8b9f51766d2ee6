"""Volume operators on the embeddings table.

A label is a volume, a vector is a slice of 8 x 8 pixels, and slices are
ordered by the text of their file name. The mask is the cells above 0.2.
"""

from __future__ import annotations

from itertools import permutations, product

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortline.operators import (
    components,
    features,
    intensity,
    surface,
    texture,
    volumes,
)
from cohortline.plans import jobs
from cohortline.plans.durable import freeze, new_path
from cohortline.plans.skew import attach
from cohortline.sources import frames
from cohortline.sources.catalogue import slice_order

SIDE = 8
CUT = 0.2


def _files(spark: SparkSession, sf: str) -> DataFrame:
    files = spark.read.parquet(f"{sf}/embeddings.parquet").select(
        F.col("label").alias("series_id"),
        F.concat(F.lit("1-"), F.col("vec_id").cast("string"), F.lit(".dcm")).alias("file_name"),
        F.col("embedding").cast("array<double>").alias("cells"),
    )
    order = slice_order(files)
    return attach(files, order, ["series_id", "file_name"]).select(
        F.col("series_id").alias("volume_id"),
        F.col("z").cast("int").alias("z"),
        F.lit(SIDE).alias("height"),
        F.lit(SIDE).alias("width"),
        "cells",
    )


def raw_image(spark: SparkSession, sf: str, files: DataFrame | None = None) -> DataFrame:
    """Slices in raw units 0..255 of the whole table."""
    files = files or _files(spark, sf)
    cells = spark.read.parquet(f"{sf}/embeddings.parquet").agg(
        F.min(F.array_min("embedding")).cast("double"),
        F.max(F.array_max("embedding")).cast("double"),
    )
    low, high = cells.first()
    raw = F.transform(
        "cells",
        lambda v: F.floor((v - F.lit(low)) / (F.lit(high) - F.lit(low)) * 255).cast("int"),
    )
    return files.select("volume_id", "z", "height", "width", raw.alias("pixels"))


def image(spark: SparkSession, sf: str, files: DataFrame | None = None) -> DataFrame:
    return volumes.normalise_slices(raw_image(spark, sf, files))


def mask(spark: SparkSession, sf: str, files: DataFrame | None = None) -> DataFrame:
    """Mask frames; all frames of a volume belong to one file."""
    frames = (files or _files(spark, sf)).withColumn(
        "pixels", F.transform("cells", lambda v: F.when(v > F.lit(CUT), 1).otherwise(0))
    )
    return volumes.normalise_files(frames.drop("cells"), ["volume_id"])


def mask_voxels(spark: SparkSession, sf: str, files: DataFrame | None = None) -> DataFrame:
    return volumes.to_voxels(volumes.with_depth(mask(spark, sf, files)), positive_only=True)


def masked(spark: SparkSession, sf: str) -> DataFrame:
    files = _files(spark, sf)
    small = freeze(volumes.resample_mask(mask_voxels(spark, sf, files)))
    return volumes.rescale_masked(freeze(volumes.mask_image(small, image(spark, sf, files))))


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    doubles = [n for n, t in df.dtypes if t == "double"]
    return df.withColumns({c: F.round(c, digits) for c in doubles})


def slice_normalise(spark: SparkSession, sf: str) -> DataFrame:
    return volumes.to_voxels(image(spark, sf)).select("volume_id", "z", "y", "x", "value")


def volume_voxels(spark: SparkSession, sf: str) -> DataFrame:
    cells = volumes.to_voxels(raw_image(spark, sf))
    return cells.groupBy("volume_id").agg(
        (F.max("z") + 1).cast("int").alias("depth"),
        (F.max("y") + 1).cast("int").alias("height"),
        (F.max("x") + 1).cast("int").alias("width"),
        F.count("*").alias("cells"),
        F.sum("value").alias("total"),
        F.expr("sum(cast(value AS BIGINT) * (z + 1) * (y + 2) * (x + 3))").alias("place_check"),
    )


def resample_linear(spark: SparkSession, sf: str) -> DataFrame:
    return volumes.resample_linear(image(spark, sf))


def resample_mask(spark: SparkSession, sf: str) -> DataFrame:
    return volumes.resample_mask(mask_voxels(spark, sf)).select("volume_id", "z", "y", "x", "mask")


def mask_rescale(spark: SparkSession, sf: str) -> DataFrame:
    return masked(spark, sf).select("volume_id", "z", "y", "x", "value", "level")


def component_table(spark: SparkSession, sf: str) -> DataFrame:
    moments = components.component_moments(components.label_runs(mask_voxels(spark, sf)))
    return moments.select(
        "volume_id",
        F.col("component.z").cast("int").alias("z"),
        F.col("component.y").cast("int").alias("y"),
        F.col("component.x").cast("int").alias("x"),
        F.col("n").alias("voxels"),
    )


def component_shape(spark: SparkSession, sf: str) -> DataFrame:
    moments = components.component_moments(components.label_runs(mask_voxels(spark, sf)))
    return rounded(components.volume_shape(components.component_shape(moments)))


def surface_faces(spark: SparkSession, sf: str) -> DataFrame:
    return surface.face_counts(surface.boundary_faces(mask_voxels(spark, sf)))


def surface_mesh(spark: SparkSession, sf: str) -> DataFrame:
    voxels = freeze(mask_voxels(spark, sf))
    sizes = voxels.groupBy("volume_id").agg(F.count("*").alias("volume"))
    area = surface.surface_area(voxels)
    return rounded(surface.derived_ratios(sizes.join(area, "volume_id")))


def mesh_tables(spark: SparkSession, sf: str) -> DataFrame:
    """Area, triangles and vertices of the mesh, summed over its tables."""
    triangles = freeze(surface.mesh_triangles(mask_voxels(spark, sf)))
    return rounded(surface.mesh_area(triangles, freeze(surface.mesh_vertices(triangles))), 5)


def max_diameter(spark: SparkSession, sf: str) -> DataFrame:
    faces = surface.boundary_faces(mask_voxels(spark, sf))
    return rounded(surface.maximum_diameter(faces))


def intensity_stats(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(intensity.intensity_features(masked(spark, sf)))


def glcm_counts(spark: SparkSession, sf: str) -> DataFrame:
    return (
        texture.cooccurrence(masked(spark, sf))
        .filter("hi > 0")
        .select("volume_id", "z", "angle", "lo", "hi", "pairs", "total")
    )


def glcm_props(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(texture.texture_features(masked(spark, sf)))


def image_features(spark: SparkSession, sf: str) -> DataFrame:
    files = _files(spark, sf)
    return rounded(features.volume_features(image(spark, sf, files), mask(spark, sf, files)))


def image_job(spark: SparkSession, sf: str) -> DataFrame:
    """Image files of every volume, a catalogue and labels to labelled feature rows, in one job."""
    root = new_path(spark, "images")
    files = freeze(_files(spark, sf).join(_names(spark, sf), ["volume_id", "z"]))
    scans = raw_image(spark, sf, files).join(files.select("volume_id", "z", "file_name"), ["volume_id", "z"])
    frame = ["frame", "height", "width", "pixels"]

    def folder(kind: str) -> Column:
        return F.concat(F.lit("study/"), F.col("volume_id").cast("string"), F.lit(f"/{kind}"))

    scans = scans.withColumns({"path": folder("ct"), "frame": F.lit(0)})
    outlines = files.withColumns(
        {
            "path": folder("seg"), "file_name": F.lit("1-1.dcm"), "frame": F.col("z"),
            "pixels": F.transform("cells", lambda v: F.when(v > F.lit(CUT), 1).otherwise(0)),
        }
    )
    frames.write_frames(scans.select("path", "file_name", *frame), root).count()
    frames.write_frames(outlines.select("path", "file_name", *frame), root, bits=1).count()
    volumes_of = files.select("volume_id").distinct()
    subject = F.concat(F.lit("p"), F.col("volume_id").cast("string"))
    # Every third volume has a second scan, which makes its subject ineligible.
    kinds = F.when(F.col("volume_id") % 3 == 1, F.array(*map(F.lit, ("seg", "ct", "ct")))).otherwise(
        F.array(F.lit("seg"), F.lit("ct"))
    )
    catalogue = volumes_of.select("volume_id", subject.alias("Subject ID"), F.posexplode(kinds).alias("at", "kind")).select(
        "Subject ID", F.upper(F.replace("kind", F.lit("seg"), F.lit("SEG"))).alias("Modality"),
        F.concat_ws("/", F.col("volume_id").cast("string"), "kind").alias("File Location"), "at",
    )
    label = F.when(F.col("volume_id") % 5 != 4, (F.col("volume_id") % 2).cast("int"))
    labels = volumes_of.select(subject.alias("patient_id"), label.alias("death_2years"))
    return rounded(jobs.image_features({"study": catalogue}, frames.read_frames(spark, root), labels, ["at"]))


def _names(spark: SparkSession, sf: str) -> DataFrame:
    """The file of each slice."""
    named = spark.read.parquet(f"{sf}/embeddings.parquet").select(
        F.col("label").alias("series_id"),
        F.concat(F.lit("1-"), F.col("vec_id").cast("string"), F.lit(".dcm")).alias("file_name"),
    )
    return slice_order(named).select(F.col("series_id").alias("volume_id"), F.col("z").cast("int").alias("z"), "file_name")


QUERIES = {
    "slice_normalise": slice_normalise,
    "volume_voxels": volume_voxels,
    "resample_linear": resample_linear,
    "resample_mask": resample_mask,
    "mask_rescale": mask_rescale,
    "components": component_table,
    "component_shape": component_shape,
    "surface_faces": surface_faces,
    "surface_mesh": surface_mesh,
    "mesh_tables": mesh_tables,
    "max_diameter": max_diameter,
    "intensity_stats": intensity_stats,
    "glcm_counts": glcm_counts,
    "glcm_props": glcm_props,
    "image_features": image_features,
    "image_job": image_job,
}

# --------------------------------------------------------------------------
# SQL counterparts, written over dense grids and plain joins.
# --------------------------------------------------------------------------

_RAW = f"""
ranked AS (
    SELECT label AS volume_id, embedding,
        CAST(row_number() OVER (PARTITION BY label ORDER BY '1-' || vec_id || '.dcm') - 1 AS INTEGER) AS z
    FROM embeddings),
cells AS (
    SELECT volume_id, z, CAST((i // {SIDE}) AS INTEGER) AS y, CAST((i % {SIDE}) AS INTEGER) AS x, v
    FROM (SELECT volume_id, z, CAST(unnest(embedding) AS DOUBLE) AS v,
                 unnest(range(0, {SIDE * SIDE})) AS i FROM ranked)),
span AS (SELECT min(v) AS lo, max(v) AS hi FROM cells),
raw AS (
    SELECT volume_id, z, y, x, CAST(floor((v - lo) / (hi - lo) * 255) AS INTEGER) AS px, v > {CUT} AS m
    FROM cells, span)
"""
_IMAGE = f"""{_RAW},
img AS (
    SELECT volume_id, z, y, x, m,
        CASE WHEN peak = 0 THEN 0
             ELSE CAST(trunc(CAST(px AS DOUBLE) / peak * 255) AS INTEGER) END AS value
    FROM raw JOIN (SELECT volume_id, z, max(px) AS peak FROM raw GROUP BY ALL) USING (volume_id, z)),
dims AS (SELECT volume_id, max(z) + 1 AS n FROM raw GROUP BY ALL)
"""


def _axis(name: str, sizes: str) -> str:
    """Weights of one axis: every output position against every input position."""
    return f"""
{name} AS (
    SELECT n, i, o, (m - 1) - abs(o * (n - 1) - i * (m - 1)) AS w
    FROM (SELECT n, CAST(round_even(n / 2.0, 0) AS BIGINT) AS m FROM {sizes}) s,
         LATERAL (SELECT unnest(range(0, n)) AS i), LATERAL (SELECT unnest(range(0, m)) AS o)
    WHERE abs(o * (n - 1) - i * (m - 1)) < m - 1)"""


_HALF = f"""{_IMAGE},
{_axis("wz", "(SELECT DISTINCT n FROM dims)")},
{_axis("wyx", f"(SELECT {SIDE} AS n)")},
half AS (
    SELECT volume_id, a.o AS z, b.o AS y, c.o AS x,
        sum(value * a.w * b.w * c.w) AS iv, sum(CASE WHEN m THEN 255 * a.w * b.w * c.w ELSE 0 END) AS mv,
        CAST((round_even(d.n / 2.0, 0) - 1) * {SIDE // 2 - 1} * {SIDE // 2 - 1} AS BIGINT) AS over
    FROM img JOIN dims d USING (volume_id)
    JOIN wz a ON a.n = d.n AND a.i = img.z JOIN wyx b ON b.i = img.y JOIN wyx c ON c.i = img.x
    GROUP BY volume_id, d.n, a.o, b.o, c.o),
small AS (
    SELECT volume_id, CAST(z AS INTEGER) AS z, CAST(y AS INTEGER) AS y, CAST(x AS INTEGER) AS x,
        CAST((2 * iv + over) // (2 * over) AS INTEGER) AS value,
        CAST((2 * mv + over) // (2 * over) AS INTEGER) AS mask
    FROM half)
"""
_LEVELS = f"""{_HALF},
shown AS (SELECT *, CASE WHEN mask > 0 THEN value ELSE 0 END AS shade FROM small),
lim AS (SELECT volume_id, min(shade) AS lo, max(shade) AS hi FROM shown GROUP BY ALL),
grid AS (
    SELECT volume_id, z, y, x, mask, value,
        CASE WHEN hi = lo THEN 0
             ELSE CAST(trunc(CAST(shade - lo AS DOUBLE) / CAST(hi - lo AS DOUBLE) * 255) AS INTEGER)
        END AS level
    FROM shown JOIN lim USING (volume_id))
"""
_GLCM = f"""{_LEVELS},
hit AS (SELECT DISTINCT volume_id, z FROM grid WHERE mask > 0),
step(angle, dy, dx) AS (VALUES (0, 0, 1), (45, 1, 1), (90, 1, 0), (135, 1, -1)),
pair AS (
    SELECT a.volume_id, a.z, angle, least(a.level, b.level) AS lo, greatest(a.level, b.level) AS hi
    FROM grid a SEMI JOIN hit USING (volume_id, z), step, grid b
    WHERE b.volume_id = a.volume_id AND b.z = a.z AND b.y = a.y + dy AND b.x = a.x + dx),
freq AS (
    SELECT *, CAST(sum(pairs) OVER (PARTITION BY volume_id, z, angle) AS BIGINT) AS total
    FROM (SELECT volume_id, z, angle, lo, hi, count(*) AS pairs FROM pair GROUP BY ALL))
"""
_PROPS = f"""{_GLCM},
sym AS (
    SELECT volume_id, z, angle, lo AS i, hi AS j, CASE WHEN lo = hi THEN 2 ELSE 1 END * pairs / (2.0 * total) AS p
    FROM freq
    UNION ALL SELECT volume_id, z, angle, hi, lo, pairs / (2.0 * total) FROM freq WHERE lo < hi),
mu AS (SELECT volume_id, z, angle, sum(p * i) AS mi, sum(p * j) AS mj FROM sym GROUP BY ALL),
per AS (
    SELECT volume_id, z, angle, sum(p * (i - j) * (i - j)) AS contrast, sum(p * abs(i - j)) AS dissimilarity,
        sum(p / (1 + (i - j) * (i - j))) AS homogeneity, sqrt(sum(p * p)) AS energy,
        CASE WHEN sum(p * (i - mi) * (i - mi)) < 1e-12 THEN 1
             ELSE sum(p * (i - mi) * (j - mj)) / sqrt(sum(p * (i - mi) * (i - mi)) * sum(p * (j - mj) * (j - mj)))
        END AS correlation
    FROM sym JOIN mu USING (volume_id, z, angle) GROUP BY ALL),
tex AS (
    SELECT volume_id, avg(contrast) AS contrast, avg(correlation) AS correlation,
        avg(dissimilarity) AS dissimilarity, avg(homogeneity) AS homogeneity, avg(energy) AS energy
    FROM (SELECT volume_id, z, avg(contrast) AS contrast, avg(correlation) AS correlation,
            avg(dissimilarity) AS dissimilarity, avg(homogeneity) AS homogeneity, avg(energy) AS energy
          FROM per GROUP BY ALL) GROUP BY ALL)
"""
_STATS = """
light AS (
    SELECT volume_id, CAST(avg(value) AS DOUBLE) AS mean_intensity, stddev_pop(value) AS std_intensity,
        CAST(min(value) AS DOUBLE) AS min_intensity, CAST(max(value) AS DOUBLE) AS max_intensity,
        CAST(median(value) AS DOUBLE) AS median_intensity
    FROM small WHERE mask > 0 GROUP BY ALL)
"""
_PARTS = """
vox AS (SELECT volume_id, z, y, x, (CAST(z AS BIGINT) * 1048576 + y) * 1048576 + x AS node FROM raw WHERE m),
near AS (
    SELECT a.volume_id, a.node AS u, b.node AS w FROM vox a JOIN vox b
    ON a.volume_id = b.volume_id AND abs(a.z - b.z) <= 1 AND abs(a.y - b.y) <= 1 AND abs(a.x - b.x) <= 1),
walk AS (
    SELECT volume_id, node AS u, node AS w FROM vox
    UNION SELECT walk.volume_id, walk.u, near.w FROM walk JOIN near
    ON near.volume_id = walk.volume_id AND near.u = walk.w),
part AS (SELECT volume_id, u AS node, min(w) AS component FROM walk GROUP BY ALL)
"""
# Eigenvalues by the closed form of a symmetric matrix.
_SHAPES = f"""
cov AS (
    SELECT volume_id, component, count(*) AS n,
        covar_pop(x, x) AS xx, covar_pop(y, y) AS yy, covar_pop(z, z) AS zz,
        covar_pop(x, y) AS xy, covar_pop(x, z) AS xz, covar_pop(y, z) AS yz
    FROM part JOIN vox USING (volume_id, node) GROUP BY ALL),
eig AS (
    SELECT *, (xx + yy + zz) / 3 AS q,
        sqrt(((xx - (xx + yy + zz) / 3) ** 2 + (yy - (xx + yy + zz) / 3) ** 2 + (zz - (xx + yy + zz) / 3) ** 2
            + 2 * (xy * xy + xz * xz + yz * yz)) / 6) AS p FROM cov),
ang AS (
    SELECT *, CASE WHEN p = 0 THEN 0 ELSE acos(greatest(-1, least(1,
        ((xx - q) * ((yy - q) * (zz - q) - yz * yz) - xy * (xy * (zz - q) - yz * xz)
            + xz * (xy * yz - (yy - q) * xz)) / (2 * p * p * p)))) / 3 END AS t FROM eig),
ext AS (SELECT *, q + 2 * p * cos(t) AS high, q + 2 * p * cos(t + 2 * pi() / 3) AS low FROM ang),
bulk AS (
    SELECT volume_id, count(*) AS n_tumours, CAST(sum(n) AS BIGINT) AS volume,
        sum(power(3.0 * n / (4 * pi()), 1.0 / 3)) AS radius,
        avg(CASE WHEN high > 0 AND low > high * {components.FLAT} THEN sqrt(high / low) ELSE 1 END) AS elongation
    FROM ext GROUP BY ALL)
"""
_SIX = "(VALUES (-1, 0, 0), (1, 0, 0), (0, -1, 0), (0, 1, 0), (0, 0, -1), (0, 0, 1)) AS d(dz, dy, dx)"
_FACES = f"""
face AS (
    SELECT a.volume_id, a.z, a.y, a.x, dz, dy, dx,
        a.z + dz BETWEEN 0 AND n - 1 AND a.y + dy BETWEEN 0 AND {SIDE - 1} AND a.x + dx BETWEEN 0 AND {SIDE - 1} AS inside
    FROM (SELECT * FROM raw WHERE m) a JOIN dims USING (volume_id), {_SIX}
    WHERE NOT EXISTS (SELECT 1 FROM raw b WHERE b.m AND b.volume_id = a.volume_id
        AND b.z = a.z + dz AND b.y = a.y + dy AND b.x = a.x + dx))
"""
_POINTS = """
pt AS (
    SELECT volume_id, 510 * z + 509 * dz AS z, 510 * y + 509 * dy AS y, 510 * x + 509 * dx AS x
    FROM face WHERE inside),
far AS (
    SELECT a.volume_id, sqrt(max((a.z - b.z) ** 2 + (a.y - b.y) ** 2 + (a.x - b.x) ** 2)) / 510 AS maximum_diameter
    FROM pt a JOIN pt b USING (volume_id) GROUP BY ALL)
"""
# Area of the surface in a cell, for one corner pattern of each kind that turning
# and mirroring the cell leaves apart. Bit 4a + 2b + c of a pattern is the corner (a, b, c).
_KINDS = {
    0: 0.0, 1: 0.862632555317, 3: 1.411440594604, 6: 1.729178989911, 7: 1.366022074198, 15: 1.0,
    22: 0.869418252252, 23: 0.869414922666, 24: 2.999999954835, 25: 1.502772945187, 27: 1.002772952714,
    30: 0.502776289828, 31: 0.502772960242, 60: 0.005545935539, 61: 0.002776297356, 63: 0.002772967769,
    105: 0.000013318345, 107: 0.000009988759, 111: 0.000006659173, 126: 0.000006659173, 127: 0.000003329586,
    255: 0.0,
}
# Triangles of the same kinds.
_COUNTS = {
    0: 0, 1: 1, 3: 2, 6: 4, 7: 3, 15: 2, 22: 5, 23: 4, 24: 6, 25: 5, 27: 4, 30: 4, 31: 3, 60: 4, 61: 3, 63: 2,
    105: 4, 107: 3, 111: 2, 126: 2, 127: 1, 255: 0,
}


def _kind(pattern: int) -> int:
    """The least pattern that turning and mirroring the cell can give."""
    corners = [(c >> 2 & 1, c >> 1 & 1, c & 1) for c in range(8) if pattern >> c & 1]
    return min(
        sum(1 << 4 * (c[i] ^ u) + 2 * (c[j] ^ v) + (c[k] ^ w) for c in corners)
        for i, j, k in permutations(range(3))
        for u, v, w in product((0, 1), repeat=3)
    )


_AREAS = ", ".join(f"({p}, {_KINDS[_kind(p)]!r})" for p in range(256))
_TRIANGLES = ", ".join(f"({p}, {_COUNTS[_kind(p)]})" for p in range(256))
_MESH = f"""
area(pattern, a) AS (VALUES {_AREAS}),
cube AS (
    SELECT o.volume_id, o.z, o.y, o.x, CAST(sum(CASE WHEN c.m THEN
            (1 << CAST((c.z - o.z) * 4 + (c.y - o.y) * 2 + (c.x - o.x) AS INTEGER)) ELSE 0 END) AS INTEGER) AS pattern
    FROM raw o JOIN dims USING (volume_id) JOIN raw c ON c.volume_id = o.volume_id
        AND c.z BETWEEN o.z AND o.z + 1 AND c.y BETWEEN o.y AND o.y + 1 AND c.x BETWEEN o.x AND o.x + 1
    WHERE o.z < n - 1 AND o.y < {SIDE - 1} AND o.x < {SIDE - 1} GROUP BY ALL),
skin AS (SELECT volume_id, sum(a) AS surface_area FROM cube JOIN area USING (pattern) GROUP BY ALL),
bag AS (SELECT volume_id, count(*) AS volume FROM raw WHERE m GROUP BY ALL),
mesh AS (
    SELECT volume_id, volume, surface_area, surface_area / volume AS surface_to_volume_ratio,
        power(pi(), 1.0 / 3) * power(6.0 * volume, 2.0 / 3) / surface_area AS sphericity,
        surface_area ** 3 / volume ** 2 AS compactness
    FROM skin JOIN bag USING (volume_id))
"""


def _round(*columns: str) -> str:
    return ", ".join(f"round({c}, 6) AS {c}" for c in columns)


_TEX_OUT = _round("contrast", "correlation", "dissimilarity", "homogeneity", "energy")
_LIGHT = [f"{s}_intensity" for s in ("mean", "std", "min", "max", "median")]

_FEATURES = f"""WITH RECURSIVE {_PROPS}, {_STATS}, {_PARTS}, {_SHAPES}, {_FACES}, {_POINTS}, {_MESH},
    rows AS (SELECT volume_id, CAST(n_tumours AS DOUBLE) AS n_tumours,
            {_round("maximum_diameter", "surface_area", "surface_to_volume_ratio")},
            CAST(bulk.volume AS DOUBLE) AS volume,
            {_round("radius", "sphericity", "elongation", "compactness", *_LIGHT)}, {_TEX_OUT}
        FROM bulk JOIN far USING (volume_id) JOIN mesh USING (volume_id)
            JOIN light USING (volume_id) JOIN tex USING (volume_id))"""

ORACLES = {
    "slice_normalise": f"WITH {_IMAGE} SELECT volume_id, z, y, x, value FROM img",
    "volume_voxels": f"""WITH {_RAW}
        SELECT volume_id, CAST(max(z) + 1 AS INTEGER) AS depth, CAST(max(y) + 1 AS INTEGER) AS height,
            CAST(max(x) + 1 AS INTEGER) AS width, count(*) AS cells, CAST(sum(px) AS BIGINT) AS total,
            CAST(sum(CAST(px AS BIGINT) * (z + 1) * (y + 2) * (x + 3)) AS BIGINT) AS place_check
        FROM raw GROUP BY volume_id""",
    "resample_linear": f"WITH {_HALF} SELECT volume_id, z, y, x, value FROM small",
    "resample_mask": f"WITH {_HALF} SELECT volume_id, z, y, x, mask FROM small WHERE mask > 0",
    "mask_rescale": f"WITH {_LEVELS} SELECT volume_id, z, y, x, value, level FROM grid WHERE mask > 0",
    "components": f"""WITH RECURSIVE {_RAW}, {_PARTS}
        SELECT volume_id, CAST(component >> 40 AS INTEGER) AS z,
            CAST((component >> 20) % 1048576 AS INTEGER) AS y, CAST(component % 1048576 AS INTEGER) AS x,
            count(*) AS voxels
        FROM part GROUP BY volume_id, component""",
    "component_shape": f"""WITH RECURSIVE {_RAW}, {_PARTS}, {_SHAPES}
        SELECT volume_id, n_tumours, volume, {_round("radius", "elongation")} FROM bulk""",
    "surface_faces": f"""WITH {_IMAGE}, {_FACES}
        SELECT volume_id, count(*) AS exposed_faces, count(*) FILTER (inside) AS inner_faces
        FROM face GROUP BY volume_id""",
    "surface_mesh": f"""WITH {_IMAGE}, {_MESH}
        SELECT volume_id, volume,
            {_round("surface_area", "surface_to_volume_ratio", "sphericity", "compactness")} FROM mesh""",
    "mesh_tables": f"""WITH {_IMAGE}, {_MESH}, {_FACES},
        points AS (SELECT volume_id, count(*) AS vertices FROM face WHERE inside GROUP BY volume_id),
        tri(pattern, n) AS (VALUES {_TRIANGLES}),
        numbers AS (SELECT volume_id, CAST(sum(n) AS BIGINT) AS triangles FROM cube JOIN tri USING (pattern) GROUP BY volume_id)
        SELECT volume_id, round(surface_area, 5) AS surface_area, triangles, vertices
        FROM skin JOIN points USING (volume_id) JOIN numbers USING (volume_id)""",
    "max_diameter": f"""WITH {_IMAGE}, {_FACES}, {_POINTS}
        SELECT volume_id, {_round("maximum_diameter")} FROM far""",
    "intensity_stats": f"WITH {_HALF}, {_STATS} SELECT volume_id, {_round(*_LIGHT)} FROM light",
    "glcm_counts": f"""WITH {_GLCM}
        SELECT volume_id, z, angle, lo, hi, pairs, total FROM freq WHERE hi > 0""",
    "glcm_props": f"WITH {_PROPS} SELECT volume_id, {_TEX_OUT} FROM tex",
    "image_features": f"{_FEATURES} SELECT * FROM rows",
    "image_job": f"""{_FEATURES} SELECT 'p' || volume_id AS patient_id, * EXCLUDE (volume_id),
        CAST(volume_id % 2 AS INTEGER) AS death_2years FROM rows WHERE volume_id % 3 <> 1 AND volume_id % 5 <> 4""",
}
