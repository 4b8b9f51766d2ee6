"""Surface of masks: exposed faces, iso-surface area, largest diameter."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortline.functions.mesh import cell_areas, cell_triangles, corner_bit, lattice_edge
from cohortline.plans.durable import freeze
from cohortline.plans.skew import attach

# Surface points lie 1/510 of a voxel from the unset voxel. In units of 1/510
# all coordinates are whole, so distances compare exactly.
UNIT = 510


def boundary_faces(voxels: DataFrame) -> DataFrame:
    """Faces between a mask voxel and a non-mask neighbour, one row each.

    Every voxel names its six faces; a face named twice lies between two mask
    voxels. One aggregate, no neighbour join. ``inside`` tells whether the
    neighbour lies within the image. Input rows need ``depth, height, width``.
    """
    named = voxels.select(
        "volume_id", "depth", "height", "width",
        F.explode(
            F.expr(
                """array(
                named_struct('axis', 0, 'z', z, 'y', y, 'x', x, 'side', 1),
                named_struct('axis', 0, 'z', z + 1, 'y', y, 'x', x, 'side', -1),
                named_struct('axis', 1, 'z', z, 'y', y, 'x', x, 'side', 1),
                named_struct('axis', 1, 'z', z, 'y', y + 1, 'x', x, 'side', -1),
                named_struct('axis', 2, 'z', z, 'y', y, 'x', x, 'side', 1),
                named_struct('axis', 2, 'z', z, 'y', y, 'x', x + 1, 'side', -1))"""
            )
        ).alias("f"),
    )
    faces = named.groupBy("volume_id", "f.axis", "f.z", "f.y", "f.x").agg(
        F.count("*").alias("owners"),
        F.max("f.side").alias("side"),
        *[F.max(c).alias(c) for c in ("depth", "height", "width")],
    )
    place = F.expr("CASE axis WHEN 0 THEN z WHEN 1 THEN y ELSE x END")
    length = F.expr("CASE axis WHEN 0 THEN depth WHEN 1 THEN height ELSE width END")
    return faces.filter("owners = 1").select(
        "volume_id", "axis", "z", "y", "x", "side",
        ((place > 0) & (place < length)).alias("inside"),
    )


def face_counts(faces: DataFrame) -> DataFrame:
    return faces.groupBy("volume_id").agg(
        F.count("*").alias("exposed_faces"), F.count_if("inside").alias("inner_faces")
    )


def _cells(voxels: DataFrame) -> DataFrame:
    """``volume_id, z, y, x, pattern`` of every cell of 2 x 2 x 2 voxels that holds a mask voxel.

    Cells lie within the image, so a mask at the border is not capped.
    """
    corners = ", ".join(
        f"named_struct('z', z - {dz}, 'y', y - {dy}, 'x', x - {dx}, 'bit', {corner_bit(dz, dy, dx)})"
        for dz in (0, 1)
        for dy in (0, 1)
        for dx in (0, 1)
    )
    return (
        voxels.select(
            "volume_id", "depth", "height", "width", F.explode(F.expr(f"array({corners})")).alias("c")
        )
        .filter(
            "c.z >= 0 AND c.y >= 0 AND c.x >= 0 "
            "AND c.z < depth - 1 AND c.y < height - 1 AND c.x < width - 1"
        )
        .groupBy("volume_id", "c.z", "c.y", "c.x")
        .agg(F.bit_or("c.bit").alias("pattern"))
    )


def surface_area(voxels: DataFrame) -> DataFrame:
    """Area of the iso-surface of the mask, from the corner pattern of each cell.

    Cells are counted per pattern before the areas are looked up: at most 256
    rows per volume meet the table of 256 areas.
    """
    counted = _cells(voxels).groupBy("volume_id", "pattern").agg(F.count("*").alias("cells"))
    table = voxels.sparkSession.createDataFrame(
        list(enumerate(cell_areas())), "pattern int, area double"
    )
    return (
        counted.join(F.broadcast(table), "pattern")
        .groupBy("volume_id")
        .agg(F.sum(F.col("cells") * F.col("area")).alias("surface_area"))
    )


# A vertex is named by the lattice edge it lies on: the lower voxel, the direction
# and the side of the set voxel. Cells that share an edge share its vertex.
EDGE = ["z", "y", "x", "axis", "side"]


def mesh_triangles(voxels: DataFrame) -> DataFrame:
    """``volume_id, z, y, x, number, corners``: the triangles of every cell, three vertex names each."""
    rows = [
        (pattern, number, [lattice_edge(e, pattern) for e in triangle])
        for pattern, triangles in enumerate(cell_triangles())
        for number, triangle in enumerate(triangles)
    ]
    named = ", ".join(f"{c}: int" for c in EDGE)
    table = voxels.sparkSession.createDataFrame(rows, f"pattern int, number int, edges array<struct<{named}>>")
    moved = F.transform(
        "edges",
        lambda e: F.struct(
            *[(F.col(c) + e[c]).alias(c) for c in "zyx"], e["axis"].alias("axis"), e["side"].alias("side")
        ),
    )
    found = _cells(voxels).join(F.broadcast(table), "pattern")
    return found.select("volume_id", "z", "y", "x", "number", moved.alias("corners"))


def mesh_vertices(triangles: DataFrame) -> DataFrame:
    """``volume_id``, the name of each vertex and its place ``pz, py, px``, once for all triangles at it."""
    names = triangles.select("volume_id", F.explode("corners").alias("e")).select("volume_id", "e.*").distinct()
    along = F.when(F.col("side") == 1, 1 / UNIT).otherwise(1 - 1 / UNIT)
    places = [
        (F.col(c) + F.when(F.col("axis") == i, along).otherwise(0.0)).alias(f"p{c}") for i, c in enumerate("zyx")
    ]
    return names.select("volume_id", *EDGE, *places)


def mesh_area(triangles: DataFrame, vertices: DataFrame) -> DataFrame:
    """Area of each volume's mesh, and its numbers of triangles and vertices."""
    cell = ["volume_id", "z", "y", "x", "number"]
    corners = triangles.select(
        F.struct(*cell).alias("triangle"), "volume_id", F.posexplode("corners").alias("k", "e")
    ).select("triangle", "volume_id", "k", "e.*")
    held = F.array_sort(F.collect_list(F.struct("k", "pz", "py", "px"))).alias("p")
    met = corners.join(vertices, ["volume_id", *EDGE]).groupBy("triangle").agg(held)

    def side(k: int, c: str) -> Column:
        return F.col("p")[k][f"p{c}"] - F.col("p")[0][f"p{c}"]

    (a, b, c), (d, e, f) = ([side(k, axis) for axis in "zyx"] for k in (1, 2))
    area = F.sqrt(F.pow(b * f - c * e, 2) + F.pow(c * d - a * f, 2) + F.pow(a * e - b * d, 2)) / 2
    sizes = met.select(F.col("triangle.volume_id").alias("volume_id"), area.alias("area"))
    totals = sizes.groupBy("volume_id").agg(F.sum("area").alias("surface_area"), F.count("*").alias("triangles"))
    points = vertices.groupBy("volume_id").agg(F.count("*").alias("vertices"))
    return totals.join(points, "volume_id")


def surface_points(faces: DataFrame) -> DataFrame:
    """The iso-surface points of the faces inside the image, in 1/510 voxel.

    The point of a face lies between a voxel and its unset neighbour, 1/510
    from the neighbour. ``side`` is 1 when the set voxel has the higher index.
    """
    near = f"CASE WHEN side = 1 THEN {1 - UNIT} ELSE {UNIT - 1} END"
    back = "CASE WHEN side = 1 THEN 0 ELSE 1 END"

    def along(axis: int, c: str) -> str:
        moved = f"({c} - ({back})) * {UNIT}L + ({near})"
        return f"CASE WHEN axis = {axis} THEN {moved} ELSE {c} * {UNIT}L END"

    return faces.filter("inside").select(
        "volume_id",
        *[F.expr(along(i, c)).alias(c) for i, c in enumerate("zyx")],
    )


def _line_ends(points: DataFrame) -> DataFrame:
    """Points that can be an end of a longest distance.

    On a line of points only the two ends can, since distance is convex. Lines
    along x, then y, then z are thinned in turn.
    """
    for axis in "xyz":
        line = [c for c in "zyx" if c != axis]
        ends = points.groupBy("volume_id", *line).agg(
            F.min(axis).alias("lo"), F.max(axis).alias("hi")
        )
        points = ends.select(
            "volume_id", *line, F.explode(F.array_distinct(F.array("lo", "hi"))).alias(axis)
        ).select("volume_id", "z", "y", "x")
    return points


def _boxes(points: DataFrame, size: int) -> DataFrame:
    """Tight boxes around the points of each cube of edge ``size``, with one member."""
    cube = [F.floor(F.col(c) / size).alias(f"b{c}") for c in "zyx"]
    return points.groupBy("volume_id", *cube).agg(
        F.min(F.struct("z", "y", "x")).alias("member"),
        *[f(c).alias(f"{n}{c}") for c in "zyx" for n, f in (("lo", F.min), ("hi", F.max))],
    )


def maximum_diameter(faces: DataFrame, branch: int = 8) -> DataFrame:
    """Largest distance between two surface points, exact, without forming all pairs.

    Pairs of boxes are refined from one box per volume down to single points.
    A pair survives a round only if the farthest its boxes can reach is not
    below the longest distance already seen between members of any pair.
    """
    points = freeze(_line_ends(surface_points(faces)))
    extent = points.agg(*[F.max(c) for c in "zyx"]).first()
    if extent[0] is None:
        return points.groupBy("volume_id").agg(F.lit(0.0).alias("maximum_diameter"))
    # Coarsest cube: holds any volume, so every volume starts as one box.
    size = UNIT
    while size <= max(extent):
        size *= branch
    boxes = _boxes(points, size)
    a = boxes.select("volume_id", *[F.col(f"b{c}").alias(f"a{c}") for c in "zyx"])
    pairs = a.select("volume_id", "az", "ay", "ax", *[F.col(f"a{c}").alias(f"c{c}") for c in "zyx"])
    while True:
        finer = size // branch if size > UNIT else 1
        reached = _refine(pairs, points, size, finer)
        best = reached.groupBy("volume_id").agg(F.max("seen").alias("longest"))
        if finer == 1:
            break
        kept = attach(reached, best, ["volume_id"]).filter("reach >= longest")
        pairs = kept.select("volume_id", "az", "ay", "ax", "cz", "cy", "cx")
        size = finer
    return best.select(
        "volume_id", (F.sqrt(F.col("longest").cast("double")) / UNIT).alias("maximum_diameter")
    )


def _refine(pairs: DataFrame, points: DataFrame, size: int, finer: int) -> DataFrame:
    """Split both boxes of each pair; give the reach and a known distance of each new pair."""
    parent = [F.floor(F.col(f"b{c}") * finer / size).alias(f"p{c}") for c in "zyx"]
    children = _boxes(points, finer).select("*", *parent)

    def side(name: str) -> DataFrame:
        keys = [F.col(f"p{c}").alias(f"{name}{c}") for c in "zyx"]
        body = F.struct(
            "member", *[f"b{c}" for c in "zyx"], *[f"{e}{c}" for c in "zyx" for e in ("lo", "hi")]
        )
        return children.select("volume_id", *keys, body.alias(f"box_{name}"))

    split = pairs.join(side("a"), ["volume_id", "az", "ay", "ax"]).join(
        side("c"), ["volume_id", "cz", "cy", "cx"]
    )
    # Each unordered pair once.
    order = [F.struct(*[F.col(f"box_{n}")[f"b{c}"] for c in "zyx"]) for n in "ac"]
    split = split.filter(order[0] <= order[1])
    seen = " + ".join(
        f"(box_a.member.{c} - box_c.member.{c}) * (box_a.member.{c} - box_c.member.{c})"
        for c in "zyx"
    )
    reach = " + ".join(
        f"greatest(abs(box_a.hi{c} - box_c.lo{c}), abs(box_c.hi{c} - box_a.lo{c}))"
        f" * greatest(abs(box_a.hi{c} - box_c.lo{c}), abs(box_c.hi{c} - box_a.lo{c}))"
        for c in "zyx"
    )
    return freeze(
        split.select(
            "volume_id",
            *[F.col("box_a")[f"b{c}"].alias(f"a{c}") for c in "zyx"],
            *[F.col("box_c")[f"b{c}"].alias(f"c{c}") for c in "zyx"],
            F.expr(reach).alias("reach"),
            F.expr(seen).alias("seen"),
        )
    )


def derived_ratios(shape: DataFrame) -> DataFrame:
    """Surface to volume, sphericity and compactness from area and voxel count."""
    return shape.withColumns(
        {
            "surface_to_volume_ratio": F.expr("surface_area / volume"),
            "sphericity": F.expr(
                "power(pi(), 1.0D / 3) * power(6.0D * volume, 2.0D / 3) / nullif(surface_area, 0D)"
            ),
            "compactness": F.expr(
                "surface_area * surface_area * surface_area "
                "/ (cast(volume AS DOUBLE) * cast(volume AS DOUBLE))"
            ),
        }
    )
