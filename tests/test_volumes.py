"""Volume operators on volumes with known answers, and against brute force."""

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortline.functions.mesh import UNSET_GAP, cell_areas
from cohortline.operators import components, features, intensity, surface, texture, volumes


def mask_frame(spark, arrays):
    """Mask voxels with their grid, from named 3-D arrays."""
    rows = [
        (name, int(z), int(y), int(x), int(a[z, y, x]), *a.shape)
        for name, a in arrays.items()
        for z, y, x in zip(*np.nonzero(a))
    ]
    return spark.createDataFrame(
        rows,
        "volume_id string, z int, y int, x int, value int, depth int, height int, width int",
    )


def slice_frame(spark, arrays):
    rows = [
        (name, z, a.shape[1], a.shape[2], [int(v) for v in a[z].ravel()])
        for name, a in arrays.items()
        for z in range(a.shape[0])
    ]
    return spark.createDataFrame(
        rows, "volume_id string, z int, height int, width int, pixels array<int>"
    )


def grid(shape, *voxels, value=255):
    a = np.zeros(shape, dtype=int)
    for v in voxels:
        a[v] = value
    return a


def box():
    a = np.zeros((5, 5, 5), dtype=int)
    a[1:4, 1:4, 1:4] = 255
    return a


def ball(r, n):
    c = (n - 1) / 2
    z, y, x = np.indices((n, n, n))
    return np.where((z - c) ** 2 + (y - c) ** 2 + (x - c) ** 2 <= r * r, 255, 0)


KNOWN = {
    "box": box(),
    "corner": grid((4, 4, 4), (1, 1, 1), (2, 2, 2)),
    "apart": grid((4, 4, 6), (1, 1, 1), (1, 1, 3)),
    "single": grid((3, 3, 3), (1, 1, 1)),
    "plate": grid((5, 5, 5), *[(2, y, x) for y in (1, 2, 3) for x in (1, 2, 3)]),
    "two_values": grid((3, 3, 5), (1, 1, 1)) + grid((3, 3, 5), (1, 1, 2), value=100),
}


def by_volume(df):
    return {r["volume_id"]: r for r in df.collect()}


def test_components_of_known_volumes(spark):
    moments = components.component_moments(components.label_runs(mask_frame(spark, KNOWN)))
    shape = by_volume(components.volume_shape(components.component_shape(moments)))
    assert {n: r["n_tumours"] for n, r in shape.items()} == {
        "box": 1, "corner": 1, "apart": 2, "single": 1, "plate": 1, "two_values": 2,
    }
    assert shape["box"]["volume"] == 27
    assert shape["box"]["elongation"] == pytest.approx(1.0)
    assert shape["single"]["elongation"] == shape["plate"]["elongation"] == 1.0
    assert shape["apart"]["radius"] == pytest.approx(2 * (3 / (4 * math.pi)) ** (1 / 3))


def flood(a):
    """Component sizes by plain search."""
    left, sizes = set(zip(*map(list, np.nonzero(a)))), []
    near = [d for d in itertools.product((-1, 0, 1), repeat=3) if any(d)]
    while left:
        todo, size = [left.pop()], 0
        while todo:
            p = todo.pop()
            size += 1
            for d in near:
                q = tuple(int(i + j) for i, j in zip(p, d))
                if q in left:
                    left.remove(q)
                    todo.append(q)
        sizes.append(size)
    return sorted(sizes)


def test_components_of_random_volumes(spark):
    rng = np.random.default_rng(3)
    arrays = {f"r{i}": (rng.random((6, 9, 12)) < share) * 255 for i, share in enumerate((0.05, 0.1, 0.3))}
    snake = np.zeros((3, 9, 40), dtype=int)
    snake[1, ::2, :] = 255
    for y in range(1, 9, 2):
        snake[1, y, -1 if y % 4 == 1 else 0] = 255
    arrays["snake"] = snake
    labelled = components.label_runs(mask_frame(spark, arrays))
    sizes = components.component_moments(labelled).groupBy("volume_id").agg(
        F.sort_array(F.collect_list("n")).alias("sizes")
    )
    assert {r[0]: r[1] for r in sizes.collect()} == {n: flood(a) for n, a in arrays.items()}


def test_components_of_far_coordinates(spark):
    far = 1 << 20
    voxels = spark.createDataFrame(
        [("v", 0, 0, 0, 255), ("v", 0, 1, 1, 255), ("v", 0, 0, far, 255), ("v", far + 5, 0, 3, 255)],
        "volume_id string, z int, y int, x int, value int",
    )
    sizes = components.component_moments(components.label_runs(voxels)).select("n").collect()
    assert sorted(r[0] for r in sizes) == [1, 1, 2]


def test_elongation_of_a_tilted_rod(spark):
    rng = np.random.default_rng(1)
    blob = grid((8, 8, 8))
    for i in range(6):
        blob[i, i, 1 : 4 + i % 2] = 255
    blob[rng.integers(2, 4), 2:4, 2:5] = 255
    points = np.argwhere(blob)
    assert flood(blob) == [len(points)]
    eigen = np.linalg.eigvalsh(np.cov(points.T, bias=True))
    moments = components.component_moments(components.label_runs(mask_frame(spark, {"rod": blob})))
    row = components.component_shape(moments).first()
    assert row["elongation"] == pytest.approx(math.sqrt(eigen[-1] / eigen[0]), rel=1e-9)
    assert row["major_axis"] == pytest.approx(math.sqrt(20 * eigen[-1]), rel=1e-9)
    assert row["minor_axis"] == pytest.approx(math.sqrt(20 * eigen[0]), rel=1e-9)


def test_faces_of_a_box(spark):
    counts = by_volume(surface.face_counts(surface.boundary_faces(mask_frame(spark, KNOWN))))
    assert counts["box"]["exposed_faces"] == counts["box"]["inner_faces"] == 54
    whole = mask_frame(spark, {"full": np.full((3, 3, 3), 255)})
    row = surface.face_counts(surface.boundary_faces(whole)).first()
    assert (row["exposed_faces"], row["inner_faces"]) == (54, 0)


def test_mesh_area_of_a_box_and_a_ball(spark):
    areas = by_volume(surface.surface_area(mask_frame(spark, {"box": box(), "ball": ball(12, 29)})))
    reach = 1 - UNSET_GAP
    # Six flat sides, twelve bevelled edges and eight corner triangles.
    closed = 6 * 4 + 12 * 2 * math.sqrt(2) * reach + 8 * math.sqrt(3) / 2 * reach**2
    assert areas["box"]["surface_area"] == pytest.approx(closed)
    # The surface lies almost one voxel outside the ball, and is faceted.
    assert areas["ball"]["surface_area"] == pytest.approx(4 * math.pi * 12.6**2, rel=0.1)


def test_cell_areas_do_not_depend_on_orientation():
    areas = cell_areas()
    turned = {0: 4, 1: 5, 2: 0, 3: 1, 4: 6, 5: 7, 6: 2, 7: 3}  # quarter turn about x
    for pattern in range(256):
        image = sum(1 << turned[c] for c in range(8) if pattern >> c & 1)
        assert areas[pattern] == pytest.approx(areas[image])


def surface_points(a):
    points = []
    for p in np.argwhere(a):
        for axis, d in itertools.product(range(3), (-1, 1)):
            q = p.copy()
            q[axis] += d
            if 0 <= q[axis] < a.shape[axis] and not a[tuple(q)]:
                point = p.astype(float)
                point[axis] += d * (1 - UNSET_GAP)
                points.append(point)
    return np.array(points)


@pytest.mark.parametrize("branch", [2, 8])
def test_diameter_equals_all_pairs(spark, branch):
    rng = np.random.default_rng(7)
    arrays = {
        "ball": ball(7, 19),
        "noise": (rng.random((20, 11, 13)) < 0.04) * 255,
        "long": (rng.random((60, 4, 4)) < 0.3) * 255,
        "single": KNOWN["single"],
    }
    faces = surface.boundary_faces(mask_frame(spark, arrays))
    found = by_volume(surface.maximum_diameter(faces, branch))
    for name, a in arrays.items():
        p = surface_points(a)
        best = max(np.sqrt(((p - q) ** 2).sum(axis=1)).max() for q in p)
        assert found[name]["maximum_diameter"] == pytest.approx(best, abs=1e-12)


def linear_half(a):
    """Separable linear sampling of half the cells of each axis, half-up."""
    out = a.astype(float)
    for axis in range(3):
        n = a.shape[axis]
        m = max(round(n / 2), 1)
        at = np.arange(m) * ((n - 1) / (m - 1) if m > 1 else 0)
        low = np.minimum(np.floor(at + 1e-12).astype(int), n - 1)
        high = np.minimum(low + 1, n - 1)
        share = (at - low).reshape([-1 if i == axis else 1 for i in range(3)])
        out = np.take(out, low, axis) * (1 - share) + np.take(out, high, axis) * share
    return np.floor(out + 0.5 + 1e-9).astype(int)


SHAPES = [(7, 10, 9), (1, 6, 5), (12, 8, 8), (3, 3, 3)]


def test_resampling_of_image_and_mask(spark):
    rng = np.random.default_rng(2)
    images = {f"v{i}": rng.integers(0, 256, s) for i, s in enumerate(SHAPES)}
    masks = {n: (rng.random(a.shape) < 0.2) * 255 for n, a in images.items()}
    dense = volumes.resample_linear(slice_frame(spark, images)).collect()
    for name, a in images.items():
        want = linear_half(a)
        got = {(r["z"], r["y"], r["x"]): r["value"] for r in dense if r["volume_id"] == name}
        assert got == {tuple(map(int, p)): int(want[tuple(p)]) for p in np.ndindex(want.shape)}
    sparse = volumes.resample_mask(mask_frame(spark, masks)).collect()
    for name, a in masks.items():
        want = linear_half(a)
        got = {(r["z"], r["y"], r["x"]): r["mask"] for r in sparse if r["volume_id"] == name}
        assert got == {tuple(map(int, p)): int(want[tuple(p)]) for p in np.argwhere(want)}


def test_image_and_mask_of_different_depth(spark):
    rng = np.random.default_rng(4)
    image, mask = rng.integers(0, 256, (9, 6, 6)), np.full((5, 6, 6), 255)
    small = volumes.resample_mask(mask_frame(spark, {"v": mask}))
    got = volumes.mask_image(small, slice_frame(spark, {"v": image})).collect()
    assert len(got) == 2 * 3 * 3  # half of five slices, ties to even
    # Two output slices: the first and the last of the image.
    plane = linear_half(np.stack([image[8]] * 2))[0]
    assert {(r["y"], r["x"]): r["value"] for r in got if r["z"] == 1} == {
        tuple(map(int, p)): int(plane[tuple(p)]) for p in np.ndindex(plane.shape)
    }


def test_normalisation(spark):
    raw = {"v": np.array([[[0, 50], [100, 200]], [[0, 0], [0, 0]], [[7, -1], [3, 5]]])}
    slices = slice_frame(spark, raw)
    own = [r["pixels"] for r in volumes.normalise_slices(slices).orderBy("z").collect()]
    assert own == [[0, 63, 127, 255], [0, 0, 0, 0], [255, 220, 109, 182]]
    file = [r["pixels"] for r in volumes.normalise_files(slices, ["volume_id"]).orderBy("z").collect()]
    assert file[0] == [0, 63, 127, 255] and file[2][0] == int(7 / 200 * 255)


def masked_frame(spark, image, mask, levels=True):
    rows = [
        ("v", int(z), int(y), int(x), int(image[z, y, x]), *map(int, mask.shape))
        for z, y, x in np.argwhere(mask)
    ]
    df = spark.createDataFrame(
        rows, "volume_id string, z int, y int, x int, value int, depth int, height int, width int"
    )
    return volumes.rescale_masked(df)


def dense_texture(image, mask):
    shown = image * (mask > 0)
    span = shown.max() - shown.min()
    level = ((shown - shown.min()) / span * 255).astype(int) if span else shown * 0
    slices = []
    for z in range(len(level)):
        if not mask[z].any():
            continue
        per_angle = []
        for dy, dx in ((0, 1), (1, 1), (1, 0), (1, -1)):
            p = np.zeros((256, 256))
            h, w = level[z].shape
            for y, x in np.ndindex(h, w):
                if 0 <= y + dy < h and 0 <= x + dx < w:
                    i, j = level[z][y, x], level[z][y + dy, x + dx]
                    p[i, j] += 1
                    p[j, i] += 1
            p /= max(p.sum(), 1)
            i, j = np.indices(p.shape)
            mean = (p * i).sum()
            var = (p * (i - mean) ** 2).sum()
            corr = 1 if var < 1e-15 else (p * (i - mean) * (j - mean)).sum() / var
            per_angle.append(
                [(p * (i - j) ** 2).sum(), corr, (p * abs(i - j)).sum(),
                 (p / (1 + (i - j) ** 2)).sum(), math.sqrt((p**2).sum())]
            )
        slices.append(np.mean(per_angle, axis=0))
    return np.mean(slices, axis=0)


CASES = {
    "sparse": ((4, 9, 7), 0.15),
    "dense": ((3, 6, 6), 1.0),
    "thin": ((3, 5, 1), 0.7),
}


@pytest.mark.parametrize("case", CASES)
def test_texture_equals_dense_matrices(spark, case):
    shape, share = CASES[case]
    rng = np.random.default_rng(11)
    image, mask = rng.integers(0, 256, shape), (rng.random(shape) < share) * 255
    mask[1] = 0 if case == "sparse" else mask[1]
    row = texture.texture_features(masked_frame(spark, image, mask)).first()
    assert [row[c] for c in texture.TEXTURES] == pytest.approx(dense_texture(image, mask))


def test_constant_volume(spark):
    image, mask = np.full((3, 3, 3), 9), np.full((3, 3, 3), 255)
    masked = masked_frame(spark, image, mask)
    assert {r["level"] for r in masked.collect()} == {0}
    row = texture.texture_features(masked).first()
    assert (row["contrast"], row["correlation"], row["homogeneity"], row["energy"]) == (0, 1, 1, 1)


def test_intensity(spark):
    rng = np.random.default_rng(6)
    image, mask = rng.integers(0, 256, (4, 5, 6)), (rng.random((4, 5, 6)) < 0.5) * 255
    seen = image[mask > 0]
    row = intensity.intensity_features(masked_frame(spark, image, mask)).first()
    want = [seen.mean(), seen.std(), seen.min(), seen.max(), np.median(seen)]
    assert list(row)[1:] == pytest.approx(want)


def test_feature_row_does_not_depend_on_partitions(spark):
    rng = np.random.default_rng(9)
    image = slice_frame(spark, {"a": rng.integers(0, 900, (8, 8, 8))})
    mask = slice_frame(spark, {"a": (rng.random((8, 8, 8)) < 0.3) * 255})
    rows = [
        features.volume_features(
            volumes.normalise_slices(image.repartition(n, "z")), mask.repartition(n, "z")
        ).first()
        for n in (1, 5)
    ]
    assert len(rows[0]) == 20
    assert list(rows[0])[1:] == pytest.approx(list(rows[1])[1:], rel=1e-12)


def ball_and_voxel(spark, radius=3.2, side=10):
    """A ball and a lone voxel, away from the border."""
    cells = [
        (z, y, x) for z in range(side) for y in range(side) for x in range(side)
        if (z - 4.5) ** 2 + (y - 4.5) ** 2 + (x - 4.5) ** 2 <= radius**2 or (z, y, x) == (1, 1, 8)
    ]
    rows = [("v", side, side, side, *c) for c in cells]
    return spark.createDataFrame(rows, "volume_id string, depth int, height int, width int, z int, y int, x int")


def test_mesh_is_closed_and_shares_its_vertices(spark):
    voxels = ball_and_voxel(spark)
    triangles = surface.mesh_triangles(voxels)
    vertices = surface.mesh_vertices(triangles)
    faces = [[tuple(e) for e in r["corners"]] for r in triangles.collect()]
    sides = {}
    for a, b, c in faces:
        for pair in ((a, b), (b, c), (c, a)):
            sides[frozenset(pair)] = sides.get(frozenset(pair), 0) + 1
    assert set(sides.values()) == {2}
    # Two closed surfaces without holes: corners less edges plus faces is 2 for each.
    names = {tuple(r[c] for c in surface.EDGE) for r in vertices.collect()}
    assert len(names) == vertices.count() and len(names) - len(sides) + len(faces) == 4
    found = surface.mesh_area(triangles, vertices).first()
    table = surface.surface_area(voxels).first()
    assert found["surface_area"] == pytest.approx(table["surface_area"], rel=1e-9)
    assert (found["triangles"], found["vertices"]) == (len(faces), len(names))


def test_vertices_lie_beside_the_unset_voxel(spark):
    one = spark.createDataFrame([("v", 3, 3, 3, 1, 1, 1)], "volume_id string, depth int, height int, width int, z int, y int, x int")
    triangles = surface.mesh_triangles(one)
    places = sorted((r["pz"], r["py"], r["px"]) for r in surface.mesh_vertices(triangles).collect())
    near, far = 1 / 510, 2 - 1 / 510
    assert places == sorted([(v, 1, 1) for v in (near, far)] + [(1, v, 1) for v in (near, far)] + [(1, 1, v) for v in (near, far)])
    area = surface.mesh_area(triangles, surface.mesh_vertices(triangles)).first()["surface_area"]
    assert area == pytest.approx(8 * math.sqrt(3) / 2 * (1 - near) ** 2)
    assert surface.mesh_triangles(one.limit(0)).count() == 0
