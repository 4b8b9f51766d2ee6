"""Connected components of masks and their size and shape.

Voxels are first joined into runs along x, which shrinks the graph by the run
length; runs that touch become edges; the graph is then contracted round by
round.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortline.functions.moments import symmetric_extremes
from cohortline.plans.durable import freeze
from cohortline.plans.skew import attach

# A component flatter than this share of its length has no elongation.
FLAT = 1e-9


def voxel_runs(voxels: DataFrame) -> DataFrame:
    """Maximal runs of equal value along x: ``(volume_id, z, y, x0, x1, value, run)``.

    A run is named by its first voxel ``(z, y, x)``.

    The window runs over one image row, which is bounded by the image width.
    """
    row = Window.partitionBy("volume_id", "z", "y", "value").orderBy("x")
    marked = voxels.select("volume_id", "z", "y", "x", "value").withColumn(
        "__island", F.col("x") - F.row_number().over(row)
    )
    runs = marked.groupBy("volume_id", "z", "y", "value", "__island").agg(
        F.min("x").alias("x0"), F.max("x").alias("x1")
    )
    return runs.select(
        "volume_id", "z", "y", "x0", "x1", "value",
        F.struct("z", "y", F.col("x0").alias("x")).alias("run"),
    )


def touching_runs(runs: DataFrame) -> DataFrame:
    """Pairs of runs of one value that touch by face, edge or corner.

    Each run looks at the four rows before it in (z, y) order; the join is an
    equi-join on the row, and one row holds a bounded number of runs.
    """
    here = runs.withColumn(
        "side",
        F.explode(
            F.expr(
                """array(named_struct('z', z, 'y', y - 1), named_struct('z', z - 1, 'y', y - 1),
                         named_struct('z', z - 1, 'y', y), named_struct('z', z - 1, 'y', y + 1))"""
            )
        ),
    ).select(
        "volume_id", F.col("side.z").alias("z"), F.col("side.y").alias("y"), "value",
        F.col("x0").alias("a0"), F.col("x1").alias("a1"), F.col("run").alias("u"),
    )
    joined = here.join(runs, ["volume_id", "z", "y", "value"])
    near = (F.col("x0") <= F.col("a1") + 1) & (F.col("a0") <= F.col("x1") + 1)
    return joined.filter(near).select("volume_id", "u", F.col("run").alias("v"))


def connected_components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Label the nodes ``(volume_id, node)`` of a graph with ``component``.

    Randomised contraction: in each round every node picks the neighbour (or
    itself) with the smallest hash, edges are redrawn between the picks, and
    repeats and loops vanish. The graph shrinks by a constant factor per round
    in expectation, so the number of rounds is logarithmic. Each round is
    written, so lineage stays short. The label is the smallest node.

    A contracted node only takes in direct neighbours that picked it, so its
    share of the edges stays small until few edges are left; the joins of a
    round therefore have no hot key while they are large.
    """
    both = freeze(
        edges.union(edges.select("volume_id", F.col("v"), F.col("u")))
        .toDF("volume_id", "u", "v")
        .filter(F.col("u") != F.col("v"))
        .distinct()
    )
    picks: list[DataFrame] = []
    while not both.isEmpty():
        salt = F.lit(len(picks))
        best = both.groupBy("volume_id", "u").agg(
            F.min(F.struct(F.xxhash64("v", salt).alias("h"), F.col("v"))).alias("best")
        )
        own = F.struct(F.xxhash64("u", salt).alias("h"), F.col("u").alias("v"))
        pick = freeze(
            best.select("volume_id", "u", F.least("best", own)["v"].alias("pick"))
        )
        picks.append(pick)
        left = pick.select("volume_id", "u", F.col("pick").alias("pu"))
        right = pick.select("volume_id", F.col("u").alias("v"), F.col("pick").alias("pv"))
        both = freeze(
            both.join(left, ["volume_id", "u"])
            .join(right, ["volume_id", "v"])
            .filter(F.col("pu") != F.col("pv"))
            .select("volume_id", F.col("pu").alias("u"), F.col("pv").alias("v"))
            .distinct()
        )

    def compose(later: DataFrame, earlier: DataFrame) -> DataFrame:
        """Follow the picks of ``earlier`` through those of ``later``."""
        follow = later.select("volume_id", F.col("u").alias("pick"), F.col("pick").alias("root"))
        return earlier.join(follow, ["volume_id", "pick"], "left").select(
            "volume_id", "u", F.coalesce("root", "pick").alias("pick")
        )

    if not picks:
        return nodes.withColumn("component", F.col("node"))
    roots = reduce(compose, reversed(picks))
    rooted = nodes.join(roots.withColumnRenamed("u", "node"), ["volume_id", "node"], "left")
    rooted = freeze(rooted.select("volume_id", "node", F.coalesce("pick", "node").alias("root")))
    smallest = rooted.groupBy("volume_id", "root").agg(F.min("node").alias("component"))
    # One giant component may own a large share of the nodes: its key is split.
    return attach(rooted, smallest, ["volume_id", "root"]).select(
        "volume_id", "node", "component"
    )


def label_runs(voxels: DataFrame) -> DataFrame:
    """Runs with the component they belong to, full (26-) connectivity."""
    runs = freeze(voxel_runs(voxels))
    labels = connected_components(
        runs.select("volume_id", F.col("run").alias("node")), touching_runs(runs)
    )
    return runs.join(labels.withColumnRenamed("node", "run"), ["volume_id", "run"])


def component_moments(labelled: DataFrame) -> DataFrame:
    """Voxel count and exact second moments of every component.

    Sums along a run have closed forms, and sums over runs are whole numbers
    combined on the map side, so one huge component does not burden one task.
    """
    n = "cast(x1 - x0 + 1 AS BIGINT)"
    sum_x = f"({n} * (x0 + x1) div 2)"
    sum_xx = "(cast(x1 AS BIGINT) * (x1 + 1) * (2 * x1 + 1) - cast(x0 AS BIGINT) * (x0 - 1) * (2 * x0 - 1)) div 6"
    parts = {
        "n": n,
        "sx": sum_x,
        "sy": f"{n} * y",
        "sz": f"{n} * z",
        "sxx": sum_xx,
        "syy": f"{n} * y * y",
        "szz": f"{n} * z * z",
        "sxy": f"{sum_x} * y",
        "sxz": f"{sum_x} * z",
        "syz": f"{n} * y * z",
    }
    sums = labelled.groupBy("volume_id", "component").agg(
        *[F.expr(f"sum({e})").alias(c) for c, e in parts.items()]
    )

    def spread(product: str, a: str, b: str):
        """Population covariance from whole numbers, exact up to the last division."""
        wide = "cast({0} AS DECIMAL(19, 0))"
        exact = " - ".join(
            f"{wide.format(p)} * {wide.format(q)}" for p, q in (("n", product), (a, b))
        )
        return F.expr(f"cast({exact} AS DOUBLE) / (cast(n AS DOUBLE) * cast(n AS DOUBLE))")

    return sums.select(
        "volume_id",
        "component",
        "n",
        *[
            spread(f"s{a}{b}", f"s{a}", f"s{b}").alias(f"c{a}{b}")
            for a, b in ("xx", "yy", "zz", "xy", "xz", "yz")
        ],
    )


def component_shape(moments: DataFrame) -> DataFrame:
    """Axis lengths, elongation and sphere radius of every component."""
    smallest, largest = symmetric_extremes("cxx", "cyy", "czz", "cxy", "cxz", "cyz")
    axes = moments.withColumns({"__low": smallest, "__high": largest})
    round_enough = (F.col("__high") > 0) & (F.col("__low") > F.col("__high") * FLAT)
    return axes.select(
        "volume_id",
        "component",
        F.col("n").alias("volume"),
        F.sqrt(F.lit(20.0) * F.col("__high")).alias("major_axis"),
        F.sqrt(F.lit(20.0) * F.greatest("__low", F.lit(0.0))).alias("minor_axis"),
        F.when(round_enough, F.sqrt(F.col("__high") / F.col("__low")))
        .otherwise(1.0)
        .alias("elongation"),
        F.expr("power(3.0D * n / (4 * pi()), 1.0D / 3)").alias("radius"),
    )


def volume_shape(shapes: DataFrame) -> DataFrame:
    """Per volume: number of components, total size, summed radius, mean elongation."""
    return shapes.groupBy("volume_id").agg(
        F.count("*").alias("n_tumours"),
        F.sum("volume").alias("volume"),
        F.sum("radius").alias("radius"),
        F.avg("elongation").alias("elongation"),
    )
