"""Splits, preparation, evaluation, training and explanation."""

import math
import time

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from cohortline.operators import evaluation, explain, lasso, neural, prep, splitting, training, wide
from cohortline.plans import jobs, sums


def labelled(spark, n=203, share=0.3):
    return spark.createDataFrame(
        [(i, int(i % 100 < share * 100)) for i in range(n)], "id long, y int"
    )


def test_split_has_exact_quotas(spark):
    df = labelled(spark)
    split = splitting.stratified_split(df, "y", ["id"], 0.2)
    counts = {(r["y"], r["split"]): r["count"] for r in split.groupBy("y", "split").count().collect()}
    assert sum(n for (_, s), n in counts.items() if s == "test") == math.ceil(203 * 0.2)
    whole = splitting.class_counts(df, "y")
    for y, n in whole.items():
        assert abs(counts[y, "test"] - n * 0.2) < 1
        assert counts[y, "test"] + counts[y, "train"] == n
    again = splitting.stratified_split(df.repartition(7), "y", ["id"], 0.2)
    assert sorted(split.collect()) == sorted(again.collect())
    other = splitting.stratified_split(df, "y", ["id"], 0.2, seed=1)
    assert sorted(split.collect()) != sorted(other.collect())


def test_split_of_repeated_keys_and_missing_labels(spark):
    df = spark.range(100).selectExpr("1 AS id", "id AS at", "CAST(id % 2 AS INT) AS y")
    split = splitting.stratified_split(df, "y", ["id"], 0.2)
    counts = {(r["y"], r["split"]): r["count"] for r in split.groupBy("y", "split").count().collect()}
    assert counts == {(0, "test"): 10, (0, "train"): 40, (1, "test"): 10, (1, "train"): 40}
    folds = splitting.stratified_folds(df, "y", ["id"]).groupBy("fold").count().collect()
    assert sorted(tuple(r) for r in folds) == [(f, 20) for f in range(5)]
    with pytest.raises(ValueError, match="equal rows"):
        splitting.stratified_split(df.drop("at"), "y", ["id"], 0.2)
    with pytest.raises(ValueError, match="have no y"):
        splitting.stratified_split(df.selectExpr("id", "nullif(y, 1) AS y"), "y", ["id"])


def test_quotas_by_largest_remainder():
    assert splitting.test_quotas({0: 5, 1: 5}, 0.5) == {0: 2, 1: 3}
    assert splitting.test_quotas({0: 58, 1: 341}, 0.2) == {0: 12, 1: 68}


def test_folds_are_dealt_like_positions():
    sizes = splitting.fold_sizes({0: 7, 1: 12}, 5)
    assert [a + b for a, b in zip(*sizes.values())] == [4, 4, 4, 4, 3]
    assert sizes[0] == [2, 2, 1, 1, 1]


def test_folds_hold_every_class(spark):
    folds = splitting.stratified_folds(labelled(spark), "y", ["id"], 5)
    counts = folds.groupBy("fold", "y").count().collect()
    sizes = splitting.fold_sizes(splitting.class_counts(folds, "y"), 5)
    assert {(r["y"], r["fold"]): r["count"] for r in counts} == {
        (y, f): n for y, ns in sizes.items() for f, n in enumerate(ns)
    }


ROWS = [
    # id, number, code, constant, text, empty
    (1, 1.0, 2, 5.0, "b", None),
    (2, 9.0, 1, 5.0, "a", None),
    (3, None, 1, None, None, None),
    (4, 3.0, 2, 5.0, "b", None),
    (5, 5.0, None, 5.0, "a", None),
]
SCHEMA = "id int, number double, code int, constant double, text string, empty double"


def test_prep_statistics(spark, tmp_path):
    df = spark.createDataFrame(ROWS, SCHEMA)
    roles = prep.column_roles(df, ["id"], ordinals=["code"])
    assert roles == {"numeric": ["number", "constant", "empty"], "ordinal": ["code"], "nominal": ["text"]}
    model = prep.TabularPrep(**roles).fit(df)
    # The empty column is left out; ties go to the smallest value.
    assert model.feature_names() == [
        "numeric__number", "numeric__constant", "ordinal__code", "nominal__text_a", "nominal__text_b",
    ]
    fresh = spark.createDataFrame(
        [(1, None, None, 6.0, "c", 1.0), (2, 17.0, 9, 5.0, None, None)], SCHEMA
    )
    path = str(tmp_path / "prep")
    PipelineModel([model]).write().overwrite().save(path)
    prepared = PipelineModel.load(path).transform(fresh).orderBy("id")
    assert prep.vector_names(prepared) == model.feature_names()
    vectors = [r[0] for r in prepared.select(vector_to_array("features")).collect()]
    # Median of 1, 3, 5, 9 is 4; a constant column is only shifted; unseen text is all zeros.
    assert vectors == [[0.375, 1.0, 1.0, 0.0, 0.0], [2.0, 0.0, 9.0, 1.0, 0.0]]


def test_many_categories_are_one_look_up(spark):
    df = spark.range(3000).selectExpr("id", "concat('v', id) AS kind", "CAST(id AS DOUBLE) AS size")
    model = prep.TabularPrep(numeric=["size"], nominal=["kind"]).fit(df)
    unseen = spark.createDataFrame([(1, "v17", 0.0), (2, "new", 2999.0), (3, None, None)], "id int, kind string, size double")
    ready = model.transform(unseen)
    assert len(ready._jdf.queryExecution().analyzed().toString()) < 200_000
    names = model.feature_names()
    assert len(names) == 3001 and prep.vector_names(ready) == names
    rows = {r["id"]: r["features"].toArray() for r in ready.collect()}
    assert rows[1][names.index("nominal__kind_v17")] == 1 and rows[1].sum() == 1
    assert rows[2][0] == 1 and rows[2].sum() == 1
    assert rows[3][names.index("nominal__kind_v0")] == 1


def test_rare_categories_share_a_place(spark, tmp_path):
    rows = [("a",)] * 5 + [("b",)] * 3 + [("c",)] * 2 + [("d",)] * 2 + [("e",), (None,)]
    df = spark.createDataFrame(rows, "kind string").withColumn("size", F.lit(2.0))

    def places(**limits):
        model = wide.fit_wide(df, {"nominal": ["kind"]}, **limits)
        return {r["value"]: (r["place"], r["rare"]) for r in model.categories.collect()}, model

    every, model = places()
    assert every == {c: (i, False) for i, c in enumerate("abcde")} and model.shared == []
    few, model = places(min_frequency=3)
    assert few == {"a": (0, False), "b": (1, False), "c": (2, True), "d": (2, True), "e": (2, True)}
    # Ties at the limit go by text; a shared place takes one of the places.
    capped, _ = places(max_categories=4)
    assert capped == {"a": (0, False), "b": (1, False), "c": (2, False), "d": (3, True), "e": (3, True)}
    assert places(max_categories=5)[0] == every
    assert places(min_frequency=2, max_categories=3)[0]["c"] == (2, True)
    fresh = spark.createDataFrame([("b",), ("e",), ("new",), (None,)], "kind string")
    model.save(str(tmp_path / "wide"))
    again = wide.load_wide(spark, str(tmp_path / "wide"))
    got = {r["kind"]: r["features"].toArray().tolist() for r in again.transform(fresh).collect()}
    assert got == {"b": [0, 1, 0], "e": [0, 0, 1], "new": [0, 0, 1], None: [1, 0, 0]}
    names = {r["place"]: r["feature"] for r in again.features().collect()}
    assert names == {0: "nominal__kind_a", 1: "nominal__kind_b", 2: "nominal__kind_infrequent"}
    plain = places()[1].transform(fresh).filter("kind = 'new'").first()["features"]
    assert plain.size == 5 and plain.numNonzeros() == 0


def test_a_hundred_thousand_categories(spark):
    df = spark.range(300_000).selectExpr(
        "id", "concat('v', id % 100000) AS kind", "concat('w', id % 3) AS few", "CAST(id AS DOUBLE) AS size", "id % 2 AS y"
    )
    roles = {"numeric": ["size"], "nominal": ["kind", "few"]}
    model = wide.fit_wide(df, roles)
    ready = model.transform(df)
    assert model.width == 1 + 100_000 + 3
    assert len(ready._jdf.queryExecution().analyzed().toString()) < 10_000
    row = ready.filter("id = 299999").first()["features"]
    names = {r["place"]: r["feature"] for r in model.features().filter(F.col("place").isin(row.indices.tolist())).collect()}
    assert dict(zip((names[i] for i in row.indices.tolist()), row.values.tolist())) == {
        "numeric__size": 1.0, "nominal__kind_v99999": 1.0, "nominal__few_w2": 1.0,
    }
    fitted = LogisticRegression(labelCol="y", maxIter=2).fit(ready)
    assert fitted.numFeatures == model.width


def test_wide_preparation_of_empty_columns(spark):
    df = spark.createDataFrame([(1, None, None)], "id int, kind string, size double")
    model = wide.fit_wide(df, {"numeric": ["size"], "nominal": ["kind"]})
    assert model.width == 0 and model.transform(df).first()["features"].size == 0


def test_exact_median(spark):
    df = spark.range(1, 1001).select((F.col("id") * F.col("id")).cast("double").alias("v"))
    exact = {"v": (500**2 + 501**2) / 2}
    assert prep.medians(df, ["v"]) == exact
    assert prep.medians(df, ["v"], margin=0.4) == exact


def test_median_of_awkward_columns(spark):
    rows = [(float(i // 300), None, 3.0 if i else None, -0.5 * i) for i in range(600)]
    df = spark.createDataFrame(rows, "steps double, empty double, same double, falling double")
    assert prep.medians(df, df.columns) == {"steps": 0.5, "same": 3.0, "falling": -149.75}


def test_approximate_median(spark):
    df = spark.range(1, 1001).select((F.col("id") * F.col("id")).cast("double").alias("v"))
    assert abs(prep.approx_medians(df, ["v"])["v"] - 500**2) < 2000


def scored(spark, rows):
    return spark.createDataFrame(rows, "m string, label int, prediction int, score double")


def auc_by_pairs(rows):
    pos = [s for _, y, _, s in rows if y == 1]
    neg = [s for _, y, _, s in rows if y == 0]
    wins = [1.0 if p > n else 0.5 if p == n else 0.0 for p in pos for n in neg]
    return sum(wins) / len(wins)


def test_auc_curve_and_area_agree(spark):
    rng = np.random.default_rng(8)
    rows = []
    for m, levels in (("few", 4), ("many", 400), ("some", 20)):
        for _ in range(300):
            s = float(rng.integers(levels)) / levels
            rows.append((m, int(rng.random() < 0.2 + 0.6 * s), int(s > 0.5), s))
    df = scored(spark, rows)
    want = {m: auc_by_pairs([r for r in rows if r[0] == m]) for m in ("few", "many", "some")}
    got = {r["m"]: r["auc"] for r in evaluation.roc_auc(df, ["m"]).collect()}
    assert got == pytest.approx(want)
    turned = evaluation.roc_auc(df.withColumn("score", -F.col("score")), ["m"]).collect()
    assert {r["m"]: 1 - r["auc"] for r in turned} == pytest.approx(want)
    chart = evaluation.roc_chart(df, ["m"]).collect()
    assert {r["m"]: r["auc"] for r in chart} == pytest.approx(want)
    few = sorted((r["at"], r["fpr"], r["tpr"]) for r in chart if r["m"] == "few")
    assert few[0][1:] == (0.0, 0.0) and few[-1][1:] == (1.0, 1.0)


def test_straight_points_are_left_out(spark):
    rows = [("m", y, 0, s) for s in (0.4, 0.3, 0.2, 0.1) for y in (0, 1)]
    points = evaluation.roc_curve(scored(spark, rows), ["m"]).orderBy("at").collect()
    assert [(r["fpr"], r["tpr"]) for r in points] == [(0, 0), (0.25, 0.25), (1, 1)]


def test_metrics_where_undefined(spark):
    rows = [("none", 1, 0, 0.1), ("none", 0, 0, 0.2), ("one", 1, 1, 0.9), ("one", 1, 0, 0.4)]
    counts = evaluation.confusion(scored(spark, rows), ["m"])
    found = {r["m"]: r for r in evaluation.class_metrics(counts, ["m"]).collect()}
    assert (found["none"]["f1"], found["none"]["balanced_accuracy"]) == (0.0, 0.5)
    assert found["one"]["balanced_accuracy"] == 0.5
    table = evaluation.metrics_table(scored(spark, rows), ["m"]).collect()
    assert {(r["m"], r["metric"]): r["value"] for r in table}["one", "AUC"] is None


def study(spark, n=400):
    rng = np.random.default_rng(12)
    x = rng.normal(size=(n, 4))
    odds = 2 * x[:, 0] - x[:, 1] + 0.5
    y = (rng.random(n) < 1 / (1 + np.exp(-odds))).astype(int)
    rows = [
        (i, *map(float, r), "u" if r[3] > 0 else "v", int(t)) for i, (r, t) in enumerate(zip(x, y))
    ]
    df = spark.createDataFrame(rows, "id long, a double, b double, c double, d double, t string, y int")
    return df, x, y


def test_lasso_is_optimal_for_every_c(spark):
    df, x, y = study(spark)
    data = df.select(F.array("a", "b", "c", "d").alias("x"), F.col("y").cast("double").alias("y"))
    grid = [0.001, 0.1, 10.0, 1000.0]
    found = lasso.fit_grid(data.repartition(3), 4, grid)
    full = np.hstack([x, np.ones((len(x), 1))])
    assert not found[0].weights.any()
    for c, fit in zip(grid, found):
        odds = full @ fit.weights
        gradient = c * full.T @ (1 / (1 + np.exp(-odds)) - y)
        on = fit.weights != 0
        assert gradient[on] == pytest.approx(-np.sign(fit.weights[on]), abs=1e-5)
        assert (abs(gradient[~on]) <= 1 + 1e-5).all()
        # The certificate is that of the weights that are returned.
        assert fit.violation <= 1e-6 and lasso.violation(fit.weights, gradient) <= 1e-5
        value = c * (np.logaddexp(0, odds) - y * odds).sum() + abs(fit.weights).sum()
        assert fit.objective == pytest.approx(value, rel=1e-12)
    many = lasso.fit_grid(data.repartition(70), 4, grid)
    for one, other in zip(found, many):
        assert other.weights == pytest.approx(one.weights, abs=1e-9)


def test_lasso_stops_where_rounding_ends(spark):
    rows = [([1e6 * (i % 7), -3.0], float(i % 2)) for i in range(60)]
    data = spark.createDataFrame(rows, "x array<double>, y double")
    fits = lasso.fit_grid(data, 2, [0.01, 1e5])
    assert all(f.passes < 100 and np.isfinite(f.objective) for f in fits)


def test_lasso_step_among_dependent_columns():
    # All values of a category beside the intercept: coordinate descent alone crawls along their common line.
    rng = np.random.default_rng(3)
    x = np.hstack([np.eye(4)[rng.integers(0, 4, 400)], np.eye(9)[rng.integers(0, 9, 400)], np.ones((400, 1))])
    y = (rng.random(400) < 0.8).astype(float)
    w = np.zeros(x.shape[1])
    for passes in range(1, 16):  # noqa: B007
        found = lasso._unpacked(lasso.partial_sums(x, y, w), len(w))
        gradient = 1000 * found[1]
        if lasso.violation(w, gradient) < 1e-6:
            break
        w = w + lasso._solve(w, gradient, 1000 * found[2], 1e-12)
    assert passes < 12


def test_lasso_does_not_crawl_to_its_end():
    # Near the optimum a sweep of descent gains next to nothing, the system among the signs leads on.
    rng, n = np.random.default_rng(2), 3000
    size = rng.exponential(0.1, n)
    groups = [np.eye(k)[rng.integers(0, k, n)] for k in (3, 4, 20)]
    numbers = [size, size * rng.uniform(0.5, 1, n), groups.pop(0) @ np.arange(3) / 3]
    x = np.hstack([np.stack(numbers, axis=1), *groups, np.ones((n, 1))])
    y = (rng.random(n) < 1 / (1 + np.exp(1 - 40 * size))).astype(float)
    w = np.zeros(x.shape[1])
    for passes in range(1, 101):  # noqa: B007
        loss, slope, curve = lasso._unpacked(lasso.partial_sums(x, y, w), len(w))
        value = 1000 * loss + np.abs(w).sum()
        if lasso.violation(w, 1000 * slope) < 1e-6:
            break
        w = w + lasso._solve(w, 1000 * slope, 1000 * curve, 1e-15 * value)
    assert passes < 12


def test_sums_do_not_depend_on_the_order(spark):
    rng = np.random.default_rng(6)
    values = rng.normal(size=(90, 50)) * 10.0 ** rng.integers(-12, 12, (90, 50))

    def total(df):
        def add(parts):
            totals = sums.Totals()
            for part in parts:
                for row in part["v"].to_pylist():
                    totals.add(3, np.array(row))
            if totals.held:
                yield totals.batch()

        return sums.tree_sum(df.mapInArrow(add, sums.SCHEMA), df.rdd.getNumPartitions())

    df = spark.createDataFrame([(v.tolist(),) for v in values], "v array<double>")
    first, other = total(df.repartition(2)), total(df.orderBy(F.rand(4)).repartition(40))
    assert first.keys() == {3} and (first[3] == other[3]).all()
    assert first[3].tolist() == [math.fsum(column) for column in values.T]


def test_network_gradient():
    rng = np.random.default_rng(5)
    sizes, x, y = [3, 4, 2, 1], rng.normal(size=(7, 3)), rng.integers(0, 2, 7).astype(float)
    w = neural.start_weights(sizes, 1)
    _, gradient = neural.loss_and_gradient(w, sizes, x, y, 0.3)
    for j in range(len(w)):
        e = np.zeros_like(w)
        e[j] = 1e-6
        up, down = (neural.loss_and_gradient(w + s * e, sizes, x, y, 0.3)[0] for s in (1, -1))
        assert gradient[j] == pytest.approx((up - down) / 2e-6, abs=1e-6)


def plain_adam(w, sizes, x, y, alpha, batch, seeds):
    mean, square, steps, losses = np.zeros_like(w), np.zeros_like(w), 0, []
    for seed in seeds:
        order, total = np.random.default_rng(seed).permutation(len(y)), 0.0
        for at in range(0, len(y), batch):
            rows = order[at : at + batch]
            loss, gradient = neural.loss_and_gradient(w, sizes, x[rows], y[rows], alpha)
            steps, total = steps + 1, total + loss * len(rows)
            mean = mean * 0.9 + gradient * (1 - 0.9)
            square = square * 0.999 + gradient * gradient * (1 - 0.999)
            rate = 1e-3 * np.sqrt(1 - 0.999**steps) / (1 - 0.9**steps)
            w = w - mean / (np.sqrt(square) + 1e-8) * rate
        losses.append(total / len(y))
    return np.concatenate([w, mean, square]), losses


@pytest.mark.parametrize("hidden", [[6], [9, 5], [100, 50, 25]])
def test_networks_side_by_side_are_those_alone(hidden):
    rng = np.random.default_rng(12)
    x, y, alphas = rng.random((75, 4)), rng.integers(0, 2, 75).astype(float), [0.001, 0.5, 3.0]
    sizes = [4, *hidden, 1]
    starts = [neural.start_weights(sizes, k) for k in range(3)]
    together = neural.AdamRuns([np.concatenate([w, np.zeros(2 * len(w))]) for w in starts], 0, sizes, alphas)
    losses = [together.epoch(x, y, 32, np.random.default_rng(seed)) for seed in (4, 5, 6)]
    for k, (w, alpha) in enumerate(zip(starts, alphas)):
        state, lost = plain_adam(w, sizes, x, y, alpha, 32, (4, 5, 6))
        got = np.concatenate([together.w[k], together.mean[k], together.square[k]])
        assert got == pytest.approx(state, rel=1e-9, abs=1e-12) and [v[k] for v in losses] == pytest.approx(lost, rel=1e-12)


def crossed(spark):
    rng = np.random.default_rng(3)
    x = rng.uniform(-1, 1, size=(400, 2))
    rows = [([float(a), float(b)], int(a * b > 0)) for a, b in x]
    df = spark.createDataFrame(rows, "x array<double>, label int")
    return df.withColumn("features", array_to_vector("x"))


@pytest.mark.parametrize("rows", [4096, 130])
def test_network_learns_what_is_not_linear(spark, rows, tmp_path):
    df = crossed(spark)
    model = neural.ReluNetwork(
        hiddenLayers=[24], alpha=1e-4, batchSize=16, maxIter=150, blockRows=rows, roundEpochs=15
    ).fit(df)
    path = str(tmp_path / "net")
    model.write().overwrite().save(path)
    scored = neural.ReluNetworkModel.load(path).transform(df)
    auc = evaluation.roc_auc(scored.withColumn("m", F.lit("m")), ["m"]).first()["auc"]
    assert auc > 0.9


def test_network_does_not_depend_on_partitions_and_shares_runs(spark):
    df = crossed(spark)
    network = neural.ReluNetwork(hiddenLayers=[6], batchSize=32, blockRows=150, roundEpochs=4)
    points = [{"maxIter": 5}, {"maxIter": 9}, {"maxIter": 5, "alpha": 0.1}]
    first = network.fit_all(df, points)
    again = network.fit_all(df.repartition(5, "label").orderBy(F.rand(1)), points)
    alone = [neural.ReluNetwork(hiddenLayers=[6], batchSize=32, blockRows=150, roundEpochs=4, maxIter=5).fit(df)]
    weights = [m.getOrDefault(m.weights) for m in (*first, *again, *alone)]
    assert weights[:3] == weights[3:6]
    assert weights[0] == weights[6] != weights[1]


def test_polished_weights_are_near_a_minimum(spark):
    df = crossed(spark)
    blocks = neural.row_blocks(df.select("x", F.col("label").cast("double").alias("y")), 100).persist()
    network = neural.ReluNetwork(hiddenLayers=[8], alpha=0.5, batchSize=16, maxIter=30, blockRows=130, roundEpochs=15)
    plain, polished = (n.fit(df) for n in (network, network.copy({network.polish: 60})))
    (before, slope), (after, left) = (
        neural.mean_gradient(blocks, [2, 8, 1], m.getOrDefault(m.weights), 0.5) for m in (plain, polished)
    )
    assert after < before and abs(left).max() < 0.1 * abs(slope).max()


def test_blocks_are_bounded_and_whole(spark):
    rows = [([float(i % 3), 1.0], 0.0) for i in range(700)] + [([float(i), 2.0], 1.0) for i in range(333)]
    df = spark.createDataFrame(rows, "x array<double>, y double")
    first, other = (neural.row_blocks(d, 64).collect() for d in (df.repartition(9), df.coalesce(1)))
    assert sorted(r["n"] for r in first) == [1033 % 64] + [64] * (1033 // 64)
    assert sorted(map(str, first)) == sorted(map(str, other))
    spread, parts = neural.spread_blocks(neural.row_blocks(df, 64), 5)
    assert parts > 1 and spread.count() == parts * len(first) and spread.rdd.getNumPartitions() >= len(first)
    back = [(tuple(r["x"][2 * i : 2 * i + 2]), r["y"][i]) for r in first for i in range(r["n"])]
    assert sorted(back) == sorted((tuple(x), y) for x, y in rows)


def test_gradient_over_blocks_is_that_of_all_rows(spark):
    rng = np.random.default_rng(9)
    x, y, sizes = rng.normal(size=(500, 3)), rng.integers(0, 2, 500).astype(float), [3, 5, 2, 1]
    w = neural.start_weights(sizes, 3)
    df = spark.createDataFrame([(r.tolist(), float(t)) for r, t in zip(x, y)], "x array<double>, y double")
    blocks = neural.row_blocks(df, 7)
    loss, gradient = neural.mean_gradient(blocks, sizes, w, 0.3)
    want = neural.loss_and_gradient(w, sizes, x, y, 0.3)
    assert loss == pytest.approx(want[0], rel=1e-12) and gradient == pytest.approx(want[1], rel=1e-9, abs=1e-14)


def test_scores_are_column_expressions(spark):
    rng = np.random.default_rng(7)
    x, sizes = rng.normal(size=(40, 6)), [6, 9, 5, 3, 1]
    w = neural.start_weights(sizes, 2) * 3
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "i int, x array<double>")
    df = df.withColumn("features", array_to_vector("x"))
    scored = neural.ReluNetworkModel(sizes=sizes, weights=w.tolist()).transform(df)
    assert "Python" not in scored._jdf.queryExecution().executedPlan().toString()
    got = [r["score"] for r in scored.orderBy("i").collect()]
    assert got == pytest.approx(neural.probability(neural.forward(x, neural.unpack(w, sizes))[-1][:, 0]), rel=1e-12)


def test_many_models_are_scored_in_one_pass(spark):
    rng = np.random.default_rng(5)
    rows = spark.createDataFrame([(rng.random(3).tolist(), i % 2) for i in range(50)], "x array<double>, label int")
    rows = rows.withColumn("features", array_to_vector("x")).repartition(60)
    shapes = [[3, 4, 1], [3, 5, 2, 1], [3, 4, 1]]
    models = [
        neural.ReluNetworkModel(sizes=s, weights=neural.start_weights(s, i).tolist()) for i, s in enumerate(shapes)
    ]
    models.insert(1, lasso.LassoModel(weights=[1.0, -2.0, 0.5, 0.1], objective=0.0, violation=0.0))
    scored = training.scores_of(models, rows)
    # One branch for all networks, however many, and one for the other model.
    assert scored._jdf.queryExecution().optimizedPlan().collectLeaves().size() == 2
    found = {}
    for r in scored.collect():
        found.setdefault(r["model"], []).append((r["label"], round(r["score"], 9)))
    assert sorted(found) == [0, 1, 2, 3]
    for i, model in enumerate(models):
        expected = [(r["label"], round(r["score"], 9)) for r in training.with_score(model, rows).collect()]
        assert sorted(found[i]) == sorted(expected)


@pytest.mark.parametrize("model_type", ["lreg", "lreg_wide"])
def test_grid_search_finds_the_signal(spark, model_type):
    df, _, _ = study(spark)
    roles = prep.column_roles(df, ["id", "y"])
    found = training.grid_search(
        df, model_type, roles, "y", ["id"], {"C": [0.001, 1.0, 1.0]}, folds=3, folds_at_once=3
    )
    report = found.report.orderBy("rank").collect()
    assert found.params == {"C": 1.0} and found.mean_auc > 0.8
    assert [r["rank"] for r in report] == [1, 2, 3]
    assert report[0]["mean_auc"] == report[1]["mean_auc"]
    assert report[2]["mean_auc"] == 0.5


def test_models_of_one_type_are_fitted_before_the_next(spark, monkeypatch):
    df, _, _ = study(spark, 200)
    calls, slow = [], [8.0, 0.0]

    def watched(name, plain):
        def fit(*given):
            # The first fold is slow with its first type.
            time.sleep(slow.pop(0) if name == "lreg" and slow else 0.0)
            calls.append(name)
            return plain(*given)

        return fit

    for m in ("lreg", "mlp"):
        monkeypatch.setitem(training.FITTERS, m, watched(m, training.FITTERS[m]))
    grids = {"lreg": {"C": [0.1]}, "mlp": {"hiddenLayers": [[3]], "maxIter": [2]}}
    roles = prep.column_roles(df, ["id", "y"])
    training.search_models(df, grids, roles, "y", ["id"], folds=3, folds_at_once=2)
    # Two folds, one fold, and the models of all rows.
    assert calls == ["lreg", "lreg", "mlp", "mlp", "lreg", "mlp", "lreg", "mlp"]


def test_unknown_model_type(spark):
    df, _, _ = study(spark, 20)
    with pytest.raises(KeyError):
        training.grid_search(df, "tree", {}, "y", ["id"])
    with pytest.raises(KeyError):
        jobs.apply_model(spark, "tree", "d", "nowhere")


def test_shapley_of_a_linear_score_is_exact(spark):
    rng = np.random.default_rng(2)
    x, weights = rng.normal(size=(12, 3)), [2.0, -1.0, 0.5]
    rows = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "id int, x array<double>")
    values = explain.linear_shapley(rows, weights, ["a", "b", "c"], ["id"])
    got = {(r["id"], r["feature"]): r["phi"] for r in values.collect()}
    for i, r in enumerate(x):
        for name, w, v, mean in zip("abc", weights, r, x.mean(axis=0)):
            assert got[i, name] == pytest.approx(w * (v - mean))
    top = explain.top_by_size(explain.shapley_importance(values), "importance", k=2).collect()
    assert [r["feature"] for r in top] == ["a", "b"]


def exact_shapley(f, x):
    """Shapley values of every row with all rows as background, over all coalitions."""
    n, d = x.shape
    value = {}
    for mask in range(1 << d):
        chosen = np.array([mask >> j & 1 for j in range(d)], bool)
        value[mask] = np.array([f(np.where(chosen, row, x)).mean() for row in x])
    phi = np.zeros((n, d))
    for j in range(d):
        for mask in range(1 << d):
            if not mask >> j & 1:
                k = bin(mask).count("1")
                weight = math.factorial(k) * math.factorial(d - k - 1) / math.factorial(d)
                phi[:, j] += weight * (value[mask | 1 << j] - value[mask])
    return phi


@pytest.mark.parametrize("d", [1, 2, 5])
def test_kernel_shapley_against_all_coalitions(spark, d):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(30, d))

    def f(rows):
        return np.maximum(rows[:, 0], 0) * (rows[:, -1] + 1) + rows.sum(1)

    def predict(df):
        total = F.aggregate("x", F.lit(0.0), lambda t, v: t + v)
        return df.withColumn("f", F.greatest(F.col("x")[0], F.lit(0.0)) * (F.col("x")[d - 1] + 1) + total)

    rows = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "id int, x array<double>")
    names = [f"v{j}" for j in range(d)]
    values = explain.kernel_shapley(rows.repartition(3), predict, names, ["id"], pairs=600).collect()
    assert len(values) == 30 * d
    want = exact_shapley(f, x)
    got = {(r["id"], r["feature"]): r for r in values}
    off = np.array([[got[i, n]["phi"] - want[i, j] for j, n in enumerate(names)] for i in range(30)])
    se = np.array([[got[i, n]["se"] for n in names] for i in range(30)])
    assert np.abs(off.sum(1)).max() < 1e-9  # the values of a row add up exactly
    assert (np.abs(off) <= 4.5 * se + 1e-9).all()
    assert np.abs(off).mean() < 0.1
    if d == 1:
        assert np.abs(off).max() < 1e-9


def test_classes_of_a_network_come_from_products_of_matrices(spark):
    rng = np.random.default_rng(9)
    sizes = [5, 20, 10, 1]
    model = neural.ReluNetworkModel(sizes=sizes, weights=(neural.start_weights(sizes, 4) * 3).tolist())
    rows = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(rng.normal(size=(200, 5)))], "i int, x array<double>")
    found = explain.class_predictor(model)(rows)
    # A column expression takes the products of very many mixed rows one by one.
    assert "ArrowEvalPython" in found._jdf.queryExecution().executedPlan().toString()
    want = model.transform(rows.withColumn("features", array_to_vector("x")))
    classes = [r["f"] for r in found.orderBy("i").collect()]
    assert classes == [r["prediction"] for r in want.orderBy("i").collect()] and len(set(classes)) == 2
    assert explain.class_predictor(model)(rows.limit(0)).count() == 0


def test_shapley_scores_every_coalition(spark):
    rows = spark.createDataFrame(
        [(1, [1.0, 2.0, 0.0]), (1, [1.0, 2.0, 0.0]), (2, [3.0, None, 1.0]), (None, [5.0, 8.0, 1.0])], "id long, x array<double>"
    )
    weights, names, seen = [0.5, -0.25, 2.0], ["a", "b", "c"], []

    def predict(df):
        seen.append(df.count())
        return explain.linear_predictor(weights)(df)

    got = explain.coalition_shapley(rows, predict, names, ["id"]).collect()
    # The model is asked for all eight coalitions of the four rows.
    assert seen == [32]
    want = explain.linear_shapley(rows, weights, names, ["id"]).collect()
    order = lambda r: (str(r["id"]), r["feature"], r["phi"] or 0.0)
    for g, w in zip(sorted(got, key=order), sorted(want, key=order), strict=True):
        assert (g["id"], g["feature"]) == (w["id"], w["feature"])
        assert g["phi"] == (None if w["phi"] is None else pytest.approx(w["phi"], abs=1e-12))


def test_shapley_queries_ask_the_model(spark, tmp_path, monkeypatch):
    from bindings import learning

    spark.createDataFrame([(i, "a\nb" * i, 10 * i) for i in range(5)], "doc_id long, text string, n_chars long").write.parquet(
        f"{tmp_path}/documents.parquet"
    )
    spark.createDataFrame([(i, i % 2) for i in range(5)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    asked, made = [], explain.linear_predictor

    def watched(weights):
        def predict(df):
            asked.append(df.count())
            return made(weights)(df)

        return predict

    monkeypatch.setattr(explain, "linear_predictor", watched)
    assert learning.shapley_linear(spark, str(tmp_path)).count() == 15
    assert learning.shapley_importance(spark, str(tmp_path)).count() == 3
    assert asked == [40, 40]


def test_kernel_shapley_of_odd_rows(spark):
    empty = spark.createDataFrame([], "id int, x array<double>")
    linear = explain.linear_predictor([1.0, 2.0])
    assert explain.kernel_shapley(empty, linear, ["a", "b"], ["id"]).count() == 0
    same = spark.createDataFrame([(None, [1.0, 2.0])] * 5 + [(1, [2.0, 2.0])], "id int, x array<double>")
    found = {(r["id"], r["feature"]): r for r in explain.kernel_shapley(same, linear, ["a", "b"], ["id"]).collect()}
    assert len(found) == 4
    assert found[None, "a"]["phi"] + found[None, "b"]["phi"] == pytest.approx(-1 / 6)


def test_train_and_evaluate_jobs(spark, tmp_path):
    df, _, _ = study(spark, 300)
    data = df.select(F.col("id").cast("string").alias("patient_id"), "a", "b", "t", F.col("y").alias("death_2years"))
    grids = {
        "lreg": {"C": [0.1, 1.0]},
        "mlp": {"hiddenLayers": [[8]], "alpha": [0.01], "batchSize": [32], "maxIter": [60]},
    }
    root = str(tmp_path)
    report = jobs.train_models({"full_data": lambda: data}, "full_data", root, grids=grids, folds=2)
    assert report.count() == 3
    results = jobs.evaluate_models(spark, "full_data", root)
    wide = jobs.results_report(spark, ["full_data"], root).first()
    assert wide["LASSO_AUC"] > 0.7 and wide["MLP_AUC"] > 0.6
    top = results["top_features"].filter("model = 'LASSO'").collect()
    assert max(top, key=lambda r: abs(r["value"]))["feature"] == "a"
    assert results["roc"].select("model").distinct().count() == 2


def test_image_job(spark):
    rng = np.random.default_rng(1)
    metadata = spark.createDataFrame(
        [("p1", "SEG", "p1/seg", 1), ("p1", "CT", "p1/ct", 2), ("p2", "SEG", "p2/seg", 3),
         ("p3", "SEG", "p3/seg", 4), ("p3", "CT", "p3/ct", 5)],
        ["Subject ID", "Modality", "File Location", "at"],
    )
    frames = []
    for p in ("p1", "p2", "p3"):
        for name in ("1-1", "1-2", "1-10", "1-3"):
            pixels = [int(v) for v in rng.integers(0, 1000, 36)]
            frames.append((f"dataset1/{p}/ct", name, 0, 6, 6, pixels))
        for file in ("1-1", "1-2"):
            for frame in range(4):
                mask = [int(v) for v in rng.random(36) < 0.4]
                frames.append((f"dataset1/{p}/seg", file, frame, 6, 6, mask))
    decoded = spark.createDataFrame(
        frames, "path string, file_name string, frame int, height int, width int, pixels array<int>"
    )
    labels = spark.createDataFrame([("p1", 1), ("p3", None)], "patient_id string, death_2years int")
    rows = jobs.image_features({"dataset1": metadata}, decoded, labels, ["at"]).collect()
    assert [(r["patient_id"], r["death_2years"]) for r in rows] == [("p1", 1)]
    first = [f for f in frames if f[0] == "dataset1/p1/seg" and f[1] == "1-1"]
    assert rows[0]["volume"] == sum(sum(f[5]) for f in first)
    assert None not in tuple(rows[0])


def test_image_job_decodes_each_frame_once(spark):
    metadata = spark.createDataFrame(
        [("p1", "SEG", "p1/seg", 1), ("p1", "CT", "p1/ct", 2)], ["Subject ID", "Modality", "File Location", "at"]
    )
    cells = np.random.default_rng(2).integers(0, 2, (8, 36)).tolist()
    frames = [("d/p1/ct", f"1-{k}", 0, 6, 6, cells[k]) for k in range(4)]
    frames += [("d/p1/seg", "1-1", k - 4, 6, 6, cells[k]) for k in range(4, 8)]
    schema = "path string, file_name string, frame int, height int, width int, pixels array<int>"
    seen = spark.sparkContext.accumulator(0)

    def decode(parts):
        for part in parts:
            seen.add(part.num_rows)
            yield part

    decoded = spark.createDataFrame(frames, schema).mapInArrow(decode, schema)
    labels = spark.createDataFrame([("p1", 1)], "patient_id string, death_2years int")
    rows = jobs.image_features({"d": metadata}, decoded, labels, ["at"]).collect()
    assert rows[0]["volume"] == sum(map(sum, cells[4:])) and seen.value == len(frames)
