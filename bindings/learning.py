"""Preparation, training, evaluation and explanation on documents and labels."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortline.functions.codes import LASSO_GRID, MLP_GRID
from cohortline.operators import assemble, evaluation, explain, neural, prep, splitting, training, wide
from cohortline.operators.lasso import Lasso
from cohortline.plans import jobs
from cohortline.plans.durable import freeze, new_path
from cohortline.sources import tables
from cohortline.sources.metrics import read_metrics, write_metrics

BY = ["dataset", "model"]
# Fixed weights of a linear score.
WEIGHTS = {"n_chars": 0.5, "n_lines": -0.25, "toxic": 2.0}


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _documents(spark: SparkSession, sf: str) -> DataFrame:
    """Features of whole documents, with gaps."""
    return _table(spark, sf, "documents").select(
        "doc_id",
        F.when(F.col("n_chars") % 5 != 0, F.col("n_chars")).alias("n_chars"),
        (F.size(F.split("text", "\n")) - 1).alias("n_lines"),
        F.lit(7).alias("constant"),
        F.nullif((F.col("n_chars") % 4).cast("int"), F.lit(3)).alias("overall_stage"),
        F.when(F.col("n_chars") % 3 != 0, F.col("lang")).alias("lang"),
        F.col("source"),
    )


def _study(spark: SparkSession, sf: str) -> DataFrame:
    labels = _table(spark, sf, "labels").select("doc_id", F.col("quality").alias("death_2years"))
    return assemble.join_label(_documents(spark, sf), labels, "doc_id", "death_2years")


def stratified_split(spark: SparkSession, sf: str) -> DataFrame:
    return splitting.stratified_split(_table(spark, sf, "labels"), "quality", ["doc_id"])


def stratified_folds(spark: SparkSession, sf: str) -> DataFrame:
    train = stratified_split(spark, sf).filter(F.col("split") == "train")
    return splitting.stratified_folds(train, "quality", ["doc_id"]).select(
        "doc_id", "quality", "fold"
    )


def impute_mode(spark: SparkSession, sf: str) -> DataFrame:
    rows = _documents(spark, sf).select("doc_id", "overall_stage", "lang")
    return prep.impute_mode(rows, ["overall_stage"], ["lang"]).withColumn(
        "overall_stage", F.col("overall_stage").cast("int")
    )


def impute_median(spark: SparkSession, sf: str) -> DataFrame:
    return prep.impute_median(_documents(spark, sf).select("doc_id", "n_chars"), ["n_chars"])


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


def minmax_scale(spark: SparkSession, sf: str) -> DataFrame:
    rows = _documents(spark, sf).select("doc_id", "n_chars", "constant", "source")
    scaled = prep.scale_minmax(rows, rows.filter(F.col("source") != "src1"), ["n_chars", "constant"])
    return _rounded(scaled.drop("source"), "n_chars", "constant")


def one_hot(spark: SparkSession, sf: str) -> DataFrame:
    rows = _documents(spark, sf).select("doc_id", "lang", "source")
    return prep.one_hot(rows, rows.filter(F.col("source") != "src1"), ["lang", "source"])


def wide_categories(spark: SparkSession, sf: str) -> DataFrame:
    """Places and values of sparse vectors of orders: customers and days by frequency, and an order's price."""
    orders = _table(spark, sf, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 7 != 0, F.col("o_custkey").cast("string")).alias("customer"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"),
        F.col("o_totalprice").alias("price"),
        "o_orderstatus",
    )
    seen = orders.filter(F.col("o_orderstatus") != "F")
    roles = {"numeric": ["price"], "nominal": ["customer", "day", "o_orderstatus"]}
    ready = wide.fit_wide(seen, roles, min_frequency=4, max_categories=900).transform(orders)
    # The parts of a sparse vector as they are stored.
    parts = F.from_json(F.to_json(F.struct("features")), "features struct<indices: array<int>, values: array<double>>")
    cells = F.explode(F.arrays_zip(parts["features"]["indices"].alias("place"), parts["features"]["values"].alias("value")))
    return ready.select("o_orderkey", cells.alias("c")).select(
        "o_orderkey", F.col("c.place").alias("place"), F.round("c.value", 6).alias("value")
    )


def _long(prepared: DataFrame, key: str) -> DataFrame:
    names = F.array(*[F.lit(n) for n in prep.vector_names(prepared)])
    pairs = F.arrays_zip(names.alias("feature"), vector_to_array("features").alias("value"))
    cells = prepared.select(key, F.explode(pairs).alias("c"))
    return cells.select(
        key, F.col("c.feature").alias("feature"), F.round("c.value", 6).alias("value")
    )


def prep_mixed(spark: SparkSession, sf: str) -> DataFrame:
    rows = _documents(spark, sf)
    roles = prep.column_roles(rows, ["doc_id"])
    return _long(prep.TabularPrep(**roles).fit(rows).transform(rows), "doc_id")


def prep_numeric(spark: SparkSession, sf: str) -> DataFrame:
    vectors = _table(spark, sf, "embeddings")
    rows = vectors.select(
        "vec_id",
        *[
            F.when(F.col("embedding")[i] > -0.2, F.col("embedding")[i].cast("double")).alias(f"e{i}")
            for i in range(64)
        ],
    )
    roles = prep.column_roles(rows, ["vec_id"], all_numeric=True)
    return _long(prep.TabularPrep(**roles).fit(rows).transform(rows), "vec_id")


def _scored(spark: SparkSession, sf: str, dataset: Column | None = None) -> DataFrame:
    """Two fixed scores with many ties."""
    rows = _table(spark, sf, "documents").select("doc_id", "n_chars").join(
        _table(spark, sf, "labels").select("doc_id", F.col("quality").alias("label")), "doc_id"
    )
    scores = F.array(
        F.struct(F.lit("LASSO").alias("model"), (F.col("n_chars") % 50 / 50).alias("score")),
        F.struct(F.lit("MLP").alias("model"), (F.col("n_chars") % 7 / 7).alias("score")),
    )
    each = rows.select("doc_id", "label", F.explode(scores).alias("s"))
    return each.select(
        (F.lit("documents") if dataset is None else dataset).alias("dataset"),
        "s.model",
        "label",
        "s.score",
        (F.col("s.score") >= 0.5).cast("int").alias("prediction"),
    )


def confusion_metrics(spark: SparkSession, sf: str) -> DataFrame:
    counts = evaluation.confusion(_scored(spark, sf), BY)
    return _rounded(evaluation.class_metrics(counts, BY), "balanced_accuracy", "f1")


def roc_auc(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(evaluation.roc_auc(_scored(spark, sf), BY), "auc")


def roc_curve(spark: SparkSession, sf: str) -> DataFrame:
    chart = evaluation.roc_chart(_scored(spark, sf), BY)
    return _rounded(chart, "fpr", "tpr", "auc").select(*BY, "fpr", "tpr", "auc")


def metrics_pivot(spark: SparkSession, sf: str) -> DataFrame:
    metrics = evaluation.metrics_table(_scored(spark, sf), BY)
    pairs = [(m, x) for m in ("LASSO", "MLP") for x in evaluation.METRICS]
    wide = assemble.pivot_metrics(metrics, pairs)
    return wide.toDF(*[c.lower().replace(" ", "_") for c in wide.columns])


def metrics_files(spark: SparkSession, sf: str) -> DataFrame:
    """Metrics of five datasets through a file with two header rows each, stacked and pivoted."""
    root = new_path(spark, "metrics")
    pairs = [(m, x) for m in ("LASSO", "MLP") for x in evaluation.METRICS]
    scored = _scored(spark, sf, F.concat(F.lit("part "), (F.col("doc_id") % 5).cast("string")))
    metrics = freeze(evaluation.metrics_table(scored, BY))
    names = [f"part {i}" for i in range(5)]
    for name in names:
        write_metrics(metrics.filter(F.col("dataset") == name), f"{root}/{name}", pairs)
    wide = assemble.pivot_metrics(read_metrics(spark, [f"{root}/{name}" for name in names]), pairs)
    return wide.toDF(*[c.lower().replace(" ", "_") for c in wide.columns])


def metrics_join(spark: SparkSession, sf: str) -> DataFrame:
    """The two models' metrics side by side, by a natural join."""
    metrics = freeze(evaluation.metrics_table(_scored(spark, sf), BY))
    sides = [
        metrics.filter(F.col("model") == m).select(
            "dataset", "metric", F.col("value").alias(m.lower())
        )
        for m in ("LASSO", "MLP")
    ]
    return assemble.join_model_metrics(*sides)


def topk_coefs(spark: SparkSession, sf: str) -> DataFrame:
    rows = _table(spark, sf, "embeddings").select(
        "label", *[F.col("embedding")[i].cast("double").alias(f"e{i:02d}") for i in range(64)]
    )
    table = explain.label_covariances(rows, [c for c in rows.columns if c != "label"], "label")
    return _rounded(explain.top_by_size(table, "coefficient"), "coefficient")


def _explained(spark: SparkSession, sf: str) -> DataFrame:
    documents = _table(spark, sf, "documents").select(
        "doc_id", "n_chars", (F.size(F.split("text", "\n")) - 1).alias("n_lines")
    )
    rows = assemble.join_label(documents, _table(spark, sf, "labels"), "doc_id", "toxic")
    return rows.select("doc_id", F.array(*[F.col(c).cast("double") for c in WEIGHTS]).alias("x"))


def _linear_shapley(spark: SparkSession, sf: str) -> DataFrame:
    """Every coalition of every row, scored by the linear model."""
    predict = explain.linear_predictor(list(WEIGHTS.values()))
    return explain.coalition_shapley(_explained(spark, sf), predict, list(WEIGHTS), ["doc_id"])


def shapley_kernel(spark: SparkSession, sf: str) -> DataFrame:
    """Attributions of a score that is not linear: their sums, and how many have a standard error."""

    def predict(rows: DataFrame) -> DataFrame:
        x = F.col("x")
        return rows.withColumn("f", F.greatest(x[0] / 100 - x[1], F.lit(0.0)) * (1 + x[2]) + x[1])

    values = explain.kernel_shapley(_explained(spark, sf), predict, list(WEIGHTS), ["doc_id"], pairs=16)
    return _rounded(values.groupBy("doc_id").agg(F.sum("phi").alias("total"), F.count("se").alias("n_se")), "total")


def shapley_linear(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(_linear_shapley(spark, sf), "phi")


def shapley_importance(spark: SparkSession, sf: str) -> DataFrame:
    ranked = explain.top_by_size(
        explain.shapley_importance(_linear_shapley(spark, sf)), "importance"
    )
    return _rounded(ranked, "importance")


def _flat(report: DataFrame) -> DataFrame:
    """Parameters as sorted text."""
    entries = F.transform(
        F.array_sort(F.map_entries("params")), lambda e: F.concat(e["key"], F.lit("="), e["value"])
    )
    return report.withColumn("params", F.array_join(entries, ", "))


def lasso_cv(spark: SparkSession, sf: str) -> DataFrame:
    rows = _study(spark, sf)
    roles = prep.column_roles(rows, ["doc_id", "death_2years"])
    found = training.grid_search(rows, "lreg", roles, "death_2years", ["doc_id"], LASSO_GRID, folds_at_once=5)
    return _flat(found.report)


def mlp_cv(spark: SparkSession, sf: str) -> DataFrame:
    rows = _study(spark, sf)
    roles = prep.column_roles(rows, ["doc_id", "death_2years"])
    found = training.grid_search(
        rows, "mlp", roles, "death_2years", ["doc_id"], MLP_GRID, folds_at_once=5
    )
    return _flat(found.report)


def _binary_study(spark: SparkSession, sf: str) -> DataFrame:
    """One 0/1 feature, for which the L1 fit has a closed form."""
    return _table(spark, sf, "labels").select("doc_id", "toxic", F.col("quality").alias("death_2years"))


def lasso_binary_cv(spark: SparkSession, sf: str) -> DataFrame:
    """Report of all loss weights, and the weights of the refitted best model."""
    rows = _binary_study(spark, sf)
    roles = prep.column_roles(rows, ["doc_id", "death_2years"])
    found = training.grid_search(rows, "lreg", roles, "death_2years", ["doc_id"], LASSO_GRID, folds_at_once=5)
    slope, intercept = found.model.stages[-1].getOrDefault("weights")
    return found.report.select(
        F.col("params")["C"].cast("double").alias("c"),
        F.round("mean_auc", 6).alias("mean_auc"),
        "rank",
        F.round(F.lit(slope), 3).alias("best_slope"),
        F.round(F.lit(intercept), 3).alias("best_intercept"),
    )


def lasso_certificate(spark: SparkSession, sf: str) -> DataFrame:
    """Weights, objective and optimality bound over all rows, for every loss weight."""
    rows = _binary_study(spark, sf).select(
        array_to_vector(F.array(F.col("toxic").cast("double"))).alias("features"), F.col("death_2years").alias("label")
    )
    rows = freeze(rows)
    fits = Lasso(labelCol="label").fit_all(rows, LASSO_GRID["C"])
    get = lambda fit, name: fit.getOrDefault(fit.getParam(name))
    found = [(c, *get(f, "weights"), get(f, "objective"), get(f, "violation")) for c, f in zip(LASSO_GRID["C"], fits)]
    table = spark.createDataFrame(found, "c double, slope double, intercept double, objective double, violation double")
    digits = {c: F.round(c, 4) for c in ("slope", "intercept", "objective", "violation")}
    return table.withColumns(digits)


def fold_statistics(spark: SparkSession, sf: str) -> DataFrame:
    """What the preparation of each fold was fitted to: rows outside of the fold only."""
    rows = _study(spark, sf)
    roles = prep.column_roles(rows, ["doc_id", "death_2years"])
    found = training.fold_statistics(rows, roles, "death_2years", ["doc_id"])
    return found.withColumns({c: F.round(c, 6) for c in ("middle", "low", "high")})


# A fixed network: its inputs, and its weights by a rule.
NET_SIZES = [3, 4, 2, 1]


def _fixed_weights(sizes: list[int]) -> list[float]:
    count = sum(a * b + b for a, b in zip(sizes, sizes[1:]))
    return [((7 * k) % 11 - 5) / 10 for k in range(count)]


def _net_inputs(spark: SparkSession, sf: str) -> DataFrame:
    rows = assemble.join_label(
        _documents(spark, sf).select("doc_id", F.coalesce("n_chars", F.lit(0)).alias("n_chars"), "n_lines"),
        _table(spark, sf, "labels"), "doc_id", "quality",
    )
    numbers = [F.col("n_chars") / 1000, F.col("n_lines") / 10, F.col("n_chars") % 3 - 1]
    return rows.select("doc_id", F.array(*[n.cast("double") for n in numbers]).alias("x"), F.col("quality").alias("label"))


def network_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Scores of a network with given weights."""
    rows = _net_inputs(spark, sf).withColumn("features", array_to_vector("x"))
    model = neural.ReluNetworkModel(sizes=NET_SIZES, weights=_fixed_weights(NET_SIZES))
    scored = training.with_score(model, rows)
    return _rounded(scored.select("doc_id", "score", "prediction"), "score")


def network_gradient(spark: SparkSession, sf: str) -> DataFrame:
    """Loss and gradient of a network with given weights over the blocks of all rows."""
    rows = _net_inputs(spark, sf).select("x", F.col("label").cast("double").alias("y"))
    blocks = freeze(neural.row_blocks(rows, 64))
    loss, gradient = neural.mean_gradient(blocks, NET_SIZES, _fixed_weights(NET_SIZES), 0.5)
    found = [(i, float(v)) for i, v in enumerate([loss, *gradient])]
    return _rounded(spark.createDataFrame(found, "at int, value double"), "value")


def network_job(spark: SparkSession, sf: str) -> DataFrame:
    """Save a network with given weights behind a fitted preparation, load it, score and evaluate the test rows."""
    root = new_path(spark, "study")
    rows = assemble.join_label(
        _documents(spark, sf).select("doc_id", "n_chars", "n_lines"),
        _table(spark, sf, "labels").withColumnRenamed("quality", "death_2years"), "doc_id", "death_2years",
    )
    tables.write_split(splitting.stratified_split(rows, "death_2years", ["doc_id"]), f"{root}/split/documents")
    train = tables.read_split(spark, f"{root}/split/documents", "train")
    sizes = [2, 3, 1]
    network = neural.ReluNetworkModel(sizes=sizes, weights=_fixed_weights(sizes))
    model = PipelineModel([prep.TabularPrep(numeric=["n_chars", "n_lines"]).fit(train), network])
    training.save_model(model, root, "mlp", "documents")
    found = jobs.evaluate_models(spark, "documents", root, key="doc_id", model_types=("mlp",))
    return found["metrics"]


def lasso_job(spark: SparkSession, sf: str) -> DataFrame:
    """Split, tune, save, load, score and explain the L1 model of one feature."""
    root = new_path(spark, "study")
    rows = {"documents": lambda: _binary_study(spark, sf)}
    jobs.train_models(rows, "documents", root, key="doc_id", grids={"lreg": LASSO_GRID}, folds_at_once=5)
    found = jobs.evaluate_models(spark, "documents", root, key="doc_id", model_types=("lreg",))
    metrics = found["metrics"].select("dataset", "model", F.col("metric").alias("item"), "value")
    top = found["top_features"].select(
        "dataset", "model", F.col("feature").alias("item"), F.round("value", 3).alias("value")
    )
    return metrics.unionByName(top)


def _trained(spark: SparkSession, sf: str) -> str:
    root = new_path(spark, "study")
    jobs.train_models(
        {"documents": lambda: _study(spark, sf)},
        "documents",
        root,
        key="doc_id",
        folds_at_once=5,
    )
    return root


def train_score_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """Split, tune, save, load, score and report both models of a dataset."""
    root = _trained(spark, sf)
    jobs.evaluate_models(spark, "documents", root, key="doc_id")
    wide = jobs.results_report(spark, ["documents"], root)
    return wide.toDF(*[c.lower().replace(" ", "_") for c in wide.columns])


def train_top_features(spark: SparkSession, sf: str) -> DataFrame:
    """The ten leading features of both trained models."""
    root = _trained(spark, sf)
    tables = jobs.evaluate_models(spark, "documents", root, key="doc_id")
    return tables["top_features"]


QUERIES = {
    "stratified_split": stratified_split,
    "stratified_folds": stratified_folds,
    "impute_mode": impute_mode,
    "impute_median": impute_median,
    "minmax_scale": minmax_scale,
    "one_hot": one_hot,
    "wide_categories": wide_categories,
    "prep_mixed": prep_mixed,
    "prep_numeric": prep_numeric,
    "confusion_metrics": confusion_metrics,
    "roc_auc": roc_auc,
    "roc_curve": roc_curve,
    "metrics_pivot": metrics_pivot,
    "metrics_join": metrics_join,
    "metrics_files": metrics_files,
    "topk_coefs": topk_coefs,
    "shapley_linear": shapley_linear,
    "shapley_kernel": shapley_kernel,
    "shapley_importance": shapley_importance,
    "lasso_cv": lasso_cv,
    "mlp_cv": mlp_cv,
    "lasso_binary_cv": lasso_binary_cv,
    "lasso_job": lasso_job,
    "lasso_certificate": lasso_certificate,
    "fold_statistics": fold_statistics,
    "network_scores": network_scores,
    "network_gradient": network_gradient,
    "network_job": network_job,
    "train_score_metrics": train_score_metrics,
    "train_top_features": train_top_features,
}

_SPLIT = """
per_class AS (SELECT quality, count(*) AS n FROM labels GROUP BY ALL),
whole AS (SELECT CAST(sum(n) AS BIGINT) AS total, CAST(sum(n) - ceil(sum(n) * 0.2) AS BIGINT) AS train FROM per_class),
dealt AS (SELECT quality, n, CAST(n * train AS DOUBLE) / total AS exact, floor(CAST(n * train AS DOUBLE) / total) AS low,
    train FROM per_class, whole),
quota AS (SELECT quality, n - low - CASE WHEN row_number() OVER (ORDER BY low - exact, quality)
    <= train - sum(low) OVER () THEN 1 ELSE 0 END AS q FROM dealt),
split AS (SELECT doc_id, quality, toxic, CASE WHEN row_number() OVER (PARTITION BY quality ORDER BY md5('42|' || doc_id))
    <= q THEN 'test' ELSE 'train' END AS split FROM labels JOIN quota USING (quality))
"""
_DOCS = """
docs AS (
    SELECT doc_id, CASE WHEN n_chars % 5 <> 0 THEN n_chars END AS n_chars,
        length(text) - length(replace(text, chr(10), '')) AS n_lines, 7 AS constant,
        CAST(nullif(n_chars % 4, 3) AS INTEGER) AS overall_stage,
        CASE WHEN n_chars % 3 <> 0 THEN lang END AS lang, source
    FROM documents)
"""
_SCORED = """
scored AS (
    SELECT 'documents' AS dataset, model, label, score, CASE WHEN score >= 0.5 THEN 1 ELSE 0 END AS prediction
    FROM (SELECT quality AS label, unnest(['LASSO', 'MLP']) AS model,
            unnest([CAST(n_chars % 50 AS DOUBLE) / 50, CAST(n_chars % 7 AS DOUBLE) / 7]) AS score
          FROM documents JOIN labels USING (doc_id)))
"""
_CLASS = """
cls AS (
    SELECT dataset, model, count(*) FILTER (label = 1 AND prediction = 1) AS tp,
        count(*) FILTER (label = 0 AND prediction = 1) AS fp, count(*) FILTER (label = 1 AND prediction = 0) AS fn,
        count(*) FILTER (label = 0 AND prediction = 0) AS tn FROM scored GROUP BY ALL),
met AS (SELECT *, (tp / (tp + fn) + tn / (tn + fp)) / 2 AS balanced_accuracy, 2 * tp / (2 * tp + fp + fn) AS f1 FROM cls)
"""
_AUC = """
area AS (
    SELECT a.dataset, a.model, sum(CASE WHEN a.score > b.score THEN 1.0 WHEN a.score = b.score THEN 0.5 ELSE 0 END)
        / count(*) AS auc
    FROM scored a JOIN scored b USING (dataset, model) WHERE a.label = 1 AND b.label = 0 GROUP BY ALL)
"""
_METRICS = f"""{_SCORED}, {_CLASS}, {_AUC},
long AS (
    SELECT dataset, model, unnest(['Weighted Accuracy', 'AUC', 'F1 Score']) AS metric,
        unnest([round_even(balanced_accuracy, 2), round_even(auc, 2), round_even(f1, 2)]) AS value
    FROM met JOIN area USING (dataset, model))
"""


def _pivot(model: str, metric: str) -> str:
    name = f"{model}_{metric}".lower().replace(" ", "_")
    return f"max(value) FILTER (model = '{model}' AND metric = '{metric}') AS {name}"


_CURVE = """
cnt AS (SELECT dataset, model, score, count(*) FILTER (label = 1) AS pos, count(*) FILTER (label = 0) AS neg
    FROM scored GROUP BY ALL),
run AS (SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, lead(pos) OVER w AS np, lead(neg) OVER w AS nn,
    row_number() OVER w AS k FROM cnt WINDOW w AS (PARTITION BY dataset, model ORDER BY score DESC)),
tot AS (SELECT dataset, model, sum(pos) AS p, sum(neg) AS n FROM cnt GROUP BY ALL),
pts AS (
    SELECT dataset, model, 0 AS k, 0.0 AS fpr, 0.0 AS tpr FROM tot
    UNION ALL SELECT dataset, model, k, CAST(fp AS DOUBLE) / n, CAST(tp AS DOUBLE) / p FROM run JOIN tot USING (dataset, model)
    WHERE np IS NULL OR k = 1 OR np <> pos OR nn <> neg)
"""


# The L1 fit of one 0/1 feature ``x`` and a penalised intercept, for each group ``k``
# of ``fit_rows`` and each C: every pair of signs (or zeros) of the two weights fixes
# the chance in both halves, and the feasible pair with the least objective is the fit.
_CLOSED_FORM = f"""
grid AS (SELECT unnest({LASSO_GRID["C"]}) AS c, unnest(range(1, {len(LASSO_GRID["C"]) + 1})) AS i),
cells AS (SELECT k, CAST(sum(1 - x) AS DOUBLE) AS n0, CAST(sum((1 - x) * y) AS DOUBLE) AS p0,
    CAST(sum(x) AS DOUBLE) AS n1, CAST(sum(x * y) AS DOUBLE) AS p1 FROM fit_rows GROUP BY k),
signs AS (SELECT * FROM (SELECT unnest([-1, 0, 1]) AS sw), (SELECT unnest([-1, 0, 1]) AS sb)),
chance AS (SELECT *,
    CASE WHEN sw <> 0 THEN (p1 - sw / c) / n1 WHEN sb <> 0 THEN (p0 + p1 - sb / c) / (n0 + n1) ELSE 0.5 END AS q1,
    CASE WHEN sb = 0 THEN 0.5 WHEN sw <> 0 THEN (p0 - (sb - sw) / c) / n0 ELSE (p0 + p1 - sb / c) / (n0 + n1) END AS q0
    FROM cells, grid, signs),
found AS (SELECT *, ln(q0 / (1 - q0)) AS b, CASE WHEN sw = 0 THEN 0 ELSE ln(q1 / (1 - q1)) - ln(q0 / (1 - q0)) END AS w
    FROM chance WHERE q0 > 0 AND q0 < 1 AND q1 > 0 AND q1 < 1),
fits AS (SELECT k, c, i, arg_min(w, cost) AS w, arg_min(b, cost) AS b
    FROM (SELECT *, abs(w) + abs(b) + c * (n0 * ln(1 + exp(b)) - p0 * b + n1 * ln(1 + exp(b + w)) - p1 * (b + w)) AS cost
          FROM found WHERE sign(w) = sw AND sign(b) = sb)
    GROUP BY k, c, i)
"""


def _folds(rows: str) -> str:
    """``marked``: the rows with x, y and their fold of five."""
    return f"""
dealt_pos AS (SELECT y, (row_number() OVER (ORDER BY y) - 1) % 5 AS fold FROM {rows}),
fold_size AS (SELECT y, fold, count(*) AS n FROM dealt_pos GROUP BY ALL),
stops AS (SELECT y, fold, sum(n) OVER (PARTITION BY y ORDER BY fold) AS stop FROM fold_size),
placed AS (SELECT *, row_number() OVER (PARTITION BY y ORDER BY md5('42|' || doc_id)) AS r FROM {rows}),
marked AS (SELECT x, y, CAST((SELECT min(fold) FROM stops s WHERE s.y = placed.y AND s.stop >= r) AS INTEGER) AS fold
    FROM placed),
fit_rows AS (
    SELECT f.k, x, y FROM marked, (SELECT unnest(range(0, 5)) AS k) f WHERE fold <> k
    UNION ALL SELECT 5 AS k, x, y FROM marked),
{_CLOSED_FORM},
held AS (SELECT fold AS k, avg(x) FILTER (y = 1) AS hit, avg(x) FILTER (y = 0) AS miss FROM marked GROUP BY fold),
means AS (SELECT c, i, avg(0.5 + sign(w) * (hit - miss) / 2) AS mean_auc FROM fits JOIN held USING (k) GROUP BY c, i),
ranked_c AS (SELECT c, mean_auc, row_number() OVER (ORDER BY round(mean_auc, 9) DESC, i) AS rank FROM means),
final AS (SELECT c, w, b FROM fits JOIN ranked_c USING (c) WHERE k = 5 AND rank = 1)
"""


def _shapley() -> str:
    parts = [
        f"SELECT doc_id, '{n}' AS feature, {w} * ({n} - (SELECT avg({n}) FROM explained)) AS phi FROM explained"
        for n, w in WEIGHTS.items()
    ]
    return f"""
explained AS (
    SELECT doc_id, n_chars, length(text) - length(replace(text, chr(10), '')) AS n_lines, toxic
    FROM documents JOIN labels USING (doc_id)),
phis AS ({" UNION ALL ".join(parts)})
"""


def _network(sizes: list[int], inputs: list[str], rows: str) -> tuple[str, str]:
    """CTEs ``layer0 ..`` of the fixed network over ``rows``, and the column with its log-odds."""
    flat, at, names = _fixed_weights(sizes), 0, inputs
    steps = [f"layer0 AS (SELECT * FROM {rows})"]
    for i, (fan_in, fan_out) in enumerate(zip(sizes, sizes[1:])):
        bias = at + fan_in * fan_out
        sums = [
            " + ".join([f"({flat[bias + j]})", *[f"{n} * ({flat[at + k * fan_out + j]})" for k, n in enumerate(names)]])
            for j in range(fan_out)
        ]
        last = i == len(sizes) - 2
        units = [f"h{i}_{j}" for j in range(fan_out)]
        out = ", ".join(f"{s} AS {u}" if last else f"greatest({s}, 0) AS {u}" for s, u in zip(sums, units))
        steps.append(f"layer{i + 1} AS (SELECT *, {out} FROM layer{i})")
        at, names = bias + fan_out, units
    return ",\n".join(steps), names[0]


def _net_gradient(sizes: list[int], inputs: list[str], odds: str, alpha: float) -> str:
    """Rows ``(at, value)``: loss and gradient of the fixed network over its last layer."""
    flat, layers = _fixed_weights(sizes), len(sizes) - 1
    starts = [sum(a * b + b for a, b in zip(sizes[:i], sizes[1 : i + 1])) for i in range(layers)]
    names = [inputs, *[[f"h{i}_{j}" for j in range(sizes[i + 1])] for i in range(layers)]]
    ctes, table = [], f"layer{layers}"
    deltas = [[] for _ in range(layers)]
    deltas[-1] = [f"(1 / (1 + exp(-{odds})) - label)"]
    for i in range(layers - 1, 0, -1):
        fan_out = sizes[i + 1]
        cells = [
            "(" + " + ".join(f"{d} * ({flat[starts[i] + k * fan_out + j]})" for j, d in enumerate(deltas[i]))
            + f") * CAST({names[i][k]} > 0 AS INTEGER) AS d{i - 1}_{k}"
            for k in range(sizes[i])
        ]
        ctes.append(f"back{i} AS (SELECT *, {', '.join(cells)} FROM {table})")
        table, deltas[i - 1] = f"back{i}", [f"d{i - 1}_{k}" for k in range(sizes[i])]
    held = sum(flat[starts[i] + k] ** 2 for i in range(layers) for k in range(sizes[i] * sizes[i + 1]))
    loss = f"(sum(greatest({odds}, 0) + ln(1 + exp(-abs({odds}))) - label * {odds}) + {alpha / 2 * held}) / count(*)"
    values = [loss]
    for i in range(layers):
        for k in range(sizes[i]):
            for j in range(sizes[i + 1]):
                w = flat[starts[i] + k * sizes[i + 1] + j]
                values.append(f"(sum({names[i][k]} * {deltas[i][j]}) + {alpha * w}) / count(*)")
        values += [f"sum({d}) / count(*)" for d in deltas[i]]
    picked = ", ".join(values)
    return (
        ",\n".join(ctes)
        + f" SELECT CAST(unnest(range(0, {len(values)})) AS INTEGER) AS at, round(unnest([{picked}]), 6) AS value FROM {table}"
    )


_NET_ROWS = f"""{_DOCS},
net AS (SELECT doc_id, coalesce(n_chars, 0) / 1000 AS a, n_lines / 10 AS b, CAST(coalesce(n_chars, 0) % 3 - 1 AS DOUBLE) AS c,
    quality AS label FROM docs JOIN labels USING (doc_id))"""
_NET, _NET_ODDS = _network(NET_SIZES, ["a", "b", "c"], "net")
_JOB_NET, _JOB_ODDS = _network([2, 3, 1], ["a", "b"], "job")
_FOLD_STATS = """
names AS (SELECT 'numeric__n_chars' AS feature, n_chars AS v, outside FROM spread WHERE n_chars IS NOT NULL
    UNION ALL SELECT 'numeric__n_lines', n_lines, outside FROM spread
    UNION ALL SELECT 'numeric__constant', constant, outside FROM spread)
"""


def _mode(column: str) -> str:
    return f"""(SELECT {column} FROM docs WHERE {column} IS NOT NULL
        GROUP BY {column} ORDER BY count(*) DESC, {column} LIMIT 1)"""


def _scaled(column: str, fit: str = "docs") -> str:
    low, high = f"(SELECT min({column}) FROM {fit})", f"(SELECT max({column}) FROM {fit})"
    return f"""round(CAST({column} - {low} AS DOUBLE)
        / CASE WHEN {high} = {low} THEN 1 ELSE {high} - {low} END, 6)"""


_LANGS = ["de", "en", "es", "fr"]
_SOURCES = [f"src{i}" for i in range(20)]


def _numeric(column: str) -> str:
    return f"""SELECT doc_id, 'numeric__{column}' AS feature, {_scaled(column, "full_docs")} AS value FROM full_docs"""


def _marks(column: str, values: list[str]) -> str:
    listed = ", ".join(f"'{v}'" for v in values)
    return f"""
        SELECT doc_id, 'nominal__{column}_' || v AS feature, CASE WHEN {column} = v THEN 1.0 ELSE 0.0 END AS value
        FROM full_docs, (SELECT DISTINCT {column} AS v FROM docs WHERE {column} IN ({listed})) k"""


ORACLES = {
    "stratified_split": f"WITH {_SPLIT} SELECT doc_id, quality, toxic, split FROM split",
    "stratified_folds": f"""WITH {_SPLIT},
        tr AS (SELECT doc_id, quality, md5('42|' || doc_id) AS h FROM split WHERE split = 'train'),
        pos AS (SELECT quality, (row_number() OVER (ORDER BY quality) - 1) % 5 AS fold FROM tr),
        size AS (SELECT quality, fold, count(*) AS n FROM pos GROUP BY ALL),
        stops AS (SELECT quality, fold, sum(n) OVER (PARTITION BY quality ORDER BY fold) AS stop FROM size),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY quality ORDER BY h) AS r FROM tr)
        SELECT doc_id, quality, CAST((SELECT min(fold) FROM stops s WHERE s.quality = ranked.quality AND s.stop >= r) AS INTEGER) AS fold
        FROM ranked""",
    "impute_mode": f"""WITH {_DOCS} SELECT doc_id, coalesce(overall_stage, {_mode("overall_stage")}) AS overall_stage,
        coalesce(lang, {_mode("lang")}) AS lang FROM docs""",
    "impute_median": f"""WITH {_DOCS}
        SELECT doc_id, coalesce(CAST(n_chars AS DOUBLE), (SELECT median(n_chars) FROM docs)) AS n_chars FROM docs""",
    "minmax_scale": f"""WITH {_DOCS}, seen AS (SELECT * FROM docs WHERE source <> 'src1')
        SELECT doc_id, {_scaled("n_chars", "seen")} AS n_chars, {_scaled("constant", "seen")} AS constant FROM docs""",
    "one_hot": f"""WITH {_DOCS} SELECT doc_id, lang, source, {", ".join(
        f"CASE WHEN {c} = '{v}' THEN 1 ELSE 0 END AS {c}_{v}"
        for c, vs in (("lang", _LANGS), ("source", _SOURCES)) for v in vs if v != "src1")} FROM docs""",
    "wide_categories": """WITH
        o AS (SELECT o_orderkey, CASE WHEN o_orderkey % 7 <> 0 THEN CAST(o_custkey AS VARCHAR) END AS customer,
            strftime(o_orderdate, '%Y-%m-%d') AS day, o_totalprice AS price, o_orderstatus FROM orders),
        seen AS (SELECT * FROM o WHERE o_orderstatus <> 'F'),
        cells AS (SELECT 1 AS col, customer AS v FROM seen UNION ALL SELECT 2, day FROM seen
            UNION ALL SELECT 3, o_orderstatus FROM seen),
        cnt AS (SELECT col, v, count(*) AS n FROM cells WHERE v IS NOT NULL GROUP BY ALL),
        low AS (SELECT *, n < 4 AS rare FROM cnt),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY col ORDER BY rare, n DESC, v) AS r,
            count(*) FILTER (NOT rare) OVER (PARTITION BY col) + CAST(bool_or(rare) OVER (PARTITION BY col) AS INTEGER) AS need
            FROM low),
        final AS (SELECT col, v, n, rare OR (need > 900 AND r >= 900) AS rare FROM ranked),
        placed AS (SELECT col, v, n, rare, CASE WHEN rare THEN count(*) FILTER (NOT rare) OVER (PARTITION BY col)
            ELSE row_number() OVER (PARTITION BY col, rare ORDER BY v) - 1 END AS place FROM final),
        size AS (SELECT col, max(place) + 1 AS size, bool_or(rare) AS shared FROM placed GROUP BY col),
        start AS (SELECT col, size, shared, 1 + coalesce(sum(size) OVER (ORDER BY col ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
            AS start FROM size),
        top AS (SELECT col, arg_min(v, (-n, v)) AS v FROM cnt GROUP BY col),
        long AS (SELECT o_orderkey, 1 AS col, customer AS v FROM o UNION ALL SELECT o_orderkey, 2, day FROM o
            UNION ALL SELECT o_orderkey, 3, o_orderstatus FROM o),
        full_long AS (SELECT o_orderkey, col, coalesce(long.v, top.v) AS v FROM long JOIN top USING (col)),
        marks AS (SELECT o_orderkey, CAST(start + coalesce(place, CASE WHEN shared THEN size - 1 END) AS INTEGER) AS place
            FROM full_long JOIN start USING (col) LEFT JOIN placed USING (col, v))
        SELECT o_orderkey, place, 1.0 AS value FROM marks WHERE place IS NOT NULL
        UNION ALL SELECT o_orderkey, 0, round((price - (SELECT min(price) FROM seen))
            / (SELECT max(price) - min(price) FROM seen), 6) FROM o""",
    "prep_mixed": f"""WITH {_DOCS},
        full_docs AS (SELECT doc_id, n_lines, constant, source,
            coalesce(n_chars, (SELECT median(n_chars) FROM docs)) AS n_chars,
            coalesce(overall_stage, {_mode("overall_stage")}) AS overall_stage, coalesce(lang, {_mode("lang")}) AS lang
            FROM docs)
        {_numeric("n_chars")} UNION ALL {_numeric("n_lines")} UNION ALL {_numeric("constant")}
        UNION ALL SELECT doc_id, 'ordinal__overall_stage', CAST(overall_stage AS DOUBLE) FROM full_docs
        UNION ALL {_marks("lang", _LANGS)} UNION ALL {_marks("source", _SOURCES)}""",
    "prep_numeric": """
        WITH cells AS (SELECT vec_id, CAST(unnest(embedding) AS DOUBLE) AS v, unnest(range(0, 64)) AS i FROM embeddings),
        gaps AS (SELECT vec_id, i, CASE WHEN v > CAST(-0.2 AS DOUBLE) THEN v END AS v FROM cells),
        st AS (SELECT i, median(v) AS m, min(v) AS lo, max(v) AS hi FROM gaps GROUP BY ALL)
        SELECT vec_id, 'numeric__e' || i AS feature, round((coalesce(v, m) - lo) / (hi - lo), 6) AS value
        FROM gaps JOIN st USING (i)""",
    "confusion_metrics": f"""WITH {_SCORED}, {_CLASS}
        SELECT dataset, model, tp, fp, fn, tn, round(balanced_accuracy, 6) AS balanced_accuracy, round(f1, 6) AS f1 FROM met""",
    "roc_auc": f"WITH {_SCORED}, {_AUC} SELECT dataset, model, round(auc, 6) AS auc FROM area",
    "roc_curve": f"""WITH {_SCORED}, {_AUC}, {_CURVE}
        SELECT dataset, model, round(fpr, 6) AS fpr, round(tpr, 6) AS tpr, round(auc, 6) AS auc
        FROM pts JOIN area USING (dataset, model)""",
    "metrics_pivot": f"""WITH {_METRICS} SELECT dataset, {", ".join(
        _pivot(m, x) for m in ("LASSO", "MLP") for x in evaluation.METRICS)} FROM long GROUP BY dataset""",
    "metrics_files": f"""WITH {_METRICS.replace("'documents' AS dataset", "'part ' || doc_id % 5 AS dataset").replace(
        "SELECT quality AS label,", "SELECT doc_id, quality AS label,")} SELECT dataset, {", ".join(
        _pivot(m, x) for m in ("LASSO", "MLP") for x in evaluation.METRICS)} FROM long GROUP BY dataset""",
    "metrics_join": f"""WITH {_METRICS}
        SELECT dataset, metric, a.value AS lasso, b.value AS mlp FROM long a JOIN long b USING (dataset, metric)
        WHERE a.model = 'LASSO' AND b.model = 'MLP'""",
    "topk_coefs": """
        WITH cells AS (SELECT label, CAST(unnest(embedding) AS DOUBLE) AS v, unnest(range(0, 64)) AS i FROM embeddings),
        cov AS (SELECT 'e' || lpad(CAST(i AS VARCHAR), 2, '0') AS feature, covar_pop(v, label) AS coefficient FROM cells GROUP BY i)
        SELECT feature, round(coefficient, 6) AS coefficient FROM cov ORDER BY abs(cov.coefficient) DESC, feature LIMIT 10""",
    "lasso_binary_cv": f"""WITH rows AS (SELECT doc_id, toxic AS x, quality AS y FROM labels), {_folds("rows")}
        SELECT CAST(r.c AS DOUBLE) AS c, round(mean_auc, 6) AS mean_auc, CAST(rank AS INTEGER) AS rank,
            round(w, 3) AS best_slope, round(b, 3) AS best_intercept
        FROM ranked_c r, final""",
    "lasso_job": f"""WITH {_SPLIT},
        rows AS (SELECT doc_id, toxic AS x, quality AS y FROM split WHERE split = 'train'), {_folds("rows")},
        scored AS (SELECT 'Documents' AS dataset, 'LASSO' AS model, quality AS label, b + w * toxic AS score,
            CASE WHEN b + w * toxic > 0 THEN 1 ELSE 0 END AS prediction FROM split, final WHERE split = 'test'),
        {_CLASS}, {_AUC}
        SELECT dataset, model, unnest(['Weighted Accuracy', 'AUC', 'F1 Score']) AS item,
            unnest([round_even(balanced_accuracy, 2), round_even(auc, 2), round_even(f1, 2)]) AS value
        FROM met JOIN area USING (dataset, model)
        UNION ALL SELECT 'documents', 'LASSO', 'toxic', round(w, 3) FROM final""",
    "shapley_kernel": f"""WITH {_shapley()},
        f AS (SELECT doc_id, greatest(n_chars / 100 - n_lines, 0) * (1 + toxic) + n_lines AS f FROM explained)
        SELECT doc_id, round(f - (SELECT avg(f) FROM f), 6) AS total, CAST(3 AS BIGINT) AS n_se FROM f""",
    "lasso_certificate": f"""WITH fit_rows AS (SELECT 0 AS k, toxic AS x, quality AS y FROM labels), {_CLOSED_FORM},
        slopes AS (SELECT c, any_value(w) AS w, any_value(b) AS b,
            any_value(abs(w) + abs(b)) + any_value(c) * sum(ln(1 + exp(b + w * x)) - y * (b + w * x)) AS objective,
            any_value(c) * sum((1 / (1 + exp(-(b + w * x))) - y) * x) AS gw,
            any_value(c) * sum(1 / (1 + exp(-(b + w * x))) - y) AS gb FROM fits, fit_rows GROUP BY c)
        SELECT CAST(c AS DOUBLE) AS c, round(w, 4) AS slope, round(b, 4) AS intercept, round(objective, 4) AS objective,
            round(greatest(CASE WHEN w = 0 THEN greatest(abs(gw) - 1, 0) ELSE abs(gw + sign(w)) END,
                CASE WHEN b = 0 THEN greatest(abs(gb) - 1, 0) ELSE abs(gb + sign(b)) END), 4) AS violation
        FROM slopes""",
    "fold_statistics": f"""WITH {_DOCS}, rows AS (SELECT docs.*, quality AS y, toxic AS x FROM docs JOIN labels USING (doc_id)),
        dealt_pos AS (SELECT y, (row_number() OVER (ORDER BY y) - 1) % 5 AS fold FROM rows),
        fold_size AS (SELECT y, fold, count(*) AS n FROM dealt_pos GROUP BY ALL),
        stops AS (SELECT y, fold, sum(n) OVER (PARTITION BY y ORDER BY fold) AS stop FROM fold_size),
        placed AS (SELECT *, row_number() OVER (PARTITION BY y ORDER BY md5('42|' || doc_id)) AS r FROM rows),
        marked AS (SELECT *, (SELECT min(fold) FROM stops s WHERE s.y = placed.y AND s.stop >= r) AS fold FROM placed),
        spread AS (SELECT m.*, k AS outside FROM marked m, (SELECT unnest(range(0, 5)) AS k) WHERE fold <> k),
        {_FOLD_STATS}
        SELECT CAST(outside AS INTEGER) AS fold, feature, round(CAST(median(v) AS DOUBLE), 6) AS middle,
            round(CAST(min(v) AS DOUBLE), 6) AS low, round(CAST(max(v) AS DOUBLE), 6) AS high, CAST(NULL AS VARCHAR) AS common
        FROM names GROUP BY outside, feature
        UNION ALL SELECT CAST(outside AS INTEGER), 'ordinal__overall_stage', NULL, NULL, NULL,
            CAST(CAST(mode_of AS DOUBLE) AS VARCHAR)
        FROM (SELECT outside, arg_max(overall_stage, (n, -overall_stage)) AS mode_of FROM
            (SELECT outside, overall_stage, count(*) AS n FROM spread WHERE overall_stage IS NOT NULL GROUP BY ALL) GROUP BY outside)
        UNION ALL SELECT CAST(outside AS INTEGER), 'nominal__' || c, NULL, NULL, NULL, v
        FROM (SELECT outside, c, v, row_number() OVER (PARTITION BY outside, c ORDER BY count(*) DESC, v) AS k FROM
            (SELECT outside, 'lang' AS c, lang AS v FROM spread UNION ALL SELECT outside, 'source', source FROM spread)
            WHERE v IS NOT NULL GROUP BY outside, c, v) WHERE k = 1""",
    "network_scores": f"""WITH {_NET_ROWS}, {_NET}
        SELECT doc_id, round(1 / (1 + exp(-{_NET_ODDS})), 6) AS score, CAST(1 / (1 + exp(-{_NET_ODDS})) >= 0.5 AS INTEGER) AS prediction
        FROM layer{len(NET_SIZES) - 1}""",
    "network_gradient": f"WITH {_NET_ROWS}, {_NET}, {_net_gradient(NET_SIZES, ['a', 'b', 'c'], _NET_ODDS, 0.5)}",
    "network_job": f"""WITH {_SPLIT}, {_DOCS},
        rows AS (SELECT doc_id, n_chars, n_lines, split.quality AS label, split FROM docs JOIN split USING (doc_id)),
        st AS (SELECT median(n_chars) AS mc, min(n_chars) AS lc, max(n_chars) AS hc, min(n_lines) AS ll, max(n_lines) AS hl
            FROM rows WHERE split = 'train'),
        job AS (SELECT label, CAST(coalesce(n_chars, mc) - lc AS DOUBLE) / (hc - lc) AS a,
            CAST(n_lines - ll AS DOUBLE) / (hl - ll) AS b FROM rows, st WHERE split = 'test'), {_JOB_NET},
        scored AS (SELECT 'Documents' AS dataset, 'MLP' AS model, label, 1 / (1 + exp(-{_JOB_ODDS})) AS score,
            CAST({_JOB_ODDS} >= 0 AS INTEGER) AS prediction FROM layer2),
        {_CLASS}, {_AUC}
        SELECT dataset, model, unnest(['Weighted Accuracy', 'AUC', 'F1 Score']) AS metric,
            unnest([round_even(balanced_accuracy, 2), round_even(auc, 2), round_even(f1, 2)]) AS value
        FROM met JOIN area USING (dataset, model)""",
    "shapley_linear": f"WITH {_shapley()} SELECT doc_id, feature, round(phi, 6) AS phi FROM phis",
    "shapley_importance": f"""WITH {_shapley()}
        SELECT feature, round(avg(abs(phi)), 6) AS importance FROM phis GROUP BY feature""",
}
