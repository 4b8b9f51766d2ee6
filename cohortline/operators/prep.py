"""Imputation, scaling and encoding of mixed columns, fitted on training rows."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortline.plans.durable import freeze
from cohortline.plans.ordering import running_sums

# Ordinal columns of the study tables.
ORDINALS = [
    "clinical_t_stage", "clinical_n_stage", "clinical_m_stage", "overall_stage",
    "gg_percentage",
]

Roles = Mapping[str, Sequence[str]]


def column_roles(
    df: DataFrame,
    except_for: Sequence[str],
    ordinals: Sequence[str] = ORDINALS,
    overrides: Mapping[str, str] | None = None,
    all_numeric: bool = False,
) -> dict[str, list[str]]:
    """Sort columns into ``numeric``, ``ordinal`` and ``nominal`` by type and name."""
    roles: dict[str, list[str]] = {"numeric": [], "ordinal": [], "nominal": []}
    for field in df.schema.fields:
        if field.name in except_for:
            continue
        if all_numeric:
            role = "numeric"
        elif field.name in ordinals:
            role = "ordinal"
        else:
            role = "nominal" if isinstance(field.dataType, T.StringType) else "numeric"
        roles[(overrides or {}).get(field.name, role)].append(field.name)
    return roles


def _cells(df: DataFrame, numbers: Sequence[str], texts: Sequence[str]) -> DataFrame:
    """One row per column and value: ``(name, num, txt)``."""
    cells = [
        F.struct(
            F.lit(c).alias("name"),
            (F.col(c).cast("double") if c in numbers else F.lit(None).cast("double")).alias("num"),
            (F.col(c) if c in texts else F.lit(None).cast("string")).alias("txt"),
        )
        for c in [*numbers, *texts]
    ]
    return df.select(F.explode(F.array(*cells)).alias("cell")).select("cell.*")


def value_counts(df: DataFrame, numbers: Sequence[str], texts: Sequence[str]) -> DataFrame:
    """Count of each value of each column, all columns in one shuffle.

    Repeated values fold on the map side, so a value that fills a third of a
    column costs one row per task.
    """
    return (
        _cells(df, numbers, texts)
        .filter("num IS NOT NULL OR txt IS NOT NULL")
        .groupBy("name", "num", "txt")
        .agg(F.count("*").alias("n"))
    )


def modes(counts: DataFrame) -> dict[str, object]:
    """Most frequent value per column; the smallest of those that tie."""
    best = counts.groupBy("name").agg(
        F.min(F.struct((-F.col("n")).alias("n"), "num", "txt")).alias("best")
    )
    return {
        r["name"]: r["best"]["txt"] if r["best"]["num"] is None else r["best"]["num"]
        for r in best.collect()
    }


def medians(df: DataFrame, columns: Sequence[str], margin: float = 0.001) -> dict[str, float]:
    """Exact median per column: the value at the middle rank, or the mean of the two.

    A sketch brackets the middle; one pass counts the values below and inside
    each bracket; only the values inside, about ``2 * margin`` of a column, are
    shuffled and ranked. A bracket that misses the middle is opened fully.
    """
    if not columns:
        return {}
    numbers = {c: F.col(c).cast("double") for c in columns}
    ends = df.agg(
        *[
            F.percentile_approx(v, [0.5 - margin, 0.5 + margin], round(10 / margin)).alias(f"e {c}")
            for c, v in numbers.items()
        ]
    ).first()
    brackets = {c: tuple(ends[f"e {c}"]) for c in columns if ends[f"e {c}"]}
    if not brackets:
        return {}
    # One row of sums for all columns: nothing is exploded to count.
    sizes = df.agg(
        *[
            f(numbers[c], *bracket).alias(f"{name} {c}")
            for c, bracket in brackets.items()
            for name, f in (
                ("rows", lambda v, low, high: F.count(v)),
                ("below", lambda v, low, high: F.count_if(v < low)),
                ("held", lambda v, low, high: F.count_if(v.between(low, high))),
            )
        ]
    ).first()
    cells = []
    for c, bracket in brackets.items():
        rows, below = sizes[f"rows {c}"], sizes[f"below {c}"]
        ranks = (rows + 1) // 2, rows // 2 + 1
        if not below < ranks[0] <= ranks[1] <= below + sizes[f"held {c}"]:
            bracket, below = (-float("inf"), float("inf")), 0
        cell = F.struct(
            F.lit(c).alias("name"),
            numbers[c].alias("num"),
            *[F.lit(rank - below).cast("bigint").alias(r) for rank, r in zip(ranks, ("first", "second"))],
        )
        cells.append(F.when(numbers[c].between(*bracket), cell))
    counts = (
        df.select(F.explode(F.array_compact(F.array(*cells))).alias("cell"))
        .groupBy("cell.name", "cell.num", "cell.first", "cell.second")
        .agg(F.count("*").alias("n"))
    )
    upto = running_sums(counts, ["name"], ["num"], {"upto": F.col("n")})
    covers = [F.expr(f"upto >= {r} AND upto - n < {r}") for r in ("first", "second")]
    middle = (
        upto.filter(covers[0] | covers[1])
        .groupBy("name")
        .agg(((F.min("num") + F.max("num")) / 2).alias("median"))
    )
    return {r["name"]: r["median"] for r in middle.collect()}


def approx_medians(df: DataFrame, columns: Sequence[str], accuracy: int = 100_000) -> dict:
    """Approximate medians in one pass, for when an exact one is not asked for."""
    row = df.agg(*[F.percentile_approx(c, 0.5, accuracy).alias(c) for c in columns]).first()
    return {c: row[c] for c in columns if row[c] is not None}


def categories(counts: DataFrame) -> dict[str, list[str]]:
    """Sorted categories per text column; these become part of the model."""
    rows = counts.filter("txt IS NOT NULL").select("name", "txt").collect()
    found: dict[str, list[str]] = {}
    for r in rows:
        found.setdefault(r["name"], []).append(r["txt"])
    return {name: sorted(texts) for name, texts in found.items()}


def extremes(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Smallest and largest value per column, in one aggregate."""
    ends = df.agg(
        *[
            f(F.col(c).cast("double")).alias(f"{i} {c}")
            for c in columns
            for i, f in enumerate((F.min, F.max))
        ]
    ).first()
    return {c: (ends[f"0 {c}"], ends[f"1 {c}"]) for c in columns}


def impute(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in values.items()})


def impute_mode(df: DataFrame, numbers: Sequence[str], texts: Sequence[str]) -> DataFrame:
    return impute(df, modes(value_counts(df, numbers, texts)))


def impute_median(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    doubles = df.withColumns({c: F.col(c).cast("double") for c in columns})
    return impute(doubles, medians(doubles, columns))


def scaled(value: Column, low: float, high: float) -> Column:
    """Min-max scaling without clipping; a constant column is only shifted."""
    width = high - low
    return (value.cast("double") - F.lit(low)) / F.lit(width if width else 1.0)


def scale_minmax(df: DataFrame, fit_on: DataFrame, columns: Sequence[str]) -> DataFrame:
    bounds = extremes(fit_on, columns)
    return df.withColumns({c: scaled(F.col(c), *bounds[c]) for c in columns})


def is_category(column: str, category: str) -> Column:
    """1 for the category; an unseen value is 0 in every category."""
    return F.coalesce((F.col(column) == category).cast("int"), F.lit(0))


def one_hot(df: DataFrame, fit_on: DataFrame, columns: Sequence[str]) -> DataFrame:
    known = categories(value_counts(fit_on, [], columns))
    marks = {f"{c}_{v}": is_category(c, v) for c in columns for v in known.get(c, [])}
    return df.withColumns(marks)


def _marked(place: Column, size: int) -> Column:
    """Array of ``size`` zeros with a one at ``place``; place 0 marks nothing.

    No lambda here: a Python function over the array could not be planned.
    """
    place, zero = place.cast("int"), F.lit(0.0)
    marked = F.concat(
        F.array_repeat(zero, place - 1), F.array(F.lit(1.0)), F.array_repeat(zero, F.lit(size) - place)
    )
    return F.when(place > 0, marked).otherwise(F.array_repeat(zero, F.lit(size)))


class _PrepParams(Params):
    numeric = Param(Params._dummy(), "numeric", "scaled columns", TypeConverters.toListString)
    ordinal = Param(Params._dummy(), "ordinal", "coded columns", TypeConverters.toListString)
    nominal = Param(Params._dummy(), "nominal", "text columns", TypeConverters.toListString)
    outputCol = Param(Params._dummy(), "outputCol", "feature vector", TypeConverters.toString)

    def __init__(self) -> None:
        super().__init__()
        self._setDefault(numeric=[], ordinal=[], nominal=[], outputCol="features")


class TabularPrep(Estimator, _PrepParams, DefaultParamsReadable, DefaultParamsWritable):
    """Numeric: median and min-max. Ordinal: mode. Nominal: mode and one-hot.

    Columns without any value in the fitted rows are left out.
    """

    @keyword_only
    def __init__(self, *, numeric=None, ordinal=None, nominal=None, outputCol="features"):
        super().__init__()
        given = {k: v for k, v in self._input_kwargs.items() if v is not None}
        self._set(**given)

    def _fit(self, dataset: DataFrame) -> TabularPrepModel:
        numeric, ordinal, nominal = (
            list(self.getOrDefault(p)) for p in (self.numeric, self.ordinal, self.nominal)
        )
        middle = medians(dataset, numeric)
        bounds = extremes(dataset, numeric) if numeric else {}
        common, known = {}, {}
        if ordinal or nominal:
            counts = freeze(value_counts(dataset, ordinal, nominal))
            common, known = modes(counts), categories(counts)
        state = {
            "numeric": [[c, middle[c], *bounds[c]] for c in numeric if c in middle],
            "ordinal": [[c, common[c]] for c in ordinal if c in common],
            "nominal": [[c, common[c], known[c]] for c in nominal if c in known],
        }
        model = TabularPrepModel(outputCol=self.getOrDefault(self.outputCol))
        return model._set(state=json.dumps(state))


class TabularPrepModel(Model, _PrepParams, DefaultParamsReadable, DefaultParamsWritable):
    """Fitted statistics; applied as one expression for each column."""

    state = Param(Params._dummy(), "state", "fitted statistics", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, outputCol="features"):
        super().__init__()
        self._set(**self._input_kwargs)

    def _state(self) -> dict[str, list]:
        return json.loads(self.getOrDefault(self.state))

    def feature_names(self) -> list[str]:
        """Output names in order: numeric, ordinal, nominal."""
        state = self._state()
        names = [f"{kind}__{c[0]}" for kind in ("numeric", "ordinal") for c in state[kind]]
        return names + [f"nominal__{c}_{v}" for c, _, known in state["nominal"] for v in known]

    def statistics(self) -> list[tuple]:
        """``(feature, median, low, high, mode)`` of every column that is kept."""
        state = self._state()
        found = [(f"numeric__{c}", *map(float, values), None) for c, *values in state["numeric"]]
        for kind in ("ordinal", "nominal"):
            found += [(f"{kind}__{c[0]}", None, None, None, str(c[1])) for c in state[kind]]
        return found

    def _transform(self, dataset: DataFrame) -> DataFrame:
        state, output = self._state(), self.getOrDefault(self.outputCol)
        numbers = [
            scaled(F.coalesce(F.col(c).cast("double"), F.lit(middle)), low, high)
            for c, middle, low, high in state["numeric"]
        ]
        numbers += [
            F.coalesce(F.col(c).cast("double"), F.lit(common)).cast("double") for c, common in state["ordinal"]
        ]
        blocks = [F.array(*numbers)] if numbers else []
        for c, common, known in state["nominal"]:
            # One look-up for a row and column, however many categories there are.
            place = F.array_position(F.lit(known), F.coalesce(F.col(c), F.lit(common)))
            blocks.append(_marked(place, len(known)))
        attributes = [{"idx": i, "name": n} for i, n in enumerate(self.feature_names())]
        metadata = {"ml_attr": {"attrs": {"numeric": attributes}, "num_attrs": len(attributes)}}
        vector = array_to_vector(F.concat(*blocks) if blocks else F.array().cast("array<double>"))
        return dataset.withColumn(output, vector).withMetadata(output, metadata)


def vector_names(df: DataFrame, column: str = "features") -> list[str]:
    """Feature names kept with a prepared vector column."""
    attributes = df.schema[column].metadata["ml_attr"]["attrs"]["numeric"]
    return [a["name"] for a in sorted(attributes, key=lambda a: a["idx"])]
