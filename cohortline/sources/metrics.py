"""Files of model metrics with two header rows: models above, metrics below."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortline.operators.assemble import pivot_metrics
from cohortline.plans.durable import freeze
from cohortline.sources.quoted import QUOTE, cells, headers, records

KEY = "Dataset"


def _cell(text: Column) -> Column:
    doubled = F.replace(text, F.lit(QUOTE), F.lit(QUOTE * 2))
    return F.when(text.rlike('[,"\\r\\n]'), F.concat(F.lit(QUOTE), doubled, F.lit(QUOTE))).otherwise(text)


def write_metrics(metrics: DataFrame, path: str, columns: Sequence[tuple[str, str]]) -> None:
    """Long metrics ``(dataset, model, metric, value)`` as text with two header rows.

    There is a file for each task that holds datasets, each with its headers.
    """
    tops = [["", *[m for m, _ in columns]], [KEY, *[x for _, x in columns]]]
    wide = pivot_metrics(metrics, columns)
    values = [F.coalesce(_cell(F.col(c).cast("string")), F.lit("")) for c in wide.columns]
    row = F.array_join(F.array(*values), ",")
    # The headers go before the first row of a task; a task sees its rows one after the other.
    lines = [F.concat_ws(",", *[_cell(F.lit(t)) for t in top]) for top in tops]
    rows = wide.select(row.alias("row"), F.monotonically_increasing_id().alias("at"))
    first = F.col("at") % (1 << 33) == 0
    shown = F.when(first, F.array(*lines, F.col("row"))).otherwise(F.array("row"))
    rows.select(F.explode(shown).alias("value")).write.mode("overwrite").text(path)


def read_metrics(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """``dataset, model, metric, value`` of all files; each may have columns of its own.

    A blank model goes on with the one before it, as where header cells are merged;
    empty values are missing.
    """
    rows = freeze(records(spark, path))
    tops = headers(rows).select("file", F.col("line").alias("top"), F.col("record").alias("models"))
    below = rows.join(F.broadcast(tops), "file").filter("line > top")
    seconds = below.groupBy("file").agg(F.min("line").alias("second"), F.min_by("record", "line").alias("names"))
    both = freeze(tops.join(seconds, "file"))
    found = []
    # One plan for each layout, of which there are few however many files there are.
    for layout in both.select("models", "names").distinct().collect():
        models, names = cells(layout["models"]), cells(layout["names"])
        if len(models) != len(names):
            raise ValueError(f"header rows of different lengths: {layout['models']!r}, {layout['names']!r}")
        for i in range(2, len(models)):
            models[i] = models[i] or models[i - 1]
        own = both.filter((F.col("models") == layout["models"]) & (F.col("names") == layout["names"]))
        schema = ", ".join(f"c{i} string" for i in range(len(names)))
        parsed = (
            rows.join(F.broadcast(own.select("file", "second")), "file").filter("line > second")
            .select(F.from_csv("record", schema, {"quote": QUOTE, "escape": QUOTE}).alias("r"))
        )
        parts = [
            F.struct(
                F.lit(m).alias("model"), F.lit(x).alias("metric"), F.col("r")[f"c{i}"].try_cast("double").alias("value")
            )
            for i, (m, x) in enumerate(zip(models, names))
            if i
        ]
        cells_of = parsed.select(F.col("r.c0").alias("dataset"), F.explode(F.array(*parts)).alias("p"))
        found.append(cells_of.select("dataset", "p.model", "p.metric", "p.value"))
    if not found:
        return spark.createDataFrame([], T.StructType.fromDDL("dataset string, model string, metric string, value double"))
    return reduce(DataFrame.unionByName, found)
