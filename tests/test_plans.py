"""Skew-safe joins and running totals against plain versions."""

import random
from pathlib import Path

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from cohortline.plans import skew
from cohortline.plans.durable import at_once, freeze, own_tables, shared_folder
from cohortline.plans.ordering import row_index, running_sums


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture(scope="module")
def skewed(spark):
    keys = [0] * 400 + [k % 50 for k in range(600)] + [None] * 5
    left = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k int, v int")
    right = spark.createDataFrame([(k, k * 10) for k in range(0, 60, 2)] + [(0, -1)], "k int, w int")
    return freeze(left), freeze(right)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_attach_within_and_beyond_the_bound(skewed, how):
    left, right = skewed
    plain = rows(left.join(right, ["k"], how).select("k", "v", "w"))
    small, large = (skew.attach(left, right, ["k"], how, broadcast_bytes=n) for n in (1 << 20, 0))
    assert "BroadcastHashJoin" in small._jdf.queryExecution().toString()
    assert rows(small.select("k", "v", "w")) == rows(large.select("k", "v", "w")) == plain


def test_size_of_a_lookup(spark):
    df = spark.createDataFrame([("ab", 1, [1, 2]), (None, 2, None)], "s string, n int, a array<int>")
    assert 100 < skew.table_bytes(df) < 200
    assert skew.table_bytes(df.limit(0)) == 0


@pytest.mark.parametrize("group", [[], ["g"]])
def test_running_sums_equal_a_window(spark, group):
    rng = random.Random(5)
    data = [
        (None if i % 5 == 0 else 0 if i % 3 else i % 7, i, rng.randint(-5, 9))
        for i in rng.sample(range(2000), 600)
    ]
    df = spark.createDataFrame(data, "g int, at int, v int")
    w = Window.partitionBy(*(group or [F.lit(0)])).orderBy("at")
    plain = df.select("*", F.sum("v").over(w).alias("s"), (F.row_number().over(w) - 1).alias("i"))
    ours = running_sums(df, group, ["at"], {"s": F.col("v")})
    assert rows(ours) == rows(plain.drop("i"))
    assert rows(row_index(df, group, ["at"], "i")) == rows(plain.drop("s"))


def test_frozen_tables_live_in_the_shared_folder(spark):
    frozen = freeze(spark.range(3))
    assert frozen.count() == 3
    assert shared_folder(spark).removeprefix("file:") in frozen.inputFiles()[0]


def test_tables_of_a_job_go_when_it_ends(spark):
    with own_tables(spark):
        inside = freeze(spark.range(3)).inputFiles()[0]
        with own_tables(spark):
            deeper = at_once(spark, lambda: freeze(spark.range(2)))[0].inputFiles()[0]
        assert not Path(deeper.removeprefix("file://")).exists()
        assert Path(inside.removeprefix("file://")).exists()
    assert not Path(inside.removeprefix("file://")).exists()
    assert freeze(spark.range(3)).count() == 3
