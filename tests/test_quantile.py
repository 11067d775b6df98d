"""Exact percentiles: Spark path and the bounded refinement path agree with numpy."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.functions.quantile import exact_percentiles


@pytest.mark.parametrize("small_n", [10**9, 0])
def test_against_numpy(spark, small_n):
    rng = np.random.default_rng(3)
    a = np.concatenate([rng.normal(size=3000), np.full(500, 2.0), rng.integers(0, 5, 1000).astype(float)])
    b = rng.exponential(size=len(a))
    df = spark.createDataFrame([(float(x), float(y)) for x, y in zip(a, b)], "a double, b double")
    got = exact_percentiles(df, ["a", "b"], [0.1, 0.25, 0.5, 0.75], small_n=small_n, histogram_rows=64)
    for col, arr in (("a", a), ("b", b)):
        want = np.percentile(arr, [10, 25, 50, 75])
        assert np.allclose(got[col], want, rtol=0, atol=1e-12), (col, got[col], want)


def test_nulls_and_single_value(spark):
    df = spark.createDataFrame([(1.0,), (None,), (1.0,)], "a double")
    assert exact_percentiles(df, ["a"], [0.5], small_n=0)["a"] == [1.0]


def test_paths_bit_identical(spark):
    rng = np.random.default_rng(11)
    vals = np.round(rng.lognormal(10, 2, 4000), 1)
    df = spark.createDataFrame([(float(v),) for v in vals], "a double")
    probs = [0.01, 0.1, 0.37, 0.5, 0.99]
    assert exact_percentiles(df, ["a"], probs) == exact_percentiles(df, ["a"], probs, small_n=0, histogram_rows=128)


@pytest.mark.parametrize("margin", [0.001, 0.2, 0.0])
def test_infinities_and_nans_end(spark, margin):
    """Both paths agree where ranks fall on infinities, and no loop runs on; a
    bracket that misses its rank (margin 0) is widened."""
    rng = np.random.default_rng(5)
    vals = [float("-inf")] * 30 + [float("inf")] * 20 + [-1.7e308, 1.7e308] + [float(v) for v in rng.normal(size=400)] + [3.0] * 200
    df = spark.createDataFrame([(v, float(i % 7)) for i, v in enumerate(vals)], "a double, b double").repartition(3)
    probs = [0.0, 0.02, 0.04, 0.25, 0.5, 0.9, 0.99, 1.0]
    assert exact_percentiles(df, ["a", "b"], probs) == exact_percentiles(df, ["a", "b"], probs, small_n=0, margin=margin, histogram_rows=200)
    only = spark.createDataFrame([(float("inf"),), (float("inf"),), (None,)], "a double")
    assert exact_percentiles(only, ["a"], [0.5], small_n=0)["a"] == [float("inf")]


def test_three_passes_and_few_rows_on_the_driver(spark, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame
    seen, collect = [], DataFrame.collect
    monkeypatch.setattr(DataFrame, "collect", lambda self: (seen.append(r := collect(self)), r)[1])
    df = spark.range(200_000).select(*[(((F.col("id") * (2 * i + 3)) % 100_003) / 7).alias(f"c{i}") for i in range(7)])
    got = exact_percentiles(df, df.columns, [0.25, 0.5, 0.75], small_n=0, max_rows=200_000)
    passes = [r for r in seen if r]
    assert len(passes) <= 4 and sum(map(len, passes)) <= 50_000  # the fourth reads the sketches, one row
    monkeypatch.undo()
    assert got == exact_percentiles(df, df.columns, [0.25, 0.5, 0.75])
