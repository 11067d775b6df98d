"""The filter of single keys: exact, and few rows are shuffled."""
import re

import pytest
from pyspark.sql import functions as F

from quarry.functions import repeats as R
from quarry.operators import quality as Q


def keyed(spark, n=60_000):
    """Mostly single keys, some pairs, one key with a third of the rows, nulls."""
    i = F.col("id")
    return spark.range(n).select(
        F.when(i % 3 == 0, 7).when(i % 100 == 1, i - i % 2000).when(i % 500 == 2, None).otherwise(i).alias("a"),
        F.when(i % 3 == 0, "x").when(i % 500 == 2, None).otherwise("y").alias("b"))


def rows(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("slice_bits", [0, 3, 10, 16])
def test_every_repeated_key_stays(spark, monkeypatch, slice_bits):
    monkeypatch.setattr(R, "ROWS_AT_A_TIME", 5_000)
    df = keyed(spark)
    want = df.groupBy("a", "b").count().where("count > 1")
    left = R.maybe_repeated(df, ["a", "b"], slice_bits)
    assert rows(left.groupBy("a", "b").count().where("count > 1")) == rows(want)
    assert left.count() <= want.agg(F.sum("count")).first()[0] + 10


def test_too_many_repeats_leave_the_rows_as_they_are(spark):
    df = keyed(spark)
    assert R.maybe_repeated(df, ["a", "b"], broadcast_buckets=3) is df


def test_empty_input(spark):
    assert R.maybe_repeated(keyed(spark, 0), ["a", "b"]).count() == 0
    assert Q.group_counts(keyed(spark, 0), ["a"], min_count=1).count() == 0


def test_counts_are_those_of_a_plain_group_by(spark):
    df = keyed(spark)
    got = Q.group_counts(df, ["a", "b"], min_count=1, limit=10)
    want = (df.groupBy("a", "b").agg(F.count(F.lit(1)).alias("count")).where("count > 1")
            .orderBy(F.desc("count"), F.col("a").asc_nulls_last(), F.col("b").asc_nulls_last()).limit(10))
    assert got.collect() == want.collect()
    assert got.first()["count"] == 20_000


def test_single_keys_stay_out_of_the_shuffle(spark):
    """Rows that reach the exchange of the final group-by."""
    df = spark.range(100_000).select((F.col("id") - F.when(F.col("id") % 1000 == 1, 1).otherwise(0)).alias("k"))
    left = R.maybe_repeated(df, ["k"])
    assert left.count() <= 220
    plan = Q.group_counts(df, ["k"], min_count=1)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"BroadcastHashJoin .*LeftSemi", plan)
