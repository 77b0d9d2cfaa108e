"""Splits cover every row once and do not depend on partitioning."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from recmill.operators import splits


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(5000).select(
        F.col("id"), (F.col("id") % 37).alias("user"), (F.col("id") % 11).alias("item"), F.col("id").alias("ts")
    ).cache()


def ids(df):
    return sorted(row["id"] for row in df.select("id").collect())


@pytest.mark.parametrize("split", [
    lambda df: splits.hash_split(df, ["id"], 0.75),
    lambda df: splits.chrono_split(df, 0.6, tiebreak=["id"]),
    lambda df: splits.user_ratio_split(df, 0.8, key=["id"]),
    lambda df: splits.random_split(df),
])
def test_cover(rows, split):
    left, right = split(rows)
    assert sorted(ids(left) + ids(right)) == list(range(5000))


@pytest.mark.parametrize("split", [
    lambda df: splits.hash_split(df, ["id"])[0],
    lambda df: splits.user_ratio_split(df, 0.8, key=["id"])[0],
    lambda df: splits.sample_exact(df, 0.3, ["id"]),
    lambda df: splits.fold_column(df, ["id"]).filter("fold = 1"),
])
def test_partitioning_does_not_matter(rows, split):
    assert ids(split(rows.repartition(7))) == ids(split(rows.repartition(3)))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.floats(0, 1), st.integers(0, 1000))
def test_exact_sample_size(rows, fraction, seed):
    assert splits.sample_exact(rows, fraction, ["id"], seed).count() == int(fraction * 5000 + 1e-9)


def test_left_share_stays_within_ratio(rows):
    left, _ = splits.chrono_split(rows, 0.7, tiebreak=["id"])
    shares = left.groupBy("user").count().join(rows.groupBy("user").count().withColumnRenamed("count", "n"), "user")
    assert shares.filter(F.col("count") > 0.7 * F.col("n")).count() == 0


def test_folds_are_even(rows):
    sizes = [r["count"] for r in splits.fold_column(rows, ["id"], 3).groupBy("fold").count().collect()]
    assert len(sizes) == 3 and min(sizes) > 1500
