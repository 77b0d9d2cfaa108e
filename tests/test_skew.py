"""Heavy groups: the split forms must give exactly what the plain forms give."""

import itertools

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from recmill.functions import pairs
from recmill.functions.metrics import label_lists
from recmill.functions.pairs import concordant, fcp
from recmill.operators import indexing, skew, splits


@pytest.fixture(scope="module")
def skewed(spark):
    """3,000 rows; key 1 holds a third, keys repeat times, some times and keys are missing."""
    rows = spark.range(3000).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, 1).when(F.col("id") % 97 == 0, None).otherwise(F.col("id") % 40).alias("user"),
        F.pmod(F.xxhash64("id"), F.lit(60)).cast("int").alias("item"),
        F.when(F.col("id") % 50 != 0, F.pmod(F.xxhash64("id", F.lit(7)), F.lit(200))).alias("ts"),
        (F.pmod(F.xxhash64("id", F.lit(3)), F.lit(90)) / 10).alias("rating"),
    )
    return rows.cache()


def bag(df):
    return sorted((tuple(row) for row in df.collect()), key=str)


def test_heavy_keys_are_the_largest(skewed):
    heavy = skew.heavy_keys(skewed, ["user"], 200)
    assert [row["user"] for row in heavy] == [1]
    assert len(skew.heavy_keys(skewed, ["user"], 10, limit=3)) == 3


def test_heavy_keys_are_found_in_a_sample(spark):
    rows = spark.range(3_000_000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") % 5000).alias("key"))
    heavy = skew.heavy_keys(rows, ["key"], 500_000)
    assert [row["key"] for row in heavy] == [-1]
    assert heavy[0]["_rows"] == pytest.approx(1_000_000, rel=0.1)
    assert skew.heavy_keys(rows, ["key"], 2_000_000) == []
    assert skew.heavy_keys(rows, [], 2_000_000)[0]["_rows"] == 3_000_000


@pytest.mark.parametrize("min_rows", [10, 200])
@pytest.mark.parametrize("keys", [["user"], []])
def test_rank(skewed, keys, min_rows):
    order = [F.col("ts").desc(), F.col("id")]
    args = (skewed, keys, order, "rank", "ts", "n")
    assert bag(skew.rank_in_group(*args, min_rows=min_rows)) == bag(skew.rank_in_group(*args))


def test_rank_spreads_a_heavy_group(spark, skewed):
    """The heavy group's rows sit in several partitions, and every rank occurs once."""
    ranked = skew.rank_in_group(skewed, [], [F.col("id")], "rank", min_rows=10)
    parts = ranked.groupBy(F.spark_partition_id()).count().collect()
    assert len(parts) > 1
    ranks = [row["rank"] for row in ranked.orderBy("id").collect()]
    assert ranks == list(range(1, 3001))


def test_group_count(skewed):
    args = (skewed, "user", "ts", "n")
    assert bag(splits.with_group_count(*args, min_rows=100)) == bag(splits.with_group_count(*args))


@pytest.mark.parametrize("how", ["inner", "left"])
def test_lookup(spark, skewed, how):
    table = spark.range(30).select(F.col("id").alias("user"), (F.col("id") * 2).alias("twice"))
    plain = skew.lookup_join(skewed, table, "user", how)
    assert bag(skew.lookup_join(skewed, table, "user", how, min_rows=50)) == bag(plain)


@pytest.mark.parametrize("newest_left", [True, False])
def test_chrono_split(skewed, newest_left):
    options = {"tiebreak": ["id"], "newest_left": newest_left}
    plain = splits.chrono_side(skewed, 0.75, **options)
    assert bag(splits.chrono_side(skewed, 0.75, min_rows=100, **options)) == bag(plain)


def test_user_ratio_split(skewed):
    plain = splits.user_ratio_split(skewed, 0.8, key=["id"])
    split = splits.user_ratio_split(skewed, 0.8, key=["id"], min_rows=100)
    assert [bag(side) for side in split] == [bag(side) for side in plain]


def test_index(skewed):
    plain = indexing.index_column(skewed, "user", "user_index")
    assert bag(indexing.index_column(skewed, "user", "user_index", min_rows=5)) == bag(plain)


@pytest.mark.parametrize("parts", [1, 4])
def test_label_lists_have_one_shape(skewed, parts):
    expected = {(row["user"], row["item"]) for row in skewed.collect() if row["user"] is not None}
    lists = label_lists(skewed, parts=parts).collect()
    assert {row["part"] for row in lists} == set(range(parts))
    assert len(lists) == len({(row["user"], row["part"]) for row in lists})
    found = [(row["user"], item) for row in lists for item in row["labels"]]
    assert len(found) == len(set(found)) and set(found) == expected


@pytest.mark.parametrize("limit", [1, 3])
def test_more_heavy_keys_than_the_list_holds(spark, skewed, monkeypatch, limit):
    """Then every row is ranked by sorting, and no task holds a group."""
    order = [F.col("ts").desc(), F.col("id")]
    plain = bag(skew.rank_in_group(skewed, ["user"], order, "rank", "ts", "n"))
    counted = bag(splits.with_group_count(skewed, "user", "ts", "n"))
    monkeypatch.setattr(skew, "HEAVY_LIMIT", limit)
    stored, real = [], skew.materialise
    monkeypatch.setattr(skew, "materialise", lambda df, name: stored.append(real(df, name)) or stored[-1])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    ranked = skew.rank_in_group(skewed, ["user"], order, "rank", "ts", "n", min_rows=20)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert bag(ranked) == plain
    assert bag(splits.with_group_count(skewed, "user", "ts", "n", min_rows=20)) == counted
    assert bag(indexing.index_column(skewed, "user", "i", min_rows=5)) == bag(indexing.index_column(skewed, "user", "i"))
    sizes = [row["count"] for row in stored[0].groupBy(F.input_file_name()).count().collect()]
    assert sum(sizes) == 3000 and max(sizes) < 1000  # key 1 alone has a third of all rows


def test_heavy_is_absolute(spark):
    """A key does not get lighter because the table grows."""
    rows = spark.range(200_000).select(F.when(F.col("id") < 30, -1).otherwise(F.col("id")).alias("key"))
    assert [row["key"] for row in skew.heavy_keys(rows, ["key"], 20)] == [-1]


def test_null_labels_stay_where_they_are(spark):
    rows = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.col("id") % 5).alias("item"), "id")
    found = indexing.index_column(rows, "item", "i")
    assert found.count() == 3000 and found.filter("item IS NULL").select("i").distinct().collect()[0][0] == 5


def test_splits_without_a_tiebreak_do_not_depend_on_the_partitioning(spark):
    rows = spark.range(600).select((F.col("id") % 3).alias("user"), F.lit(1).alias("item"), F.lit(7).alias("ts"), (F.col("id") % 9).alias("more"))
    for split in (splits.chrono_split, splits.user_ratio_split):
        sides = [[bag(side) for side in split(df)] for df in (rows, rows.repartition(7), rows.orderBy(F.desc("id")).coalesce(1))]
        assert sides[0] == sides[1] == sides[2]


def brute_force(points):
    good = pairs = 0
    for rows in points.values():
        for (r, p), (s, q) in itertools.combinations(rows, 2):
            if r != s:
                pairs += 1
                good += (r > s and p > q) or (r < s and p < q)
    return good, pairs


@pytest.mark.parametrize("min_rows,limit", [(5, 3), (5, 10_000), (25, 10_000), (1000, 10_000)])
def test_fcp_strips(skewed, monkeypatch, min_rows, limit):
    monkeypatch.setattr(pairs, "HEAVY_LIMIT", limit)
    scored = skewed.withColumn("prediction", (F.col("item") % 7).cast("double")).withColumnRenamed("rating", "label")
    means = scored.dropna(subset=["user"]).groupBy("user", "item").agg(F.avg("label"), F.avg("prediction")).collect()
    points = {}
    for row in means:
        points.setdefault(row[0], []).append((row[2], row[3]))
    good, expected = brute_force(points)
    found = fcp(scored, min_rows=min_rows).first()
    assert found["n_pairs"] == expected
    assert found["fcp"] == pytest.approx(good / expected)


def test_fcp_without_pairs(spark):
    one = spark.createDataFrame([(1, 1, 2.0, 3.0)], "user int, item int, label double, prediction double")
    assert fcp(one).first()["fcp"] is None


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 6), st.integers(0, 6), st.integers(1, 4)), max_size=60))
def test_concordant_pairs(rows):
    expected = sum(
        w * v
        for (g, a, b, w), (h, c, d, v) in itertools.permutations(rows, 2)
        if g == h and a > c and b > d
    )
    columns = np.array(rows, dtype=np.int64).reshape(-1, 4).T
    assert concordant(columns[0], columns[1].astype(float), columns[2].astype(float), columns[3]) == expected


def test_fcp_tasks_do_not_grow_with_the_table(spark, monkeypatch):
    """Users are dealt to as many tasks as the rows ask for, by one shuffle, and the plan does not coalesce them."""
    monkeypatch.setattr(pairs, "TASK_ROWS", 50)
    rows = [(u, i, float((u * i) % 5), float(i % 7)) for u in range(40) for i in range(30)]
    scored = spark.createDataFrame(rows, "user int, item int, label double, prediction double")
    placed, counted = [], pairs._counted
    monkeypatch.setattr(pairs, "_counted", lambda df: placed.append(df) or counted(df))
    found = fcp(scored).first()
    assert [df.rdd.getNumPartitions() for df in placed] == [len(rows) // 50]
    assert placed[0]._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1].count("Exchange") == 1
    points = {}
    for u, _, label, prediction in rows:
        points.setdefault(u, []).append((label, prediction))
    assert (round(found["fcp"] * int(found["n_pairs"])), found["n_pairs"]) == brute_force(points)
