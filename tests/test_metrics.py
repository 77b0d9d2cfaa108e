"""Ranking metrics against Spark's evaluator, and against their bounds."""

import math

import pytest
from pyspark.ml.evaluation import RankingEvaluator
from pyspark.sql import functions as F

from recmill.functions import metrics as M
from recmill.operators.recommend import popularity, recommend_popular


@pytest.fixture(scope="module")
def ratings(spark):
    return spark.range(2000).select(
        (F.col("id") % 23).cast("int").alias("user"), F.pmod(F.xxhash64("id"), F.lit(41)).cast("int").alias("item")
    ).cache()


@pytest.fixture(scope="module")
def recs(ratings):
    return recommend_popular(ratings.select("user").distinct(), popularity(ratings), 10).cache()


@pytest.mark.parametrize("k", [1, 3, 10])
def test_spark_agrees(ratings, recs, k):
    held = ratings.filter(F.pmod(F.xxhash64("item"), F.lit(3)) == 0)
    frame = M.ranking_frame(recs, held, 10)
    labels = M.label_lists(held).select("user", F.col("labels").cast("array<double>").alias("label"))
    lists = recs.select("user", F.slice("recommendations.itemId", 1, k).cast("array<double>").alias("prediction"))
    both = lists.join(labels, "user").cache()
    found = {r["metric"]: r["value"] for r in M.ranking_metrics(frame, k).collect()}
    for ours, theirs in (("ndcgAt", "ndcgAtK"), ("recallAtK", "recallAtK"), ("map", "meanAveragePrecision")):
        expected = RankingEvaluator(k=k, metricName=theirs).evaluate(both)
        assert found[ours] == pytest.approx(expected), ours
    assert all(0 <= value <= 1 for value in found.values())


def test_one_list_by_hand(spark):
    recs = spark.createDataFrame([(1, [(7, 3.0), (8, 2.0), (7, 1.5), (9, 1.0)]), (2, [(7, 1.0)])],
                                 "user int, recommendations array<struct<itemId:int,rating:float>>")
    truth = spark.createDataFrame([(1, 8), (1, 8), (1, 9), (1, 5), (3, 1)], "user int, item int")
    frame = M.ranking_frame(recs, truth, 3)
    row = frame.first()
    assert frame.count() == 1
    assert (row["prediction"], row["hits"], row["n_labels"]) == ([7, 8, 9], [2, 3], 3)
    assert M.mrr(frame, 3).first()[0] == 0.5
    assert M.recall_at(frame, 2).first()[0] == pytest.approx(1 / 3)
    assert M.mean_average_precision(frame, 3).first()[0] == pytest.approx((1 / 2 + 2 / 3) / 3)
    ideal = 1 + 1 / math.log2(3) + 1 / 2
    assert M.ndcg_at(frame, 3).first()[0] == pytest.approx((1 / math.log2(3) + 1 / 2) / ideal)


def test_perfect_ranking(spark):
    recs = spark.createDataFrame([(1, [(7, 3.0), (8, 2.0)])], "user int, recommendations array<struct<itemId:int,rating:float>>")
    truth = spark.createDataFrame([(1, 8), (1, 7), (1, 9)], "user int, item int")
    assert M.ndcg_at(M.ranking_frame(recs, truth, 2), 2).first()[0] == 1.0


def test_rmse(spark):
    df = spark.createDataFrame([(1, 2.0), (3, 3.0)], "rating int, prediction double")
    assert M.rmse(df).first()["rmse"] == pytest.approx(math.sqrt(0.5))
