"""The end-to-end workflows, composed from the operators."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recmill.functions.columns import first_entity, join_lines, select_columns
from recmill.functions.metrics import RANKING_METRICS, ranking_frame, ranking_metrics, rmse
from recmill.operators.enrich import Step, explode_urls, first_score, sentiment
from recmill.operators.indexing import index_column
from recmill.operators.model import (
    als_explicit,
    als_implicit,
    blocked,
    fit_als,
    grid_metrics,
    grid_search_cv,
    log_metrics,
    one_per_pair,
    recommend_all,
    run_params,
    save_model,
    score,
)
from recmill.operators.prep import clean_activity, to_ratings
from recmill.operators.recommend import recommend_active, recommend_active_popular
from recmill.operators.serving import publish_upsert, serving_documents
from recmill.operators.splits import chrono_split, hash_split
from recmill.sources.scratch import materialise
from recmill.sources.steps import write_step

# The regularisation grid.
REG_PARAMS = (1.0, 0.1, 0.01, 0.001)


@dataclass
class ExplicitRun:
    grid: DataFrame
    rmse: float
    version: int
    train: DataFrame
    test: DataFrame
    runs: DataFrame | None = None


def explicit_workflow(
    ratings: DataFrame,
    key: Sequence[str],
    serving_path: str,
    k: int = 10,
    reg_params: Sequence[float] = REG_PARAMS,
    dedupe: bool = False,
    store: str | None = None,
) -> ExplicitRun:
    """Movie ratings: index, split, search the regularisation, judge, publish top-k.

    ``ratings`` has (user, item, rating, ts) with any label type; the indexes are
    built on all rows, before the split. Under ``store`` both splits, the best model and
    the log of all runs are kept (train, test, model, runs).
    """
    spark = ratings.sparkSession
    indexed = ratings
    for col in ("user", "item"):
        indexed = index_column(indexed, col, f"{col}_index")
    indexed = materialise(indexed, "indexed")
    train, test = hash_split(indexed, key)
    if store is not None:
        train, test = write_step(train, f"{store}/train"), write_step(test, f"{store}/test")
    sides = train, test
    als = blocked(als_explicit("user_index", "item_index", "rating"))
    grid = ParamGridBuilder().addGrid(als.regParam, list(reg_params)).build()
    evaluator = RegressionEvaluator(metricName="rmse", labelCol="rating", predictionCol="prediction")
    if dedupe:
        train, key = materialise(one_per_pair(train, als), "train"), ["user_index", "item_index"]
    search = grid_search_cv(train, als, grid, evaluator, key)
    error = rmse(score(search.bestModel, test)).first()["rmse"]
    documents = serving_documents(recommend_all(search.bestModel, k), "user_index")
    version = publish_upsert(spark, serving_path, documents)
    runs = None
    if store is not None:
        save_model(search.bestModel, f"{store}/model")
        for i, (point, value) in enumerate(zip(grid, search.avgMetrics)):
            log_metrics(spark, f"run-{i}", run_params(als.copy(point)), {"rmse": value}, f"{store}/runs")
        runs = spark.read.parquet(f"{store}/runs")
    return ExplicitRun(grid_metrics(spark, search), error, version, *sides, runs)


@dataclass
class ImplicitRun:
    rmse: DataFrame
    metrics: DataFrame
    recommendations: DataFrame


def implicit_workflow(
    log: DataFrame,
    roles: Mapping[str, str],
    drop: Mapping[str, Sequence],
    above: Mapping[str, float],
    t,
    k: int = 10,
    generate: int = 5,
    cut: int = 3,
    dedupe: bool = False,
) -> ImplicitRun:
    """News log: clean, index, fit on dwell time, judge, recommend what is still active.

    ``roles`` names the log's user, item, rating and ts columns.
    """
    ratings = to_ratings(clean_activity(log, drop, above), **roles)
    for col in ("user", "item"):
        ratings = index_column(ratings.withColumnRenamed(col, "_label"), "_label", col).drop("_label")
    ratings = materialise(ratings, "ratings")
    model = fit_als(als_implicit(), ratings, dedupe)
    scored = score(model, ratings)
    frame = ranking_frame(recommend_all(model, generate), ratings, generate)
    metrics = ranking_metrics(frame, cut, RANKING_METRICS, scored.withColumnRenamed("rating", "label"))
    return ImplicitRun(rmse(scored), metrics, recommend_active(model, ratings, t, k))


def popular_active_workflow(
    ratings: DataFrame,
    drop: Mapping[str, Sequence],
    above: Mapping[str, float],
    t,
    k: int = 5,
    tiebreak: Sequence[str] = ("event_id",),
) -> DataFrame:
    """Clean, keep the newest share per user, and recommend its most used active items."""
    kept, _ = chrono_split(clean_activity(ratings, drop, above), tiebreak=tiebreak)
    return recommend_active_popular(kept, t, k)


def enrichment_steps(
    search: Callable[[SparkSession], DataFrame],
    entities: Callable[[DataFrame], DataFrame],
    ocr: Callable[[DataFrame], DataFrame],
    lexicon: Mapping[str, float],
) -> list[Step]:
    """The five steps from a search to (url, firstCeleb, text, sentimentScore).

    ``search`` adds an ``images`` response, ``entities`` a ``celebs`` response and
    ``ocr`` an ``ocr`` response; each is any provider of that shape.
    """
    return [
        ("url", lambda spark, _: explode_urls(search(spark), "images")),
        ("celeb", lambda _, df: first_entity(entities(df), "celebs.result.celebrities", "firstCeleb").drop("celebs")),
        ("text", lambda _, df: join_lines(ocr(df), "ocr.recognitionResult.lines", "text").drop("ocr")),
        ("sentiment", lambda _, df: first_score(sentiment(df, "text", lexicon))),
        ("output", lambda _, df: select_columns(df, ["url", "firstCeleb", "text", "sentimentScore"])),
    ]


def lines_response(text: str, out: str = "ocr") -> Callable[[DataFrame], DataFrame]:
    """A provider that reads a text column as recognised lines."""
    lines = F.transform(F.split(F.col(text), "\n"), lambda line: F.struct(line.alias("text")))
    return lambda df: df.withColumn(
        out, F.when(F.col(text).isNotNull(), F.struct(F.struct(lines.alias("lines")).alias("recognitionResult")))
    )
