"""Matrix factorisation: training, scoring, model search, run metrics, persistence."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.ml import Model, Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recmill.functions.metrics import RANKING_METRICS, ranking_frame, ranking_metrics
from recmill.operators.indexing import apply_index, heavy_labels, label_index
from recmill.operators.recommend import BLOCK_FLOATS, packed, recommend_active, recommend_all
from recmill.operators.splits import fold_column, user_ratio_split
from recmill.sources.scratch import checkpoint_root, materialise

SEED = 42
BLOCKS = 10  # factor blocks unless the caller sets them; about one per two million ratings keeps tasks small
ITEM_BLOCKS = 6  # item blocks where nobody asks for a count, to ``BLOCKS`` user blocks: users' factors are sent to each of them in every iteration
FEW_FACTORS = 200_000  # users and items, together, that rows to be scored meet by joins
SCORE_BLOCKS = 8  # blocks of users, and of items, that rows to be scored are dealt to beyond it


def als_explicit(user: str = "user", item: str = "item", rating: str = "rating", **params) -> ALS:
    """Explicit feedback: five iterations unless given; unknown pairs are dropped."""
    settings = {"maxIter": 5, "coldStartStrategy": "drop", "seed": SEED, **params}
    return ALS(userCol=user, itemCol=item, ratingCol=rating, **settings)


def als_implicit(user: str = "user", item: str = "item", rating: str = "rating", **params) -> ALS:
    """Implicit feedback: ``rating`` is the strength of interest, such as dwell time."""
    settings = {"implicitPrefs": True, "coldStartStrategy": "drop", "seed": SEED, **params}
    return ALS(userCol=user, itemCol=item, ratingCol=rating, **settings)


def one_per_pair(df: DataFrame, als: ALS) -> DataFrame:
    """One rating per (user, item): the sum for implicit feedback, else the mean.

    It bounds what the solver holds for a user by the catalogue instead of by the
    user's activity, whichever share of the log that is.
    """
    user, item, rating = als.getUserCol(), als.getItemCol(), als.getRatingCol()
    merge = F.sum if als.getImplicitPrefs() else F.avg
    return df.groupBy(user, item).agg(merge(rating).cast("float").alias(rating))


def blocked(als: ALS, blocks: int = BLOCKS) -> ALS:
    """The estimator with ``blocks`` user and item blocks, unless it has counts of its own.

    The count is a parameter and part of the model, as the seed is: it does not follow
    the machine or the number of rows, so the same call gives the same model anywhere.
    Raise it with the data; :func:`run_params` puts it into the run log.
    """
    if als.isSet("numUserBlocks") or als.isSet("numItemBlocks"):
        return als
    return als.copy().setNumBlocks(blocks)


def _sparing(als: ALS, blocks: int) -> ALS:
    """:func:`blocked`, with ``ITEM_BLOCKS`` item blocks to ``BLOCKS`` user blocks, and all blocks on disk, unless set.

    The solver starts from user factors drawn by user block and replaces the item factors before it reads them, so
    the count of item blocks only says how often users' factors are sent: the model is the same but for rounding.
    A task that builds a block holds its ratings about four times over, outside the memory that Spark counts. Blocks
    kept in memory would leave no room for that, and every iteration reads them once, in order.
    """
    own = als.isSet("numUserBlocks") or als.isSet("numItemBlocks")
    als = als.copy() if own else blocked(als, blocks).setNumItemBlocks(-(-blocks * ITEM_BLOCKS // BLOCKS))
    return als if als.isSet("intermediateStorageLevel") else als.setIntermediateStorageLevel("DISK_ONLY")


def run_params(als: ALS) -> dict[str, object]:
    """What a run log should hold of an estimator."""
    names = ("rank", "maxIter", "regParam", "alpha", "implicitPrefs", "seed", "numUserBlocks", "numItemBlocks")
    return {name: als.getOrDefault(name) for name in names}


def fit_als(als: ALS, df: DataFrame, dedupe: bool = False, blocks: int = BLOCKS) -> ALSModel:
    """Fit, with the checkpoint folder in place so that long runs cut their lineage."""
    checkpoint_root(df.sparkSession)
    train = materialise(one_per_pair(df, als), "train") if dedupe else df
    return _sparing(als, blocks).fit(train)


def score(model: ALSModel, pairs: DataFrame) -> DataFrame:
    """Predictions for (user, item) rows; pairs with an unknown side drop out.

    Rows meet small factor tables by join. Of larger ones, rows with int ids are dealt to blocks
    of users and items, whose factors travel once per block of the other side, and not with every row.
    """
    ids = (model.getUserCol(), model.getItemCol())
    plain = len(set(pairs.columns)) < len(pairs.columns) or any(pairs.schema[c].dataType != T.IntegerType() for c in ids)
    if plain or model.userFactors.count() + model.itemFactors.count() <= FEW_FACTORS:
        return model.transform(pairs)
    scored = _scored_in_blocks(model, pairs)
    drop = model.getColdStartStrategy() == "drop"
    return scored.filter(~F.isnan(model.getPredictionCol())) if drop else scored


def _scored_in_blocks(model: ALSModel, pairs: DataFrame) -> DataFrame:
    """``pairs`` with their products of factors, NaN where a side is unknown.

    A task takes the factors of a block of users and a block of items, and then the rows that fall
    between them batch by batch, so that a hot user or item asks for time and not for memory.
    """
    rank = model.rank
    least = [-(-side.count() * rank // BLOCK_FLOATS) for side in (model.userFactors, model.itemFactors)]
    n_users, n_items = (max(SCORE_BLOCKS, n) for n in least)

    def own(ids, n: int):
        return F.pmod(F.xxhash64(ids), F.lit(n)).cast("int")

    def sent(side: DataFrame, n: int, kind: int, n_other: int, block) -> DataFrame:
        parts = side.select(own(F.col("id"), n).alias("_own"), "id", "features")
        parts = parts.mapInArrow(packed(rank), "_own int, ids binary, factors binary")
        parts = parts.withColumn("_other", F.explode(F.sequence(F.lit(0), F.lit(n_other - 1))))
        nothing = F.lit(None).cast(pairs.schema).alias("row")
        return parts.select((block * 3 + kind).alias("place"), "ids", "factors", nothing)

    def given(name: str):  # as the joins do
        return F.coalesce(F.col(name), F.raise_error(F.lit(f"{name} Ids MUST NOT be Null")))

    user, item = given(model.getUserCol()), given(model.getItemCol())
    rows = pairs.select(
        ((own(user, n_users) * n_items + own(item, n_items)) * 3 + 2).alias("place"),
        F.lit(None).cast("binary").alias("ids"),
        F.lit(None).cast("binary").alias("factors"),
        F.struct(*[F.col(f"`{c}`") for c in pairs.columns]).alias("row"),
    )
    met = sent(model.userFactors, n_users, 0, n_items, F.col("_own") * n_items + F.col("_other"))
    met = met.unionByName(sent(model.itemFactors, n_items, 1, n_users, F.col("_other") * n_items + F.col("_own")))
    met = met.unionByName(rows).repartitionById(n_users * n_items, F.floor(F.col("place") / 3).cast("int"))
    met = met.sortWithinPartitions("place")  # one number for block and kind, which Spark sorts by its digits
    places = [pairs.columns.index(c) for c in (model.getUserCol(), model.getItemCol())]
    schema = T.StructType([*pairs.schema.fields, T.StructField(model.getPredictionCol(), T.FloatType())])
    return met.mapInArrow(_pair_scorer(rank, places, schema.names), schema)


def _pair_scorer(rank: int, places: Sequence[int], names: Sequence[str]):
    """Scores rows that come, block by block, after the packed factors of the block's users and items."""

    def sorted_side(parts: list[tuple[bytes, bytes]]) -> tuple[np.ndarray, np.ndarray]:
        ids = np.frombuffer(b"".join(part[0] for part in parts), np.int32)
        factors = np.frombuffer(b"".join(part[1] for part in parts), np.float32).reshape(-1, rank)
        order = np.argsort(ids)
        return ids[order], factors[order]

    def gathered(side: tuple[np.ndarray, np.ndarray], column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Factors of each id, and whether there are any."""
        (ids, factors), asked = side, column.to_numpy()
        if not len(ids):
            return np.zeros((len(asked), rank), np.float32), np.zeros(len(asked), bool)
        at = np.minimum(np.searchsorted(ids, asked), len(ids) - 1)
        return factors[at], ids[at] == asked

    def score_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, parts, sides = None, ([], []), None
        for batch in batches:
            if not batch.num_rows:
                continue
            blocks, kinds = np.divmod(batch.column("place").to_numpy(), 3)
            edges = np.flatnonzero(np.diff(batch.column("place").to_numpy())) + 1
            for start, end in zip(np.r_[0, edges], np.r_[edges, batch.num_rows]):
                run = batch.slice(start, end - start)
                if blocks[start] != block:
                    block, parts, sides = blocks[start], ([], []), None
                if kinds[start] < 2:
                    parts[kinds[start]].extend(zip(*(run.column(name).to_pylist() for name in ("ids", "factors"))))
                    continue
                if sides is None:
                    sides, parts = [sorted_side(part) for part in parts], ([], [])
                columns = run.column("row").flatten()
                (users, known), (items, named) = (gathered(side, columns[at]) for side, at in zip(sides, places))
                found = np.zeros(run.num_rows, np.float32)
                for r in range(rank):
                    found += users[:, r] * items[:, r]
                found[~(known & named)] = np.nan
                yield pa.RecordBatch.from_arrays([*columns, pa.array(found, from_pandas=False)], list(names))

    return score_rows


def recommend(history: DataFrame, t, k: int, als: ALS | None = None, dedupe: bool = False, **cols) -> DataFrame:
    """Train on the history, then recommend the items active after ``t``."""
    names = {role: cols[role] for role in ("user", "item") if role in cols}
    als = als or als_implicit(**names)
    return recommend_active(fit_als(als, history, dedupe), history, t, k, **cols)


def ranking_adapter(als: ALS, ratings: DataFrame, k: int = 5, dedupe: bool = False) -> DataFrame:
    """Fit, recommend ``k`` items to every user, and set them against the user's own items."""
    model = fit_als(als, ratings, dedupe)
    return ranking_frame(recommend_all(model, k), ratings, k, als.getUserCol(), als.getItemCol())


@dataclass
class IndexedALS:
    """Two label indexes and a fitted factor model, applied in that order.

    The indexes are tables, so a catalogue or user base of any size is indexed
    without passing through the driver.
    """

    user_index: DataFrame
    item_index: DataFrame
    model: ALSModel
    user: str
    item: str
    train: DataFrame | None = None  # the indexed rows it was fitted on, stored

    @classmethod
    def fit(
        cls, df: DataFrame, als: ALS, user: str, item: str, labels: DataFrame | None = None, dedupe: bool = False
    ) -> IndexedALS:
        """``als`` reads the index columns; ``labels`` may name a wider table to index."""
        indexes = [materialise(label_index(df if labels is None else labels, col), col) for col in (user, item)]
        heavy = [None, None] if labels is not None else [heavy_labels(i, col) for i, col in zip(indexes, (user, item))]
        fitted = cls(*indexes, None, user, item)
        fitted.train = materialise(fitted._indexed(df, als, heavy), "indexed")
        fitted.model = fit_als(als, fitted.train, dedupe)
        return fitted

    def _indexed(self, df: DataFrame, names, heavy=(None, None)) -> DataFrame:
        """``df`` with the index columns under the names ``names`` reads them by."""
        df = apply_index(df, self.user_index, self.user, names.getUserCol(), heavy=heavy[0])
        return apply_index(df, self.item_index, self.item, names.getItemCol(), heavy=heavy[1])

    def transform(self, df: DataFrame) -> DataFrame:
        return score(self.model, self._indexed(df, self.model))

    def recommend_all(self, k: int) -> DataFrame:
        return recommend_all(self.model, k)

    def save(self, path: str) -> None:
        self.user_index.write.mode("overwrite").parquet(f"{path}/users")
        self.item_index.write.mode("overwrite").parquet(f"{path}/items")
        save_model(self.model, f"{path}/model")

    @classmethod
    def load(cls, spark: SparkSession, path: str, user: str, item: str) -> IndexedALS:
        read = spark.read.parquet
        return cls(read(f"{path}/users"), read(f"{path}/items"), ALSModel.load(f"{path}/model"), user, item)


class _Saved(MLReadable, MLWritable):
    """A stage that is saved as its metadata and what ``_save`` adds, and made again by ``_restore``.

    Spark's pipelines and searches find the class by the metadata's name for it.
    """

    @property
    def _to_java(self):
        raise AttributeError("there is no JVM stage of this kind")

    def write(self) -> MLWriter:
        return _StageWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _StageReader(cls)


class _StageWriter(MLWriter):
    def __init__(self, stage: _Saved):
        super().__init__()
        self._stage = stage

    def saveImpl(self, path: str) -> None:
        extra = self._stage._save(self.sparkSession, path)
        DefaultParamsWriter.saveMetadata(self._stage, path, self.sparkSession, extra, {})


class _StageReader(MLReader):
    def __init__(self, cls: type):
        super().__init__()
        self._cls = cls

    def load(self, path: str):
        spark = self.sparkSession
        metadata = DefaultParamsReader.loadMetadata(path, spark)
        return self._cls._restore(spark, path, metadata)._resetUid(metadata["uid"])


class IndexedALSEstimator(_Saved, Pipeline):
    """:class:`IndexedALS` as one estimator, for pipelines and grid searches over ``als``'s parameters."""

    def __init__(self, als: ALS, user: str, item: str, labels: DataFrame | None = None, dedupe: bool = False):
        super().__init__(stages=[als])
        self.user, self.item, self.labels, self.dedupe = user, item, labels, dedupe

    @property
    def als(self) -> ALS:
        return self.getStages()[0]

    def _fit(self, dataset: DataFrame) -> IndexedALSModel:
        return IndexedALSModel(IndexedALS.fit(dataset, self.als, self.user, self.item, self.labels, self.dedupe))

    def _save(self, spark: SparkSession, path: str) -> dict:
        self.als.write().save(f"{path}/als")
        if self.labels is not None:
            self.labels.write.parquet(f"{path}/labels")
        return {"user": self.user, "item": self.item, "dedupe": self.dedupe, "labelled": self.labels is not None}

    @classmethod
    def _restore(cls, spark: SparkSession, path: str, metadata: dict) -> IndexedALSEstimator:
        labels = spark.read.parquet(f"{path}/labels") if metadata["labelled"] else None
        return cls(ALS.load(f"{path}/als"), metadata["user"], metadata["item"], labels, metadata["dedupe"])


class IndexedALSModel(_Saved, Model):
    """A fitted :class:`IndexedALS` as a transformer; it is saved with its index tables."""

    def __init__(self, fitted: IndexedALS):
        super().__init__()
        self.fitted = fitted

    def copy(self, extra=None) -> IndexedALSModel:
        return IndexedALSModel(self.fitted)._resetUid(self.uid)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return self.fitted.transform(dataset)

    def _save(self, spark: SparkSession, path: str) -> dict:
        self.fitted.save(f"{path}/fitted")
        return {"user": self.fitted.user, "item": self.fitted.item}

    @classmethod
    def _restore(cls, spark: SparkSession, path: str, metadata: dict) -> IndexedALSModel:
        return cls(IndexedALS.load(spark, f"{path}/fitted", metadata["user"], metadata["item"]))


def save_model(model: ALSModel | PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str, kind: type = ALSModel):
    return kind.load(path)


def grid_search_cv(
    df: DataFrame,
    estimator,
    grid: Sequence[Mapping],
    evaluator: RegressionEvaluator,
    key: Sequence[str],
    k: int = 3,
    seed: int = SEED,
    parallelism: int = 4,
) -> CrossValidatorModel:
    """Cross-validated grid search; each row's fold follows from its key."""
    checkpoint_root(df.sparkSession)
    search = CrossValidator(
        estimator=blocked(estimator) if isinstance(estimator, ALS) else estimator,
        estimatorParamMaps=list(grid),
        evaluator=evaluator,
        numFolds=k,
        foldCol="_fold",
        parallelism=parallelism,
    )
    return search.fit(fold_column(df, key, k, seed, "_fold"))


METRICS_SCHEMA = "run_id int, param string, param_value string, metric string, value double"


def _metric_rows(run: int, point: Mapping, found: Mapping[str, float]) -> list[tuple]:
    """A row for every parameter and metric of a run; values may be texts."""
    return [
        (run, param.name, str(setting), metric, None if value is None else float(value))
        for param, setting in point.items()
        for metric, value in found.items()
    ]


def grid_metrics(spark: SparkSession, cv_model: CrossValidatorModel) -> DataFrame:
    """(run_id, param, param_value, metric, value): the fold average, once per parameter of a grid point."""
    metric = cv_model.getEvaluator().getMetricName()
    points = zip(cv_model.getEstimatorParamMaps(), cv_model.avgMetrics)
    rows = [row for i, (point, value) in enumerate(points) for row in _metric_rows(i, point, {metric: value})]
    return spark.createDataFrame(rows, METRICS_SCHEMA)


@dataclass
class RankingSearch:
    """Outcome of :func:`grid_search_ranking`."""

    metrics: DataFrame  # (run_id, param, param_value, metric, value), every metric and parameter of every point
    validation: list[float]  # the chosen metric per grid point
    best: int
    model: ALSModel  # refitted on all rows with the best point
    train: DataFrame
    valid: DataFrame


def grid_search_ranking(
    df: DataFrame,
    als: ALS,
    grid: Sequence[Mapping],
    metric: str = "ndcgAt",
    k: int = 3,
    generate: int = 5,
    ratio: float = 0.8,
    seed: int = SEED,
    key: Sequence[str] | None = None,
    dedupe: bool = False,
    parallelism: int = 4,
) -> RankingSearch:
    """Search by a ranking metric on a per-user split.

    Every point is trained on ``ratio`` of each user's rows, recommends
    ``generate`` items and is judged on the first ``k`` against the other rows.
    ``parallelism`` points run at a time, each in a scheduler pool of its own, so that a fair
    scheduler shares the cores between them; the outcome does not depend on it.
    """
    spark = df.sparkSession
    user, item, rating = als.getUserCol(), als.getItemCol(), als.getRatingCol()
    train, valid = user_ratio_split(df, ratio, user, item, seed, key)
    train = one_per_pair(train, als) if dedupe else train
    train, valid = materialise(train, "train"), materialise(valid, "valid")
    checkpoint_root(spark)  # before threads ask for it

    def judged(numbered: tuple[int, Mapping]) -> dict[str, float]:
        i, point = numbered
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"point-{i}")
        model = fit_als(als.copy(point), train)
        frame = ranking_frame(recommend_all(model, generate), valid, generate, user, item)
        scored = score(model, valid).select(
            F.col(user).alias("user"), F.col(item).alias("item"), F.col(rating).alias("label"), "prediction"
        )
        return {r["metric"]: r["value"] for r in ranking_metrics(frame, k, RANKING_METRICS, scored).collect()}

    with ThreadPoolExecutor(parallelism) as pool:
        tries = [pool.submit(inheritable_thread_target(spark)(judged), x) for x in enumerate(grid)]
        found = [t.result() for t in tries]
    validation = [f[metric] for f in found]
    rows = [row for i, (point, f) in enumerate(zip(grid, found)) for row in _metric_rows(i, point, f)]
    best = max(range(len(validation)), key=lambda i: (validation[i] is not None, validation[i] or 0.0, -i))
    model = fit_als(als.copy(grid[best]), df, dedupe)
    return RankingSearch(spark.createDataFrame(rows, METRICS_SCHEMA), validation, best, model, train, valid)


def log_metrics(
    spark: SparkSession,
    run_id: str,
    params: Mapping[str, object],
    metrics: Mapping[str, float],
    path: str | None = None,
) -> DataFrame:
    """One row per metric of a run, appended to the table at ``path`` if given."""
    text = {name: str(value) for name, value in params.items()}
    rows = [(run_id, text, name, float(value)) for name, value in metrics.items()]
    df = spark.createDataFrame(rows, "run_id string, params map<string,string>, metric string, value double")
    if path is not None:
        df.coalesce(1).write.mode("append").parquet(path)
    return df
