"""Factor models: scoring, active-subset recommendation, search, persistence."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import SQLTransformer
from pyspark.ml.tuning import CrossValidatorModel, ParamGridBuilder
from pyspark.sql import functions as F

from fixtures import typed_rows
from recmill.operators import model as L
from recmill.operators import recommend as R
from recmill.plans import workflows as W


@pytest.fixture(scope="module")
def ratings(spark):
    return spark.range(4000).select(
        F.col("id"),
        (F.col("id") % 47).cast("int").alias("user"),
        F.pmod(F.xxhash64("id"), F.lit(101)).cast("int").alias("item"),
        (F.pmod(F.xxhash64("id", F.lit(2)), F.lit(10)) + 1).cast("float").alias("rating"),
        F.pmod(F.xxhash64("id", F.lit(5)), F.lit(1000)).alias("ts"),
    ).cache()


@pytest.fixture(scope="module")
def model(ratings):
    return L.fit_als(L.als_implicit(rank=4, maxIter=3), ratings, dedupe=True)


def best_by_hand(model, ratings, t, k):
    """Every user-item score, computed pair by pair."""
    users = {r["id"]: r["features"] for r in model.userFactors.collect()}
    items = {r["id"]: r["features"] for r in model.itemFactors.collect()}
    active = {r["item"] for r in ratings.filter(F.col("ts") > t).collect()} & set(items)
    best = {}
    for user, f in users.items():
        scored = [(sum(a * b for a, b in zip(f, items[i])), i) for i in active]
        best[user] = [i for _, i in sorted(scored, key=lambda s: (-s[0], s[1]))][:k]
    return best


@pytest.mark.parametrize("k,block_rows", [(5, R.BLOCK_ROWS), (5, 4), (1000, 13)])
def test_active_subset(model, ratings, k, block_rows):
    expected = best_by_hand(model, ratings, 985, k)
    found = R.recommend_active(model, ratings, 985, k, block_rows=block_rows).collect()
    assert {r["user"]: [e["itemId"] for e in r["recommendations"]] for r in found} == expected
    for row in found:
        scores = [e["rating"] for e in row["recommendations"]]
        assert scores == sorted(scores, reverse=True)


def test_active_subset_scores_are_the_models(model, ratings):
    rows = R.recommend_active(model, ratings, 900, 3).select("user", F.explode("recommendations").alias("e"))
    pairs = rows.select("user", F.col("e.itemId").alias("item"), F.col("e.rating").alias("given"))
    scored = L.score(model, pairs)
    assert scored.filter(F.abs(F.col("given") - F.col("prediction")) > 1e-5).count() == 0


def test_nothing_active(model, ratings):
    assert R.recommend_active(model, ratings, 10_000, 3).count() == 0


def test_unknown_users_and_items_drop_out(spark, model, ratings):
    strangers = spark.createDataFrame([(0, 900, 900, 1.0, 5000), (0, 1, 5, 1.0, 5000)],
                                      "id long, user int, item int, rating float, ts long")
    recs = R.recommend_active(model, strangers, 1000, 3).collect()
    assert [(r["user"], [e["itemId"] for e in r["recommendations"]]) for r in recs] == [(1, [5])]


@pytest.mark.parametrize("block,k", [(8192, 5), (7, 5), (3, 5), (7, 50), (1, 1)])
def test_blocks_of_items_agree(monkeypatch, block, k):
    """Few distinct scores, so that most cuts fall into a tie."""
    monkeypatch.setattr(R, "_BLOCK_ITEMS", block)
    draw = np.random.default_rng(3)
    users, items = (draw.integers(0, 3, (n, 2)).astype(np.float32) for n in (9, 40))
    names = draw.permutation(40).astype(np.int32)
    ids, scores = R._best_items_of(users, names, items, k)
    for user, found, scored in zip(users, ids, scores):
        expected = sorted(zip(-(items @ user), names))[:k]
        assert [(float(-s), int(i)) for s, i in expected] == [(float(s), int(i)) for s, i in zip(scored, found)]


@pytest.mark.parametrize("spread,share", [(2.0, 0.2), (0.0, 1.0)])
def test_norms_bound_the_search(monkeypatch, spread, share):
    """Where norms differ most blocks are skipped, the lists are those of all scores, and equal norms skip none."""
    monkeypatch.setattr(R, "_BLOCK_ITEMS", 50)
    scored = []
    monkeypatch.setattr(R, "_scores", lambda u, i, f=R._scores: scored.append(len(u) * len(i)) or f(u, i))
    draw = np.random.default_rng(8)
    users, items = draw.normal(size=(200, 4)).astype(np.float32), draw.normal(size=(3000, 4)).astype(np.float32)
    items /= np.linalg.norm(items, axis=1, keepdims=True)
    items *= np.exp(spread * draw.normal(size=(3000, 1))).astype(np.float32)
    names = draw.permutation(3000).astype(np.int64)
    ids, best = R._best_items_of(users, names, items, 10)
    whole = users.astype(float) @ items.T.astype(float)
    order = np.argsort(-whole, axis=1)[:, :10]
    assert (ids == names[order]).all()
    assert np.allclose(best, np.take_along_axis(whole, order, 1), rtol=1e-5)
    pairs = len(users) * len(items)
    assert sum(scored) <= share * pairs and (share < 1 or sum(scored) > 0.5 * pairs)


def test_unknown_pairs_are_dropped(spark, model):
    pairs = spark.createDataFrame([(1, 5), (1, 999), (999, 5)], "user int, item int")
    assert L.score(model, pairs).count() == 1


@pytest.mark.parametrize("block_rows", [R.BLOCK_ROWS, 11])
def test_recommend_all_is_spark_s(model, block_rows):
    ours = {r["user"]: [e["rating"] for e in r["recommendations"]] for r in R.recommend_all(model, 7, block_rows).collect()}
    for row in model.recommendForAllUsers(7).collect():
        assert ours.pop(row["user"]) == pytest.approx([e["rating"] for e in row["recommendations"]], abs=1e-6)
    assert not ours


def test_ranking_adapter(ratings):
    frame = L.ranking_adapter(L.als_implicit(rank=3, maxIter=2), ratings, 5, dedupe=True)
    assert frame.count() == 47 and frame.filter("size(prediction) = 5").count() == 47


def test_recommend_all(model):
    recs = R.recommend_all(model, 10)
    assert recs.schema["recommendations"].dataType.simpleString() == "array<struct<itemId:bigint,rating:double>>"
    assert {len(r["recommendations"]) for r in recs.collect()} == {10}


def test_train_then_recommend(ratings):
    recs = L.recommend(ratings, 900, 4, als=L.als_implicit(rank=3, maxIter=2), dedupe=True)
    assert recs.count() == 47


def test_indexed_model_round_trip(spark, ratings, tmp_path):
    named = ratings.select(F.concat(F.lit("u"), "user").alias("user"), F.concat(F.lit("i"), "item").alias("item"), "rating")
    als = L.als_explicit("user_index", "item_index", rank=3, maxIter=2)
    fitted = L.IndexedALS.fit(named, als, "user", "item", dedupe=True)
    fitted.save(str(tmp_path / "model"))
    loaded = L.IndexedALS.load(spark, str(tmp_path / "model"), "user", "item")
    rows = [sorted((r["user"], r["item"], r["prediction"]) for r in m.transform(named).collect()) for m in (fitted, loaded)]
    assert rows[0] == rows[1] and len(rows[0]) == 4000


def test_model_save_overwrites(model, ratings, tmp_path):
    path = str(tmp_path / "als")
    L.save_model(model, path)
    L.save_model(model, path)
    pairs = ratings.select("user", "item").distinct()
    first, second = (sorted(map(tuple, L.score(m, pairs).collect())) for m in (model, L.load_model(path)))
    assert first == second


def test_blocks_are_a_parameter(spark):
    """The same on any machine and at any number of rows, unless the caller says otherwise."""
    assert L.blocked(L.als_explicit()).getNumUserBlocks() == L.BLOCKS == L.blocked(L.als_implicit()).getNumItemBlocks()
    assert L.blocked(L.als_explicit(), 40).getNumItemBlocks() == 40
    assert L.blocked(L.als_explicit(numUserBlocks=3), 40).getNumUserBlocks() == 3
    assert L.run_params(L.blocked(L.als_explicit(), 40))["numUserBlocks"] == 40
    import inspect

    source = inspect.getsource(L)
    assert "defaultParallelism" not in source and ".count()" not in inspect.getsource(L.fit_als)


@pytest.mark.parametrize("kind", [L.als_implicit, L.als_explicit])
def test_item_blocks_are_fewer_and_change_no_model(spark, ratings, kind, monkeypatch):
    """The solver gets fewer item blocks, the factors of both sides are those of as many blocks as users have."""
    pairs, settings = L.one_per_pair(ratings, kind()), dict(rank=4, maxIter=3)
    full = L.fit_als(kind(**settings, numUserBlocks=L.BLOCKS, numItemBlocks=L.BLOCKS), pairs)
    asked, blocked = [], L._sparing
    monkeypatch.setattr(L, "_sparing", lambda *args: asked.append(blocked(*args)) or asked[-1])
    fewer = L.fit_als(kind(**settings), pairs)
    assert (asked[0].getNumUserBlocks(), asked[0].getNumItemBlocks()) == (L.BLOCKS, L.ITEM_BLOCKS)
    assert L.ITEM_BLOCKS < L.BLOCKS and L._sparing(kind(numItemBlocks=7), 10).getNumItemBlocks() == 7
    for side in ("userFactors", "itemFactors"):
        ours, theirs = ({r["id"]: r["features"] for r in getattr(m, side).collect()} for m in (fewer, full))
        assert ours.keys() == theirs.keys() and all(np.allclose(ours[i], theirs[i], atol=1e-4) for i in ours)


def test_solver_leaves_memory_to_the_blocks_it_builds(ratings, model, monkeypatch):
    """Blocks lie on disk unless the caller says otherwise, shrink on both sides with a raised count, and change no model."""
    kept = L._sparing(L.als_implicit(), L.BLOCKS)
    assert kept.getIntermediateStorageLevel() == "DISK_ONLY" and not L.als_implicit().isSet("intermediateStorageLevel")
    assert L._sparing(L.als_implicit(numUserBlocks=3), 10).getIntermediateStorageLevel() == "DISK_ONLY"
    memory = L.als_implicit(intermediateStorageLevel="MEMORY_ONLY")
    assert L._sparing(memory, 10).getIntermediateStorageLevel() == "MEMORY_ONLY"
    raised = L._sparing(L.als_implicit(), 4 * L.BLOCKS)
    assert (raised.getNumUserBlocks(), raised.getNumItemBlocks()) == (4 * L.BLOCKS, 4 * L.ITEM_BLOCKS)
    asked, blocked = [], L._sparing
    monkeypatch.setattr(L, "_sparing", lambda *args: asked.append(blocked(*args)) or asked[-1])
    settings = dict(rank=4, maxIter=3, intermediateStorageLevel="MEMORY_AND_DISK")
    other = L.fit_als(L.als_implicit(**settings), ratings, dedupe=True)
    assert asked[0].getIntermediateStorageLevel() == "MEMORY_AND_DISK"
    for side in ("userFactors", "itemFactors"):
        ours, theirs = ({r["id"]: r["features"] for r in getattr(m, side).collect()} for m in (model, other))
        assert ours.keys() == theirs.keys() and all(np.allclose(ours[i], theirs[i], atol=1e-4) for i in ours)


def test_block_scorer_streams(monkeypatch):
    """Lists leave a block pair some users at a time, whatever order its rows come in, and are those of all scores."""
    monkeypatch.setattr(R, "_BLOCK_USERS", 4)
    monkeypatch.setattr(R, "_NORM_ROWS", 7)
    draw = np.random.default_rng(4)
    users, items = (draw.normal(size=(n, 3)).astype(np.float32) for n in (10, 30))

    def row(is_user, side, start, end):
        ids = np.arange(start, end, dtype=np.int32)
        values = [[0], [0], [is_user], [ids.tobytes()], [side[start:end].tobytes()]]
        return pa.RecordBatch.from_arrays([pa.array(v) for v in values], ["_u", "_i", "is_user", "ids", "factors"])

    rows = [row(False, items, 0, 9), row(True, users, 0, 6), row(False, items, 9, 30), row(True, users, 6, 10)]
    score = R._block_scorer(5, "user", 3)
    found = list(score(iter(rows)))
    assert [batch.num_rows for batch in found] == [4, 4, 2]
    listed = {r["user"]: [e["itemId"] for e in r["recommendations"]] for batch in found for r in batch.to_pylist()}
    assert listed == {u: np.argsort(-(items @ users[u]))[:5].tolist() for u in range(10)}
    assert list(score(iter(rows[:1]))) == list(score(iter(rows[1:2]))) == []


@pytest.mark.parametrize("cores", [1, 3])
def test_model_does_not_follow_the_partitioning(spark, ratings, model, cores):
    pairs = ratings.groupBy("user", "item").agg(F.sum("rating").cast("float").alias("rating"))
    other = L.fit_als(L.als_implicit(rank=4, maxIter=3), pairs.orderBy("user", "item").coalesce(cores))
    ours, theirs = ({r["id"]: r["features"] for r in m.itemFactors.collect()} for m in (model, other))
    assert ours.keys() == theirs.keys()
    assert all(np.allclose(ours[i], theirs[i], atol=1e-4) for i in ours)


def test_rows_scored_in_blocks(spark, ratings, model, monkeypatch):
    """As by joins: unknown sides drop out or are NaN, missing ones fail, other columns stay, no row carries factors."""
    rows = ratings.select("id", "user", "item", F.timestamp_seconds("ts").alias("at"), F.col("rating").alias("odd name"))
    strange = [(-1, 5, 10**6, None, 1.0), (-2, 10**6, 3, None, None), (-3, -7, -7, None, 3.0)]
    rows = rows.unionByName(spark.createDataFrame(strange, rows.schema))
    for strategy, missing in (("drop", 0), ("nan", 3)):
        model.setColdStartStrategy(strategy)
        plain = L.score(model, rows)
        monkeypatch.setattr(L, "FEW_FACTORS", 0)
        dealt = L.score(model, rows)
        monkeypatch.undo()
        assert "features" not in dealt._jdf.queryExecution().analyzed().output().toString()
        assert "SortMergeJoin" not in dealt._jdf.queryExecution().executedPlan().toString()
        assert [(f.name, f.dataType) for f in dealt.schema] == [(f.name, f.dataType) for f in plain.schema]
        theirs, ours = ({r["id"]: tuple(r) for r in df.collect()} for df in (plain, dealt))
        assert theirs.keys() == ours.keys() and len(ours) == dealt.count() == 4000 + missing
        assert all(ours[i][:-1] == theirs[i][:-1] for i in ours)
        assert np.allclose([ours[i][-1] for i in ours], [theirs[i][-1] for i in ours], atol=1e-6, equal_nan=True)
    model.setColdStartStrategy("drop")
    monkeypatch.setattr(L, "FEW_FACTORS", 0)
    for name in ("user", "item"):
        with pytest.raises(Exception, match=f"{name} Ids MUST NOT be Null"):
            L.score(model, rows.withColumn(name, F.when(F.col("id") != 7, F.col(name)))).collect()


def test_top_k_stays_off_the_driver(model):
    import inspect

    source = inspect.getsource(R)
    assert "toArrow" not in source and "sparkContext.broadcast" not in source
    text = R.recommend_all(model, 5, block_rows=7)._jdf.queryExecution().executedPlan().toString()
    assert text.count("FlatMapGroupsInArrow") == 1 and "NestedLoop" not in text and "Cartesian" not in text
    assert text.count("Scan") <= 2  # users once, items once


def test_indexed_model_in_a_grid_search(spark, ratings):
    named = ratings.select("id", F.concat(F.lit("u"), "user").alias("user"), F.concat(F.lit("i"), "item").alias("item"), "rating")
    als = L.als_explicit("user_index", "item_index", rank=2, maxIter=1)
    estimator = L.IndexedALSEstimator(als, "user", "item", labels=named, dedupe=True)
    grid = [{als.regParam: 10.0, als.rank: 2}, {als.regParam: 0.1, als.rank: 3}]
    judge = RegressionEvaluator(metricName="rmse", labelCol="rating", predictionCol="prediction")
    search = L.grid_search_cv(named, estimator, grid, judge, ["id"], k=2)
    rows = L.grid_metrics(spark, search).collect()
    assert sorted((r["run_id"], r["param"], r["param_value"]) for r in rows) == [
        (0, "rank", "2"), (0, "regParam", "10.0"), (1, "rank", "3"), (1, "regParam", "0.1")
    ]
    assert search.avgMetrics[0] != search.avgMetrics[1]
    assert search.bestModel.transform(named).count() == 4000


def test_saved_pipelines_and_searches(spark, ratings, tmp_path):
    named = ratings.select("id", F.concat(F.lit("u"), "user").alias("user"), F.concat(F.lit("i"), "item").alias("item"), "rating")
    asked = named.union(spark.createDataFrame([(-1, "nobody", "i3", 1.0), (-2, None, "i4", 1.0)], named.schema))
    als = L.als_explicit("user_index", "item_index", rank=2, maxIter=1)
    predicted = lambda m: sorted((r.id, r.prediction) for r in m.transform(asked).select("id", "prediction").collect())
    estimator = L.IndexedALSEstimator(als, "user", "item", labels=named, dedupe=True)

    whole = Pipeline(stages=[estimator, SQLTransformer(statement="SELECT * FROM __THIS__")]).fit(named)
    whole.write().overwrite().save(str(tmp_path / "pipeline"))
    loaded = PipelineModel.load(str(tmp_path / "pipeline"))
    assert predicted(loaded) == predicted(whole) and len(predicted(whole)) >= 4000
    assert [s.uid for s in loaded.stages] == [s.uid for s in whole.stages]

    grid = [{als.regParam: 10.0}, {als.regParam: 0.1}]
    judge = RegressionEvaluator(metricName="rmse", labelCol="rating", predictionCol="prediction")
    search = L.grid_search_cv(named, estimator, grid, judge, ["id"], k=2)
    search.write().overwrite().save(str(tmp_path / "search"))
    again = CrossValidatorModel.load(str(tmp_path / "search"))
    assert predicted(again) == predicted(search) and again.avgMetrics == search.avgMetrics
    assert [list(p.values()) for p in again.getEstimatorParamMaps()] == [[10.0], [0.1]]
    assert again.getEstimator().labels.count() == 4000 and again.getEstimator().dedupe

    estimator.write().overwrite().save(str(tmp_path / "estimator"))
    refitted = L.IndexedALSEstimator.load(str(tmp_path / "estimator")).fit(named)
    assert predicted(refitted) == predicted(estimator.fit(named))


def test_concurrent_trials_agree(ratings):
    als = L.als_implicit(rank=2)
    grid = [{als.maxIter: n} for n in (1, 2, 3)]
    one, four = (L.grid_search_ranking(ratings, als, grid, key=["id"], parallelism=n) for n in (1, 4))
    assert one.validation == four.validation and one.best == four.best
    assert sorted(one.metrics.collect()) == sorted(four.metrics.collect())


def test_cross_validated_grid(spark, ratings):
    als = L.als_explicit(rank=2, maxIter=1)
    grid = ParamGridBuilder().addGrid(als.regParam, [1.0, 0.1]).build()
    judge = RegressionEvaluator(metricName="rmse", labelCol="rating", predictionCol="prediction")
    rows = L.grid_metrics(spark, L.grid_search_cv(ratings, als, grid, judge, ["id"])).collect()
    assert [(r["param"], r["param_value"], r["metric"]) for r in rows] == [("regParam", "1.0", "rmse"), ("regParam", "0.1", "rmse")]


def test_ranking_grid(spark):
    typed = spark.createDataFrame(typed_rows(), "user int, item int, rating int, notTime int")
    als = L.als_explicit(rank=3, maxIter=1)
    grid = ParamGridBuilder().addGrid(als.maxIter, [1, 2]).build()
    search = L.grid_search_ranking(typed, als, grid)
    rows = search.metrics.collect()
    assert {r["metric"] for r in rows} == {"ndcgAt", "map", "recallAtK", "mrr", "fcp"} and len(rows) == 10
    assert search.validation[search.best] == max(search.validation)
    assert search.train.count() == 24 and search.valid.count() == 8
    assert R.recommend_all(search.model, 3).count() == 4


def test_ranking_grid_logs_every_parameter(spark):
    typed = spark.createDataFrame(typed_rows(), "user int, item int, rating int, notTime int")
    als = L.als_explicit(rank=3, maxIter=1)
    grid = [{als.maxIter: 1, als.regParam: r, als.intermediateStorageLevel: "MEMORY_ONLY"} for r in (1.0, 0.1)]
    rows = L.grid_search_ranking(typed, als, grid).metrics.collect()
    assert len(rows) == 2 * 3 * 5
    assert {(r["param"], r["param_value"]) for r in rows} == {
        ("maxIter", "1"), ("regParam", "1.0"), ("regParam", "0.1"), ("intermediateStorageLevel", "MEMORY_ONLY")
    }


def test_run_log(spark, tmp_path):
    path = str(tmp_path / "runs")
    for reg, error in ((1.0, 0.9), (0.1, 0.8)):
        L.log_metrics(spark, f"reg-{reg}", {"reg": reg, "columns": ["a", "b"]}, {"rmse": error}, path)
    from recmill.operators.prep import best_run

    logged = spark.read.parquet(path)
    assert logged.count() == 2
    assert best_run(logged, "rmse").first()["run_id"] == "reg-0.1"


@pytest.mark.parametrize("dedupe", [False, True])
def test_explicit_workflow(spark, ratings, tmp_path, dedupe):
    path = str(tmp_path / "serving")
    run = W.explicit_workflow(ratings.drop("ts"), ["id"], path, k=3, reg_params=(1.0, 0.1), dedupe=dedupe)
    from recmill.operators.serving import read_serving

    assert run.grid.count() == 2 and run.rmse > 0
    assert read_serving(spark, str(tmp_path / "serving")).count() == 47


def test_explicit_workflow_stores_what_it_made(spark, ratings, tmp_path):
    store = str(tmp_path / "store")
    run = W.explicit_workflow(ratings, ["id"], f"{store}/serving", k=3, reg_params=(1.0, 0.1), dedupe=True, store=store)
    assert spark.read.parquet(f"{store}/train").count() + spark.read.parquet(f"{store}/test").count() == 4000
    logged = run.runs.collect()
    assert len(logged) == 2 and {r["params"]["regParam"] for r in logged} == {"1.0", "0.1"}
    assert {r["params"]["numUserBlocks"] for r in logged} == {"10"}
    assert L.load_model(f"{store}/model").rank == 10


def test_implicit_workflow(spark):
    log = spark.range(3000).select(
        F.concat(F.lit("reader"), F.col("id") % 30).alias("userId"),
        F.concat(F.lit("/story/"), F.pmod(F.xxhash64("id"), F.lit(25))).alias("url"),
        (F.col("id") % 60).cast("float").alias("activeTime"),
        F.col("id").alias("time"),
        (F.col("id") % 11 == 0).alias("sessionStart"),
    )
    roles = {"user": "userId", "item": "url", "rating": "activeTime", "ts": "time"}
    run = W.implicit_workflow(log, roles, {"sessionStart": ["true"]}, {"activeTime": 10}, 2900, k=4)
    assert run.recommendations.count() == 30
    assert {r["metric"] for r in run.metrics.collect()} == {"ndcgAt", "map", "recallAtK", "mrr", "fcp"}
    assert run.rmse.first()["rmse"] > 0
