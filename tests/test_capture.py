"""Packed captures, checked readers, intervals with late messages, and calls per distinct value."""

import os
import uuid

import pytest
from pyspark.sql import functions as F

from recmill.operators import enrich as E
from recmill.operators import indexing, recommend, skew
from recmill.sources import messages as G
from recmill.sources.paths import located
from recmill.sources.ratings import read_checked
from recmill.streaming import ratings as Z

MESSAGE = "id BIGINT, ts TIMESTAMP, Body BINARY"


def bag(df):
    return sorted((tuple(row) for row in df.collect()), key=str)


@pytest.fixture(scope="module")
def messages(spark):
    times = F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") * 13)
    rows = spark.range(300).select("id", times.alias("ts"))
    return G.encode_messages(rows, ["id"], keep=["id", "ts"]).cache()


def test_packed_files_hold_many_intervals_and_ranges_open_few(spark, messages, tmp_path):
    root = str(tmp_path / "packed")
    G.write_packed(messages, root, "ts", "id", max_rows_per_file=40)
    G.write_packed(messages, root, "ts", "id")  # all intervals are there
    whole = G.read_packed(spark, root, MESSAGE)
    assert bag(whole.select("id", "ts", "Body")) == bag(messages)
    assert whole.filter(F.col("start") != G.capture_interval("ts")).count() == 0
    manifest = G.packed_files(spark, root)
    files = manifest.select("file").distinct().count()
    assert manifest.agg(F.sum("n")).first()[0] == 300
    assert 1 < files < manifest.count() / 3

    starts = sorted(row["start"] for row in manifest.select("start").distinct().collect())
    since, until = F.lit(starts[20]), F.lit(starts[24])
    part = G.read_packed(spark, root, MESSAGE, partition=1, since=since, until=until)
    assert 0 < len(part.inputFiles()) < files / 2
    own = messages.withColumn("PartitionId", G.partition_id("id", 2)).withColumn("start", G.capture_interval("ts"))
    assert bag(part.select("id")) == bag(own.filter((F.col("PartitionId") == 1) & (F.col("start") >= since) & (F.col("start") < until)).select("id"))
    assert G.read_packed(spark, root, MESSAGE, partition=9).count() == 0


def test_a_packing_run_that_failed_is_not_read_and_done_again(spark, messages, tmp_path):
    root = str(tmp_path / "packed")
    G.write_packed(messages.filter("id < 100"), root, "ts", "id")
    (run,) = os.listdir(f"{root}/manifest")
    path, fs = located(spark, f"{root}/manifest/{run}/_SUCCESS")
    fs.delete(path, False)
    assert G.read_packed(spark, root, MESSAGE).count() == 0
    G.write_packed(messages.filter("id < 100"), root, "ts", "id")
    assert bag(G.read_packed(spark, root, MESSAGE).select("id")) == [(i,) for i in sorted(range(100), key=lambda i: str((i,)))]


def test_capture_folders_are_packed_up_to_a_moment(spark, messages, tmp_path):
    captured, root = str(tmp_path / "capture"), str(tmp_path / "packed")
    few = messages.filter("id < 60")
    G.write_capture(few, captured, "ts", "id")
    folders = G.read_capture(spark, captured)
    cut = F.lit("2023-11-14 22:20:00").cast("timestamp")
    G.pack_capture(folders, root, until=cut)
    early = G.read_packed(spark, root, MESSAGE)
    assert bag(early.select("id")) == bag(few.filter(G.capture_interval("ts") < cut).select("id"))
    assert 0 < early.count() < 60
    G.pack_capture(folders, root)
    G.pack_capture(folders, root)
    assert bag(G.read_packed(spark, root, MESSAGE).select("id", "ts", "Body")) == bag(few)


def test_an_empty_capture_is_packed(spark, messages, tmp_path):
    root = str(tmp_path / "packed")
    G.write_packed(messages.limit(0), root, "ts", "id")
    assert G.read_packed(spark, root, MESSAGE).count() == 0


def test_bad_csv_lines_are_kept_apart(spark, tmp_path):
    (tmp_path / "a.csv").write_text("user,item,rating\n 1 , 2 , 3.5 \n4,5\nx,5,6\n,8,1\n7,8,9,10\n\n9,,\n")
    good, rejected = read_checked(spark, str(tmp_path), "user INT, item INT, rating DOUBLE", required=["user"])
    assert bag(good) == [(1, 2, 3.5), (9, None, None)]
    found = {row["line"]: row["reason"] for row in rejected.collect()}
    assert found == {"4,5": "malformed", "x,5,6": "malformed", "7,8,9,10": "malformed", '{"item":8,"rating":1.0}': "incomplete"}
    assert {row["file"].rsplit("/", 1)[1] for row in rejected.collect()} == {"a.csv"}


def test_bad_json_lines_are_kept_apart(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"_line":"a","n":1}\n{"_line":"b","n":"many"}\nnothing\n{"n":2}\n')
    good, rejected = read_checked(spark, str(tmp_path), "_line STRING, n INT", fmt="json", required=["_line"])
    assert bag(good) == [("a", 1)]
    assert sorted(row["reason"] for row in rejected.collect()) == ["incomplete", "malformed", "malformed"]
    with pytest.raises(ValueError):
        read_checked(spark, str(tmp_path), "n INT", fmt="orc")


def test_each_partition_has_its_own_watermark(spark, tmp_path):
    root, out, progress = (str(tmp_path / name) for name in ("in", "out", "progress"))
    schema = "PartitionId INT, id INT, at BIGINT"

    def deliver(*rows):
        timed = spark.createDataFrame(rows, schema).withColumn("ts", F.timestamp_seconds("at")).drop("at")
        timed.write.mode("append").parquet(root)
        stream = Z.stream_files(spark, root, timed.schema)
        Z.count_intervals(stream, out, progress, "ts", lateness="2 minutes").awaitTermination()
        return timed.schema

    deliver((0, 1, 6_000), (0, 2, 6_010), (1, 3, 60))
    # 0 has seen 6010: intervals ending by 5890 are closed; 1 has seen 60 only; 2 nothing
    deliver((0, 4, 60), (0, 5, 5_880), (1, 6, 0), (2, 7, 0), (0, 8, None), (None, 9, 0))
    schema_out = deliver((None, 10, 1_000), (1, 11, 90), (0, 12, 60))
    found = Z.read_intervals(spark, out).select("partition", F.unix_seconds("start").alias("s"), "n", "n_late")
    assert bag(found) == sorted(
        [
            (0, 6_000, 2, 0), (0, 60, 0, 2), (0, 5_880, 1, 0), (0, None, 0, 1),
            (1, 60, 2, 0), (1, 0, 1, 0), (2, 0, 1, 0), (None, 0, 1, 0), (None, 960, 1, 0),
        ],
        key=str,
    )
    assert sorted(row["id"] for row in Z.read_late(spark, out, schema_out).collect()) == [4, 8, 12]
    assert found.agg(F.sum(F.col("n") + F.col("n_late"))).first()[0] == 12


def test_late_rows_of_a_stream_without_any(spark, tmp_path):
    assert Z.read_late(spark, str(tmp_path), "id INT").count() == 0


def _noting(folder, fails=0):
    """A provider that leaves a file per value sent, and fails its first calls."""

    def provider(values):
        tried = sum(name.startswith("try") for name in os.listdir(folder))
        if tried < fails:
            open(f"{folder}/try{tried}", "w").close()
            raise OSError("busy")
        if "bad" in values:
            raise ValueError("bad value")
        for value in values:
            open(f"{folder}/sent-{value}-{uuid.uuid4().hex}", "w").close()
        return [{"n": len(value)} for value in values]

    return provider


def test_each_distinct_value_is_sent_once(spark, tmp_path):
    rows = spark.range(200).selectExpr("id", "id AS _key", "id AS _answer", "if(id % 9 = 8, null, concat('v', id % 3)) AS v")
    for min_rows in (10_000_000, 1):
        folder = tmp_path / f"sent{min_rows}"
        folder.mkdir()
        found = E.enrich_distinct(rows, _noting(str(folder)), "v", "n", "struct<n: int>", "problem", batch=2, min_rows=min_rows)
        assert found.columns == ["id", "_key", "_answer", "v", "n", "problem"]
        for _ in range(2):
            assert [r for r in found.collect() if (r["n"] is None) != (r["v"] is None) or r["problem"]] == []
        assert found.count() == 200
        assert sorted(name.split("-")[1] for name in os.listdir(folder)) == ["v0", "v1", "v2"]


def test_failed_calls_are_made_again_and_bad_values_stay_alone(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a"), (2, "bad"), (3, "ccc"), (4, "a")], "id INT, v STRING")
    found = E.enrich_distinct(
        rows, _noting(str(tmp_path), fails=2), "v", "n", "struct<n: int>", "problem", concurrency=1, in_flight=1, backoff=0.01
    )
    told = {row["id"]: (row["n"] and row["n"]["n"], row["problem"]) for row in found.collect()}
    assert told == {1: (1, None), 2: (None, "bad value"), 3: (3, None), 4: (1, None)}


def test_lookups_when_the_list_of_heavy_keys_is_full(spark, monkeypatch):
    monkeypatch.setattr(skew, "HEAVY_LIMIT", 2)
    left = spark.range(300).selectExpr("id", "if(id % 7 = 0, null, id % 5) AS k", "1 AS _share")
    right = spark.range(4).selectExpr("id AS k", "id * 10 AS v")
    for how in ("inner", "left"):
        expected = bag(left.join(right, "k", how).select("id", "k", "v"))
        assert bag(skew.lookup_join(left, right, "k", how, min_rows=3).select("id", "k", "v")) == expected


def test_null_labels_take_part_in_the_one_join(spark):
    rows = spark.range(100).selectExpr("id", "if(id % 2 = 0, null, id % 4) AS item", "0 AS _spread")
    index = indexing.label_index(rows, "item").cache()
    for min_rows in (10_000_000, 5):
        found = indexing.apply_index(rows, index, "item", "n", min_rows)
        assert found.columns == ["id", "item", "_spread", "n"]
        assert bag(found.select("id", "n")) == bag(rows.selectExpr("id", "CASE item WHEN 1 THEN 0 WHEN 3 THEN 1 ELSE 2 END"))


def test_factors_given_as_tables(spark):
    users = spark.createDataFrame([(i, [float(i % 3), 1.0]) for i in range(9)], "id INT, features ARRAY<DOUBLE>")
    items = spark.createDataFrame([(i, [float(i % 4), float(i % 2)]) for i in range(12)], "id LONG, features ARRAY<DOUBLE>")
    for block_rows in (2, 100):
        found = recommend.recommend_factors(users, items, 5, block_rows=block_rows).collect()
        assert len(found) == 9
        for row in found:
            u = [float(row["user"] % 3), 1.0]
            scored = sorted((-(u[0] * (i % 4) + u[1] * (i % 2)), i) for i in range(12))
            assert [(-e["rating"], e["itemId"]) for e in row["recommendations"]] == scored[:5]


def test_blocks_grow_instead_of_being_sent_more_often(spark):
    for n, rank in ((900_000, 3), (5_400_000, 10), (400_000_000, 10)):
        user_blocks, item_blocks = recommend._block_counts(n, n, rank, 400)
        assert n * rank <= min(user_blocks, item_blocks) * recommend.BLOCK_FLOATS
        assert user_blocks <= max(recommend.MANY_BLOCKS, n * rank / recommend.BLOCK_FLOATS + 1)
        assert item_blocks <= max(recommend.MANY_ITEM_BLOCKS, n * rank / recommend.BLOCK_FLOATS + 1)
    users = spark.range(3000).selectExpr("id", "array(id % 7 - 3, id % 11 - 5) AS features")
    items = spark.range(2500).selectExpr("id", "array(id % 13 - 6, id % 5 - 2) AS features")
    found = recommend.recommend_factors(users, items, 3, block_rows=1).collect()
    assert len(found) == 3000
    for row in found[::97]:
        u = (row["user"] % 7 - 3, row["user"] % 11 - 5)
        scored = sorted((-(u[0] * (i % 13 - 6) + u[1] * (i % 5 - 2)), i) for i in range(2500))
        assert [(-e["rating"], e["itemId"]) for e in row["recommendations"]] == scored[:3]
