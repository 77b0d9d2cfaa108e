"""Sources, sinks, serving, enrichment and streaming."""

import random
import re
import threading
from concurrent.futures import ThreadPoolExecutor

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from recmill.functions import columns as C
from recmill.functions.transformers import Enrich, ExplodeUrls, JoinLines, SelectColumns
from recmill.operators import enrich as E
from recmill.operators import serving as V
from recmill.operators.recommend import inject_cold
from recmill.sources import messages as G
from recmill.sources.ratings import page_offsets, read_activity_json, read_ratings_csv
from recmill.sources import paths
from recmill.sources.paths import create_text, is_complete, located
from recmill.sources.scratch import materialise, scratch_path, scratch_scope
from recmill.streaming import ratings as Z

MESSAGE = "userId INT, movieId INT, rating INT"


@pytest.fixture(scope="module")
def hub(spark):
    rows = spark.range(500).select(
        F.col("id"),
        (F.col("id") % 20).alias("userId"),
        (F.col("id") % 7).alias("movieId"),
        (F.col("id") % 5 + 1).alias("rating"),
        F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") * 13).alias("ts"),
    )
    return G.encode_messages(rows, ["userId", "movieId", "rating"], keep=["id", "ts"]).cache()


def bag(df):
    return sorted(tuple(row) for row in df.collect())


def test_csv_is_trimmed_and_inferred(spark, tmp_path):
    (tmp_path / "ratings.csv").write_text("userId,itemId,rating\n 1 , 2 , 3.5 \n4,5,6\n")
    df = read_ratings_csv(spark, str(tmp_path))
    assert bag(df) == [(1, 2, 3.5), (4, 5, 6.0)]


def test_json_log(spark, tmp_path):
    (tmp_path / "log.json").write_text('{"userId":"a","activeTime":3}\n{"userId":"b"}\n')
    df = read_activity_json(spark, str(tmp_path), "userId STRING, activeTime DOUBLE")
    assert [r["activeTime"] for r in df.orderBy("userId").collect()] == [3.0, None]


def test_page_offsets(spark):
    assert [r["offset"] for r in page_offsets(spark).collect()] == list(range(0, 1000, 10))


def test_messages_are_texts(hub):
    assert hub.filter("id = 1").first()["Body"] == b'{"userId":"1","movieId":"1","rating":"2"}'


def test_bad_value_spoils_only_its_field(spark):
    df = spark.createDataFrame([(bytearray(b'{"userId":"x","movieId":"2","rating":"3"}'),)], "Body binary")
    assert [tuple(r) for r in G.decode_messages(df, MESSAGE).collect()] == [(None, 2, 3)]


def test_capture_round_trip(spark, hub, tmp_path):
    root = str(tmp_path / "hub")
    G.write_capture(hub, root, "ts", "id", interval="10 minutes")
    parts = [G.read_capture(spark, root, p).select("id", "Body") for p in (0, 1)]
    assert sorted(r["id"] for part in parts for r in part.collect()) == list(range(500))
    assert min(part.count() for part in parts) > 100
    plan = parts[0]._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(PartitionId" in plan


def test_capture_of_every_minute(spark, hub, tmp_path):
    """The default interval, read whole and by partition: every message sits in its own minute's folder."""
    root = str(tmp_path / "hub")
    G.write_capture(hub.filter("id < 60"), root, "ts", "id")
    whole = G.read_capture(spark, root)
    place = F.format_string("%04d-%02d-%02d %02d:%02d:%02d", "Year", "Month", "Day", "Hour", "Minute", "Second")
    own = F.date_format(F.date_trunc("minute", "ts"), "yyyy-MM-dd HH:mm:ss")
    assert whole.count() == 60 and whole.filter(place != own).count() == 0
    assert sum(G.read_capture(spark, root, p).count() for p in (0, 1)) == 60
    assert len(list((tmp_path / "hub").glob("*/*/*/*/*/*/*"))) == whole.select("PartitionId", own).distinct().count()


def test_plain_capture_layout(spark, hub, tmp_path):
    for part in (0, 1):
        rows = hub.filter(F.col("id") % 2 == part).drop("ts")
        rows.write.parquet(str(tmp_path / str(part) / "2024" / "01" / "02" / "03" / "04" / "05"))
    both = G.read_capture(spark, str(tmp_path), layout="plain")
    assert both.filter("PartitionId = id % 2").count() == 500
    assert G.read_capture(spark, str(tmp_path), 1, layout="plain").count() == 250


def test_stream_equals_batch(spark, hub, tmp_path):
    root = str(tmp_path / "hub")
    G.write_capture(hub, root, "ts", "id", interval="30 minutes")
    Z.write_available(
        Z.stream_ratings(spark, root, MESSAGE, max_files=1), str(tmp_path / "out"), str(tmp_path / "progress")
    ).awaitTermination()
    batch = G.filter_rating(G.decode_messages(G.read_capture(spark, root), MESSAGE), 3)
    assert bag(spark.read.parquet(str(tmp_path / "out"))) == bag(batch) and batch.count() == 200


def documents(spark, rows):
    return spark.createDataFrame(rows, "id string, items array<int>")


def test_upsert_versions(spark, tmp_path):
    path = str(tmp_path / "serving")
    assert V.publish_upsert(spark, path, documents(spark, [("1", [1]), ("2", [2])])) == 0
    second = documents(spark, [("2", [9]), ("3", [3])])
    assert V.publish_upsert(spark, path, second, token="b") == 1
    assert V.publish_upsert(spark, path, second, token="b") == 1
    assert V.current_version(spark, path) == 1
    assert bag(V.read_serving(spark, path)) == [("1", [1]), ("2", [9]), ("3", [3])]
    assert bag(V.lookup(V.read_serving(spark, path), [3, 4])) == [("3", [3])]
    assert bag(V.read_serving(spark, path, ids=[2])) == [("2", [9])]


def test_newest_row_wins_across_batches(spark, tmp_path):
    path = str(tmp_path / "serving")
    frame = lambda rows: spark.createDataFrame(rows, "id string, ts int, item int")
    batches = [[("1", 100, 1), ("2", 5, 1)], [("1", 5, 2), ("2", 6, 2)], [("1", None, 3), ("3", None, 3)], [("2", 6, 4)]]
    for full_every in (10, 2):
        for n, rows in enumerate(batches):
            V.publish_upsert(spark, f"{path}{full_every}", frame(rows), order=["ts"], full_every=full_every)
        found = V.read_serving(spark, f"{path}{full_every}", order=["ts"])
        assert {tuple(r) for r in found.collect()} == {("1", 100, 1), ("2", 6, 4), ("3", None, 3)}


def stream_rows(spark, root, table, progress, rows):
    spark.createDataFrame(rows, "id string, ts int").write.mode("append").parquet(root)
    Z.stream_upsert(Z.stream_files(spark, root, "id string, ts int"), table, progress, "id", ["ts"]).awaitTermination()


def test_streams_lose_no_batch_beside_other_publishers(spark, tmp_path):
    root, table = str(tmp_path / "in"), str(tmp_path / "serving")
    frame = lambda rows: spark.createDataFrame(rows, "id string, ts int")
    for n in range(2):
        V.publish_upsert(spark, table, frame([(f"batch{n}", n), ("shared", 10)]), order=["ts"])
    stream_rows(spark, root, table, str(tmp_path / "p1"), [("s1", 1), ("shared", 20)])
    V.publish_upsert(spark, table, frame([("batch2", 2)]), order=["ts"])
    stream_rows(spark, root, table, str(tmp_path / "p1"), [("s2", 1), ("shared", 15)])
    stream_rows(spark, str(tmp_path / "in2"), table, str(tmp_path / "p2"), [("t1", 1)])  # a new query's batch 0
    found = {tuple(r) for r in V.read_serving(spark, table, order=["ts"]).collect()}
    assert found == {("batch0", 0), ("batch1", 1), ("batch2", 2), ("shared", 20), ("s1", 1), ("s2", 1), ("t1", 1)}


def test_full_layers_return(spark, tmp_path):
    path = str(tmp_path / "serving")
    for n in range(7):
        V.publish_upsert(spark, path, documents(spark, [("a", [n]), (str(n), [n])]), full_every=3)
        expected = [("a", [n])] + [(str(i), [i]) for i in range(n + 1)]
        assert bag(V.read_serving(spark, path)) == sorted(expected)
    kinds = [p.name.split("-")[0] for p in sorted((tmp_path / "serving").iterdir(), key=lambda p: p.name[-12:])]
    assert kinds == ["full", "delta", "delta", "full", "delta", "delta", "full"]


def test_upsert_is_idempotent(spark):
    table, new = documents(spark, [("1", [1]), ("2", [2])]), documents(spark, [("2", [9])])
    once = V.upsert_serving(table, new)
    assert bag(V.upsert_serving(once, new)) == bag(once)


def test_unfinished_version_is_not_read(spark, tmp_path):
    path = str(tmp_path / "serving")
    V.publish_upsert(spark, path, documents(spark, [("1", [1])]))
    (tmp_path / "serving" / "delta-000000000001").mkdir()
    assert bag(V.read_serving(spark, path)) == [("1", [1])]
    assert V.publish_upsert(spark, path, documents(spark, [("2", [2])])) == 1
    assert V.read_serving(spark, path).count() == 2


def test_racing_publishers_lose_nothing(spark, tmp_path):
    path = str(tmp_path / "serving")
    start = threading.Barrier(4)

    def publish(who):
        start.wait()
        for n in range(3):
            rows = documents(spark, [(f"{who}-{n}", [n]), ("shared", [n])])
            V.publish_upsert(spark, path, rows, token=f"{who}/{n}", full_every=3, buckets=4)

    with ThreadPoolExecutor(4) as pool:
        list(pool.map(publish, range(4)))
    found = dict(bag(V.read_serving(spark, path)))
    assert sorted(found) == sorted([f"{w}-{n}" for w in range(4) for n in range(3)] + ["shared"])
    assert found["shared"] == [2]
    before = V.current_version(spark, path)
    V.publish_upsert(spark, path, documents(spark, [("0-0", [99])]), token="0/0", full_every=3)
    assert V.current_version(spark, path) == before and dict(bag(V.read_serving(spark, path)))["0-0"] == [0]


def test_versions_finished_late_and_dead_claims(spark, tmp_path):
    """A merge that did not see an earlier version leaves it in force; a claim without rows is passed over."""
    path, frame = str(tmp_path / "serving"), lambda rows: spark.createDataFrame(rows, "id string, item int")
    for n in range(3):
        V.publish_upsert(spark, path, frame([("a", n), ("b", n)]), full_every=4, buckets=1)
    late = tmp_path / "serving" / "delta-000000000002"
    (late / "_SUCCESS").rename(late / "_not_yet")
    V.publish_upsert(spark, path, frame([("c", 3)]), full_every=4)
    V.publish_upsert(spark, path, frame([("a", 4)]), full_every=2)
    assert {tuple(r) for r in V.read_serving(spark, path).collect()} == {("a", 4), ("b", 1), ("c", 3)}
    (late / "_not_yet").rename(late / "_SUCCESS")
    assert {tuple(r) for r in V.read_serving(spark, path).collect()} == {("a", 4), ("b", 2), ("c", 3)}
    assert create_text(spark, f"{path}/delta-000000000005/_claim", "{}") and not create_text(spark, f"{path}/delta-000000000005/_claim", "")


def test_lookup_opens_one_bucket(spark, tmp_path):
    path = str(tmp_path / "serving")
    V.publish_upsert(spark, path, documents(spark, [(str(n), [n]) for n in range(500)]))
    V.publish_upsert(spark, path, documents(spark, [(str(n), [-n]) for n in range(0, 500, 7)]))
    found = V.read_serving(spark, path, ids=[14])
    assert bag(found) == [("14", [-14])] and len({f.rpartition("/")[0] for f in found.inputFiles()}) == 2
    assert V.read_serving(spark, path).count() == 500
    assert bag(V.read_serving(spark, path, ids=["nobody"])) == []
    empty = str(tmp_path / "empty")
    V.publish_upsert(spark, empty, documents(spark, []))
    assert V.read_serving(spark, empty).dtypes == [("id", "string"), ("items", "array<int>")]


def test_create_text_by_rename(spark, tmp_path):
    source, target = tmp_path / "a", tmp_path / "b"
    source.write_text("x")
    target.write_text("y")
    (a, _), (b, _), (c, _) = (located(spark, str(p)) for p in (source, target, tmp_path / "c"))
    with pytest.raises(Py4JJavaError, match="FileAlreadyExistsException"):
        paths._rename(spark, a, b)
    paths._rename(spark, a, c)
    assert target.read_text() == "y" and (tmp_path / "c").read_text() == "x"


def test_lookup_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "serving")
    for _ in range(2):
        V.publish_upsert(spark, path, documents(spark, [("1", [1])]))
    plan = V.read_serving(spark, path, ids=[1])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PushedFilters: [IsNotNull(id), EqualTo(id,1)]") == plan.count("FileScan") == 3


def test_serve(spark):
    requests = spark.createDataFrame([("1",), ("7",), ("1",)], "id string")
    found = V.serve(requests, documents(spark, [("1", [4, 5])]), min_rows=1)
    assert sorted((r["id"], r["response"]) for r in found.collect()) == [
        ("1", '{"id":"1","items":[4,5]}'), ("1", '{"id":"1","items":[4,5]}'), ("7", None)
    ]


def test_cold_injection(spark):
    recs = spark.range(2000).select(F.col("id").alias("user"), F.expr(
        "transform(sequence(1, 5), i -> named_struct('itemId', i, 'rating', 1.0F))").alias("recommendations"))
    cold = spark.range(100, 160).select(F.col("id").cast("int").alias("item"))
    joined, broadcast = (inject_cold(recs, cold, 0.02, 1, max_broadcast=n) for n in (0, 1000))
    assert bag(joined) == bag(broadcast)
    counts = {r["exposed"]: r["count"] for r in joined.groupBy("exposed").count().collect()}
    assert sum(counts.values()) == 10_000 and 120 < counts["cold"] < 280
    assert joined.filter("exposed = 'cold'").select("item").distinct().count() > 40
    assert inject_cold(recs, cold.limit(0)).filter("exposed = 'cold'").count() == 0


def test_provider_errors_stay_with_their_row(spark):
    def provider(values):
        if "bad" in values:
            raise ValueError("no answer")
        return [{"n": len(v)} for v in values]

    df = spark.createDataFrame([("abc",), ("bad",), (None,)], "text string")
    found = E.enrich(df, provider, "text", "answer", "struct<n: bigint>", "problem", concurrency=1).collect()
    assert {r["text"]: (r["answer"] and r["answer"]["n"], r["problem"]) for r in found} == {
        "abc": (3, None), "bad": (None, "no answer"), None: (None, None)
    }


@pytest.mark.parametrize("change", [lambda a: a[:-1], lambda a: [*a, None], lambda a: []])
def test_wrong_number_of_answers(spark, change):
    def provider(values):
        answers = [{"n": len(v)} for v in values]
        return change(answers) if len(values) > 1 or values[0] == "alone" else answers

    df = spark.createDataFrame([("a",), ("bc",), (None,), ("alone",)], "text string").coalesce(1)
    found = {r["text"]: r for r in E.enrich(df, provider, "text", "answer", "struct<n: bigint>", "problem").collect()}
    assert [found[t]["answer"]["n"] for t in ("a", "bc")] == [1, 2] and found[None]["problem"] is None
    assert found["alone"]["answer"] is None and "answers to 1 values" in found["alone"]["problem"]


def test_concurrency_does_not_narrow_the_scan(spark):
    df = spark.range(100, numPartitions=6).select(F.col("id").cast("string").alias("text"))
    bounded = E.enrich(df, lambda v: [{"n": 1} for _ in v], "text", "answer", "struct<n: bigint>", concurrency=2)
    assert bounded.rdd.getNumPartitions() == 2
    assert "Coalesce" not in bounded._jdf.queryExecution().executedPlan().toString()


def test_lines_and_entities(spark):
    schema = "id int, ocr struct<recognitionResult: struct<lines: array<struct<text: string>>>>"
    rows = [(1, ((([("a",), ("",), (None,), ("b",)],),))), (2, None), (3, ((([],),)))]
    df = C.join_lines(spark.createDataFrame(rows, schema), "ocr.recognitionResult.lines", "text")
    assert {r["id"]: r["text"] for r in df.collect()} == {1: "a\n\n\nb", 2: None, 3: ""}
    schema = "id int, celebs struct<result: struct<celebrities: array<struct<name: string>>>>"
    rows = [(1, ((([("x",), ("y",)],),))), (2, None), (3, ((([],),)))]
    df = C.first_entity(spark.createDataFrame(rows, schema), "celebs.result.celebrities", "first")
    assert {r["id"]: r["first"] for r in df.collect()} == {1: "x", 2: None, 3: None}


def test_sentiment(spark):
    df = spark.createDataFrame([(1, "Good, good: BAD!"), (2, "nothing"), (3, None)], "id int, text string")
    scored = E.first_score(E.sentiment(df, "text", {"good": 1.0, "bad": -2.0}))
    assert {r["id"]: r["sentimentScore"] for r in scored.collect()} == {1: 0.0, 2: None, 3: None}


TIERS = [{}, {"max_inline": 0}, {"max_inline": 0, "max_broadcast": 0}, {"max_inline": 0, "max_broadcast": 0, "min_rows": 1}]


@pytest.mark.parametrize("tier", TIERS)
def test_recognise_forms_agree(spark, tier):
    """Repeated and missing keys, equal texts, several words, capitals, letters of other languages."""
    rows = [
        (1, "rod ring ROD bolt"), (1, "none"), (None, "Bolt!"), (None, None), (2, "bolt, rod"), (2, "bolt, rod"), (3, ""),
        (4, "Ada-LOVELACE met ada; JOSÉ Muñoz été"), (5, "lovelace ada lovelaces"),
    ]
    texts = spark.createDataFrame([(i, k, t) for i, (k, t) in enumerate(rows)], "row int, id int, text string")
    names = spark.createDataFrame([("Rod",), ("bolt",), ("Ada Lovelace",), ("Ada",), ("José Muñoz",), ("ÉTÉ",), ("",), (None,), ("rod",)], "name string")
    found = E.recognise(texts, "text", names, **tier)
    found = found.select("row", F.col("celebs.result.celebrities.name").alias("n")).collect()
    assert {r["row"]: r["n"] for r in found} == {
        0: ["rod", "bolt"], 1: [], 2: ["bolt"], 3: None, 4: ["bolt", "rod"], 5: ["bolt", "rod"], 6: [],
        7: ["ada lovelace", "ada", "josé muñoz", "été"], 8: ["ada"],
    }
    assert len(found) == len(rows)


@pytest.mark.parametrize("tier", TIERS)
def test_sentiment_forms_agree(spark, tier):
    rows = [(1, "Good, good: BAD!"), (1, "nothing"), (None, None), (2, "été good"), (2, "été good"), (3, "")]
    df = spark.createDataFrame(rows, "id int, text string")
    table = spark.createDataFrame([("Good", 1.0), ("bad", -2.0), ("ÉTÉ", 3.0), ("", 9.0), ("nothing", None), ("bad", -4.0)], "word string, weight double")
    found = E.first_score(E.sentiment(df, "text", table, **tier)).collect()
    order = lambda pair: (pair[0] is None, pair[0] or 0, pair[1] is None)
    scores = sorted(((r["id"], r["sentimentScore"]) for r in found), key=order)
    assert scores == [(1, pytest.approx(-1 / 3)), (1, None), (2, 2.0), (2, 2.0), (3, None), (None, None)]


def test_scratch_scope_removes_what_it_made(spark, tmp_path):
    with scratch_scope(spark):
        inside = materialise(spark.range(3), "inside")
        path = inside.inputFiles()[0].rsplit("/", 1)[0]
        assert inside.count() == 3 and is_complete(spark, path)
        with scratch_scope(spark):
            pass
    assert not is_complete(spark, path)


def test_scratch_is_in_the_shared_folder(spark):
    assert scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert spark.sparkContext.getCheckpointDir() is not None


def test_chain_reuses_finished_steps(spark, tmp_path):
    ran = []

    def step(name, fn):
        return name, lambda s, df: (ran.append(name), fn(s, df))[1]

    steps = [step("one", lambda s, _: s.range(3)), step("two", lambda _, df: df.filter("id > 0"))]
    for expected in (["one", "two"], []):
        assert E.run_chain(spark, steps, str(tmp_path / "chain")).count() == 2
        assert ran == expected
        ran.clear()
    E.run_chain(spark, steps, str(tmp_path / "chain"), reuse=False)
    assert ran == ["one", "two"]


LIMIT = 0


def _above(df):
    return df.filter(F.col("id") > LIMIT)


def test_chain_notices_changed_steps_and_inputs(spark, tmp_path, monkeypatch):
    root, table, ran = str(tmp_path / "chain"), str(tmp_path / "table"), []
    spark.range(3).write.parquet(table)

    def run(n, more=0, read=False):
        ran.clear()
        first = (lambda s, _: s.read.parquet(table)) if read else (lambda s, _: s.range(n))
        note = lambda name, fn: (name, lambda s, df: (ran.append(name), fn(s, df))[1])
        steps = [note("one", first), note("two", lambda _, df: _above(df).withColumn("more", F.lit(more)))]
        return E.run_chain(spark, steps, root).count(), list(ran)

    assert run(3) == (2, ["one", "two"]) and run(3) == (2, [])
    assert run(5) == (4, ["one", "two"]) and run(5) == (4, [])
    assert run(5, more=1) == (4, ["two"]) and run(5, more=1) == (4, [])
    monkeypatch.setitem(globals(), "LIMIT", 2)
    assert run(5, more=1) == (2, ["two"]) and run(5, more=1) == (2, [])
    monkeypatch.setitem(globals(), "LIMIT", 0)
    assert run(0, read=True) == (2, ["one", "two"]) and run(0, read=True) == (2, [])
    spark.range(10, 14).write.mode("append").parquet(table)
    assert run(0, read=True) == (6, ["one", "two"]) and run(0, read=True) == (6, [])


def brute_names(text, names):
    found, wanted = re.findall(r"[^\W\d_]+", text.lower()), {}
    for name in names:
        own = re.findall(r"[^\W\d_]+", name.lower())
        places = [i for i in range(len(found)) if own and found[i : i + len(own)] == own]
        if places:
            wanted[" ".join(own)] = (places[0], -len(own))
    return sorted(wanted, key=wanted.get)


@pytest.mark.parametrize("tier", [{}, {"max_inline": 0}, {"max_inline": 0, "max_broadcast": 0}])
def test_names_of_several_words(spark, tier):
    pick = random.Random(11)
    word = lambda: pick.choice(["ann", "Ann", "bob", "de", "la", "cruz", "él"])
    texts = [", ".join(word() for _ in range(pick.randint(0, 25))) for _ in range(80)] + ["Ann-Ann de la  Cruz ann", "", "annbob"]
    names = sorted({" ".join(word() for _ in range(pick.randint(1, 4))) for _ in range(40)}) + ["not there", "Ann Nobody", "--"]
    rows = [(t, n, 0, 0) for n, t in enumerate(texts)] + [(None, 99, 0, 0)]
    docs = spark.createDataFrame(rows, "text string, _key int, _value int, _names int")
    found = E.recognise(docs, "text", spark.createDataFrame([(n,) for n in names], "name string"), **tier)
    assert found.columns == ["text", "_key", "_value", "_names", "celebs"]
    for r in found.select("text", "_key", F.col("celebs.result.celebrities.name").alias("got")).collect():
        assert r.got == (None if r.text is None else brute_names(r.text, names))


def test_stages_form_a_pipeline(spark, tmp_path):
    provider = lambda values: [{"images": [{"url": f"{v}/a"}, {"url": f"{v}/b"}]} for v in values]
    ask = Enrich(provider, "struct<images: array<struct<url: string>>>", "offset", "answer", concurrency=2)
    unpack = SelectColumns(inputCols=["offset", "answer.images"])
    model = PipelineModel([ask, unpack, ExplodeUrls(inputCol="images", outputCol="url")])
    assert bag(model.transform(page_offsets(spark, 2)).select("url")) == [("0/a",), ("0/b",), ("10/a",), ("10/b",)]
    stage = JoinLines(inputCol="lines", outputCol="text")
    stage.write().overwrite().save(str(tmp_path / "stage"))
    assert JoinLines.load(str(tmp_path / "stage")).getInputCol() == "lines"


def test_zip_and_udf(spark):
    df = spark.createDataFrame([([1, 2], [0.5, 0.25], "ab")], "items array<int>, ratings array<double>, name string")
    zipped = df.select(C.zip_recommendations("items", "ratings").alias("recommendations"))
    assert C.recommended_items(zipped).first()["items"] == [1, 2]
    assert C.apply_udf(df, lambda s: s.str.upper(), "name", "upper", "string").first()["upper"] == "AB"


def test_many_names_are_looked_for_by_parts_and_slices(spark, monkeypatch):
    monkeypatch.setattr(E, "PART_CHARS", 400)
    words = [f"{a}{b}" for a in "abcdef" for b in "xyz"]
    texts = [(i, " ".join(words[(i * 7 + j * j) % 18] for j in range(i % 25))) for i in range(60)]
    docs = spark.createDataFrame([*texts, *texts[10:40], (98, ""), (99, None)], "id int, text string")
    names = {" ".join(words[(n * 5 + j * (n % 3 + 1)) % 18] for j in range(1 + n % 4)) for n in range(120)}
    vocabulary = spark.createDataFrame([(n,) for n in names], "name string")
    for slices, tier in ((1_000_000, {}), (1_000_000, {"max_broadcast": 0}), (20, {"max_broadcast": 0})):
        monkeypatch.setattr(E, "SLICE_NAMES", slices)
        found = E.recognise(docs, "text", vocabulary, max_inline=0, **tier)
        assert "instr" not in found._jdf.queryExecution().toString()  # no scan of a text for each name
        rows = found.collect()
        assert len(rows) == 92
        for row in rows:
            if row["text"] is None:
                assert row["celebs"] is None
                continue
            whole = f" {row['text']} "
            held = sorted((whole.index(f" {n} "), -len(n), n) for n in names if f" {n} " in whole)
            assert [c["name"] for c in row["celebs"]["result"]["celebrities"]] == [n for _, _, n in held]


def test_words_of_a_large_lexicon_meet_texts_by_parts(spark, monkeypatch):
    monkeypatch.setattr(E, "PART_CHARS", 100)
    docs = spark.range(50).selectExpr("id", "concat_ws(' ', 'tail', repeat('head ', int(id % 4)), concat('w', id % 5)) AS text")
    lexicon = spark.createDataFrame([("head", 2.0), ("tail", -1.0), ("unseen", 9.0)], "word string, weight double")
    found = E.first_score(E.sentiment(docs, "text", lexicon, max_inline=0, max_broadcast=0))
    plan = found._jdf.queryExecution().toString()
    assert "FlatMapCoGroupsInArrow" in plan  # no row for each word of each text
    for row in found.collect():
        n = row["id"] % 4
        assert abs(row["sentimentScore"] - (2.0 * n - 1.0) / (n + 1)) < 1e-9
