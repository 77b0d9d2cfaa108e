"""Registered queries over the driver's tables, each with its SQL oracle where one exists."""

from __future__ import annotations

import importlib
import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.tuning import ParamGridBuilder

from recmill.functions import columns as C
from recmill.functions import metrics as M
from recmill.functions.pairs import fcp
from recmill.operators import enrich as E
from recmill.operators import indexing as I
from recmill.operators import model as L
from recmill.operators import prep as P
from recmill.operators import recommend as R
from recmill.operators import serving as V
from recmill.operators import splits as S
from recmill.operators.skew import lookup_join
from recmill.plans import workflows as W
from recmill.sources import messages as G
from recmill.sources import ratings as T
from recmill.sources.scratch import materialise, scratch_path
from recmill.sources.steps import write_step
from recmill.streaming import ratings as Z

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_ORACLES: dict[str, str] = {}

CUT = "2024-01-24 00:00:00"  # items active after this moment are recommended (events)
SPARSE_CUT = "1996-01-01 00:00:00"  # the same for orders and lineitem
COLD_CUT = "1995-06-01 00:00:00"
LEXICON = {"pathetic": -2.0, "worthless": -2.0, "disgusting": -3.0, "only": -0.5, "with": 0.5, "that": 0.25, "for": 1.0}
DROP = {"event_type": ["signup", "error"], "item": [0]}
ABOVE = {"rating": 10}
MESSAGE = "event_id BIGINT, userId BIGINT, movieId BIGINT, rating INT"


def _register(name: str, sql: str | None = None):
    def add(query: Query) -> Query:
        _QUERIES[name] = query
        if sql is not None:
            _ORACLES[name] = sql
        return query

    return add


# Inputs -------------------------------------------------------------------------------------


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dense ratings: event_id, user, item, rating, ts, event_type."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    decoded = G.decode_json(_table(spark, sf_dir, "events"), "props", "k BIGINT")
    return decoded.select(
        "event_id",
        F.col("user_id").alias("user"),
        F.col("k").alias("item"),
        F.col("value").alias("rating"),
        F.col("ts").cast("timestamp").alias("ts"),
        "event_type",
    )


def _sparse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sparse ratings: line_id, user, item, rating, ts from orders and lineitem."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    lines = _table(spark, sf_dir, "lineitem")
    joined = lines.join(orders, lines.l_orderkey == orders.o_orderkey)
    return joined.select(
        "l_orderkey",
        "l_linenumber",
        "l_suppkey",
        F.col("o_custkey").alias("user"),
        F.col("l_partkey").alias("item"),
        F.col("l_quantity").alias("rating"),
        F.col("o_orderdate").cast("timestamp").alias("ts"),
    )


def _stored(spark: SparkSession, sf_dir: str, ratings: Query, *more: str) -> DataFrame:
    """The ratings written once, for queries that read them several times."""
    return materialise(ratings(spark, sf_dir).select("user", "item", "rating", "ts", *more), "ratings")


EVENTS_SQL = """r AS (
  SELECT event_id, user_id::BIGINT AS "user", json_extract_string(props, '$.k')::BIGINT AS item,
         value AS rating, ts, event_type FROM events)"""
SPARSE_SQL = """r AS (
  SELECT l_orderkey, l_linenumber, l_suppkey, o_custkey::BIGINT AS "user", l_partkey::BIGINT AS item,
         l_quantity AS rating, o_orderdate AS ts
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""
POP_SQL = "pop AS (SELECT item, count(*) AS score FROM r GROUP BY item)"
PAIRS_SQL = 'pairs AS (SELECT DISTINCT "user", item FROM r)'


def _at(moment: str):
    return F.lit(moment).cast("timestamp")


def _r6(col: str):
    return F.round(F.col(col).cast("double"), 6).alias(col)


def _listed(recs: DataFrame) -> DataFrame:
    """Recommendation lists as rows (user, position, item, rating)."""
    rows = recs.select("user", F.posexplode("recommendations").alias("_p", "_e"))
    return rows.select(
        F.col("user").cast("long").alias("user"),
        (F.col("_p") + 1).alias("position"),
        F.col("_e.itemId").alias("item"),
        F.round(F.col("_e.rating").cast("double"), 6).alias("rating"),
    )


def _hash_sql(key: str, seed: str) -> str:
    return f"('0x' || substr(md5({key} || '-{seed}'), 1, 8))::BIGINT"


# Sources and sinks --------------------------------------------------------------------------


@_register("csv_roundtrip", f'WITH {EVENTS_SQL} SELECT event_id, "user", item, rating FROM r')
def csv_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "csv")
    padded = _events(spark, sf_dir).select(
        "event_id", "user", F.concat(F.lit("  "), F.col("item"), F.lit(" ")).alias("item"), "rating"
    )
    options = {"header": True, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    padded.write.options(**options).csv(path)
    return T.read_ratings_csv(spark, path, "event_id BIGINT, user BIGINT, item BIGINT, rating DOUBLE")


@_register("json_roundtrip", f'WITH {EVENTS_SQL} SELECT event_id, "user", item, rating, event_type FROM r')
def json_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "json")
    _events(spark, sf_dir).drop("ts").write.json(path)
    schema = "event_id BIGINT, user BIGINT, item BIGINT, rating DOUBLE, event_type STRING"
    return T.read_activity_json(spark, path, schema)


@_register("decode_props", "SELECT event_id, json_extract_string(props, '$.k')::INT AS k FROM events")
def decode_props(spark, sf_dir):
    return G.decode_json(_table(spark, sf_dir, "events").select("event_id", "props"), "props", "k INT")


def _messages(spark, sf_dir) -> DataFrame:
    """Events as hub messages: key, time and a JSON body of strings."""
    named = _events(spark, sf_dir).select(
        "event_id",
        "ts",
        F.col("user").alias("userId"),
        F.col("item").alias("movieId"),
        F.floor("rating").cast("int").alias("rating"),
    )
    return G.encode_messages(named, ["event_id", "userId", "movieId", "rating"], keep=["event_id", "ts"])


MESSAGE_SQL = 'SELECT event_id, "user" AS "userId", item AS "movieId", floor(rating)::INT AS rating FROM r'


@_register("encode_messages", f"WITH {EVENTS_SQL} {MESSAGE_SQL}")
def encode_messages(spark, sf_dir):
    return G.decode_messages(_messages(spark, sf_dir), MESSAGE)


def _captured(spark, sf_dir, **options) -> str:
    root = scratch_path(spark, "capture")
    G.write_capture(_messages(spark, sf_dir), root, "ts", "event_id", **options)
    return root


@_register(
    "capture_read",
    f"WITH {EVENTS_SQL} {MESSAGE_SQL} WHERE {_hash_sql('event_id', '')} % 2 = 0",
)
def capture_read(spark, sf_dir):
    captured = G.read_capture(spark, _captured(spark, sf_dir, interval="1 day"), partition=0)
    return G.decode_messages(captured.select("Body"), MESSAGE)


@_register(
    "capture_whole",
    f"""WITH {EVENTS_SQL}, p AS (SELECT event_id, ({_hash_sql('event_id', '')} % 2)::INT AS part,
      strftime(make_timestamp(epoch_us(ts) // 21600000000 * 21600000000), '%Y-%m-%d %H:%M') AS started FROM r)
    SELECT event_id, part, started FROM p""",
)
def capture_whole(spark, sf_dir):
    """Every message of a six-hourly capture, with the partition and the time its folder names."""
    captured = G.read_capture(spark, _captured(spark, sf_dir, interval="6 hours"))
    day = F.format_string("%04d-%02d-%02d %02d:%02d", "Year", "Month", "Day", "Hour", "Minute")
    placed = captured.select("Body", F.col("PartitionId").alias("part"), day.alias("started"))
    return G.decode_messages(placed, "event_id BIGINT", keep=True).select("event_id", "part", "started")


PACKED_SQL = f"""WITH {EVENTS_SQL} SELECT event_id, "user" AS "userId", item AS "movieId",
  ({_hash_sql('event_id', '')} % 2)::INT AS part, epoch(date_trunc('minute', ts))::BIGINT AS start_s FROM r"""


def _packed(spark, sf_dir, **bounds) -> DataFrame:
    """A packed capture of the default 60 s, written by two calls; the second is given all intervals again."""
    root, messages = scratch_path(spark, "packed"), _messages(spark, sf_dir)
    for part in (messages.filter(F.col("ts") < _at(CUT)), messages):
        G.write_packed(part, root, "ts", "event_id")
    found = G.read_packed(spark, root, "event_id BIGINT, ts TIMESTAMP, Body BINARY", **bounds)
    placed = found.select("Body", F.col("PartitionId").alias("part"), C.epoch_seconds("start").alias("start_s"))
    return G.decode_messages(placed, "event_id BIGINT, userId BIGINT, movieId BIGINT", keep=True)


@_register("capture_packed", PACKED_SQL)
def capture_packed(spark, sf_dir):
    return _packed(spark, sf_dir)


@_register(
    "capture_packed_range",
    f"SELECT * FROM ({PACKED_SQL}) WHERE part = 1 AND start_s >= epoch(TIMESTAMP '{CUT}') - 432000 AND start_s < epoch(TIMESTAMP '{CUT}')",
)
def capture_packed_range(spark, sf_dir):
    """One partition's messages of the five days before ``CUT``, by the files that the manifest names."""
    return _packed(spark, sf_dir, partition=1, since=_at(CUT) - F.expr("INTERVAL 5 DAYS"), until=_at(CUT))


@_register(
    "csv_rejects",
    f"""WITH {EVENTS_SQL} SELECT event_id, CASE WHEN event_id % 5 = 0 OR event_id % 7 = 0 THEN 'malformed'
      WHEN event_id % 11 = 0 THEN 'incomplete' ELSE 'good' END AS kind,
      CASE WHEN event_id % 5 <> 0 AND event_id % 7 <> 0 AND event_id % 11 <> 0 THEN item END AS item,
      CASE WHEN event_id % 5 <> 0 AND event_id % 7 <> 0 AND event_id % 11 <> 0 THEN "user" END AS "user" FROM r""",
)
def csv_rejects(spark, sf_dir):
    """Events as CSV lines, some with a text for an item, some a value short, some without a user; every line comes back once."""
    path = scratch_path(spark, "lines")
    events = _events(spark, sf_dir)
    of = lambda n: F.col("event_id") % n == 0
    item = F.when(of(5), F.concat(F.lit("item "), F.col("item"))).otherwise(F.col("item").cast("string"))
    user = F.when(of(11), "").otherwise(F.col("user").cast("string"))
    whole = F.concat_ws(",", "event_id", user, F.coalesce(item, F.lit("")), F.col("rating").cast("string"))
    events.select(F.when(of(7), F.concat_ws(",", "event_id", user)).otherwise(whole).alias("value")).write.text(path)
    schema = "event_id BIGINT, user BIGINT, item BIGINT, rating DOUBLE"
    good, rejected = T.read_checked(spark, path, schema, required=["user"], header=False)
    kept = good.select("event_id", F.lit("good").alias("kind"), "item", "user")
    number = F.regexp_extract("line", r'^(?:\{"event_id":)?(\d+)', 1).cast("long").alias("event_id")
    none = F.lit(None).cast("long")
    return kept.unionByName(rejected.select(number, F.col("reason").alias("kind"), none.alias("item"), none.alias("user")))


@_register(
    "capture_intervals",
    f"""WITH {EVENTS_SQL} SELECT ({_hash_sql('event_id', '')} % 2)::INT AS partition_id,
    epoch(date_trunc('minute', ts))::BIGINT AS start_s, count(*) AS n FROM r GROUP BY ALL""",
)
def capture_intervals(spark, sf_dir):
    placed = _events(spark, sf_dir).select(
        G.partition_id("event_id", 2).alias("partition_id"),
        C.epoch_seconds(G.capture_interval("ts")).alias("start_s"),
    )
    return placed.groupBy("partition_id", "start_s").agg(F.count(F.lit(1)).alias("n"))


@_register("step_roundtrip", "SELECT * FROM part")
def step_roundtrip(spark, sf_dir):
    return write_step(_table(spark, sf_dir, "part"), scratch_path(spark, "step"))


@_register(
    "page_offsets",
    """SELECT source, unnest(range(0, count(*), 10))::BIGINT AS "offset" FROM documents GROUP BY source""",
)
def page_offsets(spark, sf_dir):
    """Result pages of ten for each source, as many as its documents fill."""
    return T.page_offsets_by(_table(spark, sf_dir, "documents"), "source", per_page=10)


def _last_items(df: DataFrame) -> DataFrame:
    rows = df.select(F.col("user").cast("string").alias("id"), "item", "event_id", "ts")
    return V.latest_per_key(rows, "id", ["ts", "event_id"])


LAST_SQL = f"""WITH {EVENTS_SQL}, ranked AS (SELECT *, row_number() OVER
  (PARTITION BY "user" ORDER BY ts DESC NULLS LAST, event_id DESC) AS n FROM r)
  SELECT "user"::VARCHAR AS id, item, event_id FROM ranked WHERE n = 1"""
NEWEST = ["ts", "event_id"]


def _halves(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows after CUT, all others): the newer ones first."""
    newer = F.coalesce(F.col("ts") > _at(CUT), F.lit(False))
    return rows.filter(newer), rows.filter(~newer)


def _published(spark, sf_dir) -> str:
    path = scratch_path(spark, "serving")
    for batch in _halves(_events(spark, sf_dir)):
        V.publish_upsert(spark, path, _last_items(batch), order=NEWEST)
    return path


@_register("upsert_serving", LAST_SQL)
def upsert_serving(spark, sf_dir):
    return V.read_serving(spark, _published(spark, sf_dir), order=NEWEST).drop("ts")


@_register("lookup", f"SELECT * FROM ({LAST_SQL}) WHERE id IN ('1', '7', '42')")
def lookup(spark, sf_dir):
    return V.read_serving(spark, _published(spark, sf_dir), ids=[1, 7, 42], order=NEWEST).drop("ts")


# Projections, filters and simple aggregates -------------------------------------------------


@_register(
    "to_ratings", f'WITH {EVENTS_SQL} SELECT "user", item, rating, epoch_us(ts) // 1000000 AS ts_s FROM r'
)
def to_ratings(spark, sf_dir):
    ratings = P.to_ratings(_events(spark, sf_dir), "user", "item", "rating", "ts")
    return ratings.select("user", "item", "rating", C.epoch_seconds("ts").alias("ts_s"))


@_register("select_columns", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def select_columns(spark, sf_dir):
    return C.select_columns(_table(spark, sf_dir, "orders"), ["o_orderkey", "o_custkey", "o_totalprice"])


SHIFT_SQL = "(item + 10 * {n})::BIGINT AS item, epoch_us(ts) // 1000000 + 100000000 * {n} AS ts_s"


def _seconds(spark, sf_dir):
    events = _events(spark, sf_dir)
    return events.select("event_id", "user", F.col("item").cast("long"), C.epoch_seconds("ts").alias("ts_s"))


@_register("shift_days", f'WITH {EVENTS_SQL} SELECT event_id, "user", {SHIFT_SQL.format(n=2)} FROM r')
def shift_days(spark, sf_dir):
    return P.shift_days(_seconds(spark, sf_dir), 2, 10, 100_000_000, "item", "ts_s")


@_register(
    "append_days",
    f"WITH {EVENTS_SQL} "
    + " UNION ALL ".join(f'SELECT event_id, "user", {SHIFT_SQL.format(n=n)} FROM r' for n in range(4)),
)
def append_days(spark, sf_dir):
    base = _seconds(spark, sf_dir)
    return P.append_all(*[P.shift_days(base, n, 10, 100_000_000, "item", "ts_s") for n in range(4)])


@_register("with_expr", "SELECT o_orderkey, round(o_totalprice * 0.5, 6) AS half FROM orders")
def with_expr(spark, sf_dir):
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return C.with_expr(orders, "round(o_totalprice * 0.5D, 6)", "half").drop("o_totalprice")


CLEAN_SQL = "event_type <> 'signup' AND event_type <> 'error' AND item <> 0 AND rating > 10"


@_register("clean_activity", f'WITH {EVENTS_SQL} SELECT event_id, "user", item, rating FROM r WHERE {CLEAN_SQL}')
def clean_activity(spark, sf_dir):
    kept = P.clean_activity(_events(spark, sf_dir), DROP, ABOVE)
    return kept.select("event_id", "user", "item", "rating")


@_register("filter_rating", f"WITH {EVENTS_SQL} {MESSAGE_SQL} WHERE floor(rating) > 3")
def filter_rating(spark, sf_dir):
    as_text = "event_id BIGINT, userId BIGINT, movieId BIGINT, rating STRING"
    decoded = G.decode_messages(_messages(spark, sf_dir), as_text)
    return G.filter_rating(decoded, 3).withColumn("rating", F.col("rating").cast("int"))


@_register("active_items", f"WITH {SPARSE_SQL} SELECT DISTINCT item FROM r WHERE ts > TIMESTAMP '{SPARSE_CUT}'")
def active_items(spark, sf_dir):
    return P.active_items(_sparse(spark, sf_dir), _at(SPARSE_CUT))


@_register("group_counts", f"WITH {EVENTS_SQL} SELECT item, count(ts) AS group_count FROM r GROUP BY item")
def group_counts(spark, sf_dir):
    return P.group_counts(_events(spark, sf_dir), "item", "ts")


@_register("distinct_users", 'SELECT DISTINCT user_id::BIGINT AS "user" FROM events')
def distinct_users(spark, sf_dir):
    return P.distinct_keys(_events(spark, sf_dir), "user")


@_register(
    "split_summary",
    f"""WITH {EVENTS_SQL}, s AS (SELECT {_hash_sql('event_id', '123')} / 4294967296.0 < 0.75 AS train FROM r)
    SELECT CASE WHEN train THEN 'train' ELSE 'test' END AS split, count(*) AS n_rows, 6::BIGINT AS n_cols
    FROM s GROUP BY train""",
)
def split_summary(spark, sf_dir):
    train, test = S.hash_split(_events(spark, sf_dir), ["event_id"])
    return P.split_summary(train=train, test=test)


@_register("order_ratings", f'WITH {EVENTS_SQL} SELECT "user", item, rating FROM r')
def order_ratings(spark, sf_dir):
    return P.order_ratings(_events(spark, sf_dir).select("user", "item", "rating"))


@_register(
    "head_rows",
    f'WITH {EVENTS_SQL} SELECT event_id, "user", item FROM r ORDER BY "user", item, event_id LIMIT 50',
)
def head_rows(spark, sf_dir):
    rows = _events(spark, sf_dir).select("event_id", "user", "item")
    return P.head_rows(rows, 50, ["user", "item", "event_id"])


@_register(
    "best_run",
    f"""WITH {EVENTS_SQL}, m AS (
      SELECT 'global' AS run_id, rating - avg(rating) OVER () AS e FROM r
      UNION ALL SELECT 'item', rating - avg(rating) OVER (PARTITION BY item) FROM r
      UNION ALL SELECT 'user', rating - avg(rating) OVER (PARTITION BY "user") FROM r),
    v AS (SELECT run_id, sqrt(avg(e * e)) AS value FROM m GROUP BY run_id)
    SELECT run_id, round(value, 6) AS value FROM v ORDER BY v.value, run_id LIMIT 1""",
)
def best_run(spark, sf_dir):
    """Baseline predictors as runs: global mean, item mean, user mean."""
    events = _stored(spark, sf_dir, _events).select("user", "item", "rating")
    runs = [events.withColumn("prediction", events.agg(F.avg("rating")).scalar())]
    for key in ("item", "user"):
        means = events.groupBy(key).agg(F.avg("rating").alias("prediction"))
        runs.append(lookup_join(events, means, key))
    tables = [
        M.rmse(run).select(F.lit(name).alias("run_id"), F.lit("rmse").alias("metric"), F.col("rmse").alias("value"))
        for name, run in zip(("global", "item", "user"), runs)
    ]
    return P.best_run(P.append_all(*tables), "rmse").select("run_id", _r6("value"))


# Windows, splits and samples ----------------------------------------------------------------

RANK_SQL = 'row_number() OVER (PARTITION BY {key} ORDER BY ts DESC, {tie})'


@_register(
    "with_group_count", f'WITH {EVENTS_SQL} SELECT event_id, "user", count(ts) OVER (PARTITION BY "user") AS n FROM r'
)
def with_group_count(spark, sf_dir):
    return S.with_group_count(_events(spark, sf_dir), "user", "ts", "n").select("event_id", "user", "n")


@_register(
    "recency_rank",
    f"""WITH {EVENTS_SQL} SELECT event_id, {RANK_SQL.format(key='"user"', tie='event_id')} AS rank FROM r""",
)
def recency_rank(spark, sf_dir):
    ranked = S.recency_rank(_events(spark, sf_dir), "user", "ts", ["event_id"])
    return ranked.select("event_id", "rank")


@_register(
    "recency_fraction",
    f"""WITH {EVENTS_SQL} SELECT event_id, round({RANK_SQL.format(key='"user"', tie='event_id')} /
    count(ts) OVER (PARTITION BY "user"), 6) AS fraction FROM r""",
)
def recency_fraction(spark, sf_dir):
    ranked = S.recency_fraction(_events(spark, sf_dir), "user", "ts", ["event_id"])
    return ranked.select("event_id", _r6("fraction"))


def _chrono_sql(key: str, side: str) -> str:
    return f"""WITH {EVENTS_SQL}, s AS (SELECT *, {RANK_SQL.format(key=key, tie='event_id')} /
    count(ts) OVER (PARTITION BY {key}) AS share FROM r)
    SELECT event_id, "user", item, rating FROM s WHERE share {side} 0.75"""


def _chrono(spark, sf_dir, filter_by: str) -> list[DataFrame]:
    sides = S.chrono_split(_events(spark, sf_dir), filter_by=filter_by, tiebreak=["event_id"])
    return [side.select("event_id", "user", "item", "rating") for side in sides]


@_register("chrono_left", _chrono_sql('"user"', "<="))
def chrono_left(spark, sf_dir):
    return _chrono(spark, sf_dir, "user")[0]


@_register("chrono_right", _chrono_sql('"user"', ">"))
def chrono_right(spark, sf_dir):
    return _chrono(spark, sf_dir, "user")[1]


@_register("chrono_item", _chrono_sql("item", "<="))
def chrono_item(spark, sf_dir):
    return _chrono(spark, sf_dir, "item")[0]


SPARSE_TIES = ["l_orderkey", "l_linenumber", "item", "l_suppkey", "rating"]


@_register(
    "chrono_sparse",
    f"""WITH {SPARSE_SQL}, s AS (SELECT *, row_number() OVER (PARTITION BY "user"
      ORDER BY ts DESC, {', '.join(SPARSE_TIES)}) / count(ts) OVER (PARTITION BY "user") AS share FROM r)
    SELECT l_orderkey, l_linenumber, "user", item, rating,
      CASE WHEN share <= 0.75 THEN 'left' ELSE 'right' END AS side FROM s""",
)
def chrono_sparse(spark, sf_dir):
    sided = S.chrono_side(_sparse(spark, sf_dir), tiebreak=SPARSE_TIES)
    return sided.select("l_orderkey", "l_linenumber", "user", "item", "rating", "side")


@_register("chrono_heavy", _chrono_sql('"user"', "<="))
def chrono_heavy(spark, sf_dir):
    """The chronological split with its form for heavy users, here those above 66 rows."""
    left, _ = S.chrono_split(_events(spark, sf_dir), tiebreak=["event_id"], min_rows=66)
    return left.select("event_id", "user", "item", "rating")


@_register("random_split")
def random_split(spark, sf_dir):
    return S.random_split(_events(spark, sf_dir))[0]


@_register(
    "hash_split",
    f"""WITH {EVENTS_SQL} SELECT event_id, "user", item FROM r
    WHERE {_hash_sql('event_id', '123')} / 4294967296.0 < 0.75""",
)
def hash_split(spark, sf_dir):
    return S.hash_split(_events(spark, sf_dir), ["event_id"])[0].select("event_id", "user", "item")


@_register(
    "sample_exact",
    f"""WITH {EVENTS_SQL} SELECT event_id, "user", item FROM r ORDER BY md5(event_id || '-123')
    LIMIT (SELECT floor(0.75 * count(*))::BIGINT FROM r)""",
)
def sample_exact(spark, sf_dir):
    rows = _events(spark, sf_dir).select("event_id", "user", "item")
    return S.sample_exact(rows, 0.75, ["event_id"])


@_register("sample_rows")
def sample_rows(spark, sf_dir):
    return S.sample_rows(_events(spark, sf_dir))


def _ratio_sql(side: str) -> str:
    return f"""WITH {EVENTS_SQL}, s AS (SELECT *, row_number() OVER (PARTITION BY "user"
      ORDER BY md5(event_id || '-42'), event_id) / count(*) OVER (PARTITION BY "user") AS share FROM r)
    SELECT event_id, "user", item, rating FROM s WHERE share {side} 0.8"""


def _ratio(spark, sf_dir, side: int) -> DataFrame:
    parts = S.user_ratio_split(_events(spark, sf_dir), 0.8, key=["event_id"])
    return parts[side].select("event_id", "user", "item", "rating")


@_register("user_ratio_train", _ratio_sql("<="))
def user_ratio_train(spark, sf_dir):
    return _ratio(spark, sf_dir, 0)


@_register("user_ratio_valid", _ratio_sql(">"))
def user_ratio_valid(spark, sf_dir):
    return _ratio(spark, sf_dir, 1)


@_register("fold_column", f"SELECT event_id, ({_hash_sql('event_id', '42')} % 3)::INT AS fold FROM events")
def fold_column(spark, sf_dir):
    return S.fold_column(_table(spark, sf_dir, "events").select("event_id"), ["event_id"])


# Indexing -----------------------------------------------------------------------------------

INDEX_SQL = """idx AS (SELECT {col} AS label, (row_number() OVER (ORDER BY count(*) DESC,
  {col}::VARCHAR) - 1)::INT AS "index" FROM {rows} GROUP BY {col})"""


@_register(
    "index_item",
    f"""WITH {EVENTS_SQL}, {INDEX_SQL.format(col='item', rows='r')}
    SELECT event_id, item, "index" AS "itemIndex" FROM r JOIN idx ON item = label""",
)
def index_item(spark, sf_dir):
    rows = _events(spark, sf_dir).select("event_id", "item")
    return I.index_column(rows, "item", C.index_name("itemId"))


@_register(
    "index_heavy",
    f"""WITH {EVENTS_SQL}, {INDEX_SQL.format(col='item', rows='r')}
    SELECT event_id, item, "index" AS "itemIndex" FROM r JOIN idx ON item = label""",
)
def index_heavy(spark, sf_dir):
    """The same index with the form for more labels, and rows per label, than one task takes."""
    rows = _events(spark, sf_dir).select("event_id", "item")
    return I.index_column(rows, "item", "itemIndex", min_rows=50)


@_register(
    "index_user_sparse",
    f"""WITH {SPARSE_SQL}, {INDEX_SQL.format(col='"user"', rows='r')} SELECT label, "index" FROM idx""",
)
def index_user_sparse(spark, sf_dir):
    return I.label_index(_sparse(spark, sf_dir), "user").drop("n")


@_register(
    "index_unseen",
    f"""WITH {SPARSE_SQL}, early AS (SELECT * FROM r WHERE ts <= TIMESTAMP '{COLD_CUT}'),
    {INDEX_SQL.format(col='item', rows='early')}
    SELECT l_orderkey, l_linenumber, item,
      coalesce("index", (SELECT count(*)::INT FROM idx)) AS item_index
    FROM r LEFT JOIN idx ON item = label""",
)
def index_unseen(spark, sf_dir):
    rows = _stored(spark, sf_dir, _sparse, "l_orderkey", "l_linenumber").drop("user", "rating")
    early = I.label_index(rows.filter(F.col("ts") <= _at(COLD_CUT)), "item")
    return I.apply_index(rows.drop("ts"), early, "item", "item_index")


# Recommendation with the popularity scorer --------------------------------------------------


@_register(
    "candidate_counts",
    f"""WITH {SPARSE_SQL}, c AS (SELECT count(DISTINCT "user") AS n_users, count(DISTINCT item)
      FILTER (WHERE ts > TIMESTAMP '{SPARSE_CUT}') AS n_items FROM r)
    SELECT n_users, n_items, n_users * n_items AS n_pairs FROM c""",
)
def candidate_counts(spark, sf_dir):
    return R.candidate_counts(_sparse(spark, sf_dir), _at(SPARSE_CUT))


def _top_sql(rows: str, k: int, active: str = "TRUE") -> str:
    """Top-k by interaction count among active items, for every user of ``rows``."""
    return f"""pop AS (SELECT item, count(*) AS score FROM {rows} GROUP BY item),
    act AS (SELECT DISTINCT item FROM {rows} WHERE {active}),
    top AS (SELECT item, score, row_number() OVER (ORDER BY score DESC, item) AS position
      FROM pop WHERE item IN (SELECT item FROM act)
      QUALIFY row_number() OVER (ORDER BY score DESC, item) <= {k}),
    users AS (SELECT DISTINCT "user" FROM {rows})"""


LISTED_SQL = """SELECT "user", position::INT AS position, item, score::DOUBLE AS rating FROM users, top"""


@_register(
    "recommend_active_pop",
    f"""WITH {EVENTS_SQL}, {_top_sql('r', 5, f"ts > TIMESTAMP '{CUT}'")} {LISTED_SQL}""",
)
def recommend_active_pop(spark, sf_dir):
    return _listed(R.recommend_active_popular(_events(spark, sf_dir), _at(CUT), 5))


@_register(
    "recommend_active_sparse",
    f"""WITH {SPARSE_SQL}, {_top_sql('r', 10, f"ts > TIMESTAMP '{SPARSE_CUT}'")} {LISTED_SQL}""",
)
def recommend_active_sparse(spark, sf_dir):
    return _listed(R.recommend_active_popular(_sparse(spark, sf_dir), _at(SPARSE_CUT), 10))


FLAGSHIP_SQL = f"""WITH {EVENTS_SQL}, clean AS (SELECT * FROM r WHERE {CLEAN_SQL}),
  s AS (SELECT *, {RANK_SQL.format(key='"user"', tie='event_id')} /
    count(ts) OVER (PARTITION BY "user") AS share FROM clean),
  kept AS (SELECT * FROM s WHERE share <= 0.75),
  {_top_sql('kept', 5, f"ts > TIMESTAMP '{CUT}'")} {LISTED_SQL}"""


@_register("popular_active_workflow", FLAGSHIP_SQL)
def popular_active_workflow(spark, sf_dir):
    return _listed(W.popular_active_workflow(_events(spark, sf_dir), DROP, ABOVE, _at(CUT)))


def _popular(df: DataFrame, k: int) -> DataFrame:
    return R.recommend_popular(df.select("user").distinct(), R.popularity(df), k)


@_register(
    "recommended_items",
    f"""WITH {EVENTS_SQL}, {_top_sql('r', 10)}
    SELECT "user", (SELECT string_agg(item, ',' ORDER BY position) FROM top) AS items FROM users""",
)
def recommended_items(spark, sf_dir):
    listed = C.recommended_items(_popular(_events(spark, sf_dir), 10))
    return listed.select("user", F.array_join(F.col("items").cast("array<string>"), ",").alias("items"))


@_register("zip_recs", f"WITH {EVENTS_SQL}, {_top_sql('r', 10)} {LISTED_SQL}")
def zip_recs(spark, sf_dir):
    recs = _popular(_events(spark, sf_dir), 10)
    zipped = C.zip_recommendations(F.col("recommendations.itemId"), F.col("recommendations.rating"))
    return _listed(recs.withColumn("recommendations", zipped))


@_register(
    "cold_items",
    f"""WITH {SPARSE_SQL} SELECT item FROM r GROUP BY item HAVING min(ts) > TIMESTAMP '{COLD_CUT}'""",
)
def cold_items(spark, sf_dir):
    return P.cold_items(_sparse(spark, sf_dir), _at(COLD_CUT))


@_register(
    "inject_cold",
    f"""WITH {SPARSE_SQL}, {_top_sql('r', 10)},
    cold AS (SELECT item AS cold_item, row_number() OVER (ORDER BY md5(item || '-42'), item) AS n
      FROM (SELECT item FROM r GROUP BY item HAVING min(ts) > TIMESTAMP '{COLD_CUT}')),
    served AS (SELECT "user", position::INT AS position, item, "user" || '-' || position AS slot FROM users, top),
    picked AS (SELECT *, CASE WHEN {_hash_sql('slot', '42')} / 4294967296.0 < 0.01
      THEN {_hash_sql('slot', '42-item')} % (SELECT count(*) FROM cold) + 1 END AS pick FROM served)
    SELECT "user", position, coalesce(cold_item, item) AS item,
      CASE WHEN cold_item IS NULL THEN 'warm' ELSE 'cold' END AS exposed
    FROM picked LEFT JOIN cold ON pick = n""",
)
def inject_cold(spark, sf_dir):
    sparse = _stored(spark, sf_dir, _sparse)
    return R.inject_cold(_popular(sparse, 10), P.cold_items(sparse, _at(COLD_CUT)), 0.01, 42)


@_register(
    "serve",
    f"""WITH {EVENTS_SQL}, {_top_sql('r', 10)},
    docs AS (SELECT "user" AS id, '{{"id":"' || "user" || '","items":[' ||
      (SELECT string_agg(item, ',' ORDER BY position) FROM top) || ']}}' AS response FROM users)
    SELECT o_orderkey, response FROM orders LEFT JOIN docs ON o_custkey = id""",
)
def serve(spark, sf_dir):
    documents = V.serving_documents(_popular(_events(spark, sf_dir), 10))
    requests = _table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").cast("string").alias("id"))
    return V.serve(requests, documents).select("o_orderkey", "response")


# Evaluation ---------------------------------------------------------------------------------


def _frame(df: DataFrame, k: int = 5) -> DataFrame:
    return M.ranking_frame(_popular(df, k), df, k)


def _scored(df: DataFrame) -> DataFrame:
    """Ratings with the item's interaction count as the prediction."""
    scores = R.popularity(df, out="prediction")
    return lookup_join(df.select("user", "item", F.col("rating").alias("label")), scores, "item")


def _metric_sql(rows: str, k: int = 3) -> str:
    """Per-user ndcg, ap, recall and rr of the popularity list cut at k."""
    ideal = " ".join(
        f"WHEN {n} THEN {'+'.join(f'1/log2({i + 1})' for i in range(1, n + 1))}" for n in range(1, k + 1)
    )
    return f"""{rows}, {_top_sql('r', k)}, {PAIRS_SQL},
    labels AS (SELECT "user", count(*) AS n_labels FROM pairs GROUP BY "user"),
    hits AS (SELECT "user", position, row_number() OVER (PARTITION BY "user" ORDER BY position) AS nth
      FROM pairs JOIN top USING (item)),
    sums AS (SELECT "user", count(*) AS n_hits, sum(1 / log2(position + 1)) AS dcg,
      sum(nth / position) AS ap, 1 / min(position) AS rr FROM hits GROUP BY "user"),
    per_user AS (SELECT "user",
      coalesce(dcg, 0) / CASE least(n_labels, {k}) {ideal} END AS ndcg,
      coalesce(ap, 0) / n_labels AS ap, coalesce(n_hits, 0) / n_labels AS recall, coalesce(rr, 0) AS rr
      FROM labels LEFT JOIN sums USING ("user"))"""


def _fcp_sql(rows: str) -> str:
    return f"""{rows}, {POP_SQL},
    points AS (SELECT "user", item, avg(rating) AS label, max(score) AS prediction
      FROM r JOIN pop USING (item) GROUP BY "user", item),
    counted AS (SELECT count(*) FILTER (WHERE a.prediction > b.prediction) AS good, count(*) AS n
      FROM points a JOIN points b ON a."user" = b."user" AND a.label > b.label)"""


@_register(
    "ranking_frame",
    f"""WITH {EVENTS_SQL}, {_top_sql('r', 5)}, {PAIRS_SQL},
    labels AS (SELECT "user", count(*)::BIGINT AS n_labels FROM pairs GROUP BY "user"),
    hits AS (SELECT "user", string_agg(position, ',' ORDER BY position) AS hits
      FROM pairs JOIN top USING (item) GROUP BY "user")
    SELECT "user", (SELECT string_agg(item, ',' ORDER BY position) FROM top) AS prediction,
      coalesce(hits, '') AS hits, n_labels FROM labels LEFT JOIN hits USING ("user")""",
)
def ranking_frame(spark, sf_dir):
    frame = _frame(_events(spark, sf_dir))
    return frame.select(
        "user",
        F.array_join(F.col("prediction").cast("array<string>"), ",").alias("prediction"),
        F.array_join(F.col("hits").cast("array<string>"), ",").alias("hits"),
        "n_labels",
    )


@_register(
    "label_lists",
    f"""WITH {EVENTS_SQL}, {PAIRS_SQL}
    SELECT "user", 0::BIGINT AS part, string_agg(item, ',' ORDER BY item) AS labels FROM pairs GROUP BY "user" """,
)
def label_lists(spark, sf_dir):
    lists = M.label_lists(_events(spark, sf_dir))
    return lists.withColumn("labels", F.array_join(F.col("labels").cast("array<string>"), ","))


@_register(
    "rmse_pop",
    f"WITH {EVENTS_SQL}, {POP_SQL} SELECT round(sqrt(avg((rating - score) ** 2)), 6) AS rmse FROM r JOIN pop USING (item)",
)
def rmse_pop(spark, sf_dir):
    return M.rmse(_scored(_stored(spark, sf_dir, _events)), "label").select(_r6("rmse"))


METRICS_SQL = _metric_sql(EVENTS_SQL)


@_register("ndcg_at", f'WITH {METRICS_SQL} SELECT round(avg(ndcg), 6) AS "ndcgAt" FROM per_user')
def ndcg_at(spark, sf_dir):
    return M.ndcg_at(_frame(_events(spark, sf_dir)), 3).select(_r6("ndcgAt"))


@_register("map", f'WITH {METRICS_SQL} SELECT round(avg(ap), 6) AS "map" FROM per_user')
def mean_average_precision(spark, sf_dir):
    return M.mean_average_precision(_frame(_events(spark, sf_dir)), 3).select(_r6("map"))


@_register("recall_at", f'WITH {METRICS_SQL} SELECT round(avg(recall), 6) AS "recallAtK" FROM per_user')
def recall_at(spark, sf_dir):
    return M.recall_at(_frame(_events(spark, sf_dir)), 3).select(_r6("recallAtK"))


@_register("mrr", f'WITH {METRICS_SQL} SELECT round(avg(rr), 6) AS "mrr" FROM per_user')
def mrr(spark, sf_dir):
    return M.mrr(_frame(_events(spark, sf_dir)), 3).select(_r6("mrr"))


@_register(
    "fcp",
    f"WITH {_fcp_sql(EVENTS_SQL)} SELECT round(good / n, 6) AS fcp, n AS n_pairs FROM counted",
)
def fcp_events(spark, sf_dir):
    return fcp(_scored(_stored(spark, sf_dir, _events))).select(_r6("fcp"), F.col("n_pairs").cast("long"))


@_register(
    "fcp_heavy",
    f"WITH {_fcp_sql(EVENTS_SQL)} SELECT round(good / n, 6) AS fcp, n AS n_pairs FROM counted",
)
def fcp_heavy(spark, sf_dir):
    """The same pairs with users cut into strips of at most 20 points."""
    scored = _scored(_stored(spark, sf_dir, _events))
    return fcp(scored, min_rows=20).select(_r6("fcp"), F.col("n_pairs").cast("long"))


@_register(
    "fcp_sparse",
    f"WITH {_fcp_sql(SPARSE_SQL)} SELECT round(good / n, 6) AS fcp, n AS n_pairs FROM counted",
)
def fcp_sparse(spark, sf_dir):
    return fcp(_scored(_stored(spark, sf_dir, _sparse))).select(_r6("fcp"), F.col("n_pairs").cast("long"))


def _all_metrics_sql(rows: str) -> str:
    own = _fcp_sql("").strip().lstrip(",").replace("pop AS", "pop2 AS", 1).replace("JOIN pop ", "JOIN pop2 ")
    return f"""WITH {_metric_sql(rows)}, {own}
    SELECT 'ndcgAt' AS metric, round(avg(ndcg), 6) AS value FROM per_user
    UNION ALL SELECT 'map', round(avg(ap), 6) FROM per_user
    UNION ALL SELECT 'recallAtK', round(avg(recall), 6) FROM per_user
    UNION ALL SELECT 'mrr', round(avg(rr), 6) FROM per_user
    UNION ALL SELECT 'fcp', round(good / n, 6) FROM counted"""


def _all_metrics(df: DataFrame) -> DataFrame:
    return M.ranking_metrics(_frame(df), 3, scored=_scored(df)).select("metric", _r6("value"))


@_register("ranking_metrics", _all_metrics_sql(EVENTS_SQL))
def ranking_metrics(spark, sf_dir):
    return _all_metrics(_stored(spark, sf_dir, _events))


@_register("ranking_metrics_sparse", _all_metrics_sql(SPARSE_SQL))
def ranking_metrics_sparse(spark, sf_dir):
    return _all_metrics(_stored(spark, sf_dir, _sparse))


# Factor models (no SQL equivalent) ----------------------------------------------------------


def _predictions(model, df: DataFrame) -> DataFrame:
    return L.score(model, df.select("user", "item").distinct())


@_register("als_explicit")
def als_explicit(spark, sf_dir):
    events = _stored(spark, sf_dir, _events)
    return _predictions(L.fit_als(L.als_explicit(), events, dedupe=True), events)


@_register("als_implicit")
def als_implicit(spark, sf_dir):
    events = _stored(spark, sf_dir, _events)
    return _predictions(L.fit_als(L.als_implicit(), events, dedupe=True), events)


@_register("score_pairs")
def score_pairs(spark, sf_dir):
    """RMSE of the training rows and the number scored."""
    events = _stored(spark, sf_dir, _events)
    scored = L.score(L.fit_als(L.als_explicit(), events, dedupe=True), events)
    return scored.agg(F.count(F.lit(1)).alias("n"), F.sqrt(F.avg((F.col("rating") - F.col("prediction")) ** 2)).alias("rmse"))


def _indexed_als(spark, sf_dir) -> L.IndexedALS:
    sparse = _stored(spark, sf_dir, _sparse).select("user", "item", "rating")
    return L.IndexedALS.fit(sparse, L.als_explicit("user_index", "item_index", "rating"), "user", "item", dedupe=True)


@_register("indexed_als")
def indexed_als(spark, sf_dir):
    """Predictions of the rows the model was fitted on, which it has stored with their indexes."""
    fitted = _indexed_als(spark, sf_dir)
    return L.score(fitted.model, fitted.train)


@_register("recommend_all")
def recommend_all(spark, sf_dir):
    model = L.fit_als(L.als_explicit(), _stored(spark, sf_dir, _events), dedupe=True)
    return _listed(R.recommend_all(model, 10))


@_register("recommend_active_als")
def recommend_active_als(spark, sf_dir):
    events = _stored(spark, sf_dir, _events)
    model = L.fit_als(L.als_implicit(), events, dedupe=True)
    return _listed(R.recommend_active(model, events, _at(CUT), 10))


@_register("recommend")
def recommend(spark, sf_dir):
    sparse = _stored(spark, sf_dir, _sparse)
    return _listed(L.recommend(sparse, _at(SPARSE_CUT), 10, dedupe=True))


@_register("ranking_adapter")
def ranking_adapter(spark, sf_dir):
    """Metrics of the implicit model on its own training rows: five listed, three judged."""
    frame = L.ranking_adapter(L.als_implicit(), _stored(spark, sf_dir, _events), 5, dedupe=True)
    return M.ranking_metrics(frame, 3)


@_register("scored_pairs", 'SELECT DISTINCT user_id::BIGINT AS "user", json_extract_string(props, \'$.k\')::BIGINT AS item FROM events')
def scored_pairs(spark, sf_dir):
    """The pairs the explicit model can score: all it was trained on."""
    events = _stored(spark, sf_dir, _events)
    return _predictions(L.fit_als(L.als_explicit(), events, dedupe=True), events).select(
        F.col("user").cast("long").alias("user"), F.col("item").cast("long").alias("item")
    )


@_register(
    "recommend_active_counts",
    f"""WITH {SPARSE_SQL}, act AS (SELECT count(DISTINCT item) AS n FROM r WHERE ts > TIMESTAMP '{SPARSE_CUT}')
    SELECT DISTINCT "user", least(10, n) AS n_items, 0::BIGINT AS n_inactive FROM r, act""",
)
def recommend_active_counts(spark, sf_dir):
    """Lengths of the active-subset lists, and how many of their items are not active."""
    sparse = _stored(spark, sf_dir, _sparse)
    listed = _listed(L.recommend(sparse, _at(SPARSE_CUT), 10, dedupe=True))
    active = P.active_items(sparse, _at(SPARSE_CUT)).withColumn("active", F.lit(1))
    counts = listed.join(active, "item", "left").groupBy("user")
    inactive = F.sum(F.when(F.col("active").isNull(), 1).otherwise(0))
    return counts.agg(F.count(F.lit(1)).alias("n_items"), inactive.alias("n_inactive"))


# What can be said of models in SQL: which pairs they score, and the shape of their lists.


@_register(
    "indexed_als_pairs",
    f'WITH {SPARSE_SQL} SELECT "user", item, count(*) AS n, count(*) AS n_scored FROM r GROUP BY "user", item',
)
def indexed_als_pairs(spark, sf_dir):
    scored = indexed_als(spark, sf_dir)
    finite = F.count(F.when(~F.isnan("prediction") & (F.abs("prediction") < 1e6), 1))
    return scored.groupBy("user", "item").agg(F.count(F.lit(1)).alias("n"), finite.alias("n_scored"))


@_register(
    "als_implicit_ranks",
    f"""WITH {EVENTS_SQL}, {PAIRS_SQL} SELECT "user", count(*) AS n_pairs, TRUE AS in_range FROM pairs GROUP BY "user" """,
)
def als_implicit_ranks(spark, sf_dir):
    """How many pairs of each user the implicit model scores, all of them near preferences of 0 to 1."""
    scored = als_implicit(spark, sf_dir)
    return scored.groupBy(F.col("user").cast("long").alias("user")).agg(
        F.count("prediction").alias("n_pairs"), F.every(F.col("prediction").between(-1.0, 2.0)).alias("in_range")
    )


@_register(
    "als_explicit_beats_mean",
    f"""WITH {EVENTS_SQL}, {PAIRS_SQL} SELECT (SELECT count(*) FROM pairs) AS n_pairs,
    (SELECT count(*) FROM r) AS n_rows, TRUE AS better""",
)
def als_explicit_beats_mean(spark, sf_dir):
    """The explicit model fits its training rows better than their mean does."""
    events = _stored(spark, sf_dir, _events)
    scored = L.score(L.fit_als(L.als_explicit(), events, dedupe=True), events)
    error = F.sqrt(F.avg((F.col("rating") - F.col("prediction")) ** 2))
    return scored.agg(
        F.count_distinct("user", "item").alias("n_pairs"),
        F.count(F.lit(1)).alias("n_rows"),
        (error < F.stddev_pop("rating")).alias("better"),
    )


def _list_shape(recs: DataFrame) -> DataFrame:
    """Per user: entries, distinct items, and whether the scores fall."""
    ratings = F.col("recommendations.rating")
    falling = F.array_sort(ratings, lambda a, b: F.when(a > b, -1).when(a < b, 1).otherwise(0)) == ratings
    return recs.select(
        F.col("user").cast("long").alias("user"),
        F.size("recommendations").cast("long").alias("n_items"),
        F.size(F.array_distinct("recommendations.itemId")).cast("long").alias("n_distinct"),
        falling.alias("falling"),
    )


@_register(
    "recommend_all_counts",
    f"""WITH {EVENTS_SQL}, n AS (SELECT least(10, count(DISTINCT item)) AS n FROM r)
    SELECT DISTINCT "user", n AS n_items, n AS n_distinct, TRUE AS falling FROM r, n""",
)
def recommend_all_counts(spark, sf_dir):
    model = L.fit_als(L.als_explicit(), _stored(spark, sf_dir, _events), dedupe=True)
    return _list_shape(R.recommend_all(model, 10))


@_register(
    "recommend_all_blocks",
    f"""WITH {SPARSE_SQL}, n AS (SELECT least(10, count(DISTINCT item)) AS n FROM r)
    SELECT DISTINCT "user", n AS n_items, n AS n_distinct, TRUE AS falling FROM r, n""",
)
def recommend_all_blocks(spark, sf_dir):
    """The same over the sparse ratings, in blocks so small that every list is merged."""
    model = L.fit_als(L.als_implicit(), _stored(spark, sf_dir, _sparse), dedupe=True)
    return _list_shape(R.recommend_all(model, 10, block_rows=500))


def _factor_terms(key: str) -> list[str]:
    """Whole-numbered factors that both sides compute from a key, so that products are exact; some are long."""
    long_ = f"(CASE WHEN {key} % 50 = 0 THEN 8 ELSE 1 END)"
    return [f"(({key} * 7919) % 23 - 11) * {long_}", f"(({key} * 10473) % 17 - 8) * {long_}", f"(({key} * 31) % 5) * {long_}"]


def _product_sql() -> str:
    pairs = zip(_factor_terms("c_custkey"), _factor_terms("p_partkey"))
    return " + ".join(f"({a}) * ({b})" for a, b in pairs)


@_register(
    "recommend_factors",
    f"""WITH s AS (SELECT c_custkey::BIGINT AS "user", p_partkey::BIGINT AS item, ({_product_sql()})::DOUBLE AS rating
      FROM customer, part),
    t AS (SELECT *, row_number() OVER (PARTITION BY "user" ORDER BY rating DESC, item) AS position FROM s)
    SELECT "user", position::INT AS position, item, rating FROM t WHERE position <= 10""",
)
def recommend_factors(spark, sf_dir):
    """Top-k lists by value, from factors that are given, in blocks so small that lists are merged."""
    sides = [("customer", "c_custkey"), ("part", "p_partkey")]
    factors = [
        _table(spark, sf_dir, table).select(F.col(key).alias("id"), F.array(*map(F.expr, _factor_terms(key))).alias("features"))
        for table, key in sides
    ]
    return _listed(R.recommend_factors(*factors, 10, block_rows=400)).withColumn("item", F.col("item").cast("long"))


@_register(
    "ranking_adapter_frame",
    f"""WITH {EVENTS_SQL}, {PAIRS_SQL}, n AS (SELECT least(5, count(DISTINCT item)) AS n FROM r)
    SELECT "user", any_value(n) AS n_predicted, count(*)::BIGINT AS n_labels, TRUE AS hits_fit FROM pairs, n GROUP BY "user" """,
)
def ranking_adapter_frame(spark, sf_dir):
    frame = L.ranking_adapter(L.als_implicit(), _stored(spark, sf_dir, _events), 5, dedupe=True)
    fit = F.size("hits") <= F.least(F.size("prediction").cast("long"), F.col("n_labels"))
    return frame.select("user", F.size("prediction").cast("long").alias("n_predicted"), "n_labels", fit.alias("hits_fit"))


def _runs_sql(points: list[dict]) -> str:
    rows = [f"({i}, '{name}', '{value}')" for i, point in enumerate(points) for name, value in point.items()]
    return "runs(run_id, param, param_value) AS (VALUES " + ", ".join(rows) + ")"


CV_POINTS = [{"regParam": r, "rank": n} for r in W.REG_PARAMS for n in (4, 8)]
RANKING_POINTS = [{"maxIter": i, "regParam": r} for i in (1, 2, 3) for r in (1.0, 0.1)]


def _grid(als, points: list[dict]) -> list[dict]:
    return [{als.getParam(name): value for name, value in point.items()} for point in points]


@_register(
    "grid_search_cv_runs",
    f"""WITH {EVENTS_SQL}, {PAIRS_SQL}, {_runs_sql(CV_POINTS)}
    SELECT run_id::INT AS run_id, param, param_value, 'rmse' AS metric, n AS n_pairs, TRUE AS judged
    FROM runs, (SELECT count(*) AS n FROM pairs)""",
)
def grid_search_cv_runs(spark, sf_dir):
    """Every parameter of every run over two parameters, and how many pairs were searched."""
    als = L.als_explicit()
    judge = RegressionEvaluator(metricName="rmse", labelCol="rating", predictionCol="prediction")
    pairs = materialise(L.one_per_pair(_events(spark, sf_dir), als), "pairs")
    found = L.grid_metrics(spark, L.grid_search_cv(pairs, als, _grid(als, CV_POINTS), judge, ["user", "item"]))
    sized = found.withColumn("n_pairs", pairs.agg(F.count(F.lit(1))).scalar())
    return sized.select("run_id", "param", "param_value", "metric", "n_pairs", (F.col("value") > 0).alias("judged"))


@_register(
    "grid_search_ranking_runs",
    f"""WITH {EVENTS_SQL}, {_runs_sql(RANKING_POINTS)},
    ranked AS (SELECT "user", item, row_number() OVER (PARTITION BY "user" ORDER BY md5(event_id || '-42'), event_id)
      / count(*) OVER (PARTITION BY "user") <= 0.8 AS train FROM r),
    sizes AS (SELECT count(DISTINCT ("user", item)) FILTER (train) AS n_train, count(*) FILTER (NOT train) AS n_valid FROM ranked)
    SELECT run_id::INT AS run_id, param, param_value, metric, n_train, n_valid, TRUE AS judged
    FROM runs, sizes, (VALUES ('ndcgAt'), ('map'), ('recallAtK'), ('mrr'), ('fcp')) AS m(metric)""",
)
def grid_search_ranking_runs(spark, sf_dir):
    """Every metric and parameter of every run over two parameters, and the sizes of the split."""
    als = L.als_explicit()
    events = _stored(spark, sf_dir, _events, "event_id")
    search = L.grid_search_ranking(events, als, _grid(als, RANKING_POINTS), key=["event_id"], dedupe=True)
    sized = search.metrics.withColumns(
        {
            "n_train": search.train.agg(F.count(F.lit(1))).scalar(),
            "n_valid": search.valid.agg(F.count(F.lit(1))).scalar(),
        }
    )
    return sized.select("run_id", "param", "param_value", "metric", "n_train", "n_valid", F.col("value").between(0, 1).alias("judged"))


@_register(
    "explicit_workflow",
    f"""WITH {EVENTS_SQL}, s AS (SELECT *, {_hash_sql('event_id', '123')} / 4294967296.0 < 0.75 AS train FROM r),
    {_runs_sql([{'regParam': r} for r in W.REG_PARAMS])}
    SELECT run_id::INT AS run_id, param, param_value, (SELECT count(*) FROM s WHERE train) AS n_train,
      (SELECT count(*) FROM s WHERE NOT train) AS n_test, (SELECT count(DISTINCT "user") FROM s WHERE train) AS n_served,
      (SELECT count(*) FROM runs) AS n_logged FROM runs""",
)
def explicit_workflow(spark, sf_dir):
    """The runs of the search with what the workflow stored: both splits, the served users and the run log."""
    events = _stored(spark, sf_dir, _events, "event_id")
    store = scratch_path(spark, "explicit")
    run = W.explicit_workflow(events, ["event_id"], f"{store}/serving", k=5, dedupe=True, store=store)
    served = V.read_serving(spark, f"{store}/serving")
    sizes = {"n_train": run.train, "n_test": run.test, "n_served": served, "n_logged": run.runs}
    sized = run.grid.withColumns({name: df.agg(F.count(F.lit(1))).scalar() for name, df in sizes.items()})
    return sized.select("run_id", "param", "param_value", *sizes)


@_register(
    "implicit_workflow",
    f"""WITH {EVENTS_SQL}, clean AS (SELECT * FROM r WHERE {CLEAN_SQL}),
    act AS (SELECT count(DISTINCT item) AS n FROM clean WHERE ts > TIMESTAMP '{CUT}')
    SELECT row_number() OVER (ORDER BY count(*) DESC, "user"::VARCHAR) - 1 AS "user", least(10, any_value(n)) AS n_items,
      least(10, any_value(n)) AS n_distinct, TRUE AS falling FROM clean, act GROUP BY "user" """,
)
def implicit_workflow(spark, sf_dir):
    """The lists of the news workflow: one for every indexed reader, of items still active."""
    log = _events(spark, sf_dir).select(
        F.col("user").alias("userId"), F.col("item").alias("url"), "rating", "ts", "event_type", "item"
    )
    roles = {"user": "userId", "item": "url", "rating": "rating", "ts": "ts"}
    run = W.implicit_workflow(log, roles, DROP, ABOVE, _at(CUT), k=10, dedupe=True)
    return _list_shape(run.recommendations)


@_register("grid_search_cv")
def grid_search_cv(spark, sf_dir):
    events = _stored(spark, sf_dir, _events)
    als = L.als_explicit()
    grid = ParamGridBuilder().addGrid(als.regParam, list(W.REG_PARAMS)).build()
    judge = RegressionEvaluator(metricName="rmse", labelCol="rating", predictionCol="prediction")
    pairs = L.one_per_pair(events, als)
    return L.grid_metrics(spark, L.grid_search_cv(pairs, als, grid, judge, ["user", "item"]))


@_register("grid_search_ranking")
def grid_search_ranking(spark, sf_dir):
    als = L.als_explicit()
    grid = ParamGridBuilder().addGrid(als.maxIter, [1, 2, 3, 5, 8]).build()
    events = _stored(spark, sf_dir, _events, "event_id")
    return L.grid_search_ranking(events, als, grid, key=["event_id"], dedupe=True).metrics


# Enrichment ---------------------------------------------------------------------------------

TOKENS_SQL = """tokens AS (
  SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS pos
  FROM (SELECT doc_id, string_split_regex(lower(text), '[^\\p{L}]+') AS words FROM documents)),
vocab AS (SELECT DISTINCT word AS name FROM
  (SELECT unnest(string_split_regex(lower(text), '[^\\p{L}]+')) AS word FROM benchmark) WHERE word <> ''),
firsts AS (SELECT doc_id, word, min(pos) AS pos FROM tokens JOIN vocab ON word = name GROUP BY doc_id, word)"""
LEXICON_SQL = "lexicon(entry, weight) AS (VALUES " + ", ".join(f"('{w}', {v}::DOUBLE)" for w, v in LEXICON.items()) + ")"
SCORES_SQL = "scores AS (SELECT doc_id, avg(weight) AS score FROM tokens JOIN lexicon ON word = entry GROUP BY doc_id)"


def _vocabulary(spark, sf_dir) -> DataFrame:
    """The words of the benchmark passages, as names to recognise."""
    return _table(spark, sf_dir, "benchmark").select(F.explode(E.words("text")).alias("name")).distinct()


def _recognised(spark, sf_dir, **options) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return E.recognise(documents, "text", _vocabulary(spark, sf_dir), **options)


@_register(
    "first_entity",
    f"""WITH {TOKENS_SQL} SELECT doc_id, (SELECT arg_min(word, pos) FROM firsts f WHERE f.doc_id = d.doc_id)
    AS "firstCeleb" FROM documents d""",
)
def first_entity(spark, sf_dir):
    named = C.first_entity(_recognised(spark, sf_dir), "celebs.result.celebrities", "firstCeleb")
    return named.select("doc_id", "firstCeleb")


ENTITIES_SQL = f"""WITH {TOKENS_SQL} SELECT doc_id, coalesce((SELECT string_agg(word, ',' ORDER BY pos)
  FROM firsts f WHERE f.doc_id = d.doc_id), '') AS names FROM documents d"""


@_register("recognise_inline", ENTITIES_SQL)
def recognise_inline(spark, sf_dir):
    return _recognised(spark, sf_dir, max_inline=E.INLINE_WORDS).select(
        "doc_id", F.array_join("celebs.result.celebrities.name", ",").alias("names")
    )


@_register("recognise_joined", ENTITIES_SQL)
def recognise_joined(spark, sf_dir):
    return _recognised(spark, sf_dir, max_inline=0).select(
        "doc_id", F.array_join("celebs.result.celebrities.name", ",").alias("names")
    )


@_register("recognise_shuffled", ENTITIES_SQL)
def recognise_shuffled(spark, sf_dir):
    return _recognised(spark, sf_dir, max_inline=0, max_broadcast=0).select(
        "doc_id", F.array_join("celebs.result.celebrities.name", ",").alias("names")
    )


KEYS_SQL = "CASE WHEN doc_id % 3 = 0 THEN NULL ELSE doc_id % 7 END"


def _loosely_keyed(spark, sf_dir, **options) -> DataFrame:
    """Entities of documents whose key repeats and is NULL for every third."""
    documents = _table(spark, sf_dir, "documents").select(F.expr(KEYS_SQL).alias("key"), "doc_id", "text")
    found = E.recognise(documents, "text", _vocabulary(spark, sf_dir), **options)
    return found.select("key", "doc_id", F.array_join("celebs.result.celebrities.name", ",").alias("names"))


LOOSE_SQL = f"SELECT {KEYS_SQL} AS key, doc_id, names FROM ({ENTITIES_SQL})"


@_register("recognise_loose_inline", LOOSE_SQL)
def recognise_loose_inline(spark, sf_dir):
    return _loosely_keyed(spark, sf_dir, max_inline=E.INLINE_WORDS)


@_register("recognise_loose_joined", LOOSE_SQL)
def recognise_loose_joined(spark, sf_dir):
    return _loosely_keyed(spark, sf_dir, max_inline=0)


def _full_names_sql(form: str) -> str:
    """All runs of two and three words of the benchmark, found in documents."""
    return f"""WITH b AS (SELECT item_id, list_filter(string_split_regex(lower(text), '[^\\p{{L}}]+'), lambda x: x <> '') AS w FROM benchmark),
    starts AS (SELECT w, unnest(range(1, len(w) - 1)) AS p FROM b),
    names AS (SELECT DISTINCT array_to_string(w[p:p+n-1], ' ') AS name, n FROM starts, (VALUES (2), (3)) AS l(n) WHERE p + n - 1 <= len(w)),
    d AS (SELECT doc_id, list_filter(string_split_regex(lower(text), '[^\\p{{L}}]+'), lambda x: x <> '') AS w FROM documents),
    runs AS (SELECT doc_id, p, n, array_to_string(w[p:p+n-1], ' ') AS name
      FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM d, (VALUES (2), (3)) AS l(n) WHERE len(w) >= n)),
    firsts AS (SELECT doc_id, name, min(p) AS p, any_value(n) AS n FROM runs JOIN names USING (name, n) GROUP BY doc_id, name)
    SELECT doc_id, coalesce((SELECT string_agg(name, ',' ORDER BY p, -n) FROM firsts f WHERE f.doc_id = d.doc_id), '') AS names FROM d {form}"""


def _full_names(spark, sf_dir, **options) -> DataFrame:
    """Names of several words, capitalised as a list of names would be."""
    found = _table(spark, sf_dir, "benchmark").select(E.words("text").alias("w"))
    starts = found.filter(F.size("w") > 2).select("w", F.explode(F.expr("sequence(1, size(w) - 2)")).alias("p"))
    whole = starts.select("w", "p", F.explode(F.array(F.lit(2), F.lit(3))).alias("n")).filter("p + n - 1 <= size(w)")
    plain = F.expr("array_join(slice(w, p, n), ' ')")
    title = F.initcap(plain)  # but not where capitals change the letters, as those of ß do
    names = whole.select(F.when(F.lower(title) == plain, title).otherwise(plain).alias("name")).distinct()
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    named = E.recognise(documents, "text", names, **options)
    return named.select("doc_id", F.array_join("celebs.result.celebrities.name", ",").alias("names"))


@_register("recognise_full_names", _full_names_sql(""))
def recognise_full_names(spark, sf_dir):
    return _full_names(spark, sf_dir)


@_register("recognise_full_names_joined", _full_names_sql(""))
def recognise_full_names_joined(spark, sf_dir):
    return _full_names(spark, sf_dir, max_broadcast=0)


@_register(
    "join_lines",
    "SELECT doc_id, array_to_string(list_transform(string_split(text, chr(10)), lambda x: upper(x[1:1])), chr(10)) AS joined FROM documents",
)
def join_lines(spark, sf_dir):
    """The first letter of each recognised line, one line below the other."""
    documents = W.lines_response("text")(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    first = lambda line: F.struct(F.upper(F.substring(line["text"], 1, 1)).alias("text"))
    initials = documents.withColumn("initials", F.transform("ocr.recognitionResult.lines", first))
    return C.join_lines(initials, "initials", "joined").select("doc_id", "joined")


@_register("enrich_length", "SELECT doc_id, length(text)::BIGINT AS n FROM documents")
def enrich_length(spark, sf_dir):
    def provider(texts):
        return [{"result": {"length": len(text)}} for text in texts]

    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    schema = "struct<result: struct<length: bigint>>"
    answered = E.enrich(documents, provider, "text", "response", schema)
    return answered.select("doc_id", F.col("response.result.length").alias("n"))


@_register("enrich_distinct", "SELECT doc_id, length(text)::BIGINT AS n, upper(lang) AS lang FROM documents")
def enrich_distinct(spark, sf_dir):
    """Every distinct text, and then every distinct language, sent once."""

    def lengths(texts):
        return [{"length": len(text)} for text in texts]

    def names(langs):
        return [{"name": lang.upper()} for lang in langs]

    documents = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    answered = E.enrich_distinct(documents, lengths, "text", "response", "struct<length: bigint>").drop("text")
    named = E.enrich_distinct(answered, names, "lang", "named", "struct<name: string>")
    return named.select("doc_id", F.col("response.length").alias("n"), F.col("named.name").alias("lang"))


@_register(
    "explode_urls",
    """SELECT page_id, unnest(regexp_extract_all(html, '(?:src|href)="([^"]+)"', 1)) AS link FROM pages""",
)
def explode_urls(spark, sf_dir):
    pages = E.extract_links(_table(spark, sf_dir, "pages"), "html", "images")
    return E.explode_urls(pages.select("page_id", "images"), "images", "link")


@_register(
    "sentiment",
    f"""WITH {TOKENS_SQL}, {LEXICON_SQL}, {SCORES_SQL}
    SELECT doc_id, round(score, 6) AS "sentimentScore" FROM documents LEFT JOIN scores USING (doc_id)""",
)
def sentiment(spark, sf_dir):
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = E.first_score(E.sentiment(documents, "text", LEXICON))
    return scored.select("doc_id", _r6("sentimentScore"))


@_register(
    "sentiment_large",
    f"""WITH {TOKENS_SQL}, known AS (SELECT DISTINCT word FROM tokens WHERE word <> ''),
    lexicon(entry, weight) AS (SELECT word, (length(word) % 5 - 2)::DOUBLE FROM known), {SCORES_SQL}
    SELECT doc_id, round(score, 6) AS "sentimentScore" FROM documents LEFT JOIN scores USING (doc_id)""",
)
def sentiment_large(spark, sf_dir):
    """Every word of the documents has a weight: more than ten thousand entries, joined instead of inlined."""
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    known = documents.select(F.explode(E.words("text")).alias("word")).distinct()
    lexicon = known.withColumn("weight", (F.length("word") % 5 - 2).cast("double"))
    return E.first_score(E.sentiment(documents, "text", lexicon)).select("doc_id", _r6("sentimentScore"))


@_register(
    "enrichment_chain",
    f"""WITH {TOKENS_SQL}, {LEXICON_SQL}, {SCORES_SQL}
    SELECT source || '/' || doc_id AS url, (SELECT arg_min(word, pos) FROM firsts f WHERE f.doc_id = d.doc_id)
      AS "firstCeleb", text, round(score, 6) AS "sentimentScore"
    FROM documents d LEFT JOIN scores USING (doc_id)""",
)
def enrichment_chain(spark, sf_dir):
    def search(_):
        documents = _table(spark, sf_dir, "documents").select("doc_id", "source", F.col("text").alias("body"))
        url = F.concat_ws("/", "source", "doc_id")
        return documents.withColumn("images", F.array(F.struct(url.alias("url"))))

    steps = W.enrichment_steps(
        search,
        lambda df: E.recognise(df, "body", _vocabulary(spark, sf_dir)),
        W.lines_response("body"),
        LEXICON,
    )
    final = E.run_chain(spark, steps, scratch_path(spark, "chain"))
    return final.withColumn("sentimentScore", F.round("sentimentScore", 6))


@_register("apply_udf", "SELECT p_partkey, upper(p_name) AS name FROM part")
def apply_udf(spark, sf_dir):
    parts = _table(spark, sf_dir, "part").select("p_partkey", "p_name")
    return C.apply_udf(parts, lambda names: names.str.upper(), "p_name", "name", "string").drop("p_name")


# Streaming ----------------------------------------------------------------------------------


@_register("stream_ratings", f"WITH {EVENTS_SQL} {MESSAGE_SQL} WHERE floor(rating) > 3")
def stream_ratings(spark, sf_dir):
    root, out = scratch_path(spark, "hub"), scratch_path(spark, "stream")
    _messages(spark, sf_dir).select("Body").write.parquet(root)
    stream = Z.stream_ratings(spark, root, MESSAGE)
    Z.write_available(stream, out, scratch_path(spark, "progress")).awaitTermination()
    return spark.read.parquet(out)


@_register(
    "capture_windows",
    f"""WITH {EVENTS_SQL} SELECT epoch(date_trunc('minute', ts))::BIGINT AS start_s, count(*) AS n
    FROM r GROUP BY ALL""",
)
def capture_windows(spark, sf_dir):
    """A closing message one day after the last event lets the last interval finish."""
    root, out = scratch_path(spark, "timed"), scratch_path(spark, "windows")
    events = _events(spark, sf_dir).select("ts")
    events.write.parquet(root)
    closing = events.agg((F.max("ts") + F.expr("INTERVAL 1 DAY")).alias("ts"))
    closing.write.mode("append").parquet(root)
    counts = Z.capture_windows(Z.stream_files(spark, root, events.schema), "ts")
    Z.write_available(counts, out, scratch_path(spark, "progress")).awaitTermination()
    return spark.read.parquet(out).select(C.epoch_seconds("start").alias("start_s"), "n")


@_register(
    "capture_windows_late",
    f"""WITH {EVENTS_SQL}, p AS (SELECT *, ({_hash_sql('event_id', '')} % 4)::INT AS partition_id,
      date_trunc('minute', ts) AS started, ts <= TIMESTAMP '{CUT}' AND event_id % 7 <> 0 AS early FROM r),
    marks AS (SELECT partition_id, max(ts) - INTERVAL 10 MINUTE AS mark FROM p WHERE early GROUP BY ALL),
    j AS (SELECT p.*, NOT early AND coalesce(started + INTERVAL 1 MINUTE <= mark, FALSE) AS late FROM p LEFT JOIN marks USING (partition_id))
    SELECT partition_id, epoch(started)::BIGINT AS start_s, count(*) FILTER (NOT late) AS n, count(*) FILTER (late) AS n_late,
      coalesce(sum(event_id) FILTER (late), 0)::BIGINT AS late_ids FROM j GROUP BY ALL""",
)
def capture_windows_late(spark, sf_dir):
    """Every seventh event comes with the later ones; counts per partition, and the ids of the late rows themselves."""
    root, out, progress = (scratch_path(spark, name) for name in ("parted", "intervals", "progress"))
    events = _events(spark, sf_dir).select("event_id", "ts", G.partition_id("event_id", 4).alias("PartitionId"))
    early = F.coalesce((F.col("ts") <= _at(CUT)) & (F.col("event_id") % 7 != 0), F.lit(False))
    for delivered in (events.filter(early), events.filter(~early)):
        delivered.write.mode("append").parquet(root)
        Z.count_intervals(Z.stream_files(spark, root, events.schema), out, progress, "ts").awaitTermination()
    key = [F.col("PartitionId").alias("partition"), F.date_trunc("minute", "ts").alias("start")]
    late = Z.read_late(spark, out, events.schema).groupBy(*key).agg(F.sum("event_id").alias("late_ids"))
    counted = Z.read_intervals(spark, out).join(late, ["partition", "start"], "left")
    ids = F.coalesce("late_ids", F.lit(0)).cast("long").alias("late_ids")
    return counted.select(F.col("partition").alias("partition_id"), C.epoch_seconds("start").alias("start_s"), "n", "n_late", ids)


@_register(
    "stream_dedup",
    f"WITH {EVENTS_SQL} SELECT DISTINCT event_id, \"user\", item, rating FROM r",
)
def stream_dedup(spark, sf_dir):
    """Every event twice: once in its half, and again with the other one; every seventh first comes with the later half."""
    root, out, progress = scratch_path(spark, "delivered"), scratch_path(spark, "once"), scratch_path(spark, "progress")
    events = _events(spark, sf_dir).select("event_id", "user", "item", "rating", "ts")
    cut = events.agg(F.timestamp_micros(F.percentile_approx(F.unix_micros("ts"), 0.5))).scalar()
    straggler = (F.col("event_id") % 7 == 0) & (F.col("ts") > cut - F.expr("INTERVAL 1 DAY"))
    early = (F.col("ts") <= cut) & ~straggler
    for delivered in (events.filter(early).union(events.filter(early)), events.union(events.filter(~early)).orderBy(F.desc("ts"))):
        delivered.write.mode("append").parquet(root)
        stream = Z.once(Z.stream_files(spark, root, events.schema), ["event_id"], "ts", "1 day")
        Z.write_available(stream, out, progress).awaitTermination()
    return spark.read.parquet(out).drop("ts")


@_register("stream_upsert", LAST_SQL)
def stream_upsert(spark, sf_dir):
    """Two runs of a stream, the newer events first, into a table that already has a batch version."""
    root, table = scratch_path(spark, "updates"), scratch_path(spark, "serving")
    progress = scratch_path(spark, "progress")
    rows = _events(spark, sf_dir).select(F.col("user").cast("string").alias("id"), "item", "event_id", "ts")
    third = F.col("event_id") % 3
    V.publish_upsert(spark, table, V.latest_per_key(rows.filter(third == 0), "id", NEWEST), order=NEWEST)
    for batch in _halves(rows.filter(third != 0)):
        batch.write.mode("append").parquet(root)
        stream = Z.stream_files(spark, root, rows.schema)
        Z.stream_upsert(stream, table, progress, "id", NEWEST).awaitTermination()
    return V.read_serving(spark, table, order=NEWEST).drop("ts")




def entry(spark: SparkSession) -> DataFrame:
    """Clean, split, score and recommend the active items, on the smallest tables."""
    return popular_active_workflow(spark, "/root/testdata/sf0.001")


def _optional(module: str):
    """The module, or None where its file or package is not there; errors inside it are raised."""
    try:
        return importlib.import_module(module)
    except ModuleNotFoundError as error:
        if error.name in (module, "recmill.llm", "recmill.llm.queries"):  # of the optional files themselves
            return None
        raise


_LLM = _optional("recmill.llm.queries")
_PIPELINE = _optional("corpus_pipeline")


def queries() -> dict[str, Query]:
    found = dict(_QUERIES)
    if _LLM:
        found |= _LLM.QUERIES
    if _PIPELINE:
        found["pipeline"] = _PIPELINE.run
    return found


def oracle_sql() -> dict[str, str]:
    found = dict(_ORACLES)
    if _LLM:
        found |= _LLM.ORACLES
    if _PIPELINE and _PIPELINE.ORACLE_SQL:
        found["pipeline"] = _PIPELINE.ORACLE_SQL
    return found
