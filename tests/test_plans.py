"""Physical plans: shuffles, pushdown and joins are the ones intended."""

from pyspark.sql import functions as F

import __spark_entry__ as entry
from recmill.operators import prep, splits

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def events(spark):
    return spark.read.parquet(f"{SF_DIR}/events.parquet")


def test_chrono_split_shuffles_once(spark):
    left, _ = splits.chrono_split(events(spark), col_user="user_id", tiebreak=["event_id"])
    assert plan(left).count("Exchange ") == 1


def test_cleaning_reaches_the_scan(spark):
    text = plan(prep.clean_activity(events(spark), {"event_type": ["error"]}, {"value": 10}).select("user_id"))
    assert "Not(EqualTo(event_type,error))" in text and "GreaterThan(value,10.0)" in text
    assert "ReadSchema: struct<user_id:bigint,event_type:string,value:double>" in text


def test_active_items_prunes_columns(spark):
    text = plan(prep.active_items(events(spark), F.lit("2024-01-20").cast("timestamp_ntz"), "user_id"))
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint>" in text
    assert "PushedFilters: [IsNotNull(ts), GreaterThan(ts," in text


def test_no_query_pairs_everything(spark):
    for name in ("recommend_active_pop", "ranking_frame", "fcp", "inject_cold", "serve"):
        text = plan(entry.queries()[name](spark, SF_DIR))
        assert "CartesianProduct" not in text and "NestedLoopJoin" not in text, name
