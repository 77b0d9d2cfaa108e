"""Known numbers of the sf0.01 tables."""

import pytest

import __spark_entry__ as entry

SF_DIR = "/root/testdata/sf0.01"
ROWS = {
    "chrono_left": 7438,
    "chrono_right": 2562,
    "chrono_item": 7464,
    "clean_activity": 4839,
    "hash_split": 7500,
    "stream_ratings": 9227,
    "explode_urls": 1413,
    "capture_windows": 8961,
}
METRICS = {"ndcgAt": 0.527076, "map": 0.026356, "recallAtK": 0.032537, "mrr": 0.697778, "fcp": 0.481735}


def run(spark, name):
    return entry.queries()[name](spark, SF_DIR)


@pytest.mark.parametrize("name", sorted(ROWS))
def test_rows(spark, name):
    assert run(spark, name).count() == ROWS[name]


def test_distinct_links(spark):
    assert run(spark, "explode_urls").select("link").distinct().count() == 306


def test_metrics(spark):
    found = {row["metric"]: row["value"] for row in run(spark, "ranking_metrics").collect()}
    assert found == pytest.approx(METRICS)


def test_fcp_pairs(spark):
    assert run(spark, "fcp").first()["n_pairs"] == 176_400
