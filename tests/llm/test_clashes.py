"""Columns of the documents that have the names an operator uses itself."""

from recmill.llm import edits, simhash


def test_keep_first_beside_columns_of_its_own_names(spark):
    rows = [(3, "a b c d", "x", 1), (1, "a b c d", "y", 2), (1, "a b c d", "z", 2), (2, "something else entirely here", None, 3)]
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING, _id STRING, _digest INT")
    for named in (docs, docs.withColumnsRenamed({"_id": "_ID", "_digest": "__digest"})):
        kept = simhash.keep_first(named)
        assert kept.columns == named.columns
        assert sorted(row["doc_id"] for row in kept.collect()) == [1, 2]


def test_edits_are_attached_beside_columns_of_the_same_names(spark):
    docs = spark.createDataFrame([(1, "abc", 9, "old"), (2, "d", 8, "old")], "doc_id LONG, text STRING, _id INT, edits STRING")
    changes = [(1, 2, 0, 1, "x"), (1, 1, 2, 0, "y"), (None, 1, 0, 0, "z"), (7, 1, 0, 0, "z")]
    listed = spark.createDataFrame(changes, "doc_id LONG, seq INT, pos INT, delete INT, insert STRING")
    found = {row["doc_id"]: row for row in edits.attach_edits(docs, listed).collect()}
    assert [e["insert"] for e in found[1]["edits"]] == ["y", "x"]
    assert found[2]["edits"] is None and (found[1]["_id"], found[2]["_id"]) == (9, 8)
