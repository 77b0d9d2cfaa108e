import re

import pytest
from pyspark.sql import functions as F

from recmill.llm import decontaminate as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(docs, items, window=10):
    windows = {}
    for item, text in items:
        w = words(text)
        m = min(window, len(w))
        for p in range(len(w) - m + 1) if m else ():
            windows.setdefault(tuple(w[p : p + m]), set()).add(item)
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for m in {len(x) for x in windows}:
            for p in range(len(w) - m + 1):
                if tuple(w[p : p + m]) in windows:
                    hit |= set(range(p, p + m))
                    found |= windows[tuple(w[p : p + m])]
        out.append((str(doc), len(w), len(hit), sorted(i for i in found if i is not None)))
    return sorted(out)


def found(df):
    return sorted((str(r.doc_id), r.n_words, r.n_hit, r["items"]) for r in df.collect())


A = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"
DOCS = [
    (1, f"Before, {A.upper()}! after"),
    (2, "one two three four five six seven eight nine"),
    (3, "x one two three four five six seven eight nine ten y two three four five six seven eight nine ten eleven z"),
    (4, "the the the the the the the the the the the the the the"),
    (5, "short item and Été 2024 here, short"),
    (6, None),
    (7, ""),
    (None, f"{A} {A}"),
    (1, "another text under a used id"),
    (8, "É " * 40 + "three four five six seven eight nine ten eleven twelve"),
    (9, "single"),
    (9, "single"),
    (10, "a b a b a b a b a b a b a b a b a b"),
]
ITEMS = [
    (100, A),
    (7, "five six seven eight nine ten eleven twelve thirteen fourteen fifteen"),
    (20, "the the the the the the the the the the the"),
    (21, "Short item"),
    (22, "single"),
    (23, None),
    (24, " ,. "),
    (None, A),
    (25, "a b a b a b a b a b a b"),
    (25, "short item and Été"),
    (26, "four five six seven eight nine"),
]


@pytest.fixture(scope="module")
def tables(spark):
    docs = spark.createDataFrame([(d, t, "x") for d, t in DOCS], "doc_id long, text string, key string")
    items = spark.createDataFrame([(i, t, 1) for i, t in ITEMS], "item_id long, text string, hash int")
    return docs, items


@pytest.mark.parametrize("window", [10, 6, 3, 1])
def test_matches_brute_force(tables, window):
    assert found(D.contamination(*tables, window=window)) == brute(DOCS, ITEMS, window)


def test_without_broadcast(tables, monkeypatch):
    monkeypatch.setattr(D, "BROADCAST_ROWS", 0)
    assert found(D.contamination(*tables)) == brute(DOCS, ITEMS)


def test_empty_tables(tables):
    docs, items = tables
    assert found(D.contamination(docs, items.limit(0))) == brute(DOCS, [])
    assert D.contamination(docs.limit(0), items).count() == 0


def test_spans_are_the_hit_words(tables):
    for row in D.contamination(*tables).collect():
        assert len({w for s in row.spans for w in range(s.start, s.end)}) == row.n_hit


def test_removal_keeps_clean_rows_whole(tables):
    docs, items = tables
    kept = D.remove_contaminated(docs, items)
    assert kept.columns == docs.columns
    clean = sorted(d for d, _, n, _ in brute(DOCS, ITEMS) if not n)
    assert sorted(str(r.doc_id) for r in kept.collect()) == clean


def test_long_text_in_built_in_functions_only(spark):
    text = " ".join(f"w{i % 997}" for i in range(60_000)) + " " + A
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    items = spark.createDataFrame([(1, A)], "item_id long, text string")
    frame = D.contamination(docs, items)
    assert found(frame) == [("1", 60_014, 14, [1])]
    assert not re.search("Python|Pandas|Arrow", frame._jdf.queryExecution().toString())


def test_a_document_keeps_one_gram_for_each_window(spark):
    text = " ".join(f"w{i}" for i in range(1000))
    texts = spark.createDataFrame([(text,)], "text string")
    kept = D._kept(D.words(F.col("text")), 10, D.DOC_EDGE, True)
    assert texts.select(F.size(kept).alias("n")).first()["n"] == 166  # 996 grams, every sixth
    docs = [(at, f"{'x ' * at} {' '.join(f'w{i}' for i in range(500, 510))} end") for at in range(13)]
    items = spark.createDataFrame([(1, text)], "item_id int, text string")
    hits = D.contamination(spark.createDataFrame(docs, "doc_id int, text string"), items)
    assert sorted((r.doc_id, r.n_hit, r["items"]) for r in hits.collect()) == [(at, 10, [1]) for at in range(13)]


def test_words_are_those_of_the_contract_for_every_character(spark):
    assert "[^" not in D.LOWER_WORD + D.RAW_WORD  # slow forms
    points = [i for i in range(0x110000) if not 0xD800 <= i <= 0xDFFF and (i < 0x3000 or i % 97 == 0 or i > 0x10FFF0)]
    rows = spark.createDataFrame([(i, f"a{chr(i)}b {chr(i)}") for i in points], "i int, t string")
    counted = rows.select("i", D.words(F.col("t")).alias("w"), F.regexp_count("t", F.lit(D.RAW_WORD)).alias("n")).collect()
    assert len(counted) == len(points)
    for row in counted:
        assert row["w"] == words(f"a{chr(row['i'])}b {chr(row['i'])}") and row["n"] == len(row["w"]), hex(row["i"])
