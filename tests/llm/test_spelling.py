import random
import re
import zlib
from collections import Counter

from recmill.llm import spelling
from recmill.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def is_near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(rows, shortest=7, least=2, times=10, every=31):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if every and h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= shortest:
                counts[run] += 1
    words = {w: n for w, n in counts.items() if n >= least}
    by_length = {}
    for w in words:
        by_length.setdefault(len(w), []).append(w)
    forms, near = {}, {}
    for w, n in words.items():
        others = [v for k in (-1, 0, 1) for v in by_length.get(len(w) + k, []) if is_near(w, v)]
        near[w] = len(others)
        best = min(others, key=lambda v: (-words[v], v), default=None)
        forms[w] = best if best is not None and words[best] >= times * n else None
    out = []
    for w, n in words.items():
        root = w
        while forms[root] is not None:
            root = forms[root]
        out.append((w, forms[w], root, n, near[w], words.get(forms[w])))
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()), key=str)


def test_whole_table(spark, documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    want = brute(rows)
    assert any(f for _, f, *_ in want) and max(r[4] for r in want) > 3
    assert found(QUERIES["op12_spelling_variants"](spark, SF_DIR)) == want


def test_dense_words(spark):
    """Short words of two letters and an accent: runs of one letter, chains of forms, many neighbours."""
    pick, rows = random.Random(5), []
    for doc_id in range(60):
        rows.append((doc_id, " ".join("".join(pick.choices("abÉ", [6, 3, 1], k=pick.randint(1, 7))) for _ in range(300))))
    rows += [(99, " ".join(["bbbb"] * 4000 + ["abbbb"] * 300 + ["abbbba"] * 20))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    for shortest, times in ((1, 10), (3, 2), (1, 1)):
        got = spelling.variants(docs, shortest=shortest, least=1, times=times, misspell_every=5) if times > 1 else None
        if got is not None:
            assert found(got) == brute(rows, shortest, 1, times, 5)
    assert found(spelling.variants(docs, shortest=2, least=2)) == brute(rows, 2, 2, 10, 0)


def test_chain_of_forms(spark):
    words = {"aaaaaaaa": 1, "aaaaaaab": 10, "aaaaaabb": 100, "aaaaabbb": 1000, "aaaabbbb": 10_000}
    rows = [(n, " ".join([w] * c)) for n, (w, c) in enumerate(words.items())]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = spelling.variants(docs, least=1).collect()
    assert {r.word: r.root for r in got} == dict.fromkeys(words, "aaaabbbb")


def test_odd_rows(spark, odd_docs):
    long = "x" * 40_000
    more = [(7, f"{long} {long} {long}y {long}y", "s", 1), (8, f"Zebrastreifen zebrastreifen zebrastreife {long}", "s", 1)]
    docs = odd_docs.withColumnRenamed("score", "word").withColumnRenamed("fp", "id")
    docs = docs.union(spark.createDataFrame(more, docs.schema))
    got = {r.word: r for r in spelling.variants(docs, shortest=5, least=1).collect()}
    assert got[long].n == 3 and got[long].n_near == 1 and got[long + "y"].n_near == 1
    assert got["zebrastreife"].n_near == 1 and got["zebrastreifen"].n == 2
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert found(spelling.variants(odd_docs, shortest=2, least=1, misspell_every=3)) == brute(rows, 2, 1, 10, 3)
    assert spelling.variants(docs.limit(0)).count() == 0
    assert spelling.variants(docs.filter("text IS NULL")).count() == 0


def test_groups_cut_by_batches(spark, documents):
    """Small Arrow batches cut groups of equal pairs, which then wait for the next batch."""
    rows = [(r.doc_id, r.text) for r in documents.limit(60).collect()]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        assert found(spelling.variants(docs, shortest=4, least=1)) == brute(rows, 4, 1, 10, 0)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
