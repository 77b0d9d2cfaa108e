import numpy as np

from recmill.llm import knn
from recmill.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


def brute(rows, queries, k):
    usable = lambda v: v is not None and all(x is not None and np.isfinite(x) for x in v)
    width = max([len(v) for _, v in rows if usable(v)] + [1])
    as_ints = lambda v: [int(np.floor(64 * float(x))) for x in v] + [0] * (width - len(v))
    data = [(i, as_ints(v)) for i, v in rows if i is not None and usable(v)]
    out = []
    for q, v in sorted({(i, tuple(as_ints(v))) for i, v in queries if i is not None and usable(v)}):
        scores = sorted((-sum(a * b for a, b in zip(v, x)), i) for i, x in data if i != q)[:k]
        out += [(q, n, i, -s) for n, (s, i) in enumerate(scores, start=1)]
    return sorted(out)


def found(df):
    return sorted((r.query_id, r.rank, r.vec_id, r.score) for r in df.collect())


def test_whole_table(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()]
    want = brute(rows, [r for r in rows if r[0] % 20 == 0], 20)
    assert found(QUERIES["op4_voronoi_top_k"](spark, SF_DIR)) == want


def test_odd_rows_and_small_buckets(spark, monkeypatch):
    rng = np.random.default_rng(2)
    rows = [(i, (rng.integers(-3, 4, 5) / 64).tolist()) for i in range(120)]
    rows += [(i, [0.5, 0.25, 0.125, 0.0, -1.0]) for i in range(200, 260)]  # one hot value
    rows += [(300, None), (301, [0.1, None, 0.2]), (302, [float("nan")]), (303, [float("inf")]), (None, [1.0]), (304, []), (305, [2.0])]
    rows += [(20, [1.0, 1.0, 0.0, 0.0, 0.0]), (40, rows[40][1])]
    table = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<double>, score string")
    asked = table.filter("vec_id % 20 = 0 OR vec_id > 300 OR vec_id IS NULL")
    want = brute(rows, [r for r in rows if r[0] is None or r[0] % 20 == 0 or r[0] > 300], 7)
    for bucket, seeds in ((8192, 4096), (9, 30), (9, 3)):
        monkeypatch.setattr(knn, "BUCKET", bucket)
        monkeypatch.setattr(knn, "SEEDS", seeds)
        assert found(knn.top_k(table, asked, 7, pivots=6)) == want
    assert knn.top_k(table.limit(0), asked, 7).count() == 0
    assert knn.top_k(table, asked.limit(0), 7).count() == 0


def test_few_candidates_are_all_given(spark):
    table = spark.createDataFrame([(0, [1.0]), (1, [0.5]), (2, [0.5])], "vec_id long, embedding array<float>")
    assert found(knn.top_k(table, table.filter("vec_id = 0"), 20)) == [(0, 1, 1, 2048), (0, 2, 2, 2048)]


def test_large_integers_stay_exact():
    a = np.array([[2**40 + 1, 3]]), np.array([[2**20 + 1, -5]])
    assert knn.products(*a)[0, 0] == (2**40 + 1) * (2**20 + 1) - 15


def clustered(spark):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(12, 16)) * 4
    rows = [(i, (centres[i % 12] + rng.normal(size=16) * 0.1).tolist()) for i in range(600)]
    return rows, spark.createDataFrame(rows, "vec_id long, embedding array<double>")


def test_most_pairs_of_clustered_vectors_are_left_out(spark, monkeypatch):
    rows, table = clustered(spark)
    asked = table.filter("vec_id % 5 = 0")
    assert knn.kept_share(table, asked, 7) < 0.3
    want = brute(rows, [r for r in rows if r[0] % 5 == 0], 7)
    for bucket in (8192, 16):
        monkeypatch.setattr(knn, "BUCKET", bucket)
        assert found(knn.top_k(table, asked, 7)) == want


def test_repeats_of_the_own_id_do_not_raise_the_bound(spark):
    rows = [(0, [1.0, 0.0])] * 9 + [(i, [0.01 * i, 1.0]) for i in range(1, 9)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert found(knn.top_k(table, table.filter("vec_id = 0"), 3, pivots=4)) == brute(rows, rows[:1], 3)


def test_groups_hold_near_cells_up_to_a_bucket(monkeypatch):
    monkeypatch.setattr(knn, "BUCKET", 10)
    pivots = np.array([[0], [1], [50], [51], [99]])
    group = knn._groups(pivots, np.array([5, 5, 12, 3, 0]))
    assert group[0] == group[1] and group[2] != group[3] and group[4] == -1
    assert len(set(group[:4])) == 3
