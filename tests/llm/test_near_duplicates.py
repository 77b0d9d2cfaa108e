import numpy as np
import pytest

from recmill.llm import golay, simhash
from recmill.llm.components import components
from recmill.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.01"


def brute(rows):
    """{(id, text): (fingerprint, component)} by comparing all pairs."""
    fps = np.array([simhash.fingerprint(t) for _, t in rows], dtype=np.uint64)
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in np.nonzero(np.bitwise_count(fps ^ fps[i]) <= 3)[0]:
            parent[find(int(j))] = find(i)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[find(i)] = min(least.get(find(i), doc_id), doc_id)
    return sorted((str(d), f"{int(fps[i]):016x}", str(least.get(find(i)))) for i, (d, _) in enumerate(rows))


def found(df):
    return sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in df.collect())


def test_fingerprint_by_definition():
    import xxhash

    text = "The  Cat\tsat\non the mat É the cat sat on the mat"
    words = "the cat sat on the mat É the cat sat on the mat".split()
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 3]).encode(), seed=42) for i in range(len(words) - 2)]
    bits = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    assert simhash.fingerprint(text) == bits
    assert simhash.fingerprint("One two") == xxhash.xxh64_intdigest(b"one two", seed=42)
    assert simhash.fingerprint(None) == simhash.fingerprint(" \n") == 0


def test_nearest_codeword_of_either_is_a_key_of_the_other():
    rng = np.random.default_rng(5)
    a = rng.integers(0, 1 << 63, 3000, dtype=np.uint64)
    b = a.copy()
    for i in range(len(b)):
        for bit in rng.choice(64, rng.integers(0, 4), replace=False):
            b[i] ^= np.uint64(1) << np.uint64(bit)
    nearest, _, _ = golay.fuzzy_keys(a)
    _, keys, rows = golay.fuzzy_keys(b)
    held = set(zip(rows.tolist(), keys.tolist()))
    assert all(any((i, k) in held for k in nearest[i].tolist()) for i in range(len(a)))


def test_codewords_within_four_bits():
    words = np.arange(0, 1 << 23, 4099)
    index = golay.codeword_indices(words)
    all_codewords = np.array([m << 11 | golay._remainder(np.array([m << 11]))[0] for m in range(1 << 12)])
    for word, row in zip(words[:200], index[:200]):
        near = np.bitwise_count(all_codewords ^ word)
        assert near[row[0]] == near.min() <= 3
        assert set(row[row >= 0]) == set(np.nonzero(near <= (4 if near.min() == 3 else 3))[0])


def test_whole_table_matches_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    assert found(QUERIES["op9_simhash_near_duplicates"](spark, SF_DIR)) == brute(rows)


def test_odd_rows(odd_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert found(simhash.near_duplicates(odd_docs)) == brute(rows)
    assert simhash.near_duplicates(odd_docs.limit(0)).count() == 0


def test_keeps_one_of_each_group(odd_docs):
    kept = simhash.keep_first(odd_docs)
    assert kept.columns == odd_docs.columns
    # null, empty and blank texts are one group
    names = [(1, "a b c"), (1, "quite"), (2, None), (None, "a tex"), (5, "word "), (6, "ÀÉÎ ñ")]
    assert sorted(str((r.doc_id, r.text and r.text[:5])) for r in kept.collect()) == sorted(map(str, names))

@pytest.mark.parametrize("chunk", [2, 5])
def test_cut_buckets_find_the_same_components(spark, chunk):
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 62, 12, dtype=np.int64)
    values = sorted({int(b ^ (1 << int(x)) ^ (1 << int(y))) for b in base for x, y in rng.integers(0, 62, (25, 2))})
    distinct = spark.createDataFrame([(v,) for v in values], "fp long")
    whole = {(r.node, r.root) for r in components(simhash.link_forest(distinct), "a", "b").collect()}
    cut = {(r.node, r.root) for r in components(simhash.link_forest(distinct, chunk=chunk), "a", "b").collect()}
    assert whole == cut and whole


def test_components_of_a_long_chain(spark):
    n = 300
    edges = spark.createDataFrame([(i + 1, i) for i in range(n)] + [(7, 7), (None, 3), (1000, 1001)], "a long, b long")
    roots = {r.node: r.root for r in components(edges, "a", "b").collect()}
    assert roots == {i: 0 for i in range(n + 1)} | {1000: 1000, 1001: 1000}
    assert components(edges.limit(0), "a", "b").count() == 0


def test_forest_connects_what_links_connect():
    a, b = np.array([1, 5, 9, 2, 7]), np.array([5, 9, 1, 7, 7])
    node, root = simhash.forest(a, b)
    assert dict(zip(node.tolist(), root.tolist())) == {5: 1, 9: 1, 7: 2}
