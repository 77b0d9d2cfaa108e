import re
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from recmill.llm import mixing
from recmill.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def expected_targets(sizes, weights, share, most):
    """Share by weight, stop at the cap, share the excess again, in fractions."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: weights[n % len(weights)] for n, s in enumerate(order)}
    capped = set()
    while True:
        left = share * sum(sizes.values()) - sum(most * sizes[s] for s in capped)
        still = sum(weight[s] for s in order if s not in capped)
        dealt = {s: Fraction(left) * weight[s] / still for s in order if s not in capped}
        above = {s for s, t in dealt.items() if t > most * sizes[s]}
        if not above:
            return {s: float(dealt[s]) if s in dealt else float(most * sizes[s]) for s in order}
        capped |= above
        if len(capped) == len(order):
            return {s: float(most * sizes[s]) for s in order}


def check(rows, documents, weights=(3, 1, 2), share=Fraction(3, 2), most=2):
    """``rows`` are (doc_id, text, source); ``documents`` come from the operator."""
    sizes = [(i, len(WORD.findall(t or "")), s) for i, t, s in rows]
    by_source = Counter()
    for _, n, s in sizes:
        by_source[s] += n
    target = expected_targets(by_source, weights, share, most)
    want = sorted(((i, n, s, by_source[s]) for i, n, s in sizes), key=str)
    assert sorted(((r.doc_id, r.size, r.source, r.source_size) for r in documents), key=str) == want
    taken = Counter()
    for r in documents:
        assert r.target == pytest.approx(target[r.source], rel=1e-12, abs=1e-9)
        assert 0 <= r.taken <= most * r.size
        taken[r.source] += r.taken
    for s, t in target.items():
        assert abs(taken[s] - t) <= 0.5 + 1e-6


def test_whole_table(spark, documents):
    found, of_documents = mixing.mix(documents, [3, 1, 2], (3, 2), 2, shard_blocks=16)
    of_documents = of_documents.collect()
    check([(r.doc_id, r.text, r.source) for r in documents.collect()], of_documents)
    pieces, taken = found.collect(), Counter()
    for r in pieces:
        taken[r.doc_id] += r.n_words
    assert taken == Counter({r.doc_id: r.taken for r in of_documents if r.taken})
    shards = defaultdict(list)
    for r in pieces:
        shards[r.shard].append(r.position)
    assert all(sorted(p) == list(range(len(p))) for p in shards.values())
    words = defaultdict(list)  # within a pass no word is taken twice
    for r in pieces:
        words[r.doc_id, r.epoch].append((r.first_word, r.n_words))
    for spans in words.values():
        end = 0
        for first, n in sorted(spans):
            assert first >= end and n > 0
            end = first + n


def test_query_and_reruns(spark, documents):
    key = lambda df: sorted(tuple(r) for r in df.collect())
    found = QUERIES["op11_mixed_sources"](spark, SF_DIR)
    assert found.dtypes == [("doc_id", "bigint"), ("size", "bigint"), ("source_size", "bigint"), ("target", "double"), ("taken", "bigint")]
    again = mixing.mix(documents.repartition(7), [3, 1, 2], (3, 2), 2)[1]
    assert key(found) == key(again.select(*found.columns))
    other = mixing.mix(documents, [3, 1, 2], (3, 2), 2, seed=7)[1]
    assert key(found) != key(other.select(*found.columns))


def test_shards_mix_sources(spark):
    """Each shard has about its share of every source, and all shards are of equal size."""
    rows = [(i, "w " * 100, "abc"[i % 3]) for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found, _ = mixing.mix(docs, [1], block_words=50, shard_blocks=100)
    of = {r.doc_id: r.source for r in docs.collect()}
    shards = defaultdict(Counter)
    for r in found.collect():
        shards[r.shard][of[r.doc_id]] += r.n_words
    assert len(shards) == 18
    for counts in shards.values():
        assert sum(counts.values()) == 5000
        assert all(600 < counts[s] < 2800 for s in "abc")


def test_texts(spark):
    rows = [(i, f"a{i} b{i}\tc{i}\n d{i}  e{i}", "x") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = mixing.mix(docs, [1], block_words=7, with_text=True)[0].collect()
    assert any(r.n_words < 5 for r in found)
    for r in found:
        assert r.text == " ".join([f"{c}{r.doc_id}" for c in "abcde"][r.first_word : r.first_word + r.n_words])


def test_odd_rows(spark, odd_docs):
    docs = odd_docs.withColumnRenamed("score", "source").withColumnRenamed("fp", "sid")
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    check(rows, mixing.mix(docs, [3, 1, 2], (3, 2), 2, block_words=100)[1].collect())
    check(rows, mixing.mix(docs, [1, 5], (1, 2), 1)[1].collect(), (1, 5), Fraction(1, 2), 1)
    for empty in (docs.limit(0), docs.filter("text IS NULL")):
        found, of_documents = mixing.mix(empty, [3, 1, 2], (3, 2), 2)
        assert found.count() == 0
        assert all(r.taken == 0 and r.target == 0 for r in of_documents.collect())


def test_many_sources_share_families(spark, monkeypatch):
    monkeypatch.setattr(mixing, "FAMILIES", 4)
    monkeypatch.setattr(mixing, "MOST_BLOCKS", 300)
    rows = [(i, "w " * (i % 50), f"s{i % 23}") for i in range(500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    check(rows, mixing.mix(docs, [3, 1, 2], (3, 2), 2, block_words=8, shard_blocks=9)[1].collect())


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 300), st.integers(0, 2**62))
def test_permutation(n, key):
    assert sorted(mixing.permuted(np.arange(n), np.full(n, n), np.full(n, key, dtype=np.uint64))) == list(range(n))


@settings(max_examples=100, deadline=None)
@given(st.integers(0, 50), st.integers(1, 400), st.integers(1, 40), st.floats(0, 2))
def test_quota(sid, size, block, part):
    words = int(size * part)
    n_draws, cut = mixing.quota(sid, size, words, block, 1)
    n, taken = -(-size // block), 0
    for draw in range(n_draws):
        epoch = draw // n
        order = mixing.permuted(np.arange(n), np.full(n, n), mixing._key(1, np.full(n, sid), np.full(n, epoch)))
        at = int(np.nonzero(order == draw % n)[0][0])
        whole = min(size, (at + 1) * block) - at * block
        assert draw < n_draws - 1 or 0 < cut <= whole
        taken += whole if draw < n_draws - 1 else cut
    assert taken == words


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 200), min_size=1, max_size=6), st.integers(1, 20), st.integers(0, 99))
def test_tree_deals_everything_once(quotas, shards, seed):
    quotas = np.array(quotas)
    found = list(mixing.dealt(quotas, shards, 0, shards, seed))
    assert [shard for shard, _, _ in found] == list(range(shards))
    upto = np.zeros_like(quotas)
    for shard, first, count in found:
        assert (first == upto).all() and (count >= 0).all()
        assert count.sum() == (shard + 1) * quotas.sum() // shards - shard * quotas.sum() // shards
        upto = upto + count
    assert (upto == quotas).all()
    part = [x for x in mixing.dealt(quotas, shards, shards // 2, shards, seed)]
    assert all((a[1] == b[1]).all() and (a[2] == b[2]).all() for a, b in zip(part, found[shards // 2 :]))
