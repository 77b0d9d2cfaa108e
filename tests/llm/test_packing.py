import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from recmill.llm import packing
from recmill.llm.queries import QUERIES
from recmill.llm.tokens import Generations, WordEncoder

PATH = public_tokenizers.path("word_bpe_49k.json")
SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def expected(rows, tokenizer, size=2048):
    out = []
    for doc_id, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        for n, at in enumerate(range(0, len(ids), size)):
            part = ids[at : at + size]
            out.append((str(doc_id), n, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    return sorted(out)


def check(rows, packed, tokenizer):
    assert sorted((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in packed) == expected(rows, tokenizer)
    places = defaultdict(list)
    for r in packed:
        places[r.sequence_id].append((r.offset, r.length))
    for found in places.values():
        at = 0
        for offset, length in sorted(found):
            assert offset == at
            at += length
        assert at <= 2048
    total = sum(r.length for r in packed)
    return len(places), -(-total // 2048)


def test_whole_table(spark, documents, tokenizer):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    used, least = check(rows, QUERIES["op3_best_fit_packing"](spark, SF_DIR).collect(), tokenizer)
    assert used <= least * 1.05 + 1


def test_odd_rows(odd_docs, tokenizer):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    check(rows, packing.pack(odd_docs, PATH).collect(), tokenizer)
    assert packing.pack(odd_docs.limit(0), PATH).count() == 0


def test_texts_of_several_rows_are_encoded_once(spark, tokenizer, monkeypatch):
    texts = ["one text", "one text", None, "", "another text, " * 1500, "another text, " * 1500, "alone", "ONE text"]
    rows = [(n % 6, t) for n, t in enumerate(texts * 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    check(rows, packing.pack(docs, PATH).collect(), tokenizer)
    monkeypatch.setattr(packing, "BROADCAST_ROWS", 0)
    check(rows, packing.pack(docs, PATH).collect(), tokenizer)
    given = []
    monkeypatch.setattr(packing, "_encoded", lambda of, *rest, f=packing._encoded: given.append(of.count()) or f(of, *rest))
    packing.pieces(docs, PATH).count()
    assert sum(given) == len({t or "" for t in texts})


def test_ids_of_pieces(spark, tokenizer):
    docs = spark.createDataFrame([(1, "some words"), (2, None)], "doc_id long, text string")
    found = {r.doc_id: r.ids for r in packing.pack(docs, PATH, with_ids=True).collect()}
    assert found == {1: tokenizer.encode("some words", add_special_tokens=False).ids + [0], 2: [0]}


def simple_best_fit(lengths, size):
    rooms, n = [], 0
    for length in sorted(lengths, reverse=True):
        fit = [r for r in rooms if r >= length]
        if fit:
            rooms.remove(min(fit))
            rooms.append(min(fit) - length)
        else:
            rooms.append(size - length)
    return len(rooms)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 40), min_size=1, max_size=80))
def test_plan_is_best_fit_decreasing(lengths):
    size = 40
    histogram = {n: lengths.count(n) for n in lengths}
    taken, ranks = defaultdict(list), defaultdict(int)
    for length, rank, n, first, each, offset in packing.plan(histogram, size).tolist():
        assert rank == ranks[length]
        ranks[length] += n
        for i in range(n):
            taken[first + i // each].append((offset + i % each * length, length))
    assert ranks == histogram
    for found in taken.values():
        at = 0
        for offset, length in sorted(found):
            assert offset == at
            at += length
        assert at <= size
    assert len(taken) == simple_best_fit(lengths, size)


def test_plan_stays_small():
    rng = np.random.default_rng(3)
    histogram = {n: int(c) for n, c in enumerate(rng.integers(1, 10**9, 2048), start=1)}
    assert len(packing.plan(histogram)) < 3 * 2048 * 11


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(), max_size=4))
def test_encoder_equals_tokenizer(texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    got = [np.frombuffer(b, "<u4").tolist() for b in ENCODER.encode(texts)]
    assert got == [e.ids for e in ENCODER._tokenizer.encode_batch(texts, add_special_tokens=False)]


ENCODER = WordEncoder(PATH, remembered=5)


def test_odd_words():
    texts = ["don't STOP'S it's, a<|endoftext|>b É́É é.", "x\x1cy İstanbul ﬁ 3.14 ...! a.. $$,", "ÀÉÎ, ñ! ǅ. ß!! 10% we'll. I'M!", "Σας ΣΑΣ."]
    got = [np.frombuffer(b, "<u4").tolist() for b in ENCODER.encode(texts)]
    assert got == [e.ids for e in ENCODER._tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_every_latin_letter():
    texts = [f"a{c}b {c} {c},! X{c}" for c in map(chr, range(0x21, 0x260))]
    got = [np.frombuffer(b, "<u4").tolist() for b in ENCODER.encode(texts)]
    assert got == [e.ids for e in ENCODER._tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_generations_forget_and_learn_again():
    asked = []
    store = Generations(lambda words: [asked.append(w) or w.upper() for w in words], 2)
    for words in (["a", "b"], ["a", "c"], ["d"], ["a"], ["b"]):
        known = store.have(words)
        assert [known[w] for w in words] == [w.upper() for w in words]
    assert asked.count("a") < 4 and len(store.young) <= 3
