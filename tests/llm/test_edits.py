import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from recmill.llm import edits
from recmill.llm.queries import three_edits

PATH = public_tokenizers.path("byte_bpe_50k.json")
TOKENIZER = Tokenizer.from_file(PATH)
TOKENIZER.encode_special_tokens = True


def n_tokens(text):
    return len(TOKENIZER.encode(text, add_special_tokens=False).ids)


def test_whole_table(documents):
    rows = {r.doc_id: r for r in documents.withColumn("edits", three_edits()).collect()}
    found = edits.count_edits(documents.withColumn("edits", three_edits()), PATH).collect()
    assert len(found) == len(rows)
    for row in found:
        text = rows[row.doc_id].text
        assert row.n_before == n_tokens(text)
        for e in rows[row.doc_id].edits:
            pos = min(max(e["pos"], 0), len(text))
            text = text[:pos] + e["insert"] + text[pos + e["delete"] :]
        assert row.edited == text and row.n_after == n_tokens(text)
        assert row.n_encoded <= 80  # whatever the length of the document


ALPHABET = st.text(alphabet="ab1 '\n\tsrélt.,漢", max_size=30)


@settings(max_examples=400, deadline=None)
@given(ALPHABET, st.lists(st.tuples(st.integers(-2, 40), st.integers(-1, 12), ALPHABET), max_size=5))
def test_any_edits(text, changes):
    counts = edits.counter(PATH)
    tree = edits.build(text, counts)
    assert tree.tokens == n_tokens(text)
    for pos, delete, insert in changes:
        at = min(max(pos, 0), len(text))
        want = text[:at] + insert + text[at + max(delete, 0) :]
        text, _ = edits.edit(tree, text, pos, delete, insert, counts)
        assert text == want and tree.tokens == n_tokens(text)
        assert tree.sums[1, 0] == len(text)


def test_odd_rows(odd_docs, spark):
    changes = spark.createDataFrame(
        [(1, 2, 0, 0, "late "), (1, 1, 2, 1, ""), (2, 1, None, None, "into null"), (3, 1, 99, 99, "x"), (5, 1, 0, 10**9, None), (77, 1, 0, 0, "?"), (None, 1, 0, 0, "?")],
        "doc_id long, seq int, pos long, delete long, insert string",
    )
    rows = edits.count_edits(edits.attach_edits(odd_docs, changes), PATH).collect()
    assert all(r.n_after == n_tokens(r.edited) for r in rows) and len(rows) == 10
    by = {(r.doc_id, r.edited[:5]) for r in rows}
    assert {(2, "into "), (3, "x"), (5, ""), (4, "  \n\t "), (1, "late ")} <= by
    assert edits.count_edits(edits.attach_edits(odd_docs.limit(0), changes), PATH).count() == 0
