import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from recmill.llm import edits, trees
from recmill.sources.scratch import materialise

PATH = public_tokenizers.path("byte_bpe_50k.json")
TOKENIZER = Tokenizer.from_file(PATH)
TOKENIZER.encode_special_tokens = True
SCHEMA = "doc_id long, seq int, pos long, delete long, insert string"
ALPHABET = st.text(alphabet="ab1 '\n\tsrélt.,漢", max_size=30)


def n_tokens(text):
    return len(TOKENIZER.encode(text, add_special_tokens=False).ids)


@settings(max_examples=300, deadline=None)
@given(ALPHABET, st.lists(st.tuples(st.integers(0, 40), st.integers(0, 12), ALPHABET), max_size=5))
def test_a_settled_tree_is_the_tree_of_the_text(text, changes):
    counts = edits.counter(PATH)
    built = edits.build(text, counts)
    tree = trees.KeptTree.stored(built.leaves, built.sums[:, 0], built.sums[:, 1])
    for pos, delete, insert in changes:
        text, _ = edits.edit(tree, text, pos, delete, insert, counts)
    tree, want = tree.settled(text, counts), edits.build(text, counts)
    assert tree.sums.tolist() == want.sums.tolist() and tree.leaves == want.leaves


def test_two_batches_encode_their_regions_only(spark, documents):
    first = materialise(trees.build_trees(documents, PATH))
    texts = {r.doc_id: r.text for r in first.collect()}
    some, table = sorted(texts)[:12], first
    for batch in range(2):
        rows = [(i, seq, 40 * seq + 7 * batch, 5, "late words, ") for i in some for seq in (1, 2)] + [(-5, 1, 0, 0, "x"), (None, 1, 0, 0, "x")]
        changed = materialise(trees.apply_edits(table, spark.createDataFrame(rows, SCHEMA), PATH))
        found = {r.doc_id: r for r in changed.collect()}
        assert sorted(found) == some
        for i, row in found.items():
            assert row.n_before == n_tokens(texts[i])
            for seq in (1, 2):
                at = min(40 * seq + 7 * batch, len(texts[i]))
                texts[i] = texts[i][:at] + "late words, " + texts[i][at + 5 :]
            assert row.text == texts[i] and row.n_after == n_tokens(texts[i]) and row.n_encoded <= 40
        table = materialise(trees.next_trees(table, changed))
    assert {r.doc_id: r.text for r in table.collect()} == texts and table.count() == first.count()


def test_odd_rows(spark, odd_docs):
    table = materialise(trees.build_trees(odd_docs, PATH))
    assert table.count() == odd_docs.filter("doc_id IS NOT NULL").count()
    rows = [(2, 1, None, None, "into null"), (5, 1, 0, 10**9, None), (4, 1, 99, 99, "x")]
    found = trees.apply_edits(table, spark.createDataFrame(rows, SCHEMA), PATH).collect()
    assert {r.doc_id for r in found} == {2, 4, 5} and all(r.n_after == n_tokens(r.text) for r in found)
    assert trees.apply_edits(table.limit(0), spark.createDataFrame(rows, SCHEMA), PATH).count() == 0
    assert trees.apply_edits(table, spark.createDataFrame([], SCHEMA), PATH).count() == 0
