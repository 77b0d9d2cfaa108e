"""Segment trees of pre-tokens that are kept in a table, so that a batch of edits reads and encodes its own documents' regions only.

A row holds a document's text and its tree: the number of leaves, and the sums of
characters and of tokens of every node, the root second and the leaves from the middle on.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recmill.llm import edits as E
from recmill.llm.tokens import Generations

COLUMNS = ["doc_id", "text", "leaves", "chars", "tokens"]
SCHEMA = "doc_id long, text string, leaves int, chars array<long>, tokens array<long>"


class KeptTree(E.Tree):
    """A tree that knows which of its leaves hold more than one pre-token."""

    def __init__(self, chars, tokens):
        super().__init__(chars, tokens)
        self.merged: set[int] = set()

    @classmethod
    def stored(cls, leaves: int, chars: np.ndarray, tokens: np.ndarray) -> KeptTree:
        tree = cls.__new__(cls)
        tree.leaves, tree.width, tree.merged = leaves, len(chars) // 2, set()
        tree.sums = np.stack([chars, tokens], axis=1)
        return tree

    def put(self, first: int, end: int, chars: int, tokens: int) -> None:
        super().put(first, end, chars, tokens)
        self.merged = {leaf for leaf in self.merged if not first <= leaf < end} | {first}

    def settled(self, text: str, counts: Generations) -> KeptTree:
        """The tree with a leaf for every pre-token again; only merged leaves are cut."""
        low = self.sums[self.width : self.width + self.leaves]
        starts = np.cumsum(low[:, 0]) - low[:, 0]
        parts, at = [], 0
        for leaf in sorted(self.merged):
            pieces, end = [], int(starts[leaf] + low[leaf, 0])
            for match in E._CUT.finditer(text, int(starts[leaf])):
                if match.start() >= end:
                    break
                pieces.append(match.group())
            known = counts.have(set(pieces))
            parts += [low[at:leaf], np.array([(len(p), known[p]) for p in pieces], dtype=np.int64).reshape(-1, 2)]
            at = leaf + 1
        flat = np.concatenate([*parts, low[at:]])
        flat = flat[flat[:, 0] > 0]
        return KeptTree(flat[:, 0], flat[:, 1])


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = {"text": pa.string(), "leaves": pa.int32(), "chars": pa.list_(pa.int64()), "tokens": pa.list_(pa.int64())}
    return pa.RecordBatch.from_arrays([pa.array(c, type=kinds.get(n, pa.int64())) for n, c in zip(names, zip(*rows))], names)


def build_trees(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, leaves, chars, tokens) of every row; write it, and edit what was written.

    Null texts are empty, without leaves. Rows of null id are left out, as no edit could
    name them; rows that repeat an id get a tree each. Other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = E.counter(tokenizer)
        for whole in batches:
            for at in range(0, whole.num_rows, E.TEXTS):
                rows = []
                for doc_id, text in zip(*(c.to_pylist() for c in whole.slice(at, E.TEXTS).columns)):
                    tree = E.build(text, counts)
                    rows.append((doc_id, text, tree.leaves, tree.sums[:, 0], tree.sums[:, 1]))
                yield _batch(rows, COLUMNS)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return rows.filter(F.col("doc_id").isNotNull()).mapInArrow(run, SCHEMA)


def apply_edits(trees: DataFrame, edits: DataFrame, tokenizer: str, order_col: str = "seq") -> DataFrame:
    """The new rows of the documents that ``edits`` (doc_id, order, pos, delete, insert) names, with n_before, n_after and n_encoded.

    Other documents are neither encoded nor sent to Python. Places and lengths mean what
    they mean in ``edits.count_edits``; n_encoded counts the pre-tokens of edited regions.
    A tree is given back with a leaf for every pre-token, so later batches cost no more.
    Edits of unknown or null ids are left out; each row of a repeated id is edited. All
    edits of one document of one batch meet in one row.
    """
    names = [*COLUMNS, "n_before", "n_after", "n_encoded"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = E.counter(tokenizer)
        for whole in batches:
            for at in range(0, whole.num_rows, E.TEXTS):
                batch, rows = whole.slice(at, E.TEXTS), []
                ids, texts, leaves, chars, tokens, changes = batch.columns
                for i in range(batch.num_rows):
                    text, sums = texts[i].as_py(), [c[i].values.to_numpy() for c in (chars, tokens)]
                    tree, encoded = KeptTree.stored(leaves[i].as_py(), *sums), 0
                    before = tree.tokens
                    for e in changes[i].as_py():
                        text, n = E.edit(tree, text, e["pos"] or 0, e["delete"] or 0, e["insert"] or "", counts)
                        encoded += n
                    tree = tree.settled(text, counts)
                    rows.append((ids[i].as_py(), text, tree.leaves, tree.sums[:, 0], tree.sums[:, 1], before, tree.tokens, encoded))
                if rows:
                    yield _batch(rows, names)

    named = E.attach_edits(trees.select(*COLUMNS), edits, "doc_id", order_col)
    named = named.filter(F.col("edits").isNotNull()).withColumn("edits", F.col("edits").cast(f"array<{E.EDIT}>"))
    return named.mapInArrow(run, f"{SCHEMA}, n_before long, n_after long, n_encoded long")


def next_trees(trees: DataFrame, changed: DataFrame) -> DataFrame:
    """The table after a batch: ``changed``, stored rows of ``apply_edits``, in place of the rows of their ids."""
    ids = changed.select(F.col("doc_id").alias("_changed")).distinct()
    return trees.select(*COLUMNS).join(ids, F.col("doc_id") == F.col("_changed"), "left_anti").unionByName(changed.select(*COLUMNS))
