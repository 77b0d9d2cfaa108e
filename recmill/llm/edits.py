"""Token counts that follow edits, from a segment tree of pre-tokens per document.

A leaf holds the characters and tokens of one pre-token, an inner node the sums below it.
An edit cuts the text again from a few leaves before it up to the first old boundary
beyond it that is also a new one; from there on nothing can differ. The region's new sums
go into its first leaf, its other leaves become empty, and the sums above are brought up
to date, so an edit costs its own size and the height of the tree.
"""

from __future__ import annotations

import os
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recmill.llm.tokens import REMEMBERED, Generations

# Fixed value: the pre-tokens of byte-level BPE.
PRETOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
CONTEXT = 3  # leaves before an edit that are cut again; a pre-token's end depends on two after it at most
TEXTS = 64
EDIT = "struct<pos:bigint,delete:bigint,insert:string>"

_CUT = regex.compile(PRETOKEN)
_PRETOKENIZERS: dict[str, Generations] = {}


def counter(path: str) -> Generations:
    """This worker's store of token counts of pre-tokens, by a ``tokenizers`` file."""
    if path not in _PRETOKENIZERS:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.encode_special_tokens = True

        def count(pieces: list[str]) -> list[int]:
            return [len(e.ids) for e in tokenizer.encode_batch(pieces, add_special_tokens=False)]

        _PRETOKENIZERS[path] = Generations(count, REMEMBERED)
    return _PRETOKENIZERS[path]


class Tree:
    """Sums of characters and tokens over the leaves of one text."""

    def __init__(self, chars: Iterable[int], tokens: Iterable[int]):
        chars, tokens = np.asarray(chars, dtype=np.int64), np.asarray(tokens, dtype=np.int64)
        self.leaves = len(chars)
        self.width = 1 << max(self.leaves - 1, 0).bit_length()
        self.sums = np.zeros((2 * self.width, 2), dtype=np.int64)
        self.sums[self.width : self.width + self.leaves, 0] = chars
        self.sums[self.width : self.width + self.leaves, 1] = tokens
        level = self.width
        while level > 1:
            self.sums[level // 2 : level] = self.sums[level : 2 * level].reshape(-1, 2, 2).sum(axis=1)
            level //= 2

    @property
    def tokens(self) -> int:
        return int(self.sums[1, 1])

    def leaf_chars(self, leaf: int) -> int:
        return int(self.sums[self.width + leaf, 0])

    def at(self, pos: int) -> tuple[int, int]:
        """The leaf that holds character ``pos``, the last one beyond the end, and where it starts."""
        node, start = 1, 0
        if pos >= self.sums[1, 0]:
            pos = max(int(self.sums[1, 0]) - 1, 0)
        while node < self.width:
            node *= 2
            left = int(self.sums[node, 0])
            if pos - start >= left and self.sums[node + 1, 0]:
                start, node = start + left, node + 1
        return node - self.width, start

    def put(self, first: int, end: int, chars: int, tokens: int) -> None:
        """Give leaf ``first`` the sums of the leaves up to ``end``, and empty the others."""
        low, high = self.width + first, self.width + end
        self.sums[low:high] = 0
        self.sums[low] = chars, tokens
        high -= 1
        while low > 1:
            low, high = low // 2, high // 2
            self.sums[low : high + 1] = self.sums[2 * low : 2 * high + 2].reshape(-1, 2, 2).sum(axis=1)


def build(text: str, counts: Generations) -> Tree:
    pieces = _CUT.findall(text)
    known = counts.have(set(pieces))
    return Tree(list(map(len, pieces)), list(map(known.__getitem__, pieces)))


def edit(tree: Tree, text: str, pos: int, delete: int, insert: str, counts: Generations) -> tuple[str, int]:
    """Apply one edit to the tree; gives the new text and how many pre-tokens were encoded."""
    pos = min(max(pos, 0), len(text))
    delete = min(max(delete, 0), len(text) - pos)
    if not delete and not insert:
        return text, 0
    new = f"{text[:pos]}{insert}{text[pos + delete :]}"
    if not tree.leaves:
        tree.__init__([0], [0])
    first, start = tree.at(pos)
    back = 0
    while back < CONTEXT and first:
        first -= 1
        chars = tree.leaf_chars(first)
        start, back = start - chars, back + (chars > 0)
    end, end_at = tree.at(pos + delete)  # leaf, and its start in the old text
    shift = len(insert) - delete
    pieces = []
    for match in _CUT.finditer(new, start):
        pieces.append(match.group())
        old = match.end() - shift
        if old < pos + delete:
            continue
        while end < tree.leaves and end_at < old:
            end_at += tree.leaf_chars(end)
            end += 1
        if end_at == old and end > first:  # else the region has no leaf of its own yet
            break
    else:
        end = tree.leaves
    known = counts.have(set(pieces))
    tree.put(first, max(end, first + 1), sum(map(len, pieces)), sum(known[p] for p in pieces))
    return new, len(pieces)


def count_edits(
    docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", edits_col: str = "edits"
) -> DataFrame:
    """(doc_id, n_before, n_after, n_pretokens, n_encoded, edited) of every row.

    ``edits_col`` is an array of (pos, delete, insert): at character ``pos`` of the text as
    the edits before have left it, ``delete`` characters go and ``insert`` comes. Places
    and lengths beyond the text are drawn in to it; null numbers are 0 and null inserts
    empty; null edits, and a null list, change nothing. A null text is empty. n_before and
    n_after count the tokens of the whole text, n_pretokens the leaves at first, n_encoded
    the pre-tokens that the edits made anew, and edited is the resulting text. Rows that
    repeat an id are counted each; other columns are not read.
    """
    names = ["doc_id", "n_before", "n_after", "n_pretokens", "n_encoded", "edited"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = counter(tokenizer)
        for whole in batches:
            for at in range(0, whole.num_rows, TEXTS):
                batch = whole.slice(at, TEXTS)
                rows = []
                for text, edits in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                    tree = build(text, counts)
                    before, leaves, encoded = tree.tokens, tree.leaves, 0
                    for e in edits or []:
                        if e is not None:
                            text, n = edit(tree, text, e["pos"] or 0, e["delete"] or 0, e["insert"] or "", counts)
                            encoded += n
                    rows.append((before, tree.tokens, leaves, encoded, text))
                columns = [pa.array(c, type=pa.int64()) for c in list(zip(*rows))[:4]]
                texts = pa.array([row[4] for row in rows], type=pa.string())
                yield pa.RecordBatch.from_arrays([batch.column(0), *columns, texts], names)

    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
        F.col(edits_col).cast(f"array<{EDIT}>").alias("edits"),
    )
    return rows.mapInArrow(run, "doc_id long, n_before long, n_after long, n_pretokens long, n_encoded long, edited string")


def attach_edits(docs: DataFrame, edits: DataFrame, id_col: str = "doc_id", order_col: str = "seq", out: str = "edits") -> DataFrame:
    """``docs`` with the edits of ``edits`` (id, order, pos, delete, insert) as an array in order.

    A document without edits gets null; edits of null or unknown ids are left out. A column ``out`` is replaced.
    """
    entry = F.struct(F.col(order_col), F.struct("pos", "delete", "insert").alias("e"))
    own = "_id"
    while own.lower() in {c.lower() for c in (*docs.columns, out)}:
        own = f"_{own}"
    listed = edits.groupBy(F.col(id_col).alias(own)).agg(
        F.transform(F.array_sort(F.collect_list(entry)), lambda x: x["e"]).alias(out)
    )
    docs = docs.drop(out)
    return docs.join(listed, docs[id_col] == F.col(own), "left").drop(own)
