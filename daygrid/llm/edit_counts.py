"""Token counts that follow edits.

A document is cut into leaves at places where the tokenizer's pre-tokens must end whatever stands
around them; a segment tree over the leaves keeps their counts. An edit encodes only the leaves it
touches and one neighbour on either side, and renews the sums along the paths to them.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame

from daygrid.llm.common import word_encoder

LEAF_CHARS = 512
#: A blank between two characters that are not white space: a pre-token ends before it.
_CUT = re.compile(r"(?<=\S) (?=\S)")

Edit = tuple[int, int, str]


def leaves_of(text: str, size: int = LEAF_CHARS) -> list[str]:
    """Cut at the first safe place at or after each ``size`` characters; a text without one is a single leaf."""
    out, start = [], 0
    while start < len(text):
        cut = _CUT.search(text, start + size)
        end = cut.start() if cut else len(text)
        out.append(text[start:end])
        start = end
    return out


class Node(NamedTuple):
    """A leaf with its text, or the sums of two subtrees whose heights differ by one at most."""

    left: Node | None
    right: Node | None
    text: str
    height: int
    leaves: int
    chars: int
    tokens: int


def _over(left: Node, right: Node) -> Node:
    height = 1 + max(left.height, right.height)
    return Node(left, right, "", height, left.leaves + right.leaves, left.chars + right.chars, left.tokens + right.tokens)


def _balanced(left: Node, right: Node) -> Node:
    """A node over two subtrees whose heights differ by two at most."""
    if left.height > right.height + 1:
        if left.left.height < left.right.height:
            return _over(_over(left.left, left.right.left), _over(left.right.right, right))
        return _over(left.left, _over(left.right, right))
    if right.height > left.height + 1:
        if right.right.height < right.left.height:
            return _over(_over(left, right.left.left), _over(right.left.right, right.right))
        return _over(_over(left, right.left), right.right)
    return _over(left, right)


def join(left: Node | None, right: Node | None) -> Node | None:
    """One balanced tree; new nodes only along the difference of the heights."""
    if left is None or right is None:
        return left or right
    if left.height > right.height + 1:
        return _balanced(left.left, join(left.right, right))
    if right.height > left.height + 1:
        return _balanced(join(left, right.left), right.right)
    return _over(left, right)


def split(node: Node | None, leaves: int) -> tuple[Node | None, Node | None]:
    """The first ``leaves`` leaves, and the others; new nodes only along one path."""
    if node is None or leaves <= 0:
        return None, node
    if leaves >= node.leaves:
        return node, None
    if leaves < node.left.leaves:
        first, rest = split(node.left, leaves)
        return first, join(rest, node.right)
    first, rest = split(node.right, leaves - node.left.leaves)
    return join(node.left, first), rest


def _texts(node: Node | None) -> Iterator[str]:
    waiting = [node] if node else []
    while waiting:
        node = waiting.pop()
        if node.left is None:
            yield node.text
        else:
            waiting += [node.right, node.left]


class CountTree:
    """A balanced segment tree over the token counts and lengths of the leaves of one text.

    An edit splits the leaves it touches out of the tree and joins the new ones in, however many they are: sums are made
    anew along the paths to them only.
    """

    def __init__(self, text: str, count: Callable[[str], int]):
        self._count = count
        self.encoded_chars = 0
        self.root = self._tree(text)

    def _tree(self, text: str) -> Node | None:
        row = []
        for leaf in leaves_of(text):
            self.encoded_chars += len(leaf)
            row.append(Node(None, None, leaf, 0, 1, len(leaf), self._count(leaf)))
        # Neighbours meet in rounds; an odd one goes to the end of the next.
        while len(row) > 1:
            row = [join(*row[i : i + 2]) if i + 1 < len(row) else row[i] for i in range(0, len(row), 2)]
        return row[0] if row else None

    @property
    def total(self) -> int:
        return self.root.tokens if self.root else 0

    @property
    def length(self) -> int:
        return self.root.chars if self.root else 0

    @property
    def leaves(self) -> list[str]:
        return list(_texts(self.root))

    def text(self) -> str:
        return "".join(_texts(self.root))

    def _leaf_at(self, position: int) -> int:
        """The number of the leaf that holds a position; the last one for the end of the text."""
        node, before = self.root, 0
        while node.left is not None:
            if position < node.left.chars:
                node = node.left
            else:
                position -= node.left.chars
                before += node.left.leaves
                node = node.right
        return before

    def edit(self, start: int, end: int, new: str) -> None:
        """Replace characters start to end (exclusive) by ``new``; bounds are clipped to the text."""
        start = min(max(start, 0), self.length)
        end = min(max(end, start), self.length)
        if self.root is None:
            self.root = self._tree(new)
            return
        first, last = self._leaf_at(start) - 1, self._leaf_at(max(start, end - 1)) + 1
        upto, after = split(self.root, last + 1)
        before, touched = split(upto, first)
        offset = before.chars if before else 0
        region = "".join(_texts(touched))
        region = region[: start - offset] + new + region[end - offset :]
        self.root = join(join(before, self._tree(region)), after)


def default_edits(length: int, doc_id: int) -> list[Edit]:
    """Three edits of a text of ``length``, from the end on: replace, insert, delete."""
    return [
        (3 * length // 4, 3 * length // 4 + 11, f" [{doc_id}] "),
        (length // 2, length // 2, "\n\nnew paragraph "),
        (length // 4, length // 4 + 7, ""),
    ]


def count_edits(docs: DataFrame, ranks_path: str, pattern: str, specials: dict[str, int],
                edits: Callable[[int, int], list[Edit]] = default_edits) -> DataFrame:
    """Counts before and after ``edits(length, doc_id)`` per row of ``docs`` (doc_id, text).

    Edits apply in order, each to the text as the last one left it. A null text is empty; edits of
    an empty text insert only. ``reencoded_chars`` is what the edits encoded again. Repeated rows
    are counted each; other columns are ignored; a null doc_id counts as 0 for the edits.
    """
    columns = ["doc_id", "n_tokens", "n_tokens_edited", "n_chars_edited", "reencoded_chars"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = word_encoder(ranks_path, pattern, specials)
        count = lambda text: len(encoder.encode(text)) // 4
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                tree = CountTree(text or "", count)
                before, encoded = tree.total, tree.encoded_chars
                for start, end, new in edits(tree.length, 0 if pd.isna(doc_id) else int(doc_id)):
                    tree.edit(start, end, new)
                rows.append((doc_id, before, tree.total, tree.length, tree.encoded_chars - encoded))
            yield pd.DataFrame(rows, columns=columns)

    return docs.select("doc_id", "text").mapInPandas(run, ", ".join(f"{c} long" for c in columns))
