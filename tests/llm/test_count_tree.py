import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from daygrid.llm import edit_counts, queries
from daygrid.llm.common import table


def words(text):
    return sum(1 + len(word) // 4 for word in text.split())


def checked(node):
    """Height, leaves, characters and tokens of a subtree, found anew; balance and sums hold everywhere."""
    if node.left is None:
        found = (0, 1, len(node.text), words(node.text))
    else:
        a, b = checked(node.left), checked(node.right)
        assert abs(a[0] - b[0]) <= 1
        found = (1 + max(a[0], b[0]), *(x + y for x, y in zip(a[1:], b[1:], strict=True)))
    assert found == (node.height, node.leaves, node.chars, node.tokens)
    return found


def test_edits_of_all_sizes_keep_balance_sums_and_text():
    rng = random.Random(3)
    text = " ".join("w" * rng.randint(1, 9) for _ in range(20_000))
    tree = edit_counts.CountTree(text, words)
    for step in range(150):
        start = rng.randrange(-5, len(text) + 5)
        end = start + rng.choice([0, 1, 40, 3_000, 30_000])
        new = rng.choice(["", "x", " y z ", "\n\n", "abc " * 30, "long one " * 4_000 if step % 20 == 0 else "q"])
        tree.edit(start, end, new)
        low = min(max(start, 0), len(text))
        text = text[:low] + new + text[min(max(end, low), len(text)) :]
        assert tree.text() == text and tree.total == words(text) and tree.length == len(text)
        if tree.root:
            checked(tree.root)
    tree.edit(0, len(text), "")
    assert (tree.total, tree.length, tree.leaves) == (0, 0, [])
    tree.edit(0, 0, "a b")
    assert tree.text() == "a b" and tree.total == 2


def test_an_edit_that_adds_leaves_makes_nodes_along_its_paths_only(monkeypatch):
    tree = edit_counts.CountTree("word " * 400_000, words)
    made, over = [], edit_counts._over
    monkeypatch.setattr(edit_counts, "_over", lambda a, b: made.append(1) or over(a, b))
    encoded = tree.encoded_chars
    tree.edit(1_000_000, 1_000_003, "some more words " * 200)
    assert tree.root.leaves > 3_800 and len(made) < 120
    assert tree.encoded_chars - encoded < 3_200 + 4 * (edit_counts.LEAF_CHARS + 8)


def test_query_on_the_given_table_against_the_library(session, data_root):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    library.no_truncation()
    library.no_padding()
    texts = {r.doc_id: r.text or "" for r in table(session, data_root, "documents").collect()}
    found = queries.QUERIES["op6_edit_counts"](session, data_root).collect()
    assert len(found) == len(texts)
    for row in found:
        text = texts[row.doc_id]
        assert row.n_tokens == len(library.encode(text, add_special_tokens=False).ids)
        for start, end, new in edit_counts.default_edits(len(text), row.doc_id):
            start, end = min(max(start, 0), len(text)), min(max(end, start), len(text))
            text = text[:start] + new + text[end:]
        assert (row.n_tokens_edited, row.n_chars_edited) == (len(library.encode(text, add_special_tokens=False).ids), len(text))
