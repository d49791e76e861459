"""Merkle manifest, substring dedup and fill-in-middle against plain versions."""

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from daygrid.llm import fill_middle, merkle, substring_dedup

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


# Merkle manifest


def plain_tree(leaves):
    """Root and, per leaf, its siblings and the way to fold it."""
    ways = [[] for _ in leaves]
    nodes = [(d, [i]) for i, d in enumerate(leaves)]
    while len(nodes) > 1:
        above = []
        for at in range(0, len(nodes), 3):
            run = nodes[at : at + 3]
            for k, (_, below) in enumerate(run):
                for i in below:
                    ways[i].append(([d for d, _ in run[:k]], [d for d, _ in run[k + 1 :]]))
            above.append((digest("".join(d for d, _ in run)), [i for _, below in run for i in below]))
        nodes = above
    return nodes[0][0], ways


def plain_manifest(rows):
    def leaf(row):
        return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))

    trees = {}
    for row in rows:
        trees.setdefault(row[1], []).append(row)
    order = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    roots, below = [], {}
    for source in order:
        members = sorted(trees[source], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        root, ways = plain_tree([leaf(r) for r in members])
        roots.append(root)
        below[source] = list(zip(members, ways, strict=True))
    root, top = plain_tree(roots) if roots else (None, [])
    out = []
    for source, subroot, above in zip(order, roots, top, strict=True):
        for row, way in below[source]:
            steps = way + above
            tampered = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0 and row[4] is not None
            node = leaf((*row[:4], row[4].replace("\n", ""))) if tampered else leaf(row)
            for left, right in steps:
                node = digest("".join(left) + node + "".join(right))
            proof = digest("".join("".join(left) + "".join(right) for left, right in steps))
            out.append((row[0], leaf(row), subroot, root, proof, node, node == root))
    return out


def in_order(rows):
    return sorted(map(tuple, rows), key=str)


@pytest.mark.parametrize("levels", [1, 2, 8])
def test_manifest_of_odd_rows(session, levels):
    rows = [(i, f"s{i % 3}", "en", i, f"text {i}\nof {i}\n") for i in range(70)]
    rows += [(i, "s0", None, None, None) for i in range(100, 131)]
    rows += [(None, None, None, None, "a\nb"), (7, None, "é", 3, ""), (8, "", "en", 1, "x" * 70000 + "\n"), (8, "", "en", 1, "y")]
    rows += [(9, "zz|ü", "en", 1, "same")] * 5
    schema = "doc_id long, source string, lang string, n_chars long, text string"
    docs = session.createDataFrame(rows, schema).withColumns({"tree": F.lit("x"), "steps": F.lit(1), "root": F.lit("r")})
    assert in_order(merkle.report(docs, levels).collect()) == in_order(plain_manifest(rows))
    assert merkle.report(docs.limit(0), levels).collect() == []
    one = docs.where("doc_id = 7 AND source IS NULL")
    found = merkle.report(one, levels).first()
    assert found.leaf == found.subroot == found.root and found.proof_sha256 == digest("") and found.verified


@pytest.mark.parametrize("n", [1, 2, 3, 4, 9, 10, 26, 27, 28, 82])
def test_appends_equal_the_plain_tree(n):
    leaves = [digest(str(i)) for i in range(n)]
    root, ways = plain_tree(leaves)
    grown = merkle.Witnesses()
    for d in leaves:
        grown.append(d)
    assert grown.finish() == root
    for i in range(n):
        steps = ["".join(left) + "|" + "".join(right) for left, right in ways[i]]
        assert grown.witness(i, len(steps)) == steps


def test_open_subtrees_hold_partial_witnesses():
    grown = merkle.Witnesses()
    for i in range(5):
        grown.append(digest(str(i)))
    assert [len(s) for s in grown.steps[:2]] == [3, 0] and len(grown.open[0]) == 2
    grown.append(digest("5"))
    assert len(grown.steps[0]) == 6 and len(grown.open[1]) == 2


def test_every_change_is_found(session):
    rows = [(i, "s", "en", 3, f"line\n{i}") for i in range(40)]
    docs = session.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    for row in merkle.report(docs, 2).collect():
        assert row.verified == (zlib.crc32(str(row.doc_id).encode()) % 2 != 0)


# Substring dedup


def plain_removals(rows, length):
    first = {}
    split = [(i, WORD.findall((t or "").encode())) for i, t in rows]
    for i, words in split:
        if i is not None:
            for k in range(len(words) - length + 1):
                run = tuple(words[k : k + length])
                first[run] = min(first.get(run, i), i)
    out = []
    for i, words in split:
        gone = set()
        for k in range(len(words) - length + 1):
            if i is not None and first[tuple(words[k : k + length])] < i:
                gone |= set(range(k, k + length))
        kept = b" ".join(w for k, w in enumerate(words) if k not in gone)
        out.append((i, len(words), len(gone), hashlib.sha256(kept).hexdigest(), kept.decode()))
    return out


def passages(seed, n_docs=60):
    """Documents made of shared passages of many lengths, near copies, copies and periodic texts."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(5000)}"
    shared = [[word() for _ in range(rng.choice([8, 19, 20, 21, 40, 90, 300]))] for _ in range(8)]
    rows = []
    for i in range(n_docs):
        words = []
        for _ in range(rng.randrange(4)):
            words += [word() for _ in range(rng.randrange(30))]
            words += rng.choice(shared)
        rows.append((i, rng.choice([" ", "\n", "\t ", "\x0b"]).join(words)))
    base = [word() for _ in range(200)]
    for i in range(n_docs, n_docs + 15):
        near = list(base)
        near[rng.randrange(200)] = word()
        rows.append((i, " ".join(near)))
    rows += [(i, " ".join(base)) for i in (3, 200, 201, 201, 202)]
    rows += [(300, "the " * 300), (301, "the " * 120), (302, "a b c " * 100), (303, "b c a " * 40), (299, "the " * 25)]
    rows += [(None, " ".join(base)), (None, None), (400, None), (401, ""), (402, " \n\t "), (403, "ÄÖ ß " * 60)]
    rows += [(404, "ÄÖ ß " * 61), (404, " ".join(base[10:90])), (405, "x" * 30000 + " " + " ".join(base[:45]))]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(("seed", "sizes"), [
    (1, {}), (2, {"block": 16}), (3, {"shard_words": 0}), (4, {"seed": 3, "block": 64, "shard_words": 300}),
    (5, {"seed": 20}), (6, {"seed": 1, "shard_words": 2000}),
])
def test_removals_equal_plain(session, seed, sizes):
    rows = passages(seed)
    docs = session.createDataFrame(rows, "doc_id long, text string").withColumns({"words": F.lit(1), "span": F.lit("x")})
    found = substring_dedup.dedup(docs, 20, with_text=True, **sizes).collect()
    assert in_order(found) == in_order(plain_removals(rows, 20))


def test_removals_of_nothing(session, odd_docs, no_docs):
    assert substring_dedup.dedup(no_docs).collect() == []
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert in_order(substring_dedup.dedup(odd_docs, with_text=True).collect()) == in_order(plain_removals(rows, 50))


def test_matching_statistics():
    automaton = substring_dedup.SuffixAutomaton()
    automaton.add(list("abcabx"))
    automaton.add(list("bcabcd"))
    assert automaton.spans(list("zabcabcdzz"), 4) == [(1, 8)]
    assert automaton.spans(list("abxbcabxz"), 3) == [(0, 8)]
    assert automaton.spans(list("zzzz"), 1) == []
    rng = random.Random(5)
    texts = ["".join(rng.choice("ab") for _ in range(40)) for _ in range(5)]
    automaton = substring_dedup.SuffixAutomaton()
    for t in texts:
        automaton.add(list(t))
    query = "".join(rng.choice("ab") for _ in range(200))
    covered = set()
    for s in range(len(query) - 6):
        if any(query[s : s + 7] in t for t in texts):
            covered |= set(range(s, s + 7))
    assert covered == {i for a, b in automaton.spans(list(query), 7) for i in range(a, b)}


def test_equal_windows_sample_equal_seeds():
    rng = random.Random(1)
    run = [b"%d" % rng.randrange(9) for _ in range(50)]
    sample = substring_dedup.SeedSampler(50, 16)
    inside = set(sample(run)[1].tolist())
    for _ in range(20):
        around = [b"%d" % rng.randrange(9) for _ in range(rng.randrange(60))]
        assert inside <= set(sample(around + run + around[::-1])[1].tolist())


# Fill-in-middle


def plain_form(doc_id, text, rate=100, spm=50):
    units = re.findall(r"[^\n]*\n|[^\n]+", text or "")
    n = len(units)
    h = digest(f"7:{'' if doc_id is None else doc_id}")
    h1, h2, h3, h4 = (int(h[8 * i : 8 * i + 8], 16) for i in range(4))
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = ("".join(u) for u in (units[:a], units[a:b], units[b:]))
    if not text or any(m in text for m in fill_middle.MARKS) or h3 % 100 >= rate:
        return doc_id, n, "plain", None, None, text or ""
    if h4 % 100 < spm:
        return doc_id, n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return doc_id, n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def odd_lines():
    rng = random.Random(8)
    rows = [(i, "".join(rng.choice(["a", "é\U0001f600", "\n", "\n\n", "line of text", "\r\n", "<P", ">"]) for _ in range(rng.randrange(60))))
            for i in range(80)]
    rows += [(200, "x" * 9000), (201, "ü" * 5000 + "\n" + "y\n" * 3000), (202, "a<M>b\nc"), (203, "\n"), (204, None), (205, "")]
    return rows + [(206, "one\ntwo"), (206, "one\ntwo"), (206, "three\nfour\nfive"), (None, "p\nq\nr"), (None, None), (None, "p\nq\nr")]


@pytest.mark.parametrize("piece_bytes", [1, 7, 100, 32768])
def test_fill_middle_equals_plain(session, piece_bytes):
    rows = odd_lines()
    docs = session.createDataFrame(rows, "doc_id long, text string").withColumns({"place": F.lit(9), "n": F.lit("x")})
    for rate, spm in ((100, 50), (40, 0)):
        options = {"piece_bytes": piece_bytes, "rate": rate, "spm": spm}
        plain = [plain_form(i, t, rate, spm) for i, t in rows]
        want = [(*p[:5], digest(p[5]), digest(t or "")) for p, (_, t) in zip(plain, rows, strict=True)]
        assert in_order(fill_middle.report(docs, **options).collect()) == in_order(want)
        made = fill_middle.outputs(fill_middle.pieces(docs, **options)).collect()
        assert in_order(made) == in_order(plain)


def test_fill_middle_of_nothing(session, no_docs, odd_docs):
    assert fill_middle.report(no_docs).collect() == []
    assert fill_middle.report(odd_docs).count() == odd_docs.count()


def test_fill_middle_shuffles_texts_once(session, odd_docs):
    plan = fill_middle.report(odd_docs)._jdf.queryExecution().executedPlan().toString()
    dealt = [line for line in plan.splitlines() if "Exchange hashpartitioning(doc_id" in line and "REPARTITION_BY_COL" in line]
    assert len(dealt) == 2  # the same exchange in both branches: one is reused when the plan runs
    frame = fill_middle.report(odd_docs)
    frame.collect()
    assert "ReusedExchange" in frame._jdf.queryExecution().executedPlan().toString()
