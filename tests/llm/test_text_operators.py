"""Tokens, packing, encoding, edits, copies, personal data and chats against plain versions."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from daygrid.llm import bpe, chat, edit_counts, exact_dedup, ngram_join, packing, pii
from daygrid.llm.queries import BYTE_RANKS, BYTE_SPECIALS, QUERIES, WORD_FILE
from tests.llm import brute

BYTES = (BYTE_RANKS, public_tokenizers.PATTERN, BYTE_SPECIALS)


def texts_of(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.fixture(scope="module")
def given(session, data_root):
    return texts_of(session.read.parquet(f"{data_root}/documents.parquet"))


@pytest.fixture(scope="module")
def byte_file():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def check_packing(pieces, texts, tokenizer):
    want = Counter()
    for doc_id, text in texts:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        want[(doc_id, len(ids), ids.tobytes())] += 1
    ids_of = {k[0]: k for k in want}
    covered = Counter()
    for p in pieces:
        _, n, raw = ids_of[p.doc_id]
        assert p.doc_tokens == n and 0 < p.length <= 1024
        assert zlib.crc32(raw[4 * p.start : 4 * (p.start + p.length)]) == p.ids_crc32
        covered[p.doc_id] += p.length
    assert covered == Counter({k[0]: k[1] * c for k, c in want.items()})
    by_sequence = {}
    for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)):
        assert by_sequence.get(p.sequence_id, 0) == p.offset
        by_sequence[p.sequence_id] = p.offset + p.length
    assert all(n <= 1024 for n in by_sequence.values())


def test_packing_of_odd_and_given_texts(session, odd_docs, given, byte_file, data_root):
    check_packing(packing.pack(odd_docs, *BYTES).collect(), texts_of(odd_docs), byte_file)
    check_packing(QUERIES["op7_packing"](session, data_root).collect(), given, byte_file)


def test_packing_merges_leftovers_of_tasks(session, odd_docs, byte_file):
    docs = odd_docs.where("doc_id <> 8").repartition(6)
    pieces = packing.pack(docs, *BYTES, open_windows=2).collect()
    check_packing(pieces, texts_of(docs), byte_file)
    short = Counter()
    for p in pieces:
        short[p.sequence_id] += p.length
    assert sum(n < 1024 for n in short.values()) <= 4


def test_packing_keeps_ids_and_takes_no_rows(odd_docs, no_docs):
    row = packing.pack(odd_docs.where("doc_id = 7"), *BYTES, with_ids=True).first()
    assert zlib.crc32(np.array(row.ids, "<u4").tobytes()) == row.ids_crc32 and row.ids[-1] == 0
    assert packing.pack(no_docs, *BYTES).collect() == []
    assert [packing.padded_length(n) for n in (1, 2, 3, 700, 1024)] == [1, 2, 4, 1024, 1024]


def test_bpe_equals_the_library(session, odd_docs, no_docs, given, data_root):
    library = Tokenizer.from_file(WORD_FILE)
    for rows, texts in (
        (bpe.encode_texts(odd_docs, WORD_FILE).collect(), texts_of(odd_docs)),
        (QUERIES["op9_bpe"](session, data_root).collect(), given),
    ):
        want = Counter()
        for doc_id, text in texts:
            ids = library.encode(text or "", add_special_tokens=False).ids
            want[(doc_id, len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False)))] += 1
        assert Counter(tuple(r) for r in rows) == want
    assert bpe.encode_texts(no_docs, WORD_FILE).collect() == []


def test_bpe_of_random_words():
    library, own = Tokenizer.from_file(WORD_FILE), bpe.BatchBpe(WORD_FILE)
    pick = random.Random(3)
    words = ["".join(pick.choices("aabcéñ9ß", k=pick.randint(1, 40))) for _ in range(500)] + ["a" * 300, "ab" * 200]
    for text in words:
        found = [i for w in own.encode([w for w in own.words(text)]) for i in w.tolist()]
        assert found == library.encode(text, add_special_tokens=False).ids


def test_edits_equal_a_full_count(odd_docs, no_docs, byte_file):
    rows = edit_counts.count_edits(odd_docs, *BYTES).collect()
    for (doc_id, text), row in zip(texts_of(odd_docs), rows, strict=True):
        edited = text or ""
        for start, end, new in edit_counts.default_edits(len(edited), doc_id):
            edited = edited[:start] + new + edited[end:]
        assert (row.n_tokens, row.n_tokens_edited, row.n_chars_edited) == (
            len(byte_file.encode(text or "").ids), len(byte_file.encode(edited).ids), len(edited),
        )
    assert edit_counts.count_edits(no_docs, *BYTES).collect() == []


def test_edits_at_random_encode_little(byte_file):
    pick = random.Random(5)
    text = " ".join("".join(pick.choices("abcdef", k=pick.randint(1, 9))) for _ in range(8000))
    count = lambda s: len(byte_file.encode(s).ids)
    tree = edit_counts.CountTree(text, count)
    for _ in range(60):
        start = pick.randrange(len(text) + 1)
        end = min(len(text), start + pick.choice([0, 1, 5, 2000]))
        new = pick.choice(["", " ", "x", "  \n ", "new words here " * 80])
        before = tree.encoded_chars
        tree.edit(start, end, new)
        text = text[:start] + new + text[end:]
        assert tree.encoded_chars - before < len(new) + 3000
        assert tree.length == len(text)
    assert tree.text() == text and tree.total == count(text)


def test_exact_dedup(odd_docs, no_docs):
    low = lambda t: "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
    texts = texts_of(odd_docs)
    groups = {}
    for doc_id, text in texts:
        groups.setdefault(low(text), []).append(doc_id)
    want = Counter((i, max(groups[low(t)]), len(groups[low(t)]), i == max(groups[low(t)]), sha(low(t))) for i, t in texts)
    assert Counter(tuple(r) for r in exact_dedup.dedup(odd_docs).collect()) == want
    assert exact_dedup.dedup(no_docs).collect() == []
    kept = exact_dedup.keep_last(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({max(g) for g in groups.values()})


def test_null_id_joins_no_group(session):
    docs = session.createDataFrame([(None, "a"), (1, "A"), (2, "a")], "doc_id long, text string")
    rows = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in exact_dedup.dedup(docs).collect()}
    assert rows == {None: (None, 0, False), 1: (2, 2, False), 2: (2, 2, True)}


def test_cuckoo_index_grows_deletes_and_reuses():
    rng = np.random.default_rng(1)
    digests = rng.integers(0, 2**63, (9000, 4)).astype(np.uint64)
    index = exact_dedup.CuckooIndex(buckets=16)
    for part in np.array_split(digests, 7):
        index.insert(part, np.ones(len(part), np.int64), np.arange(len(part)))
    assert len(index) == 9000 and (index.find(digests) >= 0).all() and len(index.prints) > 16
    index.delete(digests[:4000])
    assert (index.find(digests[:4000]) == -1).all() and (index.find(digests[4000:]) >= 0).all()
    used = index.used
    index.insert(digests[:4000], np.ones(4000, np.int64), np.ones(4000, np.int64))
    assert index.used == used and len(index) == 9000
    # A fingerprint that agrees is not enough: the stored digest decides.
    near = digests[:50].copy()
    near[:, 3] ^= np.uint64(1)
    assert (index.find(near) == -1).all()


def test_index_tables_lose_dead_digests(odd_docs):
    digest = F.unhex(F.sha2(exact_dedup.normalised(F.col("text")), 256)).alias("digest")
    index = exact_dedup.build_index(odd_docs.select("doc_id", digest))
    left = exact_dedup.remove_from_index(index, odd_docs.where("doc_id IN (4, 7)").select(digest))
    assert index.count() - left.count() == 2
    doubled = exact_dedup.merge_indexes(left.unionByName(left))
    assert doubled.count() == left.count() and doubled.agg(F.sum("group_size")).first()[0] == 2 * left.agg(F.sum("group_size")).first()[0]


def test_near_groups(session, odd_docs, no_docs):
    pick = random.Random(11)
    base = [" ".join(f"t{pick.randint(0, 4000)}" for _ in range(n)) for n in (9, 40, 120, 300)]
    rows = [(r.doc_id, r.text) for r in odd_docs.collect() if r.doc_id != 8]
    for i in range(120):
        words = pick.choice(base).split()
        for _ in range(pick.randint(0, 4)):
            words[pick.randrange(len(words))] = f"new{pick.randint(0, 9)}"
        rows.append((100 + i, " ".join(words[: len(words) - pick.randint(0, 3)])))
    docs = session.createDataFrame(rows, "doc_id long, text string")
    want = brute.near_groups(dict(rows))
    found = {r.doc_id: (r.n_shingles, r.component_id, r.n_links) for r in ngram_join.near_groups(docs).collect()}
    assert found == want
    assert ngram_join.near_groups(no_docs).collect() == []
    plain = ngram_join.near_groups(docs, count_links=False)
    assert {r.doc_id: tuple(r)[1:] for r in plain.collect()} == {k: v[:2] for k, v in want.items()}
    kept = ngram_join.keep_first(docs)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(k for k, v in want.items() if v[1] == k)


@pytest.mark.parametrize(("block", "probe"), [(7, 16), (35, 0), (60, 1)])
def test_near_groups_of_large_components(session, monkeypatch, block, probe):
    """Components above the block size are searched in pairs of blocks, with the same result."""
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    monkeypatch.setattr(ngram_join, "PROBE", probe)
    monkeypatch.setattr(ngram_join, "SLICE", 50)
    pick = random.Random(2)
    words = [f"t{i}" for i in range(80)]
    rows = []
    for i in range(60):
        own = list(words)
        for _ in range(pick.randint(0, 3)):
            own[pick.randrange(80)] = f"n{pick.randint(0, 300)}"
        rows.append((i, " ".join(own)))
    rows += [(60 + i, rows[i][1].upper()) for i in range(5)]
    docs = session.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: (r.n_shingles, r.component_id, r.n_links) for r in ngram_join.near_groups(docs).collect()}
    assert found == brute.near_groups(dict(rows))


@pytest.mark.parametrize(("probe", "entries"), [(16, 2_000_000), (0, 40), (1, 7)])
def test_divide_skip_counts_every_link(monkeypatch, probe, entries):
    monkeypatch.setattr(ngram_join, "PROBE", probe)
    monkeypatch.setattr(ngram_join, "SLICE", entries)
    rng = np.random.default_rng(4)
    bases = [rng.choice(5000, n, replace=False) for n in (1, 7, 30, 90, 91)]
    sets = []
    for i in range(150):
        own = bases[i % 5].copy()
        own[rng.integers(0, len(own), rng.integers(0, 6))] = rng.integers(5000, 5010)
        sets.append(np.unique(own).astype(np.uint64))
    names, copies, block = np.arange(150) * 7 - 300, rng.integers(1, 5, 150), np.arange(150) % 3
    plain = [set(s.tolist()) for s in sets]
    degree, near = [0] * 150, set()
    for i in range(150):
        for j in range(i):
            if 100 * len(plain[i] & plain[j]) >= 75 * len(plain[i] | plain[j]):
                near.add((i, j))
                if block[i] != block[j] or block[i] == 1:
                    degree[i] += copies[j]
                    degree[j] += copies[i]
    links, found = ngram_join.divide_skip(sets, names, copies, block, (1,))
    assert found.tolist() == degree
    few, _ = ngram_join.divide_skip(sets, names, copies, block, (1,), every=False)

    def groups(pairs):
        label = list(range(150))
        for i, j in pairs:
            old, new = label[i], label[j]
            label = [new if x == old else x for x in label]
        return [label.index(x) for x in label]

    back = {int(n): i for i, n in enumerate(names)}
    want = groups(near)
    assert groups([(back[a], back[b]) for a, b in links]) == want == groups([(back[a], back[b]) for a, b in few])
    assert len(links) == 150 - len(set(want))


def test_near_groups_of_given_texts(session, given, data_root):
    found = {r.doc_id: (r.n_shingles, r.component_id, r.n_links) for r in QUERIES["op2_ngram_join"](session, data_root).collect()}
    assert found == brute.near_groups(dict(given))


PII_TEXTS = [
    "mail a.b+c@x-y.org, x@y and a@b.c_d@e.f or é@ü.de", "1.2.3.4.5.6.7.8 256.1.1.1 00255.0.0.1 1.2.3",
    "4111 1111 1111 1111 and 4111-1111-1111-1112, 99 4111111111111111", "+1 (389) 555-5010 +49 30 1234567890123456 + 5",
    "\U0001f600 x@y.zz 4111111111111111", "1 2 3 4 5 6 7 8 9", "@" * 300, "9" * 3000, None, "",
]


def test_pii_base_spans(session, odd_docs, given, data_root):
    docs = session.createDataFrame(list(enumerate(PII_TEXTS)), "doc_id long, text string")
    cases = [
        (pii.report(docs), list(enumerate(PII_TEXTS))), (pii.report(odd_docs), texts_of(odd_docs)),
        (QUERIES["op3_pii"](session, data_root), given),
    ]
    for df, texts in cases:
        assert "Python" not in df._jdf.queryExecution().toString()
        texts = dict(texts)
        for r in df.collect():
            spans = brute.base_spans(texts[r.doc_id])
            listed = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
            assert r.base_sha256 == sha(listed)
            assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[0] == k for s in spans) for k in pii.KINDS]
            assert set(listed.split(",")) <= set(r.spans.split(","))


def test_pii_adds_spans_and_redacts(session, no_docs):
    clean = "Nothing to see here, not even 12 apples. " * 3
    rows = [(i, f"card 4111111111111111 4111111111111111 of {clean}") for i in range(5)]
    rows += [(10 + i, f"reach me: user{i}@example.org now") for i in range(20)] + [(40, clean), (41, None)]
    docs = session.createDataFrame([(i, t, len(t or "")) for i, t in rows], "doc_id long, text string, n_chars long")
    found = {r.doc_id: r for r in pii.report(docs).collect()}
    assert found[0].n_card == 0 and found[0].spans == "card:5:21,card:22:38"
    assert found[40].spans == "" and found[41].spans == ""
    out = {r.doc_id: r for r in pii.redact(docs).collect()}
    assert out[0].text == f"card [CARD] [CARD] of {clean}" and out[0].n_chars == len(out[0].text)
    assert out[10].text == "reach me: [EMAIL] now" and out[40].text == clean and out[41].text is None
    assert pii.redact(no_docs).collect() == [] and pii.redact(no_docs).columns == no_docs.columns


def test_chat_query_reads_back(session, data_root):
    df = QUERIES["op4_chat_format"](session, data_root)
    assert "Python" not in df._jdf.queryExecution().toString()
    turns = {-7: [(0, "user", "</s>[INST] ok [/INST]"), (1, "assistant", "</s>[INST] ok [/INST]")]}
    for r in session.read.parquet(f"{data_root}/conversations.parquet").collect():
        turns.setdefault(r.conv_id, []).append((r.turn, r.role, r.text or ""))
    rows = {r.conv_id: r for r in df.collect()}
    assert set(rows) == set(turns)
    for conv_id, own in turns.items():
        own.sort()
        learned = "".join(t for _, role, t in own if role == "assistant")
        r = rows[conv_id]
        assert (r.n_turns, r.loss_chars) == (len(own), len(learned))
        assert r.turns_sha256 == sha("".join(f"{role}\n{t}\n" for _, role, t in own)) and r.loss_sha256 == sha(learned)


def test_chat_escapes_any_control_string(session):
    nasty = ["<|end|>", "<|user|>", "&l;|end|>", "&a;b;&", "[INST]", "\U0001f600<", None, "", "line\nline"]
    rows = [(1, i, ("assistant" if i % 2 else "user"), t) for i, t in enumerate(nasty)] + [(2, 0, None, "<|"), (None, 0, "a<b", "x")]
    data = session.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    done = chat.format_messages(data.withColumn("parts", chat.text_parts(F.col("text"))).withColumn("m", F.lit(1)))
    out = {r.conv_id: r for r in done.select(
        "conv_id", chat.read_back(F.col("formatted")).alias("read"),
        chat.masked_text(F.col("formatted"), F.col("loss_spans")).alias("learned"),
    ).collect()}
    assert [t.text for t in out[1].read] == [t or "" for t in nasty]
    assert out[1].learned == "".join(t or "" for t in nasty[1::2])
    assert [(t.role, t.text) for t in out[2].read] == [("", "<|")] and out[None].read[0].role == "a<b"
    assert chat.format_messages(data.limit(0).withColumn("parts", chat.text_parts(F.col("text")))).collect() == []


def test_chat_parts_become_placeholders(session):
    parts = [
        ("text", "see ", None, None, None, None, None), ("image", None, "i.png", 57, 28, None, None),
        (None, "<b>", None, None, None, None, None), ("audio", None, "a.wav", None, None, 1.5, None),
        ("document", None, "d.pdf", None, None, None, 2), ("video", None, "v", None, None, None, None),
    ]
    data = session.createDataFrame([(1, 0, "user", parts), (1, 1, "user", parts[1:2]), (1, 2, "user", None)],
                                   f"conv_id long, turn long, role string, parts array<{chat.PART}>")
    row = chat.format_messages(data).first()
    assert row.formatted == (
        "<|user|>see <|image:0|>&l;b><|audio:1|><|document:2|><|video:3|><|end|><|user|><|image:0|><|end|><|user|><|end|>"
    )
    assert [(a.message, a.number, a.ref, a.tokens) for a in row.attachments] == [
        (0, 0, "i.png", 3), (0, 1, "a.wav", 38), (0, 2, "d.pdf", 1280), (0, 3, "v", 0), (1, 0, "i.png", 3)
    ]
    assert row.expanded_tokens == 1324


def test_a_round_of_merges_looks_up_only_new_pairs(monkeypatch):
    own, looked_up = bpe.BatchBpe(WORD_FILE), []
    plain = own.ranks_of
    monkeypatch.setattr(own, "ranks_of", lambda left, right: looked_up.append(len(left)) or plain(left, right))
    words = ["internationalisation" * 20, "a" * 301, "zq"]
    found = own.id_lists(words)
    library = Tokenizer.from_file(WORD_FILE)
    assert found == [library.encode(w, add_special_tokens=False).ids for w in words]
    assert sum(looked_up) < 3 * sum(map(len, words))


def test_ascii_words_by_the_short_way():
    own = bpe.BatchBpe(WORD_FILE)
    texts = [a + b for a in map(chr, range(128)) for b in ("", "s", "'ll", "7", "\x1c", "Ab")] + ["<|endoftext|>Ab", "it'S", ""]
    for text in texts:
        pieces = [own.specials.get(p) or own.word.findall(p.lower()) for p in own.special.split(text)]
        assert own.words(text) == [w for p in pieces for w in ([p] if isinstance(p, int) else p)]
