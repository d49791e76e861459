"""Rows that the filtering stages keep, against plain versions: null and repeated ids, and the whole pipeline."""

import itertools

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from daygrid.llm import exact_dedup, ngram_join

from .brute import shingles

LONG = "one two three four five six seven eight nine ten eleven twelve "
ROWS = [
    (None, "unique text alpha"), (5, "text one is here"), (5, "another text wholly"), (6, "text ONE is here"),
    (7, None), (7, ""), (None, None), (8, "  "), (8, "  "), (9, LONG * 2), (9, "apart from it all we go on"),
    (10, LONG.upper() + LONG), (None, LONG * 2 + "x"), (None, "only here without id, said once"), (None, "ONLY here without id, said once"),
    (11, "repeated row"), (11, "repeated row"), (11, "REPEATED row"), (None, "unique text alpha"), (None, ""),
]


@pytest.fixture(scope="module")
def docs(session):
    rows = [(i, t, "en", "s", len(t or ""), {"k": str(i)}, "x") for i, t in ROWS]
    return session.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, kept_id map<string,string>, `group` string"
    )


def lower(text):
    return (text or "").encode().lower()


def plain_last(rows):
    """Of equal texts the largest doc_id, those without one below all; then the first text."""
    best = {}
    for i, t in rows:
        key = (-(2**63) if i is None else i,)
        have = best.get(lower(t))
        if have is None or key > have[0] or (key == have[0] and order((i, t)) < order(have[1])):
            best[lower(t)] = (key, (i, t))
    return sorted((row for _, row in best.values()), key=order)


def order(row):
    i, t = row
    return (i is None, i or 0, t is not None, (t or "").encode())


def plain_first(rows):
    """One row of each linked group: the smallest doc_id, those without one last; rows without words all stay, once."""
    unique = sorted(set(rows), key=order)
    sets = [shingles(t) for _, t in unique]
    group = list(range(len(unique)))
    for a, b in itertools.combinations(range(len(unique)), 2):
        both = len(sets[a] & sets[b])
        if sets[a] and sets[b] and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
            x, y = group[a], group[b]
            group = [x if g == y else g for g in group]
    stay = {}
    for row, s, g in zip(unique, sets, group, strict=True):
        stay.setdefault(g if s else ("none", row[0], row[1] or ""), []).append(row)
    return list(stay.values())


def test_exact_stage_keeps_one_row_of_every_text(docs):
    out = exact_dedup.keep_last(docs)
    assert out.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in out.collect()), key=order) == plain_last(ROWS)


def test_near_stage_keeps_one_row_of_every_group(docs):
    out = ngram_join.keep_first(docs)
    assert out.columns == docs.columns
    found = sorted(((r.doc_id, r.text) for r in out.collect()), key=order)
    groups = plain_first(ROWS)
    assert len(found) == len(groups)
    for rows in groups:
        kept = [r for r in found if r in rows]
        assert len(kept) == 1 and (kept[0][0] is None) == (rows[0][0] is None) and kept[0][0] == rows[0][0]


def test_links_of_rows_without_ids(docs):
    out = {(r.doc_id, r.n_shingles): r for r in ngram_join.near_groups(docs).collect()}
    assert out[10, 12].component_id == 9 and out[None, 13].component_id == 9


def test_pipeline_equals_a_plain_version(session, data_root, tmp_path):
    """On the given documents with rows added that repeat an id or have none."""
    given = session.read.parquet(f"{data_root}/documents.parquet")
    # The id of the first document with another text, and a text without an id.
    first = given.agg(F.min("doc_id")).first()[0]
    added = given.where(F.col("doc_id") == first).withColumn("text", F.lit("quite another text, held by no other document"))
    nameless = added.withColumns({"doc_id": F.lit(None).cast("long"), "text": F.lit("a text without an id, held by no other document")})
    given.unionByName(added).unionByName(nameless).write.parquet(f"{tmp_path}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in session.read.parquet(f"{tmp_path}/documents.parquet").collect()]
    lettered = [(i, t) for i, t in rows if t and any(map(str.isalpha, t))]
    groups = plain_first(plain_last(lettered))
    docs = session.read.parquet(f"{tmp_path}/documents.parquet")
    for _, step in corpus_pipeline.STAGES[:3]:
        docs = session.createDataFrame(step(session, docs, str(tmp_path)).collect(), given.schema)
    kept = sorted(((r.doc_id, r.text) for r in docs.collect()), key=order)
    assert kept == sorted((g[0] for g in groups), key=order)
    assert (first, added.first().text) in kept and (None, nameless.first().text) in kept
    pieces = corpus_pipeline.run(session, str(tmp_path)).groupBy("doc_id").agg(F.sum("length").alias("n")).collect()
    assert {p.doc_id for p in pieces} == {i for i, _ in kept}
