"""Language, quality, kNN and the pipeline."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from daygrid.llm import knn, langid, quality
from daygrid.llm.queries import QUERIES


@pytest.fixture(scope="module")
def medium_root():
    return "/root/testdata/sf0.01"


def test_language_held_out(session, medium_root):
    truth = {r.doc_id: r.lang for r in session.read.parquet(f"{medium_root}/documents.parquet").select("doc_id", "lang").collect()}
    rows = [r for r in QUERIES["op5_language"](session, medium_root).collect() if r.held_out and truth[r.doc_id]]
    assert len(rows) > 200 and np.mean([truth[r.doc_id] == r.lang_pred for r in rows]) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_of_odd_texts(session, odd_docs, no_docs):
    model = langid.train([("the cat and the dog", "en"), ("der hund und die katze", "de")])
    rows = langid.predict(odd_docs, model).collect()
    assert len(rows) == odd_docs.count()
    for r in rows:
        assert (r.lang_pred == "und") == (r.doc_id in (1, 2, 3, 13)) and 0 <= r.score <= 1
    assert {r.lang_pred for r in langid.predict(odd_docs, langid.fit(odd_docs)).collect()} == {"und"}
    assert langid.predict(no_docs, model).collect() == []


def test_recurrent_gradients():
    rng = np.random.default_rng(0)
    gru = langid.Gru.fresh(rng, 3)
    for name in ("inputs", "gates", "candidate"):
        setattr(gru, name, getattr(gru, name).astype(np.float64))
    codes, mask = langid._pad([b"abca", b"ba", b"c"])
    states, kept = gru.forward(codes, mask)
    weight = rng.standard_normal(states.shape)
    grads = gru.backward(codes, mask, kept, weight)
    for name, grad in zip(("inputs", "gates", "candidate"), grads, strict=True):
        array = getattr(gru, name)
        at = np.unravel_index(np.abs(grad).argmax(), grad.shape)
        values = []
        for step in (1e-2, -1e-2):
            array[at] += step
            values.append((gru.forward(codes, mask)[0].astype(float) * weight).sum())
            array[at] -= step
        assert abs((values[0] - values[1]) / 2e-2 - grad[at]) < 1e-2 * max(1, abs(grad[at]))


def test_quality_held_out(session, medium_root):
    truth = {r.doc_id: r.quality for r in session.read.parquet(f"{medium_root}/labels.parquet").collect()}
    rows = [r for r in QUERIES["op8_quality"](session, medium_root).collect() if r.held_out and r.doc_id in truth]
    good = np.array([r.score for r in rows if truth[r.doc_id] == 1])
    bad = np.array([r.score for r in rows if truth[r.doc_id] == 0])
    assert (good[:, None] > bad[None, :]).mean() > 0.95
    assert all(r.predicted == (r.score >= 0.3) for r in rows)


def test_quality_of_odd_texts(session, odd_docs, no_docs):
    model = quality.train([("good text of words", 1), ("!!! ### %%%", 0)] * 3)
    rows = quality.score(odd_docs, model).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert quality.score(no_docs, model).collect() == []
    assert all(r.predicted == 0 for r in quality.score(odd_docs, quality.train([])).collect())


def test_quality_chunks_cover_the_text():
    for n in (0, 1, 509, 510, 511, 960, 961, 5000):
        starts = quality.chunk_starts(n)
        seen = np.zeros(max(1, n), bool)
        for s in starts:
            seen[s : s + quality.CHUNK] = True
        assert seen.all()


def brute_top(vectors, is_query, k):
    whole = {i: knn._integers(v) for i, v in vectors}
    whole = {i: v.astype(int) for i, v in whole.items() if v is not None}
    dot = lambda a, b: int(sum(x * y for x, y in zip(a.tolist(), b.tolist())))  # noqa: E731, B905
    out = set()
    for q in filter(is_query, whole):
        best = sorted((-dot(whole[q], v), i) for i, v in whole.items() if i != q)[:k]
        out |= {(q, r, i, -s) for r, (s, i) in enumerate(best, 1)}
    return out


def test_knn_odd_vectors_and_ties(session, monkeypatch):
    monkeypatch.setattr(knn, "PART_ROWS", 40)
    monkeypatch.setattr(knn, "PART_QUERIES", 3)
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in np.round(rng.standard_normal(6) * (1 + i % 3), 1)]) for i in range(150)]
    rows += [(200 + i, rows[0][1]) for i in range(30)]
    rows += [(300, None), (301, [1.0, None, 1.0]), (302, [float("nan")] * 6), (303, [float("inf")] * 6), (304, []), (305, [1.0])]
    rows += [(306, [1e12] * 6), (310, [0.0] * 6)]
    data = session.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<double>, score string, rank int")
    found = {tuple(r) for r in knn.top_k(data, F.col("vec_id") % 10 == 0).collect()}
    exact = [(i, v) for i, v in rows if i != 306]
    assert len(found) == 5 * len({q for q, *_ in found})
    small = {tuple(r) for r in knn.top_k(data.where("vec_id <> 306"), F.col("vec_id") % 10 == 0).collect()}
    assert small == brute_top(exact, lambda i: i % 10 == 0, 5)
    few = {tuple(r) for r in knn.top_k(data.where("vec_id < 3"), F.col("vec_id") == 0).collect()}
    assert few == brute_top(rows[:3], lambda i: i == 0, 5)
    assert knn.top_k(data.limit(0), F.col("vec_id") == 0).collect() == []
    assert knn.top_k(data, F.col("vec_id") < 0).collect() == []


def test_pipeline_stages(session, odd_docs):
    text = "el perro y la casa en el campo con los ninos que van a la escuela cada dia de la semana"
    rows = [(100, text, "es"), (101, text.upper(), "es"), (102, text + " ana@example.org", None), (103, "123", None), (104, None, None)]
    docs = session.createDataFrame([(i, t, lang, "s", len(t or ""), "x") for i, t, lang in rows],
                                   "doc_id long, text string, lang string, source string, n_chars long, score string")
    seen = []
    for name, step in corpus_pipeline.STAGES[:-1]:
        out = step(session, docs, "")
        assert out.columns == docs.columns
        docs = session.createDataFrame(out.collect(), docs.schema)
        seen.append((name, sorted(r.doc_id for r in docs.collect())))
    assert seen == [("language", [100, 101, 102]), ("exact_dedup", [101, 102]), ("near_dedup", [101]), ("pii", [101])]
    pieces = corpus_pipeline.STAGES[-1][1](session, docs, "").collect()
    assert {p.doc_id for p in pieces} == {101}
    for _, step in corpus_pipeline.STAGES:
        assert step(session, odd_docs.limit(0), "").collect() == []
