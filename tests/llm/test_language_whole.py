"""The language network against a plain loop, and its segments against whole texts."""

import numpy as np
import pytest

import corpus_pipeline
from daygrid.llm import langid


def plain_states(gru, raw):
    h = gru.candidate.shape[0]
    state, out = np.zeros(h), []
    sig = lambda x: 1 / (1 + np.exp(-x))
    for byte in raw:
        x = gru.inputs[byte].astype(float)
        gate = sig(x[: 2 * h] + state @ gru.gates)
        fresh = np.tanh(x[2 * h :] + (gate[:h] * state) @ gru.candidate)
        state = state + gate[h:] * (fresh - state)
        out.append(state)
    return np.array(out)


def plain_evidence(model, text):
    """Every byte once: network over each segment and its context, byte by byte."""
    raw, total, seen = text.encode(), 0, b""
    for piece, low, high in langid.segments(raw):
        both = np.hstack([plain_states(model.forward, piece), plain_states(model.backward, piece[::-1])[::-1]])
        score = both @ model.out + model.bias
        logs = score - np.log(np.exp(score).sum(1, keepdims=True))
        total = total + logs[low:high].sum(0)
        seen += piece[low:high]
    assert seen == raw
    return total


TEXTS = ["the cat", "a", "der hund und die katze " * 60, "\u4f60\u597d\u4e16\u754c" * 200, "x" * 1200, "\U0001f600 don't"]


@pytest.fixture(scope="module")
def model():
    return langid.train([("the cat and the dog " * 9, "en"), ("der hund und die katze " * 9, "de"), ("\u4f60\u597d", "zh")])


def test_batches_equal_a_plain_loop(model):
    found = langid.evidence(model, [t.encode() for t in TEXTS])
    expected = np.array([plain_evidence(model, t) for t in TEXTS])
    assert np.allclose(found, expected, rtol=1e-3, atol=1e-2)


def test_segments_cut_between_characters():
    for text in [*TEXTS, "\u00e9" * 700, "a" + "\U0001f600" * 400]:
        for piece, low, high in langid.segments(text.encode()):
            piece[low:high].decode()
            assert 0 <= low < high <= len(piece) and high - low <= langid.SEGMENT
    assert list(langid.segments(b"")) == []


def test_context_crosses_blanks(model):
    alone = langid.evidence(model, [b"an"])
    after = langid.evidence(model, [b"der hund an"]) - langid.evidence(model, [b"der hund "])
    assert not np.allclose(alone, after, atol=1e-3)


def test_only_letters_make_a_language(model):
    names, scores = langid._labels(["\u00bd \u00b2", "\u2460", "12 \u0663", "", None, "_", "7 the cat", "\u4f60"], model)
    assert [n == "und" for n in names] == [True] * 6 + [False] * 2
    assert scores[:6] == [0.0] * 6


SCHEMA = "doc_id long, text string, lang string"


def test_language_filter_keeps_all_where_nothing_is_learned(session):
    docs = session.createDataFrame([(1, "der hund", None), (2, "the cat", None)], SCHEMA)
    assert sorted(r.doc_id for r in corpus_pipeline.by_language(session, docs, "").collect()) == [1, 2]


def test_language_filter_does_not_depend_on_the_number_of_languages(session):
    model = langid.train([("the same words for all", f"l{i}") for i in range(8)])
    docs = session.createDataFrame([(1, "the same words", None), (2, "12 34", None), (3, None, None)], SCHEMA)
    assert max(r.score for r in langid.predict(docs, model).collect()) < 0.3
    assert [r.doc_id for r in langid.keep_known(docs, model).collect()] == [1]


def test_language_learns_from_the_end_of_a_text():
    filler = "12345 " * 1000
    model = langid.train([(filler + "katze hund " * 30, "de"), (filler + "gatto cane " * 30, "it")])
    names, _ = langid._labels(["katze hund", "gatto cane"], model)
    assert names == ["de", "it"]
