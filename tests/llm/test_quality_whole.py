"""The quality network against a plain convolution over every byte position."""

import zlib

import numpy as np
import pytest

from daygrid.llm import quality as q


@pytest.fixture(scope="module")
def model():
    return q.train([("good text of words, in order. " * 30, 1), ("!!! ### %%% zz9 " * 30, 0)] * 4)


def whole(model, text):
    raw = text.encode()
    features = np.concatenate([q.chunk_features(model, c) for c in q.slices_of(raw)])
    return q.combine(model, features, q.chunk_weights(len(raw)))


def plain(model, text):
    raw = text.encode()
    features, new, before = [], [], 0
    for s in q.chunk_starts(len(raw)):
        chunk = raw[s : s + q.CHUNK]
        chunk += bytes([q.PAD]) * (q.CHUNK - len(chunk))
        rows = [
            np.concatenate([model.bytes[b] for b in chunk[i : i + q.WIDTH]]) @ model.filters for i in range(q.CHUNK - q.WIDTH + 1)
        ]
        features.append(np.maximum(np.max(rows, axis=0) + model.shift, 0))
        end = max(1, min(len(raw), s + q.CHUNK))
        new.append(end - before)
        before = end
    features = np.array(features)
    mean = (features * np.array(new)[:, None]).sum(0) / sum(new)
    return 1 / (1 + np.exp(-(np.concatenate([mean, features.max(0)]) @ model.weights + model.bias[0])))


def test_equals_a_plain_convolution(model):
    for text in ["", "a", "good words", "x y! " * 101, "ab9 " * 128, "good text " * 300 + "###", "\u00e9t\u00e9 " * 400]:
        assert whole(model, text) == pytest.approx(plain(model, text), abs=1e-4)


def test_every_position_counts(model):
    # A marker moves the features wherever it stands.
    text = "a" * 1800
    base = np.concatenate([q.chunk_features(model, c) for c in q.slices_of(text.encode())]).max(0)
    tops = [
        np.concatenate([q.chunk_features(model, c) for c in q.slices_of((text[:at] + "!!! ### %%%" + text[at:]).encode())]).max(0)
        for at in (700, 701, 702, 1203)
    ]
    assert all((t > base + 1e-3).any() for t in tops)
    assert all(np.allclose(t, tops[0], atol=1e-5) for t in tops)


def test_slices_do_not_matter(model, monkeypatch):
    text = "ab9 good " * 900
    first = whole(model, text)
    monkeypatch.setattr(q, "SLICE", 3)
    assert whole(model, text) == pytest.approx(first, abs=1e-6)


def test_held_out_documents_and_a_blank_in_front(session):
    root = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in session.read.parquet(f"{root}/labels.parquet").collect() if r.quality in (0, 1)}
    docs = [(r.doc_id, r.text or "", labels[r.doc_id]) for r in session.read.parquet(f"{root}/documents.parquet").collect() if r.doc_id in labels]
    out = lambda i: zlib.crc32(str(i).encode()) % 5 == 0
    trained = q.train([(t, y) for i, t, y in docs if not out(i)])
    held = [(t, y) for i, t, y in docs if out(i)]
    score = np.array([whole(trained, t) for t, _ in held])
    moved = np.array([whole(trained, " " + t) for t, _ in held])
    y = np.array([y for _, y in held])
    assert (score[y == 1][:, None] > score[y == 0][None]).mean() > 0.97
    assert abs(score - moved).max() < 0.05 and ((score >= 0.3) == (moved >= 0.3)).all()
