"""Quality of a text from a convolutional network over its bytes, in numpy.

Every window of bytes meets learned filters; the windows cover the whole text in overlapping chunks.
The maxima of each chunk are combined over the document (mean by new bytes, and maximum) into one probability.
A filter is a table per byte and place in the window, so no embedding is multiplied out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from daygrid.llm.common import train_rows

#: Sample for training: documents per label, each read whole.
TRAIN_DOCS, EPOCHS = 700, 8
FILTERS, WIDTH = 16, 6
CHUNK, OVERLAP = 510, 60
#: Chunks looked at together; they bound the memory that a long text takes.
SLICE = 256
THRESHOLD = 0.3
#: Place holder byte after the end of a text; it never occurs in UTF-8.
PAD = 255


@dataclass
class Model:
    """Byte features (256 x D), filters (WIDTH * D x F), weights of mean and maximum (2 F) and bias."""

    bytes: np.ndarray
    filters: np.ndarray
    shift: np.ndarray
    weights: np.ndarray
    bias: np.ndarray

    def arrays(self) -> list[np.ndarray]:
        return [self.bytes, self.filters, self.shift, self.weights, self.bias]


def fresh(seed: int = 5, depth: int = 6) -> Model:
    rng = np.random.default_rng(seed)
    draw = lambda scale, *shape: (rng.standard_normal(shape) * scale).astype(np.float32)
    return Model(draw(0.5, 256, depth), draw(0.3, WIDTH * depth, FILTERS), np.zeros(FILTERS, np.float32),
                 draw(0.1, 2 * FILTERS), np.zeros(1, np.float32))


def chunk_starts(length: int) -> range:
    """Chunks overlap, and the last one reaches the end; an empty text has one chunk of padding."""
    return range(0, max(1, length - OVERLAP), CHUNK - OVERLAP)


def chunk_weights(length: int) -> np.ndarray:
    """Bytes each chunk covers first: the weights of the mean, so that a chunk of few new bytes moves it little."""
    ends = np.minimum(np.array(chunk_starts(length)) + CHUNK, max(1, length))
    return np.diff(ends, prepend=0).astype(np.float32)


def chunks_of(raw: bytes, starts: range) -> np.ndarray:
    """The chunks of a text that begin at ``starts`` (a row each), padded after its end."""
    if not len(starts):
        return np.zeros((0, CHUNK), np.uint8)
    part = np.full(starts[-1] + CHUNK - starts[0], PAD, np.uint8)
    data = np.frombuffer(raw, np.uint8)[starts[0] : starts[-1] + CHUNK]
    part[: len(data)] = data
    return np.lib.stride_tricks.sliding_window_view(part, CHUNK)[:: CHUNK - OVERLAP]


def slices_of(raw: bytes) -> Iterator[np.ndarray]:
    """All chunks of a text, at most SLICE at once."""
    starts = chunk_starts(len(raw))
    for at in range(0, len(starts), SLICE):
        yield chunks_of(raw, starts[at : at + SLICE])


def answers(model: Model, chunks: np.ndarray) -> np.ndarray:
    """What each filter answers to the window at each place of each chunk (chunks x places x F)."""
    depth, places = model.bytes.shape[1], CHUNK - WIDTH + 1
    # One table per place in the window: the filter's answer to each byte there.
    tables = [model.bytes @ model.filters[i * depth : (i + 1) * depth] for i in range(WIDTH)]
    total = tables[0].take(chunks[:, :places], axis=0)
    for i in range(1, WIDTH):
        total += tables[i].take(chunks[:, i : i + places], axis=0)
    return total


def chunk_features(model: Model, chunks: np.ndarray) -> np.ndarray:
    """Maxima of each filter over each chunk (chunks x F)."""
    return np.maximum(answers(model, chunks).max(axis=1) + model.shift, 0)


def _strongest(model: Model, raws: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per chunk of all texts: the text it belongs to, each filter's strongest answer and the window (F x WIDTH) that gave it."""
    doc, top, chosen = [], [], []
    place = np.arange(WIDTH)
    waiting: list[np.ndarray] = []

    def look() -> None:
        chunks = np.concatenate(waiting)
        waiting.clear()
        for at in range(0, len(chunks), SLICE):
            some = chunks[at : at + SLICE]
            given = answers(model, some)
            best = given.argmax(axis=1)
            top.append(np.take_along_axis(given, best[:, None, :], axis=1)[:, 0])
            chosen.append(some[np.arange(len(some))[:, None, None], best[:, :, None] + place])

    for i, raw in enumerate(raws):
        for chunks in slices_of(raw):
            doc.append(np.full(len(chunks), i))
            waiting.append(chunks)
            if sum(map(len, waiting)) >= SLICE:
                look()
    if waiting:
        look()
    return np.concatenate(doc), np.concatenate(top), np.concatenate(chosen)


def combine(model: Model, features: np.ndarray, weights: np.ndarray) -> float:
    """Probability of label 1 from the chunk features of one document and the weights of its chunks."""
    pooled = np.concatenate([weights @ features / weights.sum(), features.max(0)])
    return float(1 / (1 + np.exp(-np.clip(pooled @ model.weights + model.bias[0], -30, 30))))


def train(rows: list[tuple[str, int]], seed: int = 5) -> Model:
    """Adam over whole documents, every chunk of them; one label or no row leaves the prior."""
    model = fresh(seed)
    labels = np.array([y for _, y in rows], np.float32)
    if not len(rows) or labels.min() == labels.max():
        model.weights[:] = 0
        model.bias[:] = 4 if len(rows) and labels[0] else -4
        return model
    rng = np.random.default_rng(seed)
    raws = [text.encode("utf-8") for text, _ in rows]
    weight = np.where(labels == 1, 0.5 / labels.mean(), 0.5 / (1 - labels.mean())).astype(np.float32)
    moments = [(np.zeros_like(w), np.zeros_like(w)) for w in model.arrays()]
    depth, step = model.bytes.shape[1], 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(rows))
        for at in range(0, len(order), 16):
            docs = order[at : at + 16]
            doc, top, chosen = _strongest(model, [raws[d] for d in docs])
            top = top + model.shift
            feature = np.maximum(top, 0)
            part = np.concatenate([w / w.sum() for w in (chunk_weights(len(raws[d])) for d in docs)])[:, None]
            begin = np.r_[0, np.flatnonzero(np.diff(doc)) + 1]
            mean = np.add.reduceat(feature * part, begin, axis=0)
            most = np.maximum.reduceat(feature, begin, axis=0)
            pooled = np.hstack([mean, most])
            chance = 1 / (1 + np.exp(-np.clip(pooled @ model.weights + model.bias, -30, 30)))
            wrong = (chance - labels[docs]) * weight[docs] / len(docs)
            d_pooled = wrong[:, None] * model.weights[None, :]
            is_most = feature == most[doc]
            shared = np.add.reduceat(is_most.astype(np.float32), begin, axis=0)
            d_feature = d_pooled[doc, :FILTERS] * part + d_pooled[doc, FILTERS:] * is_most / shared[doc]
            d_feature = (d_feature * (top > 0)).astype(np.float32)
            seen = model.bytes[chosen].reshape(len(doc), FILTERS, WIDTH * depth)
            d_filters = np.einsum("cfk,cf->kf", seen, d_feature)
            d_seen = d_feature[:, :, None] * model.filters.T[None]
            d_bytes = np.zeros_like(model.bytes)
            np.add.at(d_bytes, chosen.reshape(-1), d_seen.reshape(-1, depth))
            grads = [d_bytes, d_filters, d_feature.sum(0), pooled.T @ wrong, wrong.sum(keepdims=True)]
            step += 1
            for w, g, (m, v) in zip(model.arrays(), grads, moments, strict=True):
                m += 0.1 * (g - m)
                v += 0.005 * (g * g - v)
                w -= 0.01 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.995**step)) + 1e-8)
    return model


def fit(labelled: DataFrame, per_label: int = TRAIN_DOCS) -> Model:
    """Train on a bounded sample of ``labelled`` (doc_id, text, quality), ``per_label`` documents of each label."""
    known = labelled.where("quality IN (0, 1) AND doc_id IS NOT NULL")
    known = known.selectExpr("doc_id", "coalesce(text, '') AS text", "quality")
    rows = train_rows(known, "doc_id", "quality", per_label).collect()
    return train([(r.text, r.quality) for r in sorted(rows, key=lambda r: (r.doc_id, r.text))])


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, score and predicted (1 from ``threshold`` on) per row of ``docs`` (doc_id, text).

    Null and empty texts are scored as padding only. Repeated rows are scored each; other columns are ignored.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                raw = (text or "").encode("utf-8")
                parts = [chunk_features(model, chunks) for chunks in slices_of(raw)]
                out.append((doc_id, combine(model, np.concatenate(parts), chunk_weights(len(raw)))))
            frame = pd.DataFrame(out, columns=["doc_id", "score"])
            frame["predicted"] = (frame["score"] >= threshold).astype("int32")
            yield frame

    return docs.select("doc_id", "text").mapInPandas(run, "doc_id long, score double, predicted int")
