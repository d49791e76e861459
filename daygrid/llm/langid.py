"""Language of a text from a bidirectional gated recurrent network over bytes.

Two GRUs read the bytes of a text from both ends and give a distribution over languages at every byte.
A text is read in segments, whole characters each, with the bytes before and behind a segment as context: every byte is
labelled once, in the segment that owns it, and context crosses blanks. A document's probabilities pool the log
probabilities of all its byte positions. Training is plain numpy: backpropagation through time and Adam, on the
driver, over a bounded sample of rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from daygrid.llm.common import train_rows

#: Sample for training: documents per language, read whole at least once; least number of steps, windows of a step, their bytes.
TRAIN_DOCS, STEPS, BATCH, WINDOW = 150, 250, 64, 120
HIDDEN = 8
#: Bytes a segment owns (fewer where a character would be cut), and bytes it reads beyond either end.
SEGMENT, CONTEXT = 480, 16
#: Segments labelled together.
TOGETHER = 1024
UNKNOWN = "und"
_WORDLIKE = re.compile(r"[^\W\d_]")


def _sigmoid(x):
    return np.float32(0.5) * np.tanh(np.float32(0.5) * x) + np.float32(0.5)


@dataclass
class Gru:
    """Input tables per byte (256 x 3H), recurrent weights (H x 2H gates, H x H candidate)."""

    inputs: np.ndarray
    gates: np.ndarray
    candidate: np.ndarray

    @classmethod
    def fresh(cls, rng, hidden: int) -> Gru:
        draw = lambda *shape: (rng.standard_normal(shape) * 0.3).astype(np.float32)
        return cls(draw(256, 3 * hidden), draw(hidden, 2 * hidden), draw(hidden, hidden))

    def read(self, codes: np.ndarray, mask: np.ndarray) -> np.ndarray:
        """The states of ``forward``, laid out as T x H x B so that every operation runs over contiguous rows."""
        h = self.candidate.shape[0]
        # A gate is 1 / (1 + exp(-x)), a candidate 2 / (1 + exp(-2 x)) - 1: signs and the 2 are in the weights.
        inputs = np.hstack([-self.inputs[:, : 2 * h], -2 * self.inputs[:, 2 * h :]])
        gates, candidate = np.ascontiguousarray(-self.gates.T), np.ascontiguousarray(-2 * self.candidate.T)
        one, two = np.float32(1), np.float32(2)
        whole = mask.all(axis=1)
        states = np.empty((len(codes), h, codes.shape[1]), np.float32)
        state, at = np.zeros(states.shape[1:], np.float32), codes.astype(np.intp)
        for i in range(len(codes)):
            x = np.ascontiguousarray(inputs.take(at[i], axis=0).T)
            gate, fresh = x[: 2 * h], x[2 * h :]
            gate += gates @ state
            np.exp(gate, out=gate)
            gate += one
            np.divide(one, gate, out=gate)
            fresh += candidate @ (gate[:h] * state)
            np.exp(fresh, out=fresh)
            fresh += one
            np.divide(two, fresh, out=fresh)
            fresh -= one
            fresh -= state
            fresh *= gate[h:]
            if not whole[i]:
                fresh *= mask[i]
            state = np.add(state, fresh, out=states[i])
        return states

    def forward(self, codes: np.ndarray, mask: np.ndarray):
        """States (T x B x H) over codes (T x B), and what ``backward`` needs; masked steps keep the state."""
        t, b = codes.shape
        h = self.candidate.shape[0]
        state = np.zeros((b, h), np.float32)
        states, kept = np.empty((t, b, h), np.float32), []
        for i in range(t):
            x = self.inputs[codes[i]]
            gate = _sigmoid(x[:, : 2 * h] + state @ self.gates)
            reset, update = gate[:, :h], gate[:, h:] * mask[i][:, None]
            fresh = np.tanh(x[:, 2 * h :] + (reset * state) @ self.candidate)
            kept.append((state, gate, update, fresh))
            state = state + update * (fresh - state)
            states[i] = state
        return states, kept

    def backward(self, codes, mask, kept, d_states):
        """Gradients of the three weights, back through time."""
        h = self.candidate.shape[0]
        d_inputs, d_gates, d_candidate = (np.zeros_like(w) for w in (self.inputs, self.gates, self.candidate))
        carry = np.zeros_like(kept[0][0])
        for i in range(len(codes) - 1, -1, -1):
            state, gate, update, fresh = kept[i]
            d = d_states[i] + carry
            d_fresh = d * update * (1 - fresh * fresh)
            d_update = d * (fresh - state) * mask[i][:, None] * gate[:, h:] * (1 - gate[:, h:])
            through = d_fresh @ self.candidate.T
            d_reset = through * state * gate[:, :h] * (1 - gate[:, :h])
            d_gate = np.hstack([d_reset, d_update])
            carry = d * (1 - update) + through * gate[:, :h] + d_gate @ self.gates.T
            d_candidate += (gate[:, :h] * state).T @ d_fresh
            d_gates += state.T @ d_gate
            np.add.at(d_inputs, codes[i], np.hstack([d_gate, d_fresh]))
        return d_inputs, d_gates, d_candidate


@dataclass
class Model:
    languages: list[str]
    forward: Gru
    backward: Gru
    out: np.ndarray
    bias: np.ndarray

    def weights(self) -> list[np.ndarray]:
        return [*vars(self.forward).values(), *vars(self.backward).values(), self.out, self.bias]

    def learn(self, codes: np.ndarray, mask: np.ndarray):
        """Log probabilities at every position (T x B x L), the states there, and what the two networks need to go back."""
        ahead, kept_a = self.forward.forward(codes, mask)
        back, kept_b = self.backward.forward(codes[::-1], mask[::-1])
        both = np.concatenate([ahead, back[::-1]], axis=2)
        score = both @ self.out + self.bias
        score -= score.max(axis=2, keepdims=True)
        return score - np.log(np.exp(score).sum(axis=2, keepdims=True)), both, kept_a, kept_b

    def log_probabilities(self, codes: np.ndarray, mask: np.ndarray) -> np.ndarray:
        """Log probabilities at every position (T x L x B)."""
        h = self.forward.candidate.shape[0]
        out = np.ascontiguousarray(self.out.T)
        with np.errstate(over="ignore"):  # exp of a large sum is infinite, its gate 0
            score = out[:, :h] @ self.forward.read(codes, mask)
            score += out[:, h:] @ self.backward.read(codes[::-1], mask[::-1])[::-1]
        score += self.bias[:, None]
        score -= score.max(axis=1, keepdims=True)
        score -= np.log(np.exp(score).sum(axis=1, keepdims=True))
        return score


def _pad(pieces: list[bytes]):
    """Codes (T x B) and mask of byte strings."""
    lengths = np.array([len(p) for p in pieces])
    codes = np.zeros((len(pieces), lengths.max()), np.uint8)
    mask = np.arange(codes.shape[1])[None, :] < lengths[:, None]
    codes[mask] = np.frombuffer(b"".join(pieces), np.uint8)
    return np.ascontiguousarray(codes.T), np.ascontiguousarray(mask.T.astype(np.float32))


def _boundary(raw: bytes, at: int) -> int:
    """The last place up to ``at`` that does not cut a character."""
    while 0 < at < len(raw) and raw[at] & 0xC0 == 0x80:
        at -= 1
    return at


def segments(raw: bytes) -> Iterator[tuple[bytes, int, int]]:
    """What to read, and from where to where its own bytes lie in it; own bytes follow each other without a gap."""
    start = 0
    while start < len(raw):
        end = len(raw) if len(raw) - start <= SEGMENT else _boundary(raw, start + SEGMENT)
        low, high = _boundary(raw, max(0, start - CONTEXT)), min(len(raw), end + CONTEXT)
        yield raw[low:high], start - low, end - low
        start = end


def train(rows: list[tuple[str, str]], hidden: int = HIDDEN, seed: int = 7) -> Model | None:
    """A model of (text, language) rows; None without rows. Every byte's target is the language of its document.

    A pass reads every document whole, in windows that begin elsewhere each time; languages weigh alike.
    """
    languages = sorted({language for _, language in rows})
    if not languages:
        return None
    number = {language: i for i, language in enumerate(languages)}
    docs = [(raw, number[language]) for text, language in rows if (raw := (text or "").encode("utf-8").strip())]
    rng = np.random.default_rng(seed)
    model = Model(
        languages, Gru.fresh(rng, hidden), Gru.fresh(rng, hidden),
        (rng.standard_normal((2 * hidden, len(languages))) * 0.1).astype(np.float32), np.zeros(len(languages), np.float32),
    )
    if len(languages) == 1 or not docs:
        return model
    moments = [(np.zeros_like(w), np.zeros_like(w)) for w in model.weights()]
    step = 0
    while step < STEPS:
        drawn = []
        for raw, label in docs:
            cuts = [0, *range(int(rng.integers(1, WINDOW + 1)), len(raw), WINDOW), len(raw)]
            cuts = [_boundary(raw, at) for at in cuts]
            drawn += [(raw[low:high], label) for low, high in zip(cuts, cuts[1:], strict=False) if low < high]
        share = np.bincount([label for _, label in drawn], minlength=len(languages))
        weight_of = (len(drawn) / np.maximum(1, share) / len(languages)).astype(np.float32)
        order = rng.permutation(len(drawn))
        for at in range(0, len(order), BATCH):
            some = [drawn[i] for i in order[at : at + BATCH]]
            codes, mask = _pad([piece for piece, _ in some])
            labels = np.array([label for _, label in some])
            target = np.eye(len(languages), dtype=np.float32)[labels]
            logs, both, kept_a, kept_b = model.learn(codes, mask)
            wrong = (np.exp(logs) - target[None]) * (mask * weight_of[labels])[:, :, None] / mask.sum()
            d_both = wrong @ model.out.T
            grads = [
                *model.forward.backward(codes, mask, kept_a, d_both[:, :, :hidden]),
                *model.backward.backward(codes[::-1], mask[::-1], kept_b, d_both[::-1, :, hidden:]),
                np.einsum("tbh,tbl->hl", both, wrong), wrong.sum((0, 1)),
            ]
            step += 1
            for weight, grad, (m, v) in zip(model.weights(), grads, moments, strict=True):
                m += 0.1 * (grad - m)
                v += 0.005 * (grad * grad - v)
                weight -= 0.01 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.995**step)) + 1e-8)
    return model


def evidence(model: Model, texts: list[bytes]) -> np.ndarray:
    """Sums of the log probabilities of all byte positions of each text (texts x languages)."""
    sums = np.zeros((len(texts), len(model.languages)))
    waiting: list[tuple[int, bytes, int, int]] = []

    def label() -> None:
        # Segments of like length share a batch: less padding.
        waiting.sort(key=lambda w: len(w[1]))
        for at in range(0, len(waiting), TOGETHER):
            some = waiting[at : at + TOGETHER]
            codes, mask = _pad([piece for _, piece, _, _ in some])
            place = np.arange(len(codes))[:, None]
            own = (place >= np.array([w[2] for w in some])) & (place < np.array([w[3] for w in some]))
            total = np.einsum("tlb,tb->bl", model.log_probabilities(codes, mask), own.astype(np.float32))
            np.add.at(sums, np.array([w[0] for w in some]), total)
        waiting.clear()

    for i, raw in enumerate(texts):
        for piece, low, high in segments(raw):
            waiting.append((i, piece, low, high))
            if len(waiting) >= 8 * TOGETHER:
                label()
    label()
    return sums


def probabilities(sums: np.ndarray, size: int) -> np.ndarray:
    """Probabilities that pool all positions of a document: evidence grows with the root of their number."""
    score = sums / max(1.0, np.sqrt(size))
    score = np.exp(score - score.max())
    return score / score.sum()


def has_letter(text: str) -> bool:
    """Whether a character of the Unicode category letter occurs; digits of any script and fractions are none."""
    found = _WORDLIKE.search(text)
    return found is not None and (found[0].isalpha() or any(map(str.isalpha, text)))


def _labels(texts: list[str | None], model: Model | None) -> tuple[list[str], list[float]]:
    """Language and score of each text."""
    names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
    known = [i for i, t in enumerate(texts) if model and t and has_letter(t)]
    raws = [texts[i].encode("utf-8") for i in known]
    for i, raw, sums in zip(known, raws, evidence(model, raws) if known else (), strict=True):
        chance = probabilities(sums, len(raw))
        names[i], scores[i] = model.languages[int(chance.argmax())], min(1.0, float(chance.max()))
    return names, scores


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, lang_pred, score per row of ``docs`` (doc_id, text).

    ``und`` with score 0 where the text is null or has no letter, or where nothing was learned.
    Repeated rows are predicted each; other columns are ignored.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            names, scores = _labels(batch["text"].tolist(), model)
            yield pd.DataFrame({"doc_id": batch["doc_id"], "lang_pred": names, "score": scores})

    return docs.select("doc_id", "text").mapInPandas(run, "doc_id long, lang_pred string, score double")


def keep_known(docs: DataFrame, model: Model | None) -> DataFrame:
    """Rows of ``docs`` whose language is known, whatever its score; nothing is shuffled.

    All columns stay as they are, but a null ``lang`` becomes the predicted language. Where nothing was
    learned every row stays.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, _ = _labels(batch.column("text").to_pylist(), model)
            known = pa.array([model is None or n != UNKNOWN for n in names], pa.bool_())
            if "lang" in batch.schema.names:
                at = batch.schema.get_field_index("lang")
                filled = pc.coalesce(batch.column(at), pa.array(names, batch.schema.field(at).type))
                batch = batch.set_column(at, batch.schema.field(at), filled)
            yield batch.filter(known)

    return docs.mapInArrow(run, docs.schema)


def fit(labelled: DataFrame, per_language: int = TRAIN_DOCS) -> Model | None:
    """Train on a bounded sample of ``labelled`` (doc_id, text, lang): about ``per_language`` documents each."""
    known = labelled.where("lang IS NOT NULL AND text IS NOT NULL AND doc_id IS NOT NULL")
    sample = train_rows(known.select("doc_id", "text", "lang"), "doc_id", "lang", per_language)
    rows = sample.select("doc_id", "text", "lang").collect()
    return train([(r.text, r.lang) for r in sorted(rows, key=lambda r: (r.doc_id, r.text))])
