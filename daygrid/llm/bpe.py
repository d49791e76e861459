"""Byte-pair encoding and decoding in numpy: many words share one flat array of symbols.

In every round each unfinished word merges its pair of lowest rank, all occurrences from left to right.
Ranks are found by binary search over sorted pair keys. The vocabulary file says everything else:
NFC, white space to one blank, lower case, the pattern of words, byte symbols, an end-of-word mark.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame

from daygrid.llm.common import forget_older

NO_RANK = np.iinfo(np.int32).max

ENCODED = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def byte_symbols() -> list[str]:
    """The printable stand-in of every byte: itself where Latin-1 prints it, else from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return [chr(b) if b in set(plain) else chr(256 + others.index(b)) for b in range(256)]


class BatchBpe:
    """A vocabulary file of the word kind, ready to encode batches of words."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        vocab = model["vocab"]
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = {i: t for t, i in vocab.items()} | {i: t for t, i in self.specials.items()}
        self.end = model["end_of_word_suffix"]
        symbols = byte_symbols()
        self.inner = np.array([vocab[s] for s in symbols], np.int64)
        self.last = np.array([vocab[s + self.end] for s in symbols], np.int64)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        keys = np.array([(vocab[a] << 32) | vocab[b] for a, b in pairs], np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        # A pair that is listed twice keeps its last rank.
        order = np.lexsort((-np.arange(len(keys)), keys))
        first = np.ones(len(keys), bool)
        first[1:] = keys[order][1:] != keys[order][:-1]
        order = order[first]
        self.keys, self.ranks, self.made = keys[order], order.astype(np.int32), made
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.word = regex.compile(split["pattern"]["Regex"])
        self.special = regex.compile("(" + "|".join(map(regex.escape, self.specials)) + ")")

    def words(self, text: str) -> list[str | int]:
        """Words of a text in order; special tokens come as ids."""
        if text.isascii():
            # NFC leaves ASCII as it is, and ASCII letters in a row are one word.
            if text.isalpha():
                return [text.lower()]
            if "<|" not in text:
                return self.word.findall(text.lower())
        found: list[str | int] = []
        for piece in self.special.split(text) if "<|" in text else [text]:
            if piece in self.specials:
                found.append(self.specials[piece])
            else:
                # Capital sigma is lowered without regard to its place in the word.
                found += self.word.findall(unicodedata.normalize("NFC", piece).replace("Σ", "σ").lower())
        return found

    def ranks_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs of symbols, NO_RANK for those that never merge."""
        key = (left << 32) | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NO_RANK)

    def encode(self, words: list[str]) -> list[np.ndarray]:
        """Ids of each word as arrays; words are not empty."""
        return [np.array(ids, np.int64) for ids in self.id_lists(words)]

    def id_lists(self, words: list[str]) -> list[list[int]]:
        """Ids of each word; words are not empty."""
        raw = [w.encode("utf-8") for w in words]
        lengths = np.array([len(r) for r in raw], np.int64)
        flat = self.inner[np.frombuffer(b"".join(raw), np.uint8)]
        ends = np.cumsum(lengths)
        flat[ends - 1] = self.last[np.frombuffer(b"".join([r[-1:] for r in raw]), np.uint8)]
        owner = np.repeat(np.arange(len(words)), lengths)
        done: list[list[int]] = [None] * len(words)  # type: ignore[list-item]
        # Rank of the pair that starts at each symbol; a round looks up only pairs its merges made.
        rank = np.full(len(flat), NO_RANK, np.int32)
        inside = np.flatnonzero(owner[1:] == owner[:-1])
        rank[inside] = self.ranks_of(flat[inside], flat[inside + 1])
        while len(flat):
            starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            size = np.diff(np.r_[starts, len(flat)])
            lowest = np.minimum.reduceat(rank, starts)
            finished = lowest == NO_RANK
            if finished.any():
                stay = np.repeat(~finished, size)
                ids, upto = flat[~stay].tolist(), np.cumsum(size[finished]).tolist()
                for word, begin, end in zip(owner[starts[finished]].tolist(), [0, *upto], upto, strict=False):
                    done[word] = ids[begin:end]
                flat, owner, rank = flat[stay], owner[stay], rank[stay]
                size, lowest = size[~finished], lowest[~finished]
                if not len(flat):
                    break
            merge = rank == np.repeat(lowest, size)
            # Of overlapping occurrences in a row (a a a), every second one merges.
            where = np.flatnonzero(merge)
            run_start = np.r_[True, np.diff(where) != 1]
            first_of_run = np.maximum.accumulate(np.where(run_start, np.arange(len(where)), 0))
            where = where[(np.arange(len(where)) - first_of_run) % 2 == 0]
            flat[where] = self.made[rank[where]]
            stay = np.ones(len(flat), bool)
            stay[where + 1] = False
            flat, owner, rank = flat[stay], owner[stay], rank[stay]
            merged = where - np.arange(len(where))
            changed = np.concatenate([merged, merged[merged > 0] - 1])
            rank[changed] = NO_RANK
            pairs = changed[changed + 1 < len(flat)]
            pairs = pairs[owner[pairs] == owner[pairs + 1]]
            rank[pairs] = self.ranks_of(flat[pairs], flat[pairs + 1])
        return done

    def decode(self, ids) -> str:
        """Tokens joined by one blank: the file names no decoder."""
        tokens = self.tokens
        return " ".join([tokens[i] for i in ids if i in tokens])


class TextCoder:
    """Encodes and decodes texts blank by blank; parts seen before come from a bounded cache."""

    def __init__(self, path: str):
        self.bpe = BatchBpe(path)
        # Of each part the ids and the tokens, joined by blanks; plain strings spare the garbage collector.
        self.ids: dict[str, str] = {}
        self.tokens: dict[str, str] = {}
        self.id_text = {i: str(i) for i in self.bpe.tokens}

    def fill(self, parts: set[str]) -> None:
        """Encode all new parts of a batch of texts at once, and decode them from their ids."""
        forget_older(self.ids)
        forget_older(self.tokens)
        new = list(parts.difference(self.ids))
        split = [*map(self.bpe.words, new)]
        distinct = list({w for ws in split for w in ws if w.__class__ is str})
        coded = dict(zip(distinct, self.bpe.id_lists(distinct), strict=True)) if distinct else {}
        coded |= {special: [special] for special in self.bpe.specials.values()}
        id_text, token = self.id_text.__getitem__, self.bpe.tokens.__getitem__
        for part, words in zip(new, split, strict=True):
            found = coded[words[0]] if len(words) == 1 else [i for w in words for i in coded[w]]
            self.ids[part] = " ".join(map(id_text, found))
            self.tokens[part] = " ".join(map(token, found))

    def code(self, parts: list[str]) -> tuple[int, str, str]:
        """Number of ids, ids joined by blanks, decoded text of a text split at its blanks."""
        ids = " ".join(filter(None, map(self.ids.__getitem__, parts)))
        return ids.count(" ") + 1 if ids else 0, ids, " ".join(filter(None, map(self.tokens.__getitem__, parts)))


@lru_cache(maxsize=1)
def text_coder(path: str) -> TextCoder:
    """The coder of this Python worker, which the tasks it runs one after another share with its cache."""
    return TextCoder(path)


def encode_texts(docs: DataFrame, path: str, with_texts: bool = False) -> DataFrame:
    """Token count and digests of ids and decoded text per row of ``docs`` (doc_id, text).

    A null or empty text has no ids and decodes to nothing. Repeated rows give repeated results.
    ``with_texts`` adds the ids (array) and the decoded text. Other columns are ignored.
    """
    schema = ENCODED + (", ids array<int>, decoded string" if with_texts else "")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder = text_coder(path)
        digest = lambda s: hashlib.sha256(s.encode("utf-8")).hexdigest()
        for batch in batches:
            texts = [t or "" for t in batch["text"]]
            for at in range(0, len(texts), 250):
                some = texts[at : at + 250]
                parts = [t.split(" ") for t in some]
                coder.fill(set().union(*parts))
                rows = []
                for doc_id, of_text in zip(batch["doc_id"].iloc[at : at + 250], parts, strict=True):
                    n, ids, decoded = coder.code(of_text)
                    row = (doc_id, n, digest(ids), digest(decoded))
                    rows.append((*row, [int(i) for i in ids.split()], decoded) if with_texts else row)
                yield pd.DataFrame(rows, columns=[c.strip().split(" ")[0] for c in schema.split(",")])

    return docs.select("doc_id", "text").mapInPandas(run, schema)
