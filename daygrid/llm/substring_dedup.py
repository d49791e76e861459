"""Substring dedup: passages that a document with a smaller id holds too are cut out.

A window is a run of ``length`` words. What is removed is decided by suffix automata over words: a document is
streamed through the automaton of a shard of reference texts for its matching statistics, the length of the
longest match that ends at each word, and each maximal span of at least ``length`` words is removed.

An automaton over all texts has no bound, and all shards against all documents is quadratic. So shards follow
the text, and documents are routed to them:

1. Of the seeds (runs of ``SEED`` words) in a window the one of smallest hash is sampled: equal windows sample
   equal seeds. A seed that two documents hold belongs to the shard (owner, block): the smallest document that
   holds it and the block of that document's words it lies in.
2. A document sends each shard the spans around its seeds there, wide enough to hold every window that sampled
   them. Equal spans collapse to one, with the smallest document that holds it.
3. A shard streams its spans by ascending document through the automaton of those of smaller documents, then adds
   them to it. A span that repeats as a whole is removed from every document but the first.
4. A shard of more than ``SHARD_WORDS`` words, such as variants of one passage in many documents, would outgrow
   a task. Its spans are split into single windows, which are shards of one text each and meet by their digest.

Hashes of seeds only route. Spans are compared by words (windows of oversized shards by 128-bit digests).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daygrid.llm.common import stage
from daygrid.llm.spread import join_spread

LENGTH = 50
SEED = 16
#: Words of an owner's text that make one shard.
BLOCK = 512
#: Distinct words of text an automaton may take in.
SHARD_WORDS = 400_000
#: Word hashes a worker keeps, and contents a task remembers to have sent.
CACHE, SENT = 400_000, 200_000
BASE = 0x9E3779B97F4A7C15

SHARD = ["owner", "block"]
SPAN = [*SHARD, "span"]


def words_of(text: str | None) -> list[bytes]:
    """Words as UTF-8: split at blank, tab, line feed, vertical tab, form feed and carriage return."""
    return (text or "").encode("utf-8").split()


class SuffixAutomaton:
    """All substrings of the word sequences added so far, one state per set of equal end positions."""

    def __init__(self) -> None:
        self.next: list[dict] = [{}]
        self.link = [-1]
        self.length = [0]

    def _state(self, length: int, link: int, following: dict) -> int:
        self.next.append(following)
        self.link.append(link)
        self.length.append(length)
        return len(self.link) - 1

    def _split(self, state: int, word, target: int) -> int:
        """The state for ``state`` followed by ``word``, apart from longer ones that do not end like it."""
        length = self.length[state] + 1
        if self.length[target] == length:
            return target
        clone = self._state(length, self.link[target], dict(self.next[target]))
        self.link[target] = clone
        while state >= 0 and self.next[state].get(word) == target:
            self.next[state][word] = clone
            state = self.link[state]
        return clone

    def add(self, words: list) -> None:
        last = 0
        for word in words:
            known = self.next[last].get(word)
            if known is not None:
                last = self._split(last, word, known)
                continue
            new = self._state(self.length[last] + 1, 0, {})
            at, last = last, new
            while at >= 0 and word not in self.next[at]:
                self.next[at][word] = new
                at = self.link[at]
            if at >= 0:
                self.link[new] = self._split(at, word, self.next[at][word])

    def spans(self, words: list, least: int) -> list[tuple[int, int]]:
        """Maximal spans of ``words`` in which every run of ``least`` words that is covered occurs in the automaton."""
        following, link, lengths = self.next, self.link, self.length
        state = matched = 0
        out: list[tuple[int, int]] = []
        for i, word in enumerate(words, 1):
            while state and word not in following[state]:
                state = link[state]
                matched = lengths[state]
            target = following[state].get(word)
            if target is not None:
                state, matched = target, matched + 1
                if matched >= least:
                    start = i - matched
                    if out and start <= out[-1][1]:
                        out[-1] = (min(start, out[-1][0]), i)
                    else:
                        out.append((start, i))
        return out


class SeedSampler:
    """Positions and hashes of the sampled seeds of texts."""

    def __init__(self, length: int, seed: int):
        self.length, self.seed = length, seed
        self.cache: dict[bytes, int] = {}
        self.hashes = np.zeros(1024, np.uint64)

    def _hashes(self, words: list[bytes]) -> np.ndarray:
        try:
            at = np.fromiter(map(self.cache.__getitem__, words), np.int64, len(words))
        except KeyError:
            if len(self.cache) > CACHE:
                self.cache.clear()
            new = [w for w in dict.fromkeys(words) if w not in self.cache]
            n = len(self.cache)
            if n + len(new) > len(self.hashes):
                self.hashes = np.concatenate([self.hashes, np.zeros(n + len(new), np.uint64)])
            raw = b"".join([hashlib.blake2b(w, digest_size=8).digest() for w in new])
            self.hashes[n : n + len(new)] = np.frombuffer(raw, "<u8")
            self.cache.update(zip(new, range(n, n + len(new)), strict=True))
            at = np.fromiter(map(self.cache.__getitem__, words), np.int64, len(words))
        return self.hashes[at]

    def __call__(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        if len(words) < self.length:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        seeds = self._seeds(self._hashes(words))
        width = self.length - self.seed + 1
        # A seed is sampled if it is the least of some window: if the largest least of its windows is itself.
        least = _slide(seeds, width, np.minimum)
        padded = np.concatenate([np.zeros(width - 1, np.uint64), least, np.zeros(width - 1, np.uint64)])
        at = np.flatnonzero(_slide(padded, width, np.maximum) == seeds)
        return at, seeds[at]

    def _seeds(self, hashes: np.ndarray) -> np.ndarray:
        """Polynomial hash of every run of ``seed`` words, put together from runs of doubled size; never 0."""
        n = len(hashes) - self.seed + 1
        total, done = np.zeros(n, np.uint64), 0
        block, size, weight, left = hashes, 1, BASE, self.seed
        while left:
            if left & 1:
                total = total * np.uint64(weight) + block[done : done + n]
                done += size
            left >>= 1
            if left:
                block = block[: len(block) - size] * np.uint64(weight) + block[size:]
                size, weight = 2 * size, weight * weight % 2**64
        total = (total ^ (total >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        return np.maximum(total ^ (total >> np.uint64(29)), np.uint64(1))


def _slide(values: np.ndarray, width: int, take) -> np.ndarray:
    """``take`` (minimum or maximum) over every run of ``width`` values, by doubling."""
    n = len(values) - width + 1
    size = 1
    while 2 * size <= width:
        values = take(values[: len(values) - size], values[size:])
        size *= 2
    return take(values[:n], values[width - size : width - size + n])


def _batches(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _sampled(docs: DataFrame, length: int, seed: int) -> DataFrame:
    """(doc_id, text_key, pos, seed) of the sampled seeds of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sample = SeedSampler(length, seed)
        names = ["doc_id", "text_key", "pos", "seed"]
        for batch in batches:
            ids, keys = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(2))
            found = [sample(words_of(t)) for t in batch.column(2).to_pylist()]
            n = [len(at) for at, _ in found]
            pos = np.concatenate([at for at, _ in found] or [np.zeros(0, np.int64)]).astype(np.int32)
            value = np.concatenate([v for _, v in found] or [np.zeros(0, np.uint64)]).view(np.int64)
            arrays = [pa.array(np.repeat(ids, n), pa.int64()), pa.array(np.repeat(keys, n), pa.int64()), pa.array(pos), pa.array(value)]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    known = docs.where("doc_id IS NOT NULL AND text IS NOT NULL")
    return known.mapInArrow(run, "doc_id long, text_key long, pos int, seed long")


_CUT = pa.schema([
    ("kind", pa.int8()), ("doc_id", pa.int64()), ("text_key", pa.int64()), ("n_words", pa.int64()), ("digest", pa.string()),
    ("start", pa.int32()), ("size", pa.int32()), ("owner", pa.int64()), ("block", pa.int32()), ("span", pa.binary()),
    ("words", pa.binary()),
])
#: Kinds of rows the spans' pass writes: a document without spans, the text of one with spans, a span, its words.
DONE, TEXT, PLACE, CONTENT = range(4)


def _spans(docs: DataFrame, length: int, seed: int, with_text: bool) -> DataFrame:
    """One pass over documents with the places of their shared seeds: results, texts, spans and contents by ``kind``."""
    reach = length - seed

    def cut(n: int, places: list[dict]) -> Iterator[tuple[int, int, int, int]]:
        """Spans (owner, block, start, end): around the seeds of each shard, touching ones as one."""
        by_shard: dict[tuple[int, int], list[int]] = {}
        for p in places:
            by_shard.setdefault((p["owner"], p["block"]), []).append(p["pos"])
        for (owner, block), at in by_shard.items():
            at.sort()
            start, end = max(0, at[0] - reach), min(n, at[0] + length)
            for pos in at[1:]:
                if pos - reach > end:
                    yield owner, block, start, end
                    start = pos - reach
                end = min(n, pos + length)
            yield owner, block, start, end

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[tuple] = set()
        for batch in batches:
            out: list[tuple] = []
            for doc_id, key, text, places in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                words = words_of(text)
                if places is None:
                    kept = b" ".join(words)
                    digest = hashlib.sha256(kept).hexdigest()
                    out.append((DONE, doc_id, key, len(words), digest, *[None] * 5, kept if with_text else None))
                    continue
                out.append((TEXT, doc_id, key, len(words), *[None] * 6, b" ".join(words)))
                for owner, block, start, end in cut(len(words), places):
                    raw = b" ".join(words[start:end])
                    span = hashlib.blake2b(raw, digest_size=16).digest()
                    where = (owner, block, span)
                    out.append((PLACE, doc_id, key, None, None, start, end - start, *where, None))
                    if where not in sent:
                        if len(sent) > SENT:
                            sent.clear()
                        sent.add(where)
                        out.append((CONTENT, None, None, None, None, None, end - start, *where, raw))
            yield _batches(out, _CUT)

    schema = ("kind tinyint, doc_id long, text_key long, n_words long, digest string, start int, size int, "
              "owner long, block int, span binary, words binary")
    return docs.mapInArrow(run, schema)


_CUTS = pa.list_(pa.struct([("from", pa.int32()), ("to", pa.int32())]))
_FOUND = pa.schema([("owner", pa.int64()), ("block", pa.int32()), ("span", pa.binary()), ("cuts", _CUTS)])
FOUND = "owner long, block int, span binary, cuts array<struct<`from`: int, `to`: int>>"


def _matched(contents: DataFrame, length: int) -> DataFrame:
    """(owner, block, span, cuts): what the first document of each span shares with smaller ones of the shard, if anything."""

    def resolve(shard: list[tuple]) -> Iterator[tuple]:
        """Spans of one shard by ascending document: each streams through the automaton of smaller documents."""
        if shard[0][3] == shard[-1][3]:
            return
        automaton, waiting = SuffixAutomaton(), []
        names: dict[bytes, int] = {}
        latest = shard[0][3]
        for owner, block, span, first, raw in shard:
            words = [names.setdefault(w, len(names)) for w in raw.split(b" ")]
            if first != latest:
                for earlier in waiting:
                    automaton.add(earlier)
                waiting, latest = [], first
            if len(automaton.link) > 1:
                cuts = [{"from": start, "to": end} for start, end in automaton.spans(words, length)]
                if cuts:
                    yield owner, block, span, cuts
            if first != shard[-1][3]:
                waiting.append(words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard: list[tuple] = []
        for batch in batches:
            out: list[tuple] = []
            for row in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                if shard and row[:2] != shard[-1][:2]:
                    out += resolve(shard)
                    shard = []
                shard.append(row)
            yield _batches(out, _FOUND)
        yield _batches(list(resolve(shard)) if shard else [], _FOUND)

    dealt = contents.select(*SPAN, "first", "words").repartition(*SHARD).sortWithinPartitions(*SHARD, "first", "span")
    return dealt.mapInArrow(run, FOUND)


def _matched_windows(contents: DataFrame, length: int) -> DataFrame:
    """The same for spans of oversized shards: each window is a shard of its own, named by a 128-bit digest."""
    schema = pa.schema([("window", pa.binary()), *list(_FOUND)[:3], ("first", pa.int64()), ("from", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for owner, block, span, first, raw in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                words = raw.split(b" ")
                yield _batches([
                    (hashlib.blake2b(b" ".join(words[i : i + length]), digest_size=16).digest(), owner, block, span, first, i)
                    for i in range(len(words) - length + 1)
                ], schema)

    rows = contents.select(*SPAN, "first", "words").mapInArrow(
        run, "window binary, owner long, block int, span binary, first long, `from` int"
    )
    windows = stage(rows, "substring-windows")
    groups = windows.groupBy("window").agg(F.min("first").alias("smallest"), F.count(F.lit(1)).alias("n"), F.max("first").alias("_last"))
    shared = stage(groups.where("smallest < _last").drop("_last"), "substring-shared")
    later = join_spread(windows, shared, ["window"], "n").where("smallest < first")
    found = F.struct("from", (F.col("from") + length).alias("to"))
    return later.groupBy(*SPAN).agg(F.collect_list(found).alias("cuts"))


def removals(docs: DataFrame, length: int = LENGTH, seed: int = SEED, block: int = BLOCK,
             shard_words: int = SHARD_WORDS, with_text: bool = False) -> tuple[DataFrame, DataFrame]:
    """Rows of ``_spans`` for ``docs`` (doc_id, text_key, text), and what goes: doc_id, text_key, spans (start, end in words)."""
    seeds = stage(_sampled(docs, length, seed), "substring-seeds")
    places = seeds.groupBy("seed").agg(
        F.min("doc_id").alias("owner"), F.max("doc_id").alias("_last"), F.min_by("pos", "doc_id").alias("_pos"),
        F.count(F.lit(1)).alias("n"),
    ).where("owner < _last").select("seed", "owner", F.expr(f"_pos div {block}").cast("int").alias("block"), "n")
    shared = join_spread(seeds, stage(places, "substring-shards"), ["seed"], "n")
    by_doc = shared.groupBy("doc_id", "text_key").agg(F.collect_list(F.struct("owner", "block", "pos")).alias("places"))
    # A null doc_id joins nothing; the text key spreads such rows.
    with_places = docs.join(by_doc, ["doc_id", "text_key"], "left").select("doc_id", "text_key", "text", "places")
    cut = stage(_spans(with_places, length, seed, with_text), "substring-spans")

    found = cut.where(F.col("kind") == PLACE).select("doc_id", "text_key", "start", "size", *SPAN)
    heads = stage(
        found.groupBy(*SPAN).agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n"), F.max("size").alias("size")),
        "substring-heads",
    )
    weights = heads.groupBy(*SHARD).agg(F.sum("size").alias("weight"), F.count(F.lit(1)).alias("shard_spans"))
    weighed = join_spread(heads, stage(weights, "substring-weights"), SHARD, "shard_spans").where("shard_spans > 1")
    bodies = cut.where(F.col("kind") == CONTENT).groupBy(*SPAN).agg(F.first("words").alias("words"))
    contents = stage(bodies.join(weighed.select(*SPAN, "first", "weight"), SPAN), "substring-contents")
    parts = _matched(contents.where(F.col("weight") <= shard_words), length).unionByName(
        _matched_windows(contents.where(F.col("weight") > shard_words), length)
    )

    spans = join_spread(found, heads.select(*SPAN, "first", "n"), SPAN, "n")
    pair = lambda start, end: F.struct(start.alias("start"), end.alias("end"))
    start = F.col("start")
    whole = spans.where("doc_id > first").select(
        "doc_id", "text_key", F.array(pair(start, start + F.col("size"))).alias("spans")
    )
    partly = spans.where("doc_id = first").join(parts, SPAN).select(
        "doc_id", "text_key", F.transform("cuts", lambda c: pair(start + c["from"], start + c["to"])).alias("spans")
    )
    return cut, whole.unionByName(partly)


def without_spans(words: list[bytes], spans: list[tuple[int, int]]) -> list[bytes]:
    """Words outside the spans."""
    kept: list[bytes] = []
    at = 0
    for start, end in sorted(spans):
        if start > at:
            kept += words[at:start]
        at = max(at, end)
    return kept + words[at:]


def dedup(docs: DataFrame, length: int = LENGTH, *, with_text: bool = False, **sizes: int) -> DataFrame:
    """What stays of every row of ``docs`` (doc_id, text) once repeated passages are gone.

    A word goes when a window of ``length`` words that covers it also starts in a document with a smaller doc_id.
    Words end at ASCII white space. Windows are judged on the input. A null or empty text has no words; a text
    shorter than a window stays. Rows that share a doc_id take nothing from each other, and equal rows give equal
    results. A null doc_id is neither smaller nor larger than another, so its row stays as it is. Other columns are
    ignored. Columns: doc_id, n_words, n_removed, kept_sha256 (words joined by one blank) [, kept].
    """
    rows = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_key"), "text")
    cut, gone = removals(rows, length, with_text=with_text, **sizes)
    by_doc = gone.groupBy("doc_id", "text_key").agg(F.flatten(F.collect_list("spans")).alias("spans"))
    texts = cut.where(F.col("kind") == TEXT).select("doc_id", "text_key", "n_words", "words")
    schema = pa.schema([
        ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()), ("kept", pa.string())
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc_id, n, raw, spans in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                kept = without_spans(raw.split(), [(s["start"], s["end"]) for s in spans or ()])
                rest = b" ".join(kept)
                out.append((doc_id, n, n - len(kept), hashlib.sha256(rest).hexdigest(), rest.decode("utf-8") if with_text else None))
            yield _batches(out, schema)

    touched = texts.join(by_doc, ["doc_id", "text_key"], "left").select("doc_id", "n_words", "words", "spans").mapInArrow(
        run, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string"
    )
    same = cut.where(F.col("kind") == DONE).select(
        "doc_id", "n_words", F.lit(0).cast("long").alias("n_removed"), F.col("digest").alias("kept_sha256"),
        F.col("words").cast("string").alias("kept"),
    )
    rows = same.unionByName(touched)
    return rows if with_text else rows.drop("kept")
