"""Set-similarity join on word shingles: T-occurrence search with short lists counted, long ones probed (after DivideSkip).

1. Every text becomes the set of its word shingles (64-bit hashes). Equal sets are one class from here on.
2. A set with more than a quarter of shingles that no other set holds is linked to nothing. Such shingles are
   counted twice: in a fixed part of the hash space over all sets, then wholly over the sets that remain.
   Two linked sets of at most n shingles share one of the n - ceil(0.75 n) + 1 rarest of either, by the number of remaining
   sets that hold them. These are sent, packed, to buckets of shingles; classes of like size that meet become candidate components.
3. Each candidate component is searched in one task, or in tasks for pairs of blocks if it is large. A list that most
   sets are on is turned round, so it names the others: sets that differ little have short lists only.
   A search counts the short inverted lists of a set in an array (no heap merge) and probes those that are long for its candidates
   by binary search. Every link between different sets is found and counted for both of its ends.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daygrid.llm.common import known_id, rows_of, stage, text_mark
from daygrid.llm.components import components, star_edges

WORDS = 5
#: Similarity as a fraction: 100 * intersection >= 75 * union.
NEAR, OF = 75, 100
#: Bytes of the longest word that is hashed by table.
LONG_WORD = 64
#: Shingles of a bucket, and shingles a task packs at once.
BUCKET_ENTRIES, COUNT_ENTRIES, PACK_ENTRIES = 400_000, 800_000, 500_000
#: Characters a word and its blank take about: decides the number of buckets only.
WORD_CHARS = 6
#: Levels of rarity for each doubling of the number of sets that hold a shingle.
LEVELS = 8
#: Part of the hash space in which shingles of one set only are first counted.
FIRST_PART = 0.4
BLOCK = 4_096
#: Sets of small components that are searched in one call, and the least number of such calls.
LOT, LOTS = 1_000, 512
#: A list is probed, not merged, if it is so many times longer than the candidates; entries read at once.
PROBE, SLICE = 16, 2_000_000
_ODD = np.array([2 * int.from_bytes(hashlib.sha256(b"%d" % i).digest()[:7], "big") + 1 for i in range(WORDS + 64)], np.uint64)
#: Bytes that belong to words, and a random number for each byte at each place of a word.
_OF_WORD = ~np.isin(np.arange(256), list(b" \t\n\v\f\r"))
_AT_PLACE = np.frombuffer(hashlib.shake_256(b"words").digest(LONG_WORD * 256 * 8), "<u8")


class Shingler:
    """Sorted distinct shingle hashes of texts.

    A word of at most ``LONG_WORD`` bytes is the sum of random numbers for its bytes at their places, a longer one is digested.
    """

    def __init__(self, words: int = WORDS):
        self.words = words

    def _word_hashes(self, text: str | None) -> np.ndarray:
        # Splits at blank, tab, line feed, vertical tab, form feed and carriage return; lowers A-Z only.
        raw = np.frombuffer((text or "").encode("utf-8").lower(), np.uint8)
        inside = _OF_WORD[raw]
        letters = raw[inside]
        if not len(letters):
            return np.zeros(0, np.uint64)
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        first = np.flatnonzero(begins[inside])
        lengths = np.diff(np.append(first, len(letters)))
        place = np.arange(len(letters)) - np.repeat(first, lengths)
        long = np.flatnonzero(lengths > LONG_WORD)
        if len(long):
            np.minimum(place, LONG_WORD - 1, out=place)
        hashes = np.add.reduceat(_AT_PLACE[place * 256 + letters], first)
        for i in long:
            word = letters[first[i] : first[i] + lengths[i]].tobytes()
            hashes[i] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        return _mix(hashes)

    def __call__(self, text: str | None) -> np.ndarray:
        hashes, n = self._word_hashes(text), self.words
        if not len(hashes):
            return hashes
        if len(hashes) < n:
            return _mix((hashes * _ODD[: len(hashes)]).sum(keepdims=True) + np.uint64(len(hashes)))
        total = hashes[: len(hashes) - n + 1] * _ODD[0]
        for i in range(1, n):
            total += hashes[i : len(hashes) - n + 1 + i] * _ODD[i]
        total = np.sort(_mix(total))
        new = np.ones(len(total), bool)
        np.not_equal(total[1:], total[:-1], out=new[1:])
        return total[new]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


#: Order of a group's rows by doc_id, those without one last.
_FIRST = "struct(doc_id IS NULL AS nameless, doc_id, mark)"


def required(size, near: int = NEAR, of: int = OF):
    """Smallest overlap a set of ``size`` needs with any set it is linked to."""
    return -(-near * size // of)


def _class_of(shingles: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(shingles.tobytes(), digest_size=8).digest(), "little", signed=True)


def _size_step(sizes: np.ndarray) -> np.ndarray:
    """Linked sets lie in the same step or in neighbouring ones."""
    return np.floor(np.log(np.maximum(sizes, 1)) / np.log(OF / NEAR) + 1e-9).astype(np.int64)


def _dealt(number: np.ndarray, parts: int) -> Iterator[tuple[int, np.ndarray]]:
    """(part, positions of the numbers that are in it) of the parts that have some; positions ascend."""
    part = (number % np.uint64(parts)).astype(np.uint16 if parts <= 2**16 else np.int64)
    order = np.argsort(part, kind="stable")
    ends = np.cumsum(np.bincount(part, minlength=parts))
    for i in np.unique(part):
        yield int(i), order[ends[i - 1] if i else 0 : ends[i]]


def _column(rows: pd.DataFrame, column: str, kind) -> np.ndarray:
    return np.frombuffer(b"".join(rows[column]), kind)


def _once(token: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entries sorted by token and owner. One class may be in several tasks: its copies of a shingle are one."""
    order = np.lexsort((owner, token))
    token, owner = token[order], owner[order]
    new = np.r_[True, (token[1:] != token[:-1]) | (owner[1:] != owner[:-1])]
    return token[new], owner[new]


def _survey(docs: DataFrame, buckets: int) -> DataFrame:
    """A row (doc_id, n, name, mark) per row of ``docs``, and packed rows (bucket, tokens, owners) of ``FIRST_PART``.

    Shingles travel as 32 bits of their hash within a bucket; a clash only makes a single one count as shared.
    """
    limit = np.uint64(int(FIRST_PART * 2**64))

    def pack(tokens: list[np.ndarray], owners: list[int]) -> pd.DataFrame:
        token = np.concatenate(tokens)
        owner = np.repeat(np.array(owners, np.int64), [len(t) for t in tokens])
        piece = ((token // np.uint64(buckets)) & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        rows = [(i, piece[at].tobytes(), owner[at].tobytes()) for i, at in _dealt(token, buckets)]
        out = pd.DataFrame(rows, columns=["bucket", "tokens", "owners"])
        none = pd.array([None] * len(out), "Int64")
        return out.assign(doc_id=none, n=none, name=none, mark=None)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingle, seen = Shingler(), set()
        tokens, owners, held = [], [], 0
        for batch in batches:
            sizes, names = [], []
            for text in batch["text"]:
                found = shingle(text)
                name = _class_of(found) if len(found) else None
                sizes.append(len(found))
                names.append(name)
                if name is not None and name not in seen:
                    seen.add(name)
                    tokens.append(found[: np.searchsorted(found, limit, side="right")])
                    owners.append(name)
                    held += len(tokens[-1])
            # Nullable integers from the start: a detour over floating point would change 64-bit names.
            yield pd.DataFrame({
                "doc_id": pd.array([None if pd.isna(v) else int(v) for v in batch["doc_id"]], "Int64"),
                "n": pd.array(sizes, "Int64"), "name": pd.array(names, "Int64"), "mark": batch["mark"].to_numpy(),
                "bucket": pd.array([None] * len(batch), "Int32"), "tokens": None, "owners": None,
            })
            if held >= PACK_ENTRIES:
                yield pack(tokens, owners)
                tokens, owners, held = [], [], 0
        if tokens:
            yield pack(tokens, owners)

    columns = "doc_id long, n long, name long, mark binary, bucket int, tokens binary, owners binary"
    return docs.mapInPandas(run, columns)


def _single_counts(packed: DataFrame, parts: int) -> DataFrame:
    """(name, singles): how many of the packed shingles a class holds alone."""

    def count(rows: pd.DataFrame) -> pd.DataFrame:
        token, owner = _once(_column(rows, "tokens", np.uint32), _column(rows, "owners", np.int64))
        differs = np.r_[True, token[1:] != token[:-1], True]
        name, n = np.unique(owner[differs[:-1] & differs[1:]], return_counts=True)
        rows = [(i, name[at].tobytes(), n[at].astype(np.int64).tobytes()) for i, at in _dealt(name.view(np.uint64), parts)]
        return pd.DataFrame(rows, columns=["part", "names", "counts"])

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        name, at = np.unique(_column(rows, "names", np.int64), return_inverse=True)
        total = np.zeros(len(name), np.int64)
        np.add.at(total, at, _column(rows, "counts", np.int64))
        return pd.DataFrame({"name": name, "singles": total})

    found = packed.groupBy("bucket").applyInPandas(count, "part int, names binary, counts binary")
    return found.groupBy("part").applyInPandas(add, "name long, singles long")


def _prefixes(rows: DataFrame, parts: int, buckets: int) -> DataFrame:
    """Edges and packed (shingle, class, size step) entries by bucket: the rarest shingles of the classes of ``rows`` (text).

    How many classes hold a shingle is counted wholly, so the order of rarity is one for all. Shingles that one class holds
    alone come first; nothing meets there, and a class with too many of them is linked to nothing and has no entry.
    Shingles of several classes travel on as 32 bits of their hash and their part; a clash only makes more classes meet.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingle, tokens, held = Shingler(), {}, 0

        def pack() -> pd.DataFrame:
            names, token = np.array(list(tokens), np.int64), np.concatenate(list(tokens.values()))
            number = np.repeat(np.arange(len(names)), [len(t) for t in tokens.values()])
            rows = []
            for i, at in _dealt(token, parts):
                mine = number[at]
                first = np.flatnonzero(np.r_[True, mine[1:] != mine[:-1]])
                lengths = np.diff(np.r_[first, len(mine)]).astype(np.int32)
                rows.append((i, token[at].tobytes(), names[mine[first]].tobytes(), lengths.tobytes()))
            return pd.DataFrame(rows, columns=["bucket", "tokens", "names", "lengths"])

        for batch in batches:
            for text in batch["text"]:
                found = shingle(text)
                if len(found):
                    held += len(found)
                    tokens[_class_of(found)] = found
            if held >= PACK_ENTRIES:
                yield pack()
                tokens, held = {}, 0
        if tokens:
            yield pack()

    def count(rows: pd.DataFrame) -> pd.DataFrame:
        token, owner = _once(
            _column(rows, "tokens", np.uint64), np.repeat(_column(rows, "names", np.int64), _column(rows, "lengths", np.int32))
        )
        _, at, df = np.unique(token, return_inverse=True, return_counts=True)
        level = np.floor(LEVELS * np.log2(df)).astype(np.uint8)[at]
        order = np.argsort(owner, kind="stable")
        token, owner, level = token[order], owner[order], level[order]
        first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        out, shared = [], level > 0
        # Of shingles of one class only their number travels on.
        lengths = np.add.reduceat(shared, first, dtype=np.int64)
        singles = np.diff(np.r_[first, len(owner)]) - lengths
        names, ends = owner[first], np.cumsum(lengths)
        piece, level = ((token[shared] // np.uint64(parts)) & np.uint64(0xFFFFFFFF)).astype(np.uint32), level[shared]
        for i, at in _dealt(names.view(np.uint64), parts):
            mine = _ranges(ends[at] - lengths[at], lengths[at])
            packed = names[at], lengths[at].astype(np.int32), singles[at].astype(np.int32), piece[mine], level[mine]
            out.append((i, int(rows["bucket"].iloc[0]), *[x.tobytes() for x in packed]))
        return pd.DataFrame(out, columns=["part", "bucket", "names", "lengths", "singles", "tokens", "levels"])

    def choose(rows: pd.DataFrame) -> pd.DataFrame:
        kinds = {"names": np.int64, "lengths": np.int32, "singles": np.int32, "tokens": np.uint32, "levels": np.uint8}
        of = {column: _column(rows, column, kind) for column, kind in kinds.items()}
        bucket = np.repeat(rows["bucket"].to_numpy(np.uint64), [len(levels) for levels in rows["levels"]])
        token = (bucket << np.uint64(32)) | of["tokens"]
        names, at = np.unique(of["names"], return_inverse=True)
        size, single = np.zeros(len(names), np.int64), np.zeros(len(names), np.int64)
        np.add.at(size, at, of["lengths"])
        np.add.at(single, at, of["singles"])
        owner = np.repeat(at, of["lengths"])
        order = np.lexsort((token, of["levels"], owner))
        n = size + single
        kept = np.clip(n - required(n) + 1 - single, 0, size)
        mine = order[_ranges(np.cumsum(size) - size, kept)]
        return _rows(token[mine], np.repeat(names, kept), np.repeat(_size_step(n), kept), buckets)

    packed = rows.select("text").mapInPandas(run, "bucket int, tokens binary, names binary, lengths binary")
    counted = packed.groupBy("bucket").applyInPandas(
        count, "part int, bucket int, names binary, lengths binary, singles binary, tokens binary, levels binary"
    )
    return counted.groupBy("part").applyInPandas(choose, "bucket int, tokens binary, owners binary, steps binary")


def _ranges(begin: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The positions of ranges, one behind the other."""
    return np.arange(lengths.sum()) + np.repeat(begin - (np.cumsum(lengths) - lengths), lengths)


def _joined(token: np.ndarray, owner: np.ndarray, step: np.ndarray):
    """Sorted entries, one per (shingle, size step), and the edges that hold the others."""
    order = np.lexsort((step, token))
    token, owner, step = token[order], owner[order], step[order]
    same = (token[1:] == token[:-1]) & (step[1:] == step[:-1])
    edges = (owner[:-1][same], owner[1:][same])
    first = np.r_[True, ~same][: len(token)]
    return token[first], owner[first], step[first], edges


def _rows(token, owner, step, buckets: int) -> pd.DataFrame:
    token, owner, step, (a, b) = _joined(token, owner, step)
    rows = [(i, token[at].tobytes(), owner[at].tobytes(), step[at].astype(np.int16).tobytes()) for i, at in _dealt(token, buckets)]
    if len(a):
        a, b = star_edges(a, b)
        rows += [(i, None, a[at].tobytes(), b[at].tobytes()) for i, at in _dealt(a.view(np.uint64), buckets)]
    return pd.DataFrame(rows, columns=["bucket", "tokens", "owners", "steps"])


def _meet(rows: pd.DataFrame) -> pd.DataFrame:
    """Edges between the classes that meet in one bucket."""
    is_edge = rows["tokens"].isna()
    join = lambda column, kind, some: np.frombuffer(b"".join(some[column]), kind)
    ones, twos = [join("owners", np.int64, rows[is_edge])], [join("steps", np.int64, rows[is_edge])]
    entries = rows[~is_edge]
    if len(entries):
        token, owner, step, (a, b) = _joined(
            join("tokens", np.uint64, entries), join("owners", np.int64, entries), join("steps", np.int16, entries)
        )
        near = (token[1:] == token[:-1]) & (step[1:] - step[:-1] == 1)
        ones += [a, owner[:-1][near]]
        twos += [b, owner[1:][near]]
    a, b = star_edges(np.concatenate(ones), np.concatenate(twos))
    return pd.DataFrame({"a": a, "b": b})


def _tally(tokens: np.ndarray, begin: np.ndarray, listed: np.ndarray, low: int, high: int) -> np.ndarray:
    """How many of the lists of ``tokens`` hold each set from ``low`` up to ``high``; lists are read a slice at a time."""
    counts = np.zeros(high - low, np.int64)
    lengths = begin[tokens + 1] - begin[tokens]
    ends = np.cumsum(lengths)
    at = 0
    while at < len(tokens):
        stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + SLICE, side="right")))
        some, n = tokens[at:stop], lengths[at:stop]
        owner = listed[_ranges(begin[some], n)]
        counts += np.bincount(owner[(owner >= low) & (owner < high)] - low, minlength=high - low)
        at = stop
    return counts


def _lists(keys: np.ndarray, df: np.ndarray, sets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Inverted lists as sorted keys (shingle * sets + set), one behind the other, their lengths, and which are turned round.

    A list that more than half of the sets are on is turned round: it names the sets that are not on it. Sorted keys
    can be probed by binary search.
    """
    keys = np.sort(keys)
    turned = 2 * df > sets
    begin = np.r_[0, np.cumsum(df)]
    kept = [keys[~turned[keys // sets]]]
    of_turned = np.flatnonzero(turned)
    step = max(1, SLICE // sets)
    for at in range(0, len(of_turned), step):
        some = of_turned[at : at + step]
        off = np.ones((len(some), sets), bool)
        on = keys[_ranges(begin[some], df[some])] % sets
        off[np.repeat(np.arange(len(some)), df[some]), on] = False
        row, named = np.nonzero(off)
        kept.append(some[row] * sets + named)
    return np.sort(np.concatenate(kept)), np.where(turned, sets - df, df), turned


def divide_skip(
    sets: list[np.ndarray], names: np.ndarray, copies: np.ndarray | None = None, block: np.ndarray | None = None,
    whole: tuple[int, ...] = (), every: bool = True,
) -> tuple[list[tuple[int, int]], np.ndarray]:
    """Pairs that connect what links connect, and the number of documents each set is linked to.

    The pairs of names are one fewer than a component has sets. A link counts the ``copies`` of its other
    end; a link inside a block counts only where the block is in ``whole``, as several tasks may see it.
    Without ``every``, sets that are connected already are not compared again and numbers are incomplete.
    """
    order = np.argsort([len(s) for s in sets], kind="stable")
    sets = [sets[i] for i in order]
    copies = np.ones(len(sets), np.int64) if copies is None else copies[order]
    block = np.zeros(len(sets), np.int64) if block is None else block[order]
    inside = np.isin(block, whole)
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, token, df = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    keys, df, turned = _lists(token * len(sets) + owner, df, len(sets))
    begin = np.r_[0, np.cumsum(df)]
    listed = keys % len(sets)
    order_of = np.argsort(listed, kind="stable")
    lists = (keys // len(sets))[order_of]
    bounds = np.r_[0, np.cumsum(np.bincount(listed, minlength=len(sets)))]
    # How many of the turned lists name a set, so how many of their shingles it does not hold.
    absent = np.bincount(listed[turned[keys // len(sets)]], minlength=len(sets))
    label = np.arange(len(sets))
    degree = np.zeros(len(sets), np.int64)
    for r in range(1, len(sets)):
        n = int(sizes[r])
        need = required(n)
        low = int(np.searchsorted(sizes, need))
        if low >= r:
            continue
        mine = lists[bounds[r] : bounds[r + 1]]
        mine = mine[np.argsort(df[mine], kind="stable")]
        # Two sets share the shingles of turned lists, but those either does not hold; where neither does, both are named.
        given = turned.sum() - absent[r] - absent[low:r]
        # A partner is on so many of the lists at least: one fewer may be left out.
        left = min(max(need - int(given.max()) - 1, 0), len(mine))
        short, others = mine[: len(mine) - left], mine[len(mine) - left :]
        short = short[df[short] > 1]
        if left and not len(short):
            continue
        counts = given + _tally(short, begin, listed, low, r)
        found = np.flatnonzero((OF + NEAR) * (counts + left) >= NEAR * (n + sizes[low:r]))
        if not every:
            found = found[label[low + found] != label[r]]
        if not len(found):
            continue
        # Lists that are long for the candidates at hand are probed, the others merged too.
        long = others[df[others] > PROBE * len(found)]
        merged = others[(df[others] > 1) & (df[others] <= PROBE * len(found))]
        overlap = counts[found] + _tally(merged, begin, listed, low, r)[found]
        step = max(1, SLICE // max(1, len(found)))
        for at in range(0, len(long), step):
            probe = long[at : at + step, None] * len(sets) + (low + found)[None, :]
            overlap += (keys[np.minimum(np.searchsorted(keys, probe), len(keys) - 1)] == probe).sum(0)
        linked = low + found
        linked = linked[OF * overlap >= NEAR * (n + sizes[linked] - overlap)]
        if not len(linked):
            continue
        counted = linked[inside[r] | (block[linked] != block[r])]
        degree[r] += copies[counted].sum()
        degree[counted] += copies[r]
        met = np.unique(label[linked])
        label[r] = met[0]
        if len(met) > 1:
            label[np.isin(label, met[1:])] = met[0]
    of_input = np.zeros(len(sets), np.int64)
    of_input[order] = degree
    # A star around the first set of each component.
    links = [(int(names[order[label[i]]]), int(names[order[i]])) for i in np.flatnonzero(label != np.arange(len(sets)))]
    return links, of_input


def _grouped(docs: DataFrame, count_links: bool) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, mark of the text, n_shingles, its group, the smallest doc_id there, links."""
    docs = docs.select("doc_id", "text", text_mark(F.col("text")).alias("mark"))

    buckets = max(8, int(FIRST_PART * (docs.agg(F.sum(F.length("text"))).first()[0] or 0) // (WORD_CHARS * COUNT_ENTRIES)))
    seen = stage(_survey(docs, buckets), "ngram-classes")
    members = seen.where("bucket IS NULL").select("doc_id", "n", "name", "mark")
    classes = members.where("name IS NOT NULL").groupBy("name").agg(
        F.min(F.expr(_FIRST)).alias("first"), F.max("n").alias("n"), F.count("*").alias("copies")
    ).select("name", "first.doc_id", "first.mark", "n", "copies").withColumnsRenamed({"doc_id": "first_id", "mark": "first_mark"})
    singles = _single_counts(seen.where("bucket IS NOT NULL").select("bucket", "tokens", "owners"), buckets)
    able = classes.join(singles, "name", "left").where(
        F.coalesce("singles", F.lit(0)) <= F.floor(F.col("n") * (OF - NEAR) / OF)
    )
    # Rows without a doc_id are told apart by their texts, one row a text; there are none in a sound table.
    nameless = docs.where("doc_id IS NULL").dropDuplicates(["mark"])
    one_text = F.col("mark") == F.col("first_mark")
    texts = docs.join(able, (F.col("doc_id") == F.col("first_id")) & one_text).unionByName(
        nameless.join(able.where("first_id IS NULL"), one_text)
    )
    rest = stage(texts.select("first_id", "name", "n", "copies", "text"), "ngram-rest")
    total, entries = rest.agg(F.sum("n"), F.sum(F.col("n") - F.ceil(F.col("n") * NEAR / OF) + 1)).first()
    parts, buckets = max(8, int((total or 0) // COUNT_ENTRIES)), max(8, int((entries or 0) // BUCKET_ENTRIES))
    met = _prefixes(rest, parts, buckets).groupBy("bucket").applyInPandas(_meet, "a long, b long")
    candidates = stage(components(stage(met, "ngram-candidates")), "ngram-components")

    blocks = candidates.groupBy("component").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    named = candidates.join(blocks, "component").join(rest, candidates.id == rest.name).select(
        "name", "component", "blocks", "copies", "text", F.pmod(F.hash("name"), F.col("blocks")).alias("block")
    )
    # A large component is searched for every pair of its blocks.
    pairs = F.when(F.col("blocks") == 1, F.array(F.lit("0"))).otherwise(
        F.transform(
            F.filter(F.sequence(F.lit(0), F.col("blocks") - 1), lambda other: other != F.col("block")),
            lambda other: F.concat_ws(":", F.least("block", other), F.greatest("block", other)),
        )
    )
    spread = named.select("component", "name", "copies", "block", "blocks", "text", F.explode(pairs).alias("task"))
    # Small components share a task's call; a pair of blocks has its own.
    lots = max(LOTS, candidates.count() // LOT)
    lot = F.when(F.col("blocks") == 1, F.pmod(F.hash("component"), F.lit(lots)).cast("string")).otherwise(F.concat_ws(":", "component", "task"))

    def search(group: pd.DataFrame) -> pd.DataFrame:
        shingle, rows = Shingler(), []
        names, of, copies, block = (group[c].to_numpy() for c in ("name", "component", "copies", "block"))
        sets = [shingle(t) for t in group["text"]]
        order = np.lexsort((names, of))
        order = order[[len(sets[i]) > 0 and _class_of(sets[i]) == names[i] for i in order]]
        # Rows that repeat doc_id and text are there more than once; one of them counts.
        again = (names[order][1:] == names[order][:-1]) & (of[order][1:] == of[order][:-1])
        # A block meets every other. Its own links count where it meets the next one; the last block's where the one before does.
        ends = [int(e) for e in group["task"].iloc[0].split(":")]
        low, high, last = ends[0], ends[-1], int(group["blocks"].iloc[0]) - 1
        whole = () if high - low > 1 else (low, high) if high == last else (low,)
        order = order[np.r_[True, ~again][: len(order)]]
        for at in np.split(order, np.flatnonzero(of[order][1:] != of[order][:-1]) + 1):
            if len(at) < 2:
                continue
            links, degree = divide_skip([sets[i] for i in at], names[at], copies[at], block[at], whole, count_links)
            rows += [(x, y, None) for x, y in links]
            if count_links:
                rows += [(int(name), None, int(n)) for name, n in zip(names[at], degree, strict=True) if n]
        return pd.DataFrame({c: pd.array([r[i] for r in rows], "Int64") for i, c in enumerate(("a", "b", "n"))})

    found = stage(spread.groupBy(lot.alias("lot")).applyInPandas(search, "a long, b long, n long"), "ngram-links")
    links = found.where("b IS NOT NULL").select("a", "b")
    groups = components(links)
    ids = groups.join(classes, groups.id == classes.name).select("name", "component", "first_id")
    least = ids.groupBy("component").agg(F.min("first_id").alias("least_id"))
    of_class = ids.join(least, "component").select(F.col("name").alias("class"), "component", "least_id")
    of_links = found.where("n IS NOT NULL").groupBy("a").agg(F.sum("n").alias("others"))
    own = classes.join(of_links, classes.name == of_links.a, "left").select(
        F.col("name").alias("class"), "first_id", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("linked")
    ).join(of_class, "class", "left").select(
        "class", F.coalesce("component", "class").alias("group"), F.coalesce("least_id", "first_id").alias("least_id"), "linked"
    )
    return members.join(own, members.name == own["class"], "left").drop("name", "class")


def near_groups(docs: DataFrame, count_links: bool = True) -> DataFrame:
    """doc_id, n_shingles, component_id, n_links per row of ``docs`` (doc_id, text).

    Words are runs without white space, A-Z lowered; a set holds the distinct five-word shingles, or the
    whole sequence of a shorter text. Sets link when 100 * intersection >= 75 * union. component_id is the
    smallest doc_id that links reach; n_links is the number of other rows linked to the row, copies included.
    A null or empty text has no shingle, only itself and no link. Repeated rows are returned each and link
    with one another, and so do rows without a doc_id; a null doc_id names no group. Other columns are ignored. Without
    ``count_links`` that column is left out, and sets known to be connected are not compared again.
    """
    out = _grouped(docs, count_links).select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("least_id", "doc_id").alias("component_id"),
        F.coalesce("linked", F.lit(0)).cast("long").alias("n_links"),
    )
    return out if count_links else out.drop("n_links")


def keep_first(docs: DataFrame) -> DataFrame:
    """One row of each group of near copies of ``docs``, the one with the smallest doc_id; all columns.

    A row without a doc_id stays where no row with one is in its group. Rows that share a doc_id are judged text by
    text. A text without words is in no group and stays; of rows that repeat doc_id and text one stays (``rows_of``).
    """
    rows = stage(_grouped(docs, count_links=False).select("doc_id", "mark", "group"), "ngram-members")
    of_groups = rows.where("group IS NOT NULL").groupBy("group").agg(F.min(F.expr(_FIRST)).alias("first")).select("first.doc_id", "first.mark")
    kept = of_groups.unionByName(rows.where("group IS NULL").select("doc_id", "mark"))
    kept = kept.select(known_id(F.col("doc_id")).alias("kept_id"), F.col("mark").alias("kept_mark")).distinct()
    return rows_of(docs, kept, text_mark(F.col("text")))
