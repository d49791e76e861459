"""Exact dedup over a cuckoo-filter index.

The filter keeps a 16-bit fingerprint per live digest in one of two buckets of four slots, and beside
each slot the number of the stored entry. A lookup that hits a fingerprint is verified against the
stored digest, so results are exact. An insertion that finds no slot doubles the table from the
stored digests. Digests that die are deleted and their entries reused.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daygrid.llm.common import known_id, rows_of

SLOTS = 4
MAX_KICKS = 200
#: Digests a map task holds before it hands its sums on.
LOCAL_DIGESTS = 200_000
_MIX = np.uint64(0x9E3779B97F4A7C15)


class CuckooIndex:
    """Live digests (32 bytes each) with a count and the largest id of each."""

    def __init__(self, buckets: int = 1024):
        self.digests = np.zeros((1024, 4), np.uint64)
        self.count = np.zeros(1024, np.int64)
        self.largest = np.zeros(1024, np.int64)
        self.used, self.free = 0, []
        self._clear(buckets)

    def __len__(self) -> int:
        return self.used - len(self.free)

    def _clear(self, buckets: int) -> None:
        self.mask = np.uint64(buckets - 1)
        self.prints = np.zeros((buckets, SLOTS), np.uint16)
        self.entry = np.full((buckets, SLOTS), -1, np.int32)

    def _places(self, digests: np.ndarray):
        """Fingerprint (never 0) and both buckets of each digest."""
        prints = (digests[:, 0] >> np.uint64(48)).astype(np.uint16)
        prints[prints == 0] = 1
        one = digests[:, 1] & self.mask
        return prints, one.astype(np.int64), self._other(one, prints)

    def _other(self, bucket, prints):
        return ((bucket.astype(np.uint64) ^ (prints.astype(np.uint64) * _MIX >> np.uint64(20))) & self.mask).astype(np.int64)

    def find(self, digests: np.ndarray) -> np.ndarray:
        """Entry number of each digest, -1 where it is not live. Fingerprint hits are verified."""
        prints, one, two = self._places(digests)
        found = np.full(len(digests), -1, np.int64)
        for bucket in (one, two):
            for slot in range(SLOTS):
                maybe = np.flatnonzero((self.prints[bucket, slot] == prints) & (found < 0))
                entry = self.entry[bucket[maybe], slot]
                same = (self.digests[entry] == digests[maybe]).all(axis=1)
                found[maybe[same]] = entry[same]
        return found

    def insert(self, digests: np.ndarray, count: np.ndarray, largest: np.ndarray) -> None:
        """Add counts; within one call every digest occurs once."""
        at = self.find(digests)
        old, new = at >= 0, np.flatnonzero(at < 0)
        self.count[at[old]] += count[old]
        self.largest[at[old]] = np.maximum(self.largest[at[old]], largest[old])
        if not len(new):
            return
        entries = self._new_entries(len(new))
        self.digests[entries], self.count[entries], self.largest[entries] = digests[new], count[new], largest[new]
        while len(self) > 0.85 * self.prints.size or not self._place(entries):
            self._clear(2 * len(self.prints))
            entries = self.live()

    def delete(self, digests: np.ndarray) -> None:
        """Remove live digests; others are ignored."""
        prints, one, two = self._places(digests)
        at = self.find(digests)
        for i in np.flatnonzero(at >= 0):
            for bucket in (one[i], two[i]):
                slot = np.flatnonzero((self.entry[bucket] == at[i]) & (self.prints[bucket] == prints[i]))
                if len(slot):
                    self.prints[bucket, slot[0]], self.entry[bucket, slot[0]] = 0, -1
                    self.free.append(int(at[i]))
                    break

    def live(self) -> np.ndarray:
        """Numbers of all stored entries."""
        alive = np.ones(self.used, bool)
        alive[self.free] = False
        return np.flatnonzero(alive)

    def _new_entries(self, n: int) -> np.ndarray:
        reused = [self.free.pop() for _ in range(min(n, len(self.free)))]
        more = n - len(reused)
        room = len(self.count)
        if self.used + more > room:
            grown = max(2 * room, self.used + more)
            for name in ("digests", "count", "largest"):
                old = getattr(self, name)
                fresh = np.zeros((grown, *old.shape[1:]), old.dtype)
                fresh[: len(old)] = old
                setattr(self, name, fresh)
        fresh_ids = np.arange(self.used, self.used + more)
        self.used += more
        return np.r_[np.array(reused, np.int64), fresh_ids].astype(np.int64)

    def _place(self, entries: np.ndarray) -> bool:
        """Put entries into free slots, then move others out of the way. False: the table is too small."""
        prints, one, two = self._places(self.digests[entries])
        waiting = np.arange(len(entries))
        for bucket in (one, two):
            for slot in range(SLOTS):
                able = waiting[self.prints[bucket[waiting], slot] == 0]
                _, first = np.unique(bucket[able], return_index=True)
                able = able[first]
                self.prints[bucket[able], slot], self.entry[bucket[able], slot] = prints[able], entries[able]
                waiting = np.setdiff1d(waiting, able, assume_unique=True)
        for i in waiting:
            fingerprint, bucket, entry = prints[i], one[i], entries[i]
            for kick in range(MAX_KICKS):
                empty = np.flatnonzero(self.prints[bucket] == 0)
                slot = empty[0] if len(empty) else (kick + int(fingerprint)) % SLOTS
                old = self.prints[bucket, slot], self.entry[bucket, slot]
                self.prints[bucket, slot], self.entry[bucket, slot] = fingerprint, entry
                if len(empty):
                    break
                fingerprint, entry = old
                bucket = int(self._other(np.array([bucket]), np.array([fingerprint]))[0])
            else:
                return False
        return True


def normalised(text: Column) -> Column:
    """Lower case of A-Z only; null counts as empty."""
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(F.coalesce(text, F.lit("")), capitals, capitals.lower())


def _merge(limit: int | None):
    """Sum (digest, n, keep_id) rows of a task in a cuckoo index; hand on what it holds above ``limit``."""

    def flush(index: CuckooIndex) -> pd.DataFrame:
        at = index.live()
        raw = index.digests[at].tobytes()
        return pd.DataFrame(
            {
                "digest": [raw[i : i + 32] for i in range(0, len(raw), 32)],
                "group_size": index.count[at],
                "keep_id": index.largest[at],
            }
        )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index = CuckooIndex()
        for batch in batches:
            if batch.empty:
                continue
            rows = batch.groupby("digest", sort=False).agg(n=("group_size", "sum"), largest=("keep_id", "max"))
            digests = np.frombuffer(b"".join(rows.index), np.uint64).reshape(-1, 4)
            index.insert(digests, rows["n"].to_numpy(), rows["largest"].to_numpy())
            if limit is not None and len(index) > limit:
                yield flush(index)
                index = CuckooIndex()
        yield flush(index)

    return run


INDEX = "digest binary, group_size long, keep_id long"


def build_index(rows: DataFrame, partitions: int | None = None) -> DataFrame:
    """(digest, group_size, keep_id) of all digests of ``rows`` (digest binary of 32 bytes, doc_id).

    Map tasks sum their own copies first; the sums meet by digest. To extend an index, pass its rows too
    with ``merge_indexes``.
    """
    single = rows.select("digest", F.lit(1).cast("long").alias("group_size"), F.col("doc_id").alias("keep_id"))
    local = single.where("keep_id IS NOT NULL").mapInPandas(_merge(LOCAL_DIGESTS), INDEX)
    return merge_indexes(local, partitions)


def merge_indexes(rows: DataFrame, partitions: int | None = None) -> DataFrame:
    """One row per digest from rows of several indexes."""
    n = partitions or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(n, "digest").mapInPandas(_merge(None), INDEX)


def remove_from_index(index: DataFrame, dead: DataFrame) -> DataFrame:
    """The index without the digests of ``dead`` (digest): each task deletes them from its cuckoo index."""
    marked = index.select("digest", "group_size", "keep_id").unionByName(
        dead.select("digest", F.lit(0).cast("long").alias("group_size"), F.lit(0).cast("long").alias("keep_id")).distinct()
    )
    n = int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # Deletions wait until every insertion of the task is in.
        held, gone = CuckooIndex(), []
        keys = lambda rows: np.frombuffer(b"".join(rows["digest"]), np.uint64).reshape(-1, 4)
        for batch in batches:
            kept = batch[batch["group_size"] > 0]
            if len(kept):
                held.insert(keys(kept), kept["group_size"].to_numpy(), kept["keep_id"].to_numpy())
            if len(kept) < len(batch):
                gone.append(keys(batch[batch["group_size"] == 0]))
        for digests in gone:
            held.delete(digests)
        at = held.live()
        raw = held.digests[at].tobytes()
        yield pd.DataFrame(
            {
                "digest": [raw[i : i + 32] for i in range(0, len(raw), 32)],
                "group_size": held.count[at],
                "keep_id": held.largest[at],
            }
        )

    return marked.repartition(n, "digest").mapInPandas(run, INDEX)


def dedup(docs: DataFrame) -> DataFrame:
    """Which row of equal texts stays, for every row of ``docs`` (doc_id, text).

    Texts are equal when they agree after lower-casing A-Z; null counts as empty. The largest doc_id
    stays. A row that repeats with the same doc_id counts again in group_size and is kept as often as
    it occurs. A null doc_id joins no group: its row is returned with null keep_id, kept false.
    Columns: doc_id, keep_id, group_size, kept, text_sha256. Other columns are ignored.
    """
    rows = docs.select("doc_id", F.sha2(normalised(F.col("text")), 256).alias("text_sha256"))
    index = build_index(rows.select("doc_id", F.unhex("text_sha256").alias("digest")))
    groups = index.select(F.lower(F.hex("digest")).alias("key"), "group_size", "keep_id")
    joined = rows.join(groups, (rows.text_sha256 == groups.key) & rows.doc_id.isNotNull(), "left")
    return joined.select(
        "doc_id", "keep_id", F.coalesce("group_size", F.lit(0)).cast("long").alias("group_size"),
        F.coalesce(F.col("doc_id") == F.col("keep_id"), F.lit(False)).alias("kept"), "text_sha256",
    )


def keep_last(docs: DataFrame) -> DataFrame:
    """One row of each text of ``docs``, the one with the largest doc_id; all columns.

    A row without a doc_id stays where no row with one holds its text. Rows that share a doc_id are judged text by text;
    of rows that repeat doc_id and text one stays (``rows_of`` says which).
    """
    digest = F.unhex(F.sha2(normalised(F.col("text")), 256))
    index = build_index(docs.select("text", known_id(F.col("doc_id")).alias("doc_id")).select("doc_id", digest.alias("digest")))
    return rows_of(docs, index.select(F.col("keep_id").alias("kept_id"), F.col("digest").alias("kept_mark")), digest)
