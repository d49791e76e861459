"""Helpers the operators share: reading, staging, and word-cached byte-level encoding."""

from __future__ import annotations

import base64
import re
from functools import lru_cache
from itertools import islice

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from daygrid.session import scratch_dir

#: Rows per Arrow batch. Texts are long, so a small batch bounds a Python worker's memory.
ARROW_ROWS = 500
#: Stands for a null doc_id where rows are chosen; below every other id.
NO_ID = -(2**63)
#: Entries a worker's word cache holds; then the older half goes (about 100 MB).
CACHE_WORDS = 300_000


def prepare(spark: SparkSession) -> SparkSession:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    return spark


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{name}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared scratch folder and read back: later jobs do not repeat the work."""
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_mark(text: Column) -> Column:
    """What tells texts of one doc_id, or without one, apart: 16 bytes; a null text counts as empty."""
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def known_id(doc_id: Column) -> Column:
    """The doc_id; NO_ID where it is null."""
    return F.coalesce(doc_id, F.lit(NO_ID))


def rows_of(docs: DataFrame, kept: DataFrame, mark: Column) -> DataFrame:
    """Rows of ``docs`` whose ``known_id`` and ``mark`` are in ``kept`` (kept_id, kept_mark, distinct): all columns.

    Rows that share a doc_id stay apart by their mark. Of rows that agree in both one stays: one with a doc_id, then the
    one whose text, and then whose other columns, come first. Text moves once: the window follows the join's keys, and
    what it drops goes before it.
    """
    keyed = docs.withColumns({"__id": known_id(F.col("doc_id")), "__mark": mark})
    chosen = kept.select(F.col("kept_id").alias("__id"), F.col("kept_mark").alias("__mark"))
    found = keyed.join(chosen, ["__id", "__mark"], "left_semi")
    ordered = [F.col(f"`{c}`") for c, kind in docs.dtypes if c != "doc_id" and "map<" not in kind and "variant" not in kind]
    first = Window.partitionBy("__id", "__mark").orderBy(F.col("doc_id").desc_nulls_last(), "text", *ordered)
    return found.withColumn("__number", F.row_number().over(first)).where("__number = 1").drop("__id", "__mark", "__number")


def train_rows(labelled: DataFrame, key: str, label: str, per_label: int) -> DataFrame:
    """About ``per_label`` rows of each label, chosen by a hash of the key (bounded by the number of labels)."""
    counts = {r[0]: r[1] for r in labelled.groupBy(label).count().collect()}
    share = F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(1_000_003)) / F.lit(1_000_003.0)
    keep = F.lit(False)
    for value, n in sorted(counts.items(), key=lambda kv: str(kv[0])):
        keep = keep | ((F.col(label) == F.lit(value)) & (share < F.lit(min(1.0, per_label / n))))
    return labelled.where(keep)


def forget_older(cache: dict, limit: int = CACHE_WORDS) -> None:
    """Drop the half that came in first once a cache holds more than ``limit`` entries."""
    if len(cache) > limit:
        for key in list(islice(cache, len(cache) // 2)):
            del cache[key]


class WordEncoder:
    """Byte-level BPE ids of texts as little-endian uint32 bytes.

    A blank always starts a new pre-token unless white space stands on both sides of it. Texts are
    therefore encoded blank by blank through a bounded cache; the others go to the encoder whole.
    Results equal an encoding of the whole text.
    """

    def __init__(self, ranks_path: str, pattern: str, specials: dict[str, int]):
        import tiktoken

        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines)}
        self._encoder = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens=specials)
        self._cache: dict[str, bytes] = {}

    def whole(self, text: str) -> bytes:
        return np.asarray(self._encoder.encode(text, allowed_special="all"), dtype="<u4").tobytes()

    def encode(self, text: str) -> bytes:
        if _UNSAFE.search(text) or text[-1:] == " ":
            return self.whole(text)
        cache = self._cache
        first, *rest = text.split(" ")
        head = self.whole(first)
        try:
            return head + b"".join([cache[w] for w in rest])
        except KeyError:
            pass
        forget_older(cache)
        for w in rest:
            if w not in cache:
                cache[w] = self.whole(" " + w)
        return head + b"".join([cache[w] for w in rest])


_UNSAFE = re.compile(r" \s")


@lru_cache(maxsize=2)
def _held_encoder(ranks_path: str, pattern: str, specials: tuple[tuple[str, int], ...]) -> WordEncoder:
    return WordEncoder(ranks_path, pattern, dict(specials))


def word_encoder(ranks_path: str, pattern: str, specials: dict[str, int]) -> WordEncoder:
    """The encoder of this Python worker, which the tasks it runs one after another share with its word cache."""
    return _held_encoder(ranks_path, pattern, tuple(sorted(specials.items())))
