"""Bounded-space online packing of token sequences.

A task keeps a fixed number of open windows. The pieces of each document arrive in turn: full windows
leave at once, the rest goes where it fits best; when it fits nowhere, the fullest window leaves.
The windows a task still holds at its end are packed again, together with those of other tasks.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daygrid.llm.common import WordEncoder, stage, word_encoder

WINDOW = 1024
OPEN_WINDOWS = 64
#: Leftover windows one merging task takes.
MERGE_WINDOWS = 16_384
#: Sequence ids: task number above, running number below.
TASK_BITS = 36

PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
)


class OpenWindows:
    """Best fit into at most ``limit`` windows of ``size``; each holds a fill and its items."""

    def __init__(self, size: int, limit: int):
        self.size, self.limit = size, limit
        self.fill = np.zeros(limit, np.int64)
        self.items: list[list] = [[] for _ in range(limit)]

    def place(self, length: int, item) -> list[list]:
        """Put an item (its offset, length and value are kept); returns the windows that leave."""
        room = self.size - self.fill - length
        fits = np.where(room >= 0, room, self.size + 1)
        at = int(fits.argmin())
        left = []
        if fits[at] > self.size:
            at = int(self.fill.argmax())
            left.append(self._take(at))
        self.items[at].append((int(self.fill[at]), length, item))
        self.fill[at] += length
        if self.fill[at] == self.size:
            left.append(self._take(at))
        return left

    def _take(self, at: int) -> list:
        items, self.items[at], self.fill[at] = self.items[at], [], 0
        return items

    def rest(self) -> list[list]:
        return [items for items in self.items if items]


def padded_length(fill: int, size: int = WINDOW) -> int:
    """A sequence that is not full ends at the next power of two, at most ``size``."""
    return min(size, 1 << max(0, fill - 1).bit_length())


def pack(docs: DataFrame, ranks_path: str, pattern: str, specials: dict[str, int], *, end_id: int = 0,
         size: int = WINDOW, open_windows: int = OPEN_WINDOWS, with_ids: bool = False) -> DataFrame:
    """One row per piece of a document: where it starts in the document and where it lies.

    ``docs`` has doc_id and text; other columns are ignored. A null or empty text is the end id alone.
    Repeated rows are packed as often as they occur. ``with_ids`` adds the token ids of each piece.
    Columns: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset [, ids].
    A sequence is padded to ``padded_length`` of its fill.
    """
    schema = PIECES + ", open boolean" + (", ids array<int>" if with_ids else "")

    def tokens(text: str | None, encoder: WordEncoder) -> np.ndarray:
        return np.append(np.frombuffer(encoder.encode(text or ""), "<u4"), np.uint32(end_id)).astype("<u4")

    def first_pass(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = word_encoder(ranks_path, pattern, specials)
        windows = OpenWindows(size, open_windows)
        base, number = TaskContext.get().partitionId() << TASK_BITS, 0
        for batch in batches:
            out: list[tuple] = []
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                ids = tokens(text, encoder)
                for start in range(0, len(ids), size):
                    piece = ids[start : start + size]
                    row = (doc_id, start, len(piece), zlib.crc32(piece.tobytes()), len(ids))
                    extra = (piece.astype(np.int32),) if with_ids else ()
                    for items in windows.place(len(piece), (row, extra)):
                        out += [(*r, base + number, at, False, *x) for at, _, (r, x) in items]
                        number += 1
            yield frame(out)
        out = []
        for items in windows.rest():
            out += [(*r, base + number, at, True, *x) for at, _, (r, x) in items]
            number += 1
        yield frame(out)

    names = [c.strip().split(" ")[0] for c in schema.split(",")]

    def frame(rows: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame(rows, columns=names)

    first = stage(docs.select("doc_id", "text").mapInPandas(first_pass, schema), "packing")
    open_rows = first.where("open")
    windows_left = open_rows.groupBy("sequence_id").agg(F.sum("length").alias("n"))
    n_left = windows_left.count()
    tasks = max(1, -(-n_left // MERGE_WINDOWS))

    def merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Fullest windows first; a leftover window moves as a whole."""
        held = pd.concat([pd.DataFrame({"sequence_id": [], "n": []}, dtype="int64"), *batches], ignore_index=True)
        held = held.sort_values(["n", "sequence_id"], ascending=[False, True])
        windows, done = OpenWindows(size, open_windows), []
        for sequence_id, n in zip(held["sequence_id"].tolist(), held["n"].tolist(), strict=True):
            done += windows.place(n, sequence_id)
        rows = [(old, items[0][2], at) for items in done + windows.rest() for at, _, old in items]
        yield pd.DataFrame(rows, columns=["old_id", "new_id", "shift"])

    moves = windows_left.repartition(tasks, "sequence_id").mapInPandas(merge, "old_id long, new_id long, shift long")
    moved = open_rows.join(moves, open_rows.sequence_id == moves.old_id).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens",
        F.col("new_id").alias("sequence_id"), (F.col("offset") + F.col("shift")).alias("offset"),
        *(["ids"] if with_ids else []),
    )
    return first.where(~F.col("open")).drop("open").unionByName(moved)

