"""Fill-in-middle transformation by secondary-sort assembly.

Every text is cut into units (lines). Two cuts between units, taken from a hash of the id, part it
into prefix, middle and suffix; the output names them with marks, suffix before middle. A map task
never builds the output: it emits pieces, runs of whole units of bounded size, keyed by document and
place in the output. The pieces are dealt by document and sorted within the partitions (the DataFrame
form of repartitionAndSortWithinPartitions), and a task streams them into one incremental digest per
document. The same shuffled pieces, sorted by the place that form and output place say they had in the
text, stream into the digest of the restored text: what the output holds, without its marks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes of a piece, unless one unit is longer; a longer unit is spread over several pieces.
PIECE_BYTES = 32_768
MARKS = ("<P>", "<S>", "<M>")
FORMS = ("plain", "psm", "spm")
#: By form: the sections of the output in order. 0 prefix, 1 middle, 2 suffix.
_SECTIONS = {"plain": (0,), "psm": (0, 2, 1), "spm": (2, 0, 1)}

_HEAD = [
    ("doc_id", pa.int64()), ("text_key", pa.int64()), ("n", pa.int64()), ("form", pa.string()),
    ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()),
]
_PIECES = pa.schema([*_HEAD, ("place", pa.int32()), ("part", pa.int32()), ("piece", pa.binary())])
PIECES = (
    "doc_id long, text_key long, n long, form string, prefix_chars long, middle_chars long, "
    "place int, part int, piece binary"
)


def cuts(doc_id: int | None, n: int, seed: int, rate: int, spm: int) -> tuple[int, int, str]:
    """Units before the end of prefix and of middle, and the form, from the hash of the id (a null id: of no digits)."""
    digits = "" if doc_id is None else str(doc_id)
    whole = hashlib.sha256(f"{seed}:{digits}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(whole[i : i + 8], 16) for i in range(0, 32, 8))
    form = "plain" if h3 % 100 >= rate else "spm" if h4 % 100 < spm else "psm"
    return min(h1 % (n + 1), h2 % (n + 1)), max(h1 % (n + 1), h2 % (n + 1)), form


def unit_ends(raw: bytes) -> np.ndarray:
    """Where each line ends: after its line feed, or at the end of the text."""
    ends = np.flatnonzero(np.frombuffer(raw, np.uint8) == 10) + 1
    if len(raw) and (not len(ends) or ends[-1] != len(raw)):
        ends = np.append(ends, len(raw))
    return ends


def runs_of_units(ends: np.ndarray, start: int, end: int, size: int) -> Iterator[tuple[int, int]]:
    """Cut start to end (unit bounds) into runs of whole units of at most ``size`` bytes; longer units into parts."""
    while end - start > size:
        at = int(np.searchsorted(ends, start + size, side="right")) - 1
        stop = int(ends[at]) if at >= 0 and ends[at] > start else start + size
        yield start, stop
        start = stop
    yield start, end


def pieces(docs: DataFrame, *, seed: int = 7, rate: int = 100, spm: int = 50,
           marks: tuple[str, str, str] = MARKS, piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """Pieces of the outputs of ``docs`` (doc_id, text); other columns are ignored.

    ``rate`` of a hundred documents are transformed, ``spm`` of a hundred of those start with the suffix.
    A null text is empty. Empty texts and texts that hold a mark stay plain. Rows of one doc_id with
    different texts are kept apart by a hash of the text; equal rows give equal pieces.
    """
    signs = [m.encode("utf-8") for m in marks]
    of_section = {0: signs[0], 2: signs[1], 1: signs[2]}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for doc_id, key, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                raw = (text or "").encode("utf-8")
                ends = unit_ends(raw)
                n = len(ends)
                first, second, form = cuts(doc_id, n, seed, rate, spm)
                if not raw or any(sign in raw for sign in signs):
                    form = "plain"
                head = (doc_id, key, n, form, None, None)
                bounds = [(0, len(raw))]
                if form != "plain":
                    a, b = (int(ends[k - 1]) if k else 0 for k in (first, second))
                    bounds = [(0, a), (a, b), (b, len(raw))]
                    head = (doc_id, key, n, form, len(raw[:a].decode("utf-8")), len(raw[a:b].decode("utf-8")))
                for place, section in enumerate(_SECTIONS[form]):
                    for part, (start, end) in enumerate(runs_of_units(ends, *bounds[section], piece_bytes)):
                        sign = of_section[section] if form != "plain" and part == 0 else b""
                        out.append((*head, place, part, sign + raw[start:end]))
            columns = list(zip(*out, strict=True)) or [()] * len(_PIECES)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, _PIECES, strict=True)], schema=_PIECES
            )

    rows = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_key"), "text")
    return rows.mapInArrow(run, PIECES)


def _streamed(sink: Callable[[], object], take: Callable, close: Callable, fields: list,
              batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Feed sorted pieces of each document to a sink of its own; equal rows arrive as repeated pieces and count once.

    One row per document with the columns of ``fields`` and ``copies``, how often its row occurred.
    """
    schema = pa.schema([*fields, ("copies", pa.int64())])
    names = [f.name for f in _PIECES]
    current, head, state, last, copies = None, None, None, None, 0

    def row() -> tuple:
        return (*head, close(state), copies)

    for batch in batches:
        out = []
        for piece in zip(*(batch.column(name).to_pylist() for name in names), strict=True):
            key, at = piece[:2], piece[6:8]
            if key != current:
                if current is not None:
                    out.append(row())
                current, head, state, first, last, copies = key, piece[:6], sink(), at, None, 0
            copies += at == first
            if at != last:
                take(state, piece)
                last = at
        yield _batch(out, schema)
    yield _batch([row()] if current is not None else [], schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


_RESULT = (
    "doc_id long, text_key long, n long, form string, prefix_chars long, middle_chars long, {} , copies long"
)


def _add_piece(digest, piece: tuple) -> None:
    digest.update(piece[8])


def _dealt(made: DataFrame) -> DataFrame:
    return made.repartition("doc_id", "text_key")


def output_digests(made: DataFrame) -> DataFrame:
    """SHA-256 of each output from its pieces, streamed in the order of the output."""
    run = partial(_streamed, hashlib.sha256, _add_piece, lambda d: d.hexdigest(), [*_HEAD, ("output_sha256", pa.string())])
    ordered = _dealt(made).sortWithinPartitions("doc_id", "text_key", "place", "part")
    return ordered.mapInArrow(run, _RESULT.format("output_sha256 string"))


def restored_digests(made: DataFrame, marks: tuple[str, str, str] = MARKS) -> DataFrame:
    """SHA-256 of each text rebuilt from output pieces and form: resorted to the text's order, marks taken off.

    The place a section had in the text is read from form and place in the output, not carried along.
    """
    width = [len(m.encode("utf-8")) for m in marks]
    by_section = (width[0], width[2], width[1])

    def take(digest, piece: tuple) -> None:
        form, place, part = piece[3], piece[6], piece[7]
        mark = by_section[_SECTIONS[form][place]] if form != "plain" and part == 0 else 0
        digest.update(piece[8][mark:])

    run = partial(_streamed, hashlib.sha256, take, lambda d: d.hexdigest(), [*_HEAD, ("restored_sha256", pa.string())])
    back = F.lit(0)
    for form in FORMS[1:]:
        for place, section in enumerate(_SECTIONS[form]):
            back = F.when((F.col("form") == form) & (F.col("place") == place), F.lit(section)).otherwise(back)
    ordered = _dealt(made).sortWithinPartitions("doc_id", "text_key", back, "part")
    return ordered.mapInArrow(run, _RESULT.format("restored_sha256 string"))


def outputs(made: DataFrame) -> DataFrame:
    """The transformed texts: doc_id, n, form, prefix_chars, middle_chars, output; one row per row of the documents."""
    run = partial(_streamed, list, lambda parts, piece: parts.append(piece[8]),
                  lambda parts: b"".join(parts).decode("utf-8"), [*_HEAD, ("output", pa.string())])
    ordered = _dealt(made).sortWithinPartitions("doc_id", "text_key", "place", "part")
    rows = ordered.mapInArrow(run, _RESULT.format("output string"))
    return _repeated(rows).drop("text_key")


def _repeated(rows: DataFrame) -> DataFrame:
    """Each row as often as its document occurred."""
    return rows.withColumn("copies", F.explode(F.sequence(F.lit(1), "copies"))).drop("copies")


def report(docs: DataFrame, **options) -> DataFrame:
    """Form, cuts and digests of output and restored text per row of ``docs`` (doc_id, text).

    Columns: doc_id, n (units), form, prefix_chars, middle_chars (null if plain), output_sha256,
    restored_sha256. Repeated rows are returned as often as they occur; an empty table gives no rows.
    Texts cross the shuffle once: both digests read the same dealt pieces.
    """
    made = pieces(docs, **options)
    out = output_digests(made)
    back = restored_digests(made, options.get("marks", MARKS)).select(
        F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), "restored_sha256"
    )
    both = out.join(back, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key")))
    return _repeated(both).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"
    )
