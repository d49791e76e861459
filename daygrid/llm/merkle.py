"""Merkle manifest of a dataset with incremental witnesses.

A tree has three children per node, the last node of a level fewer. Leaves are appended one by one,
in order. A complete run of siblings closes: its node moves up, and each sibling's subtree gets the
step that leads through it, so open subtrees carry partial witnesses that later completions extend.

Nothing passes through one task. Leaves get their position in the tree from a range sort, blocks of
3**LEVELS aligned positions are appended in tasks of their own, and their roots are the leaves of the
next round of appends, until every tree has one root. The roots of all trees, in order, are appended
the same way. Witnesses of blocks are then joined to those of their leaves, from the top down.

A step of a witness is the text hashed for the parent, with ``|`` where the node's own digest goes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daygrid.llm.common import stage

FAN = 3
#: Levels a task appends: a block is 3**8 = 6,561 nodes.
LEVELS = 8
#: Rows per partition of the range sort, at most on average.
SORT_ROWS = 500_000
HOLE = "|"


def leaf(*columns: Column) -> Column:
    """Digest of a row: each value as its UTF-8 byte count, ``:`` and text, or ``-`` if null."""
    texts = [c.cast("string") for c in columns]
    return F.sha2(
        F.concat(*(F.when(t.isNull(), "-").otherwise(F.concat(F.octet_length(t), F.lit(":"), t)) for t in texts)), 256
    )


def folded(digest: Column, steps: Column) -> Column:
    """The root that follows from a leaf's digest and its witness."""
    return F.aggregate(steps, digest, lambda node, step: F.sha2(F.replace(step, F.lit(HOLE), node), 256))


def siblings(steps: Column) -> Column:
    """Digests of all siblings on the way to the root, level by level, left to right."""
    return F.replace(F.array_join(steps, ""), F.lit(HOLE), F.lit(""))


def parent(nodes: list[str]) -> str:
    return hashlib.sha256("".join(nodes).encode()).hexdigest()


class Witnesses:
    """A tree that grows by appends and keeps, per node, the step to its parent once that is closed."""

    def __init__(self) -> None:
        self.n = 0
        self.open: list[list[str]] = []
        self.steps: list[list[str]] = []

    def append(self, digest: str, level: int = 0) -> None:
        if level == len(self.open):
            self.open.append([])
            self.steps.append([])
        self.n += level == 0
        self.open[level].append(digest)
        if len(self.open[level]) == FAN:
            self._close(level)

    def _close(self, level: int) -> None:
        """The open run of a level has all its siblings: their subtrees' witnesses grow by one step."""
        run, self.open[level] = self.open[level], []
        for i in range(len(run)):
            self.steps[level].append("".join(run[:i]) + HOLE + "".join(run[i + 1 :]))
        self.append(parent(run), level + 1)

    def finish(self, height: int | None = None) -> str:
        """Close what is open and return the root: at ``height``, or where one node is left."""
        level = 0
        while True:
            alone = len(self.open[level]) == 1 and not self.steps[level]
            if level == height or (height is None and alone):
                return self.open[level][0]
            if self.open[level]:
                self._close(level)
            level += 1

    def witness(self, i: int, height: int) -> list[str]:
        """Steps from leaf ``i`` up to ``height``."""
        return [self.steps[level][i // FAN**level] for level in range(height)]


def numbered(rows: DataFrame, tree: str, order: list[str]) -> DataFrame:
    """Adds ``position`` (from 0) of each row in its tree by ``order``, with no tree in one task.

    Rows are sorted over range partitions. A run is what one partition holds of one tree; runs are summed in
    order, and a row lies as far in its tree as the runs before hold, plus its place in its own run.
    """
    spark = rows.sparkSession
    rows = stage(rows, "merkle-rows")
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // SORT_ROWS))
    in_order = rows.repartitionByRange(parts, tree, *order).sortWithinPartitions(tree, *order)
    # The number of a row: its partition above bit 33, its place in the partition below.
    number = F.monotonically_increasing_id()
    ranged = stage(
        in_order.select("*", number.alias("_number")).select(
            "*", F.shiftrightunsigned("_number", 33).alias("_part")
        ),
        "merkle-sorted",
    )
    runs = ranged.groupBy("_part", tree).agg(F.min("_number").alias("_first"), F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(tree).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = runs.select("_part", tree, "_first", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    placed = ranged.join(starts, ["_part", tree])
    position = F.col("_before") + F.col("_number") - F.col("_first")
    return placed.withColumn("position", position).drop("_part", "_number", "_first", "_before")


def _appended(nodes: DataFrame, levels: int) -> DataFrame:
    """Append the nodes of each (tree, block) in order.

    One row per node with its partial witness (``steps``), and one per block with ``root`` and null position.
    """
    size = FAN**levels
    extras = [c for c in nodes.columns if c not in ("tree", "position", "digest")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        block_of = None
        grown = Witnesses()
        schema = None

        def closed() -> list[tuple]:
            if block_of is None:
                return []
            tree, block = block_of
            # A later block is a subtree of full height; the first one only if it is full.
            height = levels if block or grown.n == size else None
            root = grown.finish(height)
            top = levels if height is not None else next(i for i, s in enumerate([*grown.steps, []]) if not s)
            rows = [(tree, block, *row, grown.witness(i, top), None) for i, row in enumerate(held)]
            return [*rows, (tree, block, None, None, *[None] * len(extras), None, root)]

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True)) or [()] * len(schema)
            arrays = [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, schema=schema)

        for batch in batches:
            fields = [batch.schema.field(name).with_nullable(True) for name in ("tree", "block", "position", "digest", *extras)]
            schema = pa.schema([*fields, ("steps", pa.list_(pa.string())), ("root", pa.string())])
            out: list[tuple] = []
            columns = [batch.column(f.name).to_pylist() for f in fields]
            for tree, block, *row in zip(*columns, strict=True):
                if (tree, block) != block_of:
                    out += closed()
                    block_of, held, grown = (tree, block), [], Witnesses()
                held.append(tuple(row))
                grown.append(row[1])
            yield batch_of(out)
        if schema is not None:
            yield batch_of(closed())

    placed = nodes.select("tree", F.expr(f"position div {size}").alias("block"), "position", "digest", *extras)
    ordered = placed.repartition("tree", "block").sortWithinPartitions("tree", "block", "position")
    types = dict(placed.dtypes)
    schema = ", ".join(f"`{c}` {types[c]}" for c in placed.columns)
    return ordered.mapInArrow(run, schema + ", steps array<string>, root string")


def _grown(nodes: DataFrame, levels: int, name: str) -> tuple[list[DataFrame], DataFrame]:
    """Rounds of appends until each tree has one root: witnesses of every round, and (tree, digest) of the roots."""
    rounds = []
    while True:
        out = stage(_appended(nodes, levels), f"merkle-{name}-{len(rounds)}")
        rounds.append(out.where("root IS NULL").drop("root"))
        roots = out.where("root IS NOT NULL")
        nodes = roots.select("tree", F.col("block").alias("position"), F.col("root").alias("digest"))
        if not nodes.agg(F.max("position")).first()[0]:
            return rounds, nodes.drop("position")


def _joined(rounds: list[DataFrame], above: DataFrame) -> DataFrame:
    """Leaves of the first round with their whole witness; ``above`` has (tree, top) and columns to hand down."""
    handed = [c for c in above.columns if c not in ("tree", "top")]
    above = above.withColumn("block", F.lit(0).cast("long"))
    for rows in reversed(rounds[1:]):
        whole = rows.join(above, ["tree", "block"]).withColumn("top", F.concat("steps", "top"))
        above = whole.select("tree", F.col("position").alias("block"), "top", *handed)
    return rounds[0].join(above, ["tree", "block"]).withColumn("steps", F.concat("steps", "top")).drop("block", "top")


def manifest(rows: DataFrame, tree: str, order: list[str], digest: str, levels: int = LEVELS) -> DataFrame:
    """Root and witness of every row of ``rows``.

    ``tree`` names the string column that parts rows into trees (null is a tree and comes first), ``order`` the
    columns that order a tree's leaves (nulls first; ties by digest, so equal rows change nothing), ``digest`` the
    leaf. Other columns are kept; the names _part, _number, tree, position, steps, subroot, root are taken.
    Adds subroot, root and ``steps``, the witness from the leaf to the root. An empty table has no rows and no root.
    """
    keep = [c for c in rows.columns if c != digest]
    # A null tree sorts before all others, which begin with a letter.
    named = F.coalesce(F.concat(F.lit("s"), F.col(tree)), F.lit("-"))
    given = rows.select(named.alias("tree"), F.col(digest).alias("digest"), *keep)
    leaves, subroots = _grown(numbered(given, "tree", [*order, "digest"]), levels, "rows")
    # All subroots form one tree, in the order of the trees.
    roots = subroots.select(F.lit("").alias("all"), F.col("tree").alias("name"), "digest")
    top = numbered(roots, "all", ["name"]).withColumnRenamed("all", "tree")
    upper, root = _grown(top, levels, "trees")
    ends = root.select("tree", F.col("digest").alias("root"), F.array().cast("array<string>").alias("top"))
    above = _joined(upper, ends).select(
        F.col("name").alias("tree"), F.col("digest").alias("subroot"), "root", F.col("steps").alias("top")
    )
    return _joined(leaves, above).withColumnRenamed("digest", digest).drop("tree", "position")


def report(docs: DataFrame, levels: int = LEVELS) -> DataFrame:
    """Manifest of ``docs`` (doc_id, source, lang, n_chars, text), and whether each row still verifies.

    One tree per source over leaves by doc_id; a leaf hashes the five columns. Where the CRC-32 of the decimal
    doc_id is even, the row is read back with its line feeds gone; ``folded_root`` folds what was read back with
    the witness, ``verified`` says whether it is the root. A null doc_id comes first in its source and is read back
    as it is. Repeated rows are leaves each. Other columns are ignored; an empty table gives no rows.
    Columns: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.
    """
    others = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    cut = F.replace(F.col("text"), F.lit("\n"), F.lit(""))
    rows = docs.select(
        "doc_id", "source", leaf(*others, F.col("text")).alias("leaf"),
        F.when(tampered, leaf(*others, cut)).alias("read_back"),
    )
    made = manifest(rows, "source", ["doc_id"], "leaf", levels)
    return made.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(siblings(F.col("steps")), 256).alias("proof_sha256"),
        folded(F.coalesce("read_back", "leaf"), F.col("steps")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
