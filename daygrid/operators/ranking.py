"""Rank within a day, also when one day holds a large part of all rows.

    rank = 1 + number of rows of the day with a greater value

The default way never sorts a large day in one task:

1. The rows are written once to shared storage; all that follows, for every rank, reads them there.
2. Days of more than ``cell_rows`` rows get splitters, percentiles of a sample of their rows, which are stored too.
   They cut a day into cells of about ``cell_rows`` rows in the order of the value, into ``MAX_CELLS`` of equal shares
   where these would be more: every task gets the splitters of all days. A value so frequent that it appears among
   the splitters twice has a cell of its own, and so has NULL.
3. A row finds its cells by bisection of the splitters, in compiled steps, and travels with their numbers and the columns
   asked for only. Its rank is its rank in its cell plus the rows in cells of greater values: one count per cell,
   summed in order. Cells of one value need no order among their rows, so these are spread over salts.

Splitters decide which task ranks a row, never the rank. Where no day is large the window goes by day. Every
rank costs one shuffle of the rows and two of counts per cell.

``method="window"`` asks for ``rank() OVER (PARTITION BY day ORDER BY value DESC)`` over the rows as they come: one
shuffle, shared by every rank, one sort task per day, nothing stored. It is for callers who know that a day is small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from daygrid.schemas import DAY
from daygrid.session import scratch_dir

METHODS = ("range", "window")

#: Rows of a day that one task ranks.
CELL_ROWS = 1_000_000
#: Cells of a day: 1 KB of splitters per day and value in every task.
MAX_CELLS = 128
#: Rows sampled per cell for the splitters.
SAMPLE_ROWS = 1_000
#: Parts into which the rows of a cell of one value are spread.
SALTS = 1024


def _stored(df: DataFrame, staging: str, name: str) -> DataFrame:
    path = f"{staging.rstrip('/')}/{name}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove_staging(spark: SparkSession, staging: str) -> None:
    """Delete what ranks wrote to ``staging``, once no frame that reads it is needed any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(staging)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def splitters(rows: DataFrame, by: str, values: list[str], cell_rows: int, staging: str) -> DataFrame | None:
    """(by, _at_<value>, ...) for the days of more than ``cell_rows`` rows, or None where there is none.

    Each array holds up to one splitter per cell of the largest day, ascending, the frequent ones repeated.
    """
    sizes = rows.groupBy(by).agg(F.count(F.lit(1)).alias("_n"))
    largest = sizes.agg(F.max("_n")).first()[0] or 0
    if largest <= cell_rows:
        return None
    cells = min(-(-largest // cell_rows), MAX_CELLS)
    # The calendar bounds the number of days.
    large = rows.join(F.broadcast(sizes.where(F.col("_n") > cell_rows).select(by)), by, "left_semi")
    some = large.sample(min(1.0, SAMPLE_ROWS * cells / largest), seed=1)
    shares = F.array(*(F.lit(i / cells) for i in range(1, cells)))
    accuracy = F.lit(max(10_000, 100 * cells))
    none = F.array().cast("array<double>")
    found = some.groupBy(by).agg(
        *(F.coalesce(F.percentile_approx(v, shares, accuracy).cast("array<double>"), none).alias(f"_at_{v}") for v in values)
    )
    return _stored(found, staging, "splitters")


def _with_lookup(cuts: DataFrame, values: list[str]) -> DataFrame:
    """For each array of splitters the distinct ones, ``_cut_<value>``, and whether each is there twice, ``_own_<value>``."""

    def twice(at: Column) -> Column:
        return F.transform(F.array_distinct(at), lambda d: F.size(F.filter(at, lambda t: t == d)) > 1)

    found = cuts
    for v in values:
        found = found.withColumns({f"_cut_{v}": F.array_distinct(f"_at_{v}"), f"_own_{v}": twice(F.col(f"_at_{v}"))})
    return found.drop(*(f"_at_{v}" for v in values))


def _with_upto(found: DataFrame, values: list[str]) -> DataFrame:
    """Add ``_upto_<value>``: distinct splitters up to a value, by bisection.

    One projection per step: Spark compiles these, but calls the lambda of ``aggregate`` row by row.
    """
    found = found.withColumns({f"_upto_{v}": F.lit(0) for v in values})
    for k in reversed(range((MAX_CELLS - 1).bit_length())):
        step = 1 << k
        # Beyond the last splitter there is NULL, which stays below.
        next_at = {v: F.get(f"_cut_{v}", F.col(f"_upto_{v}") + F.lit(step - 1)) <= F.col(v) for v in values}
        found = found.withColumns({f"_upto_{v}": F.col(f"_upto_{v}") + F.when(next_at[v], step).otherwise(0) for v in values})
    return found


def _cell(value: str) -> Column:
    """Number of the cell of a value, greatest values first; odd ones hold one value only. 0 in a small day."""
    cut, upto = F.col(f"_cut_{value}"), F.col(f"_upto_{value}")
    last = F.greatest(upto - 1, F.lit(0))
    own = (upto > 0) & F.get(f"_own_{value}", last) & (F.get(cut, last) == F.col(value))
    below = F.size(cut) - upto
    cell = F.when(F.col(value).isNull(), 2 * F.size(cut) + 3).otherwise(2 * below + F.coalesce(own, F.lit(False)).cast("int"))
    return F.when(cut.isNull(), F.lit(0)).otherwise(cell)


def _part(cell: str) -> Column:
    """What a row of a cell is shuffled by: the cell, and for cells of one value a salt in its lower digits."""
    salt = F.pmod("_row", F.lit(SALTS)).cast("int")
    return F.col(cell) * SALTS + F.when(F.col(cell) % 2 == 1, salt).otherwise(F.lit(0))


def _rank_cells(rows: DataFrame, by: str, ranks: dict[str, str], cuts: DataFrame) -> DataFrame:
    columns = rows.columns
    values = sorted(set(ranks.values()))
    # Salts come from the place of a row in its file: no column is read, or travels, for them only.
    rows = rows.select("*", F.col("_metadata.row_index").alias("_row"))
    # At most 8 bytes per cell_rows rows of a large day and value; dropped before any shuffle.
    found = _with_upto(rows.join(F.broadcast(_with_lookup(cuts, values)), by, "left"), values)
    placed = found.select(
        *columns, "_row", F.col(f"_cut_{values[0]}").isNotNull().alias("_large"), *(_cell(v).alias(f"_cell_{v}") for v in values)
    )
    ranked = placed.select(*columns, *(_part(f"_cell_{v}").alias(f"_part_{v}") for v in values))
    for name, value in ranks.items():
        cell, part = f"_cell_{value}", f"_part_{value}"
        counts = placed.where("_large").groupBy(by, cell).agg(F.count(F.lit(1)).alias("_n"))
        greater = Window.partitionBy(by).orderBy(cell).rowsBetween(Window.unboundedPreceding, -1)
        # One row per cell of a large day.
        above = F.broadcast(counts.select(by, cell, F.sum("_n").over(greater).alias("_above")))
        inside = Window.partitionBy(by, part).orderBy(F.desc_nulls_last(value))
        ranked = (
            ranked.withColumn(name, F.rank().over(inside))
            .withColumn(cell, F.floor(F.col(part) / SALTS).cast("int"))
            .join(above, [by, cell], "left")
            .withColumn(name, F.col(name) + F.coalesce("_above", F.lit(0)))
            .drop(cell, "_above")
        )
    return ranked.select(*columns, *ranks)


def _rank_window(rows: DataFrame, by: str, ranks: dict[str, str]) -> DataFrame:
    return rows.select(
        "*",
        *(
            F.rank().over(Window.partitionBy(by).orderBy(F.desc_nulls_last(value))).alias(name)
            for name, value in ranks.items()
        ),
    )


def rank_within_day(
    rows: DataFrame,
    ranks: dict[str, str],
    *,
    by: str = DAY,
    unranked_nulls: frozenset[str] | set[str] = frozenset(),
    method: str = "range",
    staging: str | None = None,
    cell_rows: int = CELL_ROWS,
) -> DataFrame:
    """Add ``{rank name: value column}`` ranks, highest value first, ties sharing a rank.

    NULL values rank last, NaN first; for names in ``unranked_nulls`` NULL values get a NULL rank instead. Values
    are doubles or cast to them for splitters; the day is not NULL. The default method runs the jobs that write ``rows`` and splitters, below ``staging`` or a fresh scratch
    folder; ``remove_staging`` deletes a folder that was given.
    """
    if method not in METHODS:
        raise ValueError(f"method must be one of {METHODS}")
    if method == "window":
        ranked = _rank_window(rows, by, ranks)
    else:
        staging = staging or scratch_dir(rows.sparkSession, "ranks")
        rows = _stored(rows, staging, "rows")
        cuts = splitters(rows, by, sorted(set(ranks.values())), cell_rows, staging)
        ranked = _rank_window(rows, by, ranks) if cuts is None else _rank_cells(rows, by, ranks, cuts)
    final = {}
    for name, value in ranks.items():
        rank = F.col(name).cast("int")
        final[name] = F.when(F.col(value).isNotNull(), rank) if name in unranked_nulls else rank
    return ranked.withColumns(final)
