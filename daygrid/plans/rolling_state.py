"""The rolling mean over observations, built forward from a state instead of from all history.

The row frame reaches back over gaps of any length, so a build from the panel reads every day. The state holds the last
``size - 1`` observations of each entity up to a day; with it a build reads the days after that day only. Every build
leaves the state of its last day in a folder of its own. States from a day on are deleted before that day is built anew.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from daygrid.functions.dates import Span
from daygrid.operators.lookback import with_rolling_mean
from daygrid.plans.gold import with_dimension
from daygrid.schemas import DAY, ENTITY, ROLLING_COLUMNS
from daygrid.sources.listing import folder_days

AS_OF = "as_of"
#: States that stay, so that a late day finds one before it.
KEEP_STATES = 40
_STATE = (ENTITY, DAY, "price_usd", "volume_usd_24hr")
_MEANS = {"wkly_roll_avg_price": "price_usd", "wkly_roll_avg_volume": "volume_usd_24hr"}


def with_state(rows: DataFrame, state: DataFrame | None) -> DataFrame:
    """New rows, and those of the state as ``_old``."""
    new = rows.withColumn("_old", F.lit(False))
    return new if state is None else new.unionByName(state.select(*_STATE).withColumn("_old", F.lit(True)), allowMissingColumns=True)


def rolled(rows: DataFrame, state: DataFrame | None, size: int = 7) -> DataFrame:
    """``rows`` (later than the state) with their means; at most size - 1 rows per entity come from the state."""
    return with_rolling_mean(with_state(rows, state), _MEANS, "rows", size).where(~F.col("_old")).drop("_old")


def next_state(rows: DataFrame, state: DataFrame | None, size: int = 7) -> DataFrame:
    """The last size - 1 observations of every entity, those seen long ago included."""
    newest = Window.partitionBy(ENTITY).orderBy(F.desc(DAY))
    numbered = with_state(rows.select(*_STATE), state).withColumn("_n", F.row_number().over(newest))
    return numbered.where(F.col("_n") <= size - 1).select(*_STATE)


def _folder(path: str, day: date) -> str:
    return f"{path.rstrip('/')}/{AS_OF}={day.isoformat()}"


def _delete(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def advance(
    spark: SparkSession, panel: DataFrame, dim: DataFrame, states: str, held: list[date], span: Span | None, write, size: int = 7
) -> None:
    """Build the days of the panel from the start of ``span`` on (all without one) and leave the state of the last day.

    ``held`` are the days of the panel, ``write`` puts the resulting table into place. Days before the newest state
    that lies before the span are not read. Without such a state all days up to the end are.
    """
    if not held:
        return
    start = held[0] if span is None else span[0]
    known = folder_days(spark, states, AS_OF)
    for day in known:
        if day >= start:
            _delete(spark, _folder(states, day))
    earlier = [day for day in known if day < start]
    state = spark.read.parquet(_folder(states, earlier[-1])) if earlier else None
    rows = panel.select(ENTITY, DAY, "price_usd", "market_cap_usd", "volume_usd_24hr", "vwap_24hr")
    if earlier:
        rows = rows.where(F.col(DAY) > F.lit(earlier[-1]))
    table = with_dimension(rolled(rows, state, size).where(F.col(DAY) >= F.lit(start)), dim)
    write(table.select(*ROLLING_COLUMNS))
    next_state(rows, state, size).write.mode("overwrite").parquet(_folder(states, held[-1]))
    for day in earlier[: max(0, len(earlier) + 1 - KEEP_STATES)]:
        _delete(spark, _folder(states, day))
