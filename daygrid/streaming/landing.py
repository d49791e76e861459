"""Incremental landing of files, late-capture routing and a daily panel over a stream.

Every query runs with ``availableNow``: it takes what has arrived since its checkpoint and ends.
Checkpoints belong in the shared folder (``session.scratch_root``) or another durable one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from daygrid.plans.provenance import MAX_LAG_HOURS, is_late, with_fetch_lag
from daygrid.schemas import DAY
from daygrid.sinks.partitions import write_partitions

BATCH = "ingest_batch"


def read_stream(
    spark: SparkSession, path: str, schema: T.StructType, max_files: int | None = None
) -> DataFrame:
    """New Parquet files below ``path``. ``max_files`` bounds one micro-batch."""
    reader = spark.readStream.schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def _run(stream: DataFrame, write, checkpoint: str) -> StreamingQuery:
    query = (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def ingest(stream: DataFrame, sink: str, checkpoint: str, day: str = DAY) -> StreamingQuery:
    """Copy new files into a table partitioned by day and micro-batch.

    The checkpoint is the set of files already taken, so another run takes nothing twice. A
    batch repeated after a failure overwrites its own partitions only.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        write_partitions(batch.withColumn(BATCH, F.lit(batch_id)), sink, (day, BATCH))

    return _run(stream, write, checkpoint)


def route_late(
    stream: DataFrame, on_time: str, quarantine: str, checkpoint: str, max_lag_hours: int = MAX_LAG_HOURS
) -> StreamingQuery:
    """Split captures by fetch lag. A capture without a fetch time cannot be judged and passes."""

    def write(batch: DataFrame, batch_id: int) -> None:
        late = F.coalesce(is_late(max_lag_hours), F.lit(False))
        rows = batch.withColumn(BATCH, F.lit(batch_id))
        write_partitions(rows.where(~late), on_time, (DAY, BATCH))
        write_partitions(rows.where(late), quarantine, (DAY, BATCH))

    return _run(with_fetch_lag(stream), write, checkpoint)


def daily_panel(
    stream: DataFrame, time: str, entity: str, value: str, delay: str = "1 day"
) -> DataFrame:
    """Tumbling one-day windows per entity, emitted once the watermark has passed their end.

    Values are summed in the type they come in; a decimal column gives sums that do not depend on order.
    """
    return (
        stream.withWatermark(time, delay)
        .groupBy(F.window(time, "1 day"), F.col(entity))
        .agg(
            F.count(F.lit(1)).alias("event_count"),
            F.max(value).alias("price_usd"),
            F.sum(value).cast("double").alias("market_cap_usd"),
        )
        .select(
            F.to_date("window.start").alias(DAY), entity, "event_count", "price_usd", "market_cap_usd"
        )
    )


def write_daily_panel(
    panel: DataFrame, sink: str, checkpoint: str, state_partitions: int | None = None
) -> StreamingQuery:
    """Append closed days to ``sink`` with the exactly-once file sink.

    ``state_partitions`` fixes the number of state stores; it is recorded in the checkpoint on
    the first run and kept for later ones.
    """
    conf = panel.sparkSession.conf
    before = conf.get("spark.sql.shuffle.partitions")
    if state_partitions is not None:
        conf.set("spark.sql.shuffle.partitions", str(state_partitions))
    try:
        query = (
            panel.writeStream.format("parquet")
            .outputMode("append")
            .option("path", sink)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
    finally:
        conf.set("spark.sql.shuffle.partitions", before)
    return query


#: Folder of progress notes in a sink of partial days; readers skip names with an underscore.
PROGRESS = "_progress"


def accumulate_panel(
    stream: DataFrame, time: str, entity: str, value: str, sink: str, checkpoint: str, delay: str = "1 day"
) -> StreamingQuery:
    """Daily panel that loses no row however late it comes.

    Every micro-batch is reduced to one partial row per day and entity and stored under (day, batch); ``accumulated_panel``
    adds the partials up, so a row of a closed day repairs that day. A day is closed once the newest time of earlier
    batches, less ``delay``, has passed its end; rows of closed days are counted as late in their partial. A batch that is
    repeated after a failure overwrites its own partials and its own progress note, from which the next one goes on.
    A row without a time has no day and is left out. Values are summed in the type they come in.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch = batch.where(F.col(time).isNotNull())
        seen = None
        if batch_id > 0:
            seen = spark.read.parquet(f"{sink}/{PROGRESS}/{batch_id - 1}").first()["newest"]
        closed = F.lit(seen).cast("timestamp") - F.expr(f"INTERVAL {delay}")
        late = F.coalesce(F.date_add(F.to_date(time), 1).cast("timestamp") <= closed, F.lit(False))
        partial = batch.groupBy(F.to_date(time).alias(DAY), F.col(entity)).agg(
            F.count(F.lit(1)).alias("event_count"),
            F.count_if(late).alias("late_event_count"),
            F.max(value).alias("price_usd"),
            F.sum(value).alias("market_cap_usd"),
            F.max(time).alias("newest"),
        )
        write_partitions(partial.withColumn(BATCH, F.lit(batch_id)), sink, (DAY, BATCH))
        # Newest time so far, from the partials just written, not from the batch again.
        schema = T.StructType([*partial.schema.fields, T.StructField(BATCH, T.IntegerType())])
        own = spark.read.schema(schema).parquet(sink).where(F.col(BATCH) == batch_id)
        newest = F.greatest(F.max("newest"), F.lit(seen).cast("timestamp")).alias("newest")
        own.agg(newest).coalesce(1).write.mode("overwrite").parquet(f"{sink}/{PROGRESS}/{batch_id}")

    return _run(stream, write, checkpoint)


def accumulated_panel(spark: SparkSession, sink: str, entity: str) -> DataFrame:
    """Rows per day and entity of all partials: event_count, late_event_count, price_usd (max), market_cap_usd (sum)."""
    return (
        spark.read.parquet(sink)
        .groupBy(DAY, entity)
        .agg(
            F.sum("event_count").alias("event_count"),
            F.sum("late_event_count").alias("late_event_count"),
            F.max("price_usd").alias("price_usd"),
            F.sum("market_cap_usd").cast("double").alias("market_cap_usd"),
        )
    )
