"""Incremental bronze ingestion and windowed log metrics on Structured Streaming."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ticketlake.functions import cleanse as X


def ingest_incremental(spark: SparkSession, source: str, schema, target: str, checkpoint: str, key: str, event_time: str, lateness: str = "1 day", lineage: dict | None = None) -> None:
    """Append new files exactly once and drop repeated keys within the lateness window.

    Runs over what is available and stops; the checkpoint remembers files and keys for the next run.
    """
    stream = spark.readStream.schema(schema).parquet(source)
    if dict(stream.dtypes)[event_time] == "timestamp_ntz":
        stream = stream.withColumn(event_time, F.col(event_time).cast("timestamp"))
    unique = stream.withWatermark(event_time, lateness).dropDuplicatesWithinWatermark([key])
    tagged = unique.withColumns({k: F.lit(v) for k, v in (lineage or {}).items()})
    query = (
        tagged.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint)
        .outputMode("append").trigger(availableNow=True).start()
    )
    query.awaitTermination()


#: Step of the row that closes a stream; its own window is never complete, so it never appears in the metrics.
CLOSING = "__closing__"


def closed(events: DataFrame, time: str, step: str, gap: str = "30 days") -> DataFrame:
    """`events` and one later row that moves the watermark past every window, for streams that end."""
    late = events.agg((F.max(time) + F.expr(f"INTERVAL {gap}")).alias(time)).withColumn(step, F.lit(CLOSING))
    return events.unionByName(late, allowMissingColumns=True)


def step_metrics(events: DataFrame, time: str, step: str, value: str, window: str = "1 day", lateness: str | None = None) -> DataFrame:
    """Count, mean, p95 and error share per step and tumbling window; batch or stream."""
    source = events.withWatermark(time, lateness) if lateness else events
    failed = F.get_json_object("props", "$.k").try_cast("int") >= 90
    return source.groupBy(F.window(time, window).alias("w"), F.col(step).alias("step")).agg(
        F.count("*").alias("requests"),
        X.rounded(F.avg(value), 4).alias("avg_value"),
        F.percentile_approx(value, 0.95, 10_000).alias("p95_value"),
        X.ratio(F.count_if(failed), F.count("*")).alias("error_rate"),
    ).select(F.col("w.start").alias("window_start"), "step", "requests", "avg_value", "p95_value", "error_rate")
