"""The failure report as a stream (C15): failed events and dead letters counted as they come."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from promoflow.streaming.intake_stream import put

FAILURES = "event_id string, failure_class string, source_label string, received_date timestamp, batch_id bigint"
KEY = ["failure_class", "source_label", "day"]


def run_failure_report_stream(spark: SparkSession, failures: str, out: str, checkpoint: str, delay: str = "7 days",
                              max_files_per_trigger: int | None = None) -> None:
    """Count the failures that sinks write under ``failures`` by class, source and day.

    The counts are state of the query, one row a key and day; a day's state goes once the
    receipt times have passed it by ``delay``.  In update mode a micro-batch sends out the
    keys it has changed, with their whole count, under its ``batch_id``.  Receipt times run
    with the stream; a row later than ``delay`` is not counted, and stays in ``failures``.
    """
    r = spark.readStream.schema(FAILURES)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    counts = (r.parquet(failures).withWatermark("received_date", delay)
              .groupBy("failure_class", "source_label", F.window("received_date", "1 day")).agg(F.count("*").alias("n_failed"))
              .select("failure_class", "source_label", F.to_date("window.start").alias("day"), "n_failed"))
    q = (counts.writeStream.outputMode("update").foreachBatch(lambda batch, batch_id: put(batch, out, "report", batch_id))
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()


def read_failure_report(spark: SparkSession, out: str) -> DataFrame:
    """(failure_class, source_label, day, n_failed): the last count of every key."""
    sent = spark.read.schema("failure_class string, source_label string, day date, n_failed bigint, batch_id bigint").parquet(f"{out}/report")
    return sent.groupBy(*KEY).agg(F.max_by("n_failed", "batch_id").alias("n_failed"))
