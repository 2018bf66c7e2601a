"""Incremental fixed-width folder conversion with Structured Streaming.

The source converts every ``.txt`` file of a folder each time it runs.  As a
stream, new report files are picked up once: the text file source tracks
which files it has read in the checkpoint, each micro-batch is parsed with
the same built-in expressions as the batch path, converted rows go to header
CSV folders per batch and input file and rejected lines to a Parquet table by
batch.  The checkpoint pins which files a batch reads and the batch's folders
are overwritten, so a batch that fails and runs again counts each line once.  With
``availableNow`` the query processes what is there and stops, so it can be
scheduled like the batch job but never re-reads a file.

The change-data sync is deliberately *not* offered as a stream: deleting
stale rows needs the full snapshot, which a micro-batch does not have.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendmatch.functions.fixedwidth import CSV_HEADERS, FIELD_ORDER
from spendmatch.sources.fixedwidth import CONVERTED_SUFFIX, keep_rows, parse_lines


def read_report_stream(spark: SparkSession, in_dir: str, pattern: str = "*.txt",
                       max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.format("text").option("pathGlobFilter", pattern)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    df = reader.load(in_dir)
    stem = F.regexp_replace(F.col("_metadata.file_name"), r"\.[^.]*$", "")
    return parse_lines(df.select(stem.alias("file_stem"), "value"), keep=["file_stem", "value"])


def start_conversion(spark: SparkSession, in_dir: str, out_dir: str, rejects_dir: str, checkpoint: str,
                     pattern: str = "*.txt", available_now: bool = True):
    """Start the stream; returns the ``StreamingQuery`` (call ``awaitTermination``)."""
    parsed = read_report_stream(spark, in_dir, pattern)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        # a batch owns its folders: run again after a failure, it replaces what it left
        ok = keep_rows(batch, F.col("is_parsed"), ["file_stem"] + FIELD_ORDER).select(
            F.concat(F.col("file_stem"), F.lit(CONVERTED_SUFFIX)).alias("file_stem"),
            *[F.col(c).alias(h) for c, h in zip(FIELD_ORDER, CSV_HEADERS)])
        ok.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("file_stem").option("header", True).csv(
            f"{out_dir}/batch_id={batch_id}")
        (keep_rows(batch, ~F.col("is_blank") & ~F.col("is_parsed"), ["file_stem", "value"])
              .write.mode("overwrite").parquet(f"{rejects_dir}/batch_id={batch_id}"))

    w = parsed.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
