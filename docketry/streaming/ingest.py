"""Resumable ingest: new text files become lines of a merged table as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.segment import split_lines


def text_stream(spark: SparkSession, path: str) -> DataFrame:
    """(path, text, modified) of text files, each read whole once."""
    return spark.readStream.format("text").option("wholetext", "true").load(path).select(F.input_file_name().alias("path"), F.col("value").alias("text"))


def ingest_lines(stream: DataFrame, out: str, checkpoint: str, available_now: bool = True):
    """Append the lines of new files under out; a batch that is run again writes its own folder again."""

    def batch(df: DataFrame, number: int) -> None:
        split_lines(df, "path").write.mode("overwrite").parquet(f"{out}/batch={number}")

    writer = stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
