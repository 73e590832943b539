"""Stage 1's row-local columns on a stream of review files.

Nothing here keeps state: a file's reviews depend on no others, so a stream of files gives the same rows
as one batch over them. The checkpoint remembers which files are done, and the sink's log which of its own
files count, so a run that dies goes on where it stopped, without loss or repeats.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from reviewlens.operators import prepare
from reviewlens.schema import RAW_REVIEWS


def stream_reviews(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Raw reviews from the Parquet files that are or will be in ``path``, as a streaming DataFrame."""
    reader = spark.readStream.schema(RAW_REVIEWS)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def prepared_columns(reviews: DataFrame) -> DataFrame:
    """All row-local columns of a batch or a stream: times, ratio, cleaned texts, lengths, combined
    text and rating class."""
    ready = prepare.prepare_reviews(prepare.epoch_time(reviews))
    return ready.withColumns({"combined_text": prepare.combined_text(), "sentiment_label": prepare.score_label()})


def prepare_stream(spark: SparkSession, path: str, out: str, checkpoint: str, files_per_batch: int | None = None) -> StreamingQuery:
    """Prepare all files that are in ``path`` now and not done yet, and append them to ``out``."""
    prepared = prepared_columns(stream_reviews(spark, path, files_per_batch))
    return (
        prepared.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
