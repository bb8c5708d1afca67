"""Per-item average and count, kept up to date as rating files arrive.

The file-stream form of R1's aggregation: new text files in the input
directory are parsed with the same row rules as the batch reports; a
stateful ``groupBy`` keeps one running ``(sum, count)`` per item (the state
grows with the number of items, not with the ratings).  In ``complete`` mode
each micro-batch emits the whole table; ``foreachBatch`` writes it to
``<out>/batch_id=<n>`` with overwrite, so a batch that is replayed after a
failure rewrites the same folder (idempotent), and then deletes the folders
of all earlier batches but the last.  The output so stays at two tables; the
current one is that of the latest batch (``current_item_stats``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ratelens.session import remove_path
from ratelens.sources.ratings import parse_ratings


def start_item_stats(
    spark: SparkSession,
    input_path: str,
    out_dir: str,
    checkpoint_location: str,
    min_fields: int = 4,
    id_type: str = "int",
    max_files_per_trigger: int | None = None,
    available_now: bool = True,
    processing_time: str | None = None,
) -> StreamingQuery:
    """Start the stream; returns the running query.

    ``available_now`` processes what is there (in several batches when
    ``max_files_per_trigger`` is set) and stops; otherwise the query runs on
    a ``processing_time`` trigger until stopped.
    """
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    ratings = parse_ratings(reader.load(input_path), min_fields=min_fields,
                            id_type=id_type)
    sums = ratings.groupBy("movie_id").agg(F.sum("rating").alias("s"),
                                           F.count(F.lit(1)).alias("n"))

    root = out_dir.rstrip("/")

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/batch_id={batch_id}")
        remove_path(spark, f"{root}/batch_id={batch_id - 2}")

    writer = (sums.writeStream.outputMode("complete").foreachBatch(write_batch)
              .option("checkpointLocation", checkpoint_location))
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()


def current_item_stats(spark: SparkSession, out_dir: str) -> DataFrame:
    """``movie_id, avg_rating, n`` as of the latest batch."""
    tables = spark.read.parquet(out_dir)
    last = tables.agg(F.max("batch_id")).first()[0]
    return tables.where(F.col("batch_id") == last).select(
        "movie_id", (F.col("s") / F.col("n")).alias("avg_rating"),
        F.col("n").cast("long").alias("n"))
