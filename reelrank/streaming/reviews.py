"""Score and clean review texts arriving as files.

The reference processes review files in batch; these run the same
operators incrementally. Each text is complete inside one micro-batch,
so no cross-batch state is needed: ``clean_text`` is a stateless
projection (file sink, exactly once), and sentiment is written per epoch
with ``foreachBatch`` into its own ``epoch=<id>`` folder, overwritten on
a retry, so a replayed epoch does not duplicate rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from reelrank.functions.text import clean_text
from reelrank.operators.sentiment import review_sentiment, sentence_scores


def read_text_stream(spark: SparkSession, source_dir: str, schema: str,
                     max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(source_dir)


def clean_text_stream(stream: DataFrame, sink_dir: str, checkpoint_dir: str,
                      key: str = "page_id", column: str = "html",
                      available_now: bool = True) -> StreamingQuery:
    out = stream.select(key, clean_text(column).alias("text"))
    writer = (out.writeStream.format("parquet").option("path", sink_dir)
              .option("checkpointLocation", checkpoint_dir).outputMode("append"))
    writer = writer.trigger(availableNow=True) if available_now else writer
    return writer.start()


def sentiment_stream(stream: DataFrame, lexicon: DataFrame, sink_dir: str, checkpoint_dir: str,
                     available_now: bool = True) -> StreamingQuery:
    """``stream`` has doc_id, text; ``lexicon`` is a static table."""

    def write_epoch(batch: DataFrame, epoch_id: int) -> None:
        texts = batch.select("doc_id", "text")
        scored = review_sentiment(texts, sentence_scores(texts, lexicon))
        scored.write.mode("overwrite").parquet(f"{sink_dir.rstrip('/')}/epoch={epoch_id}")

    writer = (stream.writeStream.foreachBatch(write_epoch)
              .option("checkpointLocation", checkpoint_dir))
    writer = writer.trigger(availableNow=True) if available_now else writer
    return writer.start()
