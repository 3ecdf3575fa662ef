"""Incremental corpus building with Structured Streaming.

New post files landing in a directory are turned into instruction rows micro-batch by
micro-batch.  Every draw is a pure function of ``(id, round, salt)``, so the rows of a
post do not depend on which batch it arrives in: the streamed corpus equals the batch
corpus.  ``foreachBatch`` runs the batch operators (including the topic join) on each
micro-batch and writes the folder of its batch id anew, so a batch that is replayed after a crash
between write and commit replaces its own rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from threadsmith.config import CorpusConfig
from threadsmith.operators.corpus import original_rows


def stream_original_rows(spark: SparkSession, posts_dir: str, schema: str, out_dir: str, checkpoint: str,
                         cfg: CorpusConfig, lexicon: DataFrame | None = None, id_col: str = "id",
                         text_col: str = "text", available_now: bool = True):
    """Start the query; returns the ``StreamingQuery`` (``availableNow`` drains what is
    there and stops)."""
    src = spark.readStream.schema(schema).parquet(posts_dir)

    def emit(batch: DataFrame, batch_id: int) -> None:
        rows = original_rows(batch, cfg, lexicon, id_col=id_col, text_col=text_col)
        rows.write.mode("overwrite").parquet(f"{out_dir.rstrip('/')}/batch_id={batch_id}")

    w = src.writeStream.foreachBatch(emit).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()


def stream_cache_appends(spark: SparkSession, requests_dir: str, schema: str, cache_dir: str, checkpoint: str):
    """K8 as a stream: finished responses are appended to the cache table (readers keep
    the latest version per id)."""
    src = spark.readStream.schema(schema).parquet(requests_dir)
    return (src.writeStream.format("parquet").option("path", cache_dir).option("checkpointLocation", checkpoint)
            .outputMode("append").trigger(availableNow=True).start())
