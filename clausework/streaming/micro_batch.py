"""``foreachBatch`` runners for tagging and stance on ``readStream`` sources."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..session import scratch_path


def run_per_batch(stream: DataFrame, fn: Callable[[DataFrame], DataFrame], sink_path: str,
                  checkpoint_location: str | None = None, fmt: str = "parquet",
                  available_now: bool = False, processing_time: str | None = None) -> StreamingQuery:
    """Apply ``fn`` to every micro-batch and write it to ``sink_path/epoch=<id>``.

    The checkpoint location defaults to a fresh folder below the session's
    shared checkpoint folder.
    """
    spark = stream.sparkSession
    location = checkpoint_location or scratch_path(spark, "stream-checkpoint")

    def write(batch: DataFrame, epoch_id: int) -> None:
        fn(batch).write.mode("overwrite").format(fmt).save(f"{sink_path.rstrip('/')}/epoch={epoch_id}")

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", location)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()


def stance_stream(stream: DataFrame, sink_path: str, **kwargs) -> StreamingQuery:
    """Stance lists for each arriving clause batch (see ``operators.stance.stance``)."""
    from ..operators.stance import stance

    runner = {k: kwargs.pop(k) for k in ("checkpoint_location", "available_now", "processing_time", "fmt")
              if k in kwargs}
    return run_per_batch(stream, lambda b: stance(b, **kwargs), sink_path, **runner)


def tag_stream(stream: DataFrame, head: DataFrame, vocab: DataFrame, sink_path: str, **kwargs) -> StreamingQuery:
    """Pooled tags for each arriving clause batch (see ``plans.pipelines.tag``)."""
    from ..plans.pipelines import tag

    runner = {k: kwargs.pop(k) for k in ("checkpoint_location", "available_now", "processing_time", "fmt")
              if k in kwargs}
    head_rows, vocab_rows = head.count(), vocab.count()
    return run_per_batch(stream, lambda b: tag(b, head, vocab, head_rows=head_rows, vocab_rows=vocab_rows,
                                               **kwargs), sink_path, **runner)
