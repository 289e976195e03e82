"""Incremental runs of the batch pipelines over a stream source.

The labelling and stance work has no cross-row state (vocabulary, head and
templates are fixed inputs), so a stream is handled micro-batch by
micro-batch with ``foreachBatch``: each batch runs the same DataFrame plan as
a batch job and is written to its own ``epoch=<id>`` folder with overwrite,
which makes a replayed batch idempotent.
"""

from .micro_batch import run_per_batch, stance_stream, tag_stream

__all__ = ["run_per_batch", "stance_stream", "tag_stream"]
