"""Loads driven by Structured Streaming micro-batches.

A load takes a batch DataFrame, so a stream applies it per micro-batch with
``foreachBatch``.  Each call runs the same one-plan load as a batch job on
the rows of that micro-batch.

What a replay of a micro-batch after a failure does: rows with complete keys
are safe, since keyed appends find them in the target and SCD1 / SCD2 find the
target already changed.  Rows with NULL keys, and appends without keys, match
nothing by definition, so a replay writes them again, unless ``stream`` names
the stream: then an epoch that was applied is recognised and passed over.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from tidemark.plans.jobs import run_load


def load_each_batch(spec: dict, batch_id: str | None = None, as_of=None, root: str | None = None,
                    on_stats: Callable[[int, dict], None] | None = None, stream: str | None = None):
    """A ``foreachBatch`` function applying ``spec`` to every micro-batch.

    ``batch_id`` defaults to the stream's epoch id; ``on_stats`` receives
    (epoch_id, counters) after each batch.  ``stream`` is a name that stays
    with the stream's checkpoint: epochs count from 0 in each checkpoint."""

    def apply(batch: DataFrame, epoch_id: int) -> None:
        tag = f"{stream}|{spec.get('name')}|{epoch_id}" if stream else None
        stats = run_load(batch.sparkSession, spec, batch, batch_id or str(epoch_id), as_of, root, tag)
        if on_stats is not None and stats is not None:
            on_stats(epoch_id, stats)

    return apply
