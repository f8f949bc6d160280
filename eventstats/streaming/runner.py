"""Run a stream through a batch function."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming.query import StreamingQuery


def run_stream(
    stream: DataFrame,
    on_batch: Callable[[DataFrame, int], None],
    checkpoint: str,
    interval: str | None = None,
    output_mode: str = "append",
    compact: Callable[[int], None] | None = None,
    compact_every: int = 100,
) -> StreamingQuery:
    """Start the stream; progress is kept in ``checkpoint``, so a restart goes on from there.

    With an ``interval`` ("15 seconds") the query runs until stopped. Without one it works
    off what is there and this call returns when that is done.

    After every ``compact_every`` batches ``compact`` is called with the number of the batch
    before the one just done: fold tables up to it, and remove what older folds replaced. Then
    a batch lists and reads a bounded number of directories however long the stream has run.
    """

    def step(batch: DataFrame, batch_id: int) -> None:
        on_batch(batch, batch_id)
        if compact and batch_id and batch_id % compact_every == 0:
            compact(batch_id - 1)

    writer = (
        stream.writeStream.foreachBatch(step)
        .option("checkpointLocation", checkpoint)
        .outputMode(output_mode)
    )
    if interval:
        return writer.trigger(processingTime=interval).start()
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query
