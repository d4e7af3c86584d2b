"""Live tail on a stream: stream-static join with the subscriptions, buffer cap per micro-batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from driftlog.operators.tail import BUFFER_SIZE, tail_fanout


def tail_stream(entries: DataFrame, subscriptions: DataFrame, deliver: Callable[[DataFrame, int], None],
                checkpoint: str, cap: int = BUFFER_SIZE, available_now: bool = False) -> StreamingQuery:
    """Each micro-batch is one delivery round: at most ``cap`` tenant-matched entries per
    subscriber, then the filters; ``deliver(frames_df, batch_id)`` receives the frames."""

    def body(df: DataFrame, batch_id: int) -> None:
        out = tail_fanout(df.withColumn("__round", F.lit(batch_id)), subscriptions, cap=cap, round_col="__round")
        deliver(out.drop("__round"), batch_id)

    w = entries.writeStream.option("checkpointLocation", checkpoint).foreachBatch(body)
    if available_now:
        w = w.trigger(availableNow=True)
    return w.start()
