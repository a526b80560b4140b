"""Starting stream queries (W1, CK1).

Every query needs a checkpoint location (offsets, state store, sink commits), so it
is a required argument here; the micro-batch interval is a processing-time trigger
(the reference uses 1 s, 2 s and 10 s batches).  ``available_now`` drains what is
there and stops, which is what tests and backfills use.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery


def start(df: DataFrame, checkpoint: str, *, foreach_batch: Callable[[DataFrame, int], None] | None = None,
          fmt: str | None = None, path: str | None = None, mode: str = "append", interval: str = "1 second",
          available_now: bool = False, name: str | None = None, options: dict | None = None) -> StreamingQuery:
    if not checkpoint:
        raise ValueError("a checkpoint location is required")
    w = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    if name:
        w = w.queryName(name)
    for k, v in (options or {}).items():
        w = w.option(k, v)
    if foreach_batch is not None:
        w = w.foreachBatch(foreach_batch)
    elif fmt:
        w = w.format(fmt)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=interval)
    return w.start(path) if path else w.start()
