"""logweave: web-access-log, short-text and event-stream analytics on Spark.

Every operator is a ``DataFrame -> DataFrame`` function built from built-in
Spark columns, aggregates and window functions.  The same function accepts a
bounded table and, where Spark allows it, a Structured Streaming frame.
Actions only happen in sinks (``logweave.streaming.sinks``), in the iterative
ML trainers and in the alarm fold's doubling loop.
"""

from logweave.session import get_spark, checkpoint_dir

__all__ = ["get_spark", "checkpoint_dir"]
