"""AL4: source and query health events from a ``StreamingQueryListener``.

The reference reports receiver errors, stops and starts; Structured Streaming
has no receivers, so the same signals come from query start, progress (a batch
with zero input rows, or a source reporting an error) and termination with an
exception.
"""

from __future__ import annotations

from collections import deque

from pyspark.sql.streaming import StreamingQueryListener


class HealthListener(StreamingQueryListener):
    """Records ('started' | 'idle' | 'progress' | 'stopped' | 'error', query name, detail)."""

    def __init__(self, printer=print, keep: int = 1000):
        self.events: deque[tuple[str, str | None, str]] = deque(maxlen=keep)  # the latest ones
        self._print = printer

    def _emit(self, kind: str, name, detail: str) -> None:
        self.events.append((kind, name, detail))
        if self._print:
            level = "ALERT" if kind in ("error", "stopped") else "INFO"
            self._print(f"{level}: query {kind}: {name or ''} {detail}".rstrip())

    def onQueryStarted(self, event) -> None:
        self._emit("started", event.name, str(event.id))

    def onQueryProgress(self, event) -> None:
        p = event.progress
        rows = p.numInputRows
        self._emit("idle" if rows == 0 else "progress", p.name, f"batch={p.batchId} rows={rows}")

    def onQueryIdle(self, event) -> None:
        self._emit("idle", None, str(event.id))

    def onQueryTerminated(self, event) -> None:
        if event.exception:
            self._emit("error", None, event.exception.splitlines()[0])
        else:
            self._emit("stopped", None, str(event.id))


class AfterBatch(StreamingQueryListener):
    """Calls ``fn(batch_id)`` once for every committed batch of the query named ``name``, in order.

    What a batch left in the state can be read only once it is committed, so not inside its sink.
    Errors of ``fn`` are kept in ``errors`` (a listener cannot fail its query)."""

    def __init__(self, name: str, fn):
        self.name, self.fn = name, fn
        self.done = -1
        self.errors: deque[Exception] = deque(maxlen=100)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if p.name != self.name or p.batchId <= self.done:
            return
        self.done = p.batchId
        try:
            self.fn(p.batchId)
        except Exception as e:
            self.errors.append(e)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def attach(spark, listener: HealthListener | None = None) -> HealthListener:
    listener = listener or HealthListener()
    spark.streams.addListener(listener)
    return listener
