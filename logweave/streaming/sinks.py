"""Per-batch sinks (SNK1-SNK6, F4) as ``foreachBatch`` functions and writers.

Every writer keys its output path by ``batch_id``, so a replayed micro-batch
(after a failure) overwrites its own output instead of duplicating it.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _path(base: str, name: str) -> str:
    return base.rstrip("/") + "/" + name


def _consume(df: DataFrame) -> DataFrame:
    """Compute the whole batch once (cached) before showing a prefix of it: a stateful
    upstream must run, and commit its state, on every partition of the batch."""
    df.persist()
    df.count()
    return df


def print_rows(n: int = 10) -> Callable[[DataFrame, int], None]:
    """SNK1: show the first ``n`` rows of every batch (``print()`` defaults to 10)."""
    def fn(df: DataFrame, batch_id: int) -> None:
        print(f"-------- batch {batch_id} --------")
        _consume(df).show(n, truncate=False)
        df.unpersist()
    return fn


def raw_and_counts_json(base: str, key: str = "agent") -> Callable[[DataFrame, int], None]:
    """SNK2 + A4 + F4: non-empty batch -> raw rows and per-``key`` counts as JSON."""
    def fn(df: DataFrame, batch_id: int) -> None:
        try:
            if _consume(df).isEmpty():
                return
            df.write.mode("overwrite").json(_path(base, f"requests_{batch_id}"))
            (df.groupBy(key).agg(F.count(F.lit(1)).alias("count"))
             .write.mode("overwrite").json(_path(base, f"{key}_counts_{batch_id}")))
        finally:
            df.unpersist()
    return fn


def text_per_batch(base: str, prefix: str = "Tweets_", width: int = 10) -> Callable[[DataFrame, int], None]:
    """SNK3 + F4 for ``foreachBatch``: text files per non-empty batch in ``<base>/<prefix><padded batch_id>``, by
    Spark's own committed write.  ``sources.archive.text_batches`` is the sink for plain streams."""
    def fn(df: DataFrame, batch_id: int) -> None:
        try:
            if _consume(df).isEmpty():
                return
            df.select(F.col(df.columns[0]).cast("string")).write.mode("overwrite").text(
                _path(base, f"{prefix}{batch_id:0{width}d}"))
        finally:
            df.unpersist()
    return fn


def latest_per_key(df: DataFrame, key: Sequence[str] | str, order: Sequence[str]) -> DataFrame:
    """Last row per key in ``order`` (partial aggregate, skew-safe)."""
    keys = [key] if isinstance(key, str) else list(key)
    vals = [c for c in df.columns if c not in keys]
    last = F.max_by(F.struct(*vals), F.struct(*order)).alias("_r")
    return df.groupBy(*keys).agg(last).select(*keys, *[F.col(f"_r.{c}").alias(c) for c in vals])


def keyed_table(fmt: str, options: dict, key, order: Sequence[str], columns: Sequence[str] | None = None,
                mode: str = "append") -> Callable[[DataFrame, int], None]:
    """SNK4: write each batch to a keyed store (e.g. a Cassandra table through its connector),
    one row per key (the batch's last), so the store's upsert keeps the newest value."""
    def fn(df: DataFrame, batch_id: int) -> None:
        out = latest_per_key(df, key, order)
        if columns:
            out = out.select(*columns)
        out.write.format(fmt).options(**options).mode(mode).save()
    return fn


def console_complete(df: DataFrame, num_rows: int = 20, truncate: bool = False):
    """SNK5: console sink in complete mode (aggregations only)."""
    return (df.writeStream.outputMode("complete").format("console")
            .option("numRows", num_rows).option("truncate", truncate))


def sql_per_batch(view: str, sql: str, show: int = 20,
                  collect_to: list | None = None) -> Callable[[DataFrame, int], None]:
    """SNK6: register the batch as a temp view, run SQL on it, and show the first rows.

    ``collect_to`` gets (batch_id, frame of the first ``show`` rows) instead."""
    def fn(df: DataFrame, batch_id: int) -> None:
        try:
            _consume(df).createOrReplaceTempView(view)
            res = df.sparkSession.sql(sql)
            if collect_to is not None:
                collect_to.append((batch_id, df.sparkSession.createDataFrame(res.limit(show).collect(), res.schema)))
            else:
                res.show(show, truncate=False)
        finally:
            df.unpersist()
    return fn
