"""SNK4: a keyed table with upserts, as versioned hash buckets of Parquet files.

A key lives in one of ``buckets`` buckets.  An upsert reads and rewrites only the buckets its
batch touches: the batch's newest row per key meets the bucket's rows, the newest by ``order``
stays (the later batch on ties), and the result is written as a new version of these buckets.
A manifest per batch names the version of every bucket; it is written last, by one committed
write, and readers take the latest complete one.  The latest batch, when it runs again, starts from the
manifest before it and writes the same version again, so nothing is applied twice;
older batches are refused.

``<root>/data/v=<batch>/bucket=<b>/*.parquet``, ``<root>/manifest/v=<batch>``.  All files go
through Spark, so any store it can write will do.  One writer per table.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logweave.streaming.jobs import load_state, save_state

BUCKETS = 64


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _versions(spark: SparkSession, root: str) -> list[int]:
    """Batches with a complete manifest, oldest first."""
    fs, p = _fs(spark, f"{root}/manifest")
    if not fs.exists(p):
        return []
    found = [s.getPath() for s in fs.listStatus(p) if s.isDirectory()]
    done = [q for q in found if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(q, "_SUCCESS"))]
    return sorted(int(q.getName().removeprefix("v=")) for q in done)


def _manifest(spark: SparkSession, root: str, before: int | None = None) -> dict | None:
    held = [v for v in _versions(spark, root) if before is None or v < before]
    return load_state(spark, f"{root}/manifest/v={held[-1]}") if held else None


def _rows(spark: SparkSession, root: str, manifest: dict, only=None) -> DataFrame | None:
    paths = [f"{root}/data/v={v}/bucket={b}" for b, v in manifest["buckets"].items() if only is None or int(b) in only]
    return spark.read.schema(manifest["schema"]).parquet(*paths) if paths else None


def read_table(spark: SparkSession, root: str, before: int | None = None) -> DataFrame | None:
    """The table after the latest batch (the latest one before ``before``); None when there is none."""
    m = _manifest(spark, root, before)
    return None if m is None else _rows(spark, root, m)


def upsert(df: DataFrame, root: str, key: Sequence[str] | str, order: Sequence[str], batch_id: int,
           buckets: int = BUCKETS, keep: int = 2) -> int:
    """Applies a batch; returns the number of buckets it touched.  Null keys are a key of their own.

    Versions that none of the last ``keep`` manifests names are removed.
    """
    spark, keys = df.sparkSession, [key] if isinstance(key, str) else list(key)
    if batch_id < max(_versions(spark, root), default=batch_id):
        raise ValueError("only the latest batch can run again: what older ones started from is gone")
    before = _manifest(spark, root, batch_id)
    if before and (before["n"], before["keys"]) != (buckets, keys):
        raise ValueError(f"the table has {before['n']} buckets of {before['keys']}")
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")
    vals = [c for c in df.columns if c not in keys]

    def newest(rows: DataFrame) -> DataFrame:
        last = F.max_by(F.struct(*vals, "_later"), F.struct(*order, "_later")).alias("_r")
        return rows.groupBy(*keys).agg(last).select(*keys, *[F.col(f"_r.{c}").alias(c) for c in vals])

    df.persist()
    try:
        touched = [r[0] for r in df.select(bucket.alias("b")).distinct().collect()]  # at most ``buckets`` numbers
        held = dict(before["buckets"]) if before else {}
        if touched:
            rows = df.withColumn("_later", F.lit(1))
            old = _rows(spark, root, before, set(touched)) if before else None
            if old is not None:
                rows = rows.unionByName(old.withColumn("_later", F.lit(0)))
            out = newest(rows).select(*df.columns).withColumn("bucket", bucket)
            out.repartition(min(buckets, len(touched)), "bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{root}/data/v={batch_id}")
            held.update({str(b): batch_id for b in touched})
    finally:
        df.unpersist()
    save_state(spark, f"{root}/manifest/v={batch_id}", {
        "buckets": held, "n": buckets, "keys": keys, "schema": ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)})
    _vacuum(spark, root, keep)
    return len(touched)


def _vacuum(spark: SparkSession, root: str, keep: int) -> None:
    held = _versions(spark, root)
    for v in held[:-keep]:
        fs, p = _fs(spark, f"{root}/manifest/v={v}")
        fs.delete(p, True)
    used = {(str(v), b) for m in held[-keep:] for b, v in load_state(spark, f"{root}/manifest/v={m}")["buckets"].items()}
    fs, p = _fs(spark, f"{root}/data")
    for d in fs.listStatus(p) if fs.exists(p) else []:
        v = d.getPath().getName().removeprefix("v=")
        for b in fs.listStatus(d.getPath()):
            name = b.getPath().getName()
            if name.startswith("bucket=") and (v, name.removeprefix("bucket=")) not in used:
                fs.delete(b.getPath(), True)


def keyed_upserts(root: str, key, order: Sequence[str], columns: Sequence[str] | None = None,
                  buckets: int = BUCKETS) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` form: every batch is merged into the table at ``root``."""
    def fn(df: DataFrame, batch_id: int) -> None:
        upsert(df.select(*columns) if columns else df, root, key, order, batch_id, buckets)
    return fn
