"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logweave.session import checkpoint_dir

#: Most rows a side may have (after a count) to be broadcast; beyond it every join is a shuffle join.
BROADCAST_ROWS = 1_000_000


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"


def cut_table(df: DataFrame, name: str, options: dict | None = None) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back: cuts lineage, survives lost executors."""
    path = new_path(df.sparkSession, name)
    df.write.options(**(options or {})).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_side(df: DataFrame, rows: int, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint when its counted ``rows`` stay within ``limit``, else unchanged (shuffle join)."""
    return F.broadcast(df) if rows <= limit else df


def lower_ascii(c):
    """Lower-case A-Z only; every other character stays."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def code_points(c):
    return F.coalesce(F.length(c), F.lit(0)).cast("long")


def task_count(spark: SparkSession, rows: int, per_task: int) -> int:
    """Partitions for ``rows`` so that none gets much more than ``per_task``, at least the session's setting."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // per_task))


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """Smallest node reachable, for every node of ``edges``: returns (node, component).

    Alternating large-star / small-star steps: each is one grouped minimum plus one
    join, rows never exceed the edges, and O(log n) rounds are written to the shared
    folder to cut lineage.  Stops when a round leaves the edges unchanged (row count
    and an order-free checksum agree).
    """
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u != v").distinct()
    e = cut_table(e, "cc")

    def star(e: DataFrame, large: bool) -> DataFrame:
        both = e.unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else e
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        j = both.join(low, "u")
        if large:  # larger neighbours point at the smallest node around u
            out = j.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        else:  # u and its smaller neighbours point at the smallest one
            out = j.select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(
                low.select("u", F.col("m").alias("v")))
        return out.where("u != v").distinct()

    def state(e: DataFrame):
        return tuple(e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())

    last = state(e)
    for _ in range(max_rounds):
        e = cut_table(star(star(e, True), False), "cc")
        now = state(e)
        if now == last:
            break
        last = now
    else:
        raise RuntimeError("connected_components did not converge")
    nodes = e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.unionAll(nodes.select(F.col("component").alias("node"), "component").distinct())


# ------------------------------------------------------------------ numpy text helpers (inside tasks)
_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1
_powers: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finalizer."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _power_table(n: int, base: int) -> np.ndarray:
    p = _powers.get(base)
    if p is None or len(p) < n:
        p = np.full(max(n, 1 << 16), base, dtype=np.uint64)
        p[0] = 1
        np.multiply.accumulate(p, out=p)
        _powers[base] = p
    return p[:n]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span ``data[s:e]``: polynomial over mixed bytes, aligned by an inverse power."""
    n = len(data) + 1
    fwd = _power_table(n, _BASE)
    inv = _power_table(n, pow(_BASE, -1, 1 << 64))
    lut = mix(np.arange(1, 257, dtype=np.uint64) * _U(0x9E3779B97F4A7C15))
    pre = np.zeros(n, dtype=np.uint64)
    np.cumsum(lut[data] * fwd[:-1], out=pre[1:])
    return mix((pre[ends] - pre[starts]) * inv[starts] + (ends - starts).astype(np.uint64))


def text_bytes(col) -> tuple[np.ndarray, np.ndarray]:
    """Arrow string column -> (bytes, offsets) without copying texts; nulls are empty."""
    import pyarrow as pa
    import pyarrow.compute as pc

    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = pc.fill_null(col, "" if pa.types.is_string(col.type) or pa.types.is_large_string(col.type) else b"")
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    off = np.frombuffer(col.buffers()[1], dtype=np.int64 if wide else np.int32)[col.offset:col.offset + len(col) + 1]
    off = off.astype(np.int64)
    if off[-1] == off[0]:
        return np.zeros(0, dtype=np.uint8), off - off[0]
    data = np.frombuffer(col.buffers()[2], dtype=np.uint8)[off[0]:off[-1]]
    return data, off - off[0]


def text_chunks(batch, text: int, max_bytes: int = 1 << 21):
    """Row ranges of an Arrow batch with about ``max_bytes`` of text each: (first, last, bytes, offsets)."""
    data, off = text_bytes(batch.column(text))
    a, n = 0, len(off) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(off, off[a] + max_bytes, "right")) - 1)
        yield a, min(b, n), data[off[a]:off[min(b, n)]], off[a:min(b, n) + 1] - off[a]
        a = min(b, n)
