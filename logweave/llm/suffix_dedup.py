"""Exact substring dedup by merging shard Burrows-Wheeler transforms.

A byte is removed when a ``WINDOW``-byte string that covers it also starts anywhere else.

1. Documents with equal texts are one class; only one of them goes on.  (Each byte of a
   class of several, at least ``WINDOW`` bytes long, is repeated.)
2. Every window has one *anchor*, the smallest hash of its ``ANCHOR``-byte strings, so
   equal windows have equal anchors at the same place.  Neighbouring windows with one
   anchor form a *segment*: a run of windows, its bytes, and the hash of these bytes.
3. Segments are dealt by anchor.  A segment whose anchor occurs nowhere else has no
   repeated window; segments with equal bytes are repeated whole.  Only segments that
   share an anchor but not all bytes remain (edges of copied passages, edited copies).
4. Each task takes the remaining segments of its anchors in shards, sorts the rotations
   of each shard and keeps its Burrows-Wheeler transform.  The transforms are merged by
   interleave refinement: from an interleave that is right for the first k bytes, one
   stable distribution by the preceding s bytes gives the one right for k + s bytes; suffixes
   are not sorted again.  s is 8 or 4 where these bytes take at most 65,536 values, else 2.  Boundaries that appear in a round carry their common
   prefix length; the intervals left after ``WINDOW`` bytes are the repeated strings.

Equality of segments in step 3 rests on two 64-bit hashes (anchor and bytes).

Defined cases: null texts are empty; texts shorter than ``WINDOW`` bytes keep all; ids may
be null or repeated (documents are told apart by their texts); repeated rows are copies of
each other; empty tables work; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweave.llm.common import cut_table, small_side, span_hashes, task_count, text_bytes, text_chunks

U = np.uint64
WINDOW = 200
ANCHOR = 64
SEGMENTS_PER_TASK = 1_000_000
BYTES_PER_TASK = 1_500_000
#: Bytes of whole anchors that are transformed together, so that a round works in the processor's cache.
SLICE_BYTES = 60_000
SHARDS = 2
#: No UTF-8 text holds this byte; it ends every string of a transform.
END = 255
BROADCAST_DOCS = 300_000


# ------------------------------------------------------------------ anchors and segments
def _sliding_min(key: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours, from block-wise running minima of both directions."""
    n = len(key)
    blocks = -(-n // width)
    pad = np.full(blocks * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    pad[:n] = key
    grid = pad.reshape(blocks, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n - width + 1], ahead[width - 1:n])


def segments(data: np.ndarray, off: np.ndarray, window: int = WINDOW, anchor: int = ANCHOR):
    """(document, start in the text, windows, anchor hash, bytes hash) of the segments of concatenated texts."""
    none = np.zeros(0, dtype=np.int64)
    if len(data) < window:
        return none, none, none, none, none
    pos = np.arange(len(data) - anchor + 1)
    h = span_hashes(data, pos, pos + anchor)
    # Order by half of the hash, then leftmost: a function of the window's bytes alone.
    low = _sliding_min((h >> U(32) << U(32)) | pos.astype(np.uint64), window - anchor + 1)
    owner = (low & U(0xFFFFFFFF)).astype(np.int64)
    size = np.diff(off)
    count = np.maximum(size - window + 1, 0)
    doc = np.repeat(np.arange(len(size)), count)
    first = np.concatenate([[0], np.cumsum(count)])
    s = np.arange(first[-1]) - first[doc] + off[doc]  # starts of the windows inside one text
    if not len(s):
        return none, none, none, none, none
    own = owner[s]
    cut = np.concatenate([[True], (own[1:] != own[:-1]) | (doc[1:] != doc[:-1])])
    at = np.flatnonzero(cut)
    wins = np.diff(np.concatenate([at, [len(s)]]))
    d, start = doc[at], s[at]
    body = span_hashes(data, start, start + wins + window - 1)
    return d, start - off[d], wins, h[own[at]].view(np.int64), body.view(np.int64)


def _segments(window: int, anchor: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0).to_numpy()
            for a, b, data, off in text_chunks(batch, 1):
                d, start, wins, anc, body = segments(data, off, window, anchor)
                # Pre-aggregation: of segments that occur several times here one goes on; all are repeated whole.
                order = np.lexsort((body, anc))
                x, y = anc[order], body[order]
                new = np.ones(len(x), dtype=bool)
                new[1:] = (x[1:] != x[:-1]) | (y[1:] != y[:-1])
                count = np.diff(np.concatenate([np.flatnonzero(new), [len(x)]])) if len(x) else np.zeros(0, int)
                many = np.repeat(count, count) > 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x), pa.array(y), pa.array(keys[a:b][d[order]]), pa.array(start[order].astype(np.int32)),
                     pa.array(wins[order].astype(np.int32)), pa.array(new), pa.array(many)],
                    names=["anchor", "body", "doc", "start", "wins", "first", "many"])

    return run


def _classify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per shared anchor: rows of whole repeats (kind 0) and one row per distinct body of a mixed anchor (1 single, 2 repeated)."""
    cols = [[c.to_numpy(zero_copy_only=False) for c in b.columns] for b in batches]
    if not cols:
        return
    anc, body, doc, start, wins, many = (np.concatenate(x) for x in zip(*cols))
    order = np.lexsort((start, doc, body, anc))
    anc, body, doc, start, wins, many = (x[order] for x in (anc, body, doc, start, wins, many))
    n = len(anc)
    new_a = np.concatenate([[True], anc[1:] != anc[:-1]])
    new_b = new_a | np.concatenate([[True], body[1:] != body[:-1]])
    at_b = np.flatnonzero(new_b)
    size_b = np.diff(np.concatenate([at_b, [n]]))
    repeated = (size_b > 1) | (np.add.reduceat(many.astype(np.int64), at_b) > 0)
    group = np.cumsum(new_a) - 1
    bodies = np.bincount(group[at_b])
    mixed = bodies[group[at_b]] > 1
    whole = np.repeat(repeated, size_b)
    parts = [(np.flatnonzero(whole), np.zeros(int(whole.sum()), np.int8)),
             (at_b[mixed], np.where(repeated[mixed], 2, 1).astype(np.int8))]
    for i, kind in parts:
        for a in range(0, len(i), 100_000):
            j, k = i[a:a + 100_000], kind[a:a + 100_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array(anc[j]), pa.array(body[j]), pa.array(doc[j]), pa.array(start[j]), pa.array(wins[j]), pa.array(k)],
                names=["anchor", "body", "doc", "start", "wins", "kind"])


# ------------------------------------------------------------------ Burrows-Wheeler transforms
class Transform:
    """Sorted rotations of a set of strings (each ended by END) and the eight bytes before each of them as a number."""

    def __init__(self, data: np.ndarray, ends: np.ndarray, depth: int):
        n = len(data)
        size = np.diff(np.concatenate([[0], ends]))
        base = np.repeat(ends - size, size)
        length = np.repeat(size, size)
        inside = np.arange(n) - base

        def ahead(k):
            return base + (inside + k) % length

        rank = data.astype(np.int64)
        k = 1
        while k < depth:  # rank by 2k bytes from ranks by k bytes
            _, rank = np.unique(rank * (n + 256) + rank[ahead(k)], return_inverse=True)
            k *= 2
        self.order = np.argsort(rank, kind="stable")
        word = data.astype(np.uint64)
        for k in (1, 2, 4):
            word = word << U(8 * k) | word[ahead(k)]
        self.before = word[ahead(-8)[self.order]]


def _symbols(transforms: list[Transform], depth: int) -> tuple[int, list[np.ndarray]]:
    """(s, the s bytes before each rotation as 16-bit numbers in their order), one array per transform."""
    ends = np.cumsum([len(t.before) for t in transforms])[:-1]
    before = np.concatenate([t.before for t in transforms])
    for step in (8, 4):
        if depth % step == 0:
            values, rank = np.unique(before & U((1 << 8 * step) - 1), return_inverse=True)
            if len(values) <= 1 << 16:
                return step, np.split(rank.astype(np.uint16), ends)
    return 2, np.split(before.astype(np.uint16), ends)


def merge(transforms: list[Transform], depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(shard, rotation, interval) in merged order after refining the interleave to ``depth`` bytes (even)."""
    total = sum(len(t.order) for t in transforms)
    inter = np.repeat(np.arange(len(transforms), dtype=np.uint8), [len(t.order) for t in transforms])
    interval = np.zeros(total, dtype=np.int32)
    symbols = np.empty(total, dtype=np.uint16)
    change = np.ones(total, dtype=bool)
    width, before = _symbols(transforms, depth)
    for _ in range(depth // width):
        for s, b in enumerate(before):
            symbols[inter == s] = b
        step = np.argsort(symbols, kind="stable")
        inter = inter[step]
        c, g = symbols[step], interval[step]
        np.logical_or(c[1:] != c[:-1], g[1:] != g[:-1], out=change[1:])
        interval = np.cumsum(change, dtype=np.int32)
    rotation = np.empty(total, dtype=np.int64)
    for s, t in enumerate(transforms):
        rotation[inter == s] = t.order
    return inter, rotation, interval


def repeated_windows(strings: list[bytes], shard: np.ndarray, window: int = WINDOW) -> list[np.ndarray]:
    """For each string, which of its windows also start in another string or elsewhere in it."""
    shards = [np.flatnonzero(shard == s) for s in range(int(shard.max()) + 1)]
    shards = [s for s in shards if len(s)]
    transforms, bases = [], []
    for members in shards:
        size = np.array([len(strings[i]) + 1 for i in members])
        data = np.frombuffer(b"".join(strings[i] + bytes([END]) for i in members), np.uint8)
        transforms.append(Transform(data, np.cumsum(size), window))
        bases.append(np.cumsum(size) - size)
    inter, rotation, interval = merge(transforms, window)
    count = np.bincount(interval)
    out: list[np.ndarray] = [np.zeros(0, bool)] * len(strings)
    for s, members in enumerate(shards):
        mine = inter == s
        many = np.zeros(len(transforms[s].order), dtype=bool)
        many[rotation[mine]] = count[interval[mine]] > 1
        for i, base in zip(members, bases[s]):
            out[i] = many[base:base + max(len(strings[i]) - window + 1, 0)]
    return out


def _settle(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anc, doc, start, single, text = [], [], [], [], []
        for b in batches:
            anc.append(b.column(0).to_numpy())
            doc.append(b.column(1).to_numpy())
            start.append(b.column(2).to_numpy())
            single.append(b.column(3).to_numpy() == 1)
            text.extend(b.column(4).to_pylist())
        if not text:
            return
        anc, doc, start, single = (np.concatenate(x) for x in (anc, doc, start, single))
        # Strings with other anchors have no common window: a slice of whole anchors at a time bounds memory.
        order = np.argsort(anc, kind="stable")
        size = np.array([len(text[i]) for i in order])
        edge = np.flatnonzero(np.concatenate([anc[order][1:] != anc[order][:-1], [True]])) + 1  # ends of anchors
        total = np.cumsum(size)
        a = 0
        while a < len(order):
            reach = np.searchsorted(total, SLICE_BYTES + (total[a - 1] if a else 0)) + 1
            b = int(edge[min(np.searchsorted(edge, reach), len(edge) - 1)])
            part = order[a:b]
            a = b
            many = repeated_windows([text[i] for i in part], (doc[part] % SHARDS + SHARDS) % SHARDS, window)
            d, lo, hi = [], [], []
            for i, m in zip(part, many):
                if single[i] and m.any():
                    f = np.diff(np.concatenate([[0], m.view(np.int8), [0]]))
                    x, y = np.flatnonzero(f == 1), np.flatnonzero(f == -1)
                    d.extend([doc[i]] * len(x))
                    lo.extend((start[i] + x).tolist())
                    hi.extend((start[i] + y).tolist())
            yield pa.RecordBatch.from_arrays([pa.array(d, pa.int64()), pa.array(lo, pa.int32()), pa.array(hi, pa.int32())], names=["doc", "lo", "hi"])

    return run


# ------------------------------------------------------------------ operator
def _fetch(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wanted = batch.column(1)
            flat = wanted.flatten()
            anc, start, wins, kind = (flat.field(i).to_numpy() for i in range(4))
            first = np.concatenate([[0], np.cumsum(wanted.value_lengths().to_numpy())])
            docs = batch.column(0).to_numpy()
            data, off = text_bytes(batch.column(2))
            for r in range(batch.num_rows):
                z = slice(first[r], first[r + 1])
                body = data[off[r]:off[r + 1]].tobytes()
                out = [body[s:s + w + window - 1] for s, w in zip(start[z].tolist(), wins[z].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anc[z]), pa.array(np.full(len(out), docs[r])), pa.array(start[z]), pa.array(kind[z]), pa.array(out, pa.binary())],
                    names=["anchor", "doc", "start", "kind", "bytes"])

    return run


def _union(window: int):
    """Byte ranges of each document, merged: window starts [lo, hi) cover bytes [lo, hi + window - 1)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cols = [[c.to_numpy() for c in b.columns] for b in batches]
        if not cols:
            return
        doc, lo, hi = (np.concatenate(x) for x in zip(*cols))
        hi = hi.astype(np.int64) + window - 1
        order = np.lexsort((lo, doc))
        doc, lo, hi = doc[order], lo[order].astype(np.int64), hi[order]
        new_doc = np.concatenate([[True], doc[1:] != doc[:-1]])
        # Running end within a document: shift every document into a range of its own.
        width = int(hi.max()) + 2
        shift = (np.cumsum(new_doc) - 1) * width
        reach = np.maximum.accumulate(hi + shift)
        new = new_doc | np.concatenate([[True], lo[1:] + shift[1:] > reach[:-1]])
        at = np.flatnonzero(new)
        lo, hi, doc = lo[at], np.maximum.reduceat(hi, at), doc[at]
        first = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
        offsets = pa.array(np.concatenate([first, [len(doc)]]).astype(np.int32))
        yield pa.RecordBatch.from_arrays(
            [pa.array(doc[first]), pa.ListArray.from_arrays(offsets, pa.array(lo)), pa.ListArray.from_arrays(offsets, pa.array(hi))],
            names=["key", "lo", "hi"])

    return run


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bytes that stay: (row..., kept, n_removed, n_spans)."""
    for batch in batches:
        for a in range(0, batch.num_rows, 256):
            part = batch.slice(a, 256)
            data, off = text_bytes(part.column(1))
            kept, gone = [], []
            for r, (lo, hi) in enumerate(zip(part.column(2).to_pylist(), part.column(3).to_pylist())):
                body = data[off[r]:off[r + 1]].tobytes()
                cuts = [0, *[x for p in zip(lo, hi) for x in p], len(body)]
                kept.append(b"".join(body[cuts[i]:cuts[i + 1]] for i in range(0, len(cuts), 2)))
                gone.append(len(body) - len(kept[-1]))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array([len(k) + g for k, g in zip(kept, gone)], pa.int64()), pa.array(gone, pa.int64()),
                 part.column(2).value_lengths().cast(pa.int64()), pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()),
                 pa.array(kept, pa.binary())], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])


def repeated_ranges(docs: DataFrame, text: str = "text", window: int = WINDOW, anchor: int = ANCHOR) -> tuple[DataFrame, DataFrame]:
    """((key, lo[], hi[]) merged byte ranges per text key, (key, rows) text keys of several documents)."""
    spark = docs.sparkSession
    t = F.coalesce(F.col(text), F.lit(""))
    base = docs.select(F.xxhash64(t).alias("doc"), F.xxhash64(t, F.lit(1)).alias("check"), t.alias("text")).where(
        F.octet_length("text") >= window)
    classes = cut_table(base.groupBy("doc").agg(
        F.count(F.lit(1)).alias("rows"), F.min("check").alias("c0"), F.max("check").alias("c1"),
        F.sum(F.octet_length("text").cast("long")).alias("bytes")), "texts")
    collided, size = classes.agg(F.coalesce(F.max(F.col("c0") != F.col("c1")), F.lit(False)), F.coalesce(F.sum(F.col("bytes") / F.col("rows")), F.lit(0.0))).first()
    if collided:
        raise RuntimeError("two texts share a 64-bit key")
    copies = cut_table(classes.where("rows > 1").select(F.col("doc").alias("key"), "rows"), "copies")
    n_copies = copies.count()
    single = base.select("doc", "text").join(small_side(copies.select("key"), n_copies), F.col("doc") == F.col("key"), "left_anti")
    one_of = base.select("doc", "text").join(small_side(copies.select("key"), n_copies), F.col("doc") == F.col("key"), "left_semi")
    texts = single.unionAll(one_of.dropDuplicates(["doc"]))
    segs = cut_table(texts.mapInArrow(_segments(window, anchor),
                                      "anchor long, body long, doc long, start int, wins int, first boolean, many boolean"), "segments")
    parts = task_count(spark, int(size) * 2 // (window - anchor + 1), SEGMENTS_PER_TASK)
    shared = segs.where("first").select("anchor", "body", "doc", "start", "wins", "many").repartition(parts, "anchor")
    found = cut_table(shared.mapInArrow(_classify, "anchor long, body long, doc long, start int, wins int, kind byte"), "shared")

    mixed = found.where("kind > 0")
    wanted = mixed.groupBy("doc").agg(F.collect_list(F.struct("anchor", "start", "wins", "kind")).alias("wanted"))
    wanted = cut_table(wanted.withColumnRenamed("doc", "w"), "wanted")
    need = texts.join(small_side(wanted, wanted.count(), BROADCAST_DOCS), F.col("doc") == F.col("w")).select("doc", "wanted", "text")
    strings = need.mapInArrow(_fetch(window), "anchor long, doc long, start int, kind byte, bytes binary")
    volume = mixed.agg(F.coalesce(F.sum(F.col("wins") + window), F.lit(0))).first()[0]
    tasks = task_count(spark, volume, BYTES_PER_TASK)
    edges = strings.repartition(tasks, "anchor").mapInArrow(_settle(window), "doc long, lo int, hi int")

    def as_range(df):
        return df.select("doc", F.col("start").alias("lo"), (F.col("start") + F.col("wins")).alias("hi"))

    ranges = as_range(found.where("kind = 0")).unionAll(as_range(segs.where("many and not first"))).unionAll(edges)
    spans = ranges.repartition(parts, "doc").mapInArrow(_union(window), "key long, lo array<bigint>, hi array<bigint>")
    return cut_table(spans, "ranges"), copies


def dedup_bytes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept (binary, the remaining bytes)."""
    ranges, copies = repeated_ranges(docs, text, window, anchor)
    t = F.coalesce(F.col(text), F.lit(""))
    d = docs.select(F.col(doc_id).alias("doc_id"), t.alias("text"), F.xxhash64(t).alias("doc"))
    # A text of several documents is repeated whole; the others follow their ranges.
    whole = copies.select("key", F.array(F.lit(0).cast("long")).alias("lo"), F.lit(None).cast("array<bigint>").alias("hi"))
    some = whole.unionAll(ranges.join(copies.select(F.col("key").alias("k")), F.col("key") == F.col("k"), "left_anti"))
    some = cut_table(some, "spans")
    j = d.join(small_side(some, some.count(), BROADCAST_DOCS), F.col("doc") == F.col("key"), "left")
    size = F.octet_length("text").cast("long")
    j = j.select("doc_id", "text", "lo", F.when(F.col("lo").isNotNull() & F.col("hi").isNull(), F.array(size)).otherwise(F.col("hi")).alias("hi"))
    none = F.lit(0).cast("long")
    plain = j.where("lo is null").select("doc_id", size.alias("n_bytes"), none.alias("n_removed"), none.alias("n_spans"),
                                         F.sha2("text", 256).alias("kept_sha256"), F.encode("text", "UTF-8").alias("kept"))
    kind = j.schema["doc_id"].dataType.simpleString()
    cut = j.where("lo is not null").mapInArrow(
        _kept, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
    return plain.unionAll(cut)
