import hashlib
import random
from collections import Counter

import duckdb
import numpy as np
import pytest

from logweave.llm import suffix_dedup as sd
from logweave.llm.queries import op6_suffix_dedup
from tests.llm.support import DOCS, docs_frame


def brute(rows, w):
    body = [(t or "").encode() for _, t in rows]
    seen = Counter(b[i:i + w] for b in body for i in range(len(b) - w + 1))
    out = []
    for (k, _), b in zip(rows, body):
        gone = np.zeros(len(b) + 1, dtype=int)
        for i in range(len(b) - w + 1):
            if seen[b[i:i + w]] > 1:
                gone[i] += 1
                gone[i + w] -= 1
        gone = np.cumsum(gone)[:len(b)] > 0
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((k, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def result(df, **kw):
    return sorted((tuple(r)[:5] for r in sd.dedup_bytes(df, **kw).collect()), key=str)


@pytest.mark.parametrize("seed,w,a", [(1, 20, 6), (2, 24, 12), (3, 40, 9)])
def test_equals_brute_force(spark, seed, w, a):
    r = random.Random(seed)
    pieces = ["".join(r.choice("abcdé ") for _ in range(r.randrange(5, 120))) for _ in range(25)]
    texts = [None, "", "short", "ab" * 300, "abc" * 90, "x" * 500, "x" * 500]
    for _ in range(120):
        t = "".join(r.choice(pieces) if r.random() < 0.6 else "".join(r.choice("abcdé ") for _ in range(r.randrange(60))) for _ in range(r.randrange(1, 7)))
        texts.append(t)
        if r.random() < 0.3:
            i = r.randrange(len(t) + 1)
            texts.append(t[:i] + r.choice("ab#") + t[i + r.randrange(2):])
    rows = list(enumerate(texts))
    df = spark.createDataFrame([x + (0, "k") for x in rows], "doc_id long, text string, start int, key string")
    assert result(df, window=w, anchor=a) == brute(rows, w)


def test_table_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    rows = duckdb.sql(f"SELECT doc_id, text FROM read_parquet('{sf}/documents.parquet')").fetchall()
    assert sorted((tuple(r) for r in op6_suffix_dedup(spark, sf).collect()), key=str) == brute(rows, 200)


def test_edge_rows(spark):
    assert result(docs_frame(spark)) == brute([r[:2] for r in DOCS], 200)
    assert sd.dedup_bytes(docs_frame(spark).limit(0)).count() == 0


def test_merge_equals_sorting():
    r = np.random.default_rng(4)
    strings = [bytes(r.integers(97, 100, r.integers(30, 90), dtype=np.uint8)) for _ in range(40)]
    shard = np.arange(40) % 3
    w = 10
    seen = Counter(s[i:i + w] for s in strings for i in range(len(s) - w + 1))
    for s, m in zip(strings, sd.repeated_windows(strings, shard, w)):
        assert m.tolist() == [seen[s[i:i + w]] > 1 for i in range(len(s) - w + 1)]


def test_merge_by_longer_contexts_equals_sorting(monkeypatch):
    """Rounds of 8, 4 and 2 bytes; many slices of whole anchors find what one slice finds."""
    import pyarrow as pa
    r = np.random.default_rng(9)
    part = [bytes(r.integers(97, 100, 60, dtype=np.uint8)) for _ in range(6)]
    strings = [b"".join(part[k] for k in r.integers(0, 6, 2)) + bytes(r.integers(97, 123, r.integers(30, 90), dtype=np.uint8)) for _ in range(40)]
    shard = np.arange(40) % 2
    for w, step in ((16, 8), (40, 8), (12, 4), (10, 2)):
        seen = Counter(s[i:i + w] for s in strings for i in range(len(s) - w + 1))
        rows = [np.frombuffer(b"".join(x + bytes([sd.END]) for x, q in zip(strings, shard) if q == k), np.uint8) for k in (0, 1)]
        ends = [np.cumsum([len(x) + 1 for x, q in zip(strings, shard) if q == k]) for k in (0, 1)]
        assert sd._symbols([sd.Transform(d, e, w) for d, e in zip(rows, ends)], w)[0] == step
        for s, m in zip(strings, sd.repeated_windows(strings, shard, w)):
            assert m.tolist() == [seen[s[i:i + w]] > 1 for i in range(len(s) - w + 1)]
    batch = pa.RecordBatch.from_arrays(
        [pa.array([i // 4 for i in range(40)], pa.int64()), pa.array(range(40), pa.int64()), pa.array([0] * 40, pa.int32()),
         pa.array([1] * 40, pa.int8()), pa.array(strings, pa.binary())], names=["anchor", "doc", "start", "kind", "bytes"])

    def settled(size):
        monkeypatch.setattr(sd, "SLICE_BYTES", size)
        out = list(sd._settle(16)(iter([batch])))
        return len(out), sorted(x for b in out for x in zip(*[c.to_pylist() for c in b.columns]))
    # Strings of different anchors never share windows in the operator; here each anchor is judged alone.
    alone = settled(1)
    want = []
    for a in range(10):
        group = strings[4 * a:4 * a + 4]
        seen = Counter(s[i:i + 16] for s in group for i in range(len(s) - 15))
        for k, s in enumerate(group):
            m = [seen[s[i:i + 16]] > 1 for i in range(len(s) - 15)] + [False]
            cuts = [i for i in range(len(m)) if m[i] != (i > 0 and m[i - 1])]
            want += [(4 * a + k, x, y) for x, y in zip(cuts[::2], cuts[1::2])]
    assert alone == (10, sorted(want)) and settled(10**9)[0] == 1
