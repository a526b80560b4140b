import tracemalloc

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from logweave.llm import embed_dedup as ed
from logweave.llm import hnsw
from logweave.llm.queries import op8_embeddings


def brute(ids, vecs, threshold=0.9):
    ok = [v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v) for v in vecs]
    parent = list(range(len(ids)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    deg = [0] * len(ids)
    for i in range(len(ids)):
        for j in range(i):
            if ok[i] and ok[j] and len(vecs[i]) == len(vecs[j]):
                a, b = np.array(vecs[i], float), np.array(vecs[j], float)
                if a @ b / np.sqrt((a @ a) * (b @ b)) >= threshold:
                    deg[i] += 1
                    deg[j] += 1
                    parent[root(i)] = root(j)
    low = {}
    for i, v in enumerate(ids):
        low[root(i)] = min(low.get(root(i), v), v)
    return {(ids[i], deg[i], low[root(i)], ids[i] == low[root(i)]) for i in range(len(ids))}


def test_table_against_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    rows = duckdb.sql(f"SELECT vec_id, embedding FROM read_parquet('{sf}/embeddings.parquet')").fetchall()
    want = brute([r[0] for r in rows], [r[1] for r in rows])
    got = {tuple(r) for r in op8_embeddings(spark, sf).collect()}
    assert len(got & want) >= 0.99 * len(want)
    assert sum(r[1] for r in got) >= 0.97 * sum(r[1] for r in want)


def test_edge_vectors_and_groups(spark):
    r = np.random.default_rng(3)
    base = r.normal(size=(6, 16))
    vecs = [list(map(float, b + 0.05 * r.normal(size=16))) for b in base for _ in range(25)]
    vecs += [None, [], [0.0] * 16, [None] + [1.0] * 15, [float("nan")] * 16, [float("inf")] + [0.0] * 15, [1.0, 2.0], [2.0, 4.0]]
    vecs += [vecs[0]] * 30
    rows = [(i + 100, v, 0, "x") for i, v in enumerate(vecs)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, shard int, v string")
    want = brute([x[0] for x in rows], vecs)
    assert {tuple(x) for x in ed.near_duplicates(df).collect()} == want
    null = spark.createDataFrame([(None, [1.0, 0.0]), (5, [1.0, 0.0]), (5, [1.0, 0.0])], "vec_id long, embedding array<double>")
    got = sorted((tuple(x) for x in ed.near_duplicates(null).collect()), key=str)
    assert got == [(5, 1, 5, True), (5, 1, 5, True), (None, 0, None, None)]
    assert ed.near_duplicates(null.limit(0)).count() == 0


def _planted(spark, sizes, alone):
    """Groups of such sizes far apart and lone vectors; (rep, dim, v)."""
    r = np.random.default_rng(8)
    vecs = [b + 0.03 * r.normal(size=32) for n in sizes for b in [r.normal(size=32)] for _ in range(n)]
    vecs += list(r.normal(size=(alone, 32)))
    rows = [(i, 32, list(map(float, v))) for i, v in enumerate(vecs)]
    return spark.createDataFrame(rows, "rep long, dim int, v array<double>").repartition(4)


def test_audit_is_never_empty_and_weighs_probes(spark):
    _, alone = ed.near_links(_planted(spark, [], 600), shard_rows=200)
    assert alone.linked == 0 and alone.probes > 200 and alone.neighbours >= 0.97
    _, lost = ed.near_links(_planted(spark, [], 600), beam=1, min_recall=0.0, shard_rows=200)
    assert lost.neighbours < 0.5  # a search that finds too little is seen without any link
    _, planted = ed.near_links(_planted(spark, [1500, 200] + [3] * 100 + [2] * 200, 1000), shard_rows=1000)
    print(planted)
    assert planted.linked > 50 and planted.links >= 0.97 and planted.neighbours > 0.5


def _peak_mb(f):
    """(result, MB that numpy and Python took at once)"""
    tracemalloc.start()
    try:
        return f(), tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def _unit(x):
    return (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)


def test_memory_of_a_wide_graph_and_of_a_large_group():
    r = np.random.default_rng(2)
    wide = _unit(r.normal(size=(1200, 1024)))
    _, mb = _peak_mb(lambda: hnsw.build(wide))
    assert mb < 60  # the vectors themselves take 5
    # A group of 2,500 is found whole though its beams are far too large for all rows at once.
    group = _unit(r.normal(size=32) + 0.03 * r.normal(size=(2500, 32)))
    g = hnsw.build(np.concatenate([group, _unit(r.normal(size=(500, 32)))]))
    (rows, nodes), mb = _peak_mb(lambda: g.search(group[:300], 32, 0.9))
    want = group[:300] @ group.T >= 0.9
    got = np.zeros((300, 3000), dtype=bool)
    got[rows, nodes] = True
    assert got[:, :2500][want].mean() > 0.99 and len(rows) == got.sum()
    assert mb < 2.5 * (rows.nbytes + nodes.nbytes) + 16


def test_a_task_holds_one_turn_of_graphs_and_puts_links_out_in_pieces(spark, monkeypatch):
    taken = []
    one = ed._packed
    monkeypatch.setattr(ed, "HELD_BYTES", 1)
    monkeypatch.setattr(ed, "PART_BYTES", 2048)
    monkeypatch.setattr(ed, "_packed", lambda *a: taken.append(one(*a)) or taken[-1])
    r = np.random.default_rng(4)
    vecs = [list(map(float, v)) for dim in (8, 16) for b in r.normal(size=(5, dim)) for v in b + 0.05 * r.normal(size=(20, dim))]
    rows = list(enumerate(vecs))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    want = brute([x[0] for x in rows], vecs)
    assert {tuple(x) for x in ed.near_duplicates(df).collect()} == want
    # Every graph goes out once, however many vectors are searched, with the vectors of its shard alone.
    assert len(taken) == 8 and sum(len(np.frombuffer(g[1], np.int64)) for g in taken) == 200


@pytest.mark.parametrize("clash", [False, True])
def test_single_precision_and_clashing_digests(spark, monkeypatch, clash):
    if clash:
        monkeypatch.setattr(ed, "_digest", lambda v: F.size(v).cast("long"))
    vecs = [[0.0, 1.0, 0.5], [-0.0, 1.0, 0.5], [0.0, 1.0, 0.5], [0.1, 1.0, 0.5], [1.0, 0.0, 0.0], [1.0, -0.0, 0.0], [0.0, 0.0, 1.0], [3.0, 1.0], None]
    rows = list(enumerate(vecs))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert ed.valid_vectors(df, "vec_id", "embedding").schema["v"].dataType.simpleString() == "array<float>"
    assert {tuple(x) for x in ed.near_duplicates(df).collect()} == brute([x[0] for x in rows], vecs)
