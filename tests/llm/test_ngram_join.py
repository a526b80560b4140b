import random
import re
import tracemalloc

import numpy as np
import pytest

from logweave.llm import ngram_join as nj


def brute_sets(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(rows):
    sets = [brute_sets(t) for _, t in rows]
    comp = [i for i, _ in rows]
    pos = list(range(len(rows)))

    def root(i):
        while pos[i] != i:
            i = pos[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            x, y = sets[i], sets[j]
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                pos[root(i)] = root(j)
    best = {}
    for i in range(len(rows)):
        best[root(i)] = min(best.get(root(i), comp[i]), comp[i])
    return {(rows[i][0], len(sets[i]), best[root(i)]) for i in range(len(rows))}


def corpus(seed, n):
    r = random.Random(seed)
    vocab = [f"w{i}" for i in range(40)] + ["Ünï", "A", "b."]
    texts = [None, "", " \t\n", "one", "ONE", "a b c d", "a b\tc\x0bd", "x " * 4000]
    while len(texts) < n:
        if texts and r.random() < 0.6:
            w = (r.choice(texts[5:]) or "").split()
            for _ in range(r.choice([0, 0, 1, 1, 2, 3, 6])):
                if w:
                    w[r.randrange(len(w))] = r.choice(vocab)
            if r.random() < 0.3:
                w = w[r.randrange(3):]
            texts.append(" ".join(w))
        else:
            texts.append(" ".join(r.choice(vocab) for _ in range(r.choice([3, 6, 7, 9, 12, 20, 40, 90, 200]))))
    return [(i * 3 + 1, t) for i, t in enumerate(texts)]


def test_sets_are_made_in_pieces(monkeypatch):
    """2 MB of texts take less than 30 MB of arrays; pieces change no set."""
    r = random.Random(3)
    texts = [" ".join(str(r.randrange(10 ** 6)) for _ in range(r.choice([0, 1, 4, 5, 300, 600]))).encode() for _ in range(2000)]
    data, off = np.frombuffer(b"".join(texts), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    assert len(data) > 2_000_000
    nj.shingle_sets(data, off)
    tracemalloc.start()
    sets, so = nj.shingle_sets(data, off)
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert peak < 30e6
    monkeypatch.setattr(nj, "PIECE", len(data))
    whole, wo = nj.shingle_sets(data, off)
    assert np.array_equal(sets, whole) and np.array_equal(so, wo)


@pytest.mark.parametrize("seed", [1, 2])
def test_components_equal_brute_force(spark, seed):
    rows = corpus(seed, 220)
    df = spark.createDataFrame([(i, t, "x", 0) for i, t in rows], "doc_id long, text string, sig string, n int")
    got = {(r.doc_id, r.n_shingles, r.component_id) for r in nj.jaccard_classes(df).collect()}
    assert got == brute(rows)


def test_every_qualifying_pair_shares_a_signature():
    r = np.random.default_rng(5)
    for size in list(range(1, 30)) + [60, 150, 400]:
        for _ in range(30):
            x = np.unique(r.integers(0, 1 << 63, size, dtype=np.uint64) * np.uint64(2))
            drop = r.integers(0, len(x) // 5 + 1)
            y = np.delete(x, r.choice(len(x), drop, replace=False))
            room = int(len(x) / 0.8) - len(x)
            y = np.unique(np.concatenate([y, r.integers(0, 1 << 63, r.integers(0, room + 1), dtype=np.uint64)]))
            both = len(np.intersect1d(x, y))
            if 100 * both < 80 * (len(x) + len(y) - both):
                continue
            assert nj.sketch_difference(nj.parity_sketch(x), nj.parity_sketch(y)) <= nj.max_difference(len(x) + len(y))
            s, d = nj.signatures(np.concatenate([x, y]), np.array([0, len(x), len(x) + len(y)]))
            assert set(s[d == 0]) & set(s[d == 1]), (len(x), len(y), both)


def test_edge_tables(spark):
    schema = "doc_id long, text string, id long"
    assert nj.jaccard_classes(spark.createDataFrame([], schema)).count() == 0
    df = spark.createDataFrame([(None, "a b c d e f", 1), (7, "a b c d e f", 1), (7, "a b c d e f", 2), (9, None, 3)], schema)
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in nj.jaccard_classes(df).collect()), key=str)
    assert got == [(7, 2, 7), (7, 2, 7), (9, 0, 9), (None, 2, None)]


def brute_of_ids(rows):
    """Components by brute force where rows of one id with words belong together."""
    sets = [brute_sets(t) for _, t in rows]
    pos = list(range(len(rows)))

    def root(i):
        while pos[i] != i:
            i = pos[i]
        return i
    for i, x in enumerate(sets):
        for j, y in enumerate(sets[:i]):
            if x and y and (rows[i][0] == rows[j][0] or 100 * len(x & y) >= 80 * len(x | y)):
                pos[root(i)] = root(j)
    best = {}
    for i in range(len(rows)):
        best[root(i)] = min(best.get(root(i), rows[i][0]), rows[i][0])
    return sorted((rows[i][0], len(sets[i]), best[root(i)]) for i in range(len(rows)))


def test_an_id_on_rows_with_different_texts(spark):
    a, b = " ".join(f"a{i}" for i in range(60)), " ".join(f"b{i}" for i in range(60))
    rows = [(7, a), (7, b), (3, a + " x"), (2, b + " y"), (9, b + " z"), (7, None), (7, a), (5, "alone"), (11, "c d e f g h"), (11, "c d e f g h")]
    rows += [(i % 150 + 20, t) for i, t in corpus(3, 160)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in nj.jaccard_classes(df).collect())
    assert got == brute_of_ids(rows)
    assert {c for i, n, c in got if i in (2, 3, 7, 9) and n} == {2}
    lost = spark.createDataFrame([(None, a), ((1 << 62) + 5, a), ((1 << 62) + 5, b)], "doc_id long, text string")
    assert {r.component_id for r in nj.jaccard_classes(lost).collect()} == {None, (1 << 62) + 5}


def test_pairs_of_many_groups_are_compared_at_once(monkeypatch):
    """Every pair of a signature is met once, whatever the blocks; widths differ within a group."""
    import numpy as np
    import pyarrow as pa
    r = np.random.default_rng(6)
    base = r.integers(0, 1 << 63, 90, dtype=np.uint64) << np.uint64(1)
    rows = []
    for sig in range(40):
        for _ in range(int(r.integers(1, 9))):
            u = np.unique(r.choice(base, int(r.integers(24, 88)), replace=False))
            rows.append((sig, int(r.integers(0, 200)), int(r.integers(0, 5)), len(u), nj.parity_sketch(u)))
    r.shuffle(rows)
    rows = [(int(s), int(i), int(c), int(n), bytes(k)) for s, i, c, n, k in rows]
    want = sorted((a[1], b[1]) for x, a in enumerate(rows) for y, b in enumerate(rows) if x != y and a[0] == b[0] and a[1] < b[1] and a[2] != b[2]
                  and 100 * min(a[3], b[3]) >= 80 * max(a[3], b[3]) and nj.sketch_difference(a[4], b[4]) <= nj.max_difference(a[3] + b[3]))
    assert want
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=["sig", "id", "comp", "n", "sketch"])
    for pairs, size in ((200_000, 4 << 20), (7, 1), (1, 64)):
        monkeypatch.setattr(nj, "CROSS_PAIRS", pairs)
        monkeypatch.setattr(nj, "CROSS_BYTES", size)
        got = [p for b in nj._cross(iter([batch.slice(0, 50), batch.slice(50)])) for p in zip(*[c.to_pylist() for c in b.columns])]
        assert sorted(got) == want
    assert list(nj._cross(iter([]))) == []
