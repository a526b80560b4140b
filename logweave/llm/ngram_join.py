r"""N-gram Jaccard join by universe partition, pigeonhole and one-deletion neighbourhoods.

A document's set holds the 64-bit hashes of its distinct word 5-grams.  Two sets of sizes
a >= b with 100 * |x & y| >= 80 * |x | y| differ in at most floor((a + b) / 9) elements.
Sizes are cut into bands; in the band of the larger set that bound is H, and the hash
universe is cut into m = H + 1 ranges ("segments"), so one segment of x and y at least
agrees.  An agreement on an *empty* segment would match almost everything, which makes
it the most expensive posting list.  The cost-based allocation therefore takes the unit of
the pigeonhole budget away from empty segments and gives it to the first segments, which
are made ``WIDE`` times wider, so that one differing element there is still selective:

* ``Q(j, x_j)`` for every non-empty segment j;
* ``D(j, x_j)`` and ``D(j, x_j - e)`` for the first segments, until as many non-empty
  ones are covered as x has empty segments.

Let E segments be empty in both sets.  Sharing no Q means that the other m - E segments
differ; sharing no D means that E of them differ in two elements: together m > H
differences.  So every qualifying pair shares a signature.  (A set with fewer non-empty
than empty segments gets one signature ``F`` of its band besides.)  A set is indexed in
its own band and in the next when a partner may lie there.

Equal sets are one class (its smallest id stands for it).  Documents that share a
signature are first paired with the smallest of their group; exact verification and
components follow; then all pairs of a group that lie in different components are
verified too, so no link between different texts that could join components is lost and
large groups of near copies never expand into all pairs.  A signature frequent within a
task is salted before the shuffle.  Parity sketches (|x ^ y| >= popcount of the XORed
parities) drop most pairs before sets are fetched.

Defined cases: null or word-less texts have an empty set and link with nothing; fewer
than ``n`` words are one shingle; repeated rows fall in one class; rows of one id with
different sets keep all their links and share a component; a null id gets its row and no
component; empty tables work; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweave.llm.common import (connected_components, cut_table, mix, small_side, span_hashes, task_count,
                                 text_chunks)

U = np.uint64
N = 5
#: Similarity as a fraction.
NUM, DEN = 80, 100
BAND = 1.5
#: One segment in WIDE_SHARE is WIDE times wider; they come first.
WIDE, WIDE_SHARE = 3, 8
#: A signature seen so often in one batch is salted over SALTS parts.
HOT, SALTS = 64, 64
ROWS_PER_TASK = 1_500_000
#: Bytes of text whose words are hashed at once: the arrays of a piece take some 50 bytes a byte of it.
PIECE = 1 << 18
#: Sets whose signatures are made at once.
SIGN = 128
#: Pairs of rows that a task compares at once, and bytes of their sketches on either side.
CROSS_PAIRS, CROSS_BYTES = 200_000, 4 << 20
_COEF = mix(np.arange(1, 65, dtype=np.uint64) * U(0xD1B54A32D192ED03)) | U(1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_WORD = np.ones(256, dtype=bool)
_IS_WORD[[9, 10, 11, 12, 13, 32]] = False


def word_spans(data: np.ndarray, off: np.ndarray, is_word: np.ndarray = _IS_WORD):
    """(starts, ends, document) of the words of concatenated texts; no word crosses a text boundary."""
    w = np.zeros(len(data) + 2, dtype=bool)
    w[1:-1] = is_word[data]
    first, last = w[1:-1] & ~w[:-2], w[1:-1] & ~w[2:]
    inner = off[1:-1][(off[1:-1] > 0) & (off[1:-1] < len(data))]
    first[inner] = w[1:-1][inner]
    last[inner - 1] = w[1:-1][inner - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(off, starts, "right") - 1


def shingle_sets(data: np.ndarray, off: np.ndarray, n: int = N) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, offsets): the sorted distinct n-gram hashes of each text; texts are taken PIECE bytes at a time, longer ones alone."""
    sets, sizes = [], [np.zeros(1, dtype=np.int64)]
    a, docs = 0, len(off) - 1
    while a < docs:
        b = min(docs, max(a + 1, int(np.searchsorted(off, off[a] + PIECE, "right")) - 1))
        u, so = _piece_sets(data[off[a]:off[b]], off[a:b + 1] - off[a], n)
        sets.append(u)
        sizes.append(np.diff(so))
        a = b
    return np.concatenate(sets) if sets else np.zeros(0, np.uint64), np.cumsum(np.concatenate(sizes))


def _piece_sets(data: np.ndarray, off: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    docs = len(off) - 1
    data = _LOWER[data]
    starts, ends, doc = word_spans(data, off)
    h = span_hashes(data, starts, ends)
    words = np.bincount(doc, minlength=docs)
    first = np.concatenate([[0], np.cumsum(words)])
    width = max(len(h) - n + 1, 0)
    s = np.zeros(width, dtype=np.uint64)
    for j in range(n):
        s += h[j:j + width] * _COEF[j]
    s = mix(s)
    sets, sizes = [], np.zeros(docs, dtype=np.int64)
    for i in range(docs):
        a, b = first[i], first[i + 1]
        if b - a >= n:
            u = np.unique(s[a:b - n + 1])
        elif b > a:
            u = mix((h[a:b] * _COEF[:b - a]).sum(dtype=np.uint64, keepdims=True) + U(b - a))
        else:
            continue
        sets.append(u)
        sizes[i] = len(u)
    return np.concatenate(sets) if sets else np.zeros(0, np.uint64), np.concatenate([[0], np.cumsum(sizes)])


def max_difference(total: int, num: int = NUM, den: int = DEN) -> int:
    """Most elements in which two sets of that total size may differ: total * (den - num) / (den + num)."""
    return total * (den - num) // (den + num)


def bands(limit: int, growth: float = BAND) -> list[int]:
    """Upper sizes of the bands up to ``limit``."""
    out = [1]
    while out[-1] < limit:
        out.append(max(out[-1] + 1, int(out[-1] * growth)))
    return out


def signatures(sets: np.ndarray, off: np.ndarray, num: int = NUM, den: int = DEN):
    """(signature, document index) rows of all sets."""
    size = np.diff(off)
    upper = np.array(bands(int(size.max()) * den // num + 1 if len(size) else 1), dtype=np.int64)
    own = np.searchsorted(upper, size)
    out_s, out_d = [], []
    for step in range(len(upper)):
        band = np.minimum(own + step, len(upper) - 1)
        low = np.where(band > 0, upper[np.maximum(band, 1) - 1] + 1, 1)
        use = np.flatnonzero((size > 0) & (own + step < len(upper)) & (size * den >= low * num))
        if step and not len(use):
            break
        if not len(use):
            continue
        k = band[use]
        m = 2 * upper[k] * (den - num) // (den + num) + 1
        base = np.concatenate([[0], np.cumsum(m)])
        n = size[use]
        row = np.repeat(np.arange(len(use)), n)
        e = sets[np.repeat(off[use] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())]
        # Ranges of the universe: sets are sorted, so segments come in order.
        wide = m // WIDE_SHARE
        unit = ((e >> U(32)) * (m + (WIDE - 1) * wide)[row].astype(np.uint64) >> U(32)).astype(np.int64)
        seg = np.where(unit < WIDE * wide[row], unit // WIDE, unit - (WIDE - 1) * wide[row]) + base[row]
        g = mix(e ^ U(0xA0761D6478BD642F))
        pre = np.concatenate([np.zeros(1, np.uint64), np.cumsum(g, dtype=np.uint64)])
        cnt = np.bincount(seg, minlength=base[-1])
        end = np.cumsum(cnt)
        content = pre[end] - pre[end - cnt]
        who = np.repeat(np.arange(len(use)), m)
        j = np.arange(base[-1]) - base[who]
        place = mix((k[who].astype(np.uint64) << U(32)) + j.astype(np.uint64) + U(1))
        q = np.flatnonzero(cnt)
        out_s.append(mix(content[q] + place[q]))
        out_d.append(use[who[q]])
        full = cnt > 0
        before = np.cumsum(full) - full
        before -= before[base[:-1]][who]  # non-empty segments of the same set that come earlier
        filled = np.bincount(who[q], minlength=len(use))
        d = before < (m - filled)[who]
        dd = np.flatnonzero(d)
        out_s.append(mix((content[dd] ^ U(0x5851F42D4C957F2D)) + place[dd]))
        out_d.append(use[who[dd]])
        odd = np.flatnonzero(filled < m - filled)
        out_s.append(mix(k[odd].astype(np.uint64) ^ U(0xC2B2AE3D27D4EB4F)))
        out_d.append(use[odd])
        el = np.flatnonzero(d[seg])
        out_s.append(mix(((content[seg[el]] - g[el]) ^ U(0x5851F42D4C957F2D)) + place[seg[el]]))
        out_d.append(use[row[el]])
    if not out_s:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(out_s), np.concatenate(out_d)


def parity_sketch(u: np.ndarray) -> bytes:
    """Parities of the set over 2^b cells, 2^b >= 2 |u|; XOR of two sketches counts differences from below."""
    bits = max(6, int(2 * len(u) - 1).bit_length())
    cells = np.bincount((u >> U(64 - bits)).astype(np.int64), minlength=1 << bits)
    return np.packbits((cells & 1).astype(np.uint8)).tobytes()


def sketch_difference(a: bytes, b: bytes) -> int:
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    if len(x) > len(y):
        x, y = y, x
    if len(x) < len(y):  # coarser cells are unions of neighbouring fine ones
        bits = np.unpackbits(y).reshape(len(x) * 8, -1)
        y = np.packbits(np.bitwise_xor.reduce(bits, axis=1))
    return int(np.bitwise_count(x ^ y).sum())


def _profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, b, data, off in text_chunks(batch, 1):
            sets, so = shingle_sets(data, off)
            f1, f2, sk = np.zeros(b - a, np.int64), np.zeros(b - a, np.int64), []
            for i in range(b - a):
                u = sets[so[i]:so[i + 1]]
                sk.append(parity_sketch(u))
                f1[i], f2[i] = u.sum().astype(np.int64), np.bitwise_xor.reduce(mix(u) if len(u) else u).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(a, b - a), pa.array(np.diff(so)), pa.array(f1), pa.array(f2), pa.array(sk, pa.binary())],
                names=["doc_id", "n", "f1", "f2", "sketch"])


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        for a, b, data, off in text_chunks(batch, 1):
            sets, so = shingle_sets(data, off)
            # Signatures of a part of the sets at a time; frequent ones are told over the whole chunk.
            parts = [(i, min(i + SIGN, b - a)) for i in range(0, b - a, SIGN)]
            found = [signatures(sets[so[i]:so[j]], so[i:j + 1] - so[i]) for i, j in parts]
            sig = np.concatenate([x for x, _ in found])
            doc = np.concatenate([y + i for (i, _), (_, y) in zip(parts, found)])
            who, salt = ids[a:b][doc].astype(np.int64), np.zeros(len(sig), dtype=np.int32)
            # A signature frequent here goes to salted parts; one row of it also goes to part 0, which
            # meets the rows of tasks that saw it rarely.
            val, first, inv, count = np.unique(sig, return_index=True, return_inverse=True, return_counts=True)
            hot = count[inv] >= HOT
            salt[hot] = 1 + (mix(who[hot].astype(np.uint64)) % U(SALTS)).astype(np.int32)
            extra = first[count >= HOT]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([sig, sig[extra]]).view(np.int64)),
                 pa.array(np.concatenate([salt, np.zeros(len(extra), np.int32)])),
                 pa.array(np.concatenate([who, who[extra]]))], names=["sig", "salt", "id"])


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of signatures that several documents share, with the smallest id of the group."""
    cols = [[c.to_numpy() for c in b.columns] for b in batches]
    if not cols:
        return
    sig, salt, ids = (np.concatenate(x) for x in zip(*cols))
    order = np.lexsort((ids, salt, sig))
    sig, salt, ids = sig[order], salt[order], ids[order]
    new = np.concatenate([[True], (sig[1:] != sig[:-1]) | (salt[1:] != salt[:-1])])
    same = np.concatenate([[False], (ids[1:] == ids[:-1])]) & ~new
    sig, salt, ids, new = sig[~same], salt[~same], ids[~same], new[~same]
    start = np.flatnonzero(new)
    count = np.diff(np.concatenate([start, [len(sig)]]))
    leader = np.repeat(ids[start], count)
    keep = (np.repeat(count, count) > 1) | (salt > 0)
    sig, ids, leader = sig[keep], ids[keep], leader[keep]
    for a in range(0, len(sig), 100_000):
        z = slice(a, a + 100_000)
        yield pa.RecordBatch.from_arrays([pa.array(sig[z]), pa.array(ids[z]), pa.array(leader[z])], names=["sig", "id", "leader"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, b, data, off in text_chunks(batch, 1):
            sets, so = shingle_sets(data, off)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(a, b - a), pa.array([sets[so[i]:so[i + 1]].tobytes() for i in range(b - a)], pa.binary())],
                names=["doc_id", "set"])


def _check_sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        c = {n: batch.column(i).to_pylist() for i, n in enumerate(batch.schema.names)}
        ok = [sketch_difference(x, y) <= max_difference(p + q) for x, y, p, q in zip(c["sa"], c["sb"], c["na"], c["nb"])]
        yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))


def _at_width(sketches: list[bytes], width: int) -> np.ndarray:
    """One row of ``width`` bytes per sketch of that width or more: coarser cells are unions of neighbouring fine ones."""
    out = np.empty((len(sketches), width // 8), dtype=np.uint64)
    size = np.array([len(s) for s in sketches])
    for w in np.unique(size):
        at = np.flatnonzero(size == w)
        rows = np.frombuffer(b"".join(sketches[i] for i in at.tolist()), np.uint8).reshape(len(at), w)
        if w > width:
            bits = np.unpackbits(rows, axis=1).reshape(len(at), width * 8, -1)
            rows = np.packbits(np.bitwise_xor.reduce(bits, axis=2), axis=1)
        out[at] = rows.view(np.uint64)
    return out


def _cross(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of one signature in different components whose sizes and sketches allow a link; no other pair is put out."""
    cols = [[b.column(i).to_numpy() for i in range(4)] + [b.column(4).to_pylist()] for b in batches]
    if not cols:
        return
    sig, ids, comp, n = (np.concatenate([c[i] for c in cols]) for i in range(4))
    sketch = [s for c in cols for s in c[4]]
    order = np.lexsort((ids, sig))
    sig, ids, comp, n = sig[order], ids[order], comp[order], n[order]
    sketch = [sketch[i] for i in order.tolist()]
    width = np.array([len(s) for s in sketch], dtype=np.int64)
    # Every row meets the later rows of its signature, the rows of many groups at once.
    edge = np.flatnonzero(np.concatenate([[True], sig[1:] != sig[:-1], [True]]))
    later = np.repeat(edge[1:], np.diff(edge)) - 1 - np.arange(len(sig))
    total = np.concatenate([[0], np.cumsum(later)])
    lo = 0
    while lo < len(sig):
        hi = max(lo + 1, int(np.searchsorted(total, total[lo] + CROSS_PAIRS, "right")) - 1)
        i = np.repeat(np.arange(lo, hi), later[lo:hi])
        j = i + 1 + np.arange(len(i)) - (total[i] - total[lo])
        lo = hi
        use = (comp[i] != comp[j]) & (ids[i] != ids[j]) & (DEN * np.minimum(n[i], n[j]) >= NUM * np.maximum(n[i], n[j]))
        i, j = i[use], j[use]
        w = np.minimum(width[i], width[j])
        near = np.zeros(len(i), dtype=bool)
        for wide in np.unique(w).tolist():
            at = np.flatnonzero(w == wide)
            step = max(1, CROSS_BYTES // wide)
            for z in range(0, len(at), step):
                q = at[z:z + step]
                who, back = np.unique(np.concatenate([i[q], j[q]]), return_inverse=True)
                table = _at_width([sketch[k] for k in who.tolist()], wide)
                apart = np.bitwise_count(table[back[:len(q)]] ^ table[back[len(q):]]).sum(axis=1, dtype=np.int64)
                near[q] = apart <= (n[i[q]] + n[j[q]]) * (DEN - NUM) // (DEN + NUM)
        if near.any():
            yield pa.RecordBatch.from_arrays([pa.array(ids[i[near]]), pa.array(ids[j[near]])], names=["a", "b"])


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ok = []
        for x, y in zip(batch.column(2), batch.column(3)):
            x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
            both = len(np.intersect1d(x, y, assume_unique=True))
            ok.append(DEN * both >= NUM * (len(x) + len(y) - both))
        yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))


def _links(pairs: DataFrame, profile: DataFrame, docs: DataFrame) -> DataFrame:
    """Those (a, b) of ``pairs`` whose sets qualify."""
    p = profile.select("doc_id", "n", "sketch")
    j = pairs.join(p.toDF("a", "na", "sa"), "a").join(p.toDF("b", "nb", "sb"), "b")
    j = j.where((DEN * F.least("na", "nb") >= NUM * F.greatest("na", "nb")))
    near = cut_table(j.select("a", "b", "na", "nb", "sa", "sb").mapInArrow(_check_sketches, "a long, b long"), "near")
    ids = cut_table(near.select(F.explode(F.array("a", "b")).alias("need")).distinct(), "need")
    need = docs.join(small_side(ids, ids.count()), F.col("doc_id") == F.col("need"), "left_semi").dropDuplicates(["doc_id"])
    sets = cut_table(need.mapInArrow(_sets, "doc_id long, set binary"), "sets")
    full = near.join(sets.toDF("a", "xa"), "a").join(sets.toDF("b", "xb"), "b").select("a", "b", "xa", "xb")
    return cut_table(full.mapInArrow(_verify, "a long, b long"), "links")


def jaccard_classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: doc_id, n_shingles, class_id (smallest id with an equal set), component_id."""
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    profile = _profiles(docs)
    texts = F.struct("n", "f1", "f2")
    several = profile.where("n > 0 and doc_id is not null").groupBy("doc_id").agg((F.min(texts) < F.max(texts)).alias("several"))
    several = cut_table(several.where("several").select(F.col("doc_id").alias("s")), "several")
    if several.isEmpty():
        return _classes(docs, profile)
    return _of_repeated_ids(docs, several)


def _profiles(docs: DataFrame) -> DataFrame:
    return cut_table(docs.mapInArrow(_profile, "doc_id long, n long, f1 long, f2 long, sketch binary"), "profile")


def _of_repeated_ids(docs: DataFrame, several: DataFrame) -> DataFrame:
    """Classes of a table where the ids ``several`` stand on rows with different sets.

    Each row of these ids is a node of its own; afterwards the components that hold rows of
    one id become one, and nodes turn back into the smallest ids of their class and component.
    """
    side = small_side(several, several.count())
    low, high = docs.agg(F.min("doc_id"), F.max("doc_id")).first()
    k = F.monotonically_increasing_id()
    if high < 1 << 61:
        node = F.lit(high + 1).cast("long") + k
    elif low > -(1 << 61):
        node = F.lit(low - 1).cast("long") - k
    else:
        raise ValueError("no free numbers beside the document ids")
    keyed = cut_table(docs.join(side, F.col("doc_id") == F.col("s"), "left_semi").withColumn("node", node), "keyed")
    rest = docs.join(side, F.col("doc_id") == F.col("s"), "left_anti")
    nodes = cut_table(rest.unionAll(keyed.select(F.col("node").alias("doc_id"), "text")), "nodes")
    c = _classes(nodes, _profiles(nodes)).withColumnRenamed("doc_id", "node")
    c = c.join(keyed.select("node", F.col("doc_id").alias("own")), "node", "left").withColumn("doc_id", F.coalesce("own", "node"))
    c = cut_table(c, "of-nodes")
    # Components of one id: each is joined to the smallest.
    of_id = c.where("own is not null and n_shingles > 0").select("own", "component_id").distinct()
    least = of_id.groupBy("own").agg(F.min("component_id").alias("a"))
    root = connected_components(of_id.join(least, "own").select("a", F.col("component_id").alias("b"))).toDF("component_id", "root")
    c = cut_table(c.join(root, "component_id", "left").withColumn("group", F.coalesce("root", "component_id")), "of-groups")

    def smallest(by, name):
        return c.where(F.col(by).isNotNull()).groupBy(by).agg(F.min("doc_id").alias(name))

    out = c.join(smallest("class_id", "least_class"), "class_id", "left").join(smallest("group", "least_group"), "group", "left")
    return out.select("doc_id", "n_shingles", F.col("least_class").alias("class_id"), F.col("least_group").alias("component_id"))


def _classes(docs: DataFrame, profile: DataFrame) -> DataFrame:
    """The join itself, for ids whose rows all have one set."""
    spark = docs.sparkSession
    full = profile.where("n > 0 and doc_id is not null")
    classes = cut_table(full.groupBy("n", "f1", "f2").agg(F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("members")),
                        "classes")
    rows, elements = classes.agg(F.count(F.lit(1)), F.sum("n")).first()
    profile_of = profile.where("n > 0").join(classes.select(F.col("class_id").alias("c")), F.col("doc_id") == F.col("c"), "left_semi")
    reps = classes.select(F.col("class_id").alias("c"))
    # Signatures only for the smallest document of each class.
    first = docs.where("doc_id is not null")
    others = full.select("doc_id").join(reps, F.col("doc_id") == F.col("c"), "left_anti").distinct()
    others = cut_table(others.withColumnRenamed("doc_id", "o"), "others")
    first = first.join(small_side(others, others.count()), F.col("doc_id") == F.col("o"), "left_anti")
    sigs = first.mapInArrow(_index, "sig long, salt int, id long")
    parts = task_count(spark, (elements or 0) // 2, ROWS_PER_TASK)
    groups = cut_table(sigs.repartition(parts, "sig", "salt").mapInArrow(_groups, "sig long, id long, leader long"), "groups")

    prof = cut_table(profile_of.dropDuplicates(["doc_id"]), "prof")
    star = cut_table(groups.where("id != leader").select(F.col("leader").alias("a"), F.col("id").alias("b")).distinct(), "star")
    near = _links(star, prof, first)
    comp = connected_components(near)
    g = groups.select("sig", "id").distinct().join(comp.withColumnRenamed("node", "id"), "id", "left")
    g = cut_table(g.select("sig", "id", F.coalesce("component", "id").alias("comp")), "members")
    mixed = g.groupBy("sig").agg((F.min("comp") < F.max("comp")).alias("mixed")).where("mixed").select("sig")
    g = g.join(mixed, "sig").join(prof.select(F.col("doc_id").alias("id"), "n", "sketch"), "id")
    rest = g.select("sig", "id", "comp", "n", "sketch").repartition(parts, "sig").mapInArrow(_cross, "a long, b long").distinct()
    links = near.unionAll(_links(rest, prof, first))
    comp = connected_components(links).toDF("cnode", "component")
    out = profile.join(classes.select(F.col("n").alias("cn"), F.col("f1").alias("c1"), F.col("f2").alias("c2"), "class_id"),
                       (F.col("n") == F.col("cn")) & (F.col("f1") == F.col("c1")) & (F.col("f2") == F.col("c2")), "left")
    out = out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("class_id", "doc_id").alias("class_id"))
    out = out.join(comp, F.col("class_id") == F.col("cnode"), "left")
    keep = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "class_id"))
    return out.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("class_id")).alias("class_id"),
                      keep.alias("component_id"))
