from collections import defaultdict
from itertools import permutations

import re

from pyspark.sql import functions as F

from logweave.llm.filter_audit import audit, filter_audit, potentials, removal_games
from tests.llm.support import DOCS, docs_frame


def fails(rows):
    """[(part, id, set of failed letters)] straight from the contract."""
    first = {}
    for i, t, *_ in rows:
        if i is not None:
            first[t or ""] = min(i, first.get(t or "", i))
    out = []
    for i, t, _, source, *_ in rows:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        f = {c for c, bad in (("A", len(w) < 50), ("B", 100 * len(set(w)) < 65 * len(w)),
                              ("C", 100 * len(re.findall("[A-Z]", t)) > 5 * len(t)), ("D", re.search(r"[#$%&*|]", t)),
                              ("E", i is not None and first[t] < i)) if bad}
        out.append((source or "", i, f))
    return out


def brute(rows, labels):
    """Plays all orders document by document."""
    good = {i for i, q, _ in labels if q == 1}
    toxic = {i for i, _, x in labels if x == 1}
    parts = defaultdict(list)
    for p, i, f in fails(rows):
        parts[p].append((i, f))
    out = set()
    for p, docs in parts.items():
        sums = defaultdict(int)
        mine = []
        for order in permutations("ABCDE"):
            left = docs
            for k, c in enumerate(order):
                gone = [(i, f) for i, f in left if c in f]
                left = [(i, f) for i, f in left if c not in f]
                sums[c] += len(gone)
                mine.append(("".join(order), k + 1, c, len(left), len(gone), sum(c in f for _, f in docs) - len(gone),
                             sum(f == {c} for _, f in docs), sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone)))
        out |= {(p, o, k, *rest, sums[c]) for o, k, c, *rest in mine}
    return out


COLS = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def got(df):
    rows = [tuple(r) for r in df.select(COLS).collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_edge_rows_against_brute_force(spark):
    labels = [(1, 1, 0), (1, 0, 0), (2, 0, 1), (2, None, None), (5, 1, 1), (None, 1, 1), (77, 1, 1), (6, None, 0)]
    lf = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    marks = [(i, q, x) for i, q, x in labels if i is not None]
    assert got(filter_audit(docs_frame(spark), lf)) == brute(DOCS, marks)
    empty = docs_frame(spark).limit(0)
    assert filter_audit(empty, lf).count() == 0
    assert got(filter_audit(docs_frame(spark), lf.limit(0))) == brute(DOCS, [])


def test_copies_across_sources_and_ids(spark):
    text = " ".join(f"word{i}" for i in range(60))
    rows = [(i, text if i % 3 else text + " #", "en", f"s{i % 2}", 0) for i in (4, 2, 9, 9, 7, 6, 12, 3)]
    rows += [(2, text, "en", "s1", 0), (2, text, "en", None, 0), (None, text, "en", "s0", 0), (20, "A B", "en", "s0", 0)]
    labels = [(i, i % 2, int(i % 3 == 0)) for i in range(13)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    lf = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    assert got(filter_audit(df, lf)) == brute(rows, labels)


def test_shapley_sums_to_the_removals_of_all_filters(spark):
    counts = spark.createDataFrame([("p", m, m * m + 1, m, 0) for m in range(16)], "part string, mask int, n long, good long, toxic long")
    r = potentials(removal_games(counts, 4), 4).first()
    assert [x % 24 for x in r.p if x] and r.p[0] == 0
    shares = [r.p[15] - r.p[15 & ~(1 << i)] for i in range(4)]
    assert sum(shares) == 24 * r.v[15] == 24 * sum(m * m + 1 for m in range(1, 16))
    a = audit(counts, "WXYZ")
    assert a.count() == 24 * 4
    by = {r[0]: r[1] for r in a.groupBy(a.filter_order.substr(a.step, F.lit(1))).agg({"removed": "sum"}).collect()}
    assert [by[c] for c in "WXYZ"] == shares
