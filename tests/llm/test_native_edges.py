"""Decontamination, mixing and line dedup: edge rows against brute force, and every SQL of the subpackage at sf0.001."""

import hashlib
import random
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from logweave.llm import decontaminate, line_dedup, mixing
from logweave.llm import queries as llm_queries
from logweave.llm.sql import SQL
from logweave.sources.tables import TABLES
from tests.llm.support import DOCS, docs_frame
from tests.llm.test_pipeline import tokens

SF = "/root/testdata/sf0.001"
LONG_ITEM = " ".join(f"Wörd{i}" for i in range(14))
ITEMS = [("a", LONG_ITEM), ("b", "one two, three FOUR five six seven eight nine ten"), ("b", "Short item"), ("c", None), ("d", " .,"),
         (None, "text under id two"), ("e", LONG_ITEM)]
TEXTS = DOCS + [(7, "x " + LONG_ITEM.lower() + " y", "en", "d", 1), (8, "wörd3 " + " ".join(f"wörd{i}" for i in range(4, 13)), "en", "d", 1),
                (9, " ".join(f"wörd{i}" for i in range(4, 13)), "en", "d", 1), (10, "a short-item, short item short", "en", "d", 1)]


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def contaminated(text):
    w, hit, items = words(text), set(), set()
    for item, t in ITEMS:
        v = words(t)
        k = min(10, len(v))
        have = {tuple(v[i:i + k]) for i in range(len(v) - k + 1)} if v else set()
        for i in range(len(w) - k + 1):
            if tuple(w[i:i + k]) in have:
                hit.update(range(i, i + k))
                items.add(item)
    known = sorted(i for i in items if i is not None)
    return len(w), len(hit), bool(hit), known


def test_decontamination_of_edge_rows(spark):
    docs = docs_frame(spark).limit(0).unionByName(spark.createDataFrame(TEXTS, "doc_id long, text string, lang string, source string, n_chars long"),
                                                  allowMissingColumns=True)
    bench = spark.createDataFrame(ITEMS, "item_id string, text string").withColumn("words", F.lit("clash"))
    rows = decontaminate.decontaminate(docs, bench).collect()
    want = sorted((str(i), *contaminated(t)[:3]) for i, t, *_ in TEXTS)
    assert sorted((str(r.doc_id), r.n_words, r.n_hit, r.contaminated) for r in rows) == want
    by = {r.doc_id: r for r in rows}
    for i in (7, 8, 9, 10):
        known = contaminated(next(t for j, t, *_ in TEXTS if j == i))[3]
        assert by[i].n_items == len(known) and by[i].items_sha256 == hashlib.sha256(",".join(known).encode()).hexdigest()
    assert decontaminate.decontaminate(docs.limit(0), bench).count() == 0
    assert not any(r.contaminated for r in decontaminate.decontaminate(docs, bench.limit(0)).collect())


def test_mixing_of_edge_rows(spark):
    plan = mixing.mix_plan(docs_frame(spark)).collect()
    assert len(plan) == len(DOCS)
    size = {}
    for _, t, _, s, _ in DOCS:
        size[s] = size.get(s, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert all(r.source_size == size[r.source] and 0 <= r.copies <= 3 for r in plan)
    # Targets share all words by weight and stop at three times a source.
    target = {r.source: r.target for r in plan}
    assert all(target[s] <= 3 * size[s] for s in size) and sum(target.values()) == pytest.approx(sum(size.values()))
    again = mixing.mix_plan(docs_frame(spark).repartition(5)).collect()
    assert sorted(map(str, plan)) == sorted(map(str, again))
    copies = {(r.doc_id, r.source): r.copies for r in plan}
    out = mixing.mix(docs_frame(spark))
    assert out.columns == docs_frame(spark).columns
    counts = {}
    for r in out.collect():
        counts[r.doc_id, r.source] = counts.get((r.doc_id, r.source), 0) + 1
    rows = {}
    for i, _, _, s, _ in DOCS:
        rows[i, s] = rows.get((i, s), 0) + 1
    assert counts == {k: n * copies[k] for k, n in rows.items() if copies[k]}
    assert mixing.mix_plan(docs_frame(spark).limit(0)).count() == 0


def lines_fixture():
    """Lines around the threshold at many lengths, with ties, repeats, frequent words and very long lines."""
    rnd = random.Random(5)
    vocabulary = [f"w{i}" for i in range(3000)]
    rows = []
    for n in (1, 3, 4, 5, 9, 10, 17, 40, 80, 150, 400, 1500):
        for _ in range(4):
            line = rnd.sample(vocabulary, n)
            texts = [" ".join(line)]
            for change in (n // 10, n // 9, n // 9 + 1, n // 5):
                other = line[change:] + rnd.sample(vocabulary, change)
                rnd.shuffle(other)
                texts.append("  ".join(other) + rnd.choice(["", "\t", "\r"]))
                texts.append("\x0b".join(line[:n - change] or line))
            rnd.shuffle(texts)
            rows += [(len(rows) + i, t) for i, t in enumerate(texts)]
    rnd.shuffle(rows)
    joined = [(i, "\n".join(t for _, t in rows[i::40])) for i in range(40)]
    return joined + [(50, ""), (51, " \n\t\n "), (52, None), (53, "the end\nthe end\nthe  end the")]


def expected_lines(rows):
    lines = [(i, n, tokens(s)) for i, t in sorted(rows, key=lambda r: r[0]) if t is not None for n, s in enumerate(t.split("\n"))]
    gone = {(i, n) for a, (i, n, x) in enumerate(lines)
            if x and any(y and 100 * len(x & y) >= 80 * len(x | y) for _, _, y in lines[:a])}
    return sorted((i, None if t is None else "\n".join(s for n, s in enumerate(t.split("\n")) if (i, n) not in gone),
                   sum(k == i for k, _ in gone)) for i, t in rows)


def test_lines_around_the_threshold(spark):
    rows = lines_fixture()
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("clash") for c in ("line", "tok", "cid", "n", "late")})
    out = line_dedup.dedup_lines(df).collect()
    want = expected_lines(rows)
    assert sorted((r.doc_id, r.text, r.n_removed) for r in out) == want
    assert sum(n for _, _, n in want) > 100


def test_line_edge_rows(spark):
    out = line_dedup.dedup_lines(docs_frame(spark)).collect()
    assert len(out) == len(DOCS)
    # Rows that repeat a document are one document; null texts stay null.
    assert [r.text for r in out if r.doc_id == 1] == [DOCS[0][1]] * 2
    assert sum(r.text is None for r in out) == 2 and all(r.n_lines == 0 for r in out if r.text is None)
    assert line_dedup.dedup_lines(docs_frame(spark).limit(0)).count() == 0


def test_near_copies_do_not_expand_into_pairs(spark, monkeypatch):
    """Lines that match each other, but not the first line that shares their rare tokens: no table holds their pairs."""
    core, common, other = ([f"{c}{i}" for i in range(n)] for c, n in (("core", 8), ("common", 32), ("other", 33)))
    copies = [" ".join(core + common + [f"lone{i}"]) for i in range(150)]
    lines = [" ".join(common)] * 200 + [" ".join(other)] * 200 + copies
    rows = [(0, " ".join(core + other))] + [(i + 1, "\n".join(lines[i::10])) for i in range(10)]
    seen, write = {}, line_dedup.cut_table

    def written(df, name):
        out = write(df, name)
        seen[name] = max(seen.get(name, 0), out.count())
        return out

    monkeypatch.setattr(line_dedup, "cut_table", written)
    out = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.text, r.n_removed) for r in out) == expected_lines(rows)
    # 11,175 pairs; a class has at most 9 postings for its larger and as many for its smaller partners.
    assert max(seen.values()) < 4_000, seen


def _rows(frame):
    cols = sorted(frame.columns)
    frame = frame[cols].astype(object).where(frame[cols].notna(), None)
    return sorted(tuple(str(round(float(v), 6) if isinstance(v, (int, float)) and not isinstance(v, bool) else v) for v in r)
                  for r in frame.itertuples(index=False))


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got, want = getattr(llm_queries, name)(spark, SF).toPandas(), con.sql(SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns) and _rows(got) == _rows(want)
