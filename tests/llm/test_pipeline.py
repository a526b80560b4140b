import re

import corpus_pipeline
from logweave.llm import mixing, pipeline
from tests.llm.support import docs_frame
from tests.llm.test_ngram_join import brute as near_groups

SF = "/root/testdata/sf0.001"


def tokens(line):
    return frozenset(t for t in re.split(r"[\x20\x09-\x0D]+", line) if t)


def brute_lines(rows):
    """(id, text, removed) by comparing every line with all earlier ones."""
    lines = [(i, n, tokens(s)) for i, t in sorted(rows) for n, s in enumerate(t.split("\n"))]
    gone = set()
    for a, (i, n, x) in enumerate(lines):
        if x and any(y and 100 * len(x & y) >= 80 * len(x | y) for _, _, y in lines[:a]):
            gone.add((i, n))
    return [(i, "\n".join(s for n, s in enumerate(t.split("\n")) if (i, n) not in gone), sum(k == i for k, _ in gone)) for i, t in rows]


def windows(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    return {tuple(w[i:i + 10]) for i in range(len(w) - 9)}


def test_each_stage_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = docs.columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "ngram_jaccard", "decontamination", "mixing"]
    done = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs.collect()
        docs = pipeline.cut_table(stage(spark, docs, SF), "test")
        assert docs.columns == names
        after = docs.collect()
        done[name] = (before, after)
    before, after = done["language_id"]
    assert len(after) >= 0.97 * len(before) and {r.doc_id for r in after} <= {r.doc_id for r in before}
    before, after = done["line_dedup"]
    want = {(i, t) for i, t, n in brute_lines([(r.doc_id, r.text) for r in before]) if n == 0 or tokens(t.replace("\n", " "))}
    assert {(r.doc_id, r.text) for r in after} == want
    assert all(r.n_chars == len(r.text) for r in after)
    before, after = done["ngram_jaccard"]
    want = {i for i, _, c in near_groups([(r.doc_id, r.text) for r in before]) if i == c}
    assert sorted(r.doc_id for r in after) == sorted(want)
    before, after = done["decontamination"]
    items = set().union(*(windows(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()))
    assert sorted(r.doc_id for r in after) == sorted(r.doc_id for r in before if not windows(r.text) & items)
    before, after = done["mixing"]
    copies = {r.doc_id: r.copies for r in mixing.mix_plan(spark.createDataFrame(before, docs.schema)).collect()}
    counted = {i: sum(r.doc_id == i for r in after) for i in copies}
    assert counted == copies
    assert sorted(map(str, corpus_pipeline.run(spark, SF).collect())) == sorted(map(str, after))


def test_edge_rows(spark):
    df = docs_frame(spark)
    for _, stage in corpus_pipeline.STAGES[1:]:
        out = stage(spark, df, SF)
        assert out.columns == df.columns
        out.collect()
        assert stage(spark, df.limit(0), SF).count() == 0
    left = pipeline.drop_near_duplicates(spark, df, SF).collect()
    assert sum(r.doc_id == 1 for r in left) == 1
