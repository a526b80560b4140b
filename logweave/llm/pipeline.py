"""Stages of the training corpus pipeline: each takes and returns documents, and decides on all its predecessor kept.

Null ids are never dropped as duplicates or contaminated by another row's id; repeated
rows of one document leave one in the near-duplicate stage; an empty table stays empty.
Extra columns pass through every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweave.llm import decontaminate, langid, line_dedup, mixing, ngram_join
from logweave.llm.common import cut_table, read, small_side


def identify_language(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the language identifier rejects go."""
    return langid.keep_known(docs, langid.train(langid.training_fold(docs)))


def drop_repeated_lines(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later matches of a line go; a document that loses all its words goes with them."""
    out = line_dedup.dedup_lines(docs)
    left = (F.col("n_removed") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]")
    out = out.where(left).withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)


def drop_near_duplicates(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of near-duplicate documents the one with the smallest id stays."""
    c = cut_table(ngram_join.jaccard_classes(docs), "near-duplicates")
    gone = cut_table(c.where("component_id != doc_id").select(F.col("doc_id").alias("__gone")).distinct(), "gone")
    kept = docs.join(small_side(gone, gone.count()), F.col("doc_id") == F.col("__gone"), "left_anti")
    again = cut_table(c.where("doc_id is not null and n_shingles > 0").groupBy(F.col("doc_id").alias("__twice")).count()
                      .where("count > 1").select("__twice"), "twice")
    twice = small_side(again, again.count())
    once = kept.join(twice, F.col("doc_id") == F.col("__twice"), "left_anti")
    return once.unionAll(kept.join(twice, F.col("doc_id") == F.col("__twice"), "left_semi").dropDuplicates(["doc_id"]))


def drop_contaminated(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    out = decontaminate.decontaminate(docs, read(spark, sf_dir, "benchmark"))
    bad = cut_table(out.where("contaminated").select(F.col("doc_id").alias("__bid"), F.col("text_key").alias("__bkey")).distinct(), "contaminated")
    same = F.col("doc_id").eqNullSafe(F.col("__bid")) & (F.xxhash64("text") == F.col("__bkey"))
    return docs.join(small_side(bad, bad.count()), same, "left_anti")


def mix_sources(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as its source's target asks."""
    return mixing.mix(docs)


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", drop_repeated_lines),
    ("ngram_jaccard", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
]


def run(spark, sf_dir: str, stages=STAGES) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in stages:
        docs = cut_table(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
