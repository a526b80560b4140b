"""Mixing sources to target weights, with DataFrame operations only.

Tokens per source are aggregated, a target per source follows from the weights, the
ratio target / tokens is the source's repetition rate, and every document is emitted
``floor(rate)`` times plus one more copy when a hash of its id and the seed falls below
the fraction of the rate.  Reruns agree: nothing depends on partitioning.

Defined cases: a null text has size 0; a null source is a source of its own, last in
order; documents of a source without words are never repeated (rate 0, kept once when
``keep_empty``); repeated rows each follow the decision of their id; a null id hashes
like the empty string; an empty table gives an empty table.  Extra columns are kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweave.llm.common import cut_table, small_side
from logweave.operators.ordered import global_index

WORD = r"[^\x20\x09-\x0D]+"
MAX_REPEAT = 3
WEIGHT_CYCLE = 3
SEED = "mix-1"
#: Sources up to this many are broadcast to the documents; more are joined by shuffle.
BROADCAST_SOURCES = 10_000


def word_count(text: str):
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, source: str = "source", size: str = "size", max_repeat: int = MAX_REPEAT,
            cycle: int = WEIGHT_CYCLE) -> DataFrame:
    """(source, source_size, weight, target) from a table of (source, size) rows.

    Weights 1..cycle repeat over the sources in code point order, null last.  All sizes
    are shared by weight; a target stops at ``max_repeat`` times its source and the excess
    is reshared among the rest until none is above.  Each resharing round is one aggregate
    over the source table that returns three numbers.
    """
    s = sizes.groupBy(F.col(source).alias("source")).agg(F.sum(size).alias("source_size"))
    s = s.select("source", "source_size", F.col("source").isNull().alias("last"), F.coalesce("source", F.lit("")).alias("name"))
    s = global_index(s, ["last", "name"], "pos").select(
        "source", "source_size", (F.col("pos") % cycle + 1).cast("long").alias("weight"))
    s = cut_table(s, "sources")
    total = s.agg(F.sum("source_size")).first()[0] or 0
    capped, left, weights, n = F.lit(False), total, None, -1
    while True:
        row = s.agg(F.coalesce(F.sum(F.when(capped, max_repeat * F.col("source_size"))), F.lit(0)),
                    F.coalesce(F.sum(F.when(~capped, F.col("weight"))), F.lit(0)),
                    F.count(F.when(capped, 1))).first()
        left, weights = total - row[0], row[1]
        if row[2] == n or not weights:
            break
        n = row[2]
        # The share per weight only grows from round to round, so a capped source stays capped.
        share = F.col("weight") * F.lit(left) / F.lit(weights)
        capped = share > max_repeat * F.col("source_size")
    target = F.when(capped, (max_repeat * F.col("source_size")).cast("double"))
    if weights:
        target = target.otherwise((F.col("weight") * F.lit(left).cast("long")).cast("double") / F.lit(float(weights)))
    return s.select("source", "source_size", "weight", F.coalesce(target, F.lit(0.0)).alias("target"))


def unit(key, seed: str = SEED):
    """Uniform number in [0, 1) from the md5 of seed and key (52 bits, exact in a double)."""
    digest = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(key.cast("string"), F.lit(""))))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def _with_copies(rows: DataFrame, sources: DataFrame, source: str, doc_id: str, seed: str) -> DataFrame:
    t = sources.select(F.col("source").alias("__src"), "source_size", "target")
    t = small_side(t, sources.count(), BROADCAST_SOURCES)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    joined = rows.join(t, F.col(source).eqNullSafe(F.col("__src"))).drop("__src")
    extra = (unit(F.col(doc_id), seed) < rate - F.floor(rate)).cast("long")
    return joined.withColumn("copies", F.floor(rate) + extra)


def mix_plan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
             seed: str = SEED, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """Per document: doc_id, source, size, source_size, target (of its source) and copies."""
    sizes = docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), word_count(text).alias("size"))
    sizes = cut_table(sizes, "sizes")
    return _with_copies(sizes, targets(sizes, max_repeat=max_repeat), "source", "doc_id", seed)


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", seed: str = SEED,
        max_repeat: int = MAX_REPEAT) -> DataFrame:
    """The mixture itself: every row of ``docs`` repeated as often as the plan says, with its own columns."""
    sizes = cut_table(docs.select(F.col(source).alias("source"), word_count(text).alias("size"))
                      .groupBy("source").agg(F.sum("size").alias("size")), "sizes")
    cols = [F.col(f"d.{c}") for c in docs.columns]
    work = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("d"))
    src = targets(sizes, max_repeat=max_repeat)
    out = _with_copies(work.withColumns({"__s": F.col(f"d.{source}"), "__i": F.col(f"d.{doc_id}")}), src, "__s", "__i", seed)
    return out.select("d", F.explode(F.expr("array_repeat(0, cast(copies as int))"))).select(*cols)
