"""Short-text operators: word counts, cleaned top words, running length statistics,
batch caps (A1-A3, A5, A6, A8, P11-P13, F2, F3, T1, T3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logweave.functions import text as tx
from logweave.operators.ordered import running_totals

# --- Fixed values: reference parameters -------------------------------------------------------
TOP_WORDS = 10            # print() default
BATCH_ROW_CAP = 1000      # stop after the batch that takes the total past 1000
# --- end of fixed values ----------------------------------------------------------------------


def lines_of(docs: DataFrame, text: str = "text", keep=()) -> DataFrame:
    """SRC5 over a text column: one row per line, as a text-file reader yields them."""
    return docs.select(*keep, F.explode(tx.text_lines(text)).alias("value"))


def line_count(lines: DataFrame) -> DataFrame:
    """A1: number of lines."""
    return lines.agg(F.count(F.lit(1)).alias("n_lines"))


def words(lines: DataFrame, value: str = "value", lower: bool = True, keep=()) -> DataFrame:
    """Split on single spaces (Java split semantics), lower-cased after the split."""
    w = F.explode(tx.java_split_space(value)).alias("word")
    out = lines.select(*keep, w)
    return out.withColumn("word", F.lower("word")) if lower else out


def word_counts(words_df: DataFrame, by=()) -> DataFrame:
    """A2/A3: word -> count (per ``by`` batch key when given); partial + final aggregate."""
    return words_df.groupBy(*by, "word").agg(F.count(F.lit(1)).alias("count"))


def first_entries(counts: DataFrame, n: int = 20) -> DataFrame:
    """20 entries of the count table, in a repeatable order."""
    return counts.orderBy(F.col("count").desc(), F.col("word")).limit(n)


def clean_word_rows(texts: DataFrame, text: str = "text", keep=()) -> DataFrame:
    """P12 + F2 + F3: cleaned words longer than two characters, stop words removed.

    The filters run on the exploded words (plain predicates inside whole-stage codegen)."""
    w = texts.select(*keep, F.explode(F.split(tx.clean_text(text), " ")).alias("word"))
    return w.where((F.length("word") > tx.MIN_WORD_LENGTH_EXCLUSIVE) & ~F.col("word").isin(*tx.STOP_WORDS))


def top_words(word_rows: DataFrame, group: str, k: int = TOP_WORDS) -> DataFrame:
    """T1 over word counts per group (window or batch), ties by word."""
    counts = word_rows.groupBy(group, "word").agg(F.count(F.lit(1)).alias("count"))
    w = Window.partitionBy(group).orderBy(F.col("count").desc(), F.col("word"))
    return counts.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def length_running(texts: DataFrame, batch: str, text: str = "text", utf16: bool = False) -> DataFrame:
    """A5 + A6: per batch, running totals of texts and characters, integer average and
    longest text, in batch order.  Empty batches have no row (they are skipped).

    Per-batch partial aggregates first, then a distributed running total over the
    batch table.
    """
    ln = (tx.utf16_length(text) if utf16 else tx.char_length(text)).cast("long")
    per = texts.groupBy(batch).agg(F.count(F.lit(1)).alias("rows"), F.sum(ln).alias("chars"),
                                   F.max(ln).alias("longest"))
    run = running_totals(per, batch, sums=["rows", "chars"], maxes=["longest"])
    return run.select(batch, "rows", "chars",
                      F.col("run_rows").alias("total_rows"), F.col("run_chars").alias("total_chars"),
                      F.floor(F.col("run_chars") / F.col("run_rows")).cast("long").alias("avg_length"),
                      F.col("runmax_longest").alias("max_length"))


def take_batches_until(rows: DataFrame, batch: str, cap: int = BATCH_ROW_CAP) -> DataFrame:
    """Keep whole batches, in order, until the running row count has passed ``cap``
    (the batch that crosses the cap is kept, later ones are not)."""
    per = rows.groupBy(batch).agg(F.count(F.lit(1)).alias("rows"))
    run = running_totals(per, batch, sums=["rows"])
    kept = run.where((F.col("run_rows") - F.col("rows")) <= cap).select(batch)
    return rows.join(kept, on=batch, how="left_semi")
