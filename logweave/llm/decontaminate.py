r"""Benchmark decontamination by winnowing, with DataFrame operations only.

Words are the runs of digits, a-z and non-ASCII characters of the text with A-Z lowered.
Every run of ``K`` words has a 64-bit hash; of each ``WINDOW - K + 1`` neighbouring
hashes the smallest is a fingerprint, so two texts that share ``WINDOW`` consecutive
words share a fingerprint.  Training and test fingerprints are joined, and documents
that share one are extended: their ``WINDOW``-word windows are joined to the items'
windows on the words themselves, which settles every hit exactly.

An item with fewer words than ``WINDOW``, but some, is one window of its own length;
for each such length every run of that many words is fingerprinted.

Defined cases: null or empty texts have no words and no hits; null ids are ids;
repeated rows each get their own row; rows with one id but other texts are told apart
by a hash of the text; empty tables give no rows or no hits.  Extra columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweave.llm.common import cut_table, lower_ascii, small_side

#: What separates words; splitting is several times faster than extracting every match.
SEPARATOR = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 10
K = 5


def words(text: str):
    return F.array_remove(F.split(lower_ascii(F.coalesce(F.col(text), F.lit(""))), SEPARATOR), "")


def _fingerprints(df: DataFrame, k: int, window: int, short: list[int]) -> DataFrame:
    """Adds ``fps``: distinct fingerprints of the array ``words``; needs no shuffle.

    Each array feeds the next through several references, so the optimizer keeps it as a
    column and computes it once per row.  (Explode ``fps`` with the outer form: the plain
    form implies a filter that is pushed below these columns and computes them again.)
    """
    df = df.withColumn("h", F.expr("transform(words, w -> xxhash64(w))")).withColumn("n", F.size("h"))
    refs = ", ".join(f"h[i + {j}]" for j in range(k))
    g = f"if(n >= {window}, transform(sequence(0, n - {k}), i -> xxhash64({refs})), array())"
    df = df.withColumn("g", F.expr(f"cast({g} as array<bigint>)"))
    mins = ", ".join(f"g[i + {j}]" for j in range(window - k + 1))
    picks = [f"if(n >= {window}, array_distinct(transform(sequence(0, n - {window}), i -> least({mins}))), array())"]
    for m in short:
        runs = ", ".join(f"h[i + {j}]" for j in range(m))
        picks.append(f"if(n >= {m}, array_distinct(transform(sequence(0, n - {m}), i -> xxhash64({m}, {runs}))), array())")
    return df.withColumn("fps", F.expr(f"cast(concat({', '.join(picks)}) as array<bigint>)")).drop("h", "g")


def _windows(df: DataFrame, lengths: list[int], keep: list[str]) -> DataFrame:
    """(keep..., at, span, key): every run of ``span`` words for each length, ``key`` the words themselves."""
    parts = []
    for m in lengths:
        at = F.expr(f"if(n >= {m}, sequence(0, n - {m}), array())").cast("array<int>")
        parts.append(df.select(*keep, "words", F.explode_outer(at).alias("at")).where("at is not null").select(
            *keep, "at", F.lit(m).alias("span"), F.array_join(F.slice("words", F.col("at") + 1, m), " ").alias("key")))
    return reduce(DataFrame.unionAll, parts)


def _of_items(items: DataFrame, window: int, short: list[int], make) -> DataFrame:
    """Union of ``make(items of one kind, their window)``: the long items, then each short length on its own."""
    parts = [make(items.where(F.col("n") >= window), window)]
    return reduce(DataFrame.unionAll, parts + [make(items.where(F.col("n") == m), m) for m in short])


def decontaminate(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text",
                  item_id: str = "item_id", item_text: str = "text", window: int = WINDOW, k: int = K) -> DataFrame:
    """Per document: doc_id, text_key, n_words, n_hit, items (sorted ids as strings), n_items, items_sha256, contaminated."""
    items = benchmark.select(F.col(item_id).cast("string").alias("item"), words(item_text).alias("words"))
    items = cut_table(items.withColumn("n", F.size("words")).where("n > 0").distinct(), "items")
    short = [r[0] for r in items.where(F.col("n") < window).select("n").distinct().orderBy("n").collect()]
    item_fps = _of_items(items, window, short, lambda d, m: _fingerprints(
        d.select("words"), k, window, [m] if m < window else []).select(F.explode_outer("fps").alias("item_fp"))).where("item_fp is not null").distinct()
    item_runs = _of_items(items, window, short, lambda d, m: _windows(d, [m], ["item"])).select("item", "span", "key").distinct()
    item_fps, item_runs = cut_table(item_fps, "item-fps"), cut_table(item_runs, "item-runs")

    base = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(F.col(text)).alias("text_key"), F.col(text).alias("text"))
    fps = _fingerprints(base.select("doc_id", "text_key", words("text").alias("words")), k, window, short)
    fps = fps.select("doc_id", "text_key", "n", F.posexplode_outer("fps").alias("pos", "fp"))
    hits = fps.join(small_side(item_fps, item_fps.count()), F.col("fp") == F.col("item_fp"), "left")
    # The fingerprints of a document are neighbours in one task, so the partial aggregate leaves a row per document.
    profile = hits.groupBy("doc_id", "text_key").agg(
        F.max("n").cast("long").alias("n_words"), F.max(F.col("item_fp").isNotNull()).alias("candidate"),
        F.count(F.when(F.coalesce("pos", F.lit(0)) == 0, 1)).alias("rows"))
    profile = cut_table(profile, "decontaminate")

    def same(i, key):
        return F.col("doc_id").eqNullSafe(F.col(i)) & (F.col("text_key") == F.col(key))

    found = profile.where("candidate").select(F.col("doc_id").alias("c_id"), F.col("text_key").alias("c_key"))
    cand = base.join(small_side(found, found.count()), same("c_id", "c_key"), "left_semi")
    cand = cand.dropDuplicates(["doc_id", "text_key"])  # a repeated row has the same windows
    cand = cand.select("doc_id", "text_key", words("text").alias("words")).withColumn("n", F.size("words"))
    runs = _windows(cand, [window] + short, ["doc_id", "text_key"])
    hit = runs.join(small_side(item_runs, item_runs.count()), ["span", "key"])
    marks = hit.groupBy("doc_id", "text_key").agg(
        F.collect_set(F.struct("at", "span")).alias("runs"), F.sort_array(F.collect_set("item")).alias("items"))
    covered = F.expr("array_distinct(flatten(transform(runs, r -> sequence(r.at, r.at + r.span - 1))))")
    marks = marks.select(F.col("doc_id").alias("m_id"), F.col("text_key").alias("m_key"),
                         F.size(covered).cast("long").alias("n_hit"), "items")
    out = profile.join(marks, same("m_id", "m_key"), "left")
    out = out.select("*", F.explode(F.expr("array_repeat(0, cast(rows as int))")))
    none = F.array().cast("array<string>")
    return out.select(
        "doc_id", "text_key", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", none).alias("items"), F.size(F.coalesce("items", none)).cast("long").alias("n_items"),
        F.sha2(F.array_join(F.coalesce("items", none), ","), 256).alias("items_sha256"),
        F.col("n_hit").isNotNull().alias("contaminated"))
