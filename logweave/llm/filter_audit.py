"""Audit of interacting filters by the Hart-Mas-Colell potential.

Every document fails some subset of the filters.  The removal game of a part (a source)
gives each coalition of filters the number of documents it removes; one aggregate per
part yields the game over all ``2^n`` coalitions.  The potential of a coalition is

    P(S) = (v(S) + sum of P(S without i) over i in S) / |S|,    P(empty) = 0

computed level by level; the Shapley value of a filter is ``P(all) - P(all without it)``.
Potentials are kept times ``n!``, a multiple of every denominator, so all arithmetic is
in whole numbers and ``n! * Shapley`` is the filter's removals summed over all orders.
What a filter removes at a step of an order is the difference of two coalitions.

Documents reach the games as counts per (part, failure mask), pre-aggregated before
every shuffle; texts travel as SHA-256 digests.  The only duplicate state is the smallest
id per digest, joined back on (digest, id), which no group of copies can make hot.

Defined cases: a null text is empty (and equal to other empty texts); a null part is the
empty string; a null id is larger than no id and smaller than none, so it is never a
repeat and makes none; repeated rows of one id count one by one and are not repeats of
each other; a document is good (toxic) when any label row of its id says 1; labels of
unknown ids and null labels count nothing; an empty table gives an empty result.
Extra columns are ignored whatever their names.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logweave.llm.common import cut_table

#: More filters would mean more than 720 orders a part and 64 coalitions.
MAX_FILTERS = 6
SPACE = r"[\x20\x09-\x0D]+"


def text_filters(text: str = "text") -> dict[str, Column]:
    """Failure conditions of the row-wise filters A to D (``text`` must not be null)."""
    c = F.col(text)
    # A leading or trailing separator leaves one empty piece; it is no word.
    words = F.array_remove(F.split(c, SPACE), "")
    upper = F.length(c) - F.length(F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    return {
        "A": F.size(words) < 50,
        "B": 100 * F.size(F.array_distinct(words)) < 65 * F.size(words),
        "C": 100 * upper > 5 * F.length(c),
        "D": c.rlike("[#$%&*|]"),
    }


def failure_counts(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
                   part: str = "source", filters=text_filters, repeat: str = "E") -> tuple[DataFrame, str]:
    """((part, mask, n, good, toxic) and the filter letters): documents by the set of filters they fail.

    Bit k of ``mask`` is the k-th letter.  ``repeat`` names the filter that fails documents
    whose text is identical to that of any smaller id in the whole table.
    """
    own = filters("__t")
    letters = "".join(sorted([*own, repeat]))
    bit = {c: 1 << k for k, c in enumerate(letters)}
    d = docs.select(F.col(doc_id).alias("__id"), F.coalesce(F.col(text), F.lit("")).alias("__t"),
                    F.coalesce(F.col(part).cast("string"), F.lit("")).alias("__part"))
    mask = sum((F.when(own[c], bit[c]).otherwise(0) for c in own), F.lit(0))
    rows = d.select("__id", F.unhex(F.sha2("__t", 256)).alias("__key"), "__part", mask.alias("__mask"))
    rows = rows.groupBy("__id", "__key", "__part", "__mask").agg(F.count(F.lit(1)).alias("__n"))
    marks = labels.where(f"{doc_id} is not null").groupBy(F.col(doc_id).alias("__lid")).agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("__good"),
        F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("__toxic"))
    rows = rows.join(marks, F.col("__id") == F.col("__lid"), "left").drop("__lid").na.fill(0, ["__good", "__toxic"])
    rows = cut_table(rows, "audit-rows")
    first = rows.where("__id is not null").groupBy(F.col("__key").alias("__fkey")).agg(F.min("__id").alias("__fid"))
    fresh = rows.join(first, (F.col("__id") == F.col("__fid")) & (F.col("__key") == F.col("__fkey")), "left_semi")
    fresh = fresh.unionAll(rows.where("__id is null"))
    n, good, toxic = F.col("__n"), F.col("__n") * F.col("__good"), F.col("__n") * F.col("__toxic")
    sums = lambda sign: [F.sum(sign * x).alias(a) for x, a in ((n, "n"), (good, "good"), (toxic, "toxic"))]
    # All rows as repeats, less the fresh ones, plus the fresh ones without the bit: three small aggregates.
    key = [F.col("__part").alias("part"), F.col("__mask")]
    a = rows.groupBy(*key).agg(*sums(1)).withColumn("mask", F.col("__mask") + bit[repeat])
    f = fresh.groupBy(*key).agg(*sums(1))
    back = f.select("part", "__mask", *[(-F.col(c)).alias(c) for c in ("n", "good", "toxic")],
                    (F.col("__mask") + bit[repeat]).alias("mask"))
    cols = ["part", "mask", "n", "good", "toxic"]
    out = a.select(cols).unionAll(back.select(cols)).unionAll(f.withColumn("mask", F.col("__mask")).select(cols))
    out = out.groupBy("part", "mask").agg(*[F.sum(c).alias(c) for c in ("n", "good", "toxic")]).where("n > 0")
    return out, letters


def removal_games(counts: DataFrame, n: int) -> DataFrame:
    """One row per part: ``total`` and per game the arrays ``v``, ``good``, ``toxic``, indexed by coalition."""
    if not 1 <= n <= MAX_FILTERS:
        raise ValueError(f"1 to {MAX_FILTERS} filters, not {n}")
    # A part has at most 2^n rows here, one a mask.
    rows = counts.groupBy("part").agg(F.sum("n").alias("total"), F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("c"))
    game = lambda x: (f"transform(sequence(0, {(1 << n) - 1}), s -> aggregate(filter(c, x -> x.mask & s != 0), 0L, "  # noqa: E731
                      f"(t, x) -> t + x.{x}))")
    return rows.selectExpr("part", "total", f"{game('n')} as v", f"{game('good')} as good", f"{game('toxic')} as toxic")


def potentials(games: DataFrame, n: int, v: str = "v") -> DataFrame:
    """Adds ``p``: the array of potentials times ``n!`` by coalition, from smaller coalitions to larger ones."""
    scale, keep = factorial(n), games.columns
    by_size = sorted(range(1 << n), key=lambda s: (bin(s).count("1"), s))
    df = games.withColumn("p_0", F.lit(0).cast("long"))
    for k in range(1, n + 1):
        df = df.withColumns({f"p_{s}": F.expr("({} * {}[{}] + {}) div {}".format(
            scale, v, s, " + ".join(f"p_{s & ~(1 << i)}" for i in range(n) if s >> i & 1), k))
            for s in by_size if bin(s).count("1") == k})
    return df.select(*keep, F.array(*[F.col(f"p_{s}") for s in range(1 << n)]).alias("p"))


def audit(counts: DataFrame, letters: str) -> DataFrame:
    """One row per part, order of the filters and step, from the counts of ``failure_counts``.

    kept, removed, redundant, unique_fails, good_lost, toxic_lost and shapley (``n!`` times
    the Shapley value) of the step's filter.
    """
    n = len(letters)
    full = (1 << n) - 1
    steps = []
    for order in permutations(range(n)):
        before = 0
        for k, i in enumerate(order):
            steps.append((("'" + "".join(letters[j] for j in order) + "'"), k + 1, before, before | 1 << i, 1 << i))
            before |= 1 << i
    table = "array({})".format(", ".join("struct({} as o, {} as k, {} as b, {} as a, {} as i)".format(*s) for s in steps))
    df = potentials(removal_games(counts, n), n).withColumn("s", F.explode(F.expr(table)))
    diff = lambda c: f"{c}[s.a] - {c}[s.b]"
    return df.selectExpr(
        "part", "s.o as filter_order", "s.k as step", "total - v[s.a] as kept", f"{diff('v')} as removed",
        f"v[s.i] - ({diff('v')}) as redundant", f"v[{full}] - v[{full} - s.i] as unique_fails",
        f"{diff('good')} as good_lost", f"{diff('toxic')} as toxic_lost", f"p[{full}] - p[{full} - s.i] as shapley")


def filter_audit(docs: DataFrame, labels: DataFrame, **kw) -> DataFrame:
    counts, letters = failure_counts(docs, labels, **kw)
    return audit(counts, letters)
