"""Order-dependent building blocks that stay distributed.

Spark's analytic windows need a ``PARTITION BY`` to spread work; an ordered scan
over a whole key (``lag`` over all alarms, a running total over all batches, a
global row number) would put everything in one task.  The helpers below cut the
order into bounded pieces and stitch them with small per-piece summaries:

* ``next_after``      as-of lookup "first time > t + offset" by time buckets;
* ``suppress_repeats`` the alarm fold "fire if more than ``quiet`` after the last
  *fired* one", by pointer doubling over ``next_after`` links (log rounds);
* ``global_index``    0-based position in a total order (range partitions + offsets);
* ``running_totals``  inclusive prefix sums / maxima in a total order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logweave.session import cut


_NOKEY = "__k"


def _keys(key: Sequence[str] | str | None) -> list[str]:
    if key is None:
        return []
    return [key] if isinstance(key, str) else list(key)


def next_after(nodes: DataFrame, t: str, offset: int, bucket: int, key=None) -> DataFrame:
    """For each distinct (key, t): the smallest node time ``> t + offset`` of the same key.

    ``t`` is a long (e.g. epoch microseconds).  Work per partition is bounded by the
    number of nodes in one ``bucket`` of time; the "not in the next bucket" case is
    answered from a per-bucket minimum table (one row per occupied bucket).
    Returns ``key..., t, next`` (``next`` NULL when there is none).
    """
    ks = _keys(key)
    n = nodes.select(*ks, t).distinct()
    q = n.select(*ks, F.col(t).alias("_src"), (F.col(t) + F.lit(offset)).alias("_qt"))
    q = q.withColumn("_b", F.floor(F.col("_qt") / F.lit(bucket))).withColumn("_kind", F.lit(1))
    c = n.select(*ks, F.lit(None).cast("long").alias("_src"), F.col(t).alias("_qt"))
    c = c.withColumn("_b", F.floor(F.col("_qt") / F.lit(bucket))).withColumn("_kind", F.lit(0))
    u = q.unionByName(c)
    # A candidate at the same time as a query sorts first, so "current row onwards" is strictly later.
    w = Window.partitionBy(*ks, "_b").orderBy("_qt", "_kind").rowsBetween(0, Window.unboundedFollowing)
    near = (u.withColumn("_near", F.min(F.when(F.col("_kind") == 0, F.col("_qt"))).over(w))
            .where(F.col("_kind") == 1).select(*ks, "_src", "_b", "_near"))
    # Minimum node time of every later bucket: one row per occupied (key, bucket).
    bmin = c.groupBy(*ks, "_b").agg(F.min("_qt").alias("_bmin"))
    qb = near.select(*ks, "_b").distinct().withColumn("_bmin", F.lit(None).cast("long"))
    bt = bmin.unionByName(qb).groupBy(*ks, "_b").agg(F.min("_bmin").alias("_bmin"))
    wb = Window.partitionBy(*ks).orderBy("_b").rangeBetween(1, Window.unboundedFollowing)
    far = bt.withColumn("_far", F.min("_bmin").over(wb)).select(*ks, "_b", "_far")
    out = near.join(far, on=[*ks, "_b"], how="left")
    return out.select(*ks, F.col("_src").alias(t), F.coalesce("_near", "_far").alias("next"))


def suppress_repeats(cands: DataFrame, t: str, quiet: int, bucket: int | None = None, key=None,
                     max_rounds: int = 64) -> DataFrame:
    """Alarm fold: a candidate fires when it is more than ``quiet`` after the last fired one.

    The fired set is found without a single-task scan, whatever the input size: it is the
    chain ``first, next(first), ...`` with ``next(x)`` the first candidate later than
    ``x + quiet``, computed by pointer doubling in O(log length) join rounds, starting
    from every candidate more than ``quiet`` after its predecessor (those always fire).
    Each round is checkpointed to the session's checkpoint folder.
    Returns ``cands`` with a boolean ``fired``.
    """
    ks = _keys(key)
    reach = _doubling(cands, t, quiet, bucket or quiet, ks, max_rounds)
    fired = reach.withColumn("fired", F.lit(True))
    return cands.join(fired, on=[*ks, t], how="left").withColumn("fired", F.coalesce("fired", F.lit(False)))


def _doubling(cands: DataFrame, t: str, quiet: int, bucket: int, ks: list[str], max_rounds: int) -> DataFrame:
    links = next_after(cands, t, quiet, bucket, ks or None)
    jump = cut(links.select(*ks, F.col(t).alias("_src"), F.col("next").alias("_dst")))
    # Chain starts: the first candidate of each key and every candidate more than
    # ``quiet`` after its predecessor.
    succ = next_after(cands, t, 0, bucket, ks or None).where(F.col("next") > F.col(t) + F.lit(quiet))
    firsts = cands.groupBy(*ks).agg(F.min(t).alias(t))
    reach = cut(firsts.unionByName(succ.select(*ks, F.col("next").alias(t))).distinct())
    size = reach.count()
    for _ in range(max_rounds):
        cond = [reach[k] == jump[k] for k in ks] + [reach[t] == jump["_src"]]
        step = (reach.join(jump, on=cond)
                .where(F.col("_dst").isNotNull()).select(*[reach[k] for k in ks], F.col("_dst").alias(t)))
        new_reach = cut(reach.unionByName(step).distinct())
        new_size = new_reach.count()
        if new_size == size:
            return reach
        reach, size = new_reach, new_size
        a, b = jump.alias("a"), jump.alias("b")
        cond = [F.col(f"a.{k}") == F.col(f"b.{k}") for k in ks] + [F.col("a._dst") == F.col("b._src")]
        jump = cut(a.join(b, on=cond, how="left")
                   .select(*[F.col(f"a.{k}").alias(k) for k in ks], F.col("a._src").alias("_src"),
                           F.col("b._dst").alias("_dst")))
    raise RuntimeError("suppress_repeats did not converge")


def global_index(df: DataFrame, order: Sequence[str], name: str = "idx", partitions: int | None = None) -> DataFrame:
    """0-based position of each row in the total order ``order`` (must be unique).

    One full shuffle: sorted range partitions, whose rows carry their number inside the
    partition (``monotonically_increasing_id``: partition above bit 33, row below), plus the
    row count of all earlier partitions (a table of one row per partition).
    """
    spark = df.sparkSession
    p = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Numbered once and written (reliable checkpoint): both uses below must see the same numbers,
    # even if a lost executor forces a recompute.
    s = cut(df.repartitionByRange(p, *order).sortWithinPartitions(*order).withColumn("_row", F.monotonically_increasing_id()))
    part = F.shiftright("_row", 33)
    counts = s.groupBy(part.alias("_pid")).agg(F.count(F.lit(1)).alias("_n"))
    offs = counts.select("_pid", F.coalesce(
        F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
    offs = F.broadcast(offs)  # one row per partition: size bounded by p
    return (s.join(offs, part == F.col("_pid")).withColumn(name, F.col("_off") + F.col("_row").bitwiseAND((1 << 33) - 1))
            .drop("_pid", "_off", "_row"))


def running_totals(df: DataFrame, order: str, sums: Sequence[str] = (), maxes: Sequence[str] = (),
                   partitions: int | None = None) -> DataFrame:
    """Inclusive running sums (``run_<c>``) and maxima (``runmax_<c>``) in ``order``.

    ``order`` values must be unique.  Same two-level scheme as ``global_index``.
    """
    spark = df.sparkSession
    p = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    s = cut(df.repartitionByRange(p, order).withColumn("_pid", F.spark_partition_id()))
    part = s.groupBy("_pid").agg(*[F.sum(c).alias(f"_s_{c}") for c in sums],
                                 *[F.max(c).alias(f"_m_{c}") for c in maxes])
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offs = part.select("_pid", *[F.sum(f"_s_{c}").over(before).alias(f"_o_{c}") for c in sums],
                       *[F.max(f"_m_{c}").over(before).alias(f"_x_{c}") for c in maxes])
    w = Window.partitionBy("_pid").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    out = s.join(F.broadcast(offs), "_pid")  # one row per partition: size bounded by p
    for c in sums:
        out = out.withColumn(f"run_{c}", F.coalesce(F.col(f"_o_{c}"), F.lit(0)) + F.sum(c).over(w))
    for c in maxes:
        out = out.withColumn(f"runmax_{c}", F.greatest(F.col(f"_x_{c}"), F.max(c).over(w)))
    drop = ["_pid"] + [f"_o_{c}" for c in sums] + [f"_x_{c}" for c in maxes]
    return out.drop(*drop)
