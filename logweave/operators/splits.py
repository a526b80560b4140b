"""Repeatable dataset splits (SP1, SP2).

Row order is not a table property, so both take an explicit ``order`` (the
"file order" of the original scripts) that must be unique.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logweave.operators.ordered import global_index


def kfold_positional(df: DataFrame, order: Sequence[str], k: int = 5) -> DataFrame:
    """SP1: fold = block of consecutive rows in ``order``: ``floor(idx * k / n)``.

    Fold ``i`` is the test set of split ``i``; its train set is ``fold != i``.
    """
    indexed = global_index(df, order, "_idx")
    n = df.select(F.count(F.lit(1))).scalar()  # scalar subquery, planned with the query
    return indexed.withColumn("fold", F.floor(F.col("_idx") * F.lit(k) / n).cast("int")).drop("_idx")


def user_holdout(df: DataFrame, user: str, order: Sequence[str], start: int, stop: int,
                 max_test: int = 0) -> DataFrame:
    """SP2: a user's rows number ``start..stop`` (1-based, in ``order``) are test rows,
    as long as fewer than ``max_test`` test rows were taken before (``<= 0``: no cap);
    all other rows are train rows.  Adds ``is_test``.

    Only the first ``stop`` rows per user are ranked (``row_number() <= stop`` gets a
    partial group limit before the shuffle, so a user with a third of all rows is
    cut map-side); the cap ranks those candidates in the global order.
    """
    w = Window.partitionBy(user).orderBy(*order)
    cand = (df.select(user, *order).withColumn("_rn", F.row_number().over(w))
            .where(F.col("_rn") <= stop).where(F.col("_rn") >= start).drop("_rn"))
    if max_test > 0:
        cand = global_index(cand, order, "_ti").where(F.col("_ti") < max_test).drop("_ti")
    cand = cand.withColumn("is_test", F.lit(True))
    return (df.join(cand, on=[user, *order], how="left")
            .withColumn("is_test", F.coalesce("is_test", F.lit(False))))
