"""Per-key picks and lookups that hold up when one key owns a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def latest_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key, the first in the given order.

    The filter on row_number lets Spark keep one row per key in every map task before the shuffle, so a hot key sends
    one row per task, not all of its rows.
    """
    ranked = df.withColumn("_rank", F.row_number().over(W.partitionBy(*keys).orderBy(*order)))
    return ranked.filter("_rank = 1").drop("_rank")


def fits_broadcast(df: DataFrame) -> bool:
    """Whether Spark's own size estimate of the plan is within the session's broadcast threshold."""
    if not hasattr(df, "_jdf"):  # a remote session shows no plan statistics: take the way that needs none
        return False
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return int(str(size)) <= limit


def lookup_join(fact: DataFrame, dim: DataFrame, key: str, spread: str, how: str = "left",
                salts: int | None = None) -> DataFrame:
    """Join many fact rows to at most a few dimension rows per key; both sides call the key the same.

    A dimension within the broadcast threshold is broadcast. Otherwise Spark plans the join: adaptive execution
    broadcasts a side that turns out small and splits the partitions of hot keys. With `salts`, for sessions without
    adaptive execution, the join is on (key, salt): a fact row's salt comes from the column `spread`, and each dimension
    row is repeated once per salt, so the rows of a hot key are divided among that many tasks.
    """
    if fits_broadcast(dim):
        return fact.join(F.broadcast(dim), key, how)
    if salts is None:
        return fact.join(dim, key, how)
    salted = fact.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int"))
    copies = dim.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(copies, [key, "_salt"], how).drop("_salt")


def existing_keys(child: DataFrame, parent_keys: DataFrame, key: str, spread: str, found: bool) -> DataFrame:
    """Child rows whose key exists (or not) among the parents. Parent keys are made distinct first."""
    return lookup_join(child, parent_keys.select(key).distinct(), key, spread, "left_semi" if found else "left_anti")
