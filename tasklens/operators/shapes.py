"""Set operations, pivots, sorting."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tasklens.functions.rules import DEFAULT_FOLDER

# Fixed value: tag of a task that has none.
NO_TAG = "default"


def union_all_by_name(*parts: DataFrame) -> DataFrame:
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    return rows


def union_relations(parts: dict[str, DataFrame], source_column: str = "_dbt_source_relation") -> DataFrame:
    """Tables with different columns stacked; missing ones are NULL, and a column tells the origin."""
    rows = None
    for name, part in parts.items():
        tagged = part.select(F.lit(name).alias(source_column), "*")
        rows = tagged if rows is None else rows.unionByName(tagged, allowMissingColumns=True)
    return rows


def unnest_tags_with_default(tasks: DataFrame) -> DataFrame:
    """One row per task and tag; an empty list gives the stand-in tag. A NULL list gives no row."""
    return tasks.select("task_id", F.explode(tags_with_default()).alias("tag"))


def tags_with_default() -> Column:
    return F.when(F.size("tags") == 0, F.array(F.lit(NO_TAG))).otherwise(F.col("tags"))


def array_overlap_count(tags: Column | str, wanted: Sequence[str]) -> Column:
    """How many of the wanted tags a row has."""
    common = F.array_intersect(tags, F.array(*[F.lit(t) for t in wanted]))
    return F.greatest(F.coalesce(F.size(common), F.lit(0)), F.lit(0)).cast("bigint")


def pivot_series(df: DataFrame, keys: Sequence[str], column: str, values: Sequence, value: Column) -> DataFrame:
    """One column per listed value. The values are an argument, so no job runs to find them."""
    return df.groupBy(*keys).pivot(column, list(values)).agg(value)


def topn_sorted(df: DataFrame, order: Sequence[Column], limit: int) -> DataFrame:
    """First rows of a sort; every task keeps only its own first rows. End the order with a unique column."""
    return df.orderBy(*order).limit(limit)


def inject_default_folders(folders: DataFrame, only_missing: bool = True) -> DataFrame:
    """Folders plus the ids 'default' and '0', both called 'default'; by default only those not there yet."""
    spark = folders.sparkSession
    ids = F.explode(F.array(F.lit(DEFAULT_FOLDER), F.lit("0"))).alias("folder_id")
    extra = spark.range(1).select(ids, F.lit(DEFAULT_FOLDER).alias("folder_name"))
    if only_missing:
        present = folders.filter(F.col("folder_id").isin(DEFAULT_FOLDER, "0")).select("folder_id").distinct()
        extra = extra.join(F.broadcast(present), "folder_id", "left_anti")  # at most two rows
    return folders.unionByName(extra)
