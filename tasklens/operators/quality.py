"""Checks. Each returns the failing rows; whether they are errors or warnings is up to the caller."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tasklens.functions.dates import as_date
from tasklens.functions.links import APP, NATIVE, WEB
from tasklens.functions.rules import DONE, is_open
from tasklens.operators.keyed import existing_keys
from tasklens.operators.metrics import open_task_counts


def unique(df: DataFrame, *columns: str) -> DataFrame:
    """Values that occur more than once. NULL is not a value."""
    present = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
    return df.filter(present).groupBy(*columns).agg(F.count("*").alias("n_rows")).filter("n_rows > 1")


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def relationships(child: DataFrame, column: str, parent: DataFrame, parent_column: str | None = None,
                  spread: str | None = None) -> DataFrame:
    """Child rows whose value is not among the parents. `spread` is a column that divides the rows of a hot value."""
    keys = parent.select(F.col(parent_column or column).alias(column))
    return existing_keys(child.filter(F.col(column).isNotNull()), keys, column, spread or child.columns[0], found=False)


def accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    return df.filter(~F.col(column).isin(*values))


def workload_reconciles(workload: DataFrame, tasks: DataFrame) -> DataFrame:
    """Calendar rows whose count differs from the tasks'."""
    expected = open_task_counts(tasks).withColumnRenamed("open_task_count", "_expected")
    joined = workload.select("due_date_day", "project_id", "open_task_count").join(
        expected, ["due_date_day", "project_id"], "left"
    )
    wanted = F.coalesce("_expected", F.lit(0).cast("bigint"))
    return joined.filter(F.col("open_task_count") != wanted).select(
        "due_date_day", "project_id", wanted.alias("expected_open_task_count"), "open_task_count"
    )


def rollup_conserves(rollup: DataFrame, base: DataFrame) -> DataFrame:
    """Days, scopes and grains whose summed counts differ from the distinct open tasks."""
    keys = ["due_date_day", "scope_bucket"]
    expected = base.filter(is_open() & F.col("due_date_day").isNotNull()).groupBy(*keys).agg(
        F.count_distinct("task_id").alias("_expected")
    )
    actual = rollup.groupBy(*keys, "grain_level").agg(F.sum("task_count").alias("actual_open_task_count"))
    wanted = F.coalesce("_expected", F.lit(0).cast("bigint"))
    return actual.join(expected, keys, "left").filter(F.col("actual_open_task_count") != wanted).select(
        *keys, "grain_level", wanted.alias("expected_open_task_count"), "actual_open_task_count"
    )


# Shape of the links at each grain.
LINK_SHAPE = {"task": "#p/%/tasks/%", "project": "#p/%/tasks", "folder": "#g/%"}


def link_shape(column: str, grain: str) -> Column:
    """Whether the column's web and native links have the shape of the grain."""
    shape = APP + LINK_SHAPE[grain]
    return F.col(f"{column}_web").like(WEB + shape) & F.col(f"{column}_native").like(NATIVE + shape)


def url_patterns(df: DataFrame, grains: Sequence[str] = ("task", "project", "folder")) -> DataFrame:
    """Rows with a link of the wrong shape. Rows with missing links are left to not_null."""
    return df.filter(~reduce(lambda a, b: a & b, [link_shape(f"{g}_url", g) for g in grains]))


def rollup_url_patterns(rollup: DataFrame) -> DataFrame:
    parents = {"task": "project", "project": "folder", "folder": "folder"}
    level = F.col("grain_level")
    wrong = F.lit(True)
    for grain, parent in parents.items():
        ok = link_shape("grain_url", grain) & link_shape("parent_grain_url", parent)
        wrong = F.when(level == grain, ~ok).otherwise(wrong)
    return rollup.filter(wrong)


def parity(left: DataFrame, right: DataFrame, as_of: dt.date | str, ahead: int = 35, back: int = 30) -> DataFrame:
    """Counts of two builds of a fact side by side, and their difference."""
    day = F.lit(as_date(as_of))
    due, completed = F.col("due_date").cast("date"), F.col("completed_time").cast("date")
    measures = {
        "total_rows": F.lit(True),
        "open_rows": F.col("status") == 0,
        "done_rows": F.col("status") == DONE,
        f"due_next_{ahead}d_open": (F.col("status") == 0) & due.between(day, F.date_add(day, ahead)),
        f"completed_last_{back}d": (F.col("status") == DONE) & completed.between(F.date_sub(day, back), day),
    }

    def counts(df: DataFrame, name: str) -> DataFrame:
        one = df.agg(*[F.count(F.when(c, 1)).alias(m) for m, c in measures.items()])
        return one.unpivot([], list(measures), "measure", name)

    both = counts(left, "left_count").join(counts(right, "right_count"), "measure")
    return both.withColumn("difference", F.col("right_count") - F.col("left_count"))
