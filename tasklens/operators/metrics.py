"""Aggregations and named metrics."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tasklens.functions.dates import due_day_parts, wall_time
from tasklens.functions.links import NATIVE, WEB, folder_path, project_path, task_path
from tasklens.functions.rules import DONE, is_open
from tasklens.functions.text import surrogate_key

GRAIN_ID = {"task": "task_id", "project": "project_id", "folder": "folder_id"}


def metric(name: str, grain: str = "task", as_of: dt.datetime | str | None = None) -> Column:
    """A metric over explore rows, for use in agg()."""
    done = F.when(F.col("status") == DONE, F.col("task_id"))
    if name == "total_tasks":
        return F.count("task_id")
    if name == "completed_tasks":
        return F.count_distinct(done)
    if name == "count":
        return F.count_distinct(GRAIN_ID[grain])
    if name == "overdue_tasks":
        late = (F.col("due_date") < wall_time(as_of)) & is_open()
        return F.count_distinct(F.when(late, F.col("task_id")))
    if name == "completion_rate":
        return F.try_divide(F.count_distinct(done), F.count("task_id"))
    counted = {"project_count": "project_id", "tag_count": "tag_id", "folder_count": "folder_id"}
    if name in counted:
        return F.count_distinct(counted[name])
    if name == "habit_total":
        return F.count("surr_id")
    raise ValueError(f"unknown metric: {name}")


def open_task_counts(tasks: DataFrame) -> DataFrame:
    """Distinct open tasks per due day and project. Duplicates of a task collapse before they are counted."""
    open_rows = tasks.filter(is_open() & F.col("due_date").isNotNull())
    return open_rows.groupBy(F.col("due_date").cast("date").alias("due_date_day"), "project_id").agg(
        F.count_distinct("task_id").alias("open_task_count")
    )


def project_last_pulse(tasks: DataFrame) -> DataFrame:
    """Newest due time of each project, or else its newest completion."""
    return tasks.groupBy("project_id").agg(
        F.coalesce(F.max("due_date"), F.max("completed_time")).alias("last_pulse")
    )


def freshness_max(df: DataFrame, column: str = "updated_time") -> DataFrame:
    minute = F.date_trunc("minute", F.col(column)).cast("timestamp_ntz")
    return df.agg(F.max(minute).alias(f"{column}_minute_max"))


def sum_by_parent(rollup: DataFrame) -> DataFrame:
    return rollup.groupBy("due_date_day", "parent_grain_label").agg(F.sum("task_count").alias("open_tasks"))


def having_filter(df: DataFrame, keys: Sequence[str], metrics: dict[str, Column], condition: Column) -> DataFrame:
    return df.groupBy(*keys).agg(*[m.alias(n) for n, m in metrics.items()]).filter(condition)


def orphan_keys(child: DataFrame, parent: DataFrame, key: str, day: str) -> DataFrame:
    """Keys without a parent: rows and first and last day. Rows are counted per key before the parents are looked up."""
    counts = child.filter(F.col(key).isNotNull()).groupBy(key).agg(
        F.count("*").alias("row_count"),
        F.min(day).alias(f"earliest_{day}"),
        F.max(day).alias(f"latest_{day}"),
    )
    return counts.join(parent.select(key).distinct(), key, "left_anti")


def grain_rollup(base: DataFrame, grains: Sequence[str] = ("task", "project", "folder")) -> DataFrame:
    """Distinct open tasks per due day at each grain, with parent, label and links.

    Open tasks are first made distinct on the few columns that matter. Each then becomes one row per grain, without the
    columns that a coarser grain doesn't have, and one grouping counts them all: the tasks are read once. Labels of
    days, keys and links follow from the group columns, so they are added after counting.
    """
    keys = ["due_date_day", "scope_bucket", "folder_id", "folder_name", "project_id", "project_name"]
    open_rows = base.filter(is_open() & F.col("due_date_day").isNotNull())
    distinct = open_rows.select(*keys, "task_id", "title").distinct()
    level = F.explode(F.array(*[F.lit(g) for g in grains])).alias("grain_level")
    rows = distinct.select("*", F.col("task_id").alias("_task"), level)
    grain = F.col("grain_level")
    rows = rows.withColumns(
        {c: F.when(grain != "folder", F.col(c)) for c in ("project_id", "project_name")}
        | {c: F.when(grain == "task", F.col(c)) for c in ("task_id", "title")})
    counts = rows.groupBy(*keys, "task_id", "title", "grain_level").agg(F.count_distinct("_task").alias("task_count"))
    return _rollup_labels(counts)


def _rollup_labels(rollup: DataFrame) -> DataFrame:
    level = F.col("grain_level")

    def by_level(task: Column, project: Column, folder: Column) -> Column:
        return F.when(level == "task", task).when(level == "project", project).otherwise(folder)

    project = F.coalesce(F.col("project_id"), F.lit("unknown_project"))
    task_link = task_path(project, F.coalesce(F.col("task_id"), F.lit("unknown_task")))
    project_link = project_path(project)
    folder_link = folder_path(F.coalesce(F.col("folder_id"), F.lit("default")))
    path = by_level(task_link, project_link, folder_link)
    parent_path = by_level(project_link, folder_link, folder_link)
    c = F.col
    grain_id = by_level(c("task_id"), c("project_id"), c("folder_id"))
    return rollup.select(
        surrogate_key(c("due_date_day"), level, grain_id, c("scope_bucket")).alias("grain_rollup_id"),
        "due_date_day", *due_day_parts(), "scope_bucket", "folder_id", "folder_name", "project_id", "project_name",
        "grain_level",
        grain_id.alias("grain_id"),
        by_level(F.coalesce(c("title"), c("task_id"), F.lit("untitled_task")), c("project_name"), c("folder_name"))
        .alias("grain_label"),
        by_level(c("project_id"), c("folder_id"), c("folder_id")).alias("parent_grain_id"),
        by_level(c("project_name"), c("folder_name"), c("folder_name")).alias("parent_grain_label"),
        path.alias("grain_url_path"),
        F.concat(F.lit(WEB), path).alias("grain_url_web"),
        F.concat(F.lit(NATIVE), path).alias("grain_url_native"),
        parent_path.alias("parent_grain_url_path"),
        F.concat(F.lit(WEB), parent_path).alias("parent_grain_url_web"),
        F.concat(F.lit(NATIVE), parent_path).alias("parent_grain_url_native"),
        "task_count",
    )
