"""Staged facts and dimensions out of base models."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tasklens.config import Settings
from tasklens.functions.rules import DEFAULT_FOLDER, DONE, work_type
from tasklens.functions.text import FOLDER_TITLE_LIKE, folder_label
from tasklens.functions.typing import blank_to_null, safe_long
from tasklens.operators.history import infer_completion, infer_project_completion, next_load_banner
from tasklens.operators.metrics import project_last_pulse
from tasklens.operators.shapes import inject_default_folders


def with_work_type(tasks: DataFrame, cfg: Settings) -> DataFrame:
    return tasks.withColumn("gtd_work_type", work_type("tags", cfg.deep_tags, cfg.shallow_tags, cfg.categorise))


def staged_tasks(tasks: DataFrame, history: DataFrame, as_of_ts: dt.datetime | str, cfg: Settings,
                 only_latest: bool = False) -> DataFrame:
    """Tasks of the full extract with inferred completion, the load banner and the work type."""
    inferred = infer_completion(tasks, history, only_latest=only_latest)
    banner = next_load_banner(tasks, as_of_ts, cfg.load_interval)
    return with_work_type(inferred.unionByName(banner), cfg)


def staged_projects(projects: DataFrame, history: DataFrame, tasks: DataFrame, only_latest: bool = False) -> DataFrame:
    inferred = infer_project_completion(projects, history, only_latest=only_latest)
    return join_pulse(default_group(inferred), tasks)


def staged_folders(projects: DataFrame) -> DataFrame:
    """Folders named by the titles of special projects, plus both default folders."""
    named = projects.filter(F.col("project_name").like(FOLDER_TITLE_LIKE))
    folders = named.select(F.col("group_id").alias("folder_id"), folder_label("project_name").alias("folder_name"))
    return inject_default_folders(folders.distinct(), only_missing=False)


def default_group(projects: DataFrame) -> DataFrame:
    return projects.withColumn("group_id", F.coalesce("group_id", F.lit(DEFAULT_FOLDER)))


def join_pulse(projects: DataFrame, tasks: DataFrame) -> DataFrame:
    """Projects with their last pulse. Tasks are aggregated per project before the join."""
    return projects.join(project_last_pulse(tasks), "project_id", "left")


def drop_deleted(tasks: DataFrame) -> DataFrame:
    """Tasks known not to be deleted; an unknown flag is dropped too."""
    return tasks.filter(F.col("deleted") == 0)


def staged_v3_tasks(base: DataFrame, cfg: Settings) -> DataFrame:
    done = F.col("status") == DONE
    rows = drop_deleted(base)
    rows = rows.withColumns({
        "completed_time": F.when(done, F.col("_completed_time")),
        "updated_time": F.when(done, F.col("modified_time")),
    })
    return with_work_type(rows.drop("_completed_time", "modified_time", "deleted"), cfg)


def closed_projects_only_times(base: DataFrame) -> DataFrame:
    closed = F.coalesce("closed", F.lit(False))
    return base.withColumns({"completed_time": F.when(closed, F.col("modified_time")), "closed": closed}).drop(
        "modified_time"
    )


def legacy_inbox_projects(legacy: DataFrame, known: DataFrame) -> DataFrame:
    """Inbox projects of the first-generation feed that the replica lacks. The account is the rest of the id."""
    none = F.lit(None)
    rows = legacy.filter(F.col("id").startswith("inbox")).select(
        F.col("id").cast("string").alias("project_id"),
        F.regexp_extract("id", "^inbox(.*)$", 1).alias("account_id"),
        blank_to_null("name").alias("project_name"),
        safe_long("sortOrder").alias("sort_order"),
        blank_to_null("groupId").alias("group_id"),
        blank_to_null("kind").alias("kind"),
        blank_to_null("color").alias("color"),
        blank_to_null("viewMode").alias("view_mode"),
        blank_to_null("permission").alias("permission"),
        none.cast("string").alias("etag"),
        none.cast("string").alias("raw_json"),
        none.cast("timestamp_ntz").alias("updated_at"),
        none.cast("timestamp_ntz").alias("completed_time"),
        F.lit(False).alias("closed"),
    )
    return rows.distinct().join(known.select("project_id").distinct(), "project_id", "left_anti")


def staged_v3_projects(base: DataFrame, tasks: DataFrame, legacy: DataFrame | None = None) -> DataFrame:
    projects = closed_projects_only_times(base)
    if legacy is not None:
        projects = projects.unionByName(legacy_inbox_projects(legacy, projects))
    return join_pulse(default_group(projects), tasks)


def staged_v3_folders(base_groups: DataFrame) -> DataFrame:
    """Groups not marked deleted (an unknown mark counts as not deleted), plus default folders where missing."""
    active = base_groups.filter(~F.coalesce("deleted", F.lit(False)))
    folders = active.select(F.col("group_id").alias("folder_id"), F.col("group_name").alias("folder_name")).distinct()
    return inject_default_folders(folders)
