"""Facts, dimensions and rollups."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tasklens.config import Settings
from tasklens.functions.dates import as_date, due_day_parts, weekday_name
from tasklens.functions.links import link_columns
from tasklens.functions.rules import DEFAULT_FOLDER, folder_key, normalize_folder, scope_bucket
from tasklens.functions.text import clean_content, stable_label, streak_text, surrogate_key
from tasklens.functions.typing import blank_to_null
from tasklens.operators import metrics
from tasklens.operators.history import SCD_ID, UPDATED_AT
from tasklens.operators.keyed import latest_by, lookup_join
from tasklens.operators.series import calendar_cross, date_spine, spine_days
from tasklens.operators.shapes import union_relations, unnest_tags_with_default
from tasklens.plans import base, staging


# First generation: full extracts and row versions.

def latest_raw_version(raw_history: DataFrame) -> DataFrame:
    """Newest version per id, picked before typing, so that dates and arrays are parsed for the kept rows only."""
    keyed = raw_history.withColumn("_key", blank_to_null("id"))
    return latest_by(keyed, ["_key"], [F.desc(UPDATED_AT), F.desc(SCD_ID)]).drop("_key")


def fct_tasks(raw_tasks: DataFrame, raw_history: DataFrame, as_of_ts: dt.datetime | str, cfg: Settings) -> DataFrame:
    tasks = base.base_tasks(raw_tasks, cfg.timezone)
    latest = base.base_tasks_snapshot(latest_raw_version(raw_history), cfg.timezone)
    return staging.staged_tasks(tasks, latest, as_of_ts, cfg, only_latest=True)


def dim_projects(raw_projects: DataFrame, raw_history: DataFrame, tasks: DataFrame, cfg: Settings) -> DataFrame:
    projects = base.base_projects(raw_projects)
    latest = base.base_projects_snapshot(latest_raw_version(raw_history), cfg.timezone)
    return staging.staged_projects(projects, latest, tasks, only_latest=True)


def dim_folders(projects: DataFrame) -> DataFrame:
    return staging.staged_folders(projects)


def dim_tags(tasks: DataFrame) -> DataFrame:
    tags = unnest_tags_with_default(tasks).select("tag").distinct()
    return tags.select(surrogate_key("tag").alias("tag_id"), "tag")


def fct_task_tags_bridge(tasks: DataFrame, tags: DataFrame | None = None) -> DataFrame:
    """Task and tag pairs. The id of a tag is computed from it, as in dim_tags of the same tasks; with a tag table from
    elsewhere it comes from there, by an inner join on the tag."""
    pairs = unnest_tags_with_default(tasks)
    if tags is None:
        return pairs.select("task_id", surrogate_key("tag").alias("tag_id"))
    return lookup_join(pairs, tags.select("tag", "tag_id"), "tag", spread="task_id", how="inner").select(
        "task_id", "tag_id"
    )


def dim_date_spine(spark: SparkSession, as_of: dt.date | str) -> DataFrame:
    return date_spine(spark, as_of)


# Third generation: replica tables.

def fct_tasks_v3(raw_tasks: DataFrame, cfg: Settings) -> DataFrame:
    return staging.staged_v3_tasks(base.base_v3_tasks(raw_tasks, cfg.timezone), cfg)


def dim_projects_v3(raw_projects: DataFrame, tasks: DataFrame, cfg: Settings,
                    legacy: DataFrame | None = None) -> DataFrame:
    return staging.staged_v3_projects(base.base_v3_projects(raw_projects, cfg.timezone), tasks, legacy)


def dim_folders_v3(raw_groups: DataFrame, cfg: Settings) -> DataFrame:
    return staging.staged_v3_folders(base.base_v3_groups(raw_groups, cfg.timezone))


def join_task_project_folder(tasks: DataFrame, projects: DataFrame, folders: DataFrame) -> DataFrame:
    """Tasks with project and folder; tasks of unknown projects stay."""
    named = projects.select(
        "project_id", F.col("project_name").alias("_project_name"), folder_key("group_id").alias("folder_id")
    )
    joined = lookup_join(tasks, named, "project_id", spread="task_id")
    joined = lookup_join(joined, folders.select("folder_id", "folder_name"), "folder_id", spread="task_id")
    return joined.withColumn(
        "project_name", F.coalesce("_project_name", "project_id", F.lit("unknown_project"))
    ).drop("_project_name")


def semantic_base(tasks: DataFrame, projects: DataFrame, folders: DataFrame, cfg: Settings) -> DataFrame:
    """One row per task with project, folder, calendar parts, scope and links."""
    columns = ["task_id", "project_id", "title", "due_date", "completed_time", "updated_time", "status", "gtd_work_type"]
    joined = join_task_project_folder(tasks.select(*columns), projects, folders)
    raw_name = F.coalesce("folder_name", F.lit(DEFAULT_FOLDER))
    folder_id, folder_name = normalize_folder(F.col("folder_id"), raw_name)
    rows = joined.withColumns({"folder_id": folder_id, "folder_name": folder_name})
    rows = rows.withColumns({
        "due_date_day": F.col("due_date").cast("date"),
        "completed_time_day": F.col("completed_time").cast("date"),
        "scope_bucket": scope_bucket("folder_name", "project_name", cfg.scope_word),
    })
    return rows.select(
        "task_id", "project_id", "project_name", "folder_id", "folder_name", "title", "due_date", "due_date_day",
        *due_day_parts(), "completed_time", "completed_time_day",
        weekday_name(F.col("completed_time_day")).alias("completed_time_day_of_week_name"),
        "updated_time", "status", "gtd_work_type", "scope_bucket", *link_columns("task", "project", "folder"),
    )


def project_catalog(projects: DataFrame, folders: DataFrame, cfg: Settings) -> DataFrame:
    """Distinct projects with normalized folder and scope."""
    keyed = projects.select(
        "project_id", F.coalesce("project_name", "project_id", F.lit("unknown_project")).alias("project_name"),
        folder_key("group_id").alias("folder_id"),
    )
    joined = lookup_join(keyed, folders.select("folder_id", "folder_name"), "folder_id", spread="project_id")
    raw_name = F.coalesce("folder_name", F.lit(DEFAULT_FOLDER))
    folder_id, folder_name = normalize_folder(F.col("folder_id"), raw_name)
    catalog = joined.select("project_id", "project_name", folder_id.alias("folder_id"), folder_name.alias("folder_name"))
    return catalog.distinct().withColumn("scope_bucket", scope_bucket("folder_name", "project_name", cfg.scope_word))


def due_workload_daily(tasks: DataFrame, projects: DataFrame, folders: DataFrame, as_of: dt.date | str,
                       cfg: Settings) -> DataFrame:
    """Open tasks per calendar day and project, zeros included.

    Tasks are counted per day and project, then packed into one map per project, which has at most one entry per calendar
    day. The join is between projects and maps, row by row, and the calendar unfolds after it: the shuffle carries
    projects, not projects times days. Since every project row becomes some ninety rows, projects are dealt over all
    shuffle partitions, which adaptive execution would otherwise merge by their small size.
    """
    due = F.col("due_date").cast("date")
    last = F.element_at(spine_days(as_of), -1)
    counts = metrics.open_task_counts(tasks.filter(due.between(F.lit(as_date(as_of)), last)))
    entry = F.struct("due_date_day", "open_task_count")
    packed = counts.groupBy("project_id").agg(F.map_from_entries(F.collect_list(entry)).alias("_counts"))
    spark = projects.sparkSession
    catalog = project_catalog(projects, folders, cfg).repartition(
        int(spark.conf.get("spark.sql.shuffle.partitions")), "project_id"
    )
    calendar = calendar_cross(catalog.join(packed, "project_id", "left"), as_of)
    found = F.coalesce(F.col("_counts")[F.col("due_date_day")], F.lit(0)).cast("bigint")
    filled = calendar.withColumn("open_task_count", found)
    return filled.select(
        surrogate_key("due_date_day", "project_id").alias("due_workload_daily_id"),
        "due_date_day", "due_date_week", "due_date_day_of_week_name", "due_date_month_num",
        "due_date_day_of_month_num", "scope_bucket", "folder_id", "folder_name", "project_id", "project_name",
        "open_task_count", *link_columns("project", "folder"),
    )


def grain_rollup(semantic: DataFrame) -> DataFrame:
    return metrics.grain_rollup(semantic)


def completed_activity(semantic: DataFrame) -> DataFrame:
    """One row per completion."""
    done = semantic.filter("status = 2 and completed_time_day is not null")
    links = [f"{g}_url_{k}" for g in ("task", "project", "folder") for k in ("path", "web", "native")]
    return done.select(
        surrogate_key("task_id", "completed_time", "updated_time").alias("completed_activity_id"),
        "task_id", "title", "project_id", "project_name", stable_label("project_name").alias("project_name_formatted"),
        "folder_id", "folder_name", "scope_bucket", "gtd_work_type", "completed_time", "completed_time_day",
        "completed_time_day_of_week_name", "updated_time", "due_date", "due_date_day", *links,
    )


# Habits.

def join_completed_description(completed: DataFrame, active: DataFrame) -> DataFrame:
    """Completions with the description of the task they belong to."""
    descriptions = active.select(F.col("id").alias("task_id"), "description")
    return lookup_join(completed, descriptions, "task_id", spread="id")


def habit_status(rows: DataFrame) -> DataFrame:
    done = F.col("completed_at").isNotNull()
    return rows.withColumns({
        "scheduled_date": F.coalesce("completed_at", "due_date"),
        "is_completed": F.when(done, F.lit("completed")).otherwise(F.lit("new")),
    })


def fct_habit(active: DataFrame, completed: DataFrame, names: tuple[str, str] = ("active_tasks", "completed_tasks"),
              ) -> DataFrame:
    """Open habits and completions stacked, with clean text, streak, one date and a status."""
    described = join_completed_description(completed, active).withColumn("id", F.col("id").cast("string"))
    rows = union_relations({names[0]: active.withColumn("task_id", F.col("id")), names[1]: described})
    rows = rows.withColumns({
        "cleaned_content": clean_content("content"),
        "streak": streak_text("description"),
    })
    return habit_status(rows).select(surrogate_key("task_id", "id").alias("surr_id"), "*")


def dim_project_habit(raw_projects: DataFrame) -> DataFrame:
    return base.base_habit_projects(raw_projects)
