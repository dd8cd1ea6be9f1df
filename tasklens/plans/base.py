"""Base models: source columns renamed, typed and cleaned."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tasklens.functions.json import JsonDoc, with_json
from tasklens.functions.typing import (
    blank_to_null,
    clean_string_array,
    flag_from_int_or_json,
    parse_malformed_array,
    safe_bool,
    safe_long,
    safe_timestamp,
    to_local_datetime,
)


def _texts(names: dict[str, str]) -> list[Column]:
    return [blank_to_null(source).alias(target) for source, target in names.items()]


def _local(names: dict[str, str], tz: str) -> list[Column]:
    return [to_local_datetime(source, tz).alias(target) for source, target in names.items()]


# Source columns and their names in the models.
_PROJECT_TEXT = {
    "id": "project_id", "name": "project_name", "groupId": "group_id", "kind": "kind", "color": "color",
    "viewMode": "view_mode", "permission": "permission",
}
_TASK_TEXT = {
    "id": "task_id", "projectId": "project_id", "title": "title", "timeZone": "timezone", "columnId": "column_id",
    "etag": "etag", "kind": "kind", "repeatFlag": "repeat_flag", "parentId": "parent_id",
}
_TASK_LONG = {"sortOrder": "sort_order", "priority": "priority", "status": "status"}
_TASK_TIME = {"startDate": "start_date", "dueDate": "due_date", "completedTime": "_completed_time"}
_VERSION_TIME = {c: c for c in ("dbt_updated_at", "dbt_valid_from", "dbt_valid_to")}


def base_projects(raw: DataFrame) -> DataFrame:
    return raw.select(*_project_columns())


def base_projects_snapshot(raw: DataFrame, tz: str) -> DataFrame:
    return raw.select(
        *_project_columns(), blank_to_null("dbt_scd_id").alias("dbt_scd_id"), *_local(_VERSION_TIME, tz)
    )


def _project_columns() -> list[Column]:
    return [
        *_texts(_PROJECT_TEXT),
        F.col("sortOrder").cast("bigint").alias("sort_order"),
        F.col("closed").cast("boolean").alias("closed"),
    ]


def base_tasks(raw: DataFrame, tz: str) -> DataFrame:
    arrays = {"tags": "tags", "childIds": "childids", "reminders": "reminders"}
    return raw.select(
        *_task_columns(tz), *[clean_string_array(source).alias(target) for source, target in arrays.items()]
    )


def base_tasks_snapshot(raw: DataFrame, tz: str) -> DataFrame:
    return raw.select(
        *_task_columns(tz),
        parse_malformed_array("tags").alias("tags"),
        parse_malformed_array("childIds").alias("childids"),
        parse_malformed_array("reminders", quoted=True).alias("reminders"),
        blank_to_null("dbt_scd_id").alias("dbt_scd_id"),
        *_local(_VERSION_TIME, tz),
    )


def _task_columns(tz: str) -> list[Column]:
    return [
        *_texts(_TASK_TEXT),
        *[F.col(source).cast("bigint").alias(target) for source, target in _TASK_LONG.items()],
        F.col("isAllDay").cast("boolean").alias("is_allday"),
        *_local(_TASK_TIME, tz),
    ]


def base_v3_tasks(raw: DataFrame, tz: str) -> DataFrame:
    """Replica tasks: the typed column first, the payload text where it is NULL."""
    parsed = with_json(
        raw, "raw_json",
        scalars=["sortOrder", "timeZone", "isAllDay", "isFloating", "reminder", "priority", "progress", "repeatFlag",
                 "startDate", "dueDate", "repeatFirstDate", "completedTime", "parentId"],
        arrays=["tags", "childIds", "reminders"],
    )
    doc = JsonDoc()

    def text(column: str, key: str | None = None) -> Column:
        value = blank_to_null(column)
        return F.coalesce(value, F.nullif(doc.scalar(key), F.lit(""))) if key else value

    def number(column: str, key: str | None = None) -> Column:
        value = safe_long(column)
        return F.coalesce(value, safe_long(doc.scalar(key))) if key else value

    def flag(column: str, key: str) -> Column:
        return F.coalesce(F.col(column).cast("boolean"), safe_bool(doc.scalar(key)))

    def time(column: str, key: str | None = None) -> Column:
        value = safe_timestamp(column)
        return to_local_datetime(F.coalesce(value, safe_timestamp(doc.scalar(key))) if key else value, tz)

    columns = {
        "task_id": text("task_id"), "account_id": text("account_id"), "project_id": text("project_id"),
        "sort_order": number("sort_order", "sortOrder"), "title": text("title"), "content": text("content"),
        "timezone": text("timezone", "timeZone"), "is_allday": flag("is_all_day", "isAllDay"),
        "is_floating": flag("is_floating", "isFloating"), "reminder": text("reminder", "reminder"),
        "priority": number("priority", "priority"), "progress": number("progress", "progress"),
        "status": number("status"), "deleted": number("deleted"), "column_id": text("column_id"),
        "etag": text("etag"), "kind": text("kind"), "repeat_flag": text("repeat_flag", "repeatFlag"),
        "completed_user_id": text("completed_user_id"), "creator": number("creator"),
        "parent_id": text("parent_id", "parentId"), "tags": doc.string_array("tags"),
        "childids": doc.string_array("childIds"), "reminders": doc.string_array("reminders"),
        "raw_json": F.col("raw_json"), "start_date": time("start_date", "startDate"),
        "due_date": time("due_date", "dueDate"), "repeat_first_date": time("repeat_first_date", "repeatFirstDate"),
        "_completed_time": time("completed_time", "completedTime"), "created_time": time("created_time"),
        "modified_time": time("modified_time"), "updated_at": time("updated_at"),
    }
    return parsed.select(*[c.alias(name) for name, c in columns.items()])


def base_v3_projects(raw: DataFrame, tz: str) -> DataFrame:
    parsed = with_json(raw, "raw_json", scalars=["sortOrder", "color", "permission", "closed"])
    doc = JsonDoc()
    return parsed.select(
        *_texts({"project_id": "project_id", "account_id": "account_id", "name": "project_name",
                 "group_id": "group_id", "kind": "kind", "view_mode": "view_mode", "etag": "etag"}),
        F.coalesce(safe_long("sort_order"), safe_long(doc.scalar("sortOrder"))).alias("sort_order"),
        F.nullif(doc.scalar("color"), F.lit("")).alias("color"),
        F.nullif(doc.scalar("permission"), F.lit("")).alias("permission"),
        flag_from_int_or_json("closed", doc.scalar("closed")).alias("closed"),
        "raw_json",
        to_local_datetime(safe_timestamp("modified_time"), tz).alias("modified_time"),
        to_local_datetime(safe_timestamp("updated_at"), tz).alias("updated_at"),
    )


def base_v3_groups(raw: DataFrame, tz: str) -> DataFrame:
    parsed = with_json(raw, "raw_json", scalars=["deleted", "sortOrder", "viewMode"])
    doc = JsonDoc()
    return parsed.select(
        *_texts({"group_id": "group_id", "account_id": "account_id", "name": "group_name",
                 "sort_type": "sort_type", "etag": "etag"}),
        flag_from_int_or_json("deleted", doc.scalar("deleted")).alias("deleted"),
        F.coalesce(safe_long("sort_order"), safe_long(doc.scalar("sortOrder"))).alias("sort_order"),
        F.nullif(doc.scalar("viewMode"), F.lit("")).alias("view_mode"),
        "raw_json",
        to_local_datetime(safe_timestamp("updated_at"), tz).alias("updated_at"),
    )


def base_habit_active(raw: DataFrame, tz: str) -> DataFrame:
    times = ("completed_at", "updated_at", "added_at")
    due = ("is_recurring", "lang", "timezone", "string")
    plain = [c for c in raw.columns if c not in {*times, "due"}]
    return raw.select(
        *plain,
        *[F.col(f"due.{c}").alias(f"due_{c}") for c in due],
        *_local({c: c for c in times}, tz),
        to_local_datetime("due.date", tz).alias("due_date"),
    )


def base_habit_completed(raw: DataFrame, tz: str) -> DataFrame:
    return raw.withColumn("completed_at", to_local_datetime("completed_at", tz))


# Columns kept of a habit project.
HABIT_PROJECT_COLUMNS = [
    "parent_id", "is_collapsed", "role", "public_key", "inbox_project", "view_style", "updated_at", "is_shared",
    "default_order", "name", "is_deleted", "public_access", "is_archived", "description", "color", "creator_uid",
    "is_frozen", "child_order", "created_at", "can_assign_tasks", "is_favorite", "id",
]


def base_habit_projects(raw: DataFrame) -> DataFrame:
    return raw.select(*HABIT_PROJECT_COLUMNS)


def base_habit_archived(raw: DataFrame) -> DataFrame:
    return raw
