"""Column types of every source table. Reads always pass one of these; nothing is inferred.

The names and types are fixed values of the source feeds.
"""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DataType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

_TYPES = {
    "string": StringType(), "bigint": LongType(), "boolean": BooleanType(), "timestamp": TimestampType(),
    "strings": ArrayType(StringType()),
}


def _table(text: str, **nested: DataType) -> StructType:
    """Struct of 'name type' pairs, followed by nested columns."""
    pairs = [pair.split() for pair in text.split(",")]
    fields = [StructField(name, _TYPES[kind]) for name, kind in pairs]
    return StructType(fields + [StructField(name, kind) for name, kind in nested.items()])


_TASK = """
    id string, projectId string, parentId string, title string, timeZone string, columnId string, etag string,
    kind string, repeatFlag string, sortOrder bigint, priority bigint, status bigint, isAllDay boolean,
    startDate timestamp, dueDate timestamp, completedTime timestamp
"""
_VERSION = "dbt_scd_id string, dbt_updated_at timestamp, dbt_valid_from timestamp, dbt_valid_to string"
_PROJECT = """
    id string, name string, groupId string, kind string, color string, viewMode string, permission string,
    sortOrder bigint, closed boolean
"""

TASKS = _table(_TASK + ", tags strings, childIds strings, reminders strings")
TASKS_SNAPSHOT = _table(_TASK + ", tags string, childIds string, reminders string, " + _VERSION)
PROJECTS = _table(_PROJECT)
PROJECTS_SNAPSHOT = _table(_PROJECT + ", " + _VERSION)

TASKS_V3 = _table("""
    task_id string, account_id string, project_id string, sort_order bigint, title string, content string,
    timezone string, is_floating boolean, is_all_day boolean, reminder string, priority bigint, status bigint,
    deleted bigint, progress bigint, start_date timestamp, due_date timestamp, repeat_flag string,
    repeat_first_date timestamp, completed_time timestamp, completed_user_id string, creator bigint,
    parent_id string, created_time timestamp, modified_time timestamp, kind string, column_id string,
    etag string, raw_json string, updated_at timestamp
""")
PROJECTS_V3 = _table("""
    project_id string, account_id string, name string, group_id string, closed bigint, sort_order bigint,
    kind string, view_mode string, modified_time timestamp, etag string, raw_json string, updated_at timestamp
""")
GROUPS_V3 = _table("""
    group_id string, account_id string, name string, deleted bigint, sort_order bigint, sort_type string,
    etag string, raw_json string, updated_at timestamp
""")
REPLICA = {"tasks": TASKS_V3, "projects": PROJECTS_V3, "groups": GROUPS_V3}
REPLICA_KEY = {"tasks": "task_id", "projects": "project_id", "groups": "group_id"}

HABIT_ACTIVE = _table("""
    id string, project_id string, section_id string, parent_id string, content string, description string,
    assigned_by_uid string, responsible_uid string, deadline string, duration string, completed_at string,
    user_id bigint, added_by_uid bigint, priority bigint, note_count bigint, day_order bigint, child_order bigint,
    checked boolean, is_collapsed boolean, is_deleted boolean, added_at timestamp, updated_at timestamp,
    labels strings
""", due=_table("is_recurring boolean, lang string, timezone string, string string, date string"))
HABIT_COMPLETED = _table("""
    id bigint, user_id bigint, note_count bigint, task_id string, project_id string, section_id string,
    content string, meta_data string, item_object string, completed_at timestamp, notes strings
""")
HABIT_PROJECTS = _table("""
    id string, parent_id string, name string, description string, color string, role string, public_key string,
    view_style string, creator_uid bigint, default_order bigint, child_order bigint, inbox_project boolean,
    is_collapsed boolean, is_shared boolean, is_deleted boolean, public_access boolean, is_archived boolean,
    is_frozen boolean, can_assign_tasks boolean, is_favorite boolean, created_at timestamp, updated_at timestamp
""")
HABIT_ARCHIVED = _table("json string")

# One poll. List items stay JSON text: a payload is kept whole and typed only after the newest one is known.
DELTA = _table("""
    checkPoint bigint, projectProfiles strings, projectGroups strings
""", syncTaskBean=_table("update strings, delete strings, add strings, empty boolean"))

# JSON key and type behind each replica column, by entity.
PAYLOAD = {
    "tasks": {
        "project_id": ("projectId", "string"), "sort_order": ("sortOrder", "bigint"), "title": ("title", "string"),
        "content": ("content", "string"), "timezone": ("timeZone", "string"),
        "is_floating": ("isFloating", "boolean"), "is_all_day": ("isAllDay", "boolean"),
        "reminder": ("reminder", "string"), "priority": ("priority", "bigint"), "status": ("status", "bigint"),
        "deleted": ("deleted", "bigint"), "progress": ("progress", "bigint"), "etag": ("etag", "string"),
        "start_date": ("startDate", "timestamp"), "due_date": ("dueDate", "timestamp"),
        "repeat_flag": ("repeatFlag", "string"), "repeat_first_date": ("repeatFirstDate", "timestamp"),
        "modified_time": ("modifiedTime", "timestamp"), "created_time": ("createdTime", "timestamp"),
        "completed_time": ("completedTime", "timestamp"), "completed_user_id": ("completedUserId", "string"),
        "creator": ("creator", "bigint"), "parent_id": ("parentId", "string"), "column_id": ("columnId", "string"),
        "kind": ("kind", "string"),
    },
    "projects": {
        "name": ("name", "string"), "group_id": ("groupId", "string"), "closed": ("closed", "flag"),
        "sort_order": ("sortOrder", "bigint"), "etag": ("etag", "string"),
        "modified_time": ("modifiedTime", "timestamp"), "kind": ("kind", "string"),
        "view_mode": ("viewMode", "string"),
    },
    "groups": {
        "name": ("name", "string"), "deleted": ("deleted", "flag"), "sort_order": ("sortOrder", "bigint"),
        "etag": ("etag", "string"), "sort_type": ("sortType", "string"),
    },
}
