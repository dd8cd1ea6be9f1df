"""Deep links to a task, project or folder."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Link formats of the task application and its two schemes.
APP = "ticktick.com/webapp/"
WEB = "https://"
NATIVE = "ticktick://"


def task_path(project_id: Column, task_id: Column) -> Column:
    return F.concat(F.lit(APP + "#p/"), project_id, F.lit("/tasks/"), task_id)


def project_path(project_id: Column) -> Column:
    return F.concat(F.lit(APP + "#p/"), project_id, F.lit("/tasks"))


def folder_path(folder_id: Column) -> Column:
    return F.concat(F.lit(APP + "#g/"), folder_id)


def link_columns(*grains: str) -> list[Column]:
    """Columns <grain>_url_path, _web and _native, with stand-ins for missing ids."""
    project = F.coalesce(F.col("project_id"), F.lit("unknown_project"))
    paths = {
        "project": lambda: project_path(project),
        "folder": lambda: folder_path(F.coalesce(F.col("folder_id"), F.lit("default"))),
        "task": lambda: task_path(project, F.coalesce(F.col("task_id"), F.lit("unknown_task"))),
    }
    columns = []
    for grain in grains:
        path = paths[grain]()
        columns += [
            path.alias(f"{grain}_url_path"),
            F.concat(F.lit(WEB), path).alias(f"{grain}_url_web"),
            F.concat(F.lit(NATIVE), path).alias(f"{grain}_url_native"),
        ]
    return columns


def url_metadata(task_id: Column | str = "task_id", project_id: Column | str = "project_id",
                 folder_id: Column | str = "folder_id") -> Column:
    """JSON text with the three paths of a row."""
    task, project, folder = (F.col(c) if isinstance(c, str) else c for c in (task_id, project_id, folder_id))
    paths = F.struct(
        task_path(project, task).alias("task"),
        project_path(project).alias("project"),
        folder_path(folder).alias("folder"),
    )
    return F.when(F.concat(task, project, folder).isNotNull(), F.to_json(paths))


PARENT_GRAIN = {"task": "project", "project": "folder", "folder": "folder"}


def grain_url(grain: str) -> Column:
    """Path of the row at the chosen grain."""
    return {
        "task": lambda: task_path(F.col("project_id"), F.col("task_id")),
        "project": lambda: project_path(F.col("project_id")),
        "folder": lambda: folder_path(F.col("folder_id")),
    }[grain]()


def parent_grain_url(grain: str) -> Column:
    return grain_url(PARENT_GRAIN[grain])
