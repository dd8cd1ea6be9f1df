"""Business rules as columns."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Work type labels, default folder, statuses.
DEEP, SHALLOW = "🥩", "🧃"
DEFAULT_FOLDER = "default"
INBOX_FOLDER = "0"
OPEN, DONE = 0, 2
SENTINEL_TASK = "0"


def work_type(tags: Column | str, deep: Sequence[str] = (), shallow: Sequence[str] = (), enabled: bool = False) -> Column:
    """Deep or shallow work by tag overlap; an empty tag list matches tasks without tags. Deep wins."""
    if not enabled and (deep or shallow):
        return F.lit(None).cast("string")
    column = F.col(tags) if isinstance(tags, str) else tags

    def matches(wanted: Sequence[str]) -> Column:
        if wanted:
            overlap = F.arrays_overlap(column, F.array(*[F.lit(t) for t in wanted]))
            return F.coalesce(overlap, F.lit(False))
        return F.coalesce(F.size(column), F.lit(0)) <= 0

    return F.when(matches(deep), F.lit(DEEP)).when(matches(shallow), F.lit(SHALLOW))


def scope_bucket(folder_name: Column | str, project_name: Column | str, word: str | None) -> Column:
    """The word itself when it stands alone in the folder or project name, else 'rest'."""
    if not word:
        return F.lit("rest")
    names = F.lower(F.concat(_col(folder_name), F.lit(" "), _col(project_name)))
    pattern = f"(^|[^a-z0-9]){re.escape(word)}([^a-z0-9]|$)"
    return F.when(names.rlike(pattern), F.lit(word)).otherwise(F.lit("rest"))


def folder_key(group_id: Column | str) -> Column:
    """Join key of a project's folder: a missing or blank group is the default folder."""
    return F.coalesce(F.nullif(_col(group_id), F.lit("")), F.lit(DEFAULT_FOLDER))


def is_default_folder(folder_id: Column, folder_name: Column) -> Column:
    by_id = folder_id.isNull() | folder_id.isin(INBOX_FOLDER, DEFAULT_FOLDER)
    return by_id | (F.lower(F.coalesce(folder_name, F.lit(DEFAULT_FOLDER))) == DEFAULT_FOLDER)


def normalize_folder(folder_id: Column | str, folder_name: Column | str) -> tuple[Column, Column]:
    """Id and name with every spelling of the default folder mapped to 'default'."""
    fid, name = _col(folder_id), _col(folder_name)
    default = is_default_folder(fid, name)
    return (
        F.when(default, F.lit(DEFAULT_FOLDER)).otherwise(fid),
        F.when(default, F.lit(DEFAULT_FOLDER)).otherwise(name),
    )


def is_open() -> Column:
    """Status other than done. A missing status is neither open nor done."""
    return F.col("status") != DONE


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c
