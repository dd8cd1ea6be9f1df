"""Shaping of full extracts before they are stored."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Loader columns, heavy task keys, and the shape of the inbox project.
LOADER_COLUMNS = ("_airbyte_raw_id", "_airbyte_extracted_at", "_airbyte_meta", "_airbyte_generation_id")
HEAVY_TASK_KEYS = ("desc", "content", "items")
INBOX = {"name": "inbox", "sortOrder": -1, "groupId": "0", "kind": "TASK"}


def drop_meta(df: DataFrame, names: Sequence[str] = LOADER_COLUMNS) -> DataFrame:
    return df.drop(*names)


def slim(df: DataFrame, names: Sequence[str] = HEAVY_TASK_KEYS) -> DataFrame:
    return df.drop(*names)


def add_inbox(projects: DataFrame, inbox_tasks: DataFrame) -> DataFrame:
    """Open projects plus the inbox, whose id is only known from its tasks."""
    is_open = ~F.coalesce(F.col("closed"), F.lit(False))
    inbox = inbox_tasks.agg(F.min("projectId").alias("id")).filter("id is not null")
    inbox = inbox.select("id", *[F.lit(v).alias(k) for k, v in INBOX.items()])
    return projects.filter(is_open).unionByName(inbox, allowMissingColumns=True)
