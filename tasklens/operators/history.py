"""Row versions, and what they tell about completion and creation."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tasklens.functions.dates import wall_time
from tasklens.functions.rules import DONE, OPEN, SENTINEL_TASK
from tasklens.operators.keyed import latest_by

# Names of the version columns.
SCD_ID, UPDATED_AT, VALID_FROM, VALID_TO = "dbt_scd_id", "dbt_updated_at", "dbt_valid_from", "dbt_valid_to"
VERSION_COLUMNS = [SCD_ID, UPDATED_AT, VALID_FROM, VALID_TO]


def snapshot(history: DataFrame | None, current: DataFrame, key: str, run_ts: dt.datetime | str,
             strategy: str = "check", updated_at: str | None = None) -> DataFrame:
    """Row versions after one more full extract, whose keys are unique.

    A new key opens a version, a changed row closes its open version and opens another, a missing key closes its version.
    'check' compares all columns; 'timestamp' compares the column updated_at, which then also dates the versions.
    """
    now = wall_time(run_ts)
    stamp = F.col(f"new.{updated_at}").cast("timestamp_ntz") if strategy == "timestamp" else now
    payload = [c for c in current.columns if c != key]

    def opened(row: str, since: Column) -> Column:
        return F.struct(
            F.col(key), *[F.col(f"{row}.{c}").alias(c) for c in payload],
            F.md5(F.concat_ws("|", F.col(key).cast("string"), since.cast("string"))).alias(SCD_ID),
            since.alias(UPDATED_AT), since.alias(VALID_FROM), F.lit(None).cast("timestamp_ntz").alias(VALID_TO),
        )

    right = current.select(key, F.struct(*payload).alias("new"), F.lit(True).alias("_in_new"))
    if history is None:
        return right.select(opened("new", stamp).alias("v")).select("v.*")

    left = history.filter(F.col(VALID_TO).isNull()).select(
        key, F.struct(*payload, *VERSION_COLUMNS).alias("old"), F.lit(True).alias("_in_old")
    )
    both = left.join(right, key, "full_outer")
    if strategy == "timestamp":
        changed = F.col(f"new.{updated_at}") > F.col(f"old.{updated_at}")
    else:
        changed = F.lit(False)
        for c in payload:
            changed = changed | ~F.col(f"old.{c}").eqNullSafe(F.col(f"new.{c}"))
    changed = F.coalesce(changed, F.lit(False))
    gone = F.col("_in_new").isNull()
    added = F.col("_in_old").isNull()
    valid_to = F.when(gone, now).when(changed, stamp)
    kept = F.struct(
        F.col(key), *[F.col(f"old.{c}").alias(c) for c in payload + VERSION_COLUMNS[:3]], valid_to.alias(VALID_TO)
    )
    versions = F.array(F.when(~added, kept), F.when(added | (~gone & changed), opened("new", stamp)))
    rows = both.select(F.explode(F.filter(versions, lambda v: v.isNotNull())).alias("v")).select("v.*")
    return history.filter(F.col(VALID_TO).isNotNull()).unionByName(rows)


def latest_version(history: DataFrame, key: str) -> DataFrame:
    """Newest version per key; the version id settles ties."""
    return latest_by(history, [key], [F.desc(UPDATED_AT), F.desc(SCD_ID)])


def closed_latest(history: DataFrame, key: str, only_latest: bool = False) -> DataFrame:
    """Keys whose newest version has ended. only_latest says that the history holds newest versions already."""
    latest = history if only_latest else latest_version(history, key)
    return latest.filter(F.col(VALID_TO).isNotNull())


def infer_completion(open_rows: DataFrame, history: DataFrame, key: str = "task_id",
                     sentinel: str = SENTINEL_TASK, only_latest: bool = False) -> DataFrame:
    """Tasks with a status: open ones from the extract, done ones from versions that ended. The sentinel row is left out
    of the open ones; it is added by the load banner."""
    shared = [c for c in open_rows.columns if c not in {"title", "_completed_time", "status"}]
    none = F.lit(None).cast("timestamp_ntz")
    still_open = open_rows.filter(F.col(key) != sentinel).select(
        *shared, "title", none.alias("completed_time"), none.alias("updated_time"),
        F.lit(OPEN).cast("bigint").alias("status"),
    )
    done = closed_latest(history, key, only_latest).select(
        *shared, "title", F.col(VALID_TO).alias("completed_time"), F.col(UPDATED_AT).alias("updated_time"),
        F.lit(DONE).cast("bigint").alias("status"),
    )
    return still_open.unionByName(done)


def infer_project_completion(open_rows: DataFrame, history: DataFrame, key: str = "project_id",
                             only_latest: bool = False) -> DataFrame:
    """Projects: closed is false for extracted ones and true for those whose newest version has ended."""
    shared = [c for c in open_rows.columns if c != "closed"]
    present = open_rows.select(
        *shared, F.lit(None).cast("timestamp_ntz").alias("completed_time"), F.lit(False).alias("closed")
    )
    ended = closed_latest(history, key, only_latest).select(
        *shared, F.col(VALID_TO).alias("completed_time"), F.lit(True).alias("closed")
    )
    return present.unionByName(ended)


def created_time(history: DataFrame, key: str) -> DataFrame:
    """First time each key was seen."""
    return history.groupBy(key).agg(F.min(VALID_FROM).alias("created_time"))


def next_load_banner(open_rows: DataFrame, as_of_ts: dt.datetime | str, load_interval: int | None,
                     key: str = "task_id", sentinel: str = SENTINEL_TASK) -> DataFrame:
    """The sentinel row, whose completion time is the last load: its title says when the next load is due."""
    shared = [c for c in open_rows.columns if c not in {"title", "_completed_time", "status"}]
    title = F.col("title")
    if load_interval:
        due = F.date_trunc("minute", F.col("_completed_time")) + F.make_interval(mins=F.lit(int(load_interval)))
        now = F.date_trunc("minute", wall_time(as_of_ts))
        minutes = F.timestamp_diff("MINUTE", now.cast("timestamp_ntz"), due.cast("timestamp_ntz"))
        # The two banner texts.
        soon = F.concat(F.lit("🏗️ in "), minutes.cast("string"), F.lit(" minutes"))
        title = F.when(minutes > 0, soon).otherwise(F.lit("🟢 now"))
    return open_rows.filter(F.col(key) == sentinel).select(
        *shared, title.alias("title"), F.lit(None).cast("timestamp_ntz").alias("completed_time"),
        F.col("_completed_time").cast("timestamp_ntz").alias("updated_time"),
        F.lit(OPEN).cast("bigint").alias("status"),
    )
