"""Calendars, weekly statistics and habit streaks."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tasklens.functions.dates import as_date, due_day_parts, monday_week, sunday_week
from tasklens.functions.rules import DONE
from tasklens.operators.keyed import latest_by

MISSED = -1
# Weekday codes of a repeat rule, Sunday first.
RULE_DAYS = ["SU", "MO", "TU", "WE", "TH", "FR", "SA"]


def spine_days(as_of: dt.date | str | Column, months: int = 3) -> Column:
    """Array of the days from as_of for some months, last day excluded."""
    start = as_of if isinstance(as_of, Column) else F.lit(as_date(as_of))
    return F.sequence(start, F.date_sub(F.add_months(start, months), 1))


def date_spine(spark: SparkSession, as_of: dt.date | str, months: int = 3) -> DataFrame:
    return spark.range(1).select(F.explode(spine_days(as_of, months)).alias("date_day"))


def date_spine_after(rows: DataFrame, column: str, months: int = 3) -> DataFrame:
    """The spine that starts on the newest day of a column."""
    newest = rows.agg(F.max(F.col(column).cast("date")).alias("_start"))
    return newest.select(F.explode(spine_days(F.col("_start"), months)).alias("date_day"))


def calendar_cross(entities: DataFrame, as_of: dt.date | str, months: int = 3,
                   day: str = "due_date_day") -> DataFrame:
    """Every entity on every day of the calendar. Each row expands in place: no join and no shuffle."""
    return entities.withColumn(day, F.explode(spine_days(as_of, months))).select("*", *due_day_parts(day))


def calendar_fill(calendar: DataFrame, counts: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Counts on the calendar, zero where there is none. Both sides have one row per key."""
    filled = calendar.join(counts, list(keys), "left")
    return filled.withColumn(value, F.coalesce(value, F.lit(0)).cast("bigint"))


def week_dense_rank(daily: DataFrame, day: str = "due_date_day") -> DataFrame:
    """Number of each day's Monday week among the weeks present. For aggregated days: one row per calendar day."""
    return daily.withColumn("week_num", F.dense_rank().over(W.orderBy(monday_week(F.col(day)))).cast("bigint"))


def ceil_avg(c: Column | str) -> Column:
    return F.ceil(F.avg(c)).cast("bigint")


def has_tag(tag: str, tags: str = "tags") -> Column:
    return F.coalesce(F.exists(tags, lambda t: F.trim(t) == tag), F.lit(False))


def semi_join_tag(tasks: DataFrame, tag: str) -> DataFrame:
    """Tasks that carry a tag, ignoring blanks around it."""
    return tasks.filter(has_tag(tag))


def habit_tasks(tasks: DataFrame, tag: str = "habit") -> DataFrame:
    """Tagged tasks that repeat."""
    return semi_join_tag(tasks, tag).filter("repeat_flag is not null and repeat_flag <> ''")


def habit_start(habits: DataFrame) -> DataFrame:
    """Earliest start or due day of each habit."""
    return habits.groupBy("task_id").agg(F.min(F.least(*_days())).alias("habit_start_date"))


def habit_schedule(habits: DataFrame) -> DataFrame:
    """Start day and newest repeat rule of each habit, in one aggregation."""
    newest = F.struct(F.coalesce("due_date", "start_date"), F.col("repeat_flag"))
    return habits.groupBy("task_id").agg(
        F.min(F.least(*_days())).alias("habit_start_date"), F.max_by("repeat_flag", newest).alias("repeat_flag")
    )


def rrule_columns(repeat_flag: Column | str = "repeat_flag") -> list[Column]:
    """Frequency, interval (1 unless given) and weekday codes of a repeat rule; NULL where the rule has none."""
    rule = F.col(repeat_flag) if isinstance(repeat_flag, str) else repeat_flag

    def part(pattern: str) -> Column:
        return F.nullif(F.regexp_extract(rule, pattern, 1), F.lit(""))

    interval = part(r"INTERVAL=(\d+)").try_cast("int")
    return [
        part("FREQ=([A-Z]+)").alias("frequency"),
        F.greatest(F.coalesce(interval, F.lit(1)), F.lit(1)).alias("interval"),
        F.split(part("BYDAY=([A-Z,]+)"), ",").alias("by_day"),
    ]


def habit_expected_days(schedule: DataFrame, as_of: dt.date | str) -> DataFrame:
    """Days each habit was due up to as_of. Daily rules step from the start day; weekly rules step from the Sunday of
    the start week and take the listed weekdays, or the start's own weekday when none is listed.

    Days are generated per habit, so the row count is that of the answer.
    """
    rules = schedule.select("task_id", "habit_start_date", *rrule_columns())
    start, end, step = F.col("habit_start_date"), F.lit(as_date(as_of)), F.col("interval")
    usable = rules.filter(start <= end)

    def steps(first: Column, days: Column) -> Column:
        return F.sequence(first, end, F.make_dt_interval(days=days))

    codes = F.array(*[F.lit(d) for d in RULE_DAYS])
    own_day = F.array(F.element_at(codes, F.dayofweek(start)))
    offsets = F.transform(
        F.array_distinct(F.coalesce("by_day", own_day)), lambda d: F.array_position(codes, d).cast("int")
    )
    weekly = F.flatten(F.transform(
        steps(sunday_week(start), step * 7),
        lambda week: F.transform(F.filter(offsets, lambda o: o > 0), lambda o: F.date_add(week, o - 1)),
    ))
    days = (
        F.when(F.col("frequency") == "DAILY", steps(start, step))
        .when(F.col("frequency") == "WEEKLY", F.filter(weekly, lambda d: (d >= start) & (d <= end)))
    )
    return usable.select("task_id", F.explode(days).alias("expected_date"))


def first_completions(habits: DataFrame) -> DataFrame:
    """First completion of each habit on each day."""
    done = habits.filter(F.col("status") == DONE).withColumn("expected_date", F.col("completed_time").cast("date"))
    done = done.select("task_id", "expected_date", "completed_time", "title")
    return latest_by(done, ["task_id", "expected_date"], [F.asc("completed_time"), F.asc("title")])


def habit_log(expected: DataFrame, completions: DataFrame) -> DataFrame:
    """Every expected day, done (2) or missed (-1)."""
    joined = expected.join(completions, ["task_id", "expected_date"], "left")
    status = F.when(F.col("completed_time").isNotNull(), F.lit(DONE)).otherwise(F.lit(MISSED)).cast("bigint")
    return joined.select("task_id", "expected_date", status.alias("status"), "completed_time", "title")


def running_streak(log: DataFrame) -> DataFrame:
    """Length of the run of done days that each done day ends; a miss starts again. NULL on misses.

    The log has one row per habit and day, so the longest partition is the calendar itself.
    """
    order = W.partitionBy("task_id").orderBy("expected_date")
    so_far = order.rowsBetween(W.unboundedPreceding, W.currentRow)
    done = F.col("status") == DONE
    counted = log.withColumn("_done", F.sum(F.when(done, 1).otherwise(0)).over(so_far))
    at_last_miss = F.coalesce(F.max(F.when(~done, F.col("_done"))).over(so_far), F.lit(0))
    streak = F.when(done, F.col("_done") - at_last_miss).cast("bigint")
    return counted.withColumn("habit_streak", streak).drop("_done")


def habit_streaks(tasks: DataFrame, as_of: dt.date | str, tag: str = "habit") -> DataFrame:
    """Expected days of every habit with status and running streak."""
    habits = habit_tasks(tasks, tag)
    expected = habit_expected_days(habit_schedule(habits), as_of)
    log = running_streak(habit_log(expected, first_completions(habits)))
    return log.select("task_id", "title", "expected_date", "status", "completed_time", "habit_streak")


def _days() -> list[Column]:
    return [F.col("due_date").cast("date"), F.col("start_date").cast("date")]
