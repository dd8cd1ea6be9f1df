"""Dashboard questions. Each takes marts and the reader's choices and returns the rows of one panel."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tasklens.functions.dates import as_date, due_day_parts, iso_weekday, monday_week
from tasklens.functions.rules import DONE, OPEN, SENTINEL_TASK
from tasklens.functions.text import slash_label, stable_label, streak_count
from tasklens.operators.keyed import lookup_join
from tasklens.operators.metrics import metric, open_task_counts
from tasklens.operators.series import calendar_cross, ceil_avg, week_dense_rank
from tasklens.operators.shapes import pivot_series, topn_sorted
from tasklens.plans.explore import (
    PROJECT_COLUMNS,
    Model,
    Params,
    all_of,
    any_of,
    explore_query,
    field_filter,
    filter_relative_date,
    param_grain,
)

WEEKS = 5


def regex_name_filter(column: str, names: Sequence[str] | None = None, pattern: str | None = None) -> Column:
    """Name in a list, or matching a pattern as a whole. Neither given, or an empty list, selects everything."""
    if names:
        return F.col(column).isin(*names)
    if pattern is not None:
        return F.col(column).rlike(f"^(?:{pattern})$")
    return F.lit(True)


def panel_filter(scope: str = "all", folders: Sequence[str] | str | None = None,
                 projects: Sequence[str] | str | None = None, grain: str | None = None) -> Column:
    """Scope, folder and project choices. A string is a pattern, a list is names. Folder rows have no project."""

    def chosen(column: str, value: Sequence[str] | str | None) -> Column:
        return regex_name_filter(column, pattern=value) if isinstance(value, str) else regex_name_filter(column, value)

    conditions = [chosen("folder_name", folders)]
    if scope != "all":
        conditions.append(F.col("scope_bucket") == scope)
    if grain != "folder":
        conditions.append(chosen("project_name", projects))
    return all_of(*conditions)


def lookahead_end(as_of: dt.date | str) -> dt.date:
    """First day after five Monday weeks, this one included."""
    day = as_date(as_of)
    return day - dt.timedelta(days=day.weekday()) + dt.timedelta(weeks=WEEKS)


def lookahead_5w(workload: DataFrame, as_of: dt.date | str, scope: str = "all",
                 folders: Sequence[str] | str | None = None, projects: Sequence[str] | str | None = None) -> DataFrame:
    """Open tasks per day of the coming five weeks, one column per week, with rounded-up week and overall averages.

    Reads the stored workload mart. lookahead_of_tasks answers the same from the tasks.
    """
    rows = workload.filter(_five_weeks(as_of) & panel_filter(scope, folders, projects))
    return lookahead_rows(rows.groupBy("due_date_day").agg(F.sum("open_task_count").alias("daily_tasks")))


def daily_open_tasks(tasks: DataFrame, catalog: DataFrame, as_of: dt.date | str, scope: str = "all",
                     folders: Sequence[str] | str | None = None,
                     projects: Sequence[str] | str | None = None) -> DataFrame:
    """Open tasks per day of the coming five weeks over the chosen catalog projects, zeros included.

    Tasks shrink to one row per day and project before they meet the catalog. Days without tasks come from the calendar
    of any one chosen project, so the calendar of all projects is not built.
    """
    chosen = catalog.filter(panel_filter(scope, folders, projects))
    due = F.col("due_date").cast("date")
    counts = open_task_counts(tasks.filter((due >= F.lit(as_date(as_of))) & (due < F.lit(lookahead_end(as_of)))))
    found = counts.join(chosen.select("project_id"), "project_id").select("due_date_day", "open_task_count")
    zeros = calendar_cross(chosen.select("project_id").limit(1), as_of).filter(_five_weeks(as_of)).select(
        "due_date_day", F.lit(0).cast("bigint").alias("open_task_count")
    )
    return found.unionByName(zeros).groupBy("due_date_day").agg(F.sum("open_task_count").alias("daily_tasks"))


def lookahead_of_tasks(tasks: DataFrame, catalog: DataFrame, as_of: dt.date | str, scope: str = "all",
                       folders: Sequence[str] | str | None = None,
                       projects: Sequence[str] | str | None = None) -> DataFrame:
    """The five-week lookahead without a stored workload mart."""
    return lookahead_rows(daily_open_tasks(tasks, catalog, as_of, scope, folders, projects))


def _five_weeks(as_of: dt.date | str) -> Column:
    day = F.col("due_date_day")
    return (day >= F.lit(as_date(as_of))) & (day < F.lit(lookahead_end(as_of)))


def lookahead_rows(daily: DataFrame) -> DataFrame:
    """Lookahead layout of daily sums. They are at most 35 rows, so ranks and averages are windows over those."""
    day = F.col("due_date_day")
    ranked = week_dense_rank(daily).filter(F.col("week_num") <= WEEKS)
    in_week = F.col("week_num")
    rows = ranked.withColumns({
        "Week Avg": F.ceil(F.avg("daily_tasks").over(W.partitionBy("week_num"))).cast("bigint"),
        "Global Avg": F.ceil(F.avg("daily_tasks").over(W.partitionBy())).cast("bigint"),
    })
    weeks = [F.when(in_week == n, F.col("daily_tasks")).alias(f"W{n}") for n in range(1, WEEKS + 1)]
    return rows.select(
        day.cast("timestamp_ntz").alias("time"), *weeks, "Week Avg", "Global Avg", iso_weekday(day).alias("weekday_code")
    ).orderBy("time")


def week_averages(daily: DataFrame) -> DataFrame:
    """Rounded-up average of each week."""
    return week_dense_rank(daily).groupBy("week_num").agg(ceil_avg("daily_tasks").alias("week_avg"))


def _ahead(as_of: dt.date | str, days: int) -> Column:
    today = F.lit(as_date(as_of))
    return F.col("due_date_day").between(today, F.date_add(today, days))


def drill_down_by_grain(rollup: DataFrame, as_of: dt.date | str, grain: str = "task", days: int = 35,
                        scope: str = "all", folders=None, projects=None, limit: int = 1000) -> DataFrame:
    """Rows of one grain in the coming days, with labels and links."""
    rows = rollup.filter(
        _ahead(as_of, days) & (F.col("grain_level") == grain) & panel_filter(scope, folders, projects, grain)
    )
    order = [F.asc("due_date_day"), F.asc("parent_grain_label"), F.desc("task_count"), F.asc("grain_rollup_id")]
    top = topn_sorted(rows, order, limit)
    label = stable_label("grain_label") if grain in ("project", "folder") else F.col("grain_label")
    return top.select(
        "due_date_day", F.col("due_date_day_of_week_name").alias("day"),
        F.date_format("due_date_day", "MM/dd").alias("date_mmdd"),
        stable_label("parent_grain_label").alias("parent"), label.alias("grain"), "task_count",
        "parent_grain_url_web", "parent_grain_url_native", "grain_url_web", "grain_url_native",
    )


def distribution_by_parent(rollup: DataFrame, as_of: dt.date | str, grain: str = "task", days: int = 35,
                           scope: str = "all", folders=None, projects=None) -> DataFrame:
    """Open tasks per day and parent."""
    rows = rollup.filter(
        _ahead(as_of, days) & (F.col("grain_level") == grain) & panel_filter(scope, folders, projects, grain)
    )
    counted = rows.groupBy("due_date_day", "parent_grain_label").agg(F.sum("task_count").alias("open_tasks"))
    # The label follows from the name, and two names may share a label's glyph but never the label.
    labelled = counted.withColumn("parent_grain_label", stable_label("parent_grain_label"))
    return labelled.orderBy(F.asc("due_date_day"), F.desc("open_tasks"), F.asc("parent_grain_label"))


def what_did_you_do(activity: DataFrame, as_of: dt.date | str, days: int = 2, scope: str = "all", folders=None,
                    projects=None, limit: int = 500) -> DataFrame:
    """Completions of the last days that had a due date, newest first."""
    today = F.lit(as_date(as_of))
    recent = F.col("completed_time_day").between(F.date_sub(today, days), today)
    rows = activity.filter(F.col("due_date").isNotNull() & recent & panel_filter(scope, folders, projects))
    order = [F.desc("completed_time_day"), F.desc("updated_time"), F.asc("completed_activity_id"), F.asc("task_id")]
    return topn_sorted(rows, order, limit).select(
        F.col("completed_time_day").alias("completed_date"), F.col("completed_time_day_of_week_name").alias("day"),
        "gtd_work_type", F.col("project_name_formatted").alias("project"), "project_url_web", "project_url_native",
        F.col("title").alias("task"), "task_url_web", "task_url_native",
    )


def filter_option_lists(catalog: DataFrame, projects: DataFrame, what: str = "folder_name",
                        folders: Sequence[str] | str | None = None) -> DataFrame:
    """Names offered by a filter: those of open projects; project names follow the chosen folders.

    The calendar has every catalog project on every day, so the catalog gives the same names.
    """
    open_ids = projects.filter(~F.coalesce("closed", F.lit(False))).select("project_id").distinct()
    rows = catalog.join(open_ids, "project_id", "left_semi")
    if what == "project_name":
        rows = rows.filter(panel_filter(folders=folders, grain="folder"))
    return rows.select(what).distinct().orderBy(what)


# Charts over the joined model.

# A choice of grain refers to the names of all grains, whichever is chosen.
GRAIN_NAMES = ("project_name", "folder_name")


def not_done() -> Column:
    """Status other than done; tasks without a status are kept."""
    return field_filter("status", "notEquals", [DONE])


def dashboard_filter(spine_weeks: int | None = WEEKS, as_of: dt.date | str | None = None, hide_done: bool = True) -> Column:
    """Choices shared by all tiles of a dashboard; a tile switches off what does not apply to it."""
    conditions = []
    if spine_weeks is not None:
        conditions.append(filter_relative_date("date_day", "inTheNext", spine_weeks, "weeks", as_of))
    if hide_done:
        conditions.append(not_done())
    return all_of(*conditions)


def lookahead_by_spine(model: Model, params: Params = Params(), match: str = "exact",
                       fact_where: Column | None = None) -> DataFrame:
    """Distinct count by grain for every spine day."""
    rows = explore_query(
        model, by=["date_day"], metrics={"count": metric("count", params.grain)},
        refers=GRAIN_NAMES, params=params, match=match, fact_where=fact_where,
    )
    return rows.select("date_day", F.date_format("date_day", "EEEE").alias("day_of_week_name"),
                       monday_week(F.col("date_day")).alias("date_week"), "count")


def lookahead_pivot(rows: DataFrame, weeks: Sequence[dt.date]) -> DataFrame:
    """Lookahead with one column per week."""
    return pivot_series(rows, ["date_day", "day_of_week_name"], "date_week", weeks, F.sum("count"))


def spine_distribution(model: Model, params: Params = Params(), match: str = "exact", where: Column | None = None,
                       limit: int = 500) -> DataFrame:
    """Task rows per spine day and parent."""
    return explore_query(
        model, by={"date_day": F.col("date_day"), "parent": param_grain(params.grain)["parent_dimension_grain"]},
        metrics={"total_tasks": metric("total_tasks")}, refers=GRAIN_NAMES, params=params,
        match=match, where=where, order=[F.desc("date_day"), F.asc_nulls_first("parent")], limit=limit,
    )


def dynamic_grain_count(model: Model, as_of: dt.date | str, params: Params = Params(), match: str = "exact",
                        limit: int = 500) -> DataFrame:
    """Task rows by grain, parent and due day in the next quarter and the next five spine weeks."""
    grain = param_grain(params.grain)
    due = F.col("due_date").cast("date")
    where = all_of(
        filter_relative_date("due_date", "inTheNext", 1, "quarters", as_of),
        filter_relative_date("date_day", "inTheNext", WEEKS, "weeks", as_of),
    )
    by = {"due_date_day": due} | {k: grain[k] for k in (
        "dimension_grain", "parent_dimension_grain", "dynamic_grain_url", "dynamic_parent_grain_url")}
    parts = due_day_parts()
    rows = explore_query(
        model, by=by, metrics={"total_tasks": metric("total_tasks")}, refers=GRAIN_NAMES,
        params=params, match=match, where=where,
        order=[F.asc("due_date_day"), F.asc("parent_dimension_grain"), F.asc("dimension_grain"),
               F.asc("dynamic_grain_url")],
        limit=limit,
    )
    dated = rows.select("*", *parts[1:])
    return dated.withColumn("concat_date", slash_label("due_date_month_num", "due_date_day_of_month_num"))


def _inbox_where(kind: str, skip_folders: Sequence[str], skip_projects: Sequence[str], tag: str | None) -> Column:
    conditions = [
        field_filter("status", "equals", [OPEN]), field_filter("closed", "equals", [False]),
        field_filter("kind", "equals", [kind]),
    ]
    if skip_folders:
        conditions.append(field_filter("folder_name", "notEquals", skip_folders))
    if skip_projects:
        conditions.append(field_filter("project_name", "notEquals", skip_projects))
    if tag:
        conditions.append(field_filter("tag", "equals", [tag]))
    return all_of(*conditions)


def inbox_count(model: Model, kind: str, skip_folders: Sequence[str] = (), skip_projects: Sequence[str] = (),
                tag: str | None = None, limit: int | None = 500) -> DataFrame:
    """Open tasks of one kind in open projects; with a tag, counted for that tag."""
    return explore_query(
        model, by=["tag"] if tag else [], metrics={"total_tasks": metric("total_tasks")},
        refers=GRAIN_NAMES,
        where=_inbox_where(kind, skip_folders, skip_projects, tag), order=[F.desc("total_tasks")], limit=limit,
    )


def inbox_distribution(model: Model, kind: str, skip_folders: Sequence[str] = (), skip_projects: Sequence[str] = (),
                       tag: str | None = None, limit: int = 500) -> DataFrame:
    """The same tasks by folder and project."""
    return explore_query(
        model, by={"folder_name": F.col("folder_name"), "project_name": F.col("project_name"),
                   "project_id": F.col("project_id"), "project_name_formatted": stable_label("project_name")},
        metrics={"total_tasks": metric("total_tasks")},
        where=_inbox_where(kind, skip_folders, skip_projects, tag),
        order=[F.asc("folder_name"), F.desc("total_tasks"), F.asc("project_id")], limit=limit,
    )


def empty_projects(projects: DataFrame, folders: DataFrame, tasks: DataFrame, skip_folders: Sequence[str] = (),
                   limit: int = 500) -> DataFrame:
    """Open projects without any task. Tasks are counted per project before the join."""
    named = lookup_join(
        projects.filter(F.col("closed") == F.lit(False)).withColumn("folder_id", F.col("group_id")),
        folders, "folder_id", spread="project_id", how="inner",
    )
    if skip_folders:
        named = named.filter(field_filter("folder_name", "notEquals", skip_folders))
    counts = tasks.groupBy("project_id").agg(F.count("task_id").alias("_tasks"))
    total = F.coalesce("_tasks", F.lit(0).cast("bigint")).alias("total_tasks")
    rows = named.join(counts, "project_id", "left").select("folder_name", "project_name", "project_id", total)
    empty = rows.filter("total_tasks = 0")
    return topn_sorted(empty, [F.asc("folder_name"), F.asc("project_id")], limit)


def project_pulse(model: Model, as_of: dt.date | str, kind: str, skip_folders: Sequence[str] = (),
                  tags: Sequence[str] = (), older_than: int = 5, limit: int = 500) -> DataFrame:
    """Projects with open tasks whose last pulse is more than some days ago, oldest first."""
    where = [field_filter("closed", "equals", [False]), field_filter("status", "equals", [OPEN]),
             field_filter("kind", "equals", [kind])]
    if skip_folders:
        where.append(field_filter("folder_name", "notEquals", skip_folders))
    if tags:
        where.append(field_filter("tag", "equals", tags))
    age = F.date_diff(F.lit(as_date(as_of)), F.col("last_pulse_day")).cast("bigint")
    return explore_query(
        model, by={"folder_name": F.col("folder_name"), "project_name": F.col("project_name"),
                   "last_pulse_day": F.col("last_pulse").cast("date"), "project_id": F.col("project_id")},
        metrics={"total_tasks": metric("total_tasks")},
        project_columns=(*PROJECT_COLUMNS, "last_pulse"),
        where=all_of(*where), calc={"date_human_readable": age}, having=F.col("date_human_readable") > older_than,
        order=[F.desc("date_human_readable"), F.asc("folder_name"), F.asc("total_tasks"), F.asc("project_id")],
        limit=limit,
    )


def data_freshness(tasks: DataFrame) -> DataFrame:
    """Time of the last load, from the sentinel row."""
    minute = F.date_trunc("minute", F.col("updated_time")).cast("timestamp_ntz")
    rows = tasks.filter(F.col("task_id") == SENTINEL_TASK).select(minute.alias("updated_time_minute"))
    return rows.groupBy("updated_time_minute").agg(F.max("updated_time_minute").alias("updated_time_minute_max"))


def next_load_time(tasks: DataFrame) -> DataFrame:
    return tasks.filter(F.col("task_id") == SENTINEL_TASK).select("title").distinct()


# Habit tiles.

# Status glyphs of habits.
NEW_GLYPH, DONE_GLYPH = "⚪", "✅"


def habit_project_join(habits: DataFrame, projects: DataFrame) -> DataFrame:
    names = projects.select(F.col("id").alias("project_id"), F.col("name").alias("project_name"))
    return lookup_join(habits, names, "project_id", spread="surr_id")


def habits_today(habits: DataFrame, projects: DataFrame, as_of: dt.date | str, only: str | None = None,
                 limit: int = 500) -> DataFrame:
    """Habits due within the last month or today, or completed today. `only` keeps 'new' or 'completed' ones."""
    where = any_of(
        filter_relative_date("due_date", "inThePast", 1, "months", as_of),
        filter_relative_date("due_date", "inTheCurrent", 1, "days", as_of),
        filter_relative_date("completed_at", "inTheCurrent", 1, "days", as_of),
    )
    rows = habit_project_join(habits.filter(where), projects)
    by = ["project_name", "is_completed", F.col("scheduled_date").cast("date").alias("scheduled_date_day"),
          "cleaned_content", "streak", "task_id"]
    counted = rows.groupBy(*by).agg(metric("habit_total").alias("total_tasks"))
    glyph = F.when(F.col("is_completed") == "new", F.lit(NEW_GLYPH)).otherwise(F.lit(DONE_GLYPH))
    out = counted.withColumns({"status": glyph, "streak_count": streak_count("streak")})
    if only:
        out = out.filter(F.col("status") == (NEW_GLYPH if only == "new" else DONE_GLYPH))
    last = F.desc("scheduled_date_day") if only else F.desc_nulls_last("streak_count")
    order = [F.asc("status"), F.asc_nulls_first("project_name"), last, F.asc("task_id"),
             F.asc("scheduled_date_day"), F.asc("cleaned_content")]
    return topn_sorted(out, order, limit)


def habits_completed_7d(habits: DataFrame, projects: DataFrame, as_of: dt.date | str, days: int = 7,
                        limit: int = 500) -> DataFrame:
    """Completions of the last days, newest first."""
    recent = habits.filter(filter_relative_date("completed_at", "inThePast", days, "days", as_of))
    rows = habit_project_join(recent, projects)
    day = F.col("completed_at")
    out = rows.select(
        F.date_format(day, "EEEE").alias("completed_day_of_week_name"), "project_name", "cleaned_content", "task_id",
        day.cast("date").alias("completed_day"), "completed_at", "streak",
        slash_label(F.dayofmonth(day), F.month(day)).alias("concat_date"), "surr_id",
    )
    return topn_sorted(out, [F.desc("completed_at"), F.asc("surr_id")], limit).drop("surr_id")


def habits_done_by_project(habits: DataFrame, projects: DataFrame, as_of: dt.date | str, days: int = 7) -> DataFrame:
    """Completions per day and project."""
    recent = habits.filter(
        filter_relative_date("scheduled_date", "inThePast", days, "days", as_of)
        & field_filter("is_completed", "equals", ["completed"])
    )
    rows = habit_project_join(recent, projects)
    return rows.groupBy("project_name", "is_completed", F.col("scheduled_date").cast("date").alias("scheduled_date_day")) \
        .agg(metric("habit_total").alias("total_tasks"))
