"""Joins, aggregations, windows, sorting and set operations."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tasklens.operators import keyed, metrics, series, shapes
from tasklens.plans import base, explore, marts, panels
from workload.ctes import AS_OF as DAY
from workload.registry import query
from workload.tables import AS_OF, AS_OF_TS, CFG, HABIT_DAY, Tables


def model(t: Tables) -> explore.Model:
    return explore.Model(t.tasks, t.dim_projects, t.dim_folders, tags=t.tags, spine=t.spine)


# Joins.

@query("join_task_project_folder", """
    SELECT task_id, project_id, project_name, fid AS folder_id, fname AS folder_name FROM joined""")
def join_task_project_folder(t: Tables):
    tasks = t.tasks.select("task_id", "project_id")
    return marts.join_task_project_folder(tasks, t.projects, t.folders)


@query("join_project_folder_nullsafe_key", """
    SELECT project_id, project_name, folder_id, folder_name, scope_bucket FROM catalog""")
def join_project_folder_nullsafe_key(t: Tables):
    return marts.project_catalog(t.projects, t.folders, CFG)


@query("join_tag_bridge", "SELECT task_id, tag_id FROM bridge")
def join_tag_bridge(t: Tables):
    return t.bridge


@query("join_pulse", "SELECT project_id, project_name, group_id, last_pulse FROM dim_projects")
def join_pulse(t: Tables):
    return t.dim_projects.select("project_id", "project_name", "group_id", "last_pulse")


@query("join_completed_description", """
    SELECT c.id, c.task_id, description FROM habit_completed c LEFT JOIN habit_active a ON c.task_id = a.id""")
def join_completed_description(t: Tables):
    done = base.base_habit_completed(t.raw_habit_completed, "UTC").withColumn("id", F.col("id").cast("string"))
    return marts.join_completed_description(done, t.raw_habit_active).select("id", "task_id", "description")


@query("anti_join_missing", """
    SELECT c_custkey FROM customer WHERE NOT EXISTS (
        SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderdate >= TIMESTAMP '1998-06-15')""")
def anti_join_missing(t: Tables):
    """Customers without coming orders."""
    keys = t.read("orders").filter(F.col("o_orderdate") >= F.lit(AS_OF)).select(F.col("o_custkey").alias("c_custkey"))
    return keyed.existing_keys(t.read("customer").select("c_custkey"), keys, "c_custkey", "c_custkey", found=False)


@query("semi_join_tag", "SELECT task_id FROM tasks WHERE list_contains(tags, 'R')")
def semi_join_tag(t: Tables):
    return series.semi_join_tag(t.tasks, "R").select("task_id")


@query("calendar_cross", "SELECT date_day AS due_date_day, project_id FROM spine CROSS JOIN projects")
def calendar_cross(t: Tables):
    return series.calendar_cross(t.projects, AS_OF).select("due_date_day", "project_id")


@query("calendar_fill", "SELECT due_date_day, project_id, open_task_count FROM workload")
def calendar_fill(t: Tables):
    calendar = series.calendar_cross(t.projects.select("project_id"), AS_OF)
    filled = series.calendar_fill(calendar, metrics.open_task_counts(t.tasks), ["due_date_day", "project_id"],
                                  "open_task_count")
    return filled.select("due_date_day", "project_id", "open_task_count")


@query("explore_join", """
    SELECT date_day, e.task_id, e.project_name, e.folder_name, tag FROM explored_tags e
    RIGHT JOIN spine s ON e.due_date = CAST(s.date_day AS TIMESTAMP)""")
def explore_join(t: Tables):
    rows = explore.explore_join(model(t), ["projects", "folders", "tags", "spine"])
    return rows.select("date_day", "task_id", "project_name", "folder_name", "tag")


@query("habit_project_join", "SELECT surr_id, project_name FROM habit_named")
def habit_project_join(t: Tables):
    return panels.habit_project_join(t.habits, t.habit_projects).select("surr_id", "project_name")


@query("range_schedule_join", "SELECT task_id, expected_date FROM habit_expected")
def range_schedule_join(t: Tables):
    return series.habit_expected_days(series.habit_schedule(series.habit_tasks(t.habit_tasks)), HABIT_DAY)


@query("scalar_cross", f"""
    SELECT task_id, date_diff('day', {DAY}, CAST(due_date AS DATE)) AS days_ahead, TRUE AS in_bounds FROM tasks
    WHERE CAST(due_date AS DATE) >= {DAY} AND CAST(due_date AS DATE) < DATE '1998-07-20'""")
def scalar_cross(t: Tables):
    """Bounds of the lookahead are literals in the plan, so no one-row table is joined."""
    day, start = F.col("due_date").cast("date"), F.lit(AS_OF)
    inside = (day >= start) & (day < F.lit(panels.lookahead_end(AS_OF)))
    return t.tasks.filter(inside).select(
        "task_id", F.date_diff(day, start).cast("bigint").alias("days_ahead"), inside.alias("in_bounds"))


@query("orphan_keys", """
    SELECT 'gone' || project_id AS project_id, count(*) AS row_count, min(due_date_day) AS earliest_due_date_day,
        max(due_date_day) AS latest_due_date_day FROM semantic WHERE title = '1-URGENT' GROUP BY 1""")
def orphan_keys(t: Tables):
    """Urgent tasks name projects that aren't there."""
    gone = F.when(F.col("title") == "1-URGENT", F.concat(F.lit("gone"), "project_id")).otherwise(F.col("project_id"))
    return metrics.orphan_keys(t.semantic.withColumn("project_id", gone), t.projects, "project_id", "due_date_day")


# Aggregations and metrics.

@query("open_task_counts", "SELECT * FROM open_counts")
def open_task_counts(t: Tables):
    return metrics.open_task_counts(t.tasks)


@query("grain_rollup_task", "SELECT * FROM rollup WHERE grain_level = 'task'")
def grain_rollup_task(t: Tables):
    return metrics.grain_rollup(t.semantic, ["task"])


@query("grain_rollup_project", "SELECT * FROM rollup WHERE grain_level = 'project'")
def grain_rollup_project(t: Tables):
    return metrics.grain_rollup(t.semantic, ["project"])


@query("grain_rollup_folder", "SELECT * FROM rollup WHERE grain_level = 'folder'")
def grain_rollup_folder(t: Tables):
    return metrics.grain_rollup(t.semantic, ["folder"])


@query("project_last_pulse", """
    SELECT project_id, coalesce(max(due_date), max(completed_time)) AS last_pulse FROM tasks GROUP BY 1""")
def project_last_pulse(t: Tables):
    return metrics.project_last_pulse(t.tasks)


def _by_folder(t: Tables, **named):
    return explore.explore_query(model(t), by=["folder_name"], metrics=named, joins=["projects", "folders"])


@query("metric_total_tasks", "SELECT tag, count(task_id) AS total_tasks FROM explored_tags GROUP BY 1")
def metric_total_tasks(t: Tables):
    return explore.explore_query(model(t), by=["tag"], metrics={"total_tasks": metrics.metric("total_tasks")},
                                 joins=["projects", "folders", "tags"])


@query("metric_completed_tasks", """
    SELECT folder_name, count(DISTINCT CASE WHEN status = 2 THEN task_id END) AS completed_tasks FROM explored GROUP BY 1""")
def metric_completed_tasks(t: Tables):
    return _by_folder(t, completed_tasks=metrics.metric("completed_tasks"))


@query("metric_count_by_grain", """
    SELECT folder_name, count(DISTINCT task_id) AS tasks, count(DISTINCT project_id) AS projects,
        count(DISTINCT folder_id) AS folders FROM explored GROUP BY 1""")
def metric_count_by_grain(t: Tables):
    return _by_folder(t, tasks=metrics.metric("count", "task"), projects=metrics.metric("count", "project"),
                      folders=metrics.metric("count", "folder"))


@query("metric_overdue", """
    SELECT folder_name, count(DISTINCT CASE WHEN due_date < TIMESTAMP '1998-06-15 09:30:00' AND status <> 2 THEN task_id END)
        AS overdue_tasks FROM explored GROUP BY 1""")
def metric_overdue(t: Tables):
    return _by_folder(t, overdue_tasks=metrics.metric("overdue_tasks", as_of=AS_OF_TS))


@query("metric_completion_rate", """
    SELECT folder_name, count(DISTINCT CASE WHEN status = 2 THEN task_id END) / count(task_id) AS completion_rate
    FROM explored GROUP BY 1""")
def metric_completion_rate(t: Tables):
    return _by_folder(t, completion_rate=metrics.metric("completion_rate"))


@query("metric_dim_counts", """
    SELECT count(DISTINCT project_id) AS projects, count(DISTINCT tag_id) AS tags, count(DISTINCT folder_id) AS folders
    FROM explored_tags""")
def metric_dim_counts(t: Tables):
    named = {"projects": "project_count", "tags": "tag_count", "folders": "folder_count"}
    return explore.explore_query(model(t), metrics={k: metrics.metric(v) for k, v in named.items()},
                                 joins=["projects", "folders", "tags"])


@query("metric_habit_total", "SELECT is_completed, count(surr_id) AS total_tasks FROM habit GROUP BY 1")
def metric_habit_total(t: Tables):
    return t.habits.groupBy("is_completed").agg(metrics.metric("habit_total").alias("total_tasks"))


_DAILY_SQL = f"""SELECT due_date_day, sum(open_task_count)::BIGINT AS daily_tasks FROM workload
    WHERE due_date_day >= {DAY} AND due_date_day < DATE '1998-07-20' GROUP BY 1"""
_RANKED_SQL = f"""SELECT *, dense_rank() OVER (ORDER BY date_trunc('week', due_date_day)) AS week_num
    FROM ({_DAILY_SQL})"""


def _daily(t: Tables):
    coming = F.col("due_date_day").between(F.lit(AS_OF), F.lit(panels.lookahead_end(AS_OF) - dt.timedelta(days=1)))
    return t.workload.filter(coming).groupBy("due_date_day").agg(F.sum("open_task_count").alias("daily_tasks"))


@query("ceil_avg", f"SELECT week_num, CAST(ceil(avg(daily_tasks)) AS BIGINT) AS week_avg FROM ({_RANKED_SQL}) GROUP BY 1")
def ceil_avg(t: Tables):
    return panels.week_averages(_daily(t))


@query("having_filter", """
    SELECT project_id, count(task_id) AS total_tasks FROM tasks GROUP BY 1 HAVING count(task_id) > 12""")
def having_filter(t: Tables):
    return metrics.having_filter(t.tasks, ["project_id"], {"total_tasks": metrics.metric("total_tasks")},
                                 F.col("total_tasks") > 12)


@query("freshness_max", "SELECT max(date_trunc('minute', updated_time)) AS updated_time_minute_max FROM tasks")
def freshness_max(t: Tables):
    return metrics.freshness_max(t.tasks)


@query("sum_by_parent", """
    SELECT due_date_day, parent_grain_label, sum(task_count)::BIGINT AS open_tasks FROM rollup
    WHERE grain_level = 'project' GROUP BY 1, 2""")
def sum_by_parent(t: Tables):
    return metrics.sum_by_parent(metrics.grain_rollup(t.semantic, ["project"]))


@query("distinct_rows", "SELECT DISTINCT tag FROM task_tags")
def distinct_rows(t: Tables):
    return shapes.unnest_tags_with_default(t.tasks).select("tag").distinct()


_WEEKS = [dt.date(1998, 6, 15) + dt.timedelta(weeks=n) for n in range(5)]


@query("pivot_series", "SELECT due_date_day, " + ", ".join(
    f"max(CASE WHEN date_trunc('week', due_date_day) = DATE '{w}' THEN daily_tasks END) AS \"{w}\"" for w in _WEEKS
) + f" FROM ({_DAILY_SQL}) GROUP BY 1")
def pivot_series(t: Tables):
    daily = _daily(t).withColumn("week", F.trunc("due_date_day", "week").cast("string"))
    return shapes.pivot_series(daily, ["due_date_day"], "week", [str(w) for w in _WEEKS], F.max("daily_tasks"))


# Windows and series.

@query("date_spine", """
    SELECT CAST(unnest(range(m, m + INTERVAL 3 MONTH, INTERVAL 1 DAY)) AS DATE) AS date_day
    FROM (SELECT date_trunc('day', max(o_orderdate))::TIMESTAMP AS m FROM orders)""")
def date_spine(t: Tables):
    return series.date_spine_after(t.read("orders"), "o_orderdate")


@query("week_dense_rank", _RANKED_SQL)
def week_dense_rank(t: Tables):
    return series.week_dense_rank(_daily(t))


@query("row_number_latest", """
    SELECT task_id, expected_date, completed_time FROM habit_done""")
def row_number_latest(t: Tables):
    return series.first_completions(t.habit_tasks).drop("title")


@query("min_over_key", "SELECT CAST(user_id AS VARCHAR) AS task_id, start_day AS habit_start_date FROM habit_rules")
def min_over_key(t: Tables):
    return series.habit_start(series.habit_tasks(t.habit_tasks))


@query("habit_rrule_parse", """
    SELECT CAST(user_id AS VARCHAR) AS task_id, CASE WHEN step = 7 THEN 'WEEKLY' ELSE 'DAILY' END AS frequency,
        CAST(CASE WHEN step = 2 THEN 2 ELSE 1 END AS INTEGER) AS "interval",
        CASE WHEN step = 7 THEN 'MO,WE,SU' END AS by_day FROM habit_rules""")
def habit_rrule_parse(t: Tables):
    rules = series.habit_schedule(series.habit_tasks(t.habit_tasks)).select("task_id", *series.rrule_columns())
    return rules.withColumn("by_day", F.array_join("by_day", ","))


@query("habit_expected_days", "SELECT task_id, expected_date FROM habit_expected")
def habit_expected_days(t: Tables):
    return series.habit_expected_days(series.habit_schedule(t.habit_tasks), HABIT_DAY)


@query("habit_log", "SELECT task_id, expected_date, status, completed_time FROM habit_days")
def habit_log(t: Tables):
    expected = series.habit_expected_days(series.habit_schedule(t.habit_tasks), HABIT_DAY)
    return series.habit_log(expected, series.first_completions(t.habit_tasks)).drop("title")


@query("habit_streaks", """
    SELECT task_id, expected_date, status, completed_time,
        CASE WHEN status = 2 THEN sum(CASE WHEN status = 2 THEN 1 ELSE 0 END)
            OVER (PARTITION BY task_id, island ORDER BY expected_date)::BIGINT END AS habit_streak FROM habit_islands""")
def habit_streaks(t: Tables):
    return series.habit_streaks(t.habit_tasks, HABIT_DAY).drop("title")


# Sorting, limits, set operations.

@query("topn_sorted", """
    SELECT task_id, due_date, priority FROM tasks ORDER BY due_date DESC, priority, task_id LIMIT 100""")
def topn_sorted(t: Tables):
    order = [F.desc("due_date"), F.asc("priority"), F.asc("task_id")]
    return shapes.topn_sorted(t.tasks.select("task_id", "due_date", "priority"), order, 100)


@query("union_all_by_name", """
    SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name FROM customer
    UNION ALL SELECT CAST(s_suppkey AS VARCHAR), s_name FROM supplier""")
def union_all_by_name(t: Tables):
    c = t.read("customer").select(F.col("c_custkey").cast("string").alias("id"), F.col("c_name").alias("name"))
    s = t.read("supplier").select(F.col("s_name").alias("name"), F.col("s_suppkey").cast("string").alias("id"))
    return shapes.union_all_by_name(c, s)


@query("union_relations", """
    SELECT src AS _dbt_source_relation, id, task_id, content, priority, completed_at, due_date FROM habit""")
def union_relations(t: Tables):
    return t.habits.select("_dbt_source_relation", "id", "task_id", "content", "priority", "completed_at", "due_date")


@query("array_intersect", """
    SELECT task_id, CAST(len(list_intersect(tags, ['A', 'X'])) AS BIGINT) AS n FROM tasks""")
def array_intersect(t: Tables):
    return t.tasks.select("task_id", shapes.array_overlap_count("tags", ["A", "X"]).alias("n"))


@query("unnest_tags_with_default", "SELECT task_id, tag FROM task_tags")
def unnest_tags_with_default(t: Tables):
    return shapes.unnest_tags_with_default(t.tasks)
