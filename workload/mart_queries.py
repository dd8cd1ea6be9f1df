"""Marts, explores, dashboard panels and checks."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tasklens.operators import quality
from tasklens.operators.metrics import metric
from tasklens.plans import explore, marts, panels
from workload.ctes import AS_OF as DAY
from workload.ctes import HABIT_DAY as HDAY
from workload.ctes import label
from workload.operator_queries import model
from workload.registry import query
from workload.tables import AS_OF, CFG, HABIT_DAY, Tables

_V1_ARRAYS = "array_to_string(tags, ',') AS tags, array_to_string(reminders, ',') AS reminders"


@query("fct_tasks", f"""
    SELECT task_id, project_id, title, due_date, {_V1_ARRAYS}, kind, completed_time, updated_time, status, gtd_work_type
    FROM v1_tasks""")
def fct_tasks(t: Tables):
    return t.tasks_v1.select(
        "task_id", "project_id", "title", "due_date", F.concat_ws(",", "tags").alias("tags"),
        F.concat_ws(",", "reminders").alias("reminders"), "kind", "completed_time", "updated_time", "status",
        "gtd_work_type")


@query("dim_projects", "SELECT project_id, project_name, group_id, completed_time, closed, last_pulse FROM v1_projects")
def dim_projects(t: Tables):
    return t.projects_v1.select("project_id", "project_name", "group_id", "completed_time", "closed", "last_pulse")


@query("dim_folders", """
    SELECT DISTINCT group_id AS folder_id, regexp_extract(project_name, 'folder_map - ''(.*)''', 1) AS folder_name
    FROM v1_projects WHERE project_name LIKE 'folder_map - %'
    UNION ALL SELECT 'default', 'default' UNION ALL SELECT '0', 'default'""")
def dim_folders(t: Tables):
    return marts.dim_folders(t.projects_v1)


@query("dim_tags", "SELECT tag_id, tag FROM tags")
def dim_tags(t: Tables):
    return t.tags


@query("fct_task_tags_bridge", "SELECT task_id, tag_id FROM bridge")
def fct_task_tags_bridge(t: Tables):
    return t.bridge


@query("dim_date_spine", """
    SELECT date_day, count(task_id) AS due_tasks FROM spine LEFT JOIN tasks ON CAST(due_date AS DATE) = date_day GROUP BY 1""")
def dim_date_spine(t: Tables):
    """The days of the spine, each with the tasks due on it."""
    due = explore.on_spine(t.tasks, t.spine, "day").groupBy("date_day").agg(F.count("task_id").alias("due_tasks"))
    return t.spine.join(due, "date_day", "left").na.fill(0, ["due_tasks"])


@query("fct_tasks_v3", "SELECT * EXCLUDE (tags), array_to_string(tags, ',') AS tags FROM v3_tasks")
def fct_tasks_v3(t: Tables):
    return marts.fct_tasks_v3(t.raw_tasks_v3, CFG).select(
        "task_id", "account_id", "project_id", "sort_order", "title", "timezone", "is_allday", "priority", "due_date",
        "completed_time", "updated_time", "status", F.concat_ws(",", "tags").alias("tags"), "gtd_work_type")


@query("dim_projects_v3", "SELECT * FROM v3_projects")
def dim_projects_v3(t: Tables):
    tasks = marts.fct_tasks_v3(t.raw_tasks_v3, CFG)
    return marts.dim_projects_v3(t.raw_projects_v3, tasks, CFG, legacy=t.raw_projects).select(
        "project_id", "account_id", "project_name", "sort_order", "group_id", "completed_time", "closed", "last_pulse")


@query("dim_folders_v3", "SELECT folder_id, folder_name FROM v3_folders")
def dim_folders_v3(t: Tables):
    return marts.dim_folders_v3(t.raw_groups_v3, CFG)


@query("semantic_base", "SELECT * FROM semantic")
def semantic_base(t: Tables):
    return t.semantic


@query("due_workload_daily", "SELECT * FROM workload")
def due_workload_daily(t: Tables):
    return t.workload


@query("grain_rollup", "SELECT * FROM rollup")
def grain_rollup(t: Tables):
    return t.rollup


@query("completed_activity", "SELECT * FROM activity")
def completed_activity(t: Tables):
    return marts.completed_activity(t.semantic)


@query("fct_habit", "SELECT * FROM habit")
def fct_habit(t: Tables):
    return t.habits.select(
        "surr_id", F.col("_dbt_source_relation").alias("src"), "id", "task_id", "project_id", "content", "description",
        "priority", "completed_at", "due_date", "cleaned_content", "streak", "scheduled_date", "is_completed")


@query("dim_project_habit", "SELECT CAST(n_nationkey AS VARCHAR) AS id, n_name AS name FROM nation")
def dim_project_habit(t: Tables):
    return t.habit_projects.select("id", "name")


# Explores.

@query("explore_query", """
    SELECT folder_name, kind, count(task_id) AS total_tasks,
        count(DISTINCT CASE WHEN status = 2 THEN task_id END) AS completed_tasks
    FROM explored WHERE priority > 1 AND NOT closed GROUP BY 1, 2 HAVING count(task_id) > 10
    ORDER BY total_tasks DESC, folder_name, kind LIMIT 20""")
def explore_query(t: Tables):
    return explore.explore_query(
        model(t), by=["folder_name", "kind"],
        metrics={"total_tasks": metric("total_tasks"), "completed_tasks": metric("completed_tasks")},
        where=explore.all_of(F.col("priority") > 1, ~F.col("closed")),
        having=F.col("total_tasks") > 10, order=[F.desc("total_tasks"), F.asc("folder_name"), F.asc("kind")], limit=20)


@query("param_multi_select", """
    SELECT folder_name, tag, count(task_id) AS total_tasks FROM explored_tags
    WHERE folder_name IN ('NATION_3', 'NATION_7') AND tag IN ('A', 'default') GROUP BY 1, 2""")
def param_multi_select(t: Tables):
    params = explore.Params(folders=["NATION_3", "NATION_7"], tags=["A", "default"], projects=[explore.ALL])
    return explore.explore_query(model(t), by=["folder_name", "tag"], metrics={"total_tasks": metric("total_tasks")},
                                 joins=["projects", "folders", "tags"], params=params)


@query("param_grain", f"""
    SELECT project_name AS dimension_grain, folder_name AS parent_dimension_grain,
        {label('project_name')} AS formatted_dimension_grain, {label('folder_name')} AS formatted_parent_dimension_grain,
        'ticktick.com/webapp/#p/' || project_id || '/tasks' AS dynamic_grain_url,
        'ticktick.com/webapp/#g/' || folder_id AS dynamic_parent_grain_url, count(DISTINCT project_id) AS "count"
    FROM explored GROUP BY ALL""")
def param_grain(t: Tables):
    return explore.explore_query(
        model(t), by=explore.param_grain("project"), metrics={"count": metric("count", "project")},
        joins=["projects", "folders"], params=explore.Params(grain="project"))


@query("filter_relative_date", f"""
    SELECT task_id, d BETWEEN {DAY} AND {DAY} + INTERVAL 3 MONTH AS next_quarter,
        d BETWEEN {DAY} AND {DAY} + INTERVAL 35 DAY AS next_5_weeks, d BETWEEN {DAY} - INTERVAL 2 DAY AND {DAY} AS past_2_days,
        d BETWEEN {DAY} - INTERVAL 1 MONTH AND {DAY} AS past_month, d = {DAY} AS today
    FROM (SELECT task_id, CAST(due_date AS DATE) AS d FROM tasks)""")
def filter_relative_date(t: Tables):
    rules = {"next_quarter": ("inTheNext", 1, "quarters"), "next_5_weeks": ("inTheNext", 5, "weeks"),
             "past_2_days": ("inThePast", 2, "days"), "past_month": ("inThePast", 1, "months"),
             "today": ("inTheCurrent", 1, "days")}
    return t.tasks.select(
        "task_id", *[explore.filter_relative_date("due_date", *r, AS_OF).alias(n) for n, r in rules.items()])


@query("filter_ops", """
    SELECT task_id FROM tasks WHERE (priority > 2 AND title NOT IN ('5-LOW', '3-MEDIUM') AND completed_time IS NOT NULL)
        OR (completed_time IS NULL AND kind = 'NOTE') OR (updated_time <> TIMESTAMP '1998-01-01 01:00:00' AND priority = 1)""")
def filter_ops(t: Tables):
    f = explore.field_filter
    where = explore.any_of(
        explore.all_of(f("priority", "greaterThan", [2]), f("title", "notEquals", ["5-LOW", "3-MEDIUM"]),
                       f("completed_time", "notNull")),
        explore.all_of(f("completed_time", "isNull"), f("kind", "equals", ["NOTE"])),
        explore.all_of(f("updated_time", "notEquals", ["1998-01-01 01:00:00"], keep_nulls=False),
                       f("priority", "equals", [1])),
    )
    return t.tasks.filter(where).select("task_id")


@query("table_calculation", """
    SELECT folder_name, total_tasks, completed_tasks, total_tasks - completed_tasks AS remaining FROM (
        SELECT folder_name, count(task_id) AS total_tasks, count(DISTINCT CASE WHEN status = 2 THEN task_id END)
            AS completed_tasks FROM explored GROUP BY 1) WHERE total_tasks - completed_tasks > 300""")
def table_calculation(t: Tables):
    return explore.explore_query(
        model(t), by=["folder_name"],
        metrics={"total_tasks": metric("total_tasks"), "completed_tasks": metric("completed_tasks")},
        calc={"remaining": F.col("total_tasks") - F.col("completed_tasks")},
        having=F.col("remaining") > 300)


@query("dashboard_filter", f"""
    SELECT date_day, folder_name, count(task_id) AS total_tasks FROM explored_spine
    WHERE date_day BETWEEN {DAY} AND {DAY} + INTERVAL 35 DAY AND (status <> 2 OR status IS NULL) GROUP BY 1, 2""")
def dashboard_filter(t: Tables):
    return explore.explore_query(
        model(t), by=["date_day", "folder_name"], metrics={"total_tasks": metric("total_tasks")},
        refers=panels.GRAIN_NAMES, where=panels.dashboard_filter(as_of=AS_OF))


# Panels.

def _lookahead_sql(where: str = "TRUE") -> str:
    daily = f"""SELECT due_date_day, sum(open_task_count)::BIGINT AS daily_tasks FROM workload
        WHERE due_date_day >= {DAY} AND due_date_day < DATE '1998-07-20' AND {where} GROUP BY 1"""
    weeks = ", ".join(f"CASE WHEN week_num = {n} THEN daily_tasks END AS \"W{n}\"" for n in range(1, 6))
    return f"""SELECT CAST(due_date_day AS TIMESTAMP) AS "time", {weeks},
        CAST(ceil(avg(daily_tasks) OVER (PARTITION BY week_num)) AS BIGINT) AS "Week Avg",
        CAST(ceil(avg(daily_tasks) OVER ()) AS BIGINT) AS "Global Avg",
        CAST(isodow(due_date_day) AS BIGINT) AS weekday_code
        FROM (SELECT *, dense_rank() OVER (ORDER BY date_trunc('week', due_date_day)) AS week_num FROM ({daily}))
        WHERE week_num <= 5"""


@query("lookahead_5w", _lookahead_sql())
def lookahead_5w(t: Tables):
    return panels.lookahead_of_tasks(t.tasks, t.catalog, AS_OF)


@query("lookahead_5w_of_mart", _lookahead_sql())
def lookahead_5w_of_mart(t: Tables):
    return panels.lookahead_5w(t.workload, AS_OF)


@query("lookahead_5w_filtered", _lookahead_sql("scope_bucket = 'rest' AND folder_name IN ('NATION_3', 'NATION_4')"))
def lookahead_5w_filtered(t: Tables):
    return panels.lookahead_of_tasks(t.tasks, t.catalog, AS_OF, scope="rest", folders=["NATION_3", "NATION_4"])


def _drill_sql(grain: str, grain_label: str) -> str:
    return f"""SELECT due_date_day, due_date_day_of_week_name AS day, strftime(due_date_day, '%m/%d') AS date_mmdd,
        {label('parent_grain_label')} AS parent, {grain_label} AS grain, task_count, parent_grain_url_web,
        parent_grain_url_native, grain_url_web, grain_url_native FROM rollup
        WHERE grain_level = '{grain}' AND due_date_day BETWEEN {DAY} AND {DAY} + INTERVAL 35 DAY
        ORDER BY due_date_day, parent_grain_label, task_count DESC, grain_rollup_id LIMIT 1000"""


@query("drill_down_by_grain", _drill_sql("task", "grain_label"))
def drill_down_by_grain(t: Tables):
    return panels.drill_down_by_grain(t.rollup, AS_OF, "task")


@query("drill_down_by_project", _drill_sql("project", label("grain_label")))
def drill_down_by_project(t: Tables):
    return panels.drill_down_by_grain(t.rollup, AS_OF, "project")


@query("distribution_by_parent", f"""
    SELECT due_date_day, {label('parent_grain_label')} AS parent_grain_label, sum(task_count)::BIGINT AS open_tasks
    FROM rollup WHERE grain_level = 'project' AND due_date_day BETWEEN {DAY} AND {DAY} + INTERVAL 35 DAY GROUP BY 1, 2""")
def distribution_by_parent(t: Tables):
    return panels.distribution_by_parent(t.rollup, AS_OF, "project")


@query("what_did_you_do", f"""
    SELECT completed_time_day AS completed_date, completed_time_day_of_week_name AS day, gtd_work_type,
        project_name_formatted AS project, project_url_web, project_url_native, title AS task, task_url_web, task_url_native
    FROM activity WHERE due_date IS NOT NULL AND completed_time_day BETWEEN {DAY} - INTERVAL 14 DAY AND {DAY}
    ORDER BY completed_time_day DESC, updated_time DESC, completed_activity_id, task_id LIMIT 500""")
def what_did_you_do(t: Tables):
    return panels.what_did_you_do(marts.completed_activity(t.semantic), AS_OF, days=14)


_LOOKAHEAD_SPINE = """SELECT s.date_day, strftime(s.date_day, '%A') AS day_of_week_name,
    CAST(date_trunc('week', s.date_day) AS DATE) AS date_week, count(DISTINCT task_id) AS "count"
    FROM explored_spine s GROUP BY 1"""


@query("lookahead_by_spine", _LOOKAHEAD_SPINE)
def lookahead_by_spine(t: Tables):
    return panels.lookahead_by_spine(model(t))


# Every Monday week of the three months from AS_OF.
_SPINE_WEEKS = [AS_OF + dt.timedelta(weeks=n) for n in range(14)]


@query("lookahead_pivot", "SELECT date_day, day_of_week_name, " + ", ".join(
    f"max(CASE WHEN date_week = DATE '{w}' THEN \"count\" END) AS \"{w}\"" for w in _SPINE_WEEKS
) + f" FROM ({_LOOKAHEAD_SPINE}) GROUP BY 1, 2")
def lookahead_pivot(t: Tables):
    rows = panels.lookahead_by_spine(model(t)).withColumn("date_week", F.col("date_week").cast("string"))
    return panels.lookahead_pivot(rows, [str(w) for w in _SPINE_WEEKS])


@query("explore_by_spine_month", """
    SELECT date_trunc('month', date_day)::DATE AS date_day, count(DISTINCT task_id) AS "count" FROM explored_spine GROUP BY 1""")
def explore_by_spine_month(t: Tables):
    """The dimension has the name of the spine's day, but is an expression of it."""
    return explore.explore_query(model(t), by={"date_day": F.trunc("date_day", "month")}, metrics={"count": metric("count")},
                                 refers=panels.GRAIN_NAMES)


@query("explore_spine_days", "SELECT DISTINCT date_day FROM explored_spine")
def explore_spine_days(t: Tables):
    """No metrics: the distinct days."""
    return explore.explore_query(model(t), by=["date_day"], refers=panels.GRAIN_NAMES)


@query("spine_distribution", """
    SELECT date_day, project_name AS parent, count(task_id) AS total_tasks FROM explored_spine GROUP BY 1, 2
    ORDER BY date_day DESC, parent NULLS FIRST LIMIT 500""")
def spine_distribution(t: Tables):
    return panels.spine_distribution(model(t))


@query("dynamic_grain_count", f"""
    SELECT due_date_day, dimension_grain, parent_dimension_grain, dynamic_grain_url, dynamic_parent_grain_url, total_tasks,
        strftime(due_date_day, '%A') AS due_date_day_of_week_name, CAST(month(due_date_day) AS BIGINT) AS due_date_month_num,
        CAST(day(due_date_day) AS BIGINT) AS due_date_day_of_month_num,
        CAST(month(due_date_day) AS VARCHAR) || '/' || CAST(day(due_date_day) AS VARCHAR) AS concat_date
    FROM (SELECT CAST(due_date AS DATE) AS due_date_day, title AS dimension_grain, project_name AS parent_dimension_grain,
            'ticktick.com/webapp/#p/' || project_id || '/tasks/' || task_id AS dynamic_grain_url,
            'ticktick.com/webapp/#p/' || project_id || '/tasks' AS dynamic_parent_grain_url, count(task_id) AS total_tasks
          FROM explored_spine WHERE due_date BETWEEN {DAY} AND {DAY} + INTERVAL 3 MONTH
              AND date_day BETWEEN {DAY} AND {DAY} + INTERVAL 35 DAY GROUP BY ALL)
    ORDER BY due_date_day, parent_dimension_grain, dimension_grain, dynamic_grain_url LIMIT 500""")
def dynamic_grain_count(t: Tables):
    return panels.dynamic_grain_count(model(t), AS_OF)


_INBOX = """status = 0 AND NOT closed AND kind = 'TASK' AND folder_name NOT IN ('NATION_1', 'NATION_2')
    AND project_name <> 'Customer#000000002'"""
_SKIP = {"skip_folders": ["NATION_1", "NATION_2"], "skip_projects": ["Customer#000000002"]}


@query("inbox_count", f"""
    SELECT tag, count(task_id) AS total_tasks FROM explored_tags WHERE {_INBOX} AND tag = 'default' GROUP BY 1""")
def inbox_count(t: Tables):
    return panels.inbox_count(model(t), "TASK", tag="default", **_SKIP)


@query("inbox_distribution", f"""
    SELECT folder_name, project_name, project_id, {label('project_name')} AS project_name_formatted,
        count(task_id) AS total_tasks FROM explored WHERE {_INBOX} GROUP BY 1, 2, 3
    ORDER BY folder_name, total_tasks DESC, project_id LIMIT 500""")
def inbox_distribution(t: Tables):
    return panels.inbox_distribution(model(t), "TASK", **_SKIP)


@query("empty_projects", """
    SELECT folder_name, project_name, project_id, CAST(0 AS BIGINT) AS total_tasks
    FROM (SELECT project_id, project_name, group_id, closed FROM dim_projects
          UNION ALL SELECT 's' || CAST(s_suppkey AS VARCHAR), s_name, CAST(s_nationkey AS VARCHAR), false FROM supplier) p
    JOIN dim_folders f ON p.group_id = f.folder_id
    WHERE NOT closed AND folder_name NOT IN ('default', 'NATION_1')
        AND NOT EXISTS (SELECT 1 FROM tasks t WHERE t.project_id = p.project_id)
    ORDER BY folder_name, project_id LIMIT 500""")
def empty_projects(t: Tables):
    """Suppliers are projects nobody has put a task into."""
    suppliers = t.read("supplier").select(
        F.concat(F.lit("s"), F.col("s_suppkey").cast("string")).alias("project_id"), F.col("s_name").alias("project_name"),
        F.col("s_nationkey").cast("string").alias("group_id"), F.lit(False).alias("closed"))
    projects = t.dim_projects.select(suppliers.columns).unionByName(suppliers)
    return panels.empty_projects(projects, t.dim_folders, t.tasks, ["default", "NATION_1"])


@query("project_pulse", f"""
    SELECT folder_name, project_name, CAST(last_pulse AS DATE) AS last_pulse_day, project_id, count(task_id) AS total_tasks,
        date_diff('day', CAST(last_pulse AS DATE), DATE '2001-09-01') AS date_human_readable
    FROM explored_tags WHERE NOT closed AND status = 0 AND kind = 'TASK' AND folder_name NOT IN ('default', 'NATION_1')
        AND tag IN ('default', 'A') GROUP BY 1, 2, 3, 4 HAVING date_diff('day', CAST(last_pulse AS DATE), DATE '2001-09-01') > 5
    ORDER BY date_human_readable DESC, folder_name, total_tasks, project_id LIMIT 500""")
def project_pulse(t: Tables):
    return panels.project_pulse(model(t), "2001-09-01", "TASK", skip_folders=["default", "NATION_1"], tags=["default", "A"])


@query("data_freshness", """
    SELECT DISTINCT date_trunc('minute', updated_time) AS updated_time_minute, date_trunc('minute', updated_time)
        AS updated_time_minute_max FROM v1_tasks WHERE task_id = '0'""")
def data_freshness(t: Tables):
    return panels.data_freshness(t.tasks_v1)


@query("next_load_time", "SELECT DISTINCT title FROM v1_tasks WHERE task_id = '0'")
def next_load_time(t: Tables):
    return panels.next_load_time(t.tasks_v1)


_TODAY = f"""SELECT * FROM (SELECT project_name, is_completed, CAST(scheduled_date AS DATE) AS scheduled_date_day,
        cleaned_content, streak, task_id, count(surr_id) AS total_tasks,
        CASE WHEN is_completed = 'new' THEN '⚪' ELSE '✅' END AS status,
        try_cast(nullif(regexp_extract(streak, '^\\d+'), '') AS BIGINT) AS streak_count
    FROM habit_named WHERE CAST(due_date AS DATE) BETWEEN {HDAY} - INTERVAL 1 MONTH AND {HDAY}
        OR CAST(completed_at AS DATE) = {HDAY} GROUP BY 1, 2, 3, 4, 5, 6)"""


@query("habits_due_today", f"""{_TODAY} ORDER BY status, project_name NULLS FIRST, streak_count DESC NULLS LAST, task_id,
    scheduled_date_day, cleaned_content LIMIT 500""")
def habits_due_today(t: Tables):
    return panels.habits_today(t.habits, t.habit_projects, HABIT_DAY)


@query("habits_new_today", f"""{_TODAY} WHERE status = '⚪' ORDER BY status, project_name NULLS FIRST,
    scheduled_date_day DESC, task_id, cleaned_content LIMIT 500""")
def habits_new_today(t: Tables):
    return panels.habits_today(t.habits, t.habit_projects, HABIT_DAY, only="new")


@query("habits_completed_today", f"""{_TODAY} WHERE status = '✅' ORDER BY status, project_name NULLS FIRST,
    scheduled_date_day DESC, task_id, cleaned_content LIMIT 500""")
def habits_completed_today(t: Tables):
    return panels.habits_today(t.habits, t.habit_projects, HABIT_DAY, only="completed")


@query("habits_completed_7d", f"""
    SELECT strftime(completed_at, '%A') AS completed_day_of_week_name, project_name, cleaned_content, task_id,
        CAST(completed_at AS DATE) AS completed_day, completed_at, streak,
        CAST(day(completed_at) AS VARCHAR) || '/' || CAST(month(completed_at) AS VARCHAR) AS concat_date
    FROM habit_named WHERE CAST(completed_at AS DATE) BETWEEN {HDAY} - INTERVAL 7 DAY AND {HDAY}
    ORDER BY completed_at DESC, surr_id LIMIT 500""")
def habits_completed_7d(t: Tables):
    return panels.habits_completed_7d(t.habits, t.habit_projects, HABIT_DAY)


@query("habits_done_by_project", f"""
    SELECT project_name, is_completed, CAST(scheduled_date AS DATE) AS scheduled_date_day, count(surr_id) AS total_tasks
    FROM habit_named WHERE CAST(scheduled_date AS DATE) BETWEEN {HDAY} - INTERVAL 7 DAY AND {HDAY}
        AND is_completed = 'completed' GROUP BY 1, 2, 3""")
def habits_done_by_project(t: Tables):
    return panels.habits_done_by_project(t.habits, t.habit_projects, HABIT_DAY)


_OPEN_CATALOG = "FROM catalog c JOIN projects p ON c.project_id = p.project_id WHERE NOT coalesce(p.closed, FALSE)"


@query("filter_option_lists", f"""
    SELECT 'folder' AS kind, name FROM (SELECT DISTINCT c.folder_name AS name {_OPEN_CATALOG})
    UNION ALL SELECT 'project', name FROM (SELECT DISTINCT c.project_name AS name {_OPEN_CATALOG}
        AND c.folder_name IN ('NATION_3', 'default'))""")
def filter_option_lists(t: Tables):
    catalog = t.catalog
    folders = panels.filter_option_lists(catalog, t.projects)
    projects = panels.filter_option_lists(catalog, t.projects, "project_name", folders=["NATION_3", "default"])
    return folders.select(F.lit("folder").alias("kind"), F.col("folder_name").alias("name")).unionByName(
        projects.select(F.lit("project").alias("kind"), F.col("project_name").alias("name")))


@query("regex_name_filter", """
    SELECT grain_rollup_id FROM rollup WHERE grain_level = 'project' AND scope_bucket = 'rest'
        AND regexp_matches(folder_name, '^(?:NATION_1.*|default)$')
        AND regexp_matches(project_name, '^(?:Customer#0000000.*)$')""")
def regex_name_filter(t: Tables):
    where = panels.panel_filter("rest", folders="NATION_1.*|default", projects="Customer#0000000.*", grain="project")
    return t.rollup.filter(F.col("grain_level") == "project").filter(where).select("grain_rollup_id")


# Checks: each also has to find something, so some look at columns that break the rule.

@query("dq_unique", """
    SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""")
def dq_unique(t: Tables):
    return quality.unique(t.read("lineitem"), "l_orderkey", "l_linenumber")


@query("dq_not_null", "SELECT project_id FROM projects WHERE group_id IS NULL")
def dq_not_null(t: Tables):
    return quality.not_null(t.projects, "group_id").select("project_id")


@query("dq_relationships", """
    SELECT task_id, 'gone' || project_id AS project_id FROM tasks WHERE title = '2-HIGH'""")
def dq_relationships(t: Tables):
    gone = F.when(F.col("title") == "2-HIGH", F.concat(F.lit("gone"), "project_id")).otherwise(F.col("project_id"))
    return quality.relationships(t.tasks.select("task_id", gone.alias("project_id")), "project_id", t.projects,
                                 spread="task_id").select("task_id", "project_id")


@query("dq_accepted_values", "SELECT project_id FROM catalog WHERE scope_bucket NOT IN ('rest')")
def dq_accepted_values(t: Tables):
    catalog = marts.project_catalog(t.projects, t.folders, CFG)
    return quality.accepted_values(catalog, "scope_bucket", ["rest"]).select("project_id")


@query("dq_workload_reconciles", """
    SELECT due_date_day, project_id, open_task_count AS expected_open_task_count, open_task_count + 1 AS open_task_count
    FROM workload WHERE project_name LIKE '%7'""")
def dq_workload_reconciles(t: Tables):
    """The counts of some projects are broken on purpose; a sound mart gives no rows."""
    wrong = F.col("open_task_count") + F.when(F.col("project_name").endswith("7"), 1).otherwise(0)
    return quality.workload_reconciles(t.workload.withColumn("open_task_count", wrong.cast("bigint")), t.tasks)


@query("dq_rollup_conserves", """
    SELECT due_date_day, scope_bucket, grain_level, coalesce(n, 0) AS expected_open_task_count,
        actual AS actual_open_task_count
    FROM (SELECT due_date_day, scope_bucket, grain_level, sum(task_count + CASE WHEN grain_level = 'folder'
              AND folder_name = 'default' THEN 1 ELSE 0 END)::BIGINT AS actual FROM rollup GROUP BY 1, 2, 3) a
    LEFT JOIN (SELECT due_date_day, scope_bucket, count(DISTINCT task_id) AS n FROM open_semantic
               GROUP BY 1, 2) e USING (due_date_day, scope_bucket) WHERE actual <> coalesce(n, 0)""")
def dq_rollup_conserves(t: Tables):
    """The counts of a folder are broken on purpose; a sound mart gives no rows."""
    broken = (F.col("grain_level") == "folder") & (F.col("folder_name") == "default")
    wrong = F.col("task_count") + F.when(broken, 1).otherwise(0)
    return quality.rollup_conserves(t.rollup.withColumn("task_count", wrong.cast("bigint")), t.semantic)


@query("dq_url_patterns", """
    SELECT task_id FROM semantic WHERE project_name LIKE '%9'""")
def dq_url_patterns(t: Tables):
    """Links of some projects are broken on purpose; sound marts give no rows."""
    broken = F.col("project_name").endswith("9")
    rows = t.semantic.withColumn("task_url_web", F.when(broken, F.lit("x")).otherwise(F.col("task_url_web")))
    return quality.url_patterns(rows).select("task_id")


@query("dq_url_patterns_rollup", """
    SELECT grain_rollup_id FROM rollup WHERE grain_level = 'folder' AND folder_name = 'default'""")
def dq_url_patterns_rollup(t: Tables):
    broken = (F.col("grain_level") == "folder") & (F.col("folder_name") == "default")
    rows = t.rollup.withColumn("grain_url_native", F.when(broken, F.lit("x")).otherwise(F.col("grain_url_native")))
    return quality.rollup_url_patterns(rows).select("grain_rollup_id")


@query("dq_orphans_warn", """
    SELECT 'lost' || project_id AS project_id, count(*) AS row_count, min(due_date_day) AS earliest_due_date_day,
        max(due_date_day) AS latest_due_date_day FROM semantic WHERE folder_name = 'default' GROUP BY 1""")
def dq_orphans_warn(t: Tables):
    """Tasks of the default folder name projects that aren't there."""
    from tasklens.operators.metrics import orphan_keys

    lost = F.when(F.col("folder_name") == "default", F.concat(F.lit("lost"), "project_id")).otherwise(F.col("project_id"))
    return orphan_keys(t.semantic.withColumn("project_id", lost), t.projects, "project_id", "due_date_day")


_PARITY = f"""SELECT count(*) AS total_rows, count(CASE WHEN status = 0 THEN 1 END) AS open_rows,
    count(CASE WHEN status = 2 THEN 1 END) AS done_rows,
    count(CASE WHEN status = 0 AND CAST(due_date AS DATE) BETWEEN {DAY} AND {DAY} + INTERVAL 35 DAY THEN 1 END)
        AS due_next_35d_open,
    count(CASE WHEN status = 2 AND CAST(completed_time AS DATE) BETWEEN {DAY} - INTERVAL 30 DAY AND {DAY} THEN 1 END)
        AS completed_last_30d"""


@query("dq_parity", f"""
    SELECT measure, left_count, right_count, right_count - left_count AS difference FROM (
        UNPIVOT ({_PARITY} FROM v1_tasks) ON COLUMNS(*) INTO NAME measure VALUE left_count) a JOIN (
        UNPIVOT ({_PARITY} FROM v3_tasks) ON COLUMNS(*) INTO NAME measure VALUE right_count) b USING (measure)""")
def dq_parity(t: Tables):
    return quality.parity(t.tasks_v1, marts.fct_tasks_v3(t.raw_tasks_v3, CFG), AS_OF)
