"""The same views in SQL, as named pieces that the oracle queries put together."""

from __future__ import annotations

import re

AS_OF = "DATE '1998-06-15'"
# The zone of the models is UTC+7 all year: instants become local times by adding 7 hours.
HABIT_DAY = "DATE '2024-01-30'"


def key(*fields: str) -> str:
    parts = ", '-', ".join(f"coalesce(CAST({f} AS VARCHAR), '_dbt_utils_surrogate_key_null_')" for f in fields)
    return f"md5(concat({parts}))"


def label(name: str) -> str:
    return f"(chr((127812 + ('0x' || substr(md5({name}), 1, 8))::BIGINT % 50)::INT) || ' ' || {name})"


def sunday(day: str) -> str:
    return f"CAST({day} - CAST(dayofweek({day}) AS INTEGER) AS DATE)"


def day_parts(day: str, prefix: str = "due_date_") -> str:
    return f"""{sunday(day)} AS {prefix}week, strftime({day}, '%A') AS {prefix}day_of_week_name,
        CAST(month({day}) AS BIGINT) AS {prefix}month_num, CAST(day({day}) AS BIGINT) AS {prefix}day_of_month_num"""


def links(*grains: str) -> str:
    project = "coalesce(project_id, 'unknown_project')"
    paths = {
        "task": f"'ticktick.com/webapp/#p/' || {project} || '/tasks/' || coalesce(task_id, 'unknown_task')",
        "project": f"'ticktick.com/webapp/#p/' || {project} || '/tasks'",
        "folder": "'ticktick.com/webapp/#g/' || coalesce(folder_id, 'default')",
    }
    return ", ".join(
        f"{paths[g]} AS {g}_url_path, 'https://' || {paths[g]} AS {g}_url_web, "
        f"'ticktick://' || {paths[g]} AS {g}_url_native"
        for g in grains
    )


_SCOPE = """CASE WHEN regexp_matches(lower(folder_name || ' ' || project_name), '(^|[^a-z0-9])7([^a-z0-9]|$)')
    THEN '7' ELSE 'rest' END AS scope_bucket"""

_DEFAULT = "(fid IN ('0', 'default') OR fid IS NULL OR lower(coalesce(fname, 'default')) = 'default')"

_RAW_TASK = """CAST(o_orderkey AS VARCHAR) AS task_id, CAST(o_custkey AS VARCHAR) AS project_id, o_orderkey AS sort_order,
    o_orderpriority AS title, 'UTC' AS timezone, o_orderstatus = 'P' AS is_allday,
    CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS priority, CAST(0 AS BIGINT) AS status,
    CASE WHEN o_orderstatus <> 'O' THEN o_orderstatus END AS column_id, 'e' || CAST(o_orderkey AS VARCHAR) AS etag,
    'TEXT' AS kind, CAST(NULL AS VARCHAR) AS repeat_flag, CAST(NULL AS VARCHAR) AS parent_id,
    o_orderdate - INTERVAL 1 DAY + INTERVAL 7 HOUR AS start_date, o_orderdate + INTERVAL 7 HOUR AS due_date"""

_PROJECT = """CASE WHEN c_mktsegment = 'BUILDING' THEN 'inbox' || CAST(c_custkey AS VARCHAR)
        ELSE CAST(c_custkey AS VARCHAR) END AS project_id,
    CASE WHEN c_mktsegment = 'FURNITURE' THEN 'folder_map - ''' || c_name || '''' ELSE c_name END AS project_name,
    c_custkey AS sort_order, CASE WHEN c_acctbal >= 0 THEN CAST(c_nationkey AS VARCHAR) END AS group_id,
    'TASK' AS kind, CAST(NULL AS VARCHAR) AS color, 'list' AS view_mode, 'write' AS permission"""

CTES = {
    "order_lines": """SELECT l_orderkey, max(l_shipdate) AS ship, list_sort(list(DISTINCT l_returnflag)) AS flags
        FROM lineitem GROUP BY l_orderkey""",
    "tasks": """SELECT CAST(o_orderkey AS VARCHAR) AS task_id, CAST(o_custkey AS VARCHAR) AS project_id,
        o_orderpriority AS title, o_orderdate AS due_date,
        CAST(CASE WHEN o_orderstatus = 'F' THEN 2 ELSE 0 END AS BIGINT) AS status,
        CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS priority,
        CASE WHEN o_orderpriority = '5-LOW' THEN 'NOTE' ELSE 'TASK' END AS kind,
        CASE WHEN o_orderstatus = 'F' THEN ship END AS completed_time,
        CASE WHEN o_orderstatus = 'F' THEN ship + INTERVAL 1 HOUR END AS updated_time,
        list_filter(coalesce(flags, []), lambda t: t <> 'N') AS tags,
        CASE WHEN list_contains(coalesce(flags, []), 'A') THEN '🥩'
             WHEN len(list_filter(coalesce(flags, []), lambda t: t <> 'N')) = 0 THEN '🧃' END AS gtd_work_type
        FROM orders LEFT JOIN order_lines ON o_orderkey = l_orderkey""",
    "projects": """SELECT CAST(c_custkey AS VARCHAR) AS project_id, c_name AS project_name,
        CASE WHEN c_acctbal >= 0 THEN CAST(c_nationkey AS VARCHAR) END AS group_id,
        c_mktsegment = 'MACHINERY' AS closed FROM customer""",
    "folders": "SELECT CAST(n_nationkey AS VARCHAR) AS folder_id, n_name AS folder_name FROM nation",
    "dim_projects": """SELECT p.project_id, project_name, coalesce(group_id, 'default') AS group_id, closed,
        coalesce(due, done) AS last_pulse FROM projects p LEFT JOIN (
            SELECT project_id, max(due_date) AS due, max(completed_time) AS done FROM tasks GROUP BY 1
        ) t ON p.project_id = t.project_id""",
    "dim_folders": """SELECT * FROM folders UNION ALL
        SELECT id, 'default' FROM (VALUES ('default'), ('0')) v(id) WHERE id NOT IN (SELECT folder_id FROM folders)""",
    "task_tags": """SELECT task_id, unnest(CASE WHEN len(tags) = 0 THEN ['default'] ELSE tags END) AS tag FROM tasks""",
    "tags": f"SELECT {key('tag')} AS tag_id, tag FROM (SELECT DISTINCT tag FROM task_tags)",
    "bridge": "SELECT task_id, tag_id FROM task_tags JOIN tags USING (tag)",
    "spine": f"""SELECT CAST(d AS DATE) AS date_day
        FROM range({AS_OF}, {AS_OF} + INTERVAL 3 MONTH, INTERVAL 1 DAY) r(d)""",
    "joined": """SELECT t.task_id, t.project_id, coalesce(p.project_name, t.project_id, 'unknown_project') AS project_name,
        coalesce(nullif(p.group_id, ''), CASE WHEN p.project_id IS NOT NULL THEN 'default' END) AS fid,
        f.folder_name AS fname, title, due_date, completed_time, updated_time, status, gtd_work_type
        FROM tasks t LEFT JOIN projects p ON t.project_id = p.project_id
        LEFT JOIN folders f ON coalesce(nullif(p.group_id, ''), 'default') = f.folder_id""",
    "named": f"""SELECT *, CASE WHEN {_DEFAULT} THEN 'default' ELSE fid END AS folder_id,
        CASE WHEN {_DEFAULT} THEN 'default' ELSE fname END AS folder_name,
        CAST(due_date AS DATE) AS due_date_day, CAST(completed_time AS DATE) AS completed_time_day FROM joined""",
    "semantic": f"""SELECT task_id, project_id, project_name, folder_id, folder_name, title, due_date, due_date_day,
        {day_parts('due_date_day')}, completed_time, completed_time_day,
        strftime(completed_time_day, '%A') AS completed_time_day_of_week_name, updated_time, status, gtd_work_type,
        {_SCOPE}, {links('task', 'project', 'folder')} FROM named""",
    "catalog": f"""SELECT *, {_SCOPE} FROM (SELECT DISTINCT project_id, project_name,
        CASE WHEN {_DEFAULT} THEN 'default' ELSE fid END AS folder_id,
        CASE WHEN {_DEFAULT} THEN 'default' ELSE fname END AS folder_name
        FROM (SELECT p.project_id, project_name, coalesce(nullif(group_id, ''), 'default') AS fid, folder_name AS fname
              FROM projects p LEFT JOIN folders f ON coalesce(nullif(group_id, ''), 'default') = f.folder_id))""",
    "open_counts": """SELECT CAST(due_date AS DATE) AS due_date_day, project_id,
        count(DISTINCT task_id) AS open_task_count
        FROM tasks WHERE status <> 2 AND due_date IS NOT NULL GROUP BY 1, 2""",
    "workload": f"""SELECT {key('date_day', 'c.project_id')} AS due_workload_daily_id, date_day AS due_date_day,
        {day_parts('date_day')}, scope_bucket, folder_id, folder_name, c.project_id, project_name,
        coalesce(open_task_count, 0) AS open_task_count, {links('project', 'folder').replace('(project_id', '(c.project_id')}
        FROM spine CROSS JOIN catalog c
        LEFT JOIN open_counts o ON o.due_date_day = date_day AND o.project_id = c.project_id""",
    "open_semantic": "SELECT * FROM semantic WHERE status <> 2 AND due_date_day IS NOT NULL",
    "rollup_rows": """SELECT due_date_day, scope_bucket, folder_id, folder_name, project_id, project_name, 'task' AS grain_level,
            task_id AS grain_id, coalesce(title, task_id, 'untitled_task') AS grain_label, project_id AS parent_grain_id,
            project_name AS parent_grain_label, task_url_path AS g, project_url_path AS p,
            count(DISTINCT task_id) AS task_count
        FROM open_semantic GROUP BY ALL
        UNION ALL SELECT due_date_day, scope_bucket, folder_id, folder_name, project_id, project_name, 'project', project_id,
            project_name, folder_id, folder_name, project_url_path, folder_url_path, count(DISTINCT task_id)
        FROM open_semantic GROUP BY ALL
        UNION ALL SELECT due_date_day, scope_bucket, folder_id, folder_name, NULL, NULL, 'folder', folder_id, folder_name,
            folder_id, folder_name, folder_url_path, folder_url_path, count(DISTINCT task_id)
        FROM open_semantic GROUP BY ALL""",
    "rollup": f"""SELECT {key('due_date_day', 'grain_level', 'grain_id', 'scope_bucket')} AS grain_rollup_id,
        due_date_day, {day_parts('due_date_day')}, scope_bucket, folder_id, folder_name, project_id, project_name,
        grain_level, grain_id, grain_label, parent_grain_id, parent_grain_label, g AS grain_url_path,
        'https://' || g AS grain_url_web, 'ticktick://' || g AS grain_url_native, p AS parent_grain_url_path,
        'https://' || p AS parent_grain_url_web, 'ticktick://' || p AS parent_grain_url_native, task_count
        FROM rollup_rows""",
    "activity": f"""SELECT {key('task_id', 'completed_time', 'updated_time')} AS completed_activity_id, task_id, title,
        project_id, project_name, {label('project_name')} AS project_name_formatted, folder_id, folder_name, scope_bucket,
        gtd_work_type, completed_time, completed_time_day, completed_time_day_of_week_name, updated_time, due_date,
        due_date_day, task_url_path, task_url_web, task_url_native, project_url_path, project_url_web,
        project_url_native, folder_url_path, folder_url_web, folder_url_native
        FROM semantic WHERE status = 2 AND completed_time_day IS NOT NULL""",
    # Explore rows: inner projects and folders; tags and spine are added by the queries.
    "explored": """SELECT t.*, p.project_name, p.group_id, p.closed, p.last_pulse, f.folder_id, f.folder_name
        FROM tasks t JOIN dim_projects p ON t.project_id = p.project_id JOIN dim_folders f ON p.group_id = f.folder_id""",
    "explored_tags": """SELECT e.*, g.tag_id, g.tag FROM explored e JOIN bridge b ON e.task_id = b.task_id
        JOIN tags g ON b.tag_id = g.tag_id""",
    "explored_spine": """SELECT date_day, e.* FROM explored e RIGHT JOIN spine s ON e.due_date = CAST(s.date_day AS TIMESTAMP)""",
    # First generation.
    "v1_open": f"""SELECT {_RAW_TASK}, ship + INTERVAL 7 HOUR AS _completed_time,
        list_filter(coalesce(flags, []), lambda t: t <> 'N') AS tags,
        CASE WHEN o_orderstatus = 'P' THEN [CAST(o_custkey AS VARCHAR)] ELSE [] END AS childids,
        ['TRIGGER:PT0S'] AS reminders
        FROM orders LEFT JOIN order_lines ON o_orderkey = l_orderkey WHERE o_orderstatus <> 'F'""",
    "v1_history": f"""SELECT {_RAW_TASK}, l_shipdate + INTERVAL 7 HOUR AS _completed_time,
        [l_returnflag, l_linestatus] AS tags, CAST([] AS VARCHAR[]) AS childids, [l_returnflag, 'b'] AS reminders,
        concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS dbt_scd_id,
        l_shipdate + INTERVAL 7 HOUR AS dbt_updated_at, l_shipdate + INTERVAL 7 HOUR AS dbt_valid_from,
        CASE WHEN l_linestatus = 'F' THEN l_shipdate + INTERVAL 1 DAY + INTERVAL 7 HOUR END AS dbt_valid_to
        FROM lineitem JOIN orders ON o_orderkey = l_orderkey""",
    "v1_latest": """SELECT * FROM v1_history
        QUALIFY row_number() OVER (PARTITION BY task_id ORDER BY dbt_updated_at DESC, dbt_scd_id DESC) = 1""",
    "v1_inferred": """SELECT task_id, project_id, title, due_date, tags, childids, reminders, kind,
            CAST(NULL AS TIMESTAMP) AS completed_time, CAST(NULL AS TIMESTAMP) AS updated_time, CAST(0 AS BIGINT) AS status
        FROM v1_open WHERE task_id <> '0'
        UNION ALL SELECT task_id, project_id, title, due_date, tags, childids, reminders, kind, dbt_valid_to,
            dbt_updated_at, 2 FROM v1_latest WHERE dbt_valid_to IS NOT NULL""",
    "v1_banner": """SELECT task_id, project_id,
            CASE WHEN date_diff('minute', TIMESTAMP '1998-06-15 09:30:00', _completed_time + INTERVAL 15 MINUTE) > 0
            THEN '🏗️ in ' || CAST(date_diff('minute', TIMESTAMP '1998-06-15 09:30:00',
                _completed_time + INTERVAL 15 MINUTE) AS VARCHAR) || ' minutes' ELSE '🟢 now' END AS title,
            due_date, tags, childids, reminders, kind, CAST(NULL AS TIMESTAMP) AS completed_time,
            _completed_time AS updated_time, CAST(0 AS BIGINT) AS status
        FROM v1_open WHERE task_id = '0'""",
    "v1_tasks": """SELECT *, CASE WHEN list_contains(tags, 'A') THEN '🥩' WHEN len(tags) = 0 THEN '🧃' END AS gtd_work_type
        FROM (SELECT * FROM v1_inferred UNION ALL SELECT * FROM v1_banner)""",
    "v1_base_projects": f"SELECT {_PROJECT}, c_mktsegment = 'MACHINERY' AS closed FROM customer",
    "v1_project_history": f"""SELECT {_PROJECT}, c_mktsegment = 'MACHINERY' AS closed,
        CAST(o_orderkey AS VARCHAR) AS dbt_scd_id, o_orderdate + INTERVAL 7 HOUR AS dbt_updated_at,
        o_orderdate + INTERVAL 7 HOUR AS dbt_valid_from,
        CASE WHEN o_orderstatus = 'F' THEN o_orderdate + INTERVAL 30 DAY + INTERVAL 7 HOUR END AS dbt_valid_to
        FROM orders JOIN customer ON o_custkey = c_custkey""",
    "v1_inferred_projects": """SELECT * EXCLUDE (closed), CAST(NULL AS TIMESTAMP) AS completed_time, FALSE AS closed
        FROM v1_base_projects
        UNION ALL SELECT * EXCLUDE (closed, dbt_scd_id, dbt_updated_at, dbt_valid_from, dbt_valid_to),
            dbt_valid_to, TRUE
        FROM (SELECT * FROM v1_project_history QUALIFY
            row_number() OVER (PARTITION BY project_id ORDER BY dbt_updated_at DESC, dbt_scd_id DESC) = 1)
        WHERE dbt_valid_to IS NOT NULL""",
    "v1_projects": """SELECT i.* EXCLUDE (group_id), coalesce(group_id, 'default') AS group_id,
            coalesce(due, done) AS last_pulse
        FROM v1_inferred_projects i LEFT JOIN (
            SELECT project_id AS pid, max(due_date) AS due, max(completed_time) AS done FROM v1_tasks GROUP BY 1
        ) t ON i.project_id = t.pid""",
    # Replica.
    "v3_base": """SELECT CAST(o_orderkey AS VARCHAR) AS task_id, 'acc' || substr(o_orderpriority, 1, 1) AS account_id,
        CAST(o_custkey AS VARCHAR) AS project_id, o_orderkey AS sort_order, o_orderpriority AS title,
        CAST(NULL AS VARCHAR) AS content, CASE WHEN o_orderstatus = 'F' THEN 'Asia/Tokyo' ELSE 'UTC' END AS timezone,
        o_orderstatus IN ('F', 'O') AS is_allday, CAST(NULL AS BOOLEAN) AS is_floating,
        CAST(NULL AS VARCHAR) AS reminder,
        CAST(CASE WHEN o_orderpriority <> '5-LOW' THEN 9 ELSE 5 END AS BIGINT) AS priority,
        CAST(CASE WHEN o_orderstatus = 'F' THEN 2 ELSE 0 END AS BIGINT) AS status,
        CAST(CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 1 WHEN o_orderpriority <> '5-LOW' THEN 0 END AS BIGINT)
            AS deleted,
        o_custkey AS creator, o_orderdate + INTERVAL 7 HOUR AS due_date, ship + INTERVAL 7 HOUR AS _completed_time,
        o_orderdate + INTERVAL 7 HOUR AS created_time, ship + INTERVAL 8 HOUR AS modified_time, 'TEXT' AS kind,
        list_filter(coalesce(flags, []), lambda t: t <> 'N') AS tags
        FROM orders LEFT JOIN order_lines ON o_orderkey = l_orderkey""",
    "v3_tasks": """SELECT task_id, account_id, project_id, sort_order, title, timezone, is_allday, priority, due_date,
        CASE WHEN status = 2 THEN _completed_time END AS completed_time,
        CASE WHEN status = 2 THEN modified_time END AS updated_time, status, tags,
        CASE WHEN list_contains(tags, 'A') THEN '🥩' WHEN len(tags) = 0 THEN '🧃' END AS gtd_work_type
        FROM v3_base WHERE deleted = 0""",
    "v3_base_projects": """SELECT CAST(c_custkey AS VARCHAR) AS project_id, 'acc1' AS account_id, c_name AS project_name,
        c_custkey AS sort_order, CASE WHEN c_acctbal >= 0 THEN CAST(c_nationkey AS VARCHAR) END AS group_id,
        'TASK' AS kind, c_mktsegment AS color, 'list' AS view_mode, CAST(NULL AS VARCHAR) AS permission,
        c_mktsegment = 'MACHINERY' AS closed, 'e' AS etag, TIMESTAMP '2024-01-01 07:00:00' AS modified_time FROM customer""",
    "v3_all_projects": """SELECT project_id, account_id, project_name, sort_order, group_id,
            CASE WHEN closed THEN modified_time END AS completed_time, closed FROM v3_base_projects
        UNION ALL SELECT DISTINCT project_id, substr(project_id, 6), project_name, sort_order, group_id,
            CAST(NULL AS TIMESTAMP), FALSE
        FROM v1_base_projects b WHERE project_id LIKE 'inbox%'
            AND NOT EXISTS (SELECT 1 FROM v3_base_projects v WHERE v.project_id = b.project_id)""",
    "v3_projects": """SELECT a.* EXCLUDE (group_id), coalesce(group_id, 'default') AS group_id,
            coalesce(due, done) AS last_pulse
        FROM v3_all_projects a LEFT JOIN (
            SELECT project_id AS pid, max(due_date) AS due, max(completed_time) AS done FROM v3_tasks GROUP BY 1
        ) t ON a.project_id = t.pid""",
    "v3_groups": """SELECT CAST(n_nationkey AS VARCHAR) AS group_id, 'acc1' AS account_id, n_name AS group_name,
        CASE WHEN n_regionkey = 1 THEN TRUE WHEN n_regionkey = 2 THEN FALSE
             WHEN n_regionkey = 3 THEN n_nationkey > 10 END AS deleted,
        CAST(n_nationkey AS BIGINT) AS sort_order, CASE WHEN n_regionkey = 3 THEN 'kanban' END AS view_mode, 'e' AS etag
        FROM nation""",
    "v3_folders": """SELECT group_id AS folder_id, group_name AS folder_name FROM v3_groups WHERE NOT coalesce(deleted, FALSE)
        UNION ALL SELECT id, 'default' FROM (VALUES ('default'), ('0')) v(id)
        WHERE id NOT IN (SELECT group_id FROM v3_groups WHERE NOT coalesce(deleted, FALSE))""",
    # Changes.
    "ops": """SELECT CAST(user_id AS VARCHAR) AS account_id, event_id AS check_point, event_type,
        't' || CAST(event_id % 7 AS VARCHAR) AS task_id, CAST(user_id AS VARCHAR) AS project_id,
        CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
        FROM events WHERE event_type IN ('error', 'click', 'view')""",
    "last_ops": """SELECT * FROM ops
        QUALIFY row_number() OVER (PARTITION BY account_id, task_id ORDER BY check_point DESC) = 1""",
    "users": "SELECT DISTINCT CAST(user_id AS VARCHAR) AS account_id FROM events",
    "old_tasks": "SELECT account_id, unnest(['t0', 't9']) AS task_id FROM users",
    "polls": """SELECT CAST(user_id AS VARCHAR) AS account_id, event_id AS check_point, event_type, ts,
        CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, event_type <> 'signup' AS changed FROM events""",
    # Habits.
    "habit_active": """SELECT CAST(user_id AS VARCHAR) AS id, CAST(user_id % 30 AS VARCHAR) AS project_id,
        '  habit   @daily of ' || CAST(user_id AS VARCHAR) AS content, user_id,
        CASE WHEN count(*) > 60 THEN '**Current streak:** ' || CAST(count(*) AS VARCHAR) || ' days' ELSE 'plain' END
            AS description,
        count(*) AS priority, date_trunc('second', max(ts)) AS due_date FROM events GROUP BY user_id""",
    "habit_completed": """SELECT CAST(event_id AS VARCHAR) AS id, CAST(user_id AS VARCHAR) AS task_id,
        CAST(user_id % 30 AS VARCHAR) AS project_id, 'done @' || props AS content, user_id,
        date_trunc('second', ts) AS completed_at FROM events WHERE event_type = 'purchase'""",
    "habit_union": """SELECT 'active_tasks' AS src, id, id AS task_id, project_id, content, description, priority,
            CAST(NULL AS TIMESTAMP) AS completed_at, due_date FROM habit_active
        UNION ALL SELECT 'completed_tasks', c.id, c.task_id, c.project_id, c.content, a.description, NULL, completed_at,
            NULL FROM habit_completed c LEFT JOIN habit_active a ON c.task_id = a.id""",
    "habit": f"""SELECT {key('task_id', 'id')} AS surr_id, src, id, task_id, project_id, content, description, priority,
        completed_at, due_date,
        trim(regexp_replace(regexp_replace(content, '@[^ ]+', '', 'g'), '\\s+', ' ', 'g')) AS cleaned_content,
        CASE WHEN description LIKE '%Current streak%' THEN replace(description, '**Current streak:** ', '') END AS streak,
        coalesce(completed_at, due_date) AS scheduled_date,
        CASE WHEN completed_at IS NULL THEN 'new' ELSE 'completed' END AS is_completed FROM habit_union""",
    "habit_named": """SELECT h.*, n_name AS project_name FROM habit h
        LEFT JOIN nation ON h.project_id = CAST(n_nationkey AS VARCHAR)""",
    "habit_rules": """SELECT user_id, CAST(min(ts) AS DATE) AS start_day,
        CASE WHEN user_id < 50 THEN 1 WHEN user_id < 100 THEN 2 ELSE 7 END AS step FROM events GROUP BY user_id""",
    "habit_expected": f"""SELECT CAST(user_id AS VARCHAR) AS task_id, CAST(d AS DATE) AS expected_date
        FROM habit_rules, range(start_day, {HABIT_DAY} + INTERVAL 1 DAY, INTERVAL 1 DAY) r(d)
        WHERE CASE WHEN step = 7 THEN dayofweek(d) IN (0, 1, 3) ELSE date_diff('day', start_day, CAST(d AS DATE)) % step = 0 END""",
    "habit_done": """SELECT CAST(user_id AS VARCHAR) AS task_id, CAST(ts AS DATE) AS expected_date,
        min(date_trunc('second', ts)) AS completed_time FROM events WHERE event_type = 'purchase' GROUP BY 1, 2""",
    "habit_days": """SELECT e.task_id, e.expected_date, CAST(CASE WHEN completed_time IS NULL THEN -1 ELSE 2 END AS BIGINT)
        AS status, completed_time FROM habit_expected e LEFT JOIN habit_done d USING (task_id, expected_date)""",
    "habit_islands": """SELECT *, sum(CASE WHEN status = -1 THEN 1 ELSE 0 END)
        OVER (PARTITION BY task_id ORDER BY expected_date) AS island FROM habit_days""",
}


def sql(body: str) -> str:
    """The body with the pieces it names in front, in order."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name in CTES:
            if name not in needed and re.search(rf"(?:FROM|JOIN|,)\s+{name}\b", text):
                needed.add(name)
                visit(CTES[name])

    visit(body)
    pieces = [f"{name} AS ({CTES[name]})" for name in CTES if name in needed]
    return f"WITH {', '.join(pieces)} {body}" if pieces else body
