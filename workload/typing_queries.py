"""Typing, projection, parsing and business rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from tasklens.functions import dates, links, rules, text, typing
from tasklens.functions.json import json_scalar, json_string_array
from tasklens.operators import shapes
from tasklens.plans import base, marts, staging
from workload.ctes import label, sunday
from workload.registry import query
from workload.tables import CFG, Tables, utc

TZ = CFG.timezone


@query("base_projects", "SELECT * FROM v1_base_projects")
def base_projects(t: Tables):
    return base.base_projects(t.raw_projects)


@query("base_projects_snapshot", "SELECT * FROM v1_project_history")
def base_projects_snapshot(t: Tables):
    return base.base_projects_snapshot(t.raw_projects_history, TZ)


_ARRAYS = ["tags", "childids", "reminders"]


def _flat(df, arrays=_ARRAYS):
    return df.withColumns({a: F.concat_ws(",", a) for a in arrays})


_FLAT_SQL = "array_to_string(tags, ',') AS tags, array_to_string(childids, ',') AS childids, " \
    "array_to_string(reminders, ',') AS reminders"


@query("base_tasks", f"SELECT * EXCLUDE (tags, childids, reminders), {_FLAT_SQL} FROM v1_open")
def base_tasks(t: Tables):
    return _flat(base.base_tasks(t.raw_tasks, TZ))


@query("base_tasks_snapshot", f"SELECT * EXCLUDE (tags, childids, reminders), {_FLAT_SQL} FROM v1_history")
def base_tasks_snapshot(t: Tables):
    return _flat(base.base_tasks_snapshot(t.raw_history, TZ))


@query("base_v3_tasks", """
    SELECT b.* EXCLUDE (tags), array_to_string(tags, ',') AS tags,
        CAST(CASE WHEN o_orderstatus = 'F' THEN 100 ELSE o_custkey % 100 END AS BIGINT) AS progress,
        CAST(NULL AS VARCHAR) AS column_id, 'e' AS etag,
        CASE WHEN o_orderstatus = 'P' THEN 'RRULE:FREQ=DAILY' END AS repeat_flag,
        CASE WHEN o_orderstatus = 'F' THEN 'u1' END AS completed_user_id,
        CASE WHEN o_orderstatus = 'F' THEN 'p' ELSE CAST(o_custkey AS VARCHAR) END AS parent_id,
        CAST(o_orderkey AS VARCHAR) || ',c' AS childids,
        '' AS reminders,
        o_orderdate + CASE WHEN o_orderstatus = 'O' THEN INTERVAL 7 HOUR ELSE INTERVAL 13 HOUR END AS start_date,
        CASE WHEN o_orderstatus = 'P' THEN o_orderdate + INTERVAL 19 HOUR END AS repeat_first_date,
        o_orderdate + INTERVAL 7 HOUR AS updated_at,
        TRUE AS payload_kept
    FROM v3_base b JOIN orders ON b.task_id = CAST(o_orderkey AS VARCHAR)""")
def base_v3_tasks(t: Tables):
    rows = _flat(base.base_v3_tasks(t.raw_tasks_v3, TZ))
    kept = F.get_json_object("raw_json", "$.sortOrder") == F.col("task_id")
    return rows.withColumn("payload_kept", kept).drop("raw_json")


@query("base_v3_projects", "SELECT * FROM v3_base_projects")
def base_v3_projects(t: Tables):
    return base.base_v3_projects(t.raw_projects_v3, TZ).drop("raw_json", "updated_at")


@query("base_v3_groups", "SELECT * FROM v3_groups")
def base_v3_groups(t: Tables):
    return base.base_v3_groups(t.raw_groups_v3, TZ).drop("raw_json", "updated_at", "sort_type")


@query("base_habit_active", """
    SELECT id, project_id, content, description, priority, user_id, user_id AS added_by_uid,
        CAST(0 AS BIGINT) AS note_count, CAST(1 AS BIGINT) AS day_order, CAST(1 AS BIGINT) AS child_order,
        FALSE AS checked, FALSE AS is_collapsed, FALSE AS is_deleted, 'daily' AS labels,
        TRUE AS due_is_recurring, 'en' AS due_lang, CAST(NULL AS VARCHAR) AS due_timezone, 'every day' AS due_string,
        due_date + INTERVAL 7 HOUR AS due_date, TIMESTAMP '2024-01-01 07:00:00' AS added_at,
        TIMESTAMP '2024-01-01 07:00:00' AS updated_at, CAST(NULL AS TIMESTAMP) AS completed_at,
        CAST(NULL AS VARCHAR) AS section_id, CAST(NULL AS VARCHAR) AS parent_id, CAST(NULL AS VARCHAR) AS assigned_by_uid,
        CAST(NULL AS VARCHAR) AS responsible_uid, CAST(NULL AS VARCHAR) AS deadline, CAST(NULL AS VARCHAR) AS duration
    FROM habit_active""")
def base_habit_active(t: Tables):
    return _flat(base.base_habit_active(t.raw_habit_active, TZ), ["labels"])


@query("base_habit_completed", """
    SELECT CAST(id AS BIGINT) AS id, task_id, project_id, user_id, content, completed_at + INTERVAL 7 HOUR AS completed_at,
        CAST(0 AS BIGINT) AS note_count, CAST(NULL AS VARCHAR) AS section_id, CAST(NULL AS VARCHAR) AS meta_data,
        CAST(NULL AS VARCHAR) AS item_object, '' AS notes FROM habit_completed""")
def base_habit_completed(t: Tables):
    return _flat(base.base_habit_completed(t.raw_habit_completed, TZ), ["notes"])


@query("base_habit_projects", """
    SELECT CAST(n_nationkey AS VARCHAR) AS id, n_name AS name, 'red' AS color, CAST(n_regionkey AS BIGINT) AS default_order,
        FALSE AS is_archived, FALSE AS is_collapsed, FALSE AS inbox_project, FALSE AS is_shared, FALSE AS is_deleted,
        FALSE AS public_access, FALSE AS is_frozen, FALSE AS can_assign_tasks, FALSE AS is_favorite,
        CAST(NULL AS BIGINT) AS creator_uid, CAST(NULL AS BIGINT) AS child_order, CAST(NULL AS TIMESTAMP) AS updated_at,
        TIMESTAMP '2024-01-01 00:00:00' AS created_at, CAST(NULL AS VARCHAR) AS parent_id, CAST(NULL AS VARCHAR) AS role,
        CAST(NULL AS VARCHAR) AS public_key, CAST(NULL AS VARCHAR) AS view_style, CAST(NULL AS VARCHAR) AS description
    FROM nation""")
def base_habit_projects(t: Tables):
    rows = base.base_habit_projects(t.raw_habit_projects)
    return rows.withColumns({c: F.to_timestamp_ntz(F.col(c).cast("string")) for c in ("created_at", "updated_at")})


@query("base_habit_archived", """SELECT '{"r_name":"' || r_name || '"}' AS json FROM region""")
def base_habit_archived(t: Tables):
    return base.base_habit_archived(t.read("region").select(F.to_json(F.struct("r_name")).alias("json")))


@query("to_local_datetime", """
    SELECT event_id, ts + INTERVAL 7 HOUR AS local_ts, ts - INTERVAL 5 HOUR AS new_york FROM events""")
def to_local_datetime(t: Tables):
    return t.read("events").select(
        "event_id", typing.to_local_datetime(utc("ts"), TZ).alias("local_ts"),
        typing.utc_to_local_datetime("ts", "America/New_York").alias("new_york"))


@query("clean_string_array", """
    SELECT o_orderkey, array_to_string(list_filter(coalesce(flags, []), lambda t: t <> 'N'), ',') AS tags,
        CAST(len(list_filter(coalesce(flags, []), lambda t: t <> 'N')) AS BIGINT) AS n
    FROM orders LEFT JOIN order_lines ON o_orderkey = l_orderkey""")
def clean_string_array(t: Tables):
    o = t.read("orders").join(t.order_lines, "o_orderkey", "left")
    clean = typing.clean_string_array(F.transform("flags", lambda x: F.when(x == "N", F.lit(" ")).otherwise(x)))
    return o.select("o_orderkey", F.concat_ws(",", clean).alias("tags"), F.size(clean).cast("bigint").alias("n"))


@query("parse_malformed_array", """
    SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag || ',' || l_linestatus AS plain,
        l_returnflag || '+ ' || l_linestatus AS quoted FROM lineitem""")
def parse_malformed_array(t: Tables):
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    plain = F.concat(F.lit("["), flag, F.lit(","), status, F.lit(",]"))
    quoted = F.concat(F.lit("['"), flag, F.lit("', '"), status, F.lit("']"))
    return t.read("lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.concat_ws(",", typing.parse_malformed_array(plain)).alias("plain"),
        F.concat_ws("+", typing.parse_malformed_array(quoted, quoted=True)).alias("quoted"))


@query("flag_from_int_or_json", """
    SELECT c_custkey, c_mktsegment = 'MACHINERY' AS closed FROM customer""")
def flag_from_int_or_json(t: Tables):
    p = t.raw_projects_v3
    return p.select(F.col("project_id").cast("bigint").alias("c_custkey"),
                    typing.flag_from_int_or_json("closed", json_scalar("raw_json", "closed")).alias("closed"))


@query("json_scalar", """
    SELECT event_id, CAST(json_extract_string(props, '$.k') AS VARCHAR) AS k, CAST(NULL AS VARCHAR) AS missing,
        CAST(NULL AS VARCHAR) AS nested, '[' || json_extract_string(props, '$.k') || ']' AS bracket FROM events""")
def json_scalar_query(t: Tables):
    e = t.read("events")
    k = F.get_json_object("props", "$.k")
    e = e.withColumn("doc", F.concat(F.lit('{"props":'), F.col("props"), F.lit(',"text":"['), k, F.lit(']"}')))
    return e.select("event_id", json_scalar("props", "k").alias("k"), json_scalar("props", "none").alias("missing"),
                    json_scalar("doc", "props").alias("nested"), json_scalar("doc", "text").alias("bracket"))


@query("json_string_array", """
    SELECT CAST(o_orderkey AS VARCHAR) AS task_id,
        array_to_string(list_filter(coalesce(flags, []), lambda t: t <> 'N'), ',') AS tags, '' AS missing
    FROM orders LEFT JOIN order_lines ON o_orderkey = l_orderkey""")
def json_string_array_query(t: Tables):
    return t.raw_tasks_v3.select(
        "task_id", F.concat_ws(",", json_string_array("raw_json", "tags")).alias("tags"),
        F.concat_ws(",", json_string_array("raw_json", "reminders")).alias("missing"))


@query("clean_content", r"""
    SELECT conv_id, turn, trim(regexp_replace(regexp_replace('@' || role || ' ' || text, '@[^ ]+', '', 'g'), '\s+', ' ', 'g'))
        AS cleaned_content FROM conversations""")
def clean_content(t: Tables):
    c = t.read("conversations")
    labelled = F.concat(F.lit("@"), F.col("role"), F.lit(" "), F.col("text"))
    return c.select("conv_id", "turn", text.clean_content(labelled).alias("cleaned_content"))


@query("streak_text", "SELECT id, streak FROM habit WHERE src = 'active_tasks'")
def streak_text(t: Tables):
    return t.raw_habit_active.select("id", text.streak_text("description").alias("streak"))


@query("streak_count", """
    SELECT id, CAST(regexp_extract(streak, '^\\d+') AS BIGINT) AS streak_count FROM habit WHERE streak IS NOT NULL
    UNION ALL SELECT id, NULL FROM habit WHERE streak IS NULL""".replace("\\\\", "\\"))
def streak_count(t: Tables):
    return t.habits.select("id", text.streak_count("streak").alias("streak_count"))


@query("folder_label_extract", """
    SELECT DISTINCT group_id AS folder_id, c_name AS folder_name FROM v1_base_projects
    JOIN customer ON sort_order = c_custkey WHERE c_mktsegment = 'FURNITURE'""")
def folder_label_extract(t: Tables):
    p = base.base_projects(t.raw_projects).filter(F.col("project_name").like(text.FOLDER_TITLE_LIKE))
    return p.select(F.col("group_id").alias("folder_id"), text.folder_label("project_name").alias("folder_name")).distinct()


@query("date_parts", f"""
    SELECT o_orderkey, CAST(o_orderdate AS DATE) AS due_date_day, {sunday("CAST(o_orderdate AS DATE)")} AS due_date_week,
        strftime(o_orderdate, '%A') AS due_date_day_of_week_name, CAST(month(o_orderdate) AS BIGINT) AS due_date_month_num,
        CAST(day(o_orderdate) AS BIGINT) AS due_date_day_of_month_num FROM orders""")
def date_parts(t: Tables):
    o = t.read("orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("due_date_day"))
    return o.select("*", *dates.due_day_parts())


@query("time_intervals", f"""
    SELECT event_id, ts AS "RAW", CAST(date_trunc('day', ts) AS TIMESTAMP) AS "DAY", date_trunc('hour', ts) AS "HOUR",
        date_trunc('minute', ts) AS "MINUTE", CAST({sunday("CAST(ts AS DATE)")} AS TIMESTAMP) AS "WEEK",
        CAST(date_trunc('month', ts) AS TIMESTAMP) AS "MONTH", CAST(date_trunc('quarter', ts) AS TIMESTAMP) AS "QUARTER",
        CAST(date_trunc('year', ts) AS TIMESTAMP) AS "YEAR", CAST(dayofweek(ts) + 1 AS BIGINT) AS "DAY_OF_WEEK_INDEX",
        strftime(ts, '%A') AS "DAY_OF_WEEK_NAME", CAST(day(ts) AS BIGINT) AS "DAY_OF_MONTH_NUM",
        CAST(strftime(ts, '%U') AS BIGINT) AS "WEEK_NUM", CAST(month(ts) AS BIGINT) AS "MONTH_NUM",
        CAST(quarter(ts) AS BIGINT) AS "QUARTER_NUM", CAST(year(ts) AS BIGINT) AS "YEAR_NUM" FROM events""")
def time_intervals(t: Tables):
    return t.read("events").select("event_id", *[dates.time_interval("ts", i).alias(i) for i in dates.TIME_INTERVALS])


@query("deep_links", """
    SELECT task_id, task_url_path, task_url_web, task_url_native, project_url_path, project_url_web, project_url_native,
        folder_url_path, folder_url_web, folder_url_native FROM semantic""")
def deep_links(t: Tables):
    kinds = [f"{g}_url_{k}" for g in ("task", "project", "folder") for k in ("path", "web", "native")]
    return t.semantic.select("task_id", *kinds)


@query("url_metadata", """
    SELECT task_id, '{"task":"ticktick.com/webapp/#p/' || project_id || '/tasks/' || task_id
            || '","project":"ticktick.com/webapp/#p/' || project_id || '/tasks","folder":"ticktick.com/webapp/#g/'
            || folder_id || '"}' AS url_metadata,
        'ticktick.com/webapp/#p/' || project_id || '/tasks' AS project_url,
        'ticktick.com/webapp/#g/' || folder_id AS parent_of_project_url FROM semantic""")
def url_metadata(t: Tables):
    return t.semantic.select(
        "task_id", links.url_metadata().alias("url_metadata"), links.grain_url("project").alias("project_url"),
        links.parent_grain_url("project").alias("parent_of_project_url"))


@query("stable_emoji_label", f"SELECT c_custkey, {label('c_name')} AS label FROM customer")
def stable_emoji_label(t: Tables):
    return t.read("customer").select("c_custkey", text.stable_label("c_name").alias("label"))


@query("surrogate_key", """
    SELECT c_custkey, md5(c_name || '-' || CASE WHEN c_acctbal >= 0 THEN CAST(c_nationkey AS VARCHAR)
        ELSE '_dbt_utils_surrogate_key_null_' END) AS surr_id FROM customer""")
def surrogate_key(t: Tables):
    c = t.read("customer")
    group = F.when(F.col("c_acctbal") >= 0, F.col("c_nationkey"))
    return c.select("c_custkey", text.surrogate_key("c_name", group).alias("surr_id"))


@query("concat_month_day", """
    SELECT o_orderkey, CAST(month(o_orderdate) AS VARCHAR) || '/' || CAST(day(o_orderdate) AS VARCHAR) AS month_day,
        strftime(o_orderdate, '%m/%d') AS date_mmdd FROM orders""")
def concat_month_day(t: Tables):
    d = F.col("o_orderdate")
    return t.read("orders").select("o_orderkey", text.slash_label(F.month(d), F.dayofmonth(d)).alias("month_day"),
                                   F.date_format(d, "MM/dd").alias("date_mmdd"))


# Business rules.

_A, _R, _NONE = "list_contains(tags, 'A')", "list_contains(tags, 'R')", "len(tags) = 0"


@query("gtd_work_type", f"""
    SELECT task_id, CAST(NULL AS VARCHAR) AS off_with_lists, CASE WHEN {_NONE} THEN '🥩' END AS off_without_lists,
        CASE WHEN {_A} THEN '🥩' WHEN {_NONE} THEN '🧃' END AS deep_only,
        CASE WHEN {_A} THEN '🥩' WHEN {_R} THEN '🧃' END AS both_lists,
        CASE WHEN {_NONE} THEN '🥩' WHEN {_R} THEN '🧃' END AS shallow_only FROM tasks""")
def gtd_work_type(t: Tables):
    return t.tasks.select(
        "task_id",
        rules.work_type("tags", ["A"], ["R"], False).alias("off_with_lists"),
        rules.work_type("tags", [], [], False).alias("off_without_lists"),
        rules.work_type("tags", ["A"], [], True).alias("deep_only"),
        rules.work_type("tags", ["A"], ["R"], True).alias("both_lists"),
        rules.work_type("tags", [], ["R"], True).alias("shallow_only"),
    )


@query("scope_bucket", "SELECT project_id, scope_bucket FROM catalog")
def scope_bucket(t: Tables):
    return marts.project_catalog(t.projects, t.folders, CFG).select("project_id", "scope_bucket")


@query("normalize_folder", "SELECT project_id, folder_id, folder_name FROM catalog")
def normalize_folder(t: Tables):
    return marts.project_catalog(t.projects, t.folders, CFG).select("project_id", "folder_id", "folder_name")


@query("inject_default_folders", "SELECT folder_id, folder_name FROM dim_folders")
def inject_default_folders(t: Tables):
    return shapes.inject_default_folders(t.folders)


@query("default_group", "SELECT project_id, coalesce(group_id, 'default') AS group_id FROM projects")
def default_group(t: Tables):
    return staging.default_group(t.projects).select("project_id", "group_id")


@query("drop_deleted", "SELECT task_id FROM v3_base WHERE deleted = 0")
def drop_deleted(t: Tables):
    return staging.drop_deleted(base.base_v3_tasks(t.raw_tasks_v3, TZ)).select("task_id")


@query("completed_only_times", "SELECT task_id, status, completed_time, updated_time FROM v3_tasks")
def completed_only_times(t: Tables):
    return marts.fct_tasks_v3(t.raw_tasks_v3, CFG).select("task_id", "status", "completed_time", "updated_time")


@query("legacy_inbox_backfill", """
    SELECT DISTINCT project_id, substr(project_id, 6) AS account_id, project_name, group_id FROM v1_base_projects
    WHERE project_id LIKE 'inbox%'""")
def legacy_inbox_backfill(t: Tables):
    known = base.base_v3_projects(t.raw_projects_v3, TZ)
    return staging.legacy_inbox_projects(t.raw_projects, known).select("project_id", "account_id", "project_name", "group_id")


@query("habit_status", "SELECT surr_id, scheduled_date, is_completed FROM habit")
def habit_status(t: Tables):
    return t.habits.select("surr_id", "scheduled_date", "is_completed")
