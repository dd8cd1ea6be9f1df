"""Sources, sinks and change data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tasklens import schemas
from tasklens.functions.typing import to_local_datetime
from tasklens.operators import history, merge
from tasklens.sources import add_inbox, drop_meta, read_deltas, read_jsonl, read_replica, slim, write_jsonl, write_replica
from tasklens.streaming import Store, current_replica, purge_account, start_merge, stream_cycles, stream_stats
from workload.registry import query
from workload.scratch import scratch_dir
from workload.tables import AS_OF_TS, Tables


@query("read_jsonl_source", """
    SELECT CAST(o_orderkey AS VARCHAR) AS id, o_orderpriority AS title, o_orderkey AS "sortOrder",
        o_orderstatus = 'P' AS "isAllDay", o_orderdate AS "dueDate", array_to_string(flags, ',') AS tags
    FROM orders LEFT JOIN order_lines ON o_orderkey = l_orderkey WHERE o_orderstatus <> 'F'""")
def read_jsonl_source(t: Tables):
    path = scratch_dir(t.spark)
    write_jsonl(t.raw_tasks, path)
    tasks = read_jsonl(t.spark, path, schemas.TASKS)
    tags = F.concat_ws(",", F.transform("tags", lambda x: F.when(x == " ", F.lit("N")).otherwise(x)))
    return tasks.select("id", "title", "sortOrder", "isAllDay", to_local_datetime("dueDate", "UTC").alias("dueDate"),
                        F.when(F.col("tags").isNotNull(), tags).alias("tags"))


@query("read_jsonl_declared", """
    SELECT 'tasks' AS origin, CAST(o_orderkey AS VARCHAR) AS id, o_orderpriority AS detail FROM orders WHERE o_orderstatus <> 'F'
    UNION ALL SELECT 'tasks_snapshot', concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey),
        concat('[', chr(39), l_returnflag, chr(39), ',', chr(39), 'b', chr(39), ']') FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    UNION ALL SELECT 'projects', CASE WHEN c_mktsegment = 'BUILDING' THEN 'inbox' ELSE '' END || CAST(c_custkey AS VARCHAR),
        CASE WHEN c_acctbal < 0 THEN '' ELSE CAST(c_nationkey AS VARCHAR) END FROM customer
    UNION ALL SELECT 'projects_snapshot', CAST(o_orderkey AS VARCHAR),
        CASE WHEN c_mktsegment = 'MACHINERY' THEN 'true' ELSE 'false' END FROM orders JOIN customer ON o_custkey = c_custkey
    UNION ALL SELECT 'active_tasks', CAST(user_id AS VARCHAR),
        'every day|' || strftime(max(ts), '%Y-%m-%dT%H:%M:%SZ') FROM events GROUP BY user_id
    UNION ALL SELECT 'completed_tasks', CAST(event_id AS VARCHAR), 'done @' || props || '|n1,n2'
        FROM events WHERE event_type = 'purchase'
    UNION ALL SELECT 'active_projects', CAST(n_nationkey AS VARCHAR), n_name || '|' || n_regionkey FROM nation
    UNION ALL SELECT 'archived_projects', CAST(n_nationkey AS VARCHAR), n_name FROM nation""")
def read_jsonl_declared(t: Tables):
    """All declared tables written as JSON lines and read back with their schemas, nested columns included."""
    root = scratch_dir(t.spark)
    text = F.concat_ws
    archived = F.to_json(F.struct(F.col("n_nationkey").cast("string").alias("id"), F.col("n_name").alias("name")))
    due = text("|", "due.string", "due.date")
    tables = {
        "tasks": (t.raw_tasks, schemas.TASKS, "id", F.col("title")),
        "tasks_snapshot": (t.raw_history, schemas.TASKS_SNAPSHOT, "dbt_scd_id", F.col("reminders")),
        "projects": (t.raw_projects, schemas.PROJECTS, "id", F.col("groupId")),
        "projects_snapshot": (t.raw_projects_history, schemas.PROJECTS_SNAPSHOT, "dbt_scd_id", F.col("closed").cast("string")),
        "active_tasks": (t.raw_habit_active, schemas.HABIT_ACTIVE, "id", due),
        "completed_tasks": (t.raw_habit_completed.withColumn("notes", F.array(F.lit("n1"), F.lit("n2"))),
                            schemas.HABIT_COMPLETED, "id", text("|", "content", text(",", "notes"))),
        "active_projects": (t.raw_habit_projects, schemas.HABIT_PROJECTS, "id", text("|", "name", "default_order")),
        "archived_projects": (t.read("nation").select(archived.alias("json")), schemas.HABIT_ARCHIVED,
                              F.get_json_object("json", "$.id"), F.get_json_object("json", "$.name")),
    }
    rows = None
    for name, (df, schema, key, detail) in tables.items():
        write_jsonl(df, f"{root}/{name}")
        key = F.col(key) if isinstance(key, str) else key
        part = read_jsonl(t.spark, f"{root}/{name}", schema).select(
            F.lit(name).alias("origin"), key.cast("string").alias("id"), detail.alias("detail"))
        rows = part if rows is None else rows.unionByName(part)
    return rows


@query("write_jsonl_sink", """
    SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name, CAST(NULL AS VARCHAR) AS color, c_custkey AS "sortOrder"
    FROM customer""")
def write_jsonl_sink(t: Tables):
    path = scratch_dir(t.spark)
    rows = t.read("customer").select(
        F.col("c_custkey").cast("string").alias("id"), F.col("c_name").alias("name"),
        F.lit(None).cast("string").alias("color"), F.col("c_custkey").alias("sortOrder"),
    )
    write_jsonl(rows, path)
    write_jsonl(rows, path)  # a full refresh replaces the rows
    return read_jsonl(t.spark, path, schemas.PROJECTS).select("id", "name", "color", "sortOrder")


_REPLICA_SQL = """
    SELECT 'acc' || substr(o_orderpriority, 1, 1) AS account_id, CAST(o_orderkey AS VARCHAR) AS task_id,
        o_orderpriority AS title, CAST(CASE WHEN o_orderstatus = 'F' THEN 2 ELSE 0 END AS BIGINT) AS status,
        CASE WHEN o_orderstatus <> 'P' THEN o_orderdate END AS due_date FROM orders"""


def _replica_columns(df):
    return df.select("account_id", "task_id", "title", "status", to_local_datetime("due_date", "UTC").alias("due_date"))


@query("read_replica_parquet", _REPLICA_SQL)
def read_replica_parquet(t: Tables):
    path = scratch_dir(t.spark)
    write_replica(t.raw_tasks_v3, path, "tasks")
    return _replica_columns(read_replica(t.spark, path, "tasks"))


@query("write_replica_parquet", _REPLICA_SQL)
def write_replica_parquet(t: Tables):
    path = scratch_dir(t.spark)
    write_replica(t.raw_tasks_v3, path, "tasks")
    write_replica(t.raw_tasks_v3, path, "tasks", account_id="acc1")  # one account again, the others stay
    return _replica_columns(read_replica(t.spark, path, "tasks"))


@query("drop_meta_columns", "SELECT n_nationkey, n_name, n_regionkey FROM nation")
def drop_meta_columns(t: Tables):
    n = t.read("nation").withColumns({"_airbyte_raw_id": F.lit("x"), "_airbyte_meta": F.lit("{}")})
    return drop_meta(n)


@query("shape_extract_tasks", "SELECT o_orderkey AS id, o_orderpriority AS title FROM orders")
def shape_extract_tasks(t: Tables):
    o = t.read("orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("title"),
                                F.lit("long").alias("content"), F.lit("d").alias("desc"), F.array().alias("items"))
    return slim(o)


@query("shape_extract_projects", """
    SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name, c_custkey AS "sortOrder",
        CASE WHEN c_acctbal >= 0 THEN CAST(c_nationkey AS VARCHAR) END AS "groupId", CAST(NULL AS VARCHAR) AS kind
    FROM customer WHERE c_mktsegment <> 'MACHINERY'
    UNION ALL SELECT min('inbox' || CAST(o_orderkey AS VARCHAR)), 'inbox', -1, '0', 'TASK' FROM orders""")
def shape_extract_projects(t: Tables):
    p = t.projects.select(
        F.col("project_id").alias("id"), F.col("project_name").alias("name"),
        F.col("project_id").cast("bigint").alias("sortOrder"), F.col("group_id").alias("groupId"), "closed",
    )
    inbox = t.read("orders").select(F.concat(F.lit("inbox"), F.col("o_orderkey").cast("string")).alias("projectId"))
    return add_inbox(p, inbox).select("id", "name", "sortOrder", "groupId", "kind")


@query("shape_habit_projects", "SELECT CAST(n_nationkey AS VARCHAR) AS id, n_name AS name FROM nation")
def shape_habit_projects(t: Tables):
    return slim(t.raw_habit_projects, ["access"]).select("id", "name")


# An archive has so many files at most, and small ones hold so many polls.
_POLL_FILES, _POLLS_A_FILE = 16, 2000


def _write_polls(t: Tables, polls: DataFrame | None = None) -> str:
    """Polls as JSON lines. Files grow with the archive, as every batch of a stream has a cost of its own."""
    path = scratch_dir(t.spark)
    polls = t.polls if polls is None else polls
    most = max(_POLLS_A_FILE, -(-polls.count() // _POLL_FILES))
    polls.coalesce(_POLL_FILES).write.option("maxRecordsPerFile", most).json(path)
    return path


@query("stream_delta_source", """
    SELECT check_point, CAST(CASE WHEN event_type IN ('click', 'view') THEN 1 ELSE 0 END AS BIGINT) AS updates,
        CAST(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS BIGINT) AS deletes, changed AS state_changed FROM polls""")
def stream_delta_source(t: Tables):
    """A stream of the polls, written to a table as it comes."""
    path = _write_polls(t)
    polls = read_deltas(t.spark, path, stream=True, files_per_trigger=2, lines=True)
    rows = polls.select("check_point", F.size("updates").cast("bigint").alias("updates"),
                        F.size("deletes").cast("bigint").alias("deletes"), "state_changed")
    writer = rows.writeStream.format("parquet").option("path", f"{path}-out").option("checkpointLocation", f"{path}-state")
    writer.trigger(availableNow=True).start().awaitTermination()
    return t.spark.read.parquet(f"{path}-out")


_MERGED_TASKS = """
    SELECT account_id, task_id, project_id, event_type AS title, k AS sort_order,
        CAST(CASE WHEN event_type = 'click' THEN 2 END AS BIGINT) AS status,
        '{"id":"' || task_id || '","projectId":"' || project_id || '","sortOrder":' || CAST(k AS VARCHAR) || ',"title":"'
            || event_type || '"' || CASE WHEN event_type = 'click' THEN ',"status":2' ELSE '' END || '}' AS raw_json
    FROM last_ops WHERE event_type <> 'error'
    UNION ALL SELECT account_id, task_id, NULL, NULL, NULL, NULL, '{}' FROM old_tasks o
    WHERE NOT EXISTS (SELECT 1 FROM last_ops l WHERE l.account_id = o.account_id AND l.task_id = o.task_id)"""
_TASK_COLUMNS = ["account_id", "task_id", "project_id", "title", "sort_order", "status", "raw_json"]


@query("delta_task_upsert", _MERGED_TASKS)
def delta_task_upsert(t: Tables):
    return merge.merge_deltas(t.replica("tasks"), t.deltas, "tasks").select(*_TASK_COLUMNS)


@query("delta_task_delete", """
    SELECT account_id, task_id, check_point FROM last_ops WHERE event_type = 'error'""")
def delta_task_delete(t: Tables):
    ops = merge.latest_task_ops(merge.task_ops(t.deltas))
    return ops.filter(F.col("phase") == merge.DELETE).select("account_id", "task_id", "check_point")


@query("delta_full_replace", """
    SELECT account_id, 'projects' AS entity, 'p' || CAST(k AS VARCHAR) AS id, 'purchase' AS name, k AS sort_order
    FROM (SELECT * FROM polls WHERE event_type = 'purchase'
          QUALIFY row_number() OVER (PARTITION BY account_id ORDER BY check_point DESC) = 1)
    UNION ALL SELECT DISTINCT account_id, 'projects', 'inbox', 'inbox', CAST(NULL AS BIGINT)
    FROM polls WHERE event_type = 'purchase'
    UNION ALL SELECT account_id, 'projects', 'old', NULL, NULL FROM users
    WHERE account_id NOT IN (SELECT account_id FROM polls WHERE event_type = 'purchase')
    UNION ALL SELECT account_id, 'groups', 'g', CAST(k AS VARCHAR), NULL
    FROM (SELECT * FROM polls WHERE event_type = 'purchase' AND k > 50
          QUALIFY row_number() OVER (PARTITION BY account_id ORDER BY check_point DESC) = 1)
    UNION ALL SELECT account_id, 'groups', 'old', NULL, NULL FROM users
    WHERE account_id NOT IN (SELECT account_id FROM polls WHERE event_type = 'purchase' AND k > 50)""")
def delta_full_replace(t: Tables):
    parts = []
    for entity in ("projects", "groups"):
        merged = merge.merge_deltas(t.replica(entity), t.deltas, entity)
        parts.append(merged.select("account_id", F.lit(entity).alias("entity"),
                                   F.col(schemas.REPLICA_KEY[entity]).alias("id"), "name", "sort_order"))
    return parts[0].unionByName(parts[1])


@query("delta_checkpoint", """
    SELECT account_id, coalesce(max(CASE WHEN changed THEN check_point END), 0) AS checkpoint,
        CASE WHEN arg_max(changed, check_point) THEN 'success' ELSE 'idle' END AS last_status FROM polls GROUP BY 1""")
def delta_checkpoint(t: Tables):
    return merge.checkpoints(t.deltas)


_STATS = """
    SELECT account_id, check_point, CAST(CASE WHEN event_type IN ('click', 'view') THEN 1 ELSE 0 END AS BIGINT)
            AS updates_count,
        CAST(CASE WHEN event_type = 'error' AND found THEN 1 ELSE 0 END AS BIGINT) AS deletes_count,
        CAST(CASE WHEN event_type = 'purchase' THEN 2 END AS BIGINT) AS projects_count,
        CAST(CASE WHEN event_type = 'purchase' AND k > 50 THEN 1 END AS BIGINT) AS groups_count, changed AS state_updated
    FROM polls LEFT JOIN (
        SELECT account_id AS a, check_point AS c,
            coalesce(lag(event_type) OVER (PARTITION BY account_id, task_id ORDER BY check_point) <> 'error',
                     task_id = 't0') AS found
        FROM ops) o ON account_id = a AND check_point = c"""


@query("delta_batch_stats", _STATS)
def delta_batch_stats(t: Tables):
    return merge.batch_stats(t.deltas, t.replica("tasks")).drop("poll_id")


# An idle poll answers with the checkpoint that the account has already.
_REPEATED = _STATS.replace("SELECT account_id, check_point,", """SELECT account_id, coalesce(max(CASE WHEN changed THEN check_point END)
        OVER (PARTITION BY account_id ORDER BY check_point), 0) AS check_point,""")


@query("delta_batch_stats_of_idle_polls", _REPEATED)
def delta_batch_stats_of_idle_polls(t: Tables):
    """Polls that share a checkpoint are a row each; read from files, they are told apart by file and line."""
    polls = read_deltas(t.spark, _write_polls(t, t.repeated_polls), lines=True)
    return merge.batch_stats(polls, t.replica("tasks")).drop("poll_id")


_CYCLES = f"""
    SELECT account_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS started_at, 'success' AS status,
        coalesce(max(CASE WHEN changed THEN check_point END) OVER (
            PARTITION BY account_id ORDER BY check_point ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS source_checkpoint,
        check_point AS response_checkpoint, updates_count, deletes_count, projects_count, groups_count
    FROM polls JOIN ({_STATS.replace("task_id = 't0'", "false")}) USING (account_id, check_point)"""


def _cycle_columns(cycles: DataFrame) -> DataFrame:
    return cycles.select(
        "account_id", F.date_format("started_at", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("started_at"), "status",
        "source_checkpoint", "response_checkpoint", "updates_count", "deletes_count", "projects_count", "groups_count")


@query("cycle_history_topn", f"""
    SELECT * FROM ({_CYCLES}) WHERE account_id = '8' ORDER BY started_at DESC, response_checkpoint DESC LIMIT 50""")
def cycle_history_topn(t: Tables):
    """The newest cycles of one account, out of the log that a stream wrote."""
    return _cycle_columns(merge.cycle_history(stream_cycles(t.spark, f"{_streamed(t)}/replica", ["8"]), "8"))


@query("cycle_log", _CYCLES)
def cycle_log(t: Tables):
    """All cycles of all accounts."""
    return _cycle_columns(stream_cycles(t.spark, f"{_streamed(t)}/replica"))


@query("replica_counts", """
    SELECT account_id, sum(CASE WHEN e = 't' THEN 1 ELSE 0 END)::BIGINT AS tasks,
        sum(CASE WHEN e = 'p' THEN 1 ELSE 0 END)::BIGINT AS projects,
        sum(CASE WHEN e = 'g' THEN 1 ELSE 0 END)::BIGINT AS groups
    FROM (SELECT 'acc' || substr(o_orderpriority, 1, 1) AS account_id, 't' AS e FROM orders
          UNION ALL SELECT 'acc1', 'p' FROM customer UNION ALL SELECT 'acc1', 'g' FROM nation) GROUP BY 1""")
def replica_counts(t: Tables):
    return merge.replica_counts(t.raw_tasks_v3, t.raw_projects_v3, t.raw_groups_v3)


@query("account_purge", """
    SELECT 'extract' AS origin, task_id, account_id FROM v3_base WHERE account_id <> 'acc2'
    UNION ALL SELECT 'stream', task_id, account_id FROM last_ops WHERE event_type <> 'error' AND account_id <> '8'
    UNION ALL SELECT 'emitted', task_id, account_id FROM last_ops WHERE event_type <> 'error' AND account_id <> '8'""")
def account_purge(t: Tables):
    """An account leaves a table, a stream's replica and its emitted snapshot."""
    root = _streamed(t, emit=True)
    purge_account(t.spark, f"{root}/replica", "8", f"{root}/emitted")
    Store(t.spark, f"{root}/replica").vacuum()
    streamed = current_replica(t.spark, f"{root}/replica", "tasks").select(F.lit("stream").alias("origin"), "task_id", "account_id")
    emitted = read_replica(t.spark, f"{root}/emitted", "tasks").select(F.lit("emitted").alias("origin"), "task_id", "account_id")
    extract = merge.purge(t.raw_tasks_v3, "acc2").select(F.lit("extract").alias("origin"), "task_id", "account_id")
    return extract.unionByName(streamed).unionByName(emitted)


@query("scd2_snapshot", """
    SELECT CAST(o_orderkey AS VARCHAR) AS task_id, o_orderstatus AS state, TIMESTAMP '1998-01-01 00:00:00' AS dbt_valid_from,
        CASE WHEN o_orderstatus <> 'P' THEN TIMESTAMP '1998-06-15 09:30:00' END AS dbt_valid_to,
        md5(CAST(o_orderkey AS VARCHAR) || '|1998-01-01 00:00:00') AS dbt_scd_id
    FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01'
    UNION ALL SELECT CAST(o_orderkey AS VARCHAR), CASE WHEN o_orderstatus = 'O' THEN 'changed' ELSE o_orderstatus END,
        TIMESTAMP '1998-06-15 09:30:00', NULL, md5(CAST(o_orderkey AS VARCHAR) || '|1998-06-15 09:30:00')
    FROM orders WHERE o_orderstatus <> 'F' AND (o_orderstatus <> 'P' OR o_orderdate >= TIMESTAMP '1998-01-01')""")
def scd2_snapshot(t: Tables):
    """Two extracts: orders before 1998, then all orders but done ones, which are gone, with status O changed."""
    o = t.read("orders")
    row = [F.col("o_orderkey").cast("string").alias("task_id")]
    first = o.filter("o_orderdate < timestamp'1998-01-01'").select(*row, F.col("o_orderstatus").alias("state"))
    status = F.col("o_orderstatus")
    state = F.when(status == "O", F.lit("changed")).otherwise(status)
    second = o.filter("o_orderstatus <> 'F'").select(*row, state.alias("state"))
    versions = history.snapshot(None, first, "task_id", "1998-01-01 00:00:00")
    versions = history.snapshot(versions, second, "task_id", "1998-06-15 09:30:00")
    return versions.select("task_id", "state", "dbt_valid_from", "dbt_valid_to", "dbt_scd_id")


@query("dedupe_latest_version", """
    SELECT task_id, dbt_scd_id, dbt_updated_at, dbt_valid_to FROM v1_latest""")
def dedupe_latest_version(t: Tables):
    from tasklens.plans.base import base_tasks_snapshot
    from workload.tables import CFG

    versions = history.latest_version(base_tasks_snapshot(t.raw_history, CFG.timezone), "task_id")
    return versions.select("task_id", "dbt_scd_id", "dbt_updated_at", "dbt_valid_to")


@query("infer_completion_tasks", """
    SELECT task_id, title, completed_time, updated_time, status, array_to_string(tags, ',') AS tags FROM v1_inferred""")
def infer_completion_tasks(t: Tables):
    from tasklens.plans.base import base_tasks, base_tasks_snapshot
    from workload.tables import CFG

    rows = history.infer_completion(base_tasks(t.raw_tasks, CFG.timezone), base_tasks_snapshot(t.raw_history, CFG.timezone))
    return rows.select("task_id", "title", "completed_time", "updated_time", "status",
                       F.concat_ws(",", "tags").alias("tags"))


@query("infer_completion_projects", """
    SELECT project_id, project_name, group_id, completed_time, closed FROM v1_inferred_projects""")
def infer_completion_projects(t: Tables):
    from tasklens.plans.base import base_projects, base_projects_snapshot
    from workload.tables import CFG

    rows = history.infer_project_completion(
        base_projects(t.raw_projects), base_projects_snapshot(t.raw_projects_history, CFG.timezone))
    return rows.select("project_id", "project_name", "group_id", "completed_time", "closed")


@query("infer_created_time", "SELECT task_id, min(dbt_valid_from) AS created_time FROM v1_history GROUP BY 1")
def infer_created_time(t: Tables):
    from tasklens.plans.base import base_tasks_snapshot
    from workload.tables import CFG

    return history.created_time(base_tasks_snapshot(t.raw_history, CFG.timezone), "task_id")


@query("next_load_banner", """
    SELECT task_id, title, updated_time, status FROM v1_banner
    UNION ALL SELECT task_id, o_orderpriority, _completed_time, 0 FROM v1_open, orders
    WHERE task_id = '0' AND o_orderkey = 0""")
def next_load_banner(t: Tables):
    from tasklens.plans.base import base_tasks
    from workload.tables import CFG

    base = base_tasks(t.raw_tasks, CFG.timezone)
    with_interval = history.next_load_banner(base, AS_OF_TS, 15)
    without = history.next_load_banner(base, AS_OF_TS, None)
    return with_interval.unionByName(without).select("task_id", "title", "updated_time", "status")


def _streamed(t: Tables, emit: bool = False, of: DataFrame | None = None) -> str:
    """Merge a stream of polls, two files at a time, and return its folder."""
    root = scratch_dir(t.spark)
    polls = _write_polls(t, of)
    start_merge(t.spark, polls, f"{root}/replica", f"{root}/checkpoint", files_per_trigger=2, lines=True,
                emit_dir=f"{root}/emitted" if emit else None).awaitTermination()
    return root


@query("stream_replica_merge", """
    SELECT account_id, task_id, project_id, event_type AS title, k AS sort_order,
        CAST(CASE WHEN event_type = 'click' THEN 2 END AS BIGINT) AS status FROM last_ops WHERE event_type <> 'error'""")
def stream_replica_merge(t: Tables):
    return current_replica(t.spark, f"{_streamed(t)}/replica", "tasks").select(*_TASK_COLUMNS[:-1])


@query("stream_emit_on_change", """
    SELECT 'tasks' AS entity, account_id, task_id AS id, event_type AS name FROM last_ops WHERE event_type <> 'error'
    UNION ALL SELECT 'projects', account_id, 'p' || CAST(k AS VARCHAR), 'purchase'
    FROM (SELECT * FROM polls WHERE event_type = 'purchase'
          QUALIFY row_number() OVER (PARTITION BY account_id ORDER BY check_point DESC) = 1)
    UNION ALL SELECT DISTINCT 'projects', account_id, 'inbox', 'inbox' FROM polls WHERE event_type = 'purchase'
    UNION ALL SELECT 'groups', account_id, 'g', CAST(k AS VARCHAR)
    FROM (SELECT * FROM polls WHERE event_type = 'purchase' AND k > 50
          QUALIFY row_number() OVER (PARTITION BY account_id ORDER BY check_point DESC) = 1)""")
def stream_emit_on_change(t: Tables):
    root, parts = _streamed(t, emit=True), []
    for entity, name in (("tasks", "title"), ("projects", "name"), ("groups", "name")):
        emitted = read_replica(t.spark, f"{root}/emitted", entity)
        parts.append(emitted.select(F.lit(entity).alias("entity"), "account_id",
                                    F.col(schemas.REPLICA_KEY[entity]).alias("id"), F.col(name).alias("name")))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("stream_batch_stats", _STATS.replace("task_id = 't0'", "false"))
def stream_batch_stats(t: Tables):
    """All columns, over a stream that starts without a replica."""
    return stream_stats(t.spark, f"{_streamed(t)}/replica").drop("poll_id")


@query("stream_batch_stats_of_idle_polls", _REPEATED.replace("task_id = 't0'", "false"))
def stream_batch_stats_of_idle_polls(t: Tables):
    """Polls that share a checkpoint, in a stream."""
    return stream_stats(t.spark, f"{_streamed(t, of=t.repeated_polls)}/replica").drop("poll_id")
