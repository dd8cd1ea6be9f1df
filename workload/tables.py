"""The shared test tables in the shapes the library reads.

orders are tasks, customers projects, nations folders, line item flags tags, events changes and habits. Every view covers
its whole table.
"""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tasklens.config import Settings
from tasklens.functions.rules import work_type
from tasklens.plans import base, marts, staging
from tasklens.sources import delta_columns

AS_OF = dt.date(1998, 6, 15)
AS_OF_TS = dt.datetime(1998, 6, 15, 9, 30)
HABIT_DAY = dt.date(2024, 1, 30)
CFG = Settings(timezone="Asia/Ho_Chi_Minh", categorise=True, deep_tags=("A",), scope_word="7")


def utc(c: Column | str) -> Column:
    """Instant of a wall-clock column that holds UTC, as all times of the test tables do, in any session zone."""
    wall = F.col(c) if isinstance(c, str) else c
    moved = F.convert_timezone(F.lit("UTC"), F.current_timezone(), wall)
    return F.when(F.current_timezone() == "UTC", wall.cast("timestamp")).otherwise(moved.cast("timestamp"))


class Tables:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.dir = sf_dir

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    # Tasks, projects and folders as staged tables.

    @cached_property
    def order_lines(self) -> DataFrame:
        """Last shipping time and flags of each order."""
        return self.read("lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
            F.max("l_shipdate").alias("ship"), F.sort_array(F.collect_set("l_returnflag")).alias("flags")
        )

    @cached_property
    def tasks(self) -> DataFrame:
        done, ship = F.col("o_orderstatus") == "F", F.col("ship")
        tags = F.filter(F.coalesce("flags", F.array().cast("array<string>")), lambda t: t != "N")
        return self.read("orders").join(self.order_lines, "o_orderkey", "left").select(
            F.col("o_orderkey").cast("string").alias("task_id"),
            F.col("o_custkey").cast("string").alias("project_id"),
            F.col("o_orderpriority").alias("title"),
            F.col("o_orderdate").alias("due_date"),
            F.when(done, F.lit(2)).otherwise(F.lit(0)).cast("bigint").alias("status"),
            F.substring("o_orderpriority", 1, 1).cast("bigint").alias("priority"),
            F.when(F.col("o_orderpriority") == "5-LOW", F.lit("NOTE")).otherwise(F.lit("TASK")).alias("kind"),
            F.when(done, ship).alias("completed_time"),
            F.when(done, ship + F.expr("interval 1 hour")).alias("updated_time"),
            tags.alias("tags"),
            work_type(tags, CFG.deep_tags, CFG.shallow_tags, CFG.categorise).alias("gtd_work_type"),
        )

    @cached_property
    def projects(self) -> DataFrame:
        c = self.read("customer")
        return c.select(
            F.col("c_custkey").cast("string").alias("project_id"),
            F.col("c_name").alias("project_name"),
            F.when(F.col("c_acctbal") >= 0, F.col("c_nationkey").cast("string")).alias("group_id"),
            (F.col("c_mktsegment") == "MACHINERY").alias("closed"),
        )

    @cached_property
    def folders(self) -> DataFrame:
        n = self.read("nation")
        return n.select(F.col("n_nationkey").cast("string").alias("folder_id"), F.col("n_name").alias("folder_name"))

    @cached_property
    def dim_projects(self) -> DataFrame:
        """Projects with default group and last pulse."""
        return staging.join_pulse(staging.default_group(self.projects), self.tasks)

    @cached_property
    def dim_folders(self) -> DataFrame:
        from tasklens.operators.shapes import inject_default_folders

        return inject_default_folders(self.folders)

    @cached_property
    def tags(self) -> DataFrame:
        return marts.dim_tags(self.tasks)

    @cached_property
    def bridge(self) -> DataFrame:
        return marts.fct_task_tags_bridge(self.tasks)

    @cached_property
    def spine(self) -> DataFrame:
        return marts.dim_date_spine(self.spark, AS_OF)

    @cached_property
    def semantic(self) -> DataFrame:
        return marts.semantic_base(self.tasks, self.projects, self.folders, CFG)

    @cached_property
    def rollup(self) -> DataFrame:
        return marts.grain_rollup(self.semantic)

    @cached_property
    def catalog(self) -> DataFrame:
        return marts.project_catalog(self.projects, self.folders, CFG)

    @cached_property
    def workload(self) -> DataFrame:
        return marts.due_workload_daily(self.tasks, self.projects, self.folders, AS_OF, CFG)

    # First-generation raw tables.

    @cached_property
    def raw_tasks(self) -> DataFrame:
        """Open tasks as extracted: blanks for missing text, 'N' flags as blank tags."""
        o = self.read("orders").filter("o_orderstatus <> 'F'").join(self.order_lines, "o_orderkey", "left")
        return o.select(
            *self._raw_task_columns(),
            F.transform("flags", lambda t: F.when(t == "N", F.lit(" ")).otherwise(t)).alias("tags"),
            F.when(F.col("o_orderstatus") == "P", F.array(F.lit(""), F.col("o_custkey").cast("string"))).alias("childIds"),
            F.array(F.lit("TRIGGER:PT0S")).alias("reminders"),
        )

    def _raw_task_columns(self) -> list[Column]:
        return [
            F.col("o_orderkey").cast("string").alias("id"),
            F.col("o_custkey").cast("string").alias("projectId"),
            F.lit("").alias("parentId"),
            F.col("o_orderpriority").alias("title"),
            F.lit("UTC").alias("timeZone"),
            F.when(F.col("o_orderstatus") == "O", F.lit("")).otherwise(F.col("o_orderstatus")).alias("columnId"),
            F.concat(F.lit("e"), F.col("o_orderkey").cast("string")).alias("etag"),
            F.lit("TEXT").alias("kind"),
            F.lit("").alias("repeatFlag"),
            F.col("o_orderkey").alias("sortOrder"),
            F.substring("o_orderpriority", 1, 1).cast("bigint").alias("priority"),
            F.lit(0).cast("bigint").alias("status"),
            (F.col("o_orderstatus") == "P").alias("isAllDay"),
            utc(F.col("o_orderdate") - F.expr("interval 1 day")).alias("startDate"),
            utc("o_orderdate").alias("dueDate"),
            utc("ship").alias("completedTime"),
        ]

    @cached_property
    def raw_history(self) -> DataFrame:
        """A task version per line item; versions of lines with status F have ended."""
        lines = self.read("lineitem").withColumnRenamed("l_orderkey", "o_orderkey").withColumn("ship", F.col("l_shipdate"))
        rows = lines.join(self.read("orders"), "o_orderkey")
        since = utc("l_shipdate")
        ended = F.concat((F.col("l_shipdate") + F.expr("interval 1 day")).cast("string"), F.lit("Z"))
        version = F.concat_ws("-", "o_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
        return rows.select(
            *self._raw_task_columns(),
            F.concat(F.lit("["), F.col("l_returnflag"), F.lit(","), F.col("l_linestatus"), F.lit("]")).alias("tags"),
            F.lit("[]").alias("childIds"),
            F.concat(F.lit("['"), F.col("l_returnflag"), F.lit("','b']")).alias("reminders"),
            version.alias("dbt_scd_id"),
            since.alias("dbt_updated_at"),
            since.alias("dbt_valid_from"),
            F.when(F.col("l_linestatus") == "F", ended).alias("dbt_valid_to"),
        )

    @cached_property
    def raw_projects(self) -> DataFrame:
        return self.read("customer").select(*self._raw_project_columns())

    def _raw_project_columns(self) -> list[Column]:
        key, segment = F.col("c_custkey").cast("string"), F.col("c_mktsegment")
        folder_title = F.concat(F.lit("folder_map - '"), F.col("c_name"), F.lit("'"))
        return [
            F.when(segment == "BUILDING", F.concat(F.lit("inbox"), key)).otherwise(key).alias("id"),
            F.when(segment == "FURNITURE", folder_title).otherwise(F.col("c_name")).alias("name"),
            F.when(F.col("c_acctbal") < 0, F.lit("")).otherwise(F.col("c_nationkey").cast("string")).alias("groupId"),
            F.lit("TASK").alias("kind"), F.lit("").alias("color"), F.lit("list").alias("viewMode"),
            F.lit("write").alias("permission"), F.col("c_custkey").alias("sortOrder"),
            (segment == "MACHINERY").alias("closed"),
        ]

    @cached_property
    def raw_projects_history(self) -> DataFrame:
        """A project version per order; versions of orders with status F have ended."""
        rows = self.read("orders").join(self.read("customer"), F.col("o_custkey") == F.col("c_custkey"))
        since = utc("o_orderdate")
        ended = F.concat((F.col("o_orderdate") + F.expr("interval 30 days")).cast("string"), F.lit("Z"))
        return rows.select(
            *self._raw_project_columns(),
            F.col("o_orderkey").cast("string").alias("dbt_scd_id"),
            since.alias("dbt_updated_at"), since.alias("dbt_valid_from"),
            F.when(F.col("o_orderstatus") == "F", ended).alias("dbt_valid_to"),
        )

    @cached_property
    def tasks_v1(self) -> DataFrame:
        return marts.fct_tasks(self.raw_tasks, self.raw_history, AS_OF_TS, CFG)

    @cached_property
    def projects_v1(self) -> DataFrame:
        return marts.dim_projects(self.raw_projects, self.raw_projects_history, self.tasks_v1, CFG)

    # Replica tables: some typed columns are NULL and only the payload text has the value.

    @cached_property
    def raw_tasks_v3(self) -> DataFrame:
        o = self.read("orders").join(self.order_lines, "o_orderkey", "left")
        status, prio = F.col("o_orderstatus"), F.col("o_orderpriority")
        payload = F.to_json(F.struct(
            F.col("o_orderkey").alias("sortOrder"), F.lit("UTC").alias("timeZone"),
            (status == "O").alias("isAllDay"),
            F.substring(prio, 1, 1).cast("bigint").alias("priority"),
            F.when(prio == "1-URGENT", F.struct(F.lit(1).alias("nested"))).alias("reminder"),
            F.date_format(F.col("o_orderdate"), "yyyy-MM-dd'T'HH:mm:ss'.000+0000'").alias("dueDate"),
            F.transform("flags", lambda t: F.when(t == "N", F.lit(" ")).otherwise(t)).alias("tags"),
            (F.col("o_custkey") % 100).alias("progress"),
            F.date_format(F.col("o_orderdate"), "yyyy-MM-dd'T'06:00:00'Z'").alias("startDate"),
            F.when(status == "P", F.date_format(F.col("o_orderdate"), "yyyy-MM-dd'T'12:00:00'.000+0000'")).alias("repeatFirstDate"),
            F.when(status == "P", F.lit("RRULE:FREQ=DAILY")).otherwise(F.lit("")).alias("repeatFlag"),
            F.col("o_custkey").cast("string").alias("parentId"),
            F.array(F.col("o_orderkey").cast("string"), F.lit(" "), F.lit("c")).alias("childIds"),
        ))
        none = F.lit(None)
        ship = utc("ship")
        return o.select(
            F.col("o_orderkey").cast("string").alias("task_id"),
            F.concat(F.lit("acc"), F.substring("o_orderpriority", 1, 1)).alias("account_id"),
            F.col("o_custkey").cast("string").alias("project_id"),
            F.when(status != "O", F.col("o_orderkey")).alias("sort_order"),
            prio.alias("title"), F.lit("").alias("content"),
            F.when(status == "F", F.lit("Asia/Tokyo")).otherwise(F.lit("")).alias("timezone"),
            none.cast("boolean").alias("is_floating"),
            F.when(status == "F", F.lit(True)).alias("is_all_day"),
            none.cast("string").alias("reminder"),
            F.when(prio != "5-LOW", F.lit(9).cast("bigint")).alias("priority"),
            F.when(status == "F", F.lit(2)).otherwise(F.lit(0)).cast("bigint").alias("status"),
            F.when(prio == "4-NOT SPECIFIED", F.lit(1)).when(prio != "5-LOW", F.lit(0)).cast("bigint").alias("deleted"),
            F.when(status == "F", F.lit(100)).cast("bigint").alias("progress"),
            F.when(status == "O", utc("o_orderdate")).alias("start_date"),
            F.when(status != "P", utc("o_orderdate")).alias("due_date"),
            F.lit("").alias("repeat_flag"), none.cast("timestamp").alias("repeat_first_date"),
            ship.alias("completed_time"), F.when(status == "F", F.lit("u1")).alias("completed_user_id"),
            F.col("o_custkey").alias("creator"), F.when(status == "F", F.lit("p")).otherwise(F.lit("")).alias("parent_id"),
            utc("o_orderdate").alias("created_time"),
            (ship + F.expr("interval 1 hour")).alias("modified_time"),
            F.lit("TEXT").alias("kind"), F.lit("").alias("column_id"), F.lit("e").alias("etag"),
            payload.alias("raw_json"), utc("o_orderdate").alias("updated_at"),
        )

    @cached_property
    def raw_projects_v3(self) -> DataFrame:
        c = self.read("customer")
        machinery, in_debt = F.col("c_mktsegment") == "MACHINERY", F.col("c_acctbal") < 0
        return c.select(
            F.col("c_custkey").cast("string").alias("project_id"), F.lit("acc1").alias("account_id"),
            F.col("c_name").alias("name"),
            F.when(in_debt, F.lit("")).otherwise(F.col("c_nationkey").cast("string")).alias("group_id"),
            F.when(~in_debt, machinery.cast("bigint")).alias("closed"),
            F.lit(None).cast("bigint").alias("sort_order"),
            F.lit("TASK").alias("kind"), F.lit("list").alias("view_mode"),
            F.lit("2024-01-01 00:00:00Z").cast("timestamp").alias("modified_time"), F.lit("e").alias("etag"),
            F.to_json(F.struct(F.col("c_custkey").alias("sortOrder"), F.col("c_mktsegment").alias("color"),
                               F.lit("").alias("permission"), machinery.alias("closed"))).alias("raw_json"),
            F.lit(None).cast("timestamp").alias("updated_at"),
        )

    @cached_property
    def raw_groups_v3(self) -> DataFrame:
        n = self.read("nation")
        region = F.col("n_regionkey")
        return n.select(
            F.col("n_nationkey").cast("string").alias("group_id"), F.lit("acc1").alias("account_id"),
            F.col("n_name").alias("name"),
            F.when(region == 1, F.lit(1)).when(region == 2, F.lit(0)).cast("bigint").alias("deleted"),
            F.col("n_nationkey").cast("bigint").alias("sort_order"), F.lit("").alias("sort_type"),
            F.lit("e").alias("etag"),
            F.when(region == 3, F.to_json(F.struct((F.col("n_nationkey") > 10).alias("deleted"),
                                                   F.lit("kanban").alias("viewMode")))).alias("raw_json"),
            F.lit(None).cast("timestamp").alias("updated_at"),
        )

    # Change payloads: one poll per event.

    @cached_property
    def polls(self) -> DataFrame:
        """Events as polls: errors delete a task, clicks and views upsert one, purchases list projects, sign-ups idle."""
        e = self.read("events")
        kind, task = F.col("event_type"), F.concat(F.lit("t"), (F.col("event_id") % 7).cast("string"))
        k = F.get_json_object("props", "$.k").cast("bigint")
        update = F.to_json(F.struct(
            task.alias("id"), F.col("user_id").cast("string").alias("projectId"), k.alias("sortOrder"),
            kind.alias("title"), F.when(kind == "click", F.lit(2)).cast("bigint").alias("status"),
        ))
        project = F.to_json(F.struct(F.concat(F.lit("p"), k.cast("string")).alias("id"), kind.alias("name"),
                                     k.alias("sortOrder")))
        inbox = F.lit('{"id":"inbox","name":"inbox","closed":false}')
        nothing = F.array().cast("array<string>")
        bean = F.struct(
            F.when(kind.isin("click", "view"), F.array(update)).otherwise(nothing).alias("update"),
            F.when(kind == "error", F.array(F.to_json(F.struct(task.alias("taskId"))))).otherwise(nothing).alias("delete"),
            nothing.alias("add"),
            kind.isin("signup", "purchase").alias("empty"),
        )
        return e.select(
            F.col("user_id").cast("string").alias("account_id"), F.col("event_id").alias("checkPoint"),
            F.lpad(F.col("event_id").cast("string"), 12, "0").alias("poll_id"),
            F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("polledAt"),
            bean.alias("syncTaskBean"),
            F.when(kind == "purchase", F.array(project, inbox)).alias("projectProfiles"),
            F.when((kind == "purchase") & (k > 50), F.array(F.to_json(F.struct(F.lit("g").alias("id"), k.alias("name")))))
            .alias("projectGroups"),
        )

    @cached_property
    def repeated_polls(self) -> DataFrame:
        """Polls as a client makes them: an idle poll answers with the checkpoint that the account has already."""
        idle = F.col("syncTaskBean.empty") & F.col("projectProfiles").isNull()
        line = Window.partitionBy("account_id").orderBy("poll_id")
        held = F.last(F.when(~idle, F.col("checkPoint")), ignorenulls=True).over(line)
        return self.polls.withColumn("checkPoint", F.coalesce(held, F.lit(0).cast("bigint")))

    @cached_property
    def deltas(self) -> DataFrame:
        return delta_columns(self.polls)

    def replica(self, entity: str) -> DataFrame:
        """A replica before the polls: a task t0 and t9, a project and a group of every event user."""
        from tasklens import schemas

        users = self.read("events").select(F.col("user_id").cast("string").alias("account_id")).distinct()
        ids = {"tasks": ["t0", "t9"], "projects": ["old"], "groups": ["old"]}[entity]
        key = schemas.REPLICA_KEY[entity]
        rows = users.withColumn(key, F.explode(F.array(*[F.lit(i) for i in ids])))
        rows = rows.withColumn("raw_json", F.lit("{}"))
        return rows.select(*[
            (F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schemas.REPLICA[entity].fields
        ])

    # Habits.

    @cached_property
    def raw_habit_active(self) -> DataFrame:
        """An open habit per event user."""
        users = self.read("events").groupBy("user_id").agg(F.count("*").alias("n"), F.max("ts").alias("last"))
        none = F.lit(None)
        text = ["section_id", "parent_id", "assigned_by_uid", "responsible_uid", "deadline", "duration", "completed_at"]
        due = F.struct(
            F.lit(True).alias("is_recurring"), F.lit("en").alias("lang"), none.cast("string").alias("timezone"),
            F.lit("every day").alias("string"),
            F.date_format("last", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("date"),
        )
        described = F.concat(F.lit("**Current streak:** "), F.col("n").cast("string"), F.lit(" days"))
        return users.select(
            F.col("user_id").cast("string").alias("id"), (F.col("user_id") % 30).cast("string").alias("project_id"),
            *[none.cast("string").alias(c) for c in text],
            F.concat(F.lit("  habit   @daily of "), F.col("user_id").cast("string")).alias("content"),
            F.when(F.col("n") > 60, described).otherwise(F.lit("plain")).alias("description"),
            "user_id", F.col("user_id").alias("added_by_uid"), F.col("n").alias("priority"),
            F.lit(0).cast("bigint").alias("note_count"), F.lit(1).cast("bigint").alias("day_order"),
            F.lit(1).cast("bigint").alias("child_order"), F.lit(False).alias("checked"),
            F.lit(False).alias("is_collapsed"), F.lit(False).alias("is_deleted"),
            F.lit("2024-01-01 00:00:00Z").cast("timestamp").alias("added_at"),
            F.lit("2024-01-01 00:00:00Z").cast("timestamp").alias("updated_at"),
            F.array(F.lit("daily")).alias("labels"), due.alias("due"),
        )

    @cached_property
    def raw_habit_completed(self) -> DataFrame:
        """A completion per purchase."""
        e = self.read("events").filter("event_type = 'purchase'")
        none = F.lit(None)
        return e.select(
            F.col("event_id").alias("id"), "user_id", F.lit(0).cast("bigint").alias("note_count"),
            F.col("user_id").cast("string").alias("task_id"), (F.col("user_id") % 30).cast("string").alias("project_id"),
            none.cast("string").alias("section_id"), F.concat(F.lit("done @"), F.col("props")).alias("content"),
            none.cast("string").alias("meta_data"), none.cast("string").alias("item_object"),
            utc(F.date_trunc("second", "ts").cast("timestamp_ntz")).alias("completed_at"),
            F.array().cast("array<string>").alias("notes"),
        )

    @cached_property
    def raw_habit_projects(self) -> DataFrame:
        n = self.read("nation")
        none, no = F.lit(None), F.lit(False)
        made = {
            "id": F.col("n_nationkey").cast("string"), "name": F.col("n_name"),
            "default_order": F.col("n_regionkey").cast("bigint"), "color": F.lit("red"),
            "created_at": F.lit("2024-01-01 00:00:00Z").cast("timestamp"),
        }
        kinds = {"creator_uid": "bigint", "child_order": "bigint", "updated_at": "timestamp"}
        flags = {"is_collapsed", "inbox_project", "is_shared", "is_deleted", "public_access", "is_archived", "is_frozen",
                 "can_assign_tasks", "is_favorite"}
        return n.select(F.lit("x").alias("access"), *[
            made.get(c, no if c in flags else none.cast(kinds.get(c, "string"))).alias(c)
            for c in base.HABIT_PROJECT_COLUMNS
        ])

    @cached_property
    def habits(self) -> DataFrame:
        return marts.fct_habit(
            base.base_habit_active(self.raw_habit_active, "UTC"), base.base_habit_completed(self.raw_habit_completed, "UTC")
        )

    @cached_property
    def habit_projects(self) -> DataFrame:
        return marts.dim_project_habit(self.raw_habit_projects)

    @cached_property
    def habit_tasks(self) -> DataFrame:
        """Repeating tasks: every event is an occurrence, purchases are completions. Rules differ by user."""
        e = self.read("events")
        rule = (
            F.when(F.col("user_id") < 50, F.lit("RRULE:FREQ=DAILY;INTERVAL=1"))
            .when(F.col("user_id") < 100, F.lit("RRULE:FREQ=DAILY;INTERVAL=2"))
            .otherwise(F.lit("RRULE:FREQ=WEEKLY;INTERVAL=1;BYDAY=MO,WE,SU"))
        )
        done = F.col("event_type") == "purchase"
        when = F.date_trunc("second", "ts").cast("timestamp_ntz")
        return e.select(
            F.col("user_id").cast("string").alias("task_id"), F.col("event_type").alias("title"),
            F.array(F.lit(" habit "), F.col("event_type")).alias("tags"), rule.alias("repeat_flag"),
            when.alias("start_date"), when.alias("due_date"),
            F.when(done, F.lit(2)).otherwise(F.lit(0)).cast("bigint").alias("status"),
            F.when(done, when).alias("completed_time"),
        )
