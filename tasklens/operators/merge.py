"""Change data: polls merged into the replica, checkpoints, statistics."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tasklens import schemas
from tasklens.operators.keyed import latest_by, lookup_join

UPSERT, DELETE = 0, 1
# Order of the changes of a task. Polls with one checkpoint follow each other by id.
ORDER = ("check_point", "poll_id", "phase", "position")
OP_COLUMNS = ("account_id", "task_id", *ORDER)


def task_ops(deltas: DataFrame) -> DataFrame:
    """One row per task change: account, task, checkpoint, poll, phase (updates before deletes of a poll), position, payload."""

    def tagged(items: str, phase: int) -> Column:
        return F.transform(
            items,
            lambda raw, i: F.struct(F.lit(phase).alias("phase"), i.cast("int").alias("position"), raw.alias("raw_json")),
        )

    changes = F.concat(tagged("updates", UPSERT), tagged("deletes", DELETE))
    rows = deltas.select("account_id", "check_point", "poll_id", F.explode(changes).alias("change"))
    rows = rows.select("account_id", "check_point", "poll_id", "change.*")
    own_id, alias_id = (F.nullif(F.get_json_object("raw_json", f"$.{k}"), F.lit("")) for k in ("id", "taskId"))
    key = F.when(F.col("phase") == DELETE, F.coalesce(alias_id, own_id)).otherwise(own_id)
    return rows.withColumn("task_id", key).filter("task_id is not null")


def latest_task_ops(ops: DataFrame) -> DataFrame:
    """The change that decides each task. Payloads stay text until here, so only the survivors are parsed."""
    return latest_by(ops, ["account_id", "task_id"], [F.desc(c) for c in ORDER])


def replica_rows(rows: DataFrame, entity: str, merged_at: dt.datetime | str | None = None) -> DataFrame:
    """Replica columns out of account, key and payload text. A key missing from the payload leaves NULL."""
    key = schemas.REPLICA_KEY[entity]
    fields = schemas.PAYLOAD[entity]
    text_types = {"string", "timestamp", "flag"}
    ddl = ", ".join(f"{name} {'string' if kind in text_types else kind}" for name, kind in fields.values())
    # Its own step, so that the text is parsed once per row and not once per column.
    parsed = rows.withColumn("_doc", F.from_json("raw_json", ddl))
    doc = F.col("_doc")

    def typed(name: str, kind: str) -> Column:
        value = doc[name]
        if kind == "timestamp":
            return value.try_cast("timestamp")
        if kind == "flag":  # sent as 0/1 or as true/false
            word = F.lower(value)
            return F.when(word == "true", F.lit(1)).when(word == "false", F.lit(0)).otherwise(value.try_cast("bigint"))
        return value

    columns = {column: typed(*source) for column, source in fields.items()}
    columns |= {
        key: F.col(key),
        "account_id": F.col("account_id"),
        "raw_json": F.col("raw_json"),
        "updated_at": F.lit(merged_at).cast("timestamp"),
    }
    return parsed.select(*[columns[f.name].cast(f.dataType).alias(f.name) for f in schemas.REPLICA[entity].fields])


def latest_lists(deltas: DataFrame, entity: str) -> DataFrame:
    """The newest list each account sent for an entity."""
    sent = deltas.filter(F.col(entity).isNotNull())
    return newest_lists(sent.select("account_id", "check_point", "poll_id", F.col(entity).alias("items")))


def newest_lists(lists: DataFrame) -> DataFrame:
    """The newest list per account, by checkpoint and poll."""
    return latest_by(lists, ["account_id"], [F.desc("check_point"), F.desc("poll_id")])


def list_rows(lists: DataFrame, entity: str) -> DataFrame:
    """Rows of the newest lists: account, key, checkpoint, payload. The last item wins when an id is repeated."""
    key = schemas.REPLICA_KEY[entity]
    items = lists.select("account_id", "check_point", F.posexplode("items").alias("position", "raw_json"))
    items = items.withColumn(key, F.nullif(F.get_json_object("raw_json", "$.id"), F.lit(""))).filter(f"{key} is not null")
    return latest_by(items, ["account_id", key], [F.desc("position")])


def merge_deltas(replica: DataFrame, deltas: DataFrame, entity: str,
                 merged_at: dt.datetime | str | None = None) -> DataFrame:
    """Replica after the polls. Tasks are upserted and deleted by key, projects and groups replaced per account."""
    if entity == "tasks":
        latest = latest_task_ops(task_ops(deltas))
        touched = latest.select("account_id", "task_id")
        incoming = latest.filter(F.col("phase") == UPSERT)
        kept = replica.join(touched, ["account_id", "task_id"], "left_anti")
    else:
        lists = latest_lists(deltas, entity)
        incoming = list_rows(lists, entity)
        # One row per account on the right: Spark broadcasts it when it is small; otherwise the join is by hash of the
        # account, and a hot account is divided by the replica key.
        kept = lookup_join(replica, lists.select("account_id"), "account_id", schemas.REPLICA_KEY[entity], "left_anti")
    return kept.unionByName(replica_rows(incoming, entity, merged_at))


def account_states(deltas: DataFrame) -> DataFrame:
    """Per account: newest checkpoint that changed state (0 when none did), and the newest poll's place and effect."""
    newest = F.struct("check_point", "poll_id", "state_changed")
    return deltas.groupBy("account_id").agg(
        F.coalesce(F.max(F.when(F.col("state_changed"), F.col("check_point"))), F.lit(0)).alias("checkpoint"),
        F.max(newest).alias("newest"))


def checkpoints(deltas: DataFrame) -> DataFrame:
    """Per account: newest checkpoint that changed state (0 when none did) and whether the last poll was idle."""
    return checkpoint_status(account_states(deltas))


def checkpoint_status(states: DataFrame) -> DataFrame:
    status = F.when(F.col("newest.state_changed"), F.lit("success")).otherwise(F.lit("idle"))
    return states.select("account_id", "checkpoint", status.alias("last_status"))


def batch_stats(deltas: DataFrame, replica: DataFrame | None = None) -> DataFrame:
    """One row per poll, idle ones included: updates, deletes that found a row, listed projects and groups (NULL when not
    sent).

    A delete finds a row when the task's previous change is an upsert, or when there is none and the replica had it.
    """
    ops = task_ops(deltas).select(*OP_COLUMNS)
    if replica is not None:
        before = replica.select("account_id", "task_id", F.lit(None).cast("bigint").alias("check_point"),
                                F.lit(None).cast("string").alias("poll_id"), F.lit(UPSERT).alias("phase"),
                                F.lit(-1).alias("position"))
        ops = ops.unionByName(before)
    return with_deletes(poll_counts(deltas), found_deletes(ops))


STATS_COLUMNS = ("account_id", "check_point", "updates_count", "deletes_count", "projects_count", "groups_count", "state_updated")


def poll_counts(deltas: DataFrame, *kept: Column) -> DataFrame:
    """Per poll: what can be counted from the poll alone, and the columns kept."""
    return deltas.select(
        "account_id", "check_point", "poll_id", F.size("updates").cast("bigint").alias("updates_count"),
        F.when(F.col("projects").isNotNull(), F.size("projects")).cast("bigint").alias("projects_count"),
        F.when(F.col("groups").isNotNull(), F.size("groups")).cast("bigint").alias("groups_count"),
        F.col("state_changed").alias("state_updated"), *kept,
    )


def with_deletes(polls: DataFrame, found: DataFrame, *kept: str) -> DataFrame:
    """Statistics of polls, and the columns kept. A poll's id is its key, so polls of one account and checkpoint stay apart
    and spread."""
    joined = polls.join(found, ["account_id", "poll_id"], "left")
    deletes = F.coalesce("deletes_count", F.lit(0).cast("bigint"))
    return joined.withColumn("deletes_count", deletes).select(*STATS_COLUMNS, "poll_id", *kept)


def found_deletes(ops: DataFrame, sign: str | None = None) -> DataFrame:
    """Per poll: how many of its deletes follow an upsert of their task: account_id, poll_id, deletes_count. With a column
    `sign` of 1 and -1, changes of either sign are looked at apart, and finds count with their sign."""
    task = ["account_id", "task_id", *([sign] if sign else [])]
    found = _previous_phase(ops, task).filter((F.col("phase") == DELETE) & (F.col("previous_phase") == UPSERT))
    return found.groupBy("account_id", "poll_id").agg((F.sum(sign) if sign else F.count("*")).alias("deletes_count"))


def _sliced(rows: DataFrame, points: DataFrame | None = None) -> DataFrame:
    """Add _slice: the range of checkpoints a row lies in. Ranges hold about equally many rows, one per shuffle partition,
    so the rows of one key within a range are never more than a task's share, whatever part of all rows the key has.
    Rows without a checkpoint come before all others. `points` are rows of about the same checkpoints, if some are at hand."""
    ranges = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cuts = (rows if points is None else points).agg(F.percentile_approx("check_point", [i / ranges for i in range(1, ranges)] or [0.5], 10_000)).first()[0]
    splits = [float("-inf"), *sorted({float(c) for c in cuts or ()}), float("inf")]
    placed = rows.withColumn("_point", F.col("check_point").cast("double"))
    if len(splits) > 2:
        placed = Bucketizer(splits=splits, inputCol="_point", outputCol="_slice", handleInvalid="keep").transform(placed)
    else:
        placed = placed.withColumn("_slice", F.lit(0.0))
    return placed.withColumn("_slice", F.when(F.col("check_point").isNull(), F.lit(-1.0)).otherwise(F.col("_slice"))).drop("_point")


def _previous_phase(ops: DataFrame, task: Sequence[str] = ("account_id", "task_id")) -> DataFrame:
    """The phase of the change before each change of a task, of those with account and task: within ranges of checkpoints,
    then over their edges."""
    inside = W.partitionBy(*task, "_slice").orderBy(*[F.asc_nulls_first(c) for c in ORDER])
    marked = _sliced(ops).dropna(subset=[*task, "_slice"]).withColumns({
        "previous_phase": F.lag("phase").over(inside), "_row": F.row_number().over(inside),
        "_last": F.lead("phase").over(inside).isNull()})
    # Before the first change of a range comes the last one of the task's range before. Both parts come out of one shuffle.
    across = W.partitionBy(*task).orderBy("_slice", "_row")
    edges = marked.filter("_row = 1 or _last").withColumn("previous_phase", F.lag("phase").over(across))
    return marked.filter("_row > 1").unionByName(edges.filter("_row = 1"))


def cycle_log(polls: DataFrame, points: DataFrame | None = None) -> DataFrame:
    """Polls with statistics and times as cycles: id, account_id, started_at, finished_at, status, source_checkpoint (of
    the last poll before it that changed state, 0 without one), response_checkpoint and the counts. `points` have about
    the checkpoints of the polls, and are cheaper to read: stored polls, before they are joined."""
    sliced = _sliced(polls, points)
    changed = F.when(F.col("state_updated"), F.col("check_point"))
    earlier = W.partitionBy("account_id", "_slice").orderBy("check_point", "poll_id").rowsBetween(W.unboundedPreceding, -1)
    marked = sliced.withColumn("_inside", F.max(changed).over(earlier))
    most = sliced.groupBy("account_id", "_slice").agg(F.max(changed).alias("_most"))
    across = W.partitionBy("account_id").orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    carried = most.select("account_id", "_slice", F.max("_most").over(across).alias("_carried"))
    joined = marked.join(carried, ["account_id", "_slice"])
    return joined.select(
        F.col("poll_id").alias("id"), "account_id", F.col("polled_at").alias("started_at"), "finished_at",
        F.lit("success").alias("status"),
        F.coalesce(F.greatest("_inside", "_carried"), F.lit(0).cast("bigint")).alias("source_checkpoint"),
        F.col("check_point").alias("response_checkpoint"), "updates_count", "deletes_count", "projects_count", "groups_count")


def cycle_history(cycles: DataFrame, account_id: str, limit: int = 50) -> DataFrame:
    """Newest cycles of one account, of equal start the last ones by checkpoint and id."""
    own = cycles.filter(F.col("account_id") == account_id)
    return own.orderBy(F.desc("started_at"), F.desc("response_checkpoint"), F.desc("id")).limit(limit)


def replica_counts(tasks: DataFrame, projects: DataFrame, groups: DataFrame) -> DataFrame:
    """Rows per account in each replica table, one column per table."""
    parts = {"tasks": tasks, "projects": projects, "groups": groups}
    rows = None
    for name, df in parts.items():
        part = df.select("account_id", F.lit(name).alias("entity"))
        rows = part if rows is None else rows.unionByName(part)
    return rows.groupBy("account_id").agg(
        *[F.count(F.when(F.col("entity") == name, 1)).alias(name) for name in parts]
    )


def purge(df: DataFrame, account_id: str) -> DataFrame:
    """All rows but those of one account."""
    return df.filter(~F.col("account_id").eqNullSafe(account_id))
