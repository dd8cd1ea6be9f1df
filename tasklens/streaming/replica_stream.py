"""Replica kept up to date by a stream of change payloads.

A micro-batch writes what it adds to every table as new folders, and then one version file that names them (see
sources/commits.py). Until then readers see the version before, all tables of it; a batch that dies half-way leaves folders that
no version names, and its repetition writes its own.

Tables are kept in levels. The newest state per key (`task_changes`, the lists, `accounts`) is a folded folder per bucket
of accounts and a few newer ones; after `FANOUT` of those a bucket is folded again. Logs (`task_ops`, `polls`, `found`)
only grow, and equally old folders are joined to larger ones. So a batch reads the state of the accounts it touches, and
what it reads and writes doesn't grow with the number of batches before it.

Order is by checkpoint and poll, not by arrival: a late file loses against newer changes, deletions included, because
deletions are stored as well. A file that comes again changes nothing, as a poll is known by its file and line.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import Future, ThreadPoolExecutor
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.util import inheritable_thread_target

from tasklens import schemas
from tasklens.operators.keyed import latest_by, lookup_join
from tasklens.operators.merge import (
    OP_COLUMNS,
    ORDER,
    UPSERT,
    account_states,
    checkpoint_status,
    cycle_log,
    found_deletes,
    latest_lists,
    latest_task_ops,
    list_rows,
    newest_lists,
    poll_counts,
    purge,
    replica_rows,
    task_ops,
    with_deletes,
)
from tasklens.sources import drop_account, number_polls, read_deltas, write_replica
from tasklens.sources.commits import Part, Store, Version, bucket_of

LIST_ENTITIES = ("projects", "groups")
# The table that has the state of an entity.
STATE = {"tasks": "task_changes", **{entity: f"{entity}_lists" for entity in LIST_ENTITIES}}
_OPS = "account_id string, task_id string, check_point bigint, poll_id string, phase int, position int"
_LIST = "account_id string, check_point bigint, poll_id string, items array<string>"
TABLES = {
    "task_changes": f"{_OPS}, raw_json string",
    "projects_lists": _LIST,
    "groups_lists": _LIST,
    "accounts": "account_id string, checkpoint bigint, newest struct<check_point bigint, poll_id string, state_changed boolean>",
    "task_ops": _OPS,
    "polls": "account_id string, check_point bigint, poll_id string, updates_count bigint, projects_count bigint, "
             "groups_count bigint, state_updated boolean, polled_at timestamp, finished_at timestamp",
    "found": "account_id string, poll_id string, deletes_count bigint",
}


def _newest_states(states: DataFrame) -> DataFrame:
    return states.groupBy("account_id").agg(F.max("checkpoint").alias("checkpoint"), F.max("newest").alias("newest"))


# What is left of the rows of a table when folders are folded; tables without an entry keep all.
FOLDS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "task_changes": latest_task_ops, "projects_lists": newest_lists, "groups_lists": newest_lists, "accounts": _newest_states,
}
FANOUT = 8
BUCKET_BYTES = 256 << 20


def start_merge(spark: SparkSession, in_dir: str, replica_dir: str, checkpoint_dir: str,
                trigger: str = "availableNow", files_per_trigger: int | None = None,
                emit_dir: str | None = None, lines: bool = False,
                clock: Callable[[], dt.datetime] = lambda: dt.datetime.now(dt.UTC)) -> StreamingQuery:
    """Merge payload files into the replica; `lines` is as in read_deltas. With emit_dir, accounts whose state changed
    are also written there as a Parquet snapshot. trigger is 'availableNow' or a processing interval such as
    '30 seconds'; `clock` tells when a batch was merged, for the cycle log."""
    polls = read_deltas(spark, in_dir, stream=True, files_per_trigger=files_per_trigger, lines=lines)

    def merge(batch: DataFrame, batch_id: int) -> None:
        batch.persist()  # parsed once for all parts and the emit
        try:
            store, numbered = Store(batch.sparkSession, replica_dir), number_polls(batch)
            if emit_dir:
                merge_and_emit(store, numbered, clock(), batch, emit_dir)
            else:
                merge_batch(store, numbered, clock())
        finally:
            batch.unpersist()

    writer = polls.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint_dir)
    if trigger == "availableNow":
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=trigger).start()


def merge_and_emit(store: Store, polls: DataFrame, merged_at: dt.datetime, batch: DataFrame, emit_dir: str) -> Version:
    """Merge a batch and emit what it changed. The files of an entity are written when its table is, beside the tables that
    take longer, and count when the version is there."""
    there: Future[Version] = Future()
    emits: list[Future[None]] = []
    entities = {table: entity for entity, table in STATE.items()}
    with ThreadPoolExecutor(len(STATE)) as pool:

        def wrote(table: str, version: Version) -> None:
            if table in entities:
                emit = partial(emit_changed, batch, store.root, emit_dir, version, [entities[table]], there.result)
                emits.append(pool.submit(inheritable_thread_target(store.spark)(emit)))

        try:
            there.set_result(merge_batch(store, polls, merged_at, wrote=wrote))
        except BaseException as error:
            there.set_exception(error)  # nothing is emitted
            raise
    for emit in emits:
        emit.result()
    return there.result()


def merge_batch(store: Store, polls: DataFrame, merged_at: dt.datetime, fanout: int = FANOUT,
                bucket_bytes: int = BUCKET_BYTES, wrote: Callable[[str, Version], None] = lambda table, version: None) -> Version:
    """Everything a batch of numbered polls adds, as one new version. `wrote` is told of every table as soon as it is
    written, with a version to come that has its new rows."""
    version = store.latest()

    def written(table: str, made: Callable[[], DataFrame]) -> list[Part]:
        parts = store.write(made(), table, version.buckets)
        wrote(table, version.swapped((), parts))
        return parts

    held: list[DataFrame] = []

    def kept(df: DataFrame) -> DataFrame:
        held.append(df.persist())
        return held[-1]

    try:
        polls = kept(_not_purged(polls, version.purged))
        ops = task_ops(polls)
        keys = kept(ops.select(*OP_COLUMNS))
        # A number per bucket. This also fills what is held, before all tables ask for it.
        buckets = {r[0] for r in keys.select(bucket_of(version.buckets)).distinct().collect()}
        times = F.col("polled_at"), F.lit(merged_at).cast("timestamp").alias("finished_at")
        rows: dict[str, Callable[[], DataFrame]] = {
            "found": lambda: _found_changes(store, version, keys, buckets, kept),
            "task_changes": lambda: latest_task_ops(ops),
            "polls": lambda: poll_counts(polls.filter("account_id is not null"), *times),
            "task_ops": lambda: keys,
            **{f"{entity}_lists": partial(latest_lists, polls, entity) for entity in LIST_ENTITIES},
            "accounts": lambda: account_states(polls),
        }
        new = _side_by_side(store.spark, [partial(written, table, made) for table, made in rows.items()])
    finally:
        for df in reversed(held):
            df.unpersist()
    merged = _folded(store, version.swapped((), (part for parts in new for part in parts)), fanout)
    return store.commit(_with_buckets(store, merged, bucket_bytes))


def _side_by_side[T](spark: SparkSession, steps: Sequence[Callable[[], T]]) -> list[T]:
    """Results of steps that don't need each other. Their jobs run at the same time: each has many short stages, which
    leave most cores idle. All have ended when this returns or raises."""
    with ThreadPoolExecutor(max(1, len(steps))) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(step)) for step in steps]
    return [step.result() for step in running]


def _not_purged(polls: DataFrame, purged: dict[str, int]) -> DataFrame:
    """Polls but those that a purge has covered. One row per account ever purged, as a version lists them."""
    if not purged:
        return polls
    gone = polls.sparkSession.createDataFrame(list(purged.items()), "account_id string, purged_to bigint")
    kept = polls.join(F.broadcast(gone), "account_id", "left")
    return kept.filter(F.col("purged_to").isNull() | (F.col("check_point") > F.col("purged_to"))).drop("purged_to")


def _found_changes(store: Store, version: Version, ops: DataFrame, buckets: set[int], kept: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """What the changes add to the deletes that found a row, per poll. `kept` holds rows until the batch is merged.

    A task whose changes all come after its stored ones needs its last stored change only. Late changes can make or undo
    finds of polls before, so the history of such tasks is counted again, and the difference is kept.
    """
    task = ["account_id", "task_id"]
    first = ops.groupBy(*task).agg(F.min(F.struct(*ORDER)).alias("first"))
    stored = store.read(version.of("task_changes", buckets), TABLES["task_changes"]).select(*OP_COLUMNS)
    touched = kept(latest_task_ops(stored.join(first, task)))
    late = touched.filter(F.col("first") <= F.struct(*ORDER)).select(*task)
    last = touched.drop("first")
    if late.isEmpty():
        return found_deletes(ops.unionByName(last))
    history = store.read(version.of("task_ops", buckets), TABLES["task_ops"]).join(late, task, "left_semi")
    again = history.withColumn("sign", F.explode(F.array(F.lit(-1), F.lit(1)))).unionByName(
        ops.join(late, task, "left_semi").withColumn("sign", F.lit(1))).distinct()
    in_order = ops.unionByName(last).join(late, task, "left_anti").withColumn("sign", F.lit(1))
    return found_deletes(in_order.unionByName(again), "sign").filter("deletes_count <> 0")


def _fold(store: Store, version: Version, parts: list[Part], buckets: int, level: int) -> list[Part]:
    """The rows of parts of one table as new parts."""
    table = parts[0].table
    rows = store.read(parts, TABLES[table])
    return store.write(FOLDS.get(table, lambda df: df)(rows), table, buckets, level)


def _folded(store: Store, version: Version, fanout: int) -> Version:
    """Buckets with `fanout` newer folders of a state are folded to one; as many folders of a log of one level are joined."""
    tables = _side_by_side(store.spark, [partial(_table_folded, store, version, table, fanout) for table in TABLES])
    return version.swapped(version.parts, (part for parts in tables for part in parts))


def _table_folded(store: Store, version: Version, table: str, fanout: int) -> list[Part]:
    """The parts of one table after that."""
    for level in range(1 + max((p.level for p in version.of(table)), default=0)):
        by_bucket: dict[int, list[Part]] = {}
        for part in version.of(table):
            if part.level == level:
                by_bucket.setdefault(part.bucket, []).append(part)
        full = {b for b, parts in by_bucket.items() if len(parts) >= fanout}
        if not full or (table in FOLDS and level):
            continue
        old = [p for p in version.of(table, full) if table in FOLDS or p.level == level]
        version = version.swapped(old, _fold(store, version, old, version.buckets, level + 1))
    return version.of(table)


def _with_buckets(store: Store, version: Version, bucket_bytes: int) -> Version:
    """Twice as many buckets as often as the state has outgrown them; all rows then move once."""
    wanted = version.buckets
    while wanted * bucket_bytes < sum(p.size for p in version.of("task_changes")):
        wanted *= 2
    if wanted == version.buckets:
        return version
    for table in TABLES:
        if old := version.of(table):
            version = version.swapped(old, _fold(store, version, old, wanted, 1))
    return Version(version.number, wanted, version.parts, version.purged)


def emit_changed(batch: DataFrame, replica_dir: str, emit_dir: str, version: Version | None = None,
                 entities: Iterable[str] = tuple(STATE), after: Callable[[], object] = lambda: None) -> None:
    """Snapshot of the accounts whose state the batch changed; an idle batch writes nothing. What is there is not replaced
    before `after` has returned."""
    spark = batch.sparkSession
    accounts = batch.filter("state_changed").select("account_id").distinct().persist()

    def emit(entity: str) -> None:
        changed = current_replica(spark, replica_dir, entity, accounts=accounts, version=version)
        write_replica(changed, emit_dir, entity, accounts=accounts, shared=True, after=after)

    try:
        if not accounts.isEmpty():
            _side_by_side(spark, [partial(emit, entity) for entity in entities])
    finally:
        accounts.unpersist()


def current_replica(spark: SparkSession, replica_dir: str, entity: str, merged_at: dt.datetime | str | None = None,
                    accounts: DataFrame | None = None, version: Version | None = None) -> DataFrame:
    """Rows of one entity as of a version, the newest if none is named; with `accounts`, only their buckets are read."""
    rows = _read(spark, replica_dir, STATE[entity], version, accounts)
    if entity == "tasks":
        rows = latest_task_ops(rows).filter(F.col("phase") == UPSERT)
    else:
        rows = list_rows(newest_lists(rows), entity)
    return replica_rows(rows, entity, merged_at)


def _read(spark: SparkSession, replica_dir: str, table: str, version: Version | None = None,
          accounts: DataFrame | None = None) -> DataFrame:
    store = Store(spark, replica_dir)
    version = version or store.latest()
    if accounts is None:
        return store.read(version.of(table), TABLES[table])
    buckets = [r[0] for r in accounts.select(bucket_of(version.buckets)).distinct().collect()]  # a number per bucket
    spread = "task_id" if table == "task_changes" else "check_point"
    rows = store.read(version.of(table, buckets), TABLES[table])
    return lookup_join(rows, accounts.select("account_id").distinct(), "account_id", spread, "left_semi")


def _polls(spark: SparkSession, replica_dir: str, version: Version | None, accounts: DataFrame | None = None) -> DataFrame:
    """Every poll once, as it was first merged, with its counts."""
    polls = _read(spark, replica_dir, "polls", version, accounts)
    polls = latest_by(polls, ["account_id", "poll_id"], [F.asc("finished_at")])
    found = _read(spark, replica_dir, "found", version, accounts)
    found = found.groupBy("account_id", "poll_id").agg(F.sum("deletes_count").alias("deletes_count"))
    return with_deletes(polls, found, "polled_at", "finished_at")


def stream_stats(spark: SparkSession, replica_dir: str, version: Version | None = None) -> DataFrame:
    """Statistics of every poll, as they were counted batch by batch."""
    return _polls(spark, replica_dir, version).drop("polled_at", "finished_at")


def stream_cycles(spark: SparkSession, replica_dir: str, accounts: Iterable[str] | None = None,
                  version: Version | None = None) -> DataFrame:
    """The cycle log; with `accounts`, theirs alone, out of their buckets."""
    named = None if accounts is None else spark.createDataFrame([(a,) for a in accounts], "account_id string")
    version = version or Store(spark, replica_dir).latest()
    return cycle_log(_polls(spark, replica_dir, version, named), _read(spark, replica_dir, "polls", version, named))


def stream_checkpoints(spark: SparkSession, replica_dir: str, version: Version | None = None) -> DataFrame:
    """Newest checkpoint that changed state, per account, and the status of the last poll."""
    return checkpoint_status(_newest_states(_read(spark, replica_dir, "accounts", version)))


def compact(spark: SparkSession, replica_dir: str) -> Version:
    """Fold every bucket that has several folders. Older versions keep theirs until Store.vacuum."""
    store = Store(spark, replica_dir)
    version = store.latest()
    for table in TABLES:
        parts = version.of(table)
        several = {p.bucket for p in parts if sum(q.bucket == p.bucket for q in parts) > 1}
        if old := version.of(table, several):
            version = version.swapped(old, _fold(store, version, old, version.buckets, max(p.level for p in old) + (table not in FOLDS) or 1))
    return store.commit(version)


def purge_account(spark: SparkSession, replica_dir: str, account_id: str, emit_dir: str | None = None) -> Version:
    """Remove an account from every table, and from the emitted snapshot.

    Only the bucket of the account is written anew; the folders of other buckets stay. The version notes the account's
    last checkpoint, and polls up to it are ignored when they come again. Store.vacuum then deletes the old folders.
    """
    store = Store(spark, replica_dir)
    version = store.latest()
    own = spark.createDataFrame([(account_id,)], "account_id string")
    bucket = own.select(bucket_of(version.buckets)).first()[0]
    known = store.read(version.of("accounts", [bucket]), TABLES["accounts"]).filter(F.col("account_id") == account_id)
    last = known.agg(F.max("newest.check_point")).first()[0]
    if last is None:
        return version
    old = {table: parts for table in TABLES if (parts := version.of(table, [bucket]))}

    def left(table: str) -> list[Part]:
        rows = purge(store.read(old[table], TABLES[table]), account_id)
        level = max(p.level for p in old[table]) or 1
        return store.write(FOLDS.get(table, lambda df: df)(rows), table, version.buckets, level)

    new = _side_by_side(spark, [partial(left, table) for table in old])
    version = version.swapped((p for parts in old.values() for p in parts), (p for parts in new for p in parts))
    purged = version.purged | {account_id: max(last, version.purged.get(account_id, last))}
    version = store.commit(Version(version.number, version.buckets, version.parts, purged))
    if emit_dir:
        _side_by_side(spark, [partial(drop_account, spark, emit_dir, entity, account_id) for entity in schemas.REPLICA_KEY])
    return version
