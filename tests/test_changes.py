import datetime as dt
import json
import random
import threading

import pytest
from pyspark.sql import functions as F

from tasklens import schemas
from tasklens.operators import history, merge
from tasklens.sources import drop_account, read_deltas, read_jsonl, read_replica, write_jsonl, write_replica
from tasklens.sources.snapshots import shared_store, write_shared
from tasklens.streaming import Store, compact, current_replica, purge_account, start_merge, stream_cycles, stream_stats
from tasklens.streaming.commits import VersionTaken
from tasklens.streaming import replica_stream
from tasklens.streaming.replica_stream import TABLES, emit_changed, merge_and_emit, merge_batch, stream_checkpoints
from workload import source_queries
from workload.tables import Tables


def poll(checkpoint, update=(), delete=(), empty=False, bean=True, projects=None, groups=None):
    body = {"update": list(update), "delete": list(delete), "add": [{"id": "ignored"}], "empty": empty}
    return {"checkPoint": checkpoint, "syncTaskBean": body if bean else None, "projectProfiles": projects,
            "projectGroups": groups}


POLLS = [
    ("a", poll(1, [{"id": "1", "title": "one", "status": 0, "tags": ["x"]}, {"id": "2", "title": "two"}],
               projects=[{"id": "p1", "name": "P", "closed": False}, {"id": "p2", "name": "Q"}],
               groups=[{"id": "g", "name": "G", "deleted": 0}])),
    ("a", poll(2, [{"id": "1", "title": "first"}, {"id": "3", "title": "three"}], [{"taskId": "3"}, {"id": "9"}])),
    ("a", poll(3, empty=True)),
    ("a", poll(4, [{"id": "2", "title": "zwei"}, {"id": "2", "title": "due"}], projects=[])),
    ("b", poll(1, [{"id": "1", "title": "other", "sortOrder": 5}], groups=[])),
    ("a", poll(4, bean=False)),
    ("a", poll(4, empty=True)),
    ("a", poll(5, bean=False)),
    ("b", poll(2, [], [{"taskId": "1"}, {"taskId": "1"}], projects=[{"id": "p1", "name": "B"}, {"id": "p1", "name": "B2"}])),
]


def archive(path, polls, first=0):
    path.mkdir(parents=True, exist_ok=True)
    for second, (account, body) in enumerate(polls, start=first):
        name = f"{account}__cp_{body['checkPoint']}__20240101T0000{second:02d}Z.json"
        (path / name).write_text(json.dumps(body, ensure_ascii=False, indent=1), encoding="utf-8")


def replay(polls):
    """Plain-Python account of what the polls mean, in checkpoint order."""
    tasks, projects, groups, checkpoint = {}, {}, {}, {}
    for account, p in sorted(polls, key=lambda x: x[1]["checkPoint"]):
        bean = p["syncTaskBean"]
        live = bean is not None and not bean["empty"]
        if live:
            for item in bean["update"]:
                tasks[account, item["id"]] = item.get("title")
            for item in bean["delete"]:
                tasks.pop((account, item.get("taskId") or item.get("id")), None)
        for kept, key in ((projects, "projectProfiles"), (groups, "projectGroups")):
            if p[key] is not None:
                for k in [k for k in kept if k[0] == account]:
                    del kept[k]
                kept.update({(account, i["id"]): i["name"] for i in p[key]})
        if live or p["projectProfiles"] is not None or p["projectGroups"] is not None:
            checkpoint[account] = p["checkPoint"]
    return tasks, projects, groups, checkpoint


def as_dict(df, key, value):
    return {(r["account_id"], r[key]): r[value] for r in df.collect()}


def empty(spark, entity):
    return spark.createDataFrame([], schemas.REPLICA[entity])


def test_batch_merge(spark, tmp_path):
    archive(tmp_path / "in", POLLS)
    deltas = read_deltas(spark, str(tmp_path / "in"))
    tasks, projects, groups, checkpoint = replay(POLLS)
    merged = merge.merge_deltas(empty(spark, "tasks"), deltas, "tasks")
    assert as_dict(merged, "task_id", "title") == tasks
    row = merged.filter("account_id = 'a' and task_id = '1'").first()
    assert row["status"] is None  # a later payload replaces every column
    assert json.loads(row["raw_json"]) == {"id": "1", "title": "first"}
    assert as_dict(merge.merge_deltas(empty(spark, "projects"), deltas, "projects"), "project_id", "name") == projects
    assert as_dict(merge.merge_deltas(empty(spark, "groups"), deltas, "groups"), "group_id", "name") == groups
    states = {r["account_id"]: (r["checkpoint"], r["last_status"]) for r in merge.checkpoints(deltas).collect()}
    assert states == {"a": (checkpoint["a"], "idle"), "b": (checkpoint["b"], "success")}


def test_account_names_survive_file_names(spark, tmp_path):
    accounts = ["a b", "c+d", "e%41", "é", "x__cp_1__y"]
    archive(tmp_path / "in", [(a, poll(5)) for a in accounts])
    got = read_deltas(spark, str(tmp_path / "in")).select("account_id").collect()
    assert sorted(r[0] for r in got) == sorted(accounts)


def test_json_lines_archive(spark, tmp_path):
    (tmp_path / "lines.json").write_text("\n".join(json.dumps(p | {"account_id": a}) for a, p in POLLS))
    deltas = read_deltas(spark, str(tmp_path), lines=True)
    merged = merge.merge_deltas(empty(spark, "tasks"), deltas, "tasks")
    assert as_dict(merged, "task_id", "title") == replay(POLLS)[0]


def test_hot_account(spark, tmp_path):
    """One account sends most polls; few slices and no broadcast give the same answer."""
    rng = random.Random(7)
    polls = []
    for checkpoint in range(1, 301):
        account = "hot" if rng.random() < 0.8 else f"a{rng.randrange(3)}"
        item = {"id": str(rng.randrange(4)), "title": str(checkpoint)}
        polls.append((account, poll(checkpoint, [item], [{"taskId": str(rng.randrange(4))}] if rng.random() < 0.4 else [])))
    (tmp_path / "lines.json").write_text("\n".join(json.dumps(p | {"account_id": a}) for a, p in polls))
    deltas = read_deltas(spark, str(tmp_path), lines=True)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        merged = as_dict(merge.merge_deltas(empty(spark, "tasks"), deltas, "tasks"), "task_id", "title")
        deleted = merge.batch_stats(deltas).agg({"deletes_count": "sum"}).first()[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    live, removed = {}, 0
    for account, p in polls:
        for item in p["syncTaskBean"]["update"]:
            live[account, item["id"]] = item["title"]
        for item in p["syncTaskBean"]["delete"]:
            removed += live.pop((account, item["taskId"]), None) is not None
    assert merged == live
    assert deleted == removed


def test_null_list_keeps_rows_and_empty_list_clears_them(spark, tmp_path):
    archive(tmp_path / "in", [("a", poll(7, projects=[], groups=None))])
    deltas = read_deltas(spark, str(tmp_path / "in"))
    old = [("p", "a", "x", "{}"), ("p", "b", "y", "{}")]
    projects = spark.createDataFrame(old, "project_id string, account_id string, name string, raw_json string")
    projects = projects.select(*[
        (projects[f.name] if f.name in projects.columns else merge.F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schemas.PROJECTS_V3.fields])
    assert as_dict(merge.merge_deltas(projects, deltas, "projects"), "project_id", "name") == {("b", "p"): "y"}
    groups = merge.merge_deltas(empty(spark, "groups"), deltas, "groups")
    assert groups.count() == 0


def stats_of(polls):
    """Plain-Python statistics, in the order of checkpoints and then of the archive."""
    tasks, out = set(), []
    for account, p in sorted(polls, key=lambda x: x[1]["checkPoint"]):
        bean = p["syncTaskBean"]
        live = bean is not None and not bean["empty"]
        updates, deletes = (bean["update"], bean["delete"]) if live else ([], [])
        tasks |= {(account, i["id"]) for i in updates}
        found = 0
        for item in deletes:
            key = account, item.get("taskId") or item.get("id")
            found += key in tasks
            tasks.discard(key)
        sizes = [None if p[k] is None else len(p[k]) for k in ("projectProfiles", "projectGroups")]
        changed = live or any(n is not None for n in sizes)
        out.append((account, p["checkPoint"], len(updates), found, *sizes, changed))
    return sorted(out, key=str)


def rows_of(stats):
    return sorted(map(tuple, stats.drop("poll_id").collect()), key=str)


@pytest.mark.parametrize("partitions", ["1", "3", "50"])
def test_statistics_have_a_row_for_every_poll(spark, tmp_path, partitions):
    archive(tmp_path / "in", POLLS)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        assert rows_of(merge.batch_stats(read_deltas(spark, str(tmp_path / "in")))) == stats_of(POLLS)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_polls_are_known_by_file_and_line(spark, tmp_path):
    lines = [json.dumps(p | {"account_id": a}) for a, p in POLLS * 40]
    (tmp_path / "a.json").write_text("\n".join(lines))
    (tmp_path / "b.json").write_text("\n".join(lines[:7]) + "\n\n" + lines[7])
    ids = {}
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("1000", "128m"):  # many splits of a file, and none
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            polls = read_deltas(spark, str(tmp_path), lines=True)
            ids[size] = {(r.poll_id, r.account_id, r.check_point) for r in polls.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    want = {(f"a.json#{i:012d}", a, p["checkPoint"]) for i, (a, p) in enumerate(POLLS * 40)}
    want |= {(f"b.json#{i:012d}", a, p["checkPoint"]) for i, (a, p) in enumerate(POLLS[:8])}
    assert ids["1000"] == ids["128m"] == want


def test_a_hot_task_is_spread(spark):
    """A third of all changes are of one task: no range of checkpoints has more of them than a task's share."""
    rows = spark.range(30_000).selectExpr(
        "'a' as account_id", "if(id % 3 = 0, 'hot', cast(id as string)) as task_id", "id * id as check_point",
        "lpad(id, 9, '0') as poll_id", "cast(id % 2 as int) as phase", "0 as position")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    largest = merge._sliced(rows).groupBy("task_id", "_slice").count().agg({"count": "max"}).first()[0]
    assert largest <= 1.1 * 30_000 / 3 / parts
    assert merge.found_deletes(rows).agg({"deletes_count": "sum"}).first()[0] == 5_000


@pytest.mark.parametrize("mode", ["at_once", "one_by_one", "shuffled"])
def test_stream_equals_batch(spark, one_task, tmp_path, mode):
    folders = [str(tmp_path / d) for d in ("in", "replica", "checkpoint", "emit")]
    numbered = list(enumerate(POLLS))

    def run(checkpoint=folders[2]):
        start_merge(spark, folders[0], folders[1], checkpoint, emit_dir=folders[3], files_per_trigger=3).awaitTermination()

    if mode == "at_once":
        archive(tmp_path / "in", POLLS)
        run()
    else:
        if mode == "shuffled":
            random.Random(5).shuffle(numbered)
        for some in (numbered[:4], numbered[4:7], numbered[7:]):
            for i, p in some:
                archive(tmp_path / "in", [p], first=i)
            run()
    run()  # nothing new: nothing changes
    tasks, projects, groups, checkpoint = replay(POLLS)

    def check():
        assert as_dict(current_replica(spark, folders[1], "tasks"), "task_id", "title") == tasks
        assert as_dict(current_replica(spark, folders[1], "projects"), "project_id", "name") == projects
        assert as_dict(current_replica(spark, folders[1], "groups"), "group_id", "name") == groups
        assert {r["account_id"]: r["checkpoint"] for r in stream_checkpoints(spark, folders[1]).collect()} == checkpoint
        assert rows_of(stream_stats(spark, folders[1])) == stats_of(POLLS)
        assert as_dict(read_replica(spark, folders[3], "tasks"), "task_id", "title") == tasks

    check()
    cycles = stream_cycles(spark, folders[1]).orderBy("account_id", "response_checkpoint", "id").collect()
    sources = {"a": [0, 1, 2, 2, 4, 4, 4], "b": [0, 1]}
    assert [(c.account_id, c.source_checkpoint) for c in cycles] == [(a, n) for a in "ab" for n in sources[a]]
    assert all(c.started_at.year == 2024 and c.finished_at > c.started_at for c in cycles)
    assert [c.id for c in merge.cycle_history(stream_cycles(spark, folders[1], ["a"]), "a", 2).collect()] == [
        c.id for c in sorted(cycles, key=lambda c: c.started_at, reverse=True) if c.account_id == "a"][:2]
    compact(spark, folders[1])
    check()
    if mode == "one_by_one":
        run(str(tmp_path / "another"))  # all files again
        check()


def polls_of(spark, rows):
    """Rows of (account, checkpoint, task, whether it is a deletion) as numbered polls."""
    beans = [(a, c, f"f#{c:012d}", [] if gone else [json.dumps({"id": t, "title": str(c)})],
              [json.dumps({"id": t})] if gone else [], None, None, True, dt.datetime(2024, 1, 1)) for a, c, t, gone in rows]
    return spark.createDataFrame(beans, "account_id string, check_point bigint, poll_id string, updates array<string>, "
                                        "deletes array<string>, projects array<string>, groups array<string>, "
                                        "state_changed boolean, polled_at timestamp")


NOW = dt.datetime(2024, 1, 2)


@pytest.fixture
def one_task(spark):
    """Small batches by the dozen: one shuffle partition each."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def test_half_a_batch_is_never_seen(spark, one_task, tmp_path, monkeypatch):
    """The writer dies before some of its writes, before the commit and after it."""
    store = Store(spark, str(tmp_path))
    merge_batch(store, polls_of(spark, [("a", 1, "t", False), ("b", 1, "u", False)]), NOW)
    batch = polls_of(spark, [("a", 2, "t", True), ("b", 2, "v", False)])

    def seen():
        tables = {t: sorted(map(str, store.read(store.latest().of(t), ddl).collect())) for t, ddl in TABLES.items()}
        return tables, as_dict(current_replica(spark, str(tmp_path), "tasks"), "task_id", "title")

    before, write, commit = seen(), Store.write, Store.commit
    for dies_at in (0, 1, 4, len(TABLES) - 1, len(TABLES), len(TABLES) + 1):
        calls = iter(range(100))

        def failing(*args, real, **kwargs):
            n = next(calls)
            if n == dies_at:
                raise OSError("lost")
            done = real(*args, **kwargs)
            if n + 1 == dies_at == len(TABLES) + 1:
                raise OSError("lost after the commit")
            return done

        monkeypatch.setattr(Store, "write", lambda *a, **k: failing(*a, real=write, **k))
        monkeypatch.setattr(Store, "commit", lambda *a, **k: failing(*a, real=commit, **k))
        with pytest.raises(OSError):
            merge_batch(store, batch, NOW)
        if dies_at <= len(TABLES):
            assert seen() == before
    monkeypatch.setattr(Store, "write", write)
    monkeypatch.setattr(Store, "commit", commit)
    merge_batch(store, batch, NOW)  # the repetition of a batch that is there already
    assert seen()[1] == {("b", "u"): "1", ("b", "v"): "2"}
    assert rows_of(stream_stats(spark, str(tmp_path))) == [
        ("a", 1, 1, 0, None, None, True), ("a", 2, 0, 1, None, None, True),
        ("b", 1, 1, 0, None, None, True), ("b", 2, 1, 0, None, None, True)]
    old = store.version(1)
    assert as_dict(current_replica(spark, str(tmp_path), "tasks", version=old), "task_id", "title") == before[1]
    with pytest.raises(VersionTaken):
        store.commit(old)
    assert store.vacuum() > 0 and store.versions() == [store.latest().number]
    assert seen()[1] == {("b", "u"): "1", ("b", "v"): "2"}


def test_a_batch_reads_no_history(spark, one_task, tmp_path, monkeypatch):
    """Twenty batches over the same tasks: what one reads stays about the size of the state."""
    store, read, asked = Store(spark, str(tmp_path)), Store.read, []
    monkeypatch.setattr(Store, "read", lambda self, parts, ddl: asked.append(sum(p.size for p in parts)) or read(self, parts, ddl))
    sizes = []
    for n in range(20):
        asked.clear()
        rows = [("ab"[i % 2], 100 * n + i, f"t{i}", n % 3 == 2) for i in range(20)]
        merge_batch(store, polls_of(spark, rows), NOW, fanout=3)
        sizes.append(sum(asked))
    assert max(sizes[14:]) < 1.5 * max(sizes[4:9])
    assert max(len(store.latest().of(t)) for t in TABLES) < 12
    assert len(as_dict(current_replica(spark, str(tmp_path), "tasks"), "task_id", "title")) == 20
    stats = stream_stats(spark, str(tmp_path))
    assert stats.agg({"deletes_count": "sum"}).first()[0] == 6 * 20 and stats.count() == 400


def test_late_changes_move_finds(spark, one_task, tmp_path):
    store = Store(spark, str(tmp_path))
    rows = [("a", 1, "t", False), ("a", 2, "t", True), ("a", 3, "t", True), ("a", 4, "t", False), ("a", 5, "t", True)]
    for i in (1, 4, 2, 0, 3):
        merge_batch(store, polls_of(spark, [rows[i]]), NOW, fanout=2)
    found = {r["check_point"]: r["deletes_count"] for r in stream_stats(spark, str(tmp_path)).collect()}
    assert found == {1: 0, 2: 1, 3: 0, 4: 0, 5: 1}
    assert current_replica(spark, str(tmp_path), "tasks").isEmpty()


def test_buckets_grow_and_purges_leave_others_alone(spark, tmp_path):
    store, accounts = Store(spark, str(tmp_path / "replica")), [f"acc {i}" for i in range(12)]
    for n in range(3):
        merge_batch(store, polls_of(spark, [(a, n, f"t{n}", False) for a in accounts]), NOW, bucket_bytes=3000)
    version = store.latest()
    assert version.buckets >= 4
    want = {(a, f"t{n}"): str(n) for a in accounts for n in range(3)}
    assert as_dict(current_replica(spark, store.root, "tasks"), "task_id", "title") == want
    some = spark.createDataFrame([("acc 3",)], "account_id string")
    emitted = str(tmp_path / "emitted")
    for entity in schemas.REPLICA_KEY:
        write_replica(current_replica(spark, store.root, entity), emitted, entity)
    plan = current_replica(spark, store.root, "tasks", accounts=some)
    assert 0 < len(plan.inputFiles()) < len(current_replica(spark, store.root, "tasks").inputFiles())
    purged = purge_account(spark, store.root, "acc 3", emitted)
    (bucket,) = {p.bucket for p in set(purged.parts) - set(version.parts)}
    assert {p for p in version.parts if p.bucket != bucket} == {p for p in purged.parts if p.bucket != bucket}
    assert store.vacuum() > 0
    for table, ddl in TABLES.items():
        rows = store.read(store.latest().of(table), ddl)
        assert rows.filter("account_id = 'acc 3'").isEmpty()
        files = spark.read.option("recursiveFileLookup", True).schema(ddl).parquet(f"{store.root}/{table}")
        assert files.count() == rows.count()
    left = {k: v for k, v in want.items() if k[0] != "acc 3"}
    assert as_dict(current_replica(spark, store.root, "tasks"), "task_id", "title") == left
    assert as_dict(read_replica(spark, emitted, "tasks"), "task_id", "title") == left
    # What the purge covered doesn't come back; what is newer does.
    merge_batch(store, polls_of(spark, [("acc 3", 2, "t2", False), ("acc 3", 9, "new", False)]), NOW)
    assert as_dict(current_replica(spark, store.root, "tasks"), "task_id", "title") == left | {("acc 3", "new"): "9"}
    assert purge_account(spark, store.root, "nobody").number == store.latest().number


def test_jsonl_round_trip_and_broken_lines(spark, tmp_path):
    rows = spark.createDataFrame([("1", "a", None, True), ("2", None, 3, None)],
                                 "id string, name string, sortOrder bigint, closed boolean")
    write_jsonl(rows, str(tmp_path / "p"))
    (tmp_path / "p" / "extra.json").write_text('{"id": "3", "name":\n')
    got = read_jsonl(spark, str(tmp_path / "p"), schemas.PROJECTS, corrupt_column="_broken").cache()
    assert sorted((r["id"], r["sortOrder"]) for r in got.collect() if r["id"]) == [("1", None), ("2", 3)]
    assert got.filter("_broken is not null").count() == 1


def test_replica_overwrites_one_account_only(spark, tmp_path):
    def groups(*rows):
        df = spark.createDataFrame(list(rows), "group_id string, account_id string, name string")
        return df.select(*[
            (df[f.name] if f.name in df.columns else merge.F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schemas.GROUPS_V3.fields])

    path = str(tmp_path)
    write_replica(groups(("g", "a", "old"), ("h", "b", "stays")), path, "groups")
    write_replica(groups(("g", "a", "new"), ("h", "b", "unseen")), path, "groups", account_id="a")
    assert as_dict(read_replica(spark, path, "groups"), "group_id", "name") == {("a", "g"): "new", ("b", "h"): "stays"}


def test_snapshot(spark):
    def rows(*r):
        return spark.createDataFrame(list(r), "id string, v string")

    h = history.snapshot(None, rows(("1", "a"), ("2", "b"), ("3", None)), "id", "2024-01-01")
    h = history.snapshot(h, rows(("1", "a"), ("2", "c"), ("4", "d"), ("3", None)), "id", "2024-01-02")
    h = history.snapshot(h, rows(("2", "c"), ("4", "e"), ("3", "x")), "id", "2024-01-03")
    h = history.snapshot(h, rows(("1", "a"), ("2", "c"), ("4", "e"), ("3", "x")), "id", "2024-01-04")
    got = sorted((r["id"], r["v"] or "", r["dbt_valid_from"].day, r["dbt_valid_to"].day if r["dbt_valid_to"] else 0)
                 for r in h.collect())
    assert got == [("1", "a", 1, 3), ("1", "a", 4, 0), ("2", "b", 1, 2), ("2", "c", 2, 0), ("3", "", 1, 3),
                   ("3", "x", 3, 0), ("4", "d", 2, 3), ("4", "e", 3, 0)]
    assert h.select("dbt_scd_id").distinct().count() == h.count()
    created = {r["id"]: r["created_time"].day for r in history.created_time(h, "id").collect()}
    assert created == {"1": 1, "2": 1, "3": 1, "4": 2}


def test_snapshot_by_timestamp(spark):
    def rows(*r):
        return spark.createDataFrame(list(r), "id string, v string, at string").selectExpr("id", "v", "to_timestamp_ntz(at) as at")

    h = history.snapshot(None, rows(("1", "a", "2024-01-01")), "id", "2024-01-05", "timestamp", "at")
    h = history.snapshot(h, rows(("1", "b", "2024-01-01")), "id", "2024-01-06", "timestamp", "at")
    h = history.snapshot(h, rows(("1", "c", "2024-01-03")), "id", "2024-01-07", "timestamp", "at")
    got = sorted((r["v"], r["dbt_valid_from"].day, r["dbt_valid_to"].day if r["dbt_valid_to"] else 0) for r in h.collect())
    assert got == [("a", 1, 3), ("c", 3, 0)]


def test_completion_inference(spark):
    ddl = "task_id string, title string, _completed_time timestamp_ntz, status bigint"
    open_rows = spark.sql("select * from values ('1','open again',cast(null as timestamp_ntz),0L),"
                          "('0','load',timestamp_ntz'2024-01-01 10:00:30',0L) as t(task_id,title,_completed_time,status)")
    versions = spark.sql("""
        select task_id, title, cast(null as timestamp_ntz) as _completed_time, 0L as status, id as dbt_scd_id,
            to_timestamp_ntz(u) as dbt_updated_at, to_timestamp_ntz(u) as dbt_valid_from, to_timestamp_ntz(v) as dbt_valid_to
        from values ('1','closed once','a','2024-01-01','2024-01-02'), ('1','open','b','2024-01-03',null),
            ('2','never closed','c','2024-01-01',null), ('3','first','d','2024-01-01','2024-01-02'),
            ('3','second','e','2024-01-04','2024-01-05'), ('4','tie','f','2024-01-01',null),
            ('4','tie','g','2024-01-01','2024-01-02') as t(task_id,title,id,u,v)""")
    assert open_rows.columns == [c.split()[0] for c in ddl.split(", ")]
    got = {(r["task_id"], r["status"]): (r["title"], r["completed_time"].day if r["completed_time"] else None)
           for r in history.infer_completion(open_rows, versions).collect()}
    assert got == {("1", 0): ("open again", None), ("3", 2): ("second", 5), ("4", 2): ("tie", 2)}

    def title(now, interval):
        return history.next_load_banner(open_rows, now, interval).first()["title"]

    try:  # a clock time is not moved by the session zone
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        assert title(dt.datetime(2024, 1, 1, 10, 5, 59), 15) == "🏗️ in 10 minutes"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert title("2024-01-01 10:05:59", 15) == "🏗️ in 10 minutes"
    assert title("2024-01-01 10:15:00", 15) == "🟢 now"
    assert title("2024-01-01 10:05:59", None) == "load"


def events_of(spark, path, count):
    """Tables with so many events."""
    kinds = "element_at(array('click', 'view', 'error', 'purchase', 'signup'), cast(id % 5 as int) + 1)"
    spark.range(count).selectExpr(
        "id as event_id", "timestamp_ntz'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, 0, id) as ts", "id % 40 as user_id",
        f"{kinds} as event_type", "1.0D as value", "concat('{\"k\": ', id % 100, '}') as props").write.parquet(f"{path}/events.parquet")
    return Tables(spark, str(path))


@pytest.mark.parametrize("name", ["polls", "repeated_polls"])
def test_a_larger_archive_has_larger_files(spark, tmp_path, name):
    tables, files = {}, {}
    for count in (5_000, 100_000):
        tables[count] = events_of(spark, tmp_path / str(count), count)
        path = source_queries._write_polls(tables[count], getattr(tables[count], name))
        files[count] = len(spark.read.json(path).inputFiles())
        assert read_deltas(spark, path, lines=True).select("poll_id").distinct().count() == count
    assert 3 <= files[5_000] <= 16  # several batches of a stream
    assert files[100_000] <= 32


def test_late_changes_are_counted_at_once(spark, one_task, tmp_path, monkeypatch):
    """Changes in order, late ones and what they undo share one pass over the changes."""
    store, calls, real = Store(spark, str(tmp_path)), [], merge._sliced
    rows = [("a", 1, "t", False), ("a", 2, "t", True), ("b", 1, "u", False), ("b", 3, "u", True), ("a", 4, "v", False)]
    merge_batch(store, polls_of(spark, [rows[i] for i in (1, 3, 4)]), NOW)
    monkeypatch.setattr(merge, "_sliced", lambda df: calls.append(1) or real(df))
    merge_batch(store, polls_of(spark, [rows[i] for i in (0, 2)] + [("a", 5, "v", True), ("c", 1, "w", False)]), NOW)
    assert len(calls) == 1
    found = {(r["account_id"], r["check_point"]): r["deletes_count"] for r in stream_stats(spark, str(tmp_path)).collect()}
    assert found == {("a", 1): 0, ("a", 2): 1, ("a", 4): 0, ("a", 5): 1, ("b", 1): 0, ("b", 3): 1, ("c", 1): 0}


def test_statistics_read_the_changes_once(spark, tmp_path):
    """Of an archive, changes and counts are a scan each."""
    (tmp_path / "lines.json").write_text("\n".join(json.dumps(p | {"account_id": a}) for a, p in POLLS))
    stats = merge.batch_stats(read_deltas(spark, str(tmp_path), lines=True))
    stats.collect()
    plan = stats._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert sum("FileScan json" in line and "syncTaskBean" in line for line in plan.splitlines()) == 2


def test_jsonl_is_compressed(spark, tmp_path):
    rows = spark.range(5_000).selectExpr("cast(id as string) as id", "'a name' as name", "id as sortOrder", "id % 2 = 0 as closed")
    write_jsonl(rows, str(tmp_path / "p"))
    written = [f for f in (tmp_path / "p").iterdir() if f.name.startswith("part-")]
    assert all(f.name.endswith(".json.gz") for f in written) and sum(f.stat().st_size for f in written) < 5_000 * 20
    got = read_jsonl(spark, str(tmp_path / "p"), schemas.PROJECTS).select("id", "name", "sortOrder", "closed")
    assert sorted(got.collect()) == sorted(rows.collect())
    write_jsonl(rows, str(tmp_path / "p"), "none")
    assert all(f.name.endswith(".json") for f in (tmp_path / "p").iterdir() if f.name.startswith("part-"))


def test_tables_of_a_batch_are_written_side_by_side(spark, one_task, tmp_path, monkeypatch):
    """Every write of a batch waits for the others to begin."""
    store, write, together = Store(spark, str(tmp_path)), Store.write, threading.Barrier(len(TABLES))

    def meeting(self, df, table, buckets, level=0):
        if not level:
            together.wait(60)
        return write(self, df, table, buckets, level)

    monkeypatch.setattr(Store, "write", meeting)
    for n in range(2):
        beans = polls_of(spark, [("a", n, "t", n == 1)]).withColumns({"projects": F.array(F.lit("{}")), "groups": F.array(F.lit("{}"))})
        merge_batch(store, beans, NOW, fanout=2)
    assert {len(store.latest().of(t)) for t in TABLES} == {1}  # folded
    assert {r["check_point"]: r["deletes_count"] for r in stream_stats(spark, str(tmp_path)).collect()} == {0: 0, 1: 1}


def test_changes_are_not_joined_to_themselves(spark, one_task, tmp_path):
    """Finds come out of windows alone, and statistics out of one join."""
    rows = [("a", 10 * i + d, f"t{i % 3}", d == 1) for i in range(30) for d in range(2)] + [(None, 400 + d, "t", d == 1) for d in range(2)]
    found = merge.found_deletes(merge.task_ops(polls_of(spark, rows)))
    assert "Join" not in found._jdf.queryExecution().executedPlan().toString()
    assert found.agg({"deletes_count": "sum"}).first()[0] == 30
    merge_batch(Store(spark, str(tmp_path)), polls_of(spark, rows), NOW)
    stats = stream_stats(spark, str(tmp_path))
    assert stats._jdf.queryExecution().executedPlan().toString().count("Join ") == 1
    assert stats.count() == 60  # a poll without account is no row


def test_many_accounts_are_written_by_many_tasks(spark, tmp_path):
    """A small snapshot of many accounts is no single task; a large account is split; few accounts stay a file each."""
    def written(path, count):
        rows = spark.range(count + 3_000).selectExpr("cast(id as string) as task_id", "cast(if(id < 3000, 0, id - 3000) as string) as account_id")
        rows = rows.select(*[(rows[f.name] if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                             for f in schemas.REPLICA["tasks"].fields])
        write_replica(rows, path, "tasks", accounts=rows.select("account_id").distinct())
        assert read_replica(spark, path, "tasks").select("task_id", "account_id").distinct().count() == count + 3_000
        folders = {f.name: [p.name[:10] for p in f.glob("part-*")] for f in (tmp_path / path).glob("tasks/account_id=*")}
        assert len(folders) == count
        return folders

    many = written(str(tmp_path / "many"), 200)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert len({p for parts in many.values() for p in parts}) == tasks and len(many["account_id=0"]) > 1
    assert sum(map(len, many.values())) < 200 + tasks
    assert {len(parts) for parts in written(str(tmp_path / "few"), 5).values()} == {1}


def test_an_emit_has_few_files(spark, one_task, tmp_path):
    """A batch emits a file per entity, not one per account; accounts it leaves alone keep their rows."""
    store, emitted = Store(spark, str(tmp_path / "replica")), str(tmp_path / "emitted")

    def emit(rows, changed=True):
        batch = polls_of(spark, rows).withColumn("state_changed", F.lit(changed))
        version = merge_batch(store, batch, NOW)
        emit_changed(batch, store.root, emitted, version)
        return len(list((tmp_path / "emitted").rglob("part-*.parquet")))

    accounts = [f"acc {i}" for i in range(60)]
    assert emit([(a, 1, "t", False) for a in accounts]) == len(schemas.REPLICA)
    assert emit([("acc 0", 2, "t", True), ("acc 1", 2, "u", False)]) == 2 * len(schemas.REPLICA)
    assert emit([("acc 2", 3, "t", False)], changed=False) == 2 * len(schemas.REPLICA)
    want = {(a, "t"): "1" for a in accounts[1:]} | {("acc 1", "u"): "2"}
    assert as_dict(read_replica(spark, emitted, "tasks"), "task_id", "title") == want
    purge_account(spark, store.root, "acc 1", emitted)
    left = {k: v for k, v in want.items() if k[0] != "acc 1"}
    assert as_dict(read_replica(spark, emitted, "tasks"), "task_id", "title") == left
    files = spark.read.option("recursiveFileLookup", True).schema(schemas.TASKS_V3).parquet(f"{emitted}/tasks/_shared/rows")
    assert files.filter("account_id = 'acc 1'").isEmpty() and not files.isEmpty()


def test_emits_are_written_beside_a_batch(spark, one_task, tmp_path, monkeypatch):
    """Finds wait for the emitted files, which count when the version is there and go if the batch fails."""
    store, emitted, commit, write = Store(spark, str(tmp_path / "replica")), str(tmp_path / "emitted"), Store.commit, Store.write
    written, found = threading.Semaphore(0), replica_stream._found_changes

    def run(rows):
        batch = polls_of(spark, rows).withColumns({"projects": F.array(F.lit("{}")), "groups": F.array(F.lit("{}"))})
        merge_and_emit(store, batch, NOW, batch, emitted)

    def waiting(*args):
        assert all(written.acquire(timeout=60) for _ in schemas.REPLICA)
        return found(*args)

    def writing(self, df, table, *args, **kwargs):
        parts = write(self, df, table, *args, **kwargs)
        if table == "rows":
            written.release()
        return parts

    def failing(self, version):
        if self.root == store.root:
            raise OSError("lost")
        return commit(self, version)

    monkeypatch.setattr(replica_stream, "_found_changes", waiting)
    monkeypatch.setattr(Store, "write", writing)
    run([("a", 1, "t", False), ("b", 1, "u", False)])
    seen, files = as_dict(read_replica(spark, emitted, "tasks"), "task_id", "title"), set((tmp_path / "emitted").rglob("part-*.parquet"))
    assert seen == {("a", "t"): "1", ("b", "u"): "1"}
    monkeypatch.setattr(Store, "commit", failing)
    with pytest.raises(OSError):
        run([("a", 2, "t", True), ("b", 2, "v", False)])
    assert as_dict(read_replica(spark, emitted, "tasks"), "task_id", "title") == seen
    assert set((tmp_path / "emitted").rglob("part-*.parquet")) == files
    monkeypatch.setattr(Store, "commit", commit)
    run([("a", 2, "t", True), ("b", 2, "v", False)])
    assert as_dict(read_replica(spark, emitted, "tasks"), "task_id", "title") == {("b", "u"): "1", ("b", "v"): "2"}


def test_shared_snapshot(spark, one_task, tmp_path, monkeypatch):
    """Of every account the newest write counts, also when folders are folded, buckets double, and one was written before."""
    schema, path = schemas.GROUPS_V3, str(tmp_path)
    store = shared_store(spark, f"{path}/groups")

    def rows(groups):
        df = spark.createDataFrame([(g, a, n) for (a, g), n in groups.items()], "group_id string, account_id string, name string")
        return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields])

    def seen():
        return as_dict(read_replica(spark, path, "groups"), "group_id", "name")

    want = {("old", "g"): "o", ("a", "g"): "o", ("é /b", "g"): "o", (None, "g"): "o"}
    write_replica(rows(want), path, "groups")
    columns = read_replica(spark, path, "groups").columns
    names = ["a", "é /b", None, *map(str, range(8))]
    for n in range(7):
        some = [a for i, a in enumerate(names) if (i + n) % 3]
        new = {(a, f"g{i}"): f"{n}" for a in some if (len(a or "") + n) % 4 for i in range(2)}
        named = spark.createDataFrame([(a,) for a in some], "account_id string")
        if n < 2:
            write_replica(rows(new), path, "groups", accounts=named, shared=True)
        else:
            write_shared(rows(new).unionByName(named, allowMissingColumns=True), store, schema, fanout=3, bucket_bytes=2200)
        want = {k: v for k, v in want.items() if k[0] not in some} | new
        assert seen() == want
    version = store.latest()
    assert version.buckets > 1 and len(version.parts) <= 3 * version.buckets
    folders = {p.path for n in store.versions() for p in store.version(n).parts}
    assert {f"rows/{f.parent.parent.name}/{f.parent.name}" for f in tmp_path.rglob("part-*.parquet") if "_shared" in f.parts} == folders

    # Someone else is faster once: both writes count.
    commit = Store.commit

    def late(self, version):
        monkeypatch.setattr(Store, "commit", commit)
        write_replica(rows({("a", "g"): "first", ("c", "g"): "first"}), path, "groups")
        return commit(self, version)

    monkeypatch.setattr(Store, "commit", late)
    write_replica(rows({("a", "h"): "second", ("b", "h"): "not asked for"}), path, "groups", account_id="a")
    want = {k: v for k, v in want.items() if k[0] != "a"} | {("c", "g"): "first", ("a", "h"): "second"}
    assert seen() == want
    for gone in ("a", "é /b", "old", "nobody"):
        drop_account(spark, path, "groups", gone)
        want = {k: v for k, v in want.items() if k[0] != gone}
        assert seen() == want
    assert read_replica(spark, path, "groups").columns == columns


def test_a_purge_writes_tables_side_by_side(spark, one_task, tmp_path, monkeypatch):
    """Every table of the account's bucket waits for the others to begin; the other account keeps its rows."""
    store, write = Store(spark, str(tmp_path)), Store.write
    rows = [(a, n, "t", n == 1) for a in "ab" for n in range(2)] + [("b", 2, "u", False)]
    merge_batch(store, polls_of(spark, rows).withColumns({"projects": F.array(F.lit("{}")), "groups": F.array(F.lit("{}"))}), NOW)
    assert {p.table for p in store.latest().parts} == set(TABLES)
    together = threading.Barrier(len(TABLES))
    monkeypatch.setattr(Store, "write", lambda *args, **kwargs: together.wait(60) is None or write(*args, **kwargs))
    version = purge_account(spark, store.root, "a")
    assert version.purged == {"a": 1} and {p.table for p in version.parts} == set(TABLES)
    for table, ddl in TABLES.items():
        assert {r[0] for r in store.read(version.of(table), ddl).select("account_id").collect()} == {"b"}
    assert as_dict(current_replica(spark, str(tmp_path), "tasks"), "task_id", "title") == {("b", "u"): "2"}
