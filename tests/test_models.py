import datetime as dt

import pytest
from pyspark.sql import functions as F

from tasklens.config import Settings
from tasklens.operators import keyed, metrics, quality, series, shapes
from tasklens.plans import explore, marts, panels

D = dt.date
CFG = Settings(scope_word="focus")


@pytest.fixture(scope="module")
def world(spark):
    tasks = spark.sql("""
        select task_id, project_id, title, to_timestamp_ntz(due) as due_date, to_timestamp_ntz(done) as completed_time,
            to_timestamp_ntz(done) as updated_time, status, cast(null as string) as gtd_work_type, 'TASK' as kind,
            cast(tags as array<string>) as tags
        from values ('1','p1','a','2024-01-07 14:00:00',null,0L,array('x')), ('1','p1','a','2024-01-07 14:00:00',null,0L,array('x')),
            ('2','p1','b','2024-01-08',null,0L,array()), ('3','p2',null,'2024-01-08',null,0L,array('x','y')),
            ('4','gone','d','2024-01-09',null,0L,null), ('5',null,'e','2024-01-09',null,0L,array()),
            ('6','p3','f','2024-01-02','2024-01-03 10:00:00',2L,array()), ('7','p4','g',null,null,0L,array()),
            ('8','p2','h','2024-01-08',null,null,array())
        as t(task_id,project_id,title,due,done,status,tags)""")
    projects = spark.sql("""select * from values ('p1','Focus work','g1',false,date'2024-01-01'),
        ('p2','Rest','',false,date'2024-01-01'), ('p3','Old','g2',true,date'2024-01-01'),
        ('p4',null,'nowhere',null,date'2024-01-01') as t(project_id,project_name,group_id,closed,last_pulse)""")
    folders = spark.sql("select * from values ('g1','Work'), ('g2','Default') as t(folder_id,folder_name)")
    return tasks, projects, folders


def test_semantic_base(world):
    rows = {r["task_id"]: r for r in marts.semantic_base(*world, CFG).collect()}
    assert (rows["1"]["folder_id"], rows["1"]["folder_name"], rows["1"]["scope_bucket"]) == ("g1", "Work", "focus")
    assert (rows["3"]["folder_id"], rows["3"]["scope_bucket"]) == ("default", "rest")
    assert (rows["4"]["project_name"], rows["4"]["folder_id"]) == ("gone", "default")
    assert rows["5"]["project_name"] == "unknown_project"
    assert (rows["6"]["folder_id"], rows["6"]["completed_time_day_of_week_name"]) == ("default", "Wednesday")
    assert (rows["7"]["project_name"], rows["7"]["due_date_day"]) == ("p4", None)
    assert rows["1"]["due_date_week"] == D(2024, 1, 7)  # a Sunday starts its week


def test_workload_and_checks(world):
    tasks, projects, folders = world
    workload = marts.due_workload_daily(*world, "2024-01-07", CFG)
    assert workload.count() == 4 * 91
    counts = {(r["due_date_day"].day, r["project_id"]): r["open_task_count"]
              for r in workload.filter("open_task_count > 0").collect()}
    assert counts == {(7, "p1"): 1, (8, "p1"): 1, (8, "p2"): 1}  # duplicates once, unknown status not at all
    base = marts.semantic_base(*world, CFG)
    rollup = marts.grain_rollup(base)
    assert quality.workload_reconciles(workload, tasks).count() == 0
    assert quality.rollup_conserves(rollup, base).count() == 0
    assert quality.unique(workload, "due_workload_daily_id").count() == 0
    assert quality.unique(rollup, "grain_rollup_id").count() == 0
    for df in (base, marts.completed_activity(base)):
        assert quality.url_patterns(df).count() == 0
    assert quality.url_patterns(workload, ("project", "folder")).count() == 0
    assert quality.rollup_url_patterns(rollup).count() == 0
    orphans = metrics.orphan_keys(base, projects, "project_id", "due_date_day").collect()
    assert [(r["project_id"], r["row_count"]) for r in orphans] == [("gone", 1)]
    assert quality.relationships(tasks, "project_id", projects, spread="task_id").count() == 1
    grains = {(r["grain_level"], r["grain_id"]): r["task_count"] for r in rollup.filter("due_date_day = '2024-01-08'").collect()}
    assert grains == {("task", "2"): 1, ("task", "3"): 1, ("project", "p1"): 1, ("project", "p2"): 1,
                      ("folder", "g1"): 1, ("folder", "default"): 1}
    untitled = rollup.filter("grain_level = 'task' and grain_id = '3'").first()
    assert untitled["grain_label"] == "3"


# The worked example of the lookahead: weeks of daily counts, averages 4 1 1 1 1, overall 2.
WEEKS = [[2, 3, 4, 3, 8, 1, 1], [1, 1, 2, 1, 2, 0, 0], [0, 1, 2, 1, 1, 0, 0], [1, 1, 1, 2, 1, 0, 0], [0, 0, 1, 1, 0, 0, 0]]


def lookahead_inputs(spark):
    monday = D(2024, 1, 8)
    due = [(monday + dt.timedelta(days=7 * w + d)) for w, days in enumerate(WEEKS) for d, n in enumerate(days) for _ in range(n)]
    rows = [(str(i), "p1", dt.datetime.combine(day, dt.time(9))) for i, day in enumerate(due)]
    tasks = spark.createDataFrame(rows, "task_id string, project_id string, due_date timestamp_ntz").withColumn("status", F.lit(0))
    projects = spark.createDataFrame([("p1", "P", None)], "project_id string, project_name string, group_id string")
    folders = spark.createDataFrame([("default", "default")], "folder_id string, folder_name string")
    return tasks, projects, folders, monday


def test_lookahead_worked_example(spark):
    tasks, projects, folders, monday = lookahead_inputs(spark)
    from_mart = panels.lookahead_5w(marts.due_workload_daily(tasks, projects, folders, monday, CFG), monday).collect()
    catalog = marts.project_catalog(projects, folders, CFG)
    rows = panels.lookahead_of_tasks(tasks, catalog, monday).collect()
    assert rows == from_mart and len(rows) == 35
    for w in range(5):
        week = rows[7 * w:7 * w + 7]
        assert [r[f"W{w + 1}"] for r in week] == WEEKS[w]
        assert {r["Week Avg"] for r in week} == {[4, 1, 1, 1, 1][w]}
        assert [r["weekday_code"] for r in week] == [1, 2, 3, 4, 5, 6, 7]
    assert {r["Global Avg"] for r in rows} == {2}
    assert panels.lookahead_of_tasks(tasks, catalog, monday, folders=["none"]).collect() == []
    later = panels.lookahead_of_tasks(tasks, catalog, D(2024, 1, 13)).collect()  # starts on a Saturday
    assert len(later) == 30 and [r["W1"] for r in later[:2]] == [1, 1] and later[2]["W2"] == 1


def test_explore_spine_match(world, spark):
    tasks, projects, folders = world
    dims = projects.withColumn("group_id", F.coalesce(F.nullif("group_id", F.lit("")), F.lit("g1")))
    model = explore.Model(tasks, dims, folders, spine=series.date_spine(spark, "2024-01-07", 1))

    def per_day(match):
        rows = panels.lookahead_by_spine(model, match=match).collect()
        assert len(rows) == 31
        return {r["date_day"].day: r["count"] for r in rows if r["count"]}

    assert per_day("exact") == {8: 3}  # the task due at 14:00 meets no midnight
    assert per_day("day") == {7: 1, 8: 3}
    wide = explore.explore_query(model, by=["date_day", "project_name"], joins=["projects", "folders", "spine"],
                                 metrics={"n": metrics.metric("total_tasks")}, match="day")
    got = {(r["date_day"].day, r["project_name"]): r["n"] for r in wide.collect()}
    assert got[(7, "Focus work")] == 2 and got[(8, "Rest")] == 2 and got[(9, None)] == 0 and len(got) == 32


def scans(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString().count("Scan parquet")


def test_a_question_picks_its_joins(world, spark):
    tasks, projects, folders = world
    model = explore.Model(tasks, projects, folders, spine=series.date_spine(spark, "2024-01-07", 1))
    needed = lambda by=(), metrics_=None, where=None, refers=(): explore.needed_joins(
        model, {str(i): c for i, c in enumerate(by)}, metrics_ or {}, where, refers)
    assert needed([F.col("task_id")], {"n": metrics.metric("total_tasks")}) == []
    assert needed([F.upper("project_name")]) == ["projects"]
    assert needed([F.col("folder_name")]) == ["projects", "folders"]
    assert needed(where=~F.col("closed")) == ["projects"]
    assert needed(metrics_={"n": F.count_distinct("tag")}) == ["tags"]
    assert needed([F.trunc("date_day", "month")]) == ["spine"]
    assert needed(refers=("folder_name",)) == ["projects", "folders"]
    assert needed(where=F.col("title") == "date_day") == []  # a value, not a column


def test_days_without_rows_in_one_pass(world, spark, tmp_path):
    """Equal to the right join, with a filter that drops rows, one that drops days, and without metrics."""
    tasks, projects, folders = world
    tasks.write.parquet(str(tmp_path / "t"))
    tasks = spark.read.parquet(str(tmp_path / "t"))
    dims = projects.withColumn("group_id", F.coalesce(F.nullif("group_id", F.lit("")), F.lit("g1")))
    model = explore.Model(tasks, dims, folders, spine=series.date_spine(spark, "2024-01-05", 1))
    by = {"date_day": F.col("date_day"), "name": F.col("project_name")}
    for where in (None, F.col("project_name") == "Rest", F.col("project_name").isNull(), F.col("date_day") < "2024-01-08",
                  (F.col("project_name") != "Rest") | F.col("title").isNull()):
        for metrics_ in ({"n": metrics.metric("total_tasks"), "rows": F.count("*")}, None):
            got = explore.explore_query(model, by=by, metrics=metrics_, where=where, match="day")
            joined = explore.explore_join(model, ["projects", "spine"], match="day")
            joined = joined if where is None else joined.filter(where)
            cols = [c.alias(n) for n, c in by.items()]
            want = joined.groupBy(*cols).agg(*[m.alias(n) for n, m in metrics_.items()]) if metrics_ else joined.select(*cols).distinct()
            assert scans(got) == 1
            assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_rollup_reads_its_tasks_once(world, spark, tmp_path):
    tasks, projects, folders = world
    base = marts.semantic_base(tasks, projects, folders, CFG)
    base.write.parquet(str(tmp_path / "b"))
    rollup = marts.grain_rollup(spark.read.parquet(str(tmp_path / "b")))
    assert scans(rollup) == 1
    assert sorted(map(str, rollup.collect())) == sorted(map(str, marts.grain_rollup(base).collect()))


def test_explore_parameters_and_filters(world):
    tasks, projects, folders = world
    tags = marts.dim_tags(tasks)
    model = explore.Model(tasks, projects, folders, marts.fct_task_tags_bridge(tasks, tags), tags)
    by_tag = explore.explore_query(model, by=["tag"], joins=["projects", "tags"], metrics={
        "n": metrics.metric("total_tasks"), "rate": metrics.metric("completion_rate")})
    got = {r["tag"]: (r["n"], r["rate"]) for r in by_tag.collect()}
    assert got["x"] == (5, 0.0)  # two copies of a task meet two bridge rows each
    assert got["default"][0] == 4 and got["default"][1] == 0.25
    some = explore.explore_query(model, by=["task_id"], joins=["projects"], params=explore.Params(projects=["Old"]))
    assert [r["task_id"] for r in some.collect()] == ["6"]
    kept = tasks.filter(explore.field_filter("status", "notEquals", [2])).count()
    assert kept == 8 and tasks.filter(explore.field_filter("status", "notEquals", [2], keep_nulls=False)).count() == 7


def test_panels_over_small_world(world):
    tasks, projects, folders = world
    base = marts.semantic_base(*world, CFG)
    rollup = marts.grain_rollup(base)
    drill = panels.drill_down_by_grain(rollup, "2024-01-07", "project", scope="focus").collect()
    assert [(r["due_date_day"].day, r["grain"][2:], r["parent"][2:]) for r in drill] == [(7, "Focus work", "Work"), (8, "Focus work", "Work")]
    assert panels.drill_down_by_grain(rollup, "2024-01-07", "folder", projects=["Focus work"]).count() == 4
    done = panels.what_did_you_do(marts.completed_activity(base), "2024-01-04").collect()
    assert [r["task"] for r in done] == ["f"]
    catalog = marts.project_catalog(projects, folders, CFG)
    names = panels.filter_option_lists(catalog, projects, "project_name", folders="Wor.").collect()
    assert [r["project_name"] for r in names] == ["Focus work"]
    empty = panels.empty_projects(projects.withColumn("group_id", F.lit("g1")), folders, tasks.filter("project_id = 'p1'"))
    assert [r["project_id"] for r in empty.collect()] == ["p2"]


def test_inject_default_folders(spark):
    have = spark.createDataFrame([("0", "Inbox"), ("g", "G")], "folder_id string, folder_name string")
    assert sorted(map(tuple, shapes.inject_default_folders(have).collect())) == [
        ("0", "Inbox"), ("default", "default"), ("g", "G")]
    assert shapes.inject_default_folders(have, only_missing=False).count() == 4


def habit_rows(spark, rule, done, start="2024-01-01"):
    rows = [("h", "t", [" habit "], rule, start, 0, None)] + [("h", "t", ["habit"], rule, start, 2, d) for d in done]
    df = spark.createDataFrame(rows, "task_id string, title string, tags array<string>, repeat_flag string, s string, "
                                     "status int, c string")
    return df.selectExpr("task_id", "title", "tags", "repeat_flag", "to_timestamp_ntz(s) as start_date",
                         "to_timestamp_ntz(s) as due_date", "status", "to_timestamp_ntz(c) as completed_time")


def streaks(spark, *args, as_of="2024-01-07"):
    rows = series.habit_streaks(habit_rows(spark, *args), as_of).orderBy("expected_date").collect()
    return [(r["expected_date"].day, r["status"], r["habit_streak"]) for r in rows]


def test_habit_streaks(spark):
    done = ["2024-01-01 08:00:00", "2024-01-02 08:00:00", "2024-01-02 20:00:00", "2024-01-04 08:00:00"]
    assert streaks(spark, "RRULE:FREQ=DAILY", done, as_of="2024-01-05") == [
        (1, 2, 1), (2, 2, 2), (3, -1, None), (4, 2, 1), (5, -1, None)]
    assert streaks(spark, "FREQ=DAILY;INTERVAL=2", ["2024-01-03 08:00:00", "2024-01-05 08:00:00"]) == [
        (1, -1, None), (3, 2, 1), (5, 2, 2), (7, -1, None)]
    # 2024-01-01 is a Monday
    assert streaks(spark, "FREQ=WEEKLY;BYDAY=MO,WE", ["2024-01-03 08:00:00"], as_of="2024-01-10") == [
        (1, -1, None), (3, 2, 1), (8, -1, None), (10, -1, None)]
    assert [d for d, *_ in streaks(spark, "FREQ=WEEKLY;INTERVAL=2;BYDAY=WE", [], as_of="2024-01-31")] == [3, 17, 31]
    assert [d for d, *_ in streaks(spark, "FREQ=WEEKLY", [], as_of="2024-01-15")] == [1, 8, 15]
    assert streaks(spark, "FREQ=MONTHLY", []) == []


def test_hot_key_gives_the_same_rows_with_and_without_broadcast(spark):
    fact = spark.range(3000).select(F.col("id").cast("string").alias("task_id"),
                                    F.when(F.col("id") < 1000, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"))
    dim = spark.range(500, 2500).select(F.col("id").cast("string").alias("k"), F.lit("n").alias("name")).unionByName(
        spark.createDataFrame([("hot", "h")], "k string, name string"))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")

    def run(how, salts=None):
        return sorted(tuple(str(v) for v in r) for r in keyed.lookup_join(fact, dim, "k", "task_id", how, salts).collect())

    for how in ("left", "inner", "left_semi", "left_anti"):
        wide = run(how)
        try:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
            joined = keyed.lookup_join(fact, dim, "k", "task_id", how, salts=8)
            assert "_salt" in joined._jdf.queryExecution().executedPlan().toString()
            assert run(how) == run(how, 8) == wide
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_latest_by_reduces_before_the_shuffle(spark):
    df = spark.range(100).withColumn("k", F.col("id") % 3)
    latest = keyed.latest_by(df, ["k"], [F.desc("id")])
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert sorted(r["id"] for r in latest.collect()) == [97, 98, 99]
