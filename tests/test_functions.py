import datetime as dt

from pyspark.sql import functions as F

from tasklens.functions import dates, links, rules, text, typing
from tasklens.functions.json import json_scalar, json_string_array


def one(spark, rows, ddl, *columns):
    return [tuple(r) for r in spark.createDataFrame(rows, ddl).select(*columns).collect()]


def test_blank_to_null(spark):
    assert one(spark, [("",), ("a",), (None,), (" ",)], "c string", typing.blank_to_null("c")) == [
        (None,), ("a",), (None,), (" ",)]


def test_arrays(spark):
    rows = [(None,), ([],), ([""],), ([" ", "a"],), ([None, "b"],)]
    assert one(spark, rows, "c array<string>", typing.clean_string_array("c")) == [
        ([],), ([],), ([],), (["a"],), (["b"],)]
    rows = [("[]",), ("[a,b]",), ("['a','b']",), (None,), ("[a, b,]",)]
    assert one(spark, rows, "c string", typing.parse_malformed_array("c"), typing.parse_malformed_array("c", True)) == [
        ([], []), (["a", "b"], ["a", "b"]), (["'a'", "'b'"], ["a", "b"]), ([], []), (["a", " b"], ["a", " b"])]


def test_casts(spark):
    rows = [("true",), ("FALSE",), ("1",), ("yes",), (None,)]
    assert one(spark, rows, "c string", typing.safe_bool("c")) == [(True,), (False,), (None,), (None,), (None,)]
    rows = [("12",), ("x",), ("1.5",)]
    assert one(spark, rows, "c string", typing.safe_long("c")) == [(12,), (None,), (None,)]
    rows = [("2025-10-19T12:00:00.000+0000",), ("2025-10-19T12:00:00Z",), ("2025-10-19 19:00:00+07:00",), ("soon",)]
    got = one(spark, rows, "c string", typing.to_local_datetime(typing.safe_timestamp("c"), "Asia/Ho_Chi_Minh"))
    assert got == [(dt.datetime(2025, 10, 19, 19),)] * 3 + [(None,)]


def test_local_time_does_not_depend_on_the_session_zone(spark):
    rows = [("2025-07-01T12:00:00Z",)]
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        got = one(spark, rows, "c string", typing.to_local_datetime(typing.safe_timestamp("c"), "Europe/Paris"))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == [(dt.datetime(2025, 7, 1, 14),)]


def test_json(spark):
    rows = [('{"a": "x", "t": ["p", null, " ", 3]}',), ('{"a": {"b": 1}, "t": [{"z": 1}]}',), ('{"a": "[q]", "t": ["[r]"]}',),
            ('{"a": [1], "t": "no"}',), ('{"a": "x", "t":',), (None,), ('{"a": 1.0, "t": []}',)]
    got = one(spark, rows, "j string", json_scalar("j", "a"), json_string_array("j", "t"))
    assert got == [("x", ["p", "3"]), (None, []), ("[q]", ["[r]"]), (None, []), (None, []), (None, []), ("1.0", [])]


def test_flag(spark):
    rows = [(1, None), (0, '{"c": true}'), (None, '{"c": true}'), (None, "{}"), (None, '{"c": "1"}')]
    got = one(spark, rows, "i bigint, j string", typing.flag_from_int_or_json("i", json_scalar("j", "c")))
    assert got == [(True,), (False,), (True,), (None,), (None,)]


def test_text(spark):
    rows = [("  read @home  the\tbook @x",), (None,), ("@a",)]
    assert one(spark, rows, "c string", text.clean_content("c")) == [("read the book",), (None,), ("",)]
    rows = [("**Current streak:** 12 days",), ("note",), ("Current streak none",), (None,)]
    assert one(spark, rows, "c string", text.streak_text("c"), text.streak_count(text.streak_text("c"))) == [
        ("12 days", 12), (None, None), ("Current streak none", None), (None, None)]
    rows = [("folder_map - 'Home'",), ("folder_map - Home",), ("x",), ("folder_map - ''",)]
    assert one(spark, rows, "c string", text.folder_label("c")) == [("Home",), (None,), (None,), ("",)]
    assert one(spark, [(3, 7), (None, 7)], "m int, d int", text.slash_label("m", "d")) == [("3/7",), (None,)]


def test_keys_and_labels(spark):
    import hashlib

    got = one(spark, [("a", None), ("a", "b")], "x string, y string", text.surrogate_key("x", "y"))
    want = [hashlib.md5(s.encode()).hexdigest() for s in ("a-_dbt_utils_surrogate_key_null_", "a-b")]
    assert [g[0] for g in got] == want
    labels = one(spark, [("a",), ("a",), (None,)], "x string", text.stable_label("x"))
    assert labels[0] == labels[1] and labels[2] == (None,)
    glyph = ord(labels[0][0][0])
    assert text.FIRST_GLYPH <= glyph < text.FIRST_GLYPH + text.GLYPHS


def test_weeks(spark):
    days = [(dt.date(2024, 1, 6),), (dt.date(2024, 1, 7),), (dt.date(2024, 1, 8),)]  # Saturday, Sunday, Monday
    got = one(spark, days, "d date", dates.sunday_week(F.col("d")), dates.monday_week(F.col("d")), dates.iso_weekday(F.col("d")))
    d = dt.date
    assert got == [(d(2023, 12, 31), d(2024, 1, 1), 6), (d(2024, 1, 7), d(2024, 1, 1), 7), (d(2024, 1, 7), d(2024, 1, 8), 1)]


def test_work_type_table(spark):
    tags = [[], ["d"], ["s"], ["d", "s"], None]
    deep, shallow = rules.DEEP, rules.SHALLOW

    def table(*args):
        return [r[0] for r in one(spark, [(t,) for t in tags], "tags array<string>", rules.work_type("tags", *args))]

    assert table(["d"], ["s"], False) == [None] * 5
    assert table([], [], False) == table([], [], True) == [deep, None, None, None, deep]
    assert table(["d"], ["s"], True) == [None, deep, shallow, deep, None]
    assert table(["d"], [], True) == [shallow, deep, None, deep, shallow]
    assert table([], ["s"], True) == [deep, None, shallow, shallow, deep]


def test_scope_word(spark):
    names = ["x focus", "focusy", "a-focus-b", "FOCUS", "plain"]
    got = one(spark, [("f", n) for n in names], "f string, p string", rules.scope_bucket("f", "p", "focus"))
    assert [g[0] for g in got] == ["focus", "rest", "focus", "focus", "rest"]
    assert one(spark, [("f", "focus")], "f string, p string", rules.scope_bucket("f", "p", None)) == [("rest",)]


def test_folders(spark):
    rows = [(None, None), ("0", "Inbox"), ("default", None), ("g1", "Default"), ("g2", "Work"), ("g3", None)]
    got = one(spark, rows, "i string, n string", *rules.normalize_folder("i", "n"))
    assert got == [("default", "default")] * 4 + [("g2", "Work"), ("default", "default")]
    assert one(spark, [(None,), ("",), ("a",)], "g string", rules.folder_key("g")) == [("default",), ("default",), ("a",)]


def test_links(spark):
    rows = [("t1", "p1", "f1"), (None, None, None)]
    df = spark.createDataFrame(rows, "task_id string, project_id string, folder_id string")
    got = df.select(*links.link_columns("task", "folder"), links.url_metadata().alias("m")).collect()
    assert got[0].task_url_web == "https://ticktick.com/webapp/#p/p1/tasks/t1"
    assert got[1].task_url_native == "ticktick://ticktick.com/webapp/#p/unknown_project/tasks/unknown_task"
    assert got[1].folder_url_path == "ticktick.com/webapp/#g/default"
    assert got[1].m is None
