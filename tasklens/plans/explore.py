"""Ad-hoc questions over the joined model: metrics by dimensions, with filters, sorting and post-aggregate columns."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tasklens.functions.dates import as_date
from tasklens.functions.links import PARENT_GRAIN, grain_url, parent_grain_url
from tasklens.functions.text import stable_label, surrogate_key
from tasklens.operators.keyed import lookup_join
from tasklens.operators.shapes import tags_with_default

# Fixed value: a list parameter holding this word selects everything.
ALL = "default_ld_param_value"


@dataclass(frozen=True)
class Params:
    """Choices a reader makes: the grain of counts and lists of names; an empty list selects everything."""

    grain: str = "task"
    projects: Sequence[str] = field(default=())
    folders: Sequence[str] = field(default=())
    tags: Sequence[str] = field(default=())


@dataclass(frozen=True)
class Model:
    """Tables of an explore. Tables left out cannot be joined, except tags: without a bridge, a task's own list is read."""

    tasks: DataFrame
    projects: DataFrame | None = None
    folders: DataFrame | None = None
    bridge: DataFrame | None = None
    tags: DataFrame | None = None
    spine: DataFrame | None = None


def param_multi_select(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    if not values or ALL in values:
        return df
    return df.filter(F.col(column).isin(*values))


def param_grain(grain: str) -> dict[str, Column]:
    """Columns that follow the chosen grain."""
    names = {"task": "title", "project": "project_name", "folder": "folder_name"}
    own, parent = F.col(names[grain]), F.col(names[PARENT_GRAIN[grain]])
    return {
        "dimension_grain": own,
        "parent_dimension_grain": parent,
        "formatted_dimension_grain": stable_label(own),
        "formatted_parent_dimension_grain": stable_label(parent),
        "dynamic_grain_url": grain_url(grain),
        "dynamic_parent_grain_url": parent_grain_url(grain),
    }


def filter_relative_date(column: Column | str, operator: str, n: int, unit: str, as_of: dt.date | str) -> Column:
    """inTheNext, inThePast or inTheCurrent n units, by day, both ends included."""
    day = (F.col(column) if isinstance(column, str) else column).cast("date")
    today = F.lit(as_date(as_of))
    if operator == "inTheCurrent":
        start = F.trunc(today, {"weeks": "week", "months": "month", "quarters": "quarter", "years": "year"}[unit]) \
            if unit != "days" else today
        return (day >= start) & (day < _shift(start, n, unit))
    if operator == "inTheNext":
        return day.between(today, _shift(today, n, unit))
    if operator == "inThePast":
        return day.between(_shift(today, -n, unit), today)
    raise ValueError(f"unknown operator: {operator}")


def _shift(day: Column, n: int, unit: str) -> Column:
    if unit in ("days", "weeks"):
        return F.date_add(day, n * (7 if unit == "weeks" else 1))
    return F.add_months(day, n * {"months": 1, "quarters": 3, "years": 12}[unit])


def field_filter(column: str, operator: str, values: Sequence = (), keep_nulls: bool = True) -> Column:
    """One condition. notEquals keeps rows without a value unless told otherwise."""
    c = F.col(column)
    if operator == "equals":
        return c.isin(*values)
    if operator == "notEquals":
        differs = ~c.isin(*values)
        return differs | c.isNull() if keep_nulls else differs
    if operator == "notNull":
        return c.isNotNull()
    if operator == "isNull":
        return c.isNull()
    if operator == "greaterThan":
        return c > values[0]
    if operator == "lessThan":
        return c < values[0]
    raise ValueError(f"unknown operator: {operator}")


def all_of(*conditions: Column) -> Column:
    out = F.lit(True)
    for c in conditions:
        out = out & c
    return out


def any_of(*conditions: Column) -> Column:
    out = F.lit(False)
    for c in conditions:
        out = out | c
    return out


PROJECT_COLUMNS = ("project_name", "group_id", "closed")


def explore_join(model: Model, joins: Sequence[str], params: Params = Params(), match: str = "exact",
                 rows: DataFrame | None = None, project_columns: Sequence[str] = PROJECT_COLUMNS) -> DataFrame:
    """Tasks joined to the named tables: projects, folders and tags (inner), then the spine (every day is kept).

    Parameters restrict the dimension before it is joined. Projects bring the named columns only, so that what a
    question does not read, such as the last pulse, is not computed for it.
    """
    rows = model.tasks if rows is None else rows
    if "projects" in joins or "folders" in joins:
        projects = param_multi_select(model.projects, "project_name", params.projects)
        rows = lookup_join(rows, projects.select("project_id", *project_columns), "project_id", spread="task_id",
                           how="inner")
        if "folders" in joins:
            folders = param_multi_select(model.folders, "folder_name", params.folders)
            rows = lookup_join(rows.withColumn("folder_id", F.col("group_id")),
                               folders.select("folder_id", "folder_name"), "folder_id", spread="task_id", how="inner")
    if "tags" in joins:
        if model.bridge is None:  # each task unfolds its own tags: nothing to join
            rows = param_multi_select(rows.withColumn("tag", F.explode(tags_with_default())), "tag", params.tags)
            rows = rows.withColumn("tag_id", surrogate_key("tag"))
        else:
            tags = param_multi_select(model.tags, "tag", params.tags).select("tag_id", "tag")
            named = lookup_join(model.bridge, tags, "tag_id", spread="task_id", how="inner")
            rows = rows.join(named, "task_id")
    if "spine" in joins:
        rows = spine_right_join(rows, model.spine, match)
    return rows


def on_spine(rows: DataFrame, spine: DataFrame, match: str = "exact") -> DataFrame:
    """Rows that fall on a spine day. 'exact' compares the due time with midnight, 'day' compares days.

    The spine is a few months of days by construction, so it is always the broadcast side.
    """
    due = F.col("due_date") if match == "exact" else F.col("due_date").cast("date")
    days = spine.select("date_day", F.col("date_day").cast("timestamp_ntz" if match == "exact" else "date").alias("_day"))
    return rows.withColumn("_day", due).join(F.broadcast(days), "_day").drop("_day")


def spine_right_join(rows: DataFrame, spine: DataFrame, match: str = "exact") -> DataFrame:
    """Rows on spine days plus the days without rows.

    A right join proper would hash all rows by a few dozen days. Here the rows meet a broadcast spine where they are,
    and the days found are one small distinct set.
    """
    matched = on_spine(rows, spine, match)
    empty = spine.join(F.broadcast(matched.select("date_day").distinct()), "date_day", "left_anti")  # spine days at most
    return matched.unionByName(empty, allowMissingColumns=True)


def needed_joins(model: Model, dims: dict[str, Column], metrics: dict[str, Column], where: Column | None = None,
                 refers: Sequence[str] = (), project_columns: Sequence[str] = PROJECT_COLUMNS) -> list[str]:
    """The joins that a question's dimensions, metrics and filter need, and the columns it `refers` to besides.

    A join is needed if the question reads a column that only it brings. Spark says which columns those are, once it has
    resolved the question over an empty table that has all of them. Folders hang on projects.
    """
    own = dict(model.tasks.dtypes)
    brought = {"tags": {"tag": "string", "tag_id": "string"}}
    if model.projects is not None:
        brought["projects"] = {n: k for n, k in model.projects.dtypes if n in project_columns}
    if model.folders is not None:
        brought["folders"] = {"folder_id": "string", "folder_name": "string"}
    if model.spine is not None:
        brought["spine"] = {"date_day": "date"}
    extra = {name: {n: k for n, k in fields.items() if n not in own} for name, fields in brought.items()}
    if not hasattr(model.tasks, "_jdf"):  # a remote session shows no plan
        return list(brought)
    every = own | {n: k for fields in extra.values() for n, k in fields.items()}
    empty = model.tasks.sparkSession.createDataFrame([], ", ".join(f"`{n}` {k}" for n, k in every.items()))
    rows = empty if where is None else empty.filter(where)
    counts = [m.alias(n) for n, m in metrics.items()] or [F.count("*")]
    read = _columns_read(rows.groupBy(*[c.alias(n) for n, c in dims.items()], *refers).agg(*counts))
    needed = [name for name, fields in extra.items() if fields.keys() & read]
    return ["projects", *needed] if "folders" in needed and "projects" not in needed else needed


def _columns_read(df: DataFrame) -> set[str]:
    """Names of the columns that a resolved question refers to."""
    nodes, names = [df._jdf.queryExecution().analyzed()], set()
    while nodes:
        node = nodes.pop()
        references, children = node.references().iterator(), node.children().iterator()
        while references.hasNext():
            names.add(references.next().name())
        while children.hasNext():
            nodes.append(children.next())
    return names


def _on_every_day(matched: DataFrame, spine: DataFrame, dims: dict[str, Column], metrics: dict[str, Column],
                  where: Column | None) -> DataFrame:
    """The question's groups over rows on spine days and the days without rows, in one pass over the rows.

    One marker for each spine day goes into the same grouping, apart from the rows, and so do rows that the filter drops,
    by day alone. A marker then stays where its day has no row at all.
    """
    days = spine.select("date_day", F.lit("marker").alias("_kind"))
    rows = matched.withColumn("_kind", F.lit("row")).unionByName(days, allowMissingColumns=True)
    if where is not None:
        rows = rows.withColumn("_kind", F.when(where, F.col("_kind")).otherwise(
            F.when(F.col("_kind") == "row", F.lit("dropped")).otherwise(F.lit("dropped marker"))))
    dropped = F.col("_kind") == "dropped"
    columns = [F.when(~dropped, c).alias(n) for n, c in dims.items()]
    groups = rows.groupBy(F.col("date_day").alias("_day"), "_kind", *columns)
    found = groups.agg(*[m.alias(n) for n, m in metrics.items()]) if metrics else groups.agg(F.lit(1).alias("_any")).drop("_any")
    by_day = W.partitionBy("_day")  # groups, no longer rows
    has_rows = F.max(F.col("_kind").isin("row", "dropped")).over(by_day)
    kept = found.withColumn("_has_rows", has_rows).filter(
        (F.col("_kind") == "row") | ((F.col("_kind") == "marker") & ~F.col("_has_rows")))
    return kept.select(*dims, *metrics)


def explore_query(model: Model, by: dict[str, Column] | Sequence[str] = (), metrics: dict[str, Column] | None = None,
                  joins: Sequence[str] | None = None, params: Params = Params(), where: Column | None = None,
                  calc: dict[str, Column] | None = None, having: Column | None = None,
                  order: Sequence[Column] = (), limit: int | None = None, match: str = "exact",
                  fact_where: Column | None = None, refers: Sequence[str] = (),
                  project_columns: Sequence[str] = PROJECT_COLUMNS) -> DataFrame:
    """One question as one plan: join what is needed, filter, group, add calculated columns, filter again, sort.

    The joins follow from what the question refers to, unless they are named. Joins are inner: a name in `refers` asks
    for its table although no dimension, metric or filter reads it. `where` sees all joined columns. `fact_where` is applied to the tasks before any join; use it for conditions that
    drop tasks without dropping empty spine days. Without metrics the distinct dimension rows are returned.

    When the only dimension is the spine's day itself, tasks are aggregated per day first and the days are filled in
    after, which replaces the right join by a join of two calendars. When it is one of several, days without rows come
    into the same grouping, so the tasks are read once.
    """
    rows = model.tasks if fact_where is None else model.tasks.filter(fact_where)
    dims = by if isinstance(by, dict) else {name: F.col(name) for name in by}
    metrics = metrics or {}
    if joins is None:
        joins = needed_joins(model, dims, metrics, where, refers, project_columns)
    by_day = not isinstance(by, dict) and list(by) == ["date_day"]  # the bare column, not an expression of that name
    if "spine" in joins and where is None and by_day and metrics:
        inner = explore_join(model, [j for j in joins if j != "spine"], params, match, rows, project_columns)
        counted = on_spine(inner, model.spine, match).groupBy("date_day").agg(*[m.alias(n) for n, m in metrics.items()])
        out = model.spine.select("date_day").join(F.broadcast(counted), "date_day", "left")
        out = out.na.fill(0, subset=[name for name, kind in counted.dtypes if kind == "bigint"])
    elif "spine" in joins and any(repr(c) == repr(F.col("date_day")) for c in dims.values()):  # groups lie within days
        inner = explore_join(model, [j for j in joins if j != "spine"], params, match, rows, project_columns)
        out = _on_every_day(on_spine(inner, model.spine, match), model.spine, dims, metrics, where)
    else:
        joined = explore_join(model, joins, params, match, rows, project_columns)
        if where is not None:
            joined = joined.filter(where)
        columns = [c.alias(n) for n, c in dims.items()]
        if metrics:
            out = joined.groupBy(*columns).agg(*[m.alias(n) for n, m in metrics.items()])
        else:
            out = joined.select(*columns).distinct()
    for name, expression in (calc or {}).items():
        out = out.withColumn(name, expression)
    if having is not None:
        out = out.filter(having)
    if order:
        out = out.orderBy(*order)
    return out if limit is None else out.limit(limit)
