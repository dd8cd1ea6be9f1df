"""Archived change payloads, one JSON document per poll, as a batch or a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tasklens import schemas

# Fixed value: archive files are called <account>__cp_<checkpoint>__<time>.json
ACCOUNT_IN_FILE_NAME = r"^(.*)__cp_-?\d+__"
TIME_IN_FILE_NAME = r"__(\d{8}T\d{6}Z)\.json$"


def read_deltas(spark: SparkSession, path: str, stream: bool = False, files_per_trigger: int | None = None,
                lines: bool = False) -> DataFrame:
    """Polls with their account, in the columns of delta_columns.

    By default a file is one JSON document and its name tells the account and the time. With `lines`, files hold many
    polls, one per line, each with an account_id and perhaps a polledAt: that is the form for archives of millions of
    polls, which Spark can also split. Without a time of its own a poll has the file's.

    A batch comes with its poll ids. A stream can't number lines: give every micro-batch to number_polls.
    """
    reader = spark.readStream if stream else spark.read
    if stream and files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    reader = reader.option("pathGlobFilter", "*.json")
    written = F.col("_metadata.file_modification_time")
    if lines:
        own = [StructField("account_id", StringType()), StructField("polledAt", StringType())]
        files = reader.schema(StructType([*schemas.DELTA.fields, *own])).json(path)
        found = files.withColumn("polled_at", F.coalesce(F.col("polledAt").try_cast("timestamp"), written))
    else:
        files = reader.schema(schemas.DELTA).option("multiLine", True).json(path)
        name = F.url_decode(F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B")))
        time = F.try_to_timestamp(F.nullif(F.regexp_extract(name, TIME_IN_FILE_NAME, 1), F.lit("")), F.lit("yyyyMMdd'T'HHmmssX"))
        found = files.withColumn("account_id", F.regexp_extract(name, ACCOUNT_IN_FILE_NAME, 1)).withColumn(
            "polled_at", F.coalesce(time, written))
    place = {"source_file": F.col("_metadata.file_name"), "source_block": F.col("_metadata.file_block_start")}
    polls = delta_columns(found.withColumns(place))
    return polls if stream else number_polls(polls)


def number_polls(polls: DataFrame) -> DataFrame:
    """Add poll_id: the file and the number of the line in it, however the file was split.

    A file that comes again gives the same ids. They sort as the lines of a file do.
    """
    rows = polls.withColumn("_row", F.monotonically_increasing_id())
    # One row per split of a file; rows of a split are numbered without gaps.
    splits = rows.groupBy("source_file", "source_block").agg(F.min("_row").alias("_first"), F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.partitionBy("source_file").orderBy("source_block")) - F.col("_n")
    splits = splits.select("source_file", "source_block", "_first", before.alias("_before"))
    line = F.col("_before") + F.col("_row") - F.col("_first")
    numbered = rows.join(splits, ["source_file", "source_block"])
    poll_id = F.concat_ws("#", "source_file", F.lpad(line.cast("string"), 12, "0"))
    return numbered.withColumn("poll_id", poll_id).drop("source_file", "source_block", "_row", "_first", "_before")


def delta_columns(polls: DataFrame) -> DataFrame:
    """Flat poll: account, checkpoint, task changes that apply, the nullable full lists, and whether state changes.

    A task part flagged empty, or missing, changes nothing. NULL lists mean 'not sent'; empty lists mean 'now empty'.
    What tells a poll from others (poll_id, or the file and split), and its time, are kept if they are there.
    """
    live = F.col("syncTaskBean").isNotNull() & ~F.coalesce(F.col("syncTaskBean.empty"), F.lit(False))
    nothing = F.array().cast("array<string>")
    known = [c for c in ("poll_id", "source_file", "source_block", "polled_at") if c in polls.columns]
    return polls.select(
        "account_id",
        F.col("checkPoint").alias("check_point"),
        F.when(live, F.coalesce(F.col("syncTaskBean.update"), nothing)).otherwise(nothing).alias("updates"),
        F.when(live, F.coalesce(F.col("syncTaskBean.delete"), nothing)).otherwise(nothing).alias("deletes"),
        F.col("projectProfiles").alias("projects"),
        F.col("projectGroups").alias("groups"),
        (live | F.col("projectProfiles").isNotNull() | F.col("projectGroups").isNotNull()).alias("state_changed"),
        *known,
    )
