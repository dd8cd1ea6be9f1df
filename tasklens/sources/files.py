"""JSONL tables and the Parquet replica."""

from __future__ import annotations

from collections.abc import Callable
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tasklens import schemas
from tasklens.sources.commits import Store
from tasklens.sources.snapshots import drop_shared, read_shared, shared_store, write_shared

ACCOUNTS_A_TASK = 32


def read_jsonl(spark: SparkSession, path: str, schema: StructType, corrupt_column: str | None = None) -> DataFrame:
    """Newline-delimited JSON with a given schema. Unreadable lines give NULLs, and their text when a column is named."""
    reader = spark.read.option("mode", "PERMISSIVE")
    if corrupt_column:
        schema = StructType([*schema.fields, StructField(corrupt_column, StringType())])
        reader = reader.option("columnNameOfCorruptRecord", corrupt_column)
    return reader.schema(schema).json(path)


def write_jsonl(df: DataFrame, path: str, compression: str = "gzip") -> None:
    """Full refresh of a JSONL folder. NULL fields are kept so that every line has every column: lines are long and much
    alike, so files are compressed, fast. Readers know the codec by the file's ending; a compressed file is read in one piece."""
    fast = {"compression": compression, "zlib.compress.level": "BEST_SPEED"}
    df.write.mode("overwrite").options(ignoreNullFields="false", **fast).json(path)


def read_replica(spark: SparkSession, path: str, entity: str) -> DataFrame:
    """Current replica rows of one entity: tasks, projects or groups. A remote session sees folders of accounts only."""
    folder, schema = f"{path}/{entity}", schemas.REPLICA[entity]
    plain = spark.read.schema(schema)
    version = shared_store(spark, folder).latest() if hasattr(spark, "_jsc") else None
    if version and version.number:
        older = plain.parquet(folder) if Store(spark, path).named(entity, lambda name: name[0] not in "_.") else None
        rows = read_shared(shared_store(spark, folder), list(version.parts), schema, older)
        rows = rows.select(*(c for c in schema.names if c != "account_id"), "account_id")
    else:
        rows = plain.parquet(folder)
    return rows.filter(F.col(schemas.REPLICA_KEY[entity]).isNotNull())


def drop_account(spark: SparkSession, path: str, entity: str, account_id: str) -> None:
    """Remove an account from a snapshot."""
    Store(spark, path).drop(entity, lambda name: unquote(name) == f"account_id={account_id}")
    drop_shared(shared_store(spark, f"{path}/{entity}"), schemas.REPLICA[entity], account_id)


def write_replica(df: DataFrame, path: str, entity: str, account_id: str | None = None,
                  accounts: DataFrame | None = None, shared: bool = False,
                  after: Callable[[], object] = lambda: None) -> None:
    """Replica snapshot, one folder per account; only the folders of the accounts written are replaced.

    account_id writes one account. `accounts` names all accounts to replace: each gets one extra row without a key, which
    reading drops, so that the folder of an account that lost its last row is replaced as well.

    With `shared`, accounts have files in common (see snapshots.py), which read_replica alone can tell apart: that is the
    form for many accounts written again and again. A snapshot that has such files gets all later rows in them; folders
    of accounts written before stay, as the oldest rows. Nothing is replaced before `after` has returned, but shared files
    are written by then.

    Rows are rebalanced by account, which keeps the number of files low; adaptive execution splits an account that is
    too large for one task. But a file costs the same however few rows it has: of many named accounts, tasks get ranges
    of account and key with equally many rows, ACCOUNTS_A_TASK accounts each or as many as the shuffle partitions leave.
    """
    schema = schemas.REPLICA[entity]
    rows = df
    if account_id is not None:
        rows = df.filter(F.col("account_id") == account_id)
        accounts = df.sparkSession.range(1).select(F.lit(account_id).alias("account_id"))
    rows = rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
    if accounts is not None:
        rows = rows.unionByName(accounts.select("account_id"), allowMissingColumns=True)
    store = shared_store(df.sparkSession, f"{path}/{entity}") if hasattr(df.sparkSession, "_jsc") else None
    if store and (shared or store.versions()):
        write_shared(rows, store, schema, after)
        return
    after()
    ranges = 1
    if accounts is not None:
        partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        ranges = 1 if account_id is not None else min(partitions, -(-accounts.count() // ACCOUNTS_A_TASK))
    if ranges > 1:
        rows = rows.repartitionByRange(ranges, "account_id", schemas.REPLICA_KEY[entity])
    else:
        rows = rows.hint("rebalance", F.col("account_id"))
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy")
        .partitionBy("account_id")
        .parquet(f"{path}/{entity}")
    )
