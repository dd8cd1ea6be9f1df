"""Replica snapshots whose files hold many accounts.

A file costs the same however few rows it has, so a folder per account is dear where thousands of accounts are written
again and again. Here a write adds one folder per bucket of accounts, in one version (see commits.py), with all rows of the
accounts it names. Of every account the rows of its newest write count: what a write puts down is as much as it was given,
whatever was there before. A bucket with FANOUT folders is folded to one.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tasklens.sources.commits import Part, Store, Version, VersionTaken, bucket_of

ROWS = "rows"
FANOUT = 8
BUCKET_BYTES = 256 << 20
# A reader has its rows until so many more versions came.
KEPT_VERSIONS = 2


def shared_store(spark: SparkSession, folder: str) -> Store:
    """The versions below a folder, hidden from readers of plain Parquet."""
    return Store(spark, f"{folder}/_shared")


def write_shared(rows: DataFrame, store: Store, schema: StructType, after: Callable[[], object] = lambda: None,
                 fanout: int = FANOUT, bucket_bytes: int = BUCKET_BYTES) -> None:
    """Replace the accounts that have rows; the others keep theirs. Files are written at once and count when `after` has
    returned; they go if it fails."""

    def added(version: Version) -> Version:
        parts = _write(rows, store, version.buckets)
        try:
            after()
        except BaseException:
            store.remove({p.path for p in parts}, set())
            raise
        return version.swapped((), parts)

    _changed(store, added)
    _changed(store, lambda version: _folded(store, version, schema, fanout, bucket_bytes))
    store.expire(KEPT_VERSIONS)


def read_shared(store: Store, parts: list[Part], schema: StructType, older: DataFrame | None = None) -> DataFrame:
    """Of every account the rows of its newest write; rows older than all writes can be given."""
    if older is not None and not parts:
        return older
    rows = store.read(parts, schema)
    if older is None and len({p.bucket for p in parts}) == len(parts):
        return rows
    # An account lies in one bucket, and the folders of a bucket are in the order of the writes.
    writes = dict.fromkeys(p.path.split("/")[1] for p in parts)
    name = F.substring_index(F.substring_index("_metadata.file_path", "/", -3), "/", 1)
    rows = rows.withColumn("_write", F.array_position(F.array(*map(F.lit, writes)), name))
    rows = rows if older is None else older.withColumn("_write", F.lit(0).cast("bigint")).unionByName(rows)
    newest = rows.groupBy(F.col("account_id").alias("_account")).agg(F.max("_write").alias("_newest"))
    kept = F.col("account_id").eqNullSafe(F.col("_account")) & (F.col("_write") == F.col("_newest"))
    return rows.join(newest, kept, "left_semi").drop("_write")


def drop_shared(store: Store, schema: StructType, account_id: str) -> None:
    """Remove an account, from the files as well."""
    own = store.spark.createDataFrame([(account_id,)], "account_id string")

    def dropped(version: Version) -> Version:
        old = version.parts and version.of(ROWS, [own.select(bucket_of(version.buckets)).first()[0]])
        if not old:
            return version
        rows = read_shared(store, old, schema).filter(~F.col("account_id").eqNullSafe(account_id))
        return version.swapped(old, _write(rows, store, version.buckets, 1))

    _changed(store, dropped)
    store.expire(1)


def _write(rows: DataFrame, store: Store, buckets: int, level: int = 0) -> list[Part]:
    return store.write(rows, ROWS, buckets, level, compression="snappy")


def _changed(store: Store, change: Callable[[Version], Version]) -> None:
    """Commit a change of the newest version; it is made again if someone else was faster."""
    while (changed := change(version := store.latest())) is not version:
        try:
            store.commit(changed)
            return
        except VersionTaken:
            store.remove({p.path for p in changed.parts}, {p.path for p in version.parts})


def _folded(store: Store, version: Version, schema: StructType, fanout: int, bucket_bytes: int) -> Version:
    """Buckets with `fanout` folders are folded to one; all are if the folded ones have outgrown their number."""
    full = {bucket for bucket, n in Counter(p.bucket for p in version.parts).items() if n >= fanout}
    buckets = version.buckets
    while buckets * bucket_bytes < sum(p.size for p in version.parts if p.level):
        buckets *= 2
    old = version.of(ROWS, full if buckets == version.buckets else None)
    if not old:
        return version
    new = _write(read_shared(store, old, schema), store, buckets, 1)
    return Version(version.number, buckets, version.swapped(old, new).parts, version.purged)
