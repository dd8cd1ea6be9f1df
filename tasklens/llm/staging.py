"""Reading input tables and cutting lineage through the shared folder."""

from __future__ import annotations

import pickle
import tempfile
import uuid

from pyspark import Broadcast, cloudpickle
from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The named columns of one input table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def shared_folder(spark: SparkSession) -> str:
    """A new path under spark.checkpoint.dir. Only a local session without that setting gets a temporary folder."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="run-")
    return f"{root.rstrip('/')}/{uuid.uuid4().hex}"


def send(spark: SparkSession, value) -> Broadcast:
    """Broadcast an object with its class, so that workers need no copy of this package to open it with received()."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(value))


def received(sent: Broadcast):
    return pickle.loads(sent.value)


def materialize(df: DataFrame) -> DataFrame:
    """Write rows to the shared folder and read them back: the plan so far runs once, and lost executors lose nothing."""
    path = shared_folder(df.sparkSession)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
