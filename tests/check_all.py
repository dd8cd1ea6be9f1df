"""Run every query against its oracle: python tests/check_all.py [sf_dir] [name ...]"""

from __future__ import annotations

import sys
import time

sys.path.insert(0, __file__.rsplit("/", 2)[0])

from pyspark.sql import SparkSession  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from tests.compare import connect, difference  # noqa: E402


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    oracles, bad, empty = entry.oracle_sql(), 0, []
    for name, fn in entry.queries().items():
        if only and name not in only:
            continue
        start = time.time()
        try:
            df = fn(spark, sf_dir)
            problem = difference(df, con, oracles[name]) if name in oracles else None
            if problem is None and df.isEmpty():
                empty.append(name)
        except Exception as error:  # report and go on
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {name} {time.time() - start:.1f}s", problem or "", flush=True)
    print(f"{bad} bad; no rows: {empty}")
    return bad


if __name__ == "__main__":
    sys.exit(main())
