"""Writing tables, and the one place that decides where intermediate tables may go."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"
#: Shuffle files go when the write that made them ends, not when the driver happens to collect its garbage.
CLEANUP_KEY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def scratch_dir(spark: SparkSession) -> str:
    """A new path in the shared folder named by ``spark.checkpoint.dir``.

    Where it is unset, a folder in the warehouse serves, which all executors share too.
    """
    shared = spark.conf.get(CHECKPOINT_KEY, None) or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    return f"{shared.rstrip('/')}/{uuid.uuid4().hex}"


def save(df: DataFrame, path: str, by: Sequence[str]) -> None:
    """Partitioned Parquet.

    ``rebalance`` brings the rows of one partition value together so that a value
    does not end up in one small file per task, and lets the adaptive planner cut
    a value that holds a large part of the table into several files.
    """
    df.hint("rebalance", *by).write.partitionBy(*by).parquet(path)


def stage(df: DataFrame) -> DataFrame:
    """The same rows, written once to the shared folder and read back.

    For a result that several later steps read: it is computed once, its size is
    known to the planner, and a lost executor costs no recomputation. The files stay
    in the folder named by ``spark.checkpoint.dir`` until its owner clears it.
    """
    return stage_all([df])


def stage_all(parts: Iterable[DataFrame]) -> DataFrame:
    """The rows of all ``parts``, which have one schema, each written like :func:`stage` before the next is asked for.

    A write's shuffle files go with it, so no more than one part's shuffles are on disk at a time.
    """
    path, paths = None, []
    for df in parts:
        spark, schema = df.sparkSession, df.schema
        path = path or scratch_dir(spark)
        paths.append(f"{path}/{len(paths)}")
        before = spark.conf.get(CLEANUP_KEY, None)
        spark.conf.set(CLEANUP_KEY, "true")
        try:
            df.write.parquet(paths[-1])
        finally:
            if before is None:
                spark.conf.unset(CLEANUP_KEY)
            else:
                spark.conf.set(CLEANUP_KEY, before)
    return spark.read.schema(schema).parquet(*paths)
