"""Keyed tables written as commits and merged on read.

Each micro-batch writes its rows as one commit and rewrites only that commit
when it is replayed.  A reader takes the newest commit per key, so an upsert
never reads or rewrites what is already stored.  ``compact`` folds commits into
one when the reader should have less to merge.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from touchline.operators.dedup import RANK, top_rows

COMMIT = "commit"


def commit_id(generation: int, batch_id: int) -> str:
    """Sorts by generation, then batch; no clock decides which write is newer."""
    return f"{generation:08d}-{batch_id:012d}"


def generation(spark: SparkSession, checkpoint: str, paths: Sequence[str]) -> int:
    """The number of the query run that ``checkpoint`` belongs to.

    A new checkpoint counts batches from 0 again, so it gets the number after
    the newest one in the tables it writes to, and keeps it beside its state.
    """
    marker = f"{checkpoint}/generation"
    try:
        return spark.read.schema("number bigint").parquet(marker).first()[0]
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
    number = 1 + max((_newest(spark, path) for path in paths), default=-1)
    spark.range(1).select(F.lit(number).cast("bigint").alias("number")).write.parquet(marker)
    return number


def _newest(spark: SparkSession, path: str) -> int:
    try:
        newest = spark.read.schema(f"{COMMIT} string").parquet(path).agg(F.max(COMMIT)).first()[0]
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        newest = None
    return -1 if newest is None else int(newest.split("-")[0])


def write_commit(
    rows: DataFrame,
    path: str,
    commit: str,
    partition_by: Sequence[str] = (),
    rebalance: bool = False,
) -> None:
    """Write ``rows`` as ``commit``, replacing what an earlier attempt left.

    A micro-batch lies in one or two hours and is written as it is spread.
    ``rebalance`` shuffles rows of many partitions so that each one gets few
    files and a large one is split.
    """
    if rebalance and partition_by:
        rows = rows.hint("rebalance", *partition_by)
    (
        rows.withColumn(COMMIT, F.lit(commit))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by, COMMIT)
        .parquet(path)
    )


def read_commits(spark: SparkSession, paths: Sequence[str], schema: T.StructType) -> DataFrame:
    full = T.StructType([*schema.fields, T.StructField(COMMIT, T.StringType())])
    frames = [spark.read.schema(full).parquet(path) for path in paths]
    rows = frames[0]
    for frame in frames[1:]:
        rows = rows.unionByName(frame)
    return rows


def read_latest(
    spark: SparkSession, paths: Sequence[str], schema: T.StructType, keys: Sequence[str]
) -> DataFrame:
    """The newest row per key over one or more commit folders."""
    rows = top_rows(read_commits(spark, paths, schema), keys, [F.desc(COMMIT)])
    return rows.drop(RANK, COMMIT)


def compact(
    spark: SparkSession,
    paths: Sequence[str],
    schema: T.StructType,
    keys: Sequence[str],
    target: str,
    partition_by: Sequence[str] = (),
    read: Callable[..., DataFrame] | None = None,
) -> None:
    """Write the newest row per key to the new folder ``target`` as one commit.

    The commit carries the newest id it contains, so ``[target, *paths]`` reads
    the same as ``paths`` and later commits still win.  ``read`` replaces the
    rule of which rows are kept.
    """
    newest = read_commits(spark, paths, schema).agg(F.max(COMMIT)).first()[0]
    if newest is not None:
        rows = read(spark, *paths) if read else read_latest(spark, paths, schema, keys)
        write_commit(rows, target, newest, partition_by, rebalance=True)


def merge_into(rows: DataFrame, table: str, keys: Sequence[str]) -> None:
    """Upsert into a catalog table whose format supports MERGE.

    Needs such a format on the classpath; ``rows`` must be unique by ``keys``.
    """
    view = f"upsert_{uuid.uuid4().hex}"
    rows.createOrReplaceTempView(view)
    match = " AND ".join(f"target.`{k}` <=> source.`{k}`" for k in keys)
    try:
        rows.sparkSession.sql(
            f"MERGE INTO {table} AS target USING {view} AS source ON {match} "
            "WHEN MATCHED THEN UPDATE SET * WHEN NOT MATCHED THEN INSERT *"
        )
    finally:
        rows.sparkSession.catalog.dropTempView(view)
