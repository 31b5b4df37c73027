"""Joins to a table that is unique on the key, safe against hot and null keys."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import partial

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from hazardlens.session import shared_folder

_STAGING: set[str] = set()


def lookup_join(
    left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "left", spread: str | None = None
) -> DataFrame:
    """``left`` joined to ``right``, which has at most one row per key.

    Whether a side is broadcast and where a hot key of the left side is split is left
    to the engine, which knows the sizes when it runs; nothing runs while the plan is
    built, and only the columns that are used are read. ``spread`` names a column that
    tells the left rows without a key apart: they match nothing, so they are dealt by
    its value and do not meet in one task.
    """
    on = list(on)
    if spread is None:
        return left.join(right, on, how)
    null_key = F.lit(False)
    for name in on:
        null_key = null_key | F.col(name).isNull()
    dealt = left.withColumn("_spread", F.when(null_key, F.xxhash64(spread)).otherwise(0))
    return dealt.join(right.withColumn("_spread", F.lit(0).cast("bigint")), [*on, "_spread"], how).drop("_spread")


def left_join_many(left: DataFrame, many: DataFrame, on: Sequence[str]) -> DataFrame:
    """``left``, unique on the key, with every matching row of ``many`` or with nulls.

    The engine cannot split a hot key on the right of a left join, but on either side of
    an inner one; so the matches are joined there, and the rest of ``left`` is added.
    """
    on = list(on)
    matched = many.join(left, on)
    lonely = left.join(many.select(*on).distinct(), on, "left_anti")
    return matched.unionByName(lonely, allowMissingColumns=True)


def staging_path(spark: SparkSession) -> str:
    """A new name below the shared folder, in a folder of this application that goes when its driver ends."""
    root = f"{shared_folder(spark)}/staged/{spark.sparkContext.applicationId}"
    if root not in _STAGING:
        path = spark._jvm.org.apache.hadoop.fs.Path(root)
        files = path.getFileSystem(spark._jsc.hadoopConfiguration())
        files.mkdirs(path)
        files.deleteOnExit(path)
        _STAGING.add(root)
    return f"{root}/{uuid.uuid4().hex}"


def staged(df: DataFrame) -> DataFrame:
    """The table written once to the shared folder and read back.

    For a result that several steps of one plan read: it is computed once, keeps its
    size for the optimizer and survives the loss of an executor.
    """
    path = staging_path(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def at_once(spark: SparkSession, jobs: Sequence[Callable]) -> list:
    """The results of jobs that do not wait for each other, run at the same time.

    A job has as many tasks as its input has parts, often fewer than there are cores; one
    after another they would leave the rest idle. If one fails, all have ended before its
    error is raised.
    """
    with ThreadPoolExecutor(max(1, len(jobs))) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]
    return [job.result() for job in running]


def staged_together(*tables: DataFrame) -> list[DataFrame]:
    """``staged`` for several tables, written at the same time."""
    return at_once(tables[0].sparkSession, [partial(staged, table) for table in tables])


def staged_and_measured(df: DataFrame, **measures: Column) -> tuple[DataFrame, dict]:
    """``staged``, with aggregates over the rows taken by the pass that writes them."""
    seen = Observation(uuid.uuid4().hex)
    written = staged(df.observe(seen, *(c.alias(n) for n, c in measures.items())))
    return written, dict(seen.get)
