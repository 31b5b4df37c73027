"""Intermediate tables in the shared folder, so that a lost executor costs one task and not the run."""

from __future__ import annotations

from pyspark.sql import DataFrame

from hazardlens.operators.joins import staging_path


def staged(df: DataFrame) -> DataFrame:
    """The table written once to the folder in ``spark.checkpoint.dir`` and read back."""
    path = staging_path(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
