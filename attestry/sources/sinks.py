"""Sinks: partitioned tables of artefacts and the JSON read model."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_artifact(df: DataFrame, path: str, artifact: str) -> None:
    """A Parquet table partitioned by the artefact it belongs to."""
    df.withColumn("artifact_id", F.lit(artifact)).write.mode("append").partitionBy("artifact_id").parquet(path)


def write_read_model(df: DataFrame, path: str) -> None:
    """One JSON document a row, NULLs kept."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)
