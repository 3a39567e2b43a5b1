"""Helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ticketlens.session import scratch_path
from ticketlens.sources.tables import table

__all__ = ["NULL_ID", "partitions", "table", "written"]

#: Stands for a null id where ids are compared: after every other id.
NULL_ID = 2**63 - 1


def partitions(spark: SparkSession) -> int:
    """The cluster's number of shuffle partitions (grows with the data it is set for)."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a Parquet table in the shared checkpoint folder.

    Cuts the lineage: lost executors cost no recomputation beyond one task,
    and a costly input is computed once however often it is read.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
