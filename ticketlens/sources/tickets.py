"""Ticket schemas, the CSV/Parquet scans, column policy and request validation."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TICKET_FIELDS = ("subject", "body", "queue", "priority", "language", "version")
TICKET_SCHEMA = T.StructType([T.StructField(name, T.StringType(), True) for name in TICKET_FIELDS])

REQUEST_SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType(), True),
        T.StructField("subject", T.StringType(), True),
        T.StructField("body", T.StringType(), True),
        T.StructField("language", T.StringType(), True),
    ]
)


def read_tickets_csv(spark: SparkSession, path: str, schema: T.StructType = TICKET_SCHEMA) -> DataFrame:
    """Header CSV with quoted multi-line bodies; explicit schema, never inferred."""
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("multiLine", True)
        .option("escape", '"')
        .option("mode", "FAILFAST")
        .csv(path)
    )


def read_tickets(spark: SparkSession, path: str, schema: T.StructType = TICKET_SCHEMA) -> DataFrame:
    """Parquet tickets, whose files need not have the same columns.

    The given schema decides: a column that a file lacks is null for its rows, one
    that the schema lacks is not read. A folder in which no file has the body is an
    error at plan time; a file without it beside others fails the query.
    """
    held = spark.read.option("mergeSchema", True).parquet(path)
    require_columns(held, ("body",))
    rows = spark.read.schema(schema).parquet(path)
    file = F.col("_metadata.file_path")
    without = rows.groupBy(file.alias("file")).agg(F.count("body").alias("n"), F.count(F.lit(1)).alias("rows")).where("n = 0 and rows > 0")
    names = without.orderBy("file").limit(20).agg(F.array_join(F.array_sort(F.collect_list("file")), ", ")).scalar()
    body = F.when(names != "", F.raise_error(F.concat(F.lit("files without a body: "), names)).cast("string")).otherwise(F.col("body"))
    return rows.withColumn("body", body)


def write_tickets_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def require_columns(df: DataFrame, required=("body",), what: str = "text column") -> None:
    """Plan-time check: a missing required column is a KeyError naming it."""
    missing = [name for name in required if name not in df.columns]
    if missing:
        raise KeyError(f"no {what} named {', '.join(missing)}")


def with_optional_columns(df: DataFrame, subject: str = "subject", language: str = "language") -> DataFrame:
    """Absent subject → null text (read as ''), absent language → null (read as unknown)."""
    out = df
    if subject not in out.columns:
        out = out.withColumn(subject, F.lit(None).cast("string"))
    if language not in out.columns:
        out = out.withColumn(language, F.lit(None).cast("string"))
    return out


def validate_requests(df: DataFrame) -> DataFrame:
    """Tag each request row: subject and body must hold at least one character.

    Returns the rows with ``accepted`` and ``reason``; callers split on
    ``accepted`` (one pass, no second scan of the source).
    """
    out = with_optional_columns(df)
    if "body" not in out.columns:
        out = out.withColumn("body", F.lit(None).cast("string"))
    reason = (
        F.when(F.col("subject").isNull(), F.lit("missing subject"))
        .when(F.length("subject") < 1, F.lit("empty subject"))
        .when(F.col("body").isNull(), F.lit("missing body"))
        .when(F.length("body") < 1, F.lit("empty body"))
    )
    return out.withColumn("reason", reason).withColumn("accepted", F.col("reason").isNull())


def dataset_profile(df: DataFrame, path: str) -> DataFrame:
    """Dataset id (stem of the given path), path and row count: one row, however many files lie there."""
    stem = re.sub(r"\.[^./]*$", "", path.rstrip("/").rsplit("/", 1)[-1])
    return df.agg(F.count(F.lit(1)).alias("dataset_row_count")).select(
        F.lit(stem).alias("dataset_id"), F.lit(path).alias("dataset_path"), "dataset_row_count"
    )


def file_row_counts(df: DataFrame) -> DataFrame:
    """Rows of each input file of a dataset."""
    return df.groupBy(F.col("_metadata.file_path").alias("file_path")).agg(F.count(F.lit(1)).alias("row_count"))
