"""Sinks and sources between stages: feature Parquet, result CSV, run records, models."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbline.session import stage

METRIC_FIELDS = ("auc", "pr_auc", "precision", "recall", "f1", "top_10pct_churn_recall", "positive_rate")

METRICS_SCHEMA = T.StructType(
    [T.StructField("model", T.StringType()), T.StructField("split", T.StringType())]
    + [T.StructField(name, T.DoubleType()) for name in METRIC_FIELDS]
)
PREDICTION_SCHEMA = T.StructType(
    [
        T.StructField("client_id", T.LongType()),
        T.StructField("snapshot_date", T.DateType()),
        T.StructField("y_true", T.IntegerType()),
        T.StructField("y_score", T.DoubleType()),
        T.StructField("y_pred", T.IntegerType()),
        T.StructField("error_type", T.StringType()),
    ]
)
RUN_RECORD_SCHEMA = T.StructType(
    [
        T.StructField("dataset_root", T.StringType()),
        T.StructField("observation_days", T.LongType()),
        T.StructField("label_days", T.LongType()),
        T.StructField("window_days", T.ArrayType(T.LongType())),
        T.StructField("snapshot_step_days", T.LongType()),
        T.StructField("max_snapshots", T.LongType()),
        T.StructField("sample_frac", T.DoubleType()),
        T.StructField("snapshot_count", T.LongType()),
        T.StructField("row_count", T.LongType()),
        T.StructField("feature_count", T.LongType()),
        T.StructField("active_user_definition", T.StringType()),
        T.StructField("active_user_definition_detail", T.StringType()),
        T.StructField("churn_definition", T.StringType()),
        T.StructField("churn_definition_detail", T.StringType()),
    ]
)


def write_feature_table(table: DataFrame, path: str) -> None:
    """ZSTD Parquet in one folder per snapshot, so that splits and folds read only their folders.

    The rebalance lets adaptive execution split large snapshots over tasks and merge small ones.
    """
    balanced = table.hint("rebalance", F.col("snapshot_date"))
    balanced.write.mode("overwrite").option("compression", "zstd").partitionBy("snapshot_date").parquet(path)


def read_feature_table(spark: SparkSession, path: str) -> DataFrame:
    table = spark.read.parquet(path)
    return table.withColumn("snapshot_date", F.col("snapshot_date").cast("date"))


def rewrite_snapshots(spark: SparkSession, path: str, change: Callable[[DataFrame], DataFrame], dates: list[dt.date]) -> None:
    """Replace the rows of the given snapshots of a stored feature table by ``change`` of them. Only their folders are read and written; the
    changed rows are staged first, because a folder that is read can't be overwritten. A snapshot that ``change`` leaves without rows is kept."""
    table = read_feature_table(spark, path)
    changed = stage(change(table.filter(F.col("snapshot_date").isin(dates))), "rewritten").select(table.columns)
    balanced = changed.hint("rebalance", F.col("snapshot_date"))
    balanced.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy("snapshot_date").parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


BAD_LINE = "_bad_line"


def read_csv_checked(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Rows of ``schema`` and ``_bad_line``: the text of a line that does not fit the schema, whose columns are NULL where they can't be
    read. Lines are told apart by whether they fit, so a NULL in a good line is a missing value. The parsed rows are staged: a parser that
    is asked for fewer columns would find other lines good."""
    with_line = T.StructType([*schema.fields, T.StructField(BAD_LINE, T.StringType())])
    reader = spark.read.schema(with_line).option("header", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", BAD_LINE)
    return stage(reader.csv(path), "checked")


def line_counts(checked: DataFrame) -> DataFrame:
    """Good and bad lines of ``read_csv_checked``."""
    return checked.agg(F.count_if(F.col(BAD_LINE).isNull()).alias("n_good"), F.count_if(F.col(BAD_LINE).isNotNull()).alias("n_bad"))


def write_record(record: DataFrame, path: str) -> None:
    record.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def read_record(spark: SparkSession, path: str, schema: T.StructType = RUN_RECORD_SCHEMA) -> DataFrame:
    return spark.read.schema(schema).json(path)


def save_model(model, path: str) -> None:
    model.write().overwrite().save(path)
