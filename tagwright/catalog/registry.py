"""Where registered queries and their check SQL are kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rounded(column, digits: int = 6):
    """Rounded value without negative zero."""
    column = F.col(column) if isinstance(column, str) else column
    return F.round(column, digits) + F.lit(0.0)


def sql_list(words) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


def labeled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as (id, classLabel, origText); classLabel is null without a label."""
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("classLabel"))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return docs.join(labels, "doc_id", "left").select(
        F.col("doc_id").alias("id"), "classLabel", F.col("text").alias("origText")
    )


LABELED_DOCS = """ld AS (SELECT d.doc_id AS id, l.quality AS classLabel, d.text AS origText
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("label").alias("classLabel"),
        F.col("embedding").cast("array<double>").alias("vec"),
    )
