"""Reading and writing corpora, wide feature tables, word lists and predictions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from .csv_blocks import csv_records

RAW_SCHEMA = "id LONG, text STRING, sentiment STRING"
# What is written is read back as it was: blanks at the edges, empty texts (quoted) apart from
# nulls (nothing at all), and line ends of any kind inside quotes.
EXACT_CSV = {
    "header": True, "quote": '"', "escape": '"', "encoding": "UTF-8", "lineSep": "\n",
    "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False,
}
NULL_CELL = "\x00null\x00"  # stands for an unquoted empty cell while a file is read


def read_csv(spark: SparkSession, path: str, schema) -> DataFrame:
    """A CSV of quoted cells, which may hold commas, quotes and newlines; a large file is read by
    several tasks.  Each file begins with a header."""
    ddl = schema if isinstance(schema, str) else ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    options = {k: str(v).lower() if isinstance(v, bool) else v for k, v in EXACT_CSV.items() if k not in ("header", "encoding")}
    options |= {"multiLine": "true", "nullValue": NULL_CELL, "emptyValue": ""}
    records = csv_records(spark, path).where(~F.col("first") & (F.col("value") != ""))
    return records.select(F.from_csv("value", ddl, options).alias("r")).select("r.*")


def read_raw_csv(spark: SparkSession, path: str, schema: str = RAW_SCHEMA) -> DataFrame:
    """UTF-8 ``text, label`` CSV."""
    return read_csv(spark, path, schema)


def wide_schema(
    feature_names: Sequence[str], id_col="id", text_col="origText", label_col="classLabel"
) -> T.StructType:
    fields = [
        T.StructField(id_col, T.LongType()),
        T.StructField(text_col, T.StringType()),
        T.StructField(label_col, T.IntegerType()),
    ]
    return T.StructType(fields + [T.StructField(f, T.DoubleType()) for f in feature_names])


def read_feature_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Wide feature CSV: id, text, class label, then one column per feature."""
    return read_csv(spark, path, schema)


def unpivot_features(
    wide: DataFrame, id_cols: Sequence[str], features: Sequence[str], keep_zeros: bool = True
) -> DataFrame:
    """Wide columns to ``(ids, feature, value)`` rows; a narrow expand, no shuffle."""
    typed = wide.select(*id_cols, *[F.col(f).cast("double").alias(f) for f in features])
    rows = typed.unpivot(list(id_cols), list(features), "feature", "value")
    return rows if keep_zeros else rows.where(F.col("value") != 0)


def vector_features(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """Dense array rows to long ``(id, feature, value)``; features are 0-based positions."""
    return vectors.select(id_col, F.posexplode(vector_col).alias("feature", "value")).withColumn(
        "value", F.col("value").cast("double")
    )


def default_stopwords(language: str = "english") -> list[str]:
    return StopWordsRemover.loadDefaultStopWords(language)


def read_word_list(spark: SparkSession, path: str) -> DataFrame:
    """One word per line."""
    return (
        spark.read.text(path)
        .select(F.lower(F.trim("value")).alias("word"))
        .where(F.col("word") != "")
        .distinct()
    )


def write_csv(df: DataFrame, path: str) -> None:
    """CSV that ``read_csv`` reads back unchanged."""
    df.write.csv(path, nullValue="", emptyValue='""', **EXACT_CSV)


def write_results(labeled: DataFrame, predictions: DataFrame, path: str) -> None:
    """Every labeled row and every prediction for the rest, as two CSV tables."""
    write_csv(labeled, f"{path}/all_labeled_data")
    write_csv(predictions, f"{path}/all_unlabeled_data_predictions")
