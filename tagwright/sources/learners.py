"""Saving and restoring a learner: labeled rows, metrics and model, keyed by class name."""

from __future__ import annotations

import json
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

SAVES = "number LONG, version STRING, document STRING"


def _last_save(spark: SparkSession, home: str):
    try:
        return spark.read.schema(SAVES).json(f"{home}/saves").orderBy(F.desc("number"), F.desc("version")).first()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def save_learner(
    path: str, class_name: str, labeled: DataFrame, model: DataFrame, metrics: dict, naive_bayes: bool, **more
) -> None:
    """Labeled rows and model as Parquet in a new folder, the rest as one JSON document.

    Nothing is overwritten: a line appended at the end of the save names the folder, so a save
    that breaks off leaves the one before, and tables loaded earlier can still be read."""
    spark, home, version = labeled.sparkSession, f"{path}/{class_name}", uuid.uuid4().hex
    labeled.write.parquet(f"{home}/{version}/labeled")
    model.write.parquet(f"{home}/{version}/model")
    last = _last_save(spark, home)
    document = json.dumps({"metrics": metrics, "naive_bayes": naive_bayes, **more}, sort_keys=True)
    row = ((last["number"] if last else 0) + 1, version, document)
    spark.createDataFrame([row], SAVES).coalesce(1).write.mode("append").json(f"{home}/saves")


def load_learner(spark: SparkSession, path: str, class_name: str) -> dict | None:
    """The parts of the last save, or None with a note if this learner was never saved."""
    home = f"{path}/{class_name}"
    last = _last_save(spark, home)
    if last is None:
        print(f"Note: {class_name} learner does not exist yet")
        return None
    return {
        "labeled": spark.read.parquet(f"{home}/{last['version']}/labeled"),
        "model": spark.read.parquet(f"{home}/{last['version']}/model"),
        **json.loads(last["document"]),
    }


def prepend_saved(saved_rows: DataFrame, pool: DataFrame, id_col: str = "id") -> DataFrame:
    """Saved rows that the pool does not hold yet, followed by the pool."""
    missing = saved_rows.join(pool.select(id_col), id_col, "left_anti")
    return missing.unionByName(pool)
