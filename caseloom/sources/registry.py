"""Stored models with their metrics, and the audit trail."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseloom.operators.forecast import Model, Trained, load_model, save_model
from caseloom.schemas import AUDIT, HOLDOUT_FORECASTS, MODEL_METRICS, MODEL_REGISTRY
from caseloom.sources import files


class ModelRegistry:
    """``models/<name>/<time>`` folders plus three append-only tables, ``holdout``, ``metrics`` and ``registry``.

    A model is written first, its metrics next and its registry row last, so a listed model is
    always complete.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def _table(self, name: str, schema: T.StructType) -> DataFrame:
        path = f"{self.root}/{name}"
        if not files.exists(self.spark, path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(path)

    def _append(self, name: str, row: tuple, schema: T.StructType) -> None:
        self.spark.createDataFrame([row], schema).coalesce(1).write.mode("append").parquet(f"{self.root}/{name}")

    def registry(self) -> DataFrame:
        return self._table("registry", MODEL_REGISTRY)

    def metrics(self) -> DataFrame:
        return self._table("metrics", MODEL_METRICS)

    def holdout(self) -> DataFrame:
        """The forecasts of the holdout days that a model's errors were computed from."""
        return self._table("holdout", HOLDOUT_FORECASTS)

    def publish(self, name: str, trained: Trained, created_at: datetime) -> str:
        path = f"{self.root}/models/{name}/{created_at:%Y%m%dT%H%M%S%f}"
        save_model(trained.model, path)
        if trained.holdout:
            rows = [(name, created_at, day, float(y), yhat) for day, y, yhat in trained.holdout]
            self.spark.createDataFrame(rows, HOLDOUT_FORECASTS).coalesce(1).write.mode("append").parquet(f"{self.root}/holdout")
        row = (name, created_at, trained.mae, trained.rmse, trained.training_rows)
        self._append("metrics", row, MODEL_METRICS)
        self._append("registry", (name, created_at, path), MODEL_REGISTRY)
        return path

    def latest_row(self, name: str) -> DataFrame:
        return self.registry().where(F.col("model_name") == name).orderBy(F.desc("created_at")).limit(1)

    def load_latest(self, name: str) -> Model | None:
        """The newest model of that name; None if there is none."""
        row = self.latest_row(name).first()
        return None if row is None else load_model(self.spark, row["path"])

    def names(self) -> list[str]:
        return [r["model_name"] for r in self.registry().select("model_name").distinct().orderBy("model_name").collect()]


# ---------------------------------------------------------------- audit
def append_audit(records: DataFrame, path: str) -> None:
    """Append run records, one folder per day of ``ts``."""
    rows = records.select(*AUDIT.names).withColumn("day", F.to_date("ts"))
    rows.hint("rebalance", "day").write.mode("append").partitionBy("day").parquet(path)


def audit_record(spark: SparkSession, records: Iterable[tuple]) -> DataFrame:
    """Run records from the driver: (ts, flow, task, status, logical_date, log_url, error)."""
    rows = spark.createDataFrame(list(records), AUDIT)
    failed = F.col("status") == "FAILED"
    return rows.withColumn("error_message", F.when(failed, F.col("error_message")).otherwise(""))


def read_audit(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(AUDIT).parquet(path)


def error_log(audit: DataFrame) -> DataFrame:
    return audit.where("status = 'FAILED'").select(
        "ts", "flow", "task", "log_url", F.col("error_message").alias("error_details")
    )
