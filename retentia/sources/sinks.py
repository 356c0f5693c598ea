"""Sinks and publication (O-02, O-04..O-11c).

Every job writes its tables under ``<base>/<table>/run_id=<id>/`` and, last,
a row for the run under ``<base>/_published``. Readers resolve the newest published run, so a
job that dies half-way never exposes partial outputs (Spark's overwrite alone is
not atomic across several tables)."""

from __future__ import annotations

import json
import os
import pickle
import uuid
from datetime import datetime, timezone

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .paths import exists, hadoop

PUBLISHED = "_published"
PROMOTIONS = "_promotions"
HISTORY = "drift_history"


def new_run_id() -> str:
    return datetime.now(timezone.utc).strftime("%Y%m%dT%H%M%S") + "_" + uuid.uuid4().hex[:8]


def table_path(base: str, name: str, run_id: str | None = None) -> str:
    p = os.path.join(base, name)
    return os.path.join(p, f"run_id={run_id}") if run_id else p


def write_table(df: DataFrame, base: str, name: str, run_id: str,
                partition_by: list[str] | None = None, cluster_by: list[str] | None = None) -> str:
    """Parquet under the run folder. With ``partition_by``, rows are first range
    partitioned by (partition columns, ``cluster_by``): each task then covers a
    contiguous slice of partition values, so the file count stays near the task
    count instead of tasks x partition values, and a hot partition value is still
    split across tasks by the cluster columns."""
    path = table_path(base, name, run_id)
    if partition_by:
        n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        df = df.repartitionByRange(n, *partition_by, *(cluster_by or []))
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def write_report_csv(df: DataFrame, base: str, name: str, run_id: str) -> str:
    """Small report tables: one CSV file with a header."""
    path = table_path(base, name + "_csv", run_id)
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)
    return path


def write_report_json(df: DataFrame, base: str, name: str, run_id: str) -> str:
    path = table_path(base, name + "_json", run_id)
    df.coalesce(1).write.mode("overwrite").json(path)
    return path


def publish_run(spark: SparkSession, base: str, run_id: str, job: str, tables: list[str]) -> None:
    """The commit point: one row naming the run and its tables."""
    rec = spark.createDataFrame(
        [(run_id, job, ",".join(tables), datetime.now(timezone.utc).isoformat())],
        "run_id string, job string, tables string, published_at string")
    _write_once(rec, os.path.join(base, PUBLISHED), f"{job}-{run_id}")


def _write_once(rows: DataFrame, path: str, key: str) -> None:
    """Rows of one run in a folder of their own: a run that is done again replaces its rows."""
    rows.write.mode("overwrite").parquet(os.path.join(path, f"run-{key}"))


def _read_runs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("recursiveFileLookup", True).option("mergeSchema", True).parquet(path)


def latest_run(spark: SparkSession, base: str, job: str) -> str:
    path = os.path.join(base, PUBLISHED)
    if not exists(spark, path):
        raise FileNotFoundError(f"No published run for job {job!r} under {base}")
    pub = _read_runs(spark, path).filter(F.col("job") == job)
    row = pub.agg(F.max_by("run_id", "published_at").alias("run_id")).first()
    if row is None or row["run_id"] is None:
        raise FileNotFoundError(f"No published run for job {job!r} under {base}")
    return row["run_id"]


def read_published(spark: SparkSession, base: str, name: str, job: str) -> DataFrame:
    return spark.read.parquet(table_path(base, name, latest_run(spark, base, job)))


def append_history(df: DataFrame, base: str, run_id: str, name: str = HISTORY) -> None:
    """Adds a run's rows, with its ``run_id``, or replaces them if the run is done again (O-08)."""
    _write_once(df.withColumn("run_id", F.lit(run_id)), table_path(base, name), run_id)


def load_history(spark: SparkSession, base: str, name: str = HISTORY) -> DataFrame | None:
    path = table_path(base, name)
    if not exists(spark, path):
        return None
    return _read_runs(spark, path)


# ------------------------------------------------------------------ models

def save_model(tm, base: str, run_id: str) -> str:
    """Fitted pipeline or trees + calibrator + feature list + metadata (O-10)."""
    from ..operators.models import BoostedModel
    path = os.path.join(base, "models", tm.name, f"run_id={run_id}")
    if isinstance(tm.model, BoostedModel):
        SparkSession.getActiveSession().createDataFrame([(pickle.dumps(tm.model),)], "model binary").coalesce(
            1).write.mode("overwrite").parquet(os.path.join(path, "boosted"))
    else:
        tm.model.write().overwrite().save(os.path.join(path, "pipeline"))
    cal = {"method": tm.calibrator.method, "a": tm.calibrator.a, "b": tm.calibrator.b}
    if tm.calibrator.iso is not None:
        tm.calibrator.iso.write().overwrite().save(os.path.join(path, "isotonic"))
    from ..operators.split import inference_contract
    meta = {"name": tm.name, "feature_cols": tm.feature_cols, "calibrator": cal, "metadata": tm.metadata,
            "inference_contract": inference_contract(tm.feature_cols)}
    spark = SparkSession.getActiveSession()
    spark.createDataFrame([(json.dumps(meta),)], "meta string").coalesce(1).write.mode("overwrite").json(
        os.path.join(path, "meta"))
    return path


def load_model(path: str):
    from pyspark.ml.regression import IsotonicRegressionModel
    from ..operators.models import Calibrator, TrainedModel
    spark = SparkSession.getActiveSession()
    meta = json.loads(spark.read.json(os.path.join(path, "meta")).first()["meta"])
    cal = Calibrator(meta["calibrator"]["method"], meta["calibrator"]["a"], meta["calibrator"]["b"])
    if cal.method == "isotonic":
        cal.iso = IsotonicRegressionModel.load(os.path.join(path, "isotonic"))
    boosted = os.path.join(path, "boosted")
    model = (pickle.loads(spark.read.parquet(boosted).first()["model"]) if exists(spark, boosted)
             else PipelineModel.load(os.path.join(path, "pipeline")))
    return TrainedModel(meta["name"], model, cal, meta["feature_cols"], meta["metadata"])


def newest_model(spark: SparkSession, base: str, name: str) -> str:
    """The saved model of a family with the greatest run id (run ids begin with their time)."""
    fs, folder = hadoop(spark, os.path.join(base, "models", name))
    runs = [str(s.getPath()) for s in fs.listStatus(folder)] if fs.exists(folder) else []
    if not runs:
        raise FileNotFoundError(f"No saved {name} model under {base}")
    return max(runs)


def write_promotion(spark: SparkSession, base: str, model_name: str, model_path: str,
                    metric_name: str, metric_value: float) -> None:
    """Promotion pointer (O-11), append-only; the newest row wins."""
    rec = spark.createDataFrame(
        [(model_name, model_path, metric_name, float(metric_value), datetime.now(timezone.utc).isoformat())],
        "model string, model_path string, metric_name string, metric_value double, promoted_at string")
    rec.write.mode("append").parquet(os.path.join(base, PROMOTIONS))


def resolve_champion(spark: SparkSession, base: str, default_model: str = "logistic_regression") -> dict:
    path = os.path.join(base, PROMOTIONS)
    if not exists(spark, path):
        return {"model": default_model, "model_path": None, "source": "default"}
    p = spark.read.parquet(path)
    row = p.agg(F.max_by(F.struct("model", "model_path", "metric_name", "metric_value", "promoted_at"),
                         "promoted_at").alias("r")).first()["r"]
    if row is None:
        return {"model": default_model, "model_path": None, "source": "default"}
    if row["model_path"] and not exists(spark, row["model_path"]):
        raise FileNotFoundError(f"Promoted model path does not exist: {row['model_path']}")
    return {**row.asDict(), "source": "promotion"}


def run_log(metrics: DataFrame, run_id: str, id_cols: list[str], metric_cols: list[str],
            step_col: str | None = None) -> DataFrame:
    """Long run-log table (run_id, ids..., metric, step, value) from a wide metric
    table with ``unpivot`` -- the run-tracking log as data, appended per run (O-11c)."""
    ids = list(id_cols) + ([step_col] if step_col else [])
    long = metrics.select(*ids, *[F.col(c).cast("double").alias(c) for c in metric_cols]).unpivot(
        ids, metric_cols, "metric", "value")
    step = F.round(F.col(step_col) * 100).cast("int") if step_col else F.lit(0)
    return long.select(F.lit(run_id).alias("run_id"), *id_cols, "metric", step.alias("step"), "value")
