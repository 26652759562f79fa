"""Sweep states, evaluation reports and monitor lines as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

JOB = "struct<id:string,overrides:map<string,string>,seed:bigint,status:string,attempts:int,worker:string,returncode:int,train_loss:double,task_mean:double,error:string>"


def sweep_jobs(spark: SparkSession, path: str) -> DataFrame:
    """One row per job of sweep state files."""
    state = spark.read.text(path, wholetext=True).select(F.from_json("value", f"sweep string, jobs map<string,{JOB}>").alias("s"))
    return state.select("s.sweep", F.explode("s.jobs").alias("job_id", "job")).select("sweep", "job_id", "job.*")


def with_reports(jobs: DataFrame, reports: DataFrame) -> DataFrame:
    """Jobs with the task mean of their report where the state has none; a mean of 0 is a mean."""
    r = reports.select(F.col("job_id"), F.col("task_mean").alias("_reported"))
    return jobs.join(r, "job_id", "left").withColumn("task_mean", F.coalesce("task_mean", "_reported")).drop("_reported")


def last_loss(log: DataFrame, key: str, text: str) -> DataFrame:
    """The last train_loss= of a log, nan and inf included; none gives null."""
    found = F.regexp_extract_all(text, F.lit(r"train_loss['\"]?[=:]\s*([+-]?(?:nan|inf|\d+(?:\.\d+)?(?:[eE][+-]?\d+)?))"), F.lit(1))
    return log.select(key, F.try_element_at(found, F.lit(-1)).cast("double").alias("train_loss"))


def gpu_rows(lines: DataFrame, fields: list[str]) -> DataFrame:
    """Comma-separated monitor lines as named columns; short rows are filled with empty text."""
    p = F.split("value", ",")
    return lines.where(F.trim("value") != "").select(*[F.coalesce(F.trim(F.get(p, F.lit(i))), F.lit("")).alias(f) for i, f in enumerate(fields)])
