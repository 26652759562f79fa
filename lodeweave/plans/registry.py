"""All registered queries of the core, gathered from the plan modules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lodeweave.plans import building, citations, context, dataset, evaluation, facts, history, linking, orphans, retrieval

MODULES = [orphans, retrieval, linking, citations, facts, building, context, dataset, history, evaluation]


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retrieval.rt_hybrid(spark, sf_dir)


def queries() -> dict:
    return {name: fn for m in MODULES for name, fn in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in MODULES for name, sql in m.SQL.items()}
