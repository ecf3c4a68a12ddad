"""Reading the tables of a folder, by name and in SQL."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession

from .linkage_sql import TABLES


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def run_sql(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """A query over the folder's tables, under view names of its own so that folders don't mix."""
    tag = uuid.uuid4().hex[:8]
    for t in TABLES:
        if re.search(rf"\b{t}\b", sql):
            table(spark, sf_dir, t).createOrReplaceTempView(f"{t}_{tag}")
            sql = re.sub(rf"\b(FROM|JOIN)\s+{t}\b", rf"\1 {t}_{tag}", sql)
    return spark.sql(sql)
