"""Parquet table reader for the driver's test tables.

Only ``spark.read.parquet`` -- column pruning and predicate pushdown into the
scan come from Catalyst as long as callers select/filter declaratively.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(table_path(sf_dir, name))


class Tables:
    """Attribute access to the tables of one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def dealt(self, name: str, key: str, *columns: str) -> DataFrame:
        """``key`` and ``columns`` of a table, dealt out by ``key``: the test
        tables are single files with one row group, hence one input task."""
        return read_table(self.spark, self.sf_dir, name).select(key, *columns).repartition(F.col(key))

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return read_table(self.spark, self.sf_dir, name)
        raise AttributeError(name)
