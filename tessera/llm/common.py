"""Helpers shared by the training-data operators: staged tables and words."""

from __future__ import annotations

import os
import sys
import tempfile
import types
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# --- fixed values: word separators of every word rule here ---------------------
SPACE_CLASS = r"[\x20\x09-\x0D]+"


def shared_dir(spark: SparkSession) -> str:
    """Folder that driver and executors share: ``spark.checkpoint.dir``.

    Only a local master may go without the setting; it then gets a scratch
    folder.  A cluster without a shared folder is an error."""
    sc = spark.sparkContext
    folder = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if folder:
        return folder
    if not (sc.master == "local" or sc.master.startswith("local[")):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="tessera-stage-"))
    return sc.getCheckpointDir()


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared folder and read it back.

    The result has no lineage beyond the files, so it is computed once, ids
    made while writing stay the same, and a lost executor costs nothing."""
    spark = df.sparkSession
    path = os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex}")
    schema = df.schema
    df.write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def kept_by_worker(name: str, make: Callable[[], object]) -> object:
    """What ``make`` gives, made once in a Python worker and kept for its later
    tasks.  Functions come to a worker with every task anew, so it is kept
    under a module name of its own; it must not grow without bound."""
    held = sys.modules.setdefault("tessera_worker_state", types.ModuleType("tessera_worker_state")).__dict__
    if name not in held:
        held[name] = make()
    return held[name]


def words(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of ``text``, unchanged; null gives none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE_CLASS), "")


def text_key(text: Column) -> Column:
    """Hash that, next to its id, tells a document's text (null as empty)."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def lower_ascii(text: Column) -> Column:
    """``text`` with A-Z lower-cased and nothing else changed."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
