"""Tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

_written: dict[tuple[str, str, str], tuple[str, object]] = {}


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; only a local session that names none gets a temporary folder."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="spark-shared-")
        spark.sparkContext.setCheckpointDir(base)
        base = f"file://{base}"
    return base


def save(df: DataFrame, name: str) -> DataFrame:
    """Written to the shared folder and read back: a lost executor then costs a read only."""
    path = f"{shared_folder(df.sparkSession)}/tables/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def once(spark: SparkSession, sf_dir: str, name: str, make: Callable[[], DataFrame]) -> DataFrame:
    """The table ``name`` over the input folder ``sf_dir``, written by the first query of an application that needs it."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _written:
        df = make()
        path = f"{shared_folder(spark)}/tables/{name}-{uuid.uuid4().hex}"
        df.write.parquet(path)
        _written[key] = (path, df.schema)
    path, schema = _written[key]
    return spark.read.schema(schema).parquet(path)
