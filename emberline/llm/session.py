"""What every training-data operator needs from the session: tables and a shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, from ``spark.checkpoint.dir``.

    Only a local session that names none (tests, a laptop) gets a temporary folder of its own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    base = base or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="spark-shared-")
        spark.sparkContext.setCheckpointDir(base)
        base = f"file://{base}"
    return base


def save(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write ``df`` once to the shared folder and return the written table.

    A lost executor then costs a read, never a recomputation of what led here.
    """
    path = f"{shared_folder(df.sparkSession)}/tables/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores added until ``df`` has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def crc32_of_id(doc_id="doc_id"):
    """CRC-32 of the id written in decimal: what splits rows into learning and held-out rows."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary"))


def utf8_bytes(text="text"):
    return F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("long")
