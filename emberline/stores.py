"""Stores of dated rows: Parquet tables partitioned by month, written so that a job that is run again leaves the same table."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import IntegerType, StringType, StructType

from .storage import save, shared_folder


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/stores/{name}-{uuid.uuid4().hex}"


def month_of(date: str | Column) -> Column:
    return F.substring(date, 1, 7)


class Store:
    """Rows with a column ``date`` ('yyyy-MM-dd') in the folder ``path``, partitioned by month and batch.

    A batch overwrites its own partitions only, so that the same batch written again changes nothing. What one batch holds must not depend on when
    it is run: callers take it from the batches before it, and from its own rows."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType, date: str = "acq_date"):
        self.spark, self.path, self.date = spark, path, date
        self.columns = [f.name for f in schema.fields]
        self.schema = StructType(schema.fields[:]).add("month", StringType()).add("batch", IntegerType())
        spark.createDataFrame([], self.schema).write.mode("append").partitionBy("month", "batch").parquet(path)  # the folder exists from now on

    def rows(self, before: int | None = None, months: list[str] | None = None) -> DataFrame:
        """All rows with ``batch``, of batches ``before`` one and of ``months``; other partitions aren't read."""
        out = self.spark.read.schema(self.schema).parquet(self.path)
        out = out if before is None else out.where(F.col("batch") < before)
        return (out if months is None else out.where(F.col("month").isin(months))).select(*self.columns, "batch")

    def write(self, rows: DataFrame, batch: int) -> None:
        dated = rows.select(*self.columns).withColumn("month", month_of(self.date)).withColumn("batch", F.lit(batch))
        self._overwrite(dated)

    def append(self, rows: DataFrame, batch: int, key: list[str]) -> None:
        """``rows`` whose key no earlier batch holds, each key once. Only the months of ``rows`` are read."""
        months = [r[0] for r in rows.select(month_of(self.date)).distinct().collect()]  # a few: those of one batch
        stored = self.rows(batch, months).select(*key)
        self.write(rows.dropDuplicates(key).join(stored, key, "left_anti"), batch)

    def replace(self, first: str, last: str, rows: DataFrame, batch: int) -> None:
        """The rows of ``first`` to ``last`` are exactly ``rows`` afterwards; other dates stay as they are. Run again, it writes the same."""
        inside = F.col(self.date).between(first, last)
        months = [r[0] for r in self.spark.sql(f"SELECT explode(sequence(trunc(DATE '{first}', 'MM'), DATE '{last}', INTERVAL 1 MONTH)) AS m").select(F.date_format("m", "yyyy-MM")).collect()]
        held = self.spark.read.schema(self.schema).parquet(self.path).where(F.col("month").isin(months))
        new = rows.select(*self.columns).where(inside).withColumn("month", month_of(self.date)).withColumn("batch", F.lit(batch))
        after = save(held.where(~inside).select(*new.columns).unionByName(new), "replaced")  # the partitions read are overwritten next
        gone = held.select("month", "batch").distinct().join(after.select("month", "batch").distinct(), ["month", "batch"], "left_anti").collect()  # a few: batches of these months
        self._overwrite(after)
        for r in gone:
            folder = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/month={r.month}/batch={r.batch}")
            folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)

    def _overwrite(self, rows: DataFrame) -> None:
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("month", "batch").parquet(self.path)
