"""What was written against what was counted: digests of partitions that don't depend on the order of rows, and two counts of each metric."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..contract import CONTRACT_COLUMNS
from ..storage import save
from ..stores import new_folder
from . import labels as L
from .catalog import query
from .oracle import TABLES

#: Steps to which numbers count, so that engines that add in another order agree; other columns count as their text.
STEPS = {
    "latitude": 1e5, "longitude": 1e5, "bright_ti4": 1e3, "bright_ti5": 1e3, "frp": 1e3, "dist_to_industrial_m": 10.0, "dist_to_flare_capable_m": 10.0,
    "dist_to_heat_industry_m": 10.0, "dist_to_coal_mine_m": 10.0, "dist_to_brick_kiln_m": 10.0,
}


def row_digest(columns: list[str], steps: dict[str, float] = STEPS) -> Column:
    """A number of 60 bits of all ``columns``: a changed value in any of them, also to or from null, gives another one."""

    def text(c: str) -> Column:
        value = F.floor(F.col(c) * steps[c] + 0.5).cast("string") if c in steps else F.col(c).cast("string")
        return F.coalesce(F.concat(F.length(value).cast("string"), F.lit(":"), value), F.lit("~"))

    return F.conv(F.substring(F.md5(F.concat(*map(text, columns))), 1, 15), 16, 10).cast("decimal(38,0)")


def digests(rows: DataFrame, by: str, columns: list[str]) -> DataFrame:
    """(by, n, digest) of each partition: rows and the sum of their digests, which their order doesn't change."""
    return rows.groupBy(by).agg(F.count("*").alias("n"), F.sum(row_digest(columns)).cast("string").alias("digest"))


def _digest_sql(columns: list[str]) -> str:
    def text(c: str) -> str:
        value = f"CAST(CAST(floor({c} * {STEPS[c]}::DOUBLE + 0.5::DOUBLE) AS BIGINT) AS VARCHAR)" if c in STEPS else f"CAST({c} AS VARCHAR)"
        return f"coalesce(CAST(length({value}) AS VARCHAR) || ':' || {value}, '~')"

    return f"CAST(sum(('0x' || substr(md5({' || '.join(map(text, columns))}), 1, 15))::BIGINT::HUGEINT) AS VARCHAR)"


@query("content_hash", f"SELECT acq_date, count(*) AS n, {_digest_sql(CONTRACT_COLUMNS)} AS digest FROM lab GROUP BY acq_date")
def content_hash(s, d):
    """Of each day, a digest of all columns of the contract."""
    return digests(L.labelled(s, d), "acq_date", CONTRACT_COLUMNS)


class Manifest:
    """A table written by partition, with the digests of its partitions beside it."""

    def __init__(self, spark: SparkSession, path: str, by: str, columns: list[str]):
        self.spark, self.path, self.by, self.columns = spark, path, by, columns

    def write(self, rows: DataFrame) -> None:
        self.schema = rows.schema
        rows.write.mode("overwrite").partitionBy(self.by).parquet(f"{self.path}/rows")
        digests(rows, self.by, self.columns).write.mode("overwrite").parquet(f"{self.path}/digests")

    def rows(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/rows")

    def compare(self) -> DataFrame:
        """(by, status) of all partitions of either side: ok, rows (another number), changed, missing or extra."""
        then = self.spark.read.schema(f"{self.by} string, n long, digest string").parquet(f"{self.path}/digests")
        return compare_digests(digests(self.rows(), self.by, self.columns), then, self.by)


def compare_digests(now: DataFrame, then: DataFrame, by: str) -> DataFrame:
    a, b = now.alias("a"), then.alias("b")
    status = (
        F.when(F.col(f"a.{by}").isNull(), "missing").when(F.col(f"b.{by}").isNull(), "extra").when(F.col("a.n") != F.col("b.n"), "rows")
        .when(F.col("a.digest") != F.col("b.digest"), "changed").otherwise("ok")
    )
    return a.join(b, F.col(f"a.{by}") == F.col(f"b.{by}"), "full").select(F.coalesce(f"a.{by}", f"b.{by}").alias(by), status.alias("status"))


CHANGED, SHORT, LOST, ADDED = "2024-01-05", "2024-01-07", "2024-01-09", "2024-02-01"


@query("check_manifest", f"""SELECT acq_date, CASE acq_date WHEN '{CHANGED}' THEN 'changed' WHEN '{SHORT}' THEN 'rows' WHEN '{LOST}' THEN 'missing' ELSE 'ok' END AS status
  FROM (SELECT DISTINCT acq_date FROM detections) t UNION ALL SELECT '{ADDED}', 'extra' WHERE EXISTS (SELECT 1 FROM detections)""")
def check_manifest(s, d):
    """The labelled days against their manifest after four were tampered with: one label changed, a row lost, a day lost, a day added."""
    rows = L.labelled(s, d).select("det_id", *CONTRACT_COLUMNS)
    table = Manifest(s, new_folder(s, "labelled"), "acq_date", ["det_id", *CONTRACT_COLUMNS])
    table.write(rows)
    day, first = F.col("acq_date"), rows.groupBy("acq_date").agg(F.min("det_id").alias("first"))
    marked = rows.join(first, "acq_date").withColumn("is_first", F.col("det_id") == F.col("first"))
    label = F.when((day == CHANGED) & F.col("is_first"), F.concat("label", F.lit("?"))).otherwise(F.col("label"))
    kept = marked.where((day != LOST) & ~((day == SHORT) & F.col("is_first"))).withColumn("label", label).select(*rows.columns)
    added = rows.where(day == CHANGED).withColumn("acq_date", F.lit(ADDED)).select(*rows.columns)
    tampered = Manifest(s, new_folder(s, "tampered"), "acq_date", table.columns)
    tampered.write(kept.unionByName(added))
    return compare_digests(digests(tampered.rows(), "acq_date", table.columns), s.read.parquet(f"{table.path}/digests"), "acq_date")


def metrics(rows: DataFrame, n: Column, anomalous: Column) -> DataFrame:
    """(metric, key, n) of rows with acq_date, label, state and a measure: the same metrics from detections and from counts of them."""
    where = F.coalesce("state", F.lit("outside"))
    keys = {
        "label": ("label", n), "day": ("acq_date", n), "state": (where, n), "state_label": (F.concat_ws("|", where, "label"), n), "day_label": (F.concat_ws("|", "acq_date", "label"), n),
        "anomalous_label": ("label", anomalous), "anomalous_day": ("acq_date", anomalous),
    }
    each = F.inline(F.array(*[F.struct(F.lit(m).alias("metric"), (F.col(k) if isinstance(k, str) else k).alias("key"), v.cast("long").alias("v")) for m, (k, v) in keys.items()]))
    return rows.select(each).groupBy("metric", "key").agg(F.sum("v").alias("n"))


def reconcile(source: DataFrame, export: DataFrame) -> DataFrame:
    """(metric, key, source_n, export_n, differs): a full join of two metric tables; what one side lacks differs."""
    a, b = source.withColumnRenamed("n", "source_n"), export.withColumnRenamed("n", "export_n")
    return a.join(b, ["metric", "key"], "full").withColumn("differs", ~F.col("source_n").eqNullSafe(F.col("export_n")))


def _metrics_sql(table: str, n: str, anomalous: str) -> str:
    where = "coalesce(state, 'outside')"
    keys = {
        "label": ("label", n), "day": ("acq_date", n), "state": (where, n), "state_label": (f"{where} || '|' || label", n), "day_label": ("acq_date || '|' || label", n),
        "anomalous_label": ("label", anomalous), "anomalous_day": ("acq_date", anomalous),
    }
    return " UNION ALL ".join(f"SELECT '{m}' AS metric, {k} AS key, sum({v})::BIGINT AS n FROM {table} GROUP BY 2" for m, (k, v) in keys.items())


TABLES["cube_rows"] = "SELECT acq_date, label, state, count(*) AS n, count(*) FILTER (WHERE is_anomalous) AS anomalous FROM lab_s GROUP BY ALL"


@query("check_consistency", f"""SELECT metric, key, a.n AS source_n, b.n AS export_n, a.n IS DISTINCT FROM b.n AS differs FROM ({_metrics_sql('lab_s', '1', 'is_anomalous::INT')}) a FULL JOIN ({_metrics_sql('cube_rows', 'n', 'anomalous')}) b USING (metric, key)""")
def check_consistency(s, d):
    """Metrics counted from labelled rows against those of the cube as it was written and read back."""
    rows = L.labelled_by_region(s, d)
    cube = save(rows.groupBy("acq_date", "label", "state").agg(F.count("*").alias("n"), F.count_if("is_anomalous").alias("anomalous")), "cube")
    return reconcile(metrics(rows, F.lit(1), F.col("is_anomalous").cast("int")), metrics(cube, F.col("n"), F.col("anomalous")))
