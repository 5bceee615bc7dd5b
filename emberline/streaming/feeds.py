"""The detection feed as a stream: every job reads what has landed, stops, and equals its batch twin."""

from __future__ import annotations

import datetime as dt
import re
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor

from ..fixtures import VIEWS, view
from ..functions.rules import apply_rules
from ..functions.scalars import clean_time, sighted
from ..operators.history import causal_recurrence, prior_statistics, with_anomaly, with_grid
from ..plans.catalog import BATCH, query
from ..plans.labels import add_context, with_landcover
from ..storage import save, shared_folder
from ..stores import Store

#: A row that comes this much later than the newest is too late for a closed day. The feed overlaps by three days.
LATENESS = "7 days"
EPOCH = dt.date(1970, 1, 1)
KEY = ["latitude", "longitude", "acq_date", "acq_time", "satellite"]


def new_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/streams/{uuid.uuid4().hex}"


def detections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Streaming detections with ``event_time``, from the event files in ``sf_dir``."""
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    landed = spark.readStream.schema(schema).option("pathGlobFilter", "events*.parquet").parquet(sf_dir)
    rows = spark.sql(re.sub(r"\bFROM\s+events\b", "FROM {landed}", VIEWS["detections"]), landed=landed)
    return rows.withColumn("event_time", sighted(F.col("acq_date"), F.col("acq_time")).cast("timestamp"))


def drained(stream: DataFrame, mode: str = "append") -> DataFrame:
    """Run ``stream`` over all that has landed and return the written table."""
    folder, spark = new_folder(stream.sparkSession), stream.sparkSession
    job = stream.writeStream.format("parquet").outputMode(mode).option("checkpointLocation", f"{folder}/state").option("path", f"{folder}/rows")
    job.trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{folder}/rows")


@query("stream_dedupe", f"SELECT DISTINCT {', '.join(KEY)} FROM detections")
def stream_dedupe(s, d):
    """Each key once, however often pulls overlap."""
    return drained(detections(s, d).withWatermark("event_time", LATENESS).dropDuplicatesWithinWatermark(KEY).select(*KEY))


@query("stream_complete_days", """SELECT acq_date, count(*) AS n FROM detections WHERE CAST(acq_date AS DATE) + INTERVAL 1 DAY <=
  (SELECT max(CAST(acq_date || ' ' || substr(acq_time, 1, 2) || ':' || substr(acq_time, 3, 2) AS TIMESTAMP)) - INTERVAL 7 DAY FROM detections) GROUP BY acq_date""")
def stream_complete_days(s, d):
    """Counts of days that the watermark has closed; days still open give no row."""
    day = F.window("event_time", "1 day")
    counts = detections(s, d).withWatermark("event_time", LATENESS).groupBy(day).agg(F.count("*").alias("n"))
    return drained(counts.select(F.date_format("window.start", "yyyy-MM-dd").alias("acq_date"), "n"))


#: Files that the replayed feed lands in, in this order: each holds some days, neighbours are exchanged. A row comes at most 6 days late.
DAYS_OF_FILE, ORDER = 3, (1, 0, 3, 2, 5, 4, 7, 6, 9, 8, 10)


class Landing:
    """The events as files that land one after the other and out of order, as overlapping pulls of a feed do."""

    def __init__(self, s: SparkSession, d: str, order: tuple[int, ...] = ORDER):
        self.spark, self.folder, self.order = s, new_folder(s), order
        self.events, self.landed = view(s, d, "events"), 0
        part = F.least(F.floor((F.dayofmonth("ts") - 1) / DAYS_OF_FILE), F.lit(max(order)))
        self.parts = self.events.withColumn("file", part)

    def land(self, count: int | None = None) -> None:
        """The next ``count`` files (default: all that are left)."""
        for n in self.order[self.landed : None if count is None else self.landed + count]:
            self.parts.where(F.col("file") == n).drop("file").coalesce(1).write.parquet(f"{self.folder}/landed={self.landed:04d}")
            self.landed += 1

    def detections(self) -> DataFrame:
        """One file each micro-batch, in the order of landing."""
        stream = self.spark.readStream.schema(self.events.schema).option("maxFilesPerTrigger", 1).option("pathGlobFilter", "*.parquet")
        landed = stream.parquet(f"{self.folder}/landed=*")
        rows = self.spark.sql(re.sub(r"\bFROM\s+events\b", "FROM {landed}", VIEWS["detections"]), landed=landed)
        return rows.withColumn("event_time", sighted(F.col("acq_date"), F.col("acq_time")).cast("timestamp"))


def run_batches(stream: DataFrame, each, state: str) -> None:
    """All that has landed, in micro-batches given to ``each``; ``state`` is the checkpoint to go on from."""
    stream.writeStream.foreachBatch(each).option("checkpointLocation", state).trigger(availableNow=True).start().awaitTermination()


def append_unseen(store: Store):
    """A foreachBatch function: rows whose key no earlier batch stored, the smallest id of each key within the batch."""

    def add(batch: DataFrame, number: int) -> None:
        store.append(batch.groupBy(*KEY).agg(F.min("det_id").alias("det_id")), number, KEY)

    return add


_STORED = "latitude double, longitude double, acq_date string, acq_time string, satellite string, det_id long"


def _schema(text: str):
    return T._parse_datatype_string(text)


@query("stream_ingest", f"SELECT DISTINCT {', '.join(KEY)} FROM detections")
def stream_ingest(s, d):
    """The store after files that landed out of order, some of them after a restart: each key once."""
    folder, landing = new_folder(s), Landing(s, d)
    store = Store(s, f"{folder}/store", _schema(_STORED))
    for count in (4, None):
        landing.land(count)
        run_batches(landing.detections().drop("event_time"), append_unseen(store), f"{folder}/state")
    return store.rows().select(*KEY)


class Crash(Exception):
    """Raised by tests and replays between two writes."""


def raise_once(alerts: Store, store: Store, crash=lambda number: None):
    """A foreachBatch function: days that this batch closes are judged, their anomalous (cell, day) pairs written as alerts, and
    only then the batch's rows to the store. If the job dies in between (``crash``), the batch is run again and raises the same alerts anew:
    it overwrites its own partitions, so nothing is raised or stored twice, and nothing is lost.

    A day is closed when a row LATE days newer has been stored or is in the batch. So it is judged once, by all of its rows and those of days before
    it, whatever the order of arrival."""

    def run(batch: DataFrame, number: int) -> None:
        new = with_grid(batch.dropDuplicates(KEY)).select(*store.columns).join(store.rows(number).select(*KEY), KEY, "left_anti")
        new = save(new, "arrived")
        seen = store.rows(number).agg(F.max("acq_date")).first()[0]
        newest = max(filter(None, [seen, new.agg(F.max("acq_date")).first()[0]]), default=None)
        if newest is None:
            return
        closed = F.date_format(F.date_sub(F.lit(newest), LATE), "yyyy-MM-dd")
        done = F.date_format(F.date_sub(F.lit(seen), LATE), "yyyy-MM-dd") if seen else F.lit("")
        known = store.rows(number).drop("batch").unionByName(new).where(F.col("acq_date") <= closed)
        judged = with_anomaly(known.where(F.col("acq_date") > done), known).where("is_anomalous")
        alerts.write(judged.groupBy("cell", "acq_date").agg(F.max("frp").alias("frp")), number)
        crash(number)
        store.write(new, number)

    return run


#: A row that comes this many days after a newer one is too late to be judged.
LATE = 7
_CLOSED = f"CAST(acq_date AS DATE) <= (SELECT max(CAST(acq_date AS DATE)) FROM detections) - {LATE}"
_ONCE = "SELECT DISTINCT ON (latitude, longitude, acq_date, acq_time, satellite) * FROM feat ORDER BY det_id"
_RAISED = f"SELECT cell, acq_date, max(frp) AS frp FROM feat WHERE is_anomalous AND {_CLOSED} GROUP BY cell, acq_date"


def _alert_run(s, d, order=ORDER, restarts=(4,), crashes=()) -> tuple[Store, Store]:
    """Alerts and store after the feed's files landed in ``order`` with ``restarts`` after so many files; the first attempts at the batches in ``crashes``
    die between the two writes."""
    folder, landing, left = new_folder(s), Landing(s, d, order), set(crashes)
    sample = with_grid(view(s, d, "detections")).limit(0)
    store = Store(s, f"{folder}/store", sample.schema)
    alerts = Store(s, f"{folder}/alerts", _schema("cell string, acq_date string, frp double"))

    def crash(number: int) -> None:
        if number in left:
            left.remove(number)
            raise Crash(number)

    for count in (*restarts, None):
        landing.land(count)
        while True:
            try:
                run_batches(landing.detections().drop("event_time"), raise_once(alerts, store, crash), f"{folder}/state")
                break
            except StreamingQueryException as e:
                if "Crash" not in str(e):
                    raise
    return alerts, store


@query("stream_alert_once", _RAISED)
def stream_alert_once(s, d):
    """Alerts of closed days after all files have landed: each (cell, day) is raised once."""
    return _alert_run(s, d)[0].rows().select("cell", "acq_date", "frp")


@query("stream_write_order", f"""SELECT 'alert' AS kind, acq_date, count(*) AS n, round(sum(frp), 6) AS frp FROM ({_RAISED}) t GROUP BY acq_date
  UNION ALL SELECT 'row', acq_date, count(*), NULL FROM (SELECT DISTINCT {', '.join(KEY)} FROM detections) t GROUP BY acq_date""")
def stream_write_order(s, d):
    """Alerts and rows a day, from files in another order and a job that died twice between its two writes: the same as without."""
    alerts, store = _alert_run(s, d, (0, 2, 1, 4, 3, 6, 5, 8, 7, 10, 9), (3, 3), (2, 6))
    raised = alerts.rows().groupBy("acq_date").agg(F.count("*").alias("n"), F.round(F.sum("frp"), 6).alias("frp")).select(F.lit("alert").alias("kind"), "acq_date", "n", "frp")
    stored = store.rows().groupBy("acq_date").agg(F.count("*").alias("n")).select(F.lit("row").alias("kind"), "acq_date", "n", F.lit(None).cast("double").alias("frp"))
    return raised.unionByName(stored)


def relabel_late(store: Store, labels: Store, lookback: int = 90):
    """A foreachBatch function: a batch's rows are stored, and the (cell, day) pairs whose active days they change get a new version: those of its own
    cells from the day of the cell's first new row to ``lookback`` days after its last. A row's count takes days on or before its own only,
    also when later ones have been stored already."""

    def run(batch: DataFrame, number: int) -> None:
        store.append(with_grid(batch.dropDuplicates(KEY)), number, KEY)
        known = store.rows(number + 1)
        touched = known.where(F.col("batch") == number).groupBy("gi", "gj").agg(F.min("acq_date").alias("first"), F.max("acq_date").alias("last"))
        days = causal_recurrence(known.join(touched, ["gi", "gj"], "left_semi"), lookback).join(touched, ["gi", "gj"])
        changed = days.where((F.col("acq_date") >= F.col("first")) & (F.datediff("acq_date", "last") <= lookback))
        labels.write(changed, number)

    return run


@query("late_data", """SELECT a.gi, a.gj, a.acq_date, count(DISTINCT b.acq_date) AS recurrence_count, min(b.acq_date) AS first_seen FROM (SELECT DISTINCT gi, gj, acq_date FROM det) a JOIN (SELECT DISTINCT gi, gj, acq_date FROM det) b
  ON a.gi = b.gi AND a.gj = b.gj AND b.acq_date <= a.acq_date AND CAST(b.acq_date AS DATE) >= CAST(a.acq_date AS DATE) - 90 GROUP BY ALL""")
def late_data(s, d):
    """Active days of each (cell, day) after files that landed out of order: late rows change later days, and never take from them."""
    folder, landing = new_folder(s), Landing(s, d, (4, 9, 1, 0, 7, 3, 10, 2, 5, 8, 6))
    store = Store(s, f"{folder}/store", with_grid(view(s, d, "detections")).schema)
    labels = Store(s, f"{folder}/labels", _schema("gi long, gj long, acq_date string, recurrence_count long, first_seen string"))
    landing.land()
    run_batches(landing.detections().drop("event_time"), relabel_late(store, labels), f"{folder}/state")
    newest = F.max_by(F.struct("recurrence_count", "first_seen"), "batch").alias("v")
    return labels.rows().groupBy("gi", "gj", "acq_date").agg(newest).select("gi", "gj", "acq_date", "v.*")


# A site's state


_SITE_DAYS = "gi long, gj long, daynight string, acq_date string, max_frp double, recurrence_count long, first_seen string, prior_active_days long, med double, mad double"
#: Days that a site's state holds.
KEPT_DAYS = 90


class SiteDays(StatefulProcessor):
    """Of each cell, the largest power by day and day or night. When the watermark closes a day, it gives the day's row: active days
    within KEPT_DAYS up to it, and the baseline of the days before it; days further back are forgotten, and with the last one the site."""

    def init(self, handle) -> None:
        self.handle = handle
        self.days = handle.getMapState("days", "day int, daynight string", "max_frp double")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        for frame in rows:
            for (day, part), frp in frame.fillna({"daynight": ""}).groupby(["day", "daynight"])["frp"].max().items():
                at = (int(day), part)
                if self.days.containsKey(at):
                    frp = np.fmax(frp, self.days.getValue(at)[0])
                self.days.updateValue(at, (float(frp),))
                self.handle.registerTimer((int(day) + 1) * 86_400_000)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        day = expiredTimerInfo.getExpiryTimeInMs() // 86_400_000 - 1
        everything = [(at, value[0]) for at, value in self.days.iterator()]
        held = sorted(x for x in everything if day - KEPT_DAYS < x[0][0] <= day)
        name = lambda n: (EPOCH + dt.timedelta(days=int(n))).isoformat()
        active, out = sorted({d for (d, _), _ in held}), []
        for (d, part), frp in held:
            if d == day and part:
                prior = np.array([v for (e, p), v in held if p == part and e < day] + [np.nan])
                med, mad = (x[-1] for x in prior_statistics(prior))
                out.append((*key, part, name(day), frp, len(active), name(active[0]), len(prior) - 1, med, mad))
        for (d, part), _ in everything:
            if d <= day - KEPT_DAYS:
                self.days.removeKey((d, part))
        columns = [c.split()[0] for c in _SITE_DAYS.split(", ")]
        yield pd.DataFrame(out, columns=columns).astype({"max_frp": float, "med": float, "mad": float})

    def close(self) -> None:
        pass


def site_days(stream: DataFrame) -> DataFrame:
    """_SITE_DAYS of the days that the watermark of ``stream`` (detections with event_time) has closed."""
    rows = with_grid(stream).withWatermark("event_time", LATENESS).select("gi", "gj", "daynight", "frp", "event_time", F.datediff(F.col("acq_date").cast("date"), F.lit("1970-01-01").cast("date")).alias("day"))
    return rows.groupBy("gi", "gj").transformWithStateInPandas(SiteDays(), _SITE_DAYS, "Append", "EventTime")


PROVIDER = "spark.sql.streaming.stateStore.providerClass"


@query("stream_site_state", """SELECT d.gi, d.gj, d.daynight, d.acq_date, d.max_frp, r.n AS recurrence_count, r.first_seen, b.n AS prior_active_days, round(b.med, 6) AS med, round(b.mad, 6) AS mad
  FROM daily d JOIN base b USING (gi, gj, daynight, acq_date) JOIN (SELECT a.gi, a.gj, a.acq_date, count(DISTINCT b.acq_date) AS n, min(b.acq_date) AS first_seen FROM (SELECT DISTINCT gi, gj, acq_date FROM det) a
    JOIN (SELECT DISTINCT gi, gj, acq_date FROM det) b ON a.gi = b.gi AND a.gj = b.gj AND b.acq_date <= a.acq_date AND CAST(b.acq_date AS DATE) > CAST(a.acq_date AS DATE) - 90 GROUP BY ALL) r USING (gi, gj, acq_date)
  WHERE CAST(d.acq_date AS DATE) + INTERVAL 1 DAY <= (SELECT max(CAST(acq_date || ' ' || substr(acq_time, 1, 2) || ':' || substr(acq_time, 3, 2) AS TIMESTAMP)) - INTERVAL 7 DAY FROM detections)""")
def stream_site_state(s, d):
    """Each site's closed days with active days and baseline, kept as state over micro-batches and a restart from the checkpoint."""
    folder, landing = new_folder(s), Landing(s, d)
    before = s.conf.get(PROVIDER)
    s.conf.set(PROVIDER, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        for count in (5, None):
            landing.land(count)
            job = site_days(landing.detections()).writeStream.format("parquet").outputMode("append").option("checkpointLocation", f"{folder}/state").option("path", f"{folder}/rows")
            job.trigger(availableNow=True).start().awaitTermination()
    finally:
        s.conf.set(PROVIDER, before)
    rows = s.read.schema(_SITE_DAYS).parquet(f"{folder}/rows")
    told = lambda c: F.round(F.nanvl(c, F.lit(None).cast("double")), 6).alias(c)
    return rows.select("gi", "gj", "daynight", "acq_date", F.nanvl("max_frp", F.lit(None).cast("double")).alias("max_frp"), "recurrence_count", "first_seen", "prior_active_days", told("med"), told("mad"))


def run_ingest(pull: DataFrame, history: DataFrame, around: DataFrame, landcover: DataFrame) -> DataFrame:
    """A live run over one pull: cleaned, each key once, none that is stored; with surroundings, days up to each row's own, anomaly and label.

    ``around``: surroundings by position."""
    fresh = with_grid(pull.withColumn("acq_time", clean_time(F.col("acq_time"))).dropDuplicates(KEY)).join(history.select(*KEY), KEY, "left_anti")
    known = history.select("gi", "gj", "acq_date", "daynight", "frp").unionByName(fresh.select("gi", "gj", "acq_date", "daynight", "frp"))
    rows = with_landcover(fresh.join(around, ["latitude", "longitude"], "left"), landcover)
    rows = rows.join(causal_recurrence(known, 90), ["gi", "gj", "acq_date"], "left")
    return apply_rules(with_anomaly(rows, known))


@query("run_ingest")
def run_ingest_query(s, d):
    """The pull from BATCH on, with two days that are stored already, against the rows before it."""
    rows = view(s, d, "detections")
    context = add_context(s, d)
    around = context.select("latitude", "longitude", *[c for c in context.columns if c.startswith(("dist_", "nearest_", "osm_"))]).distinct()
    history = with_grid(rows.where(F.col("acq_date") < BATCH))
    done = run_ingest(rows.where(F.col("acq_date") >= "2024-01-23"), history, around, view(s, d, "landcover_cells"))
    return done.select("det_id", "acq_date", "label", "label_source", "is_anomalous", "recurrence_count")
