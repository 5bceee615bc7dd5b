"""Streams equal their batch twins whatever the landing order, restarts and crashes; a batch that is run again changes nothing."""

import datetime as dt

import pytest

from emberline.fixtures import view
from emberline.plans import catalog
from emberline.stores import Store, new_folder
from emberline.streaming import feeds

SF = "/root/testdata/sf0.001"


def test_repeated_and_overlapping_batches_are_stored_once(spark):
    rows = view(spark, SF, "detections")
    store = Store(spark, new_folder(spark, "store"), feeds._schema(feeds._STORED))
    add = feeds.append_unseen(store)
    first, second = rows.where("acq_date < '2024-01-15'"), rows.where("acq_date >= '2024-01-12'")
    for number, batch in ((0, first), (1, second), (1, second)):
        add(batch, number)
    stored = store.rows()
    assert stored.count() == rows.select(*feeds.KEY).distinct().count()
    assert stored.select(*feeds.KEY).distinct().count() == stored.count()


@pytest.mark.parametrize("name", ["stream_dedupe", "stream_ingest"])
def test_each_key_once(spark, name):
    keys = view(spark, SF, "detections").select(*feeds.KEY).distinct().count()
    assert catalog.QUERIES[name](spark, SF).count() == keys


def test_any_order_and_any_crash_give_the_same(spark):
    read = lambda stores: [sorted(map(tuple, s.rows().select(*c).collect())) for s, c in zip(stores, (["cell", "acq_date", "frp"], feeds.KEY))]
    plain = read(feeds._alert_run(spark, SF, tuple(range(11)), ()))
    crashed = read(feeds._alert_run(spark, SF, feeds.ORDER, (1, 6), (0, 3, 9)))
    assert plain == crashed and len(plain[0]) == len(set(plain[0]))


def stored(store):
    return sorted((r.acq_date, r.n, r.batch) for r in store.rows().collect())


def test_windows_are_replaced_exactly(spark):
    store = Store(spark, new_folder(spark, "store"), feeds._schema("acq_date string, n long"))
    rows = lambda *pairs: spark.createDataFrame(list(pairs), "acq_date string, n long")
    assert stored(store) == []
    store.write(rows(("2024-01-30", 1), ("2024-02-01", 2), ("2024-02-20", 3), ("2024-03-05", 4), ("2024-05-01", 5)), 0)
    for _ in range(2):
        store.replace("2024-02-01", "2024-03-10", rows(("2024-02-01", 20), ("2024-04-01", 99)), 1)
        assert stored(store) == [("2024-01-30", 1, 0), ("2024-02-01", 20, 1), ("2024-05-01", 5, 0)]
    store.replace("2024-02-01", "2024-02-29", rows(), 2)
    assert stored(store) == [("2024-01-30", 1, 0), ("2024-05-01", 5, 0)]
    store.append(rows(("2024-01-30", 1), ("2024-01-31", 7), ("2024-01-31", 7)), 3, ["acq_date", "n"])
    assert stored(store) == [("2024-01-30", 1, 0), ("2024-01-31", 7, 3), ("2024-05-01", 5, 0)]


def test_site_days_forget_and_wait_for_the_watermark(spark):
    """Days 100 apart: the first is no prior day of the last, nor active with it; a day that the watermark hasn't closed gives no row."""
    folder, before = new_folder(spark, "site"), spark.conf.get(feeds.PROVIDER)
    day = lambda n: dt.date(2024, 1, 1) + dt.timedelta(days=n)
    rows = [(21.0, 70.0, day(n).isoformat(), frp, part, dt.datetime.combine(day(n), dt.time(6))) for n, frp, part in [(0, 5.0, "D"), (1, 3.0, "D"), (1, 9.0, "N"), (1, None, "D"), (101, 4.0, "D"), (102, 1.0, None), (150, 1.0, "D")]]
    schema = "latitude double, longitude double, acq_date string, frp double, daynight string, event_time timestamp"
    for n, row in enumerate(rows):
        spark.createDataFrame([row], schema).coalesce(1).write.parquet(f"{folder}/in/n={n:03d}")
    spark.conf.set(feeds.PROVIDER, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 2).parquet(f"{folder}/in/n=*")
        job = feeds.site_days(stream).writeStream.format("parquet").option("checkpointLocation", f"{folder}/state").option("path", f"{folder}/out")
        job.trigger(availableNow=True).start().awaitTermination()
    finally:
        spark.conf.set(feeds.PROVIDER, before)
    got = {(r.acq_date, r.daynight): (r.max_frp, r.recurrence_count, r.first_seen, r.prior_active_days) for r in spark.read.schema(feeds._SITE_DAYS).parquet(f"{folder}/out").collect()}
    first, second, late = (day(n).isoformat() for n in (0, 1, 101))
    assert got == {(first, "D"): (5.0, 1, first, 0), (second, "D"): (3.0, 2, first, 1), (second, "N"): (9.0, 2, first, 0), (late, "D"): (4.0, 1, late, 0)}
