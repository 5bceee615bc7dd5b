"""Running medians against the statistics module; baselines over batch ends."""

import math
import random
import statistics
import time

import numpy as np
import pytest

from emberline.operators import history


@pytest.mark.parametrize("kind", ["continuous", "ties", "rising", "equal"])
def test_running_median_and_deviation(kind):
    rng = random.Random(kind)
    make = {"continuous": lambda i: rng.gauss(5, 3), "ties": lambda i: float(rng.randrange(4)), "rising": float, "equal": lambda i: 2.5}[kind]
    values = [make(i) for i in range(120)]
    med, mad = history.prior_statistics(np.array(values))
    for i, (m, d) in enumerate(zip(med, mad)):
        if i < history.MIN_PRIOR:
            assert math.isnan(m) and math.isnan(d)
        else:
            middle = statistics.median(values[:i])
            assert m == middle and d == statistics.median(abs(v - middle) for v in values[:i])


def test_missing_values_end_the_judging():
    values = np.array([1.0] * 6 + [np.nan] + [2.0] * 5)
    med, mad = history.prior_statistics(values)
    assert [i for i in range(12) if not math.isnan(med[i])] == [5, 6] and mad[6] == 0
    assert np.isnan(history.prior_statistics(np.array([]))[0]).all()


def test_ten_thousand_days_of_a_site():
    began = time.process_time()
    history.prior_statistics(np.random.default_rng(1).gamma(2, 3, 10_000))
    assert time.process_time() - began < 15


def test_sites_over_batch_ends(spark):
    rng = random.Random(9)
    rows = [(g, g % 3, n, f"2024-{1 + i // 28:02d}-{1 + i % 28:02d}", None if rng.random() < 0.01 else rng.random()) for g in range(30) for n in "DN" for i in range(rng.choice([1, 5, 6, 40, 90]))]
    frame = spark.createDataFrame(rows + [(1, 1, None, "2024-01-01", 1.0)], "gi long, gj long, daynight string, acq_date string, frp double")
    want = {}
    for g, j, n, day, _ in rows:
        before = [f for a, b, c, e, f in rows if (a, b, c) == (g, j, n) and e < day]
        m = statistics.median(before) if len(before) >= history.MIN_PRIOR and None not in before else None
        want[g, j, n, day] = (len(before), m, None if m is None else statistics.median(abs(v - m) for v in before))
    size = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        for batch in ("1", "7", "10000"):
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
            got = {(r.gi, r.gj, r.daynight, r.acq_date): (r.prior_active_days, r.med, r.mad) for r in history.baselines(frame).collect()}
            assert got == want
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
