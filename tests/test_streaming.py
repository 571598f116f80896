"""The streaming window statistics equal the batch ones."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from stayframe.operators import timeseries as TS
from stayframe.sources import adapters as ad
from stayframe.streaming.window_stats import finish_stats, start_window_stats, stream_rows
from tests.conftest import SF_SMALL


def test_stream_matches_batch(spark):
    src = tempfile.mkdtemp(prefix="stayframe-stream-src-")
    ckpt = tempfile.mkdtemp(prefix="stayframe-stream-ckpt-")
    meas = ad.measurements(spark, SF_SMALL).drop("itemid")
    # land the rows as several files (by user id range) to drive several triggers
    meas.repartition(4, "subject_id").write.mode("overwrite").parquet(os.path.join(src, "part"))
    cohort = ad.measurement_episodes(spark, SF_SMALL)
    rows = stream_rows(spark, os.path.join(src, "part"), meas.schema)
    q = start_window_stats(rows, cohort, ckpt, query_name="ws_test", window_hours=120.0)
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    got = finish_stats(spark.table("ws_test")).collect()
    batch = TS.window_stats(TS.observed_rows(ad.measurements(spark, SF_SMALL), cohort, 120.0, 4)).collect()
    key = lambda r: (r.subject_id, r.feature_name, r.window)
    b = {key(r): r for r in batch}
    assert len(got) == len(b)
    for r in got:
        w = b[key(r)]
        assert r.n == w.n and r["min"] == w["min"] and r["max"] == w["max"]
        assert r.mean == pytest.approx(w.mean) and r.std == pytest.approx(w.std, abs=1e-6)
        assert r["first"] == w["first"] and r["last"] == w["last"]
