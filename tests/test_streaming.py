import os
import tempfile

from conftest import SF_SMALL
from quarterlens.operators import staging
from quarterlens.sources import driver
from quarterlens.streaming import stage_stream

SCHEMA = "event_id BIGINT, customer_id BIGINT, event_date DATE, event_type STRING"


def test_incremental_staging_matches_batch(spark):
    root = tempfile.mkdtemp(prefix="ql-stream-")
    src, sink, ckpt = (os.path.join(root, p) for p in ("bronze", "silver", "ckpt"))
    raw = driver.bronze_usage_events(spark, SF_SMALL)
    first, second = raw.where("event_id % 2 = 0"), raw.where("event_id % 2 = 1")
    first.write.mode("append").parquet(src)
    q = stage_stream(spark, "stg_usage_events", src, SCHEMA, sink, ckpt)
    q.awaitTermination(120)
    assert spark.read.parquet(sink).count() == first.count()
    second.write.mode("append").parquet(src)  # new files land later
    q = stage_stream(spark, "stg_usage_events", src, SCHEMA, sink, ckpt)
    q.awaitTermination(120)
    got = spark.read.parquet(sink)
    want = staging.stage_usage_events(raw)
    assert got.count() == want.count()
    assert got.exceptAll(want).count() == 0
