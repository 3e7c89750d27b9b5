"""A keyed incremental load driven by a file stream, one micro-batch per file."""

import os
import tempfile
import uuid

from tidemark.streaming.batches import load_each_batch


def test_stream_of_event_files(spark):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    src = tempfile.mkdtemp(prefix="tm-stream-src-")
    for i in range(3):
        events.filter(f"event_id % 3 = {i}").write.parquet(os.path.join(src, f"part{i}"))
    db = f"s_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {db}")
    spec = {"name": "ev", "target": {"table_name": f"{db}.events"}, "load_type": "incremental",
            "scd": {"keys": ["event_id"]}}
    seen = []
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(os.path.join(src, "*"))
    q = (
        stream.writeStream.foreachBatch(load_each_batch(spec, on_stats=lambda e, s: seen.append(s["inserted"])))
        .option("checkpointLocation", tempfile.mkdtemp(prefix="tm-stream-ckpt-"))
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination(300)
    assert spark.read.table(f"{db}.events").count() == events.count()
    assert sum(seen) == events.count()
