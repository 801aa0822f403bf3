"""The incremental ingest produces the same observations as the batch one."""

import os

from rankflow.operators.history import observations_from_documents
from rankflow.sources.readers import read_rank_documents
from rankflow.streaming.ingest import start_ingest


def test_stream_equals_batch(spark, tmpdir_path):
    src = os.path.join(tmpdir_path, "src")
    os.makedirs(src)
    docs = {"B01": '{"1483228800": 7, "1483232400": 5}', "B02": '{"1485907200": 1}',
            "B03": '{"1": "x"}'}
    for asin, doc in docs.items():
        with open(os.path.join(src, f"{asin}_com_norm.json"), "w") as f:
            f.write(doc + "\n")
    sink = os.path.join(tmpdir_path, "sink")
    q = start_ingest(spark, src, sink, os.path.join(tmpdir_path, "ckpt"))
    q.awaitTermination(120)
    streamed = sorted(tuple(r) for r in spark.read.parquet(sink)
                      .select("asin", "timestamp", "rank").collect())
    batch = observations_from_documents(read_rank_documents(spark, os.path.join(src, "*.json")))
    expected = sorted(tuple(r) for r in batch.select("asin", "timestamp", "rank").collect())
    assert streamed == expected and len(expected) == 3
