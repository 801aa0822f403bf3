"""Incremental form of the rank-document ingest.

The reference ingests a bucket of rank documents in batch; new documents
keep arriving in such a bucket, so the same transformation is offered as a
Structured Streaming query over the file source: each new file is parsed,
exploded and given its calendar columns exactly as in batch, and appended
to a parquet table partitioned by (year, month).  Progress is kept in the
checkpoint location, so a restarted or failed job resumes where it stopped
without duplicating files.  (The reference has no streaming operator; this
is not a new operator, only a trigger mode for an existing one.)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rankflow.operators.history import observations_from_documents


def read_rank_document_stream(spark: SparkSession, source_dir: str,
                              max_files_per_trigger: int = 1000) -> DataFrame:
    """New text files under ``source_dir`` as (value, file_name) rows."""
    df = (spark.readStream.format("text")
          .option("maxFilesPerTrigger", max_files_per_trigger)
          .load(source_dir))
    return df.select("value", F.col("_metadata.file_path").alias("file_name"))


def observation_stream(spark: SparkSession, source_dir: str, id_rule: str = "suffix") -> DataFrame:
    return observations_from_documents(read_rank_document_stream(spark, source_dir), "value",
                                       "file_name", id_rule)


def start_ingest(spark: SparkSession, source_dir: str, sink_dir: str, checkpoint: str,
                 id_rule: str = "suffix", available_now: bool = True) -> StreamingQuery:
    """Append observations to ``sink_dir`` (parquet, partitioned by year and
    month).  ``available_now`` processes what is there and stops; otherwise
    the query keeps running."""
    obs = observation_stream(spark, source_dir, id_rule)
    writer = (obs.writeStream.format("parquet").outputMode("append")
              .option("checkpointLocation", checkpoint).partitionBy("year", "month"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime="1 minute")
    return writer.start(sink_dir)
