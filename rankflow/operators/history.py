"""Rank-history ingest: JSON rank maps -> long observations with calendar
columns, wide -> long melt, item id from the source path."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


RANK_MAP = T.MapType(T.StringType(), T.LongType())

# File-name suffix of a normalised rank document.
RANK_FILE_SUFFIX = "_com_norm.json"

OBSERVATION_COLUMNS = ["asin", "timestamp", "rank", "year", "month", "date", "day", "hour"]


def explode_rank_map(df: DataFrame, text_col: str = "value",
                     keep: tuple[str, ...] = ("file_name",)) -> DataFrame:
    """One JSON object per row, ``{"<epoch seconds>": rank, ...}`` ->
    one row per key.  A document whose values are not all integers parses
    to null and, like an empty or malformed line, yields no rows."""
    parsed = F.from_json(F.col(text_col), RANK_MAP)
    return df.select(*keep, F.explode(parsed).alias("timestamp", "rank"))


def item_id_from_path(path: Column | str, rule: str = "suffix") -> Column:
    """Item id from a source path.

    * ``suffix``: everything before ``_com_norm.json`` in the last path element
    * ``prefix``: the last path element up to its first ``_``
    * ``depth3``: the element at fixed depth 3 (``s3://bucket/<file>``) up to
      its first ``_`` -- the literal form of the batch job
    * ``folder``: the value of an ``asin=<id>`` folder (files written with
      ``partitionBy("asin")``)
    """
    p = F.col(path) if isinstance(path, str) else path
    parts = F.split(p, "/")
    if rule == "suffix":
        return F.regexp_extract(p, r".*/([^/]+)_com_norm\.json", 1)
    if rule == "prefix":
        return F.split(F.element_at(parts, -1), "_").getItem(0)
    if rule == "folder":
        return F.regexp_extract(p, r"/asin=([^/]+)/", 1)
    if rule == "depth3":
        return F.split(F.try_element_at(parts, F.lit(4)), "_").getItem(0)
    raise ValueError(f"unknown id rule {rule!r}")


def to_observations(exploded: DataFrame, id_col: str = "asin",
                    epoch_col: str = "timestamp", rank_col: str = "rank") -> DataFrame:
    """(id, epoch text, rank) -> the observation schema: ``timestamp`` is a
    ``yyyy-MM-dd HH:mm:ss`` string in the session time zone and the
    calendar parts are zero-padded strings plus the weekday name.  The
    epoch is converted once; every part is formatted from that instant."""
    epoch = F.col(epoch_col).try_cast("bigint")
    t = F.timestamp_seconds(epoch)
    with_time = exploded.select(F.col(id_col).alias("asin"), F.col(rank_col).alias("rank"),
                                F.date_format(t, "yyyy-MM-dd HH:mm:ss").alias("timestamp"),
                                F.date_format(t, "EEEE").alias("day"))
    ts = F.col("timestamp")
    # the zero-padded parts are fixed slices of the formatted time string
    return with_time.select(
        "asin", "timestamp", "rank",
        F.substring(ts, 1, 4).alias("year"),
        F.substring(ts, 6, 2).alias("month"),
        F.substring(ts, 9, 2).alias("date"),
        "day",
        F.substring(ts, 12, 2).alias("hour"),
    )


def observations_from_documents(docs: DataFrame, text_col: str = "value",
                                path_col: str = "file_name", id_rule: str = "suffix") -> DataFrame:
    """The whole ingest: documents with their source path -> observations."""
    exploded = explode_rank_map(docs, text_col, keep=(path_col,))
    with_id = exploded.withColumn("asin", item_id_from_path(path_col, id_rule))
    return to_observations(with_id)


def melt(df: DataFrame, id_cols: list[str], value_cols: list[str] | None = None,
         key_name: str = "timestamp", value_name: str = "rank",
         keep_missing: bool = True) -> DataFrame:
    """Wide -> long: one row per (id, every value column).  With
    ``keep_missing`` a column absent for a row gives a null value, as
    ``stack`` over the union of keys does; otherwise those rows go."""
    value_cols = value_cols or [c for c in df.columns if c not in id_cols]
    out = df.unpivot(id_cols, value_cols, key_name, value_name)
    if not keep_missing:
        out = out.where(F.col(value_name).isNotNull())
    return out
