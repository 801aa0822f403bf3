"""Daily fact table: observations joined to item metadata, one row per
item-day with the minimum rank (and the time of that minimum)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

METADATA_COLUMNS = ["group_name", "format", "title", "author", "publisher", "genre"]
DAILY_COLUMNS = ["asin", "timestamp", "rank", "year", "month", "date", "day", *METADATA_COLUMNS]

_DAY_SECONDS = 86400
# ranks up to this size are packed with the second of the day into a long
_LONG_RANK = 70_000_000_000_000
_DAY_NAMES = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]


def _two(c):
    """``%02d`` of a number."""
    return F.when((c >= 0) & (c < 10), F.concat(F.lit("0"), c.cast("string"))).otherwise(c.cast("string"))


def join_metadata(observations: DataFrame, metadata: DataFrame, key: str = "asin") -> DataFrame:
    """Inner equi-join of observations to the item dimension.  No broadcast
    hint: the catalogue grows with the data, so AQE picks a broadcast from
    runtime sizes and keeps the sort-merge join beyond its threshold."""
    return observations.join(metadata, key, "inner")


def daily_min_rank(observations: DataFrame, metadata: DataFrame,
                   metadata_cols: list[str] = METADATA_COLUMNS, key: str = "asin") -> DataFrame:
    """Minimum rank per item and calendar day, with the item attributes and
    the timestamp at which the minimum was first reached (earliest on ties).

    Same result as the reference's join -> ``dropna`` -> group by the eleven
    (item, day, attribute) keys, but planned the other way round: rows with
    a null are dropped, the observations are reduced to one row per
    (item, day) by a partial + final hash aggregate, and only then joined to
    the distinct, complete metadata rows.  The shuffle carries two keys
    instead of eleven and the join sees one row per item-day.

    For integral ranks (the reference's ``long``) the pair (rank, second of
    day) is packed into one number: a long, or for ranks beyond seventy
    million million a ``decimal(38,0)``, so any long rank fits and the
    aggregate buffer stays fixed-width; other rank types use ``min(struct(rank, second))``.
    """
    obs = observations.select(key, "timestamp", "rank")
    # 'yyyy-MM-dd HH:mm:ss': the day and the second of day are slices of the
    # string (no per-row timestamp parsing).  The calendar columns and the
    # hour are functions of the timestamp, so a row with any null has a null
    # item, timestamp or rank.  Such rows are not filtered up front (a filter
    # over derived columns is pushed below the projection and re-evaluates
    # it): a null rank or time makes the packed value null, which ``min``
    # skips; groups left empty and null items are removed after the
    # aggregate and by the inner join.
    ts = F.col("timestamp")
    day = F.substring(ts, 1, 10)
    sod = (F.substring(ts, 12, 2).cast("long") * 3600 + F.substring(ts, 15, 2).cast("long") * 60
           + F.substring(ts, 18, 2).cast("long"))
    rank_type = obs.schema["rank"].dataType
    keyed = obs.select(key, day.alias("_day"), sod.alias("_sod"), "rank")
    if isinstance(rank_type, (T.LongType, T.IntegerType, T.ShortType, T.ByteType)):
        fits = F.col("rank").between(-_LONG_RANK, _LONG_RANK)
        packed = F.when(fits, F.col("rank").cast("long") * F.lit(_DAY_SECONDS) + F.col("_sod"))
        wide = F.when(~fits, (F.col("rank").cast("decimal(20,0)") * F.lit(_DAY_SECONDS) + F.col("_sod")).cast("decimal(38,0)"))
        agg = (keyed.groupBy(key, "_day").agg(F.min(packed).alias("_p"), F.min(wide).alias("_w"))
               .where(F.col("_p").isNotNull() | F.col("_w").isNotNull()))
        # a wide rank is the least if it is negative or alone
        use_wide = F.col("_p").isNull() | F.coalesce(F.col("_w") < 0, F.lit(False))
        sec = F.when(use_wide, F.pmod(F.col("_w"), F.lit(_DAY_SECONDS)).cast("long")).otherwise(F.pmod(F.col("_p"), F.lit(_DAY_SECONDS)))
        # exact integer division (``/`` would go through double)
        whole = {c: F.expr(f"({c} - pmod({c}, {_DAY_SECONDS})) div {_DAY_SECONDS}").cast(rank_type) for c in ("_p", "_w")}
        rank = F.when(use_wide, whole["_w"]).otherwise(whole["_p"])
    else:
        pair = F.when(F.col("rank").isNotNull() & F.col("_sod").isNotNull(), F.struct("rank", "_sod"))
        agg = keyed.groupBy(key, "_day").agg(F.min(pair).alias("_m")).where(F.col("_m").isNotNull())
        sec = F.col("_m._sod")
        rank = F.col("_m.rank")
    d, s = F.col("_day"), F.col("_sec")
    stamp = F.concat(d, F.lit(" "), _two((s / 3600).cast("int")), F.lit(":"), _two(((s % 3600) / 60).cast("int")),
                     F.lit(":"), _two((s % 60).cast("int")))
    names = F.array(*[F.lit(n) for n in _DAY_NAMES])
    daily = agg.select(key, "_day", sec.alias("_sec"), rank.alias("rank")).select(
        key,
        stamp.alias("timestamp"),
        "rank",
        F.substring(d, 1, 4).alias("year"),
        F.substring(d, 6, 2).alias("month"),
        F.substring(d, 9, 2).alias("date"),
        F.element_at(names, F.weekday(F.to_date(d)) + 1).alias("day"),
    )
    meta = metadata.select(key, *metadata_cols).na.drop("any").distinct()
    return join_metadata(daily, meta, key).select(*DAILY_COLUMNS)


def typed_facts(daily: DataFrame) -> DataFrame:
    """The daily fact as the model notebooks read it back: real timestamp,
    integer month / date."""
    return (daily.withColumn("timestamp", F.to_timestamp("timestamp"))
            .withColumn("month", F.col("month").cast("int"))
            .withColumn("date", F.col("date").cast("int")))
