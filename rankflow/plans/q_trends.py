"""Trend queries over the daily fact and the event series."""

from __future__ import annotations

from pyspark.sql import functions as F

from rankflow.operators.facts import daily_min_rank
from rankflow.operators.trends import (centred_moving_mean, smooth_fraction, every_nth, keep_keys, mean_by,
                                       mean_by_weekday, sample_keys)
from rankflow.plans import catalog as C
from rankflow.plans import sql as S
from rankflow.plans.registry import query

_D = S.with_(S.META, S.OBS, S.FACTS, S.DAILY)
_MEAN = "round(CAST(sum(rank) AS DOUBLE) / count(rank), 4) AS mean_rank"
_WEEKDAY_IDX = ("(list_position(['Monday','Tuesday','Wednesday','Thursday','Friday',"
                "'Saturday','Sunday'], day) - 1)")


def _daily_typed(spark, sf_dir):
    d = C.book_daily(spark, sf_dir)
    return d.withColumn("month", F.col("month").cast("int")).withColumn(
        "date", F.col("date").cast("int"))


@query("trend_month", _D + f"SELECT CAST(month AS INTEGER) AS month, {_MEAN} FROM daily GROUP BY 1")
def trend_month(spark, sf_dir):
    """Mean rank by month."""
    return mean_by(_daily_typed(spark, sf_dir), ["month"])


@query("trend_weekday", _D + f"SELECT day, CAST({_WEEKDAY_IDX} AS INTEGER) AS day_index, {_MEAN} "
       "FROM daily GROUP BY day")
def trend_weekday(spark, sf_dir):
    """Mean rank by weekday, Monday first (A3 O2)."""
    return mean_by_weekday(_daily_typed(spark, sf_dir))


@query("trend_genre_month", _D + f"SELECT genre, CAST(month AS INTEGER) AS month, {_MEAN} "
       "FROM daily GROUP BY 1, 2")
def trend_genre_month(spark, sf_dir):
    """Mean rank by (genre, month) (A4)."""
    return mean_by(_daily_typed(spark, sf_dir), ["genre", "month"])


@query("trend_genre", _D + f"SELECT genre, {_MEAN} FROM daily GROUP BY 1")
def trend_genre(spark, sf_dir):
    """Mean rank by genre (A5)."""
    return mean_by(_daily_typed(spark, sf_dir), ["genre"])


_SAMPLED = _D.rstrip() + """,
picked AS (SELECT asin FROM (SELECT DISTINCT asin FROM daily WHERE asin IS NOT NULL)
           ORDER BY md5(asin || '42'), asin LIMIT 20),
sampled AS (SELECT * FROM daily WHERE asin IN (SELECT asin FROM picked))
"""


def _sampled_daily(spark, sf_dir):
    """The daily fact of 20 items: the keys are taken from the complete
    observations of complete items, and only their observations are joined."""
    obs = C.book_observations(spark, sf_dir)
    books = C.book_metadata(spark, sf_dir)
    whole = obs.where("timestamp IS NOT NULL AND rank IS NOT NULL").join(books.na.drop("any"), "asin", "left_semi")
    # at most 20 rows
    keys = F.broadcast(sample_keys(whole, "asin", 20, "42"))
    d = daily_min_rank(keep_keys(obs, keys, "asin"), books)
    return d.withColumn("month", F.col("month").cast("int")).withColumn("date", F.col("date").cast("int"))


@query("trend_item_month", _SAMPLED + f"SELECT asin, CAST(month AS INTEGER) AS month, {_MEAN} "
       "FROM sampled GROUP BY 1, 2")
def trend_item_month(spark, sf_dir):
    """20 seeded items, mean rank by month for each."""
    return mean_by(_sampled_daily(spark, sf_dir), ["asin", "month"])


@query("trend_item_date", _SAMPLED + f"SELECT asin, CAST(date AS INTEGER) AS date, {_MEAN} "
       "FROM sampled GROUP BY 1, 2")
def trend_item_date(spark, sf_dir):
    """20 seeded items, mean rank by day of month."""
    return mean_by(_sampled_daily(spark, sf_dir), ["asin", "date"])


@query("trend_item_weekday", _SAMPLED + f"SELECT asin, day, CAST({_WEEKDAY_IDX} AS INTEGER) "
       f"AS day_index, {_MEAN} FROM sampled GROUP BY 1, 2")
def trend_item_weekday(spark, sf_dir):
    """20 seeded items, mean rank by weekday, Monday first."""
    d = _sampled_daily(spark, sf_dir)
    res = mean_by(d, ["asin", "day"], sort=False)
    from rankflow.functions.calendar import weekday_index
    return res.withColumn("day_index", weekday_index("day")).orderBy("asin", "day_index")


_SMOOTH_SQL = S.with_(S.EVENTS) + """
SELECT pos, event_id, rank, smoothed FROM (
  SELECT event_id, rank, row_number() OVER (ORDER BY ts, event_id) - 1 AS pos,
         round(CAST(sum(rank) OVER w AS DOUBLE) / count(rank) OVER w, 4) AS smoothed
  FROM ev
  WINDOW w AS (ORDER BY ts, event_id ROWS BETWEEN 5 PRECEDING AND 5 FOLLOWING))
WHERE pos % 100 = 0"""


@query("trend_smoothed", _SMOOTH_SQL)
def trend_smoothed(spark, sf_dir):
    """Centred moving mean (+-5 rows) over the time-ordered series, then
    every 100th point (W10 F11 W6)."""
    ev = C.event_series(spark, sf_dir).select("event_id", "ts", "rank")
    sm = centred_moving_mean(ev, ["ts", "event_id"], "rank", 5)
    return every_nth(sm, "pos", 100).select("pos", "event_id", "rank", "smoothed")


_SMOOTH_BOTH_SQL = S.with_(S.EVENTS).rstrip() + """,
mean AS (SELECT asin, round(CAST(sum(rank) AS DOUBLE) / count(rank), 4) AS predicted FROM ev GROUP BY 1),
placed AS (SELECT event_id, ts, rank AS actual, predicted, row_number() OVER (ORDER BY ts, event_id) - 1 AS place
           FROM ev JOIN mean USING (asin)),
picked AS (SELECT *, row_number() OVER (ORDER BY place) - 1 AS pos, count(*) OVER () AS n FROM placed WHERE place % 100 = 0),
half AS (SELECT greatest(1, CAST(floor(max(n) * 0.05 / 2) AS BIGINT)) AS h FROM picked)
SELECT a.pos, a.event_id, a.actual, a.predicted,
       round(CAST(sum(CAST(b.actual AS DECIMAL(38,6))) AS DOUBLE) / count(b.actual), 4) AS smoothed_actual,
       round(CAST(sum(CAST(b.predicted AS DECIMAL(38,6))) AS DOUBLE) / count(b.predicted), 4) AS smoothed_predicted
FROM picked a, half JOIN picked b ON b.pos BETWEEN a.pos - h AND a.pos + h GROUP BY 1, 2, 3, 4"""


@query("trend_smoothed_series", _SMOOTH_BOTH_SQL)
def trend_smoothed_series(spark, sf_dir):
    """Every 100th point of the time-ordered events, then the actual and the
    predicted series (each user's mean) smoothed over 5 % of those points
    (W10 F11 W6)."""
    from rankflow.operators.ordering import with_position
    ev = C.event_series(spark, sf_dir).select("asin", "event_id", "ts", F.col("rank").alias("actual"))
    mean = mean_by(ev, ["asin"], "actual", "predicted", sort=False)
    picked = every_nth(with_position(ev, ["ts", "event_id"], "at"), "at", 100).join(mean, "asin")
    return smooth_fraction(picked.select("event_id", "at", "actual", "predicted"), ["at"], ["actual", "predicted"]).select(
        "pos", "event_id", "actual", "predicted", "smoothed_actual", "smoothed_predicted")
