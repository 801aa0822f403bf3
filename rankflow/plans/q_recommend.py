"""Recommendation queries: top-10 for a fixed request, and the monthly /
weekday trends of the recommended titles."""

from __future__ import annotations

from rankflow.functions.text import TOKEN_FILTERS
from rankflow.operators.recommend import (CODED, Request, fit_serving_maps, linear_scorer, recommend,
                                          title_trends)
from rankflow.plans import catalog as C
from rankflow.plans import sql as S
from rankflow.plans.registry import query
from rankflow.session import materialize

REQUEST = Request(day=2, date=15, month=6, genre="economy", group="book")

# A fixed linear scorer so the serving plumbing can be checked against SQL;
# the learned model is exercised by ``train_score_rank``.
COEFFICIENTS = {"author_code": -900.0, "publisher_code": -500.0, "format_code": 300.0,
                "title_code": 50.0, "genre_code": 20.0, "group_code": 10.0,
                "month_sin": 10000.0, "month_cos": 10000.0, "date_sin": 10000.0,
                "date_cos": 10000.0, "day_sin": 10000.0, "day_cos": 10000.0}
INTERCEPT = 2_000_000.0


def top10(spark, sf_dir):
    # the daily fact is the pipeline's stored table: computed once here
    daily = materialize(C.book_daily(spark, sf_dir))
    maps = fit_serving_maps(daily)
    # scores depend on the item and the request: one row per item is scored
    items = daily.select("asin", "title", *CODED).distinct()
    return recommend(items, maps, REQUEST, linear_scorer(COEFFICIENTS, INTERCEPT), 10), daily


def _lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


_TOK = ("list_filter(string_split(translate(lower(c.title), " + _lit(TOKEN_FILTERS) + ", "
        + _lit(" " * len(TOKEN_FILTERS)) + "), ' '), lambda x: x <> '')")
_TOK_ALL = _TOK.replace("c.title", "title")
_DAYS = "['Monday','Tuesday','Wednesday','Thursday','Friday','Saturday','Sunday']"
_CYC = {"month_sin": "sin(2 * pi() * m / 12)", "month_cos": "cos(2 * pi() * m / 12)",
        "date_sin": "sin(2 * pi() * dd / 31)", "date_cos": "cos(2 * pi() * dd / 31)",
        "day_sin": "sin(2 * pi() * wd / 7)", "day_cos": "cos(2 * pi() * wd / 7)"}
_REQ = {"m": REQUEST.month, "dd": REQUEST.date, "wd": REQUEST.day}


def _req_expr(expr: str) -> str:
    for k, v in _REQ.items():
        expr = expr.replace(f"* {k} /", f"* {v} /")
    return expr


def _codes(col: str) -> str:
    return (f"c_{col} AS (SELECT {col} AS value, dense_rank() OVER (ORDER BY {col}) - 1 AS code "
            f"FROM (SELECT DISTINCT {col} FROM daily WHERE {col} IS NOT NULL))")


_TOP_SQL = S.with_(S.META, S.OBS, S.FACTS, S.DAILY).rstrip() + ",\n" + ",\n".join([
    f"cat AS (SELECT *, CAST(month AS INTEGER) AS m, CAST(date AS INTEGER) AS dd, "
    f"list_position({_DAYS}, day) - 1 AS wd FROM daily)",
    "sc AS (SELECT " + ", ".join(f"min({e}) AS {k}_lo, max({e}) AS {k}_hi" for k, e in _CYC.items())
    + " FROM cat)",
    "req AS (SELECT " + " + ".join(
        f"{COEFFICIENTS[k]} * coalesce(({_req_expr(e)} - {k}_lo) / nullif({k}_hi - {k}_lo, 0), 0)"
        for k, e in _CYC.items()) + " AS cyc FROM sc)",
    *[_codes(c) for c in ("author", "publisher", "format", "genre", "group_name")],
    f"vocab AS (SELECT word, row_number() OVER (ORDER BY n DESC, word) AS idx FROM ("
    f"SELECT word, count(*) AS n FROM (SELECT unnest({_TOK_ALL}) AS word FROM daily) GROUP BY word))",
    f"cand AS (SELECT c.asin, c.title, coalesce(a.code, -1) AS ac, coalesce(p.code, -1) AS pc, "
    f"coalesce(f.code, -1) AS fc, coalesce(g.code, -1) AS gc, coalesce(r.code, -1) AS rc, "
    f"coalesce(v.idx, 0) AS tc FROM cat c "
    f"LEFT JOIN c_author a ON c.author = a.value LEFT JOIN c_publisher p ON c.publisher = p.value "
    f"LEFT JOIN c_format f ON c.format = f.value LEFT JOIN c_genre g ON c.genre = g.value "
    f"LEFT JOIN c_group_name r ON c.group_name = r.value "
    f"LEFT JOIN vocab v ON v.word = {_TOK}[1] "
    f"WHERE c.genre = {_lit(REQUEST.genre)} AND c.group_name = {_lit(REQUEST.group)})",
    f"scored AS (SELECT asin, title, abs(CAST(trunc({INTERCEPT} + "
    f"{COEFFICIENTS['author_code']} * ac + {COEFFICIENTS['publisher_code']} * pc + "
    f"{COEFFICIENTS['format_code']} * fc + {COEFFICIENTS['title_code']} * tc + "
    f"{COEFFICIENTS['genre_code']} * gc + {COEFFICIENTS['group_code']} * rc + "
    f"(SELECT cyc FROM req)) AS BIGINT)) AS predicted_rank FROM cand)",
    "dedup AS (SELECT title, predicted_rank FROM (SELECT *, row_number() OVER "
    "(PARTITION BY title ORDER BY predicted_rank, asin) AS rn FROM scored) WHERE rn = 1)",
    "top AS (SELECT CAST(row_number() OVER (ORDER BY predicted_rank, title) AS INTEGER) AS position, "
    "title, predicted_rank FROM dedup ORDER BY predicted_rank, title LIMIT 10)",
]) + "\n"


@query("recommend_top10", _TOP_SQL + "SELECT position, title, predicted_rank FROM top")
def recommend_top10(spark, sf_dir):
    """Validate -> filter by genre/group -> request features -> lookups ->
    score every row -> |int| -> one row per title -> top 10 numbered
    (M8 F1 F8 F9 P6 X34 J2 X16 A18 O4 W8)."""
    top, _ = top10(spark, sf_dir)
    return top


_MEAN = "round(CAST(sum(rank) AS DOUBLE) / count(rank), 4) AS mean_rank"


@query("trend_title_month", _TOP_SQL + f"SELECT title, CAST(month AS INTEGER) AS month, {_MEAN} "
       "FROM daily WHERE title IN (SELECT title FROM top) GROUP BY 1, 2")
def trend_title_month(spark, sf_dir):
    """Monthly mean rank of each recommended title."""
    top, daily = top10(spark, sf_dir)
    from pyspark.sql import functions as F
    return title_trends(top, daily.withColumn("month", F.col("month").cast("int")), "month")


@query("trend_title_weekday", _TOP_SQL + f"SELECT title, day, {_MEAN} "
       "FROM daily WHERE title IN (SELECT title FROM top) GROUP BY 1, 2")
def trend_title_weekday(spark, sf_dir):
    """Weekday mean rank of each recommended title."""
    top, daily = top10(spark, sf_dir)
    return title_trends(top, daily, "day")


# coefficients without common fractions: no score lies on a whole number
_SERVE = {"author_code": -900.0, "publisher_code": -500.0, "format_code": 300.0, "title_code": 50.0, "genre_code": 20.0,
          "group_code": 10.0, "month_sin": 10007.313, "month_cos": 9973.727, "date_sin": 10009.119, "date_cos": 9967.531,
          "day_sin": 10037.977, "day_cos": 9949.389}
_ITEM_CODES = {"author": "author_code", "publisher": "publisher_code", "format": "format_code", "genre": "genre_code",
               "group_name": "group_code"}


def _requests(spark, sf_dir):
    """A user's first event asks, on its date, for the genre and group of the
    book numbered like the user; errors ask for a genre that is not listed."""
    from pyspark.sql import functions as F
    from rankflow.functions.calendar import weekday_of
    from rankflow.operators.features import first_per_key
    ev = C.event_series(spark, sf_dir)
    first = first_per_key(ev, "asin", ["ts", "event_id", "event_type"], ["ts", "event_type"])
    books = C.book_metadata(spark, sf_dir).select("asin", "genre", "group_name")
    return first.join(books, "asin", "left").select(
        F.col("asin").alias("request_id"), weekday_of("ts").alias("day"), F.dayofmonth("ts").alias("date"),
        F.month("ts").alias("month"),
        F.when(F.col("event_type") == "error", F.lit("unlisted")).otherwise(F.col("genre")).alias("genre"), "group_name")


_SERVE_SQL = S.with_(S.META, S.OBS, S.FACTS, S.DAILY, S.EVENTS).rstrip() + ",\n" + ",\n".join([
    f"cat AS (SELECT *, CAST(month AS INTEGER) AS m, CAST(date AS INTEGER) AS dd, "
    f"list_position({_DAYS}, day) - 1 AS wd FROM daily)",
    "sc AS (SELECT " + ", ".join(f"min({e}) AS {k}_lo, max({e}) AS {k}_hi" for k, e in _CYC.items()) + " FROM cat)",
    *[_codes(c) for c in ("author", "publisher", "format", "genre", "group_name")],
    f"vocab AS (SELECT word, row_number() OVER (ORDER BY n DESC, word) AS idx FROM ("
    f"SELECT word, count(*) AS n FROM (SELECT unnest({_TOK_ALL}) AS word FROM daily) GROUP BY word))",
    "firsts AS (SELECT * FROM (SELECT user, ts, event_type, row_number() OVER (PARTITION BY user ORDER BY ts, event_id, event_type) AS rn "
    "FROM (SELECT asin AS user, * EXCLUDE asin FROM ev)) WHERE rn = 1)",
    "req AS (SELECT user AS request_id, CAST(isodow(ts) - 1 AS INTEGER) AS wd, CAST(day(ts) AS INTEGER) AS dd, "
    "CAST(month(ts) AS INTEGER) AS m, CASE WHEN event_type = 'error' THEN 'unlisted' ELSE genre END AS genre, group_name "
    "FROM firsts LEFT JOIN meta ON user = asin)",
    "checked AS (SELECT *, CASE WHEN genre IS NULL OR genre NOT IN (SELECT value FROM c_genre) THEN 'unknown genre' "
    "WHEN group_name IS NULL OR group_name NOT IN (SELECT value FROM c_group_name) THEN 'unknown group' ELSE 'ok' END AS status FROM req)",
    f"items AS (SELECT c.asin, c.title, c.genre, c.group_name, {' + '.join(f'{_SERVE[k]} * c_{c}.code' for c, k in _ITEM_CODES.items())} "
    f"+ {_SERVE['title_code']} * coalesce(v.idx, 0) AS s FROM (SELECT DISTINCT asin, title, author, publisher, format, genre, group_name "
    f"FROM daily) c {' '.join(f'JOIN c_{c} ON c.{c} = c_{c}.value' for c in _ITEM_CODES)} LEFT JOIN vocab v ON v.word = {_TOK}[1])",
    "asked AS (SELECT checked.*, " + " + ".join(
        f"{_SERVE[k]} * coalesce(({e} - {k}_lo) / nullif({k}_hi - {k}_lo, 0), 0)" for k, e in _CYC.items())
    + " AS cyc FROM checked, sc WHERE status = 'ok')",
    f"scored AS (SELECT request_id, title, min(abs(CAST(trunc({INTERCEPT} + s + cyc) AS BIGINT))) AS predicted_rank "
    "FROM asked JOIN items ON asked.genre = items.genre AND asked.group_name = items.group_name GROUP BY 1, 2)",
    "top AS (SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY request_id ORDER BY predicted_rank, title) AS INTEGER) "
    "AS position FROM scored) WHERE position <= 10)",
]) + """
SELECT c.request_id, CASE WHEN status = 'ok' AND position IS NULL THEN 'no titles' ELSE status END AS status,
       position, title, predicted_rank
FROM checked c LEFT JOIN top USING (request_id)"""


@query("recommend_requests", _SERVE_SQL)
def recommend_requests(spark, sf_dir):
    """Top ten titles for every user's request, from the stored catalogue and
    maps; requests for a genre that is not listed say so (M8 F8 F9 S13 J2 O4
    W8)."""
    from rankflow.operators.serving import load_store, save_store, serve
    from rankflow.session import scratch_path
    path = scratch_path(spark, "store")
    daily = materialize(C.book_daily(spark, sf_dir))
    save_store(daily, fit_serving_maps(daily), path)
    catalogue, maps = load_store(spark, path)
    return serve(_requests(spark, sf_dir), catalogue, maps, linear_scorer(_SERVE, INTERCEPT))
