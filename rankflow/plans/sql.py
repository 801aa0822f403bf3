"""DuckDB fragments mirroring the stand-ins of :mod:`rankflow.plans.catalog`."""

META = """meta AS (
  SELECT CAST(p_partkey AS VARCHAR) AS asin,
         CASE WHEN p_size <= 25 THEN 'book' ELSE 'kindle' END AS group_name,
         CAST(p_size AS VARCHAR) AS format, p_name AS title, p_brand AS author,
         string_split(p_name, ' ')[-1] AS publisher, lower(p_type) AS genre
  FROM part)"""

OBS = """obs AS (
  SELECT CAST(l_partkey AS VARCHAR) AS asin,
         strftime(date_trunc('second', l_shipdate), '%Y-%m-%d %H:%M:%S') AS timestamp,
         CAST(round(l_extendedprice * 100) AS BIGINT) AS rank,
         strftime(l_shipdate, '%Y') AS year, strftime(l_shipdate, '%m') AS month,
         strftime(l_shipdate, '%d') AS date, strftime(l_shipdate, '%A') AS day,
         strftime(l_shipdate, '%H') AS hour
  FROM lineitem)"""

FACTS = """facts AS (
  SELECT o.asin, o.timestamp, o.rank, o.year, o.month, o.date, o.day, o.hour,
         m.group_name, m.format, m.title, m.author, m.publisher, m.genre
  FROM obs o JOIN meta m ON o.asin = m.asin)"""

DAILY = """daily AS (
  SELECT asin, timestamp, rank, year, month, date, day,
         group_name, format, title, author, publisher, genre
  FROM (
    SELECT *, row_number() OVER (
        PARTITION BY asin, year, month, date, day, group_name, format, title, author,
                     publisher, genre
        ORDER BY rank, timestamp) AS rn
    FROM facts
    WHERE asin IS NOT NULL AND timestamp IS NOT NULL AND rank IS NOT NULL
      AND year IS NOT NULL AND month IS NOT NULL AND date IS NOT NULL AND day IS NOT NULL
      AND group_name IS NOT NULL AND format IS NOT NULL AND title IS NOT NULL
      AND author IS NOT NULL AND publisher IS NOT NULL AND genre IS NOT NULL)
  WHERE rn = 1)"""

EVENTS = """ev AS (
  SELECT CAST(user_id AS VARCHAR) AS asin, event_id, ts, event_type,
         CAST(round(value * 100) AS BIGINT) AS rank
  FROM events)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"
