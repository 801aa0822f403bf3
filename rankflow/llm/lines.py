"""Line dedup by site-relative frequency.

The pages of a host are compared with one another: a line is boilerplate when
the share of the host's pages that contain it exceeds ``ratio``, and is
dropped from all of them.  A line on fewer than ``support`` pages of its host
stays, so a host of one page loses nothing; hosts of every size are judged.

The lines of an HTML page are the stretches between tags and line breaks,
trimmed, without the empty ones; ``lines_of`` also takes plain text.

Scale: a page's distinct lines are hashed (64 bits, with the host in the key)
and counted per host with map-side partial sums, so a common line costs one
row per task.  A host has at most (mean lines per page / ``ratio``)
boilerplate lines, so they fit one row per host; the pages join it under a
salted key, which spreads a host of a third of all pages over ``SALTS`` tasks.

Defined cases: a null page or one without text has no lines; a null URL, or
one without a host, belongs to no site and keeps all its lines; rows that
repeat a page id count as pages of their own; a very long page is one row; an
empty table gives no row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankflow.llm.common import written

RATIO = 0.2
SUPPORT = 2     # a line that one page alone holds is no boilerplate
SALTS = 16
HTML_BREAK = r"<[^>]*>|\n"
TEXT_BREAK = r"\n"
_HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)"


def host_of(url: Column) -> Column:
    """Lower-cased host of a URL; null where there is none."""
    host = F.lower(F.regexp_extract(url, _HOST, 1))
    return F.when(host != "", host)


def lines_of(text: Column, breaks: str = HTML_BREAK) -> Column:
    parts = F.transform(F.split(F.coalesce(text, F.lit("")), breaks), lambda x: F.btrim(x, F.lit(" \t\r")))
    return F.filter(parts, lambda x: x != "")


def drop_site_lines(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", text_col: str = "html",
                    ratio: float = RATIO, support: int = SUPPORT, breaks: str = HTML_BREAK,
                    salts: int = SALTS) -> DataFrame:
    """One row per page: page_id, host, n_lines, n_dropped, kept_text (the
    kept lines, joined by line breaks)."""
    page = written(pages.select(F.col(id_col).alias("page_id"), host_of(F.col(url_col)).alias("host"),
                                lines_of(F.col(text_col), breaks).alias("lines")), "page-lines")
    salt = F.explode(F.array(*[F.lit(k) for k in range(salts)]))
    # a host's lines meet its page total in as many places as there are salts
    sites = (page.where(F.col("host").isNotNull()).groupBy("host").agg(F.count(F.lit(1)).alias("n_pages"))
             .select(F.col("host").alias("s_host"), "n_pages", salt.alias("s_salt")))
    seen = page.where(F.col("host").isNotNull()).select(
        "host", F.explode(F.array_distinct(F.transform("lines", lambda x: F.xxhash64(x)))).alias("line"))
    often = (seen.groupBy("host", "line").agg(F.count(F.lit(1)).alias("n_with")).where(F.col("n_with") >= support)
             .withColumn("salt", F.pmod("line", F.lit(salts)).cast("int")))
    # fewer than (lines of a page) / ratio lines of a host can exceed the ratio
    common = (often.join(sites, (F.col("host") == F.col("s_host")) & (F.col("salt") == F.col("s_salt")))
              .where(F.col("n_with") > F.lit(ratio) * F.col("n_pages"))
              .groupBy("host").agg(F.collect_set("line").alias("common")))
    common = written(common, "site-lines").select(
        F.col("host").alias("c_host"), "common", salt.alias("c_salt"))
    salted = page.withColumn("salt", F.pmod(F.xxhash64("page_id"), F.lit(salts)).cast("int"))
    both = salted.join(common, (F.col("host") == F.col("c_host")) & (F.col("salt") == F.col("c_salt")), "left")
    kept = F.when(F.col("common").isNull(), F.col("lines")).otherwise(
        F.filter("lines", lambda x: ~F.array_contains("common", F.xxhash64(x))))
    return both.select("page_id", "host", "lines", kept.alias("kept")).select(
        "page_id", "host", F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size("kept")).cast("long").alias("n_dropped"),
        F.array_join("kept", "\n").alias("kept_text"))
