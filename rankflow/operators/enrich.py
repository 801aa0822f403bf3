"""Catalogue enrichment from stored lookup responses.

The reference calls a web API once per row inside a Python UDF.  Here the
responses are a table ``(title, status, body)`` (collected by whatever
fetches them, outside the query); enrichment is distinct titles joined to
that table and parsed with ``from_json`` -- native expressions only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Defaults the lookup returns when a field is missing.
NO_TITLE, NO_AUTHOR, NO_RATING = "No Title", "No Author", "No Rating"

BODY_SCHEMA = T.StructType([T.StructField("items", T.ArrayType(T.StructType([
    T.StructField("volumeInfo", T.StructType([
        T.StructField("title", T.StringType()),
        T.StructField("authors", T.ArrayType(T.StringType())),
        T.StructField("averageRating", T.StringType()),
    ]))])))])

DETAILS = T.StructType([T.StructField("title", T.StringType()),
                        T.StructField("authors", T.StringType()),
                        T.StructField("ratings", T.StringType())])


def parse_details(title_col: str = "title", status_col: str = "status", body_col: str = "body"):
    """Struct (title, authors, ratings) from one response: status other
    than 200 or no ``items`` -> (input title, No Author, No Rating); else
    the first item's title / authors joined by ", " / average rating, each
    with its default."""
    parsed = F.from_json(F.col(body_col), BODY_SCHEMA)
    first = F.try_element_at(parsed["items"], F.lit(1))["volumeInfo"]
    ok = (F.col(status_col) == 200) & first.isNotNull()
    authors = F.coalesce(F.array_join(first["authors"], ", "), F.lit(NO_AUTHOR))
    return F.when(ok, F.struct(F.coalesce(first["title"], F.lit(NO_TITLE)).alias("title"),
                               authors.alias("authors"),
                               F.coalesce(first["averageRating"], F.lit(NO_RATING)).alias("ratings"))
                  ).otherwise(F.struct(F.col(title_col).alias("title"), F.lit(NO_AUTHOR).alias("authors"),
                                       F.lit(NO_RATING).alias("ratings")))


def enrich_titles(books: DataFrame, payloads: DataFrame, title_col: str = "TITLE") -> DataFrame:
    """Every book row with a ``book_details`` struct.  Each distinct title is
    parsed once; a title with no stored response gets the defaults.  Of
    several responses for a title a successful one counts, of several of
    those one with a body, the smallest."""
    titles = books.select(F.col(title_col).alias("title")).distinct()
    one = payloads.groupBy("title").agg(F.min(F.struct(
        (~F.coalesce(F.col("status") == 200, F.lit(False))).alias("failed"),
        F.col("body").isNull().alias("empty"), "body", "status")).alias("_best"))
    resp = titles.join(one.select("title", "_best.status", "_best.body"), "title", "left")
    details = resp.select(F.col("title").alias("_t"), parse_details().alias("book_details"))
    return books.join(details, books[title_col].eqNullSafe(details["_t"]), "left").drop("_t")


def rated_only(details: DataFrame, ratings_col: str = "ratings") -> DataFrame:
    """Rows with a real rating (not null, not the sentinel)."""
    return details.where(F.col(ratings_col).isNotNull() & (F.col(ratings_col) != NO_RATING))
