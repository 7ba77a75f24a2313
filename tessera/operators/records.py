"""Typed nested records from all-string rows (SRC-06, SCL-06, PRJ-06).

Files are read as strings on the executors (``spark.read.csv`` with an
all-string schema), then typed and nested by Column expressions; rows that
fail become quarantine rows through the policies module.  The reference
parses on the driver and ships the rows; here nothing passes the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions import scalar as S

# Column order of the movie metadata file (FIXTURES.md §2).
MOVIE_COLUMNS = [
    "color", "director_name", "num_critic_for_reviews", "duration", "director_facebook_likes",
    "actor_3_facebook_likes", "actor_2_name", "actor_1_facebook_likes", "gross", "genres", "actor_1_name",
    "movie_title", "num_voted_users", "cast_total_facebook_likes", "actor_3_name", "facenumber_in_poster",
    "plot_keywords", "movie_imdb_link", "num_user_for_reviews", "language", "country", "content_rating",
    "budget", "title_year", "actor_2_facebook_likes", "imdb_score", "aspect_ratio", "movie_facebook_likes",
]


def _int(c: str) -> Column:
    return F.col(c).try_cast("int")


def _dbl(c: str) -> Column:
    return F.col(c).try_cast("double")


def _pipe_list(c: str) -> Column:
    """Pipe-separated list; Java's split drops trailing empties, so do we."""
    return F.filter(F.split(F.coalesce(F.col(c), F.lit("")), r"\|"), lambda x: x != "")


def _principal(name: str, likes: str) -> Column:
    return F.struct(S.parse_person_name(F.col(name)).alias("name"), _int(likes).alias("facebook_likes"))


def movie_records(df: DataFrame, strict_fields: bool = False) -> DataFrame:
    """Nested movie records from the 28 string columns: format, production,
    reviews (with a parsed content rating), director, three actors, genres
    and plot keywords (pipe-split).  ``error`` names the first field that
    failed; with ``strict_fields`` a non-numeric number is an error, else it
    is a null (the spark-csv variant's optional fields)."""
    fmt = F.struct((F.col("color") == "Color").alias("color"), F.col("language").alias("language"),
                   _dbl("aspect_ratio").alias("aspect_ratio"), _int("duration").alias("duration"))
    prod = F.struct(F.col("country").alias("country"), _int("budget").alias("budget"), _int("gross").alias("gross"),
                    _int("title_year").alias("title_year"))
    rating = S.parse_content_rating(F.col("content_rating"))
    reviews = F.struct(_dbl("imdb_score").alias("imdb_score"), _int("movie_facebook_likes").alias("facebook_likes"),
                       F.struct(rating["code"].alias("code"), rating["age"].alias("age")).alias("content_rating"),
                       _int("num_user_for_reviews").alias("num_users_review"),
                       _int("num_voted_users").alias("num_users_voted"),
                       _int("num_critic_for_reviews").alias("num_critic_reviews"),
                       _int("cast_total_facebook_likes").alias("total_facebook_likes"))
    checks = [(F.col("movie_title").isNull(), "movie_title"),
              (S.parse_person_name(F.col("director_name"))["error"].isNotNull(), "director_name"),
              (rating["error"].isNotNull() & F.col("content_rating").isNotNull(), "content_rating")]
    if strict_fields:
        for c in ["duration", "budget", "gross", "title_year", "num_voted_users"]:
            checks.append((F.col(c).isNotNull() & _int(c).isNull(), c))
        checks.append((F.col("imdb_score").isNotNull() & _dbl("imdb_score").isNull(), "imdb_score"))
    error = None
    for cond, field in checks:
        error = F.when(cond, F.lit(f"bad {field}")) if error is None else error.when(cond, F.lit(f"bad {field}"))
    return df.select(
        F.trim(F.regexp_replace("movie_title", "\u00a0", " ")).alias("title"), fmt.alias("format"),
        prod.alias("production"), reviews.alias("reviews"),
        _principal("director_name", "director_facebook_likes").alias("director"),
        F.array(_principal("actor_1_name", "actor_1_facebook_likes"), _principal("actor_2_name", "actor_2_facebook_likes"),
                _principal("actor_3_name", "actor_3_facebook_likes")).alias("actors"),
        _pipe_list("genres").alias("genres"), _pipe_list("plot_keywords").alias("plot_keywords"),
        F.col("movie_imdb_link").alias("imdb"), error.alias("error"))


def movies_from_country(records: DataFrame, country: str) -> DataFrame:
    """Parsed records whose production country matches (FIL-03)."""
    return records.where(F.col("error").isNull() & (F.col("production.country") == country))
