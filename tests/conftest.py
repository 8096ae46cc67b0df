import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tablewright.session import tuned_session  # noqa: E402


@pytest.fixture(scope="session")
def shared(tmp_path_factory):
    return str(tmp_path_factory.mktemp("shared"))


@pytest.fixture(scope="session")
def spark(shared):
    session = tuned_session("tests", "local[8]", spark__sql__shuffle__partitions=4,
                            spark__ui__enabled="false", spark__ui__showConsoleProgress="false",
                            spark__driver__memory="4g",
                            spark__checkpoint__dir=shared)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def tracks(spark):
    """Track table with the default configuration's columns; deterministic values."""
    from pyspark.sql import functions as F
    rows = spark.range(600).withColumn("u", F.pmod(F.xxhash64("id"), F.lit(1000)) / 1000.0)

    def unit(seed):
        return F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(10_000)) / 10_000.0

    genres = F.array(*[F.lit(g) for g in (
        "['pop'; 'dance pop']", "['rock']", "['latin'; 'reggaeton']", "['hip hop'; 'pop rap']", None)])
    return rows.select(
        (F.lit(2000) + F.pmod("id", F.lit(20))).cast("int").alias("year"),
        F.concat(F.lit("song "), F.col("id")).alias("track_name"),
        (40 + 30 * unit(1) + 15 * unit(2) + 5 * unit(3)).cast("int").alias("track_popularity"),
        F.lit("album").alias("album"), F.lit("artist").alias("artist_name"),
        F.element_at(genres, (F.pmod("id", F.lit(5)) + 1).cast("int")).alias("artist_genres"),
        (100 * unit(1)).cast("int").alias("artist_popularity"),
        unit(2).alias("danceability"), unit(4).alias("energy"),
        F.floor(12 * unit(5)).cast("double").alias("key"), (-20 * unit(6)).alias("loudness"),
        F.round(unit(7)).alias("mode"), unit(8).alias("speechiness"), unit(9).alias("acousticness"),
        unit(10).alias("instrumentalness"), unit(11).alias("liveness"), unit(12).alias("valence"),
        (60 + 140 * unit(13)).alias("tempo"), (120_000 + 200_000 * unit(14)).alias("duration_ms"))
