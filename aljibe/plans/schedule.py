"""TV schedule: nested daily JSON to episodes, networks, shows, calendar and fact."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from aljibe.functions.dates import parsed_date
from aljibe.functions.nested import joined
from aljibe.operators.columns import flatten, rename, select_or_null, tidy_names
from aljibe.operators.grouping import dedupe_rows, first_per_key
from aljibe.operators.models import dim_by_key, dim_from_sources, dim_time, with_fact_keys
from aljibe.sources.files import read_json_arrays

# Flattened source names and the names silver gives them.
SILVER_NAMES = {
    "id": "episode_id",
    "name": "episode_name",
    "number": "episode_number",
    "type": "episode_type",
    "runtime": "episode_runtime",
    "summary": "episode_summary",
    "rating_average": "episode_rating",
    "_embedded_show_id": "show_id",
    "_embedded_show_name": "show_name",
    "_embedded_show_type": "show_type",
    "_embedded_show_language": "show_language",
    "_embedded_show_status": "show_status",
    "_embedded_show_genres": "show_genres",
    "_embedded_show_premiered": "show_premiered",
    "_embedded_show_rating_average": "show_rating_average",
    "_embedded_show_webchannel_id": "show_webchannel_id",
    "_embedded_show_webchannel_name": "show_webchannel_name",
    "_embedded_show_webchannel_country_name": "show_webchannel_country_name",
    "_embedded_show_webchannel_country_code": "show_webchannel_country_code",
    "_embedded_show_network_id": "show_network_id",
    "_embedded_show_network_name": "show_network_name",
    "_embedded_show_network_country_name": "show_network_country_name",
    "_embedded_show_network_country_code": "show_network_country_code",
    "_embedded_show_schedule_days": "show_schedule_days",
    "_embedded_show_schedule_time": "show_schedule_time",
}

# The columns of the show dimension.
SHOWS = StructType([
    StructField("show_id", LongType()),
    StructField("show_name", StringType()),
    StructField("show_type", StringType()),
    StructField("show_language", StringType()),
    StructField("show_status", StringType()),
    StructField("show_genres", StringType()),
    StructField("show_premiered", StringType()),
    StructField("show_rating_average", DoubleType()),
    StructField("show_webchannel_name", StringType()),
    StructField("show_network_name", StringType()),
])

# The columns of the network dimension.
NETWORK_ID = StructType([
    StructField("network_id", LongType()),
    StructField("network_name", StringType()),
    StructField("country_code", StringType()),
    StructField("country_name", StringType()),
])

# The columns of the episode fact before its keys.
EPISODES = StructType([
    StructField("episode_id", LongType()), StructField("show_id", LongType()), StructField("episode_name", StringType()),
    StructField("season", LongType()), StructField("episode_number", DoubleType()), StructField("episode_runtime", DoubleType()),
    StructField("episode_rating", DoubleType()), StructField("airdate", StringType()), StructField("airstamp", StringType()),
    StructField("show_network_id", LongType()), StructField("show_webchannel_id", LongType()),
])


def bronze(spark: SparkSession, root: str, schema: StructType | str | None = None) -> DataFrame:
    """All daily files as one flat row per episode."""
    return tidy_names(flatten(read_json_arrays(spark, root, schema)))


def silver(bronze_rows: DataFrame) -> DataFrame:
    """Business names, distinct rows, lists as comma-separated text."""
    named = dedupe_rows(rename(tidy_names(bronze_rows), SILVER_NAMES))
    lists = [c for c in ("show_genres", "show_schedule_days") if c in named.columns]
    return named.withColumns({c: joined(F.col(c)) for c in lists})


def _networks(silver_rows: DataFrame, origin: str) -> DataFrame:
    parts = {"network_id": "id", "network_name": "name", "country_code": "country_code", "country_name": "country_name"}
    source = {f"show_{origin}_{part}": name for name, part in parts.items()}
    return select_or_null(rename(silver_rows.select(*[c for c in source if c in silver_rows.columns]), source), NETWORK_ID)


def dim_networks(silver_rows: DataFrame) -> DataFrame:
    """Networks and web channels; a network wins where ids clash."""
    return dim_from_sources(
        [("broadcast", _networks(silver_rows, "network")), ("web", _networks(silver_rows, "webchannel"))], "network_id", "network_type"
    )


def dim_shows(silver_rows: DataFrame) -> DataFrame:
    return dim_by_key(silver_rows, SHOWS, "show_id", [F.col("show_name")])


def dim_dates(silver_rows: DataFrame) -> DataFrame:
    return dim_time(parsed_date(F.col("airdate")), silver_rows)


def fact_episodes(silver_rows: DataFrame) -> DataFrame:
    """One row per episode with date key (air date, else air time) and network (else web channel)."""
    rows = select_or_null(silver_rows, EPISODES).where(F.col("episode_id").isNotNull())
    first = first_per_key(rows, ["episode_id"], [F.asc_nulls_last("airdate"), F.asc_nulls_last("airstamp")])
    keyed = with_fact_keys(
        first,
        [parsed_date(F.col("airdate")), parsed_date(F.col("airstamp"))],
        [F.col("show_network_id"), F.col("show_webchannel_id")],
        "network_id",
    )
    return keyed.drop("airdate", "airstamp", "show_network_id", "show_webchannel_id")
