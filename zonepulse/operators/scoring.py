"""Requests to scored zones; many request hours go through in one job.

A request is (request_id, ts, zone_ids). It can name a zone once, so its rows
are at most the zone catalogue.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window, functions as F

from zonepulse.functions.columns import as_col
from zonepulse.functions.score import demand_score
from zonepulse.functions.text import clean_text
from zonepulse.operators.dims import fill_weather
from zonepulse.operators.features import add_calendar, add_cyclical, add_weather_flags, encode_location
from zonepulse.operators.nearest import nearest_allowed
from zonepulse.operators.ranking import first_per_key, ordered_union, top_n


def selected_zones(requests: DataFrame) -> DataFrame:
    """(request_id, ts, id), each named zone once."""
    return requests.select("request_id", "ts", F.explode(F.array_distinct("zone_ids")).alias("id")).filter(
        F.col("id").isNotNull()
    )


def nearby_zones(requests: DataFrame, centers: DataFrame, k: int = 4) -> DataFrame:
    """(request_id, ts, id): the nearest zones of each named zone that the request does not name.

    What a request names is barred for its zones inside the search, which passes over cells that hold nothing else; so a
    request for all zones costs no pair, whatever other requests ask for.
    """
    named = selected_zones(requests.select(F.struct("request_id", "ts").alias("request_id"), "ts", "zone_ids"))
    named = named.select(F.col("request_id").alias("group"), "id").distinct()
    near = nearest_allowed(centers, named.join(centers, "id"), named, k)
    return near.select("group.request_id", "group.ts", F.col("near_id").alias("id")).distinct()


def with_zone_meta(df: DataFrame, zones: DataFrame, zone: str = "pulocationid") -> DataFrame:
    """Trimmed borough and service zone per row, null if the zone is unknown."""
    meta = zones.select(
        as_col("location_id").alias(zone), clean_text("borough").alias("borough"), clean_text("service_zone").alias("service_zone")
    )
    return df.join(first_per_key(meta, [zone]), zone, "left")


def scoring_grid(requests: DataFrame, zones: DataFrame, nearby: DataFrame | None = None) -> DataFrame:
    """Requested and nearby zones at the request's time, with calendar and location features."""
    chosen = selected_zones(requests)
    near = nearby if nearby is not None else chosen.limit(0)
    ids = ordered_union(chosen, near, ["request_id", "ts", "id"])
    rows = ids.select(
        "request_id",
        F.col("id").cast("int").alias("pulocationid"),
        F.col("ts").alias("hour_ts"),
        F.when(F.col("priority") == 0, "selected").otherwise("nearby").alias("source"),
    )
    return (
        with_zone_meta(rows, zones)
        .transform(add_calendar)
        .drop("pickup_date")
        .transform(add_cyclical)
        .withColumns({c: F.nullif(as_col(c), F.lit("")) for c in ("borough", "service_zone")})
        .transform(encode_location)
    )


def with_lookup(df: DataFrame, lookup: DataFrame, on: Sequence[str], defaults: Mapping[str, float]) -> DataFrame:
    """Attach lookup columns; a row without a match gets the defaults."""
    kept = lookup.select(*on, *defaults)
    joined = df.join(kept, list(on), "left")
    return joined.withColumns({c: F.coalesce(as_col(c).cast("double"), F.lit(float(v))) for c, v in defaults.items()})


def with_weather(df: DataFrame, weather: DataFrame) -> DataFrame:
    """Daily weather of the zone's borough, zero where unknown, and its flags."""
    daily = weather.select(
        F.to_date("date").alias("_date"),
        F.lower(clean_text("borough")).alias("_borough"),
        "temperature_mean",
        "precipitation_sum",
        "wind_speed_max",
    )
    keyed = df.withColumns({"_date": F.to_date("hour_ts"), "_borough": F.lower(clean_text("borough"))})
    daily = first_per_key(daily, ["_date", "_borough"])
    joined = keyed.join(daily, ["_date", "_borough"], "left").drop("_date", "_borough")
    return joined.transform(fill_weather).transform(add_weather_flags)


def with_source(preds: DataFrame, grid: DataFrame, on: Sequence[str] = ("request_id", "pulocationid")) -> DataFrame:
    """Selected or nearby tag per prediction; nearby if the grid has no row."""
    joined = preds.join(grid.select(*on, "source"), list(on), "left")
    return joined.withColumn("source", F.coalesce("source", F.lit("nearby")))


def scored(preds: DataFrame, pred: str = "prediction") -> DataFrame:
    """Rounded demand and score beside the raw prediction."""
    return preds.withColumns({"predicted_demand": F.round(as_col(pred), 2), "score": demand_score(pred)})


def top_zones(preds: DataFrame, k: int = 5, within: Sequence[str] = ()) -> DataFrame:
    """Best ``k`` by score, per request if ``within`` names one."""
    if not within:
        return top_n(preds, "score", "pulocationid", k)
    w = Window.partitionBy(*within).orderBy(F.col("score").desc(), F.col("pulocationid").asc())
    return preds.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def with_zone_name(preds: DataFrame, zones: DataFrame) -> DataFrame:
    """Zone name per prediction; unknown zones drop out."""
    names = zones.select(F.col("location_id").alias("pulocationid"), F.col("zone").alias("zone_name"))
    return preds.join(names, "pulocationid")


def recent_runs(preds: DataFrame, zones: DataFrame, n: int = 50, run: str = "request_id", at: str = "run_ts") -> DataFrame:
    """Latest ``n`` runs with zone counts, top zone and top score; a run whose top zone is unknown is left out."""
    top = F.min(F.struct((-F.col("score")).alias("s"), F.col("pulocationid").alias("z"))).alias("_top")
    runs = preds.groupBy(run, at).agg(
        F.count_if(F.col("source") == "selected").alias("selected_count"),
        F.count("*").alias("included_count"),
        top,
    )
    named = with_zone_name(
        runs.select(run, at, "selected_count", "included_count", F.col("_top.z").alias("pulocationid"), (-F.col("_top.s")).alias("top_score")),
        zones,
    )
    return named.orderBy(F.col(at).desc(), F.col(run).desc()).limit(n)
