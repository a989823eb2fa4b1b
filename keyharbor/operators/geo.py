"""Geo sets: tables of (member, lon, lat)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyharbor.functions import geo
from keyharbor.sources.table import Table, opened

COLUMNS = "member string, lon double, lat double"


@dataclass
class GeoAddResult:
    added: int = 0
    updated: int = 0


def geo_add_from_dataframe(target: Table | str, df: DataFrame, member_column: str = "member", lon_column: str = "lon", lat_column: str = "lat") -> GeoAddResult:
    """New members are added, known ones moved; of a member's repeats, the last in the frame's order counts."""
    t = opened(target)
    rows = df.select(F.col(member_column).cast("string").alias("member"), F.col(lon_column).cast("double").alias("lon"), F.col(lat_column).cast("double").alias("lat"), F.monotonically_increasing_id().alias("_o"))
    rows = rows.where("member IS NOT NULL AND lon BETWEEN -180 AND 180 AND lat BETWEEN -90 AND 90").groupBy("member").agg(F.max_by(F.struct("lon", "lat"), "_o").alias("p")).select("member", "p.lon", "p.lat")
    old = t.read()
    n = rows.count()
    known = rows.join(old.select("member"), "member", "left_semi").count() if old is not None else 0
    t.save(rows if old is None else old.join(rows.select("member"), "member", "left_anti").unionByName(rows))
    return GeoAddResult(n - known, known)


def geo_add(target: Table | str, places: list[tuple[str, float, float]]) -> GeoAddResult:
    t = opened(target)
    return geo_add_from_dataframe(t, t.spark.createDataFrame([(m, float(x), float(y)) for m, x, y in places], COLUMNS))


def geo_radius(places: DataFrame, lon: float, lat: float, radius: float, unit: str = "km", *, count: int | None = None, sort: str | None = None) -> DataFrame:
    """member, longitude, latitude, distance of those within the radius; sort: ASC or DESC by distance, ties by member; count takes the nearest unless DESC is asked."""
    at = geo.distance(F.col("lon"), F.col("lat"), F.lit(float(lon)), F.lit(float(lat)), unit)
    out = places.where(geo.within_radius(F.col("lon"), F.col("lat"), lon, lat, radius, unit)).select("member", F.col("lon").alias("longitude"), F.col("lat").alias("latitude"), at.alias("distance"))
    if sort or count is not None:
        out = out.orderBy(F.desc("distance") if (sort or "ASC").upper() == "DESC" else F.asc("distance"), "member")
    return out if count is None else out.limit(count)


def geo_radius_by_member(places: DataFrame, member: str, radius: float, unit: str = "km", *, count: int | None = None, sort: str | None = None) -> DataFrame:
    """geo_radius() around a member, itself included; no rows if it isn't there."""
    center = places.where(F.col("member") == member).select(F.col("lon").alias("_x"), F.col("lat").alias("_y")).limit(1)  # one row
    at = geo.distance(F.col("lon"), F.col("lat"), F.col("_x"), F.col("_y"), unit)
    out = places.crossJoin(F.broadcast(center)).withColumn("distance", at).where(F.col("distance") <= radius).select("member", F.col("lon").alias("longitude"), F.col("lat").alias("latitude"), "distance")
    if sort or count is not None:
        out = out.orderBy(F.desc("distance") if (sort or "ASC").upper() == "DESC" else F.asc("distance"), "member")
    return out if count is None else out.limit(count)


def geo_pos(places: DataFrame, members: list[str]) -> DataFrame:
    """member, longitude, latitude of each asked member; null where it isn't there."""
    asked = places.sparkSession.createDataFrame([(m,) for m in members], "member string")
    return asked.join(places.select("member", F.col("lon").alias("longitude"), F.col("lat").alias("latitude")), "member", "left")


def geo_dist(places: DataFrame, a: str, b: str, unit: str = "km") -> float | None:
    """The distance of two members; None if one isn't there."""
    two = places.where(F.col("member").isin(a, b)).agg(*(F.max(F.when(F.col("member") == m, F.struct("lon", "lat"))).alias(n) for m, n in ((a, "p"), (b, "q"))))
    return two.select(geo.distance(F.col("p.lon"), F.col("p.lat"), F.col("q.lon"), F.col("q.lat"), unit)).first()[0]


def geo_dist_matrix(places: DataFrame, members: list[str], unit: str = "km") -> DataFrame:
    """member and a column of distances to each asked member, which bound its size."""
    some = places.where(F.col("member").isin(members))
    targets = some.select(F.col("member").alias("_to"), F.col("lon").alias("_x"), F.col("lat").alias("_y"))
    pairs = some.crossJoin(F.broadcast(targets)).withColumn("d", geo.distance(F.col("lon"), F.col("lat"), F.col("_x"), F.col("_y"), unit))
    return pairs.groupBy("member").pivot("_to", members).agg(F.first("d"))


def geo_hash(places: DataFrame, members: list[str] | None = None, length: int = 11) -> DataFrame:
    found = places if members is None else places.where(F.col("member").isin(members))
    return found.select("member", geo.geohash(F.col("lon"), F.col("lat"), length).alias("geohash"))
