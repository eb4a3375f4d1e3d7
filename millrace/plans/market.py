"""Business questions of a marketplace: listings, sellers, bids.

Tables: car(car_id, color, mileage_km, mfg_year_id, model_id, ads_id, price, date_created),
model(model_id, model_name, brand_id), brand(brand_id, brand), mfg_year(mfg_year_id, mfg_year),
ads(ads_id, user_id), users(user_id, user_name, city_id), city(city_id, city, coordinate),
bid(bid_id, bid_price, user_id, car_id, date_created).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import month_start, months_before
from ..functions.geo import haversine_km, point_parts
from ..functions.numbers import exact_mean, exact_sum, percent_difference, rounded_mean
from ..operators.aggregates import child_counts
from ..operators.lookups import left_lookup
from ..operators.shape import where_recent_months
from ..operators.windows import first_and_next, running_mean_newest_first

Tables = Mapping[str, DataFrame]


def _with_model(t: Tables, car: DataFrame) -> DataFrame:
    named = left_lookup(t["model"], t["brand"], {"brand_id": "brand_id"}, {"brand": "brand"})
    return left_lookup(car, named, {"model_id": "model_id"}, {"car_name": "model_name", "brand": "brand"})


def _with_year(t: Tables, car: DataFrame) -> DataFrame:
    return left_lookup(car, t["mfg_year"], {"mfg_year_id": "mfg_year_id"}, {"year": "mfg_year"})


def _sellers(t: Tables) -> DataFrame:
    """Ads with the name and the city of their owner."""
    people = left_lookup(t["users"], t["city"], {"city_id": "city_id"}, {"city": "city", "coordinate": "coordinate"})
    return left_lookup(
        t["ads"], people, {"user_id": "user_id"},
        {"user_name": "user_name", "city": "city", "coordinate": "coordinate"},
    )


def listings_since(t: Tables, year: int) -> DataFrame:
    """Listings built in or after a year."""
    full = _with_year(t, _with_model(t, t["car"])).where(F.col("year") >= year)
    return full.select("car_id", "brand", "car_name", "year", "price")


def newest_bids(bids: DataFrame, n: int = 5) -> DataFrame:
    return bids.orderBy(F.desc("bid_id")).limit(n)


def listings_per_user(t: Tables) -> DataFrame:
    """Listings of every user, busiest first; users without any count zero."""
    owned = left_lookup(t["car"], t["ads"], {"ads_id": "ads_id"}, {"owner": "user_id"})
    counts = child_counts(t["users"], owned.where(F.col("owner").isNotNull()), "user_id", "owner", "count_car")
    return counts.orderBy(F.desc("count_car"), "user_id")


def listings_of_user(t: Tables, user_id: int) -> DataFrame:
    """The listings of one account, newest first."""
    mine = _sellers(t).where(F.col("user_id") == user_id).select("ads_id", "user_name")
    cars = _with_year(t, _with_model(t, t["car"].join(mine, "ads_id"))).orderBy(F.desc("date_created"), "car_id")
    return cars.select("user_name", "brand", "car_name", "year", "price", "date_created")


def listings_by_keyword(t: Tables, word: str) -> DataFrame:
    """Listings whose model name contains a word, in any case."""
    named = _with_model(t, t["car"]).where(F.col("car_name").ilike(f"%{word}%"))
    return _with_year(t, named).select("car_id", "brand", "car_name", "color", "year", "price", "mileage_km")


def nearest_listings(t: Tables, city: str, n: int = 5, legacy: bool = False) -> DataFrame:
    """The n listings nearest to a city.

    Distances are worked out once per city and joined to the listings.
    """
    lat, lon = point_parts("coordinate")
    places = t["city"].withColumns({"lat": lat, "lon": lon})
    home = places.where(F.col("city") == city).agg(F.struct(F.min("lat").alias("lat"), F.min("lon").alias("lon"))).scalar()
    distance = haversine_km(home.getField("lat"), home.getField("lon"), "lat", "lon", legacy=legacy)
    distances = places.select("city_id", "city", distance.alias("distance_km"))
    people = left_lookup(t["users"], distances, {"city_id": "city_id"}, {"city": "city", "distance_km": "distance_km"})
    sellers = left_lookup(t["ads"], people, {"user_id": "user_id"}, {"city": "city", "distance_km": "distance_km"})
    cars = left_lookup(t["car"], sellers, {"ads_id": "ads_id"}, {"city": "city", "distance_km": "distance_km"})
    near = _with_year(t, _with_model(t, cars.orderBy(F.asc_nulls_last("distance_km"), "car_id").limit(n)))
    return near.select("car_id", "brand", "car_name", "year", "price", "mileage_km", "city", "distance_km").orderBy(
        F.asc_nulls_last("distance_km"), "car_id"
    )


def popularity(t: Tables) -> DataFrame:
    """Listings and bids per model, most bids first. Bids are counted per listing before the join."""
    bids = t["bid"].groupBy("car_id").agg(F.count("bid_id").alias("bids"))
    cars = _with_model(t, left_lookup(t["car"], bids, {"car_id": "car_id"}, {"bids": "bids"}))
    grouped = cars.groupBy("brand", "car_name").agg(
        F.count("car_id").alias("cars"), F.sum(F.coalesce("bids", F.lit(0))).alias("bids")
    )
    return grouped.orderBy(F.desc("bids"), "brand", "car_name")


def mean_price_by_city(t: Tables) -> DataFrame:
    cars = left_lookup(_with_model(t, t["car"]), _sellers(t), {"ads_id": "ads_id"}, {"city": "city"})
    return cars.groupBy("brand", "car_name", "city").agg(rounded_mean("price").alias("avg_price")).orderBy(
        "car_name", "city"
    )


def bids_per_model(t: Tables) -> DataFrame:
    bids = t["bid"].groupBy("car_id").agg(F.count("bid_id").alias("bids"))
    cars = left_lookup(t["car"], bids, {"car_id": "car_id"}, {"bids": "bids"}).groupBy("model_id").agg(
        F.sum(F.coalesce("bids", F.lit(0))).alias("bids")
    )
    counted = left_lookup(t["model"], cars, {"model_id": "model_id"}, {"bids": "bids"})
    return counted.select("model_id", "model_name", F.coalesce("bids", F.lit(0)).alias("bids")).orderBy(
        F.desc("bids"), "model_id"
    )


def _bids_of(t: Tables, wanted) -> DataFrame:
    """Bids on listings of the wanted models, with the model name."""
    cars = t["car"].join(t["model"].where(wanted), "model_id").select("car_id", "model_name")
    return t["bid"].join(cars, "car_id")


def first_and_next_bid(t: Tables, model_name: str) -> DataFrame:
    """First and second bid of each user on one model."""
    bids = _bids_of(t, F.col("model_name") == model_name)
    pair = first_and_next(bids, ["user_id"], ["date_created", "bid_id"], ["model_name", "date_created", "bid_price"])
    return pair.select(
        F.col("first_model_name").alias("model_name"), "user_id",
        F.col("first_date_created").alias("first_bid_date"), F.col("next_date_created").alias("next_bid_date"),
        F.col("first_bid_price"), F.coalesce("next_bid_price", F.lit(0)).alias("next_bid_price"),
    ).orderBy(F.desc("next_bid_price"), "user_id")


def price_against_recent_bids(t: Tables, months: int = 6) -> DataFrame:
    """Mean list price per model against the mean bid of the last months."""
    recent = where_recent_months(t["bid"], "date_created", months).groupBy("car_id").agg(
        exact_sum("bid_price").alias("total"), F.count("bid_price").alias("bids")
    )
    cars = left_lookup(t["car"], t["model"], {"model_id": "model_id"}, {"model_name": "model_name"})
    offers = (
        left_lookup(recent, cars, {"car_id": "car_id"}, {"model_name": "model_name"})
        .where(F.col("model_name").isNotNull())
        .groupBy("model_name")
        .agg(F.round(F.sum("total").cast("decimal(30,4)") / F.sum("bids").cast("decimal(19,0)"), 2).cast("double").alias("bid"))
    )
    prices = cars.groupBy("model_name").agg(rounded_mean("price").alias("price"))
    names = t["model"].select("model_name").distinct()
    zero = F.lit(0.0)
    both = names.join(prices, "model_name", "left").join(offers, "model_name", "left").select(
        "model_name", F.coalesce("price", zero).alias("avg_price"), F.coalesce("bid", zero).alias("avg_bid6_month")
    )
    money = {c: F.col(c).cast("decimal(20,2)") for c in ("avg_price", "avg_bid6_month")}
    return both.withColumns({
        "difference": (money["avg_price"] - money["avg_bid6_month"]).cast("double"),
        "difference_percent": percent_difference(money["avg_price"], money["avg_bid6_month"]).cast("double"),
    })


def monthly_bid_pivot(t: Tables, word: str, months: int = 6) -> DataFrame:
    """Running mean bid, newest month first, for the last months; one column per month rank."""
    bids = _bids_of(t, F.col("model_name").ilike(f"%{word}%")).withColumn("month", month_start("date_created"))
    by_month = bids.groupBy("month", "model_name").agg(exact_sum("bid_price").alias("total"), F.count("bid_price").alias("bids"))
    running = running_mean_newest_first(by_month, F.col("month"), F.sum("total"), F.sum("bids"))
    recent = running.where(F.col("period") >= months_before("newest", months - 1)).withColumnRenamed("period", "month")
    ranked = by_month.select("month", "model_name").join(recent, "month")
    return ranked.groupBy("model_name").agg(
        *[F.min(F.when(F.col("place") == k, F.col("running_mean"))).alias(f"m_min_{k}") for k in range(months, 0, -1)]
    )


def mean_bid(bids: DataFrame, by: str) -> DataFrame:
    return bids.groupBy(by).agg(exact_mean("bid_price").alias("avg_bid"))
