"""Food-truck sales: the star view, loyalty metrics, daily weather, and daily
sales next to the weather."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import fahrenheit_to_celsius, inch_to_millimeter
from ..operators.aggregates import zero_filled_daily

# Names of the long-format measures.
SALES_MEASURE = "Daily Sales ($ millions)"
WEATHER_MEASURES = {
    "avg_temperature_fahrenheit": "Avg Temperature (°F)",
    "avg_precipitation_inches": "Avg Precipitation (in)",
    "max_wind_speed_100m_mph": "Max Wind Speed (mph)",
}
LOYALTY_KEYS = ["customer_id", "city", "country", "first_name", "last_name", "phone_number", "e_mail"]


def orders_star(detail, header, truck, menu, franchise, location, loyalty) -> DataFrame:
    """Order lines with their order, truck, menu item, franchise and location,
    and with the loyalty member where there is one.

    Only the columns of the view are taken from each table.  The small tables
    carry no broadcast hint: Spark checks their size itself.
    """
    od = detail.select("order_detail_id", "order_id", "line_number", "menu_item_id", "quantity", "unit_price", "price")
    oh = header.select(
        "order_id", "truck_id", "order_ts", F.col("location_id").cast("long").alias("location_id"), "customer_id",
        "order_amount", "order_tax_amount", "order_discount_amount", "order_total")
    t = truck.select("truck_id", "primary_city", "region", "country", "franchise_flag", "franchise_id")
    m = menu.select("menu_item_id", "truck_brand_name", "menu_type", "menu_item_name")
    f = franchise.select("franchise_id", F.col("first_name").alias("franchisee_first_name"),
                         F.col("last_name").alias("franchisee_last_name"))
    place = location.select("location_id")
    member = loyalty.select("customer_id", F.col("customer_id").alias("_member"), "first_name", "last_name", "e_mail",
                            "phone_number", "children_count", "gender", "marital_status")
    joined = (
        od.join(oh, "order_id").join(t, "truck_id").join(m, "menu_item_id").join(f, "franchise_id")
        .join(place, "location_id").join(member, "customer_id", "left")
    )
    return joined.select(
        "order_id", "truck_id", "order_ts", "order_detail_id", "line_number", "truck_brand_name", "menu_type",
        "primary_city", "region", "country", "franchise_flag", "franchise_id", "franchisee_first_name",
        "franchisee_last_name", "location_id", F.col("_member").alias("customer_id"), "first_name", "last_name",
        "e_mail", "phone_number", "children_count", "gender", "marital_status", "menu_item_id", "menu_item_name",
        "quantity", "unit_price", "price", "order_amount", "order_tax_amount", "order_discount_amount", "order_total",
    )


def orders_with_date(star: DataFrame) -> DataFrame:
    return star.select(F.to_date("order_ts").alias("date"), "*")


def loyalty_metrics(loyalty: DataFrame, header: DataFrame) -> DataFrame:
    """Total sales and visited locations per loyalty member.

    Orders are summed per (customer, location) and then per customer before
    they meet the members, so a customer with very many orders arrives as one
    row whose array holds distinct locations only.
    """
    per_place = header.groupBy("customer_id", F.col("location_id").cast("long").alias("location_id")).agg(
        F.sum("order_total").alias("s"))
    per_customer = per_place.groupBy("customer_id").agg(
        F.sum("s").alias("s"), F.array_sort(F.collect_list("location_id")).alias("visited"))
    return loyalty.select(*LOYALTY_KEYS).join(per_customer, "customer_id").groupBy(*LOYALTY_KEYS).agg(
        F.sum("s").alias("total_sales"), F.first("visited").alias("visited_location_ids_array"))


def city_daily_sales(star: DataFrame, country: str, city: str, start: dt.date, end: dt.date) -> DataFrame:
    """Sales of one city per day, with zero for days without sales."""
    here = (F.col("country") == country) & (F.col("primary_city") == city)
    return zero_filled_daily(star, "order_ts", "price", start, end, where=here, name="daily_sales")


def daily_weather(history: DataFrame, postal_codes: DataFrame, country: DataFrame) -> DataFrame:
    """Weather of the cities with trucks, one row per postal code and day."""
    codes = postal_codes.select("postal_code", "country", F.col("city_name").alias("city"))
    cities = country.select(F.col("iso_country").alias("country"), F.col("city").alias("city_name"),
                            F.col("country").alias("country_desc"))
    return (
        history.join(codes, ["postal_code", "country"]).join(cities, ["country", "city_name"])
        .withColumn("yyyy_mm", F.date_format("date_valid_std", "yyyy-MM"))
    )


def in_month(year: int, month: int) -> Column:
    """The month as a date range, which reaches the scan as a pushed filter."""
    first = dt.date(year, month, 1)
    after = dt.date(year + month // 12, month % 12 + 1, 1)
    return (F.col("date_valid_std") >= F.lit(first)) & (F.col("date_valid_std") < F.lit(after))


def city_weather(weather: DataFrame) -> DataFrame:
    """Average temperature and strongest wind per city and day."""
    return weather.groupBy("country_desc", "city_name", "date_valid_std").agg(
        F.avg("avg_temperature_air_2m_f").alias("avg_temperature_air_2m_f"),
        F.max("max_wind_speed_100m_mph").alias("max_wind_speed_100m_mph"))


def weather_sales(weather: DataFrame, star: DataFrame, corrected: bool = True) -> DataFrame:
    """Daily sales next to the weather, per city.

    A city has several postal codes, hence several weather rows per day, and a
    plain join counts every sale once for each of them.  ``corrected=False``
    gives exactly that result.  Neither form builds the join: every weather row
    of a day meets the same sales, so averages over the weather rows do not
    change and the sum is the sales times the number of weather rows.
    """
    f, inch = "avg_temperature_air_2m_f", "tot_precipitation_in"
    days = weather.groupBy(F.col("date_valid_std").alias("date"), "city_name", "country_desc").agg(
        F.count(F.lit(1)).alias("_rows"),
        F.round(F.avg(f), 2).alias("avg_temperature_fahrenheit"),
        F.round(F.avg(fahrenheit_to_celsius(f)), 2).alias("avg_temperature_celsius"),
        F.round(F.avg(inch), 2).alias("avg_precipitation_inches"),
        F.round(F.avg(inch_to_millimeter(inch)), 2).alias("avg_precipitation_millimeters"),
        F.max("max_wind_speed_100m_mph").alias("max_wind_speed_100m_mph"),
    )
    sales = star.groupBy(
        F.to_date("order_ts").alias("date"), F.col("primary_city").alias("city_name"), F.col("country").alias("country_desc")
    ).agg(F.sum("price").alias("_sales"))
    times = F.lit(1) if corrected else F.col("_rows")
    return days.join(sales, ["date", "city_name", "country_desc"], "left").select(
        "date", "city_name", "country_desc", F.zeroifnull(F.col("_sales") * times).alias("daily_sales"),
        "avg_temperature_fahrenheit", "avg_temperature_celsius", "avg_precipitation_inches",
        "avg_precipitation_millimeters", "max_wind_speed_100m_mph")


def trend_long(daily: DataFrame) -> DataFrame:
    """(date, measure, value): sales in millions, then the weather series."""
    sales = daily.select("date", F.lit(SALES_MEASURE).alias("measure"),
                         (F.col("daily_sales").cast("double") / 1000000).alias("value"))
    series = daily.select("date", *[F.col(c).cast("double").alias(c) for c in WEATHER_MEASURES])
    names = F.create_map(*[F.lit(x) for pair in WEATHER_MEASURES.items() for x in pair])
    weather = series.unpivot(["date"], list(WEATHER_MEASURES), "measure", "value").withColumn(
        "measure", F.element_at(names, F.col("measure")))
    return sales.unionByName(weather)
