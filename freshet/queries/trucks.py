"""Food-truck views and the weather next to them."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from .. import bindings as b
from ..plans import trucks as t
from . import query
from .invoices import amounts

STAR = """star AS (SELECT o_orderkey AS order_id, CAST(c.c_nationkey AS BIGINT) AS truck_id, o_orderdate AS order_ts, l_orderkey * 10 + l_linenumber AS order_detail_id,
  CAST(l_linenumber AS BIGINT) AS line_number, p_brand AS truck_brand_name, p_type AS menu_type, n_name AS primary_city, r_name AS region, r_name AS country,
  CAST(n_regionkey AS BIGINT) AS franchise_id, r_name AS franchisee_first_name, CAST(c.c_nationkey + 1000 AS BIGINT) AS location_id,
  m.c_custkey AS customer_id, m.c_name AS first_name, p_partkey AS menu_item_id, p_name AS menu_item_name, CAST(l_quantity AS DOUBLE) AS quantity,
  CAST(l_extendedprice AS DECIMAL(18,4)) AS price, CAST(o_totalprice AS DECIMAL(18,4)) AS order_total
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer c ON c.c_custkey = o_custkey JOIN nation ON n_nationkey = c.c_nationkey
  JOIN region ON r_regionkey = n_regionkey JOIN part ON p_partkey = l_partkey LEFT JOIN customer m ON m.c_custkey = o_custkey AND m.c_acctbal > 0)"""
SHOWN = ["order_id", "truck_id", "order_detail_id", "line_number", "truck_brand_name", "menu_type", "primary_city", "country", "franchise_id",
         "franchisee_first_name", "location_id", "customer_id", "first_name", "menu_item_id", "menu_item_name"]


@query("orders_star_view", f"""
WITH {STAR} SELECT CAST(order_ts AS DATE) AS date, {', '.join(SHOWN)}, quantity, CAST(price AS DOUBLE) AS price, CAST(order_total AS DOUBLE) AS order_total FROM star""")
def _(spark, sf):
    star = t.orders_with_date(b.star(spark, sf))
    return amounts(star.select("date", *SHOWN, "quantity", "price", "order_total"), "quantity", "price", "order_total")


@query("loyalty_metrics", """
SELECT c_custkey AS customer_id, c_name AS first_name, CAST(sum(CAST(o_totalprice AS DECIMAL(18,4))) AS DOUBLE) AS total_sales,
  string_agg(DISTINCT CAST(c_nationkey + 1000 AS VARCHAR), ',') AS visited_location_ids_array
FROM customer JOIN orders ON o_custkey = c_custkey WHERE c_acctbal > 0 GROUP BY 1, 2""")
def _(spark, sf):
    tables = b.trucks(spark, sf)
    df = t.loyalty_metrics(tables["loyalty"], tables["header"])
    return amounts(df, "total_sales").select("customer_id", "first_name", "total_sales",
                                             F.array_join("visited_location_ids_array", ",").alias("visited_location_ids_array"))


@query("city_daily_sales", f"""
WITH {STAR} SELECT CAST(d AS DATE) AS day, coalesce(CAST(sum(price) AS DOUBLE), 0) AS daily_sales FROM generate_series(DATE '1999-02-01', DATE '1999-02-28', INTERVAL 1 DAY) g(d)
LEFT JOIN star ON CAST(order_ts AS DATE) = d AND country = 'EUROPE' AND primary_city = 'NATION_3' GROUP BY 1""")
def _(spark, sf):
    return amounts(t.city_daily_sales(b.star(spark, sf), "EUROPE", "NATION_3", dt.date(1999, 2, 1), dt.date(1999, 2, 28)), "daily_sales")


WEATHER = """weather AS (SELECT CAST(l_shipdate AS DATE) AS date, CAST(l_suppkey AS VARCHAR) AS postal_code, n_name AS city_name, r_name AS country_desc,
  CAST(max(l_quantity) + 30 AS DECIMAL(10,4)) AS f, CAST(max(l_discount) AS DECIMAL(10,4)) AS inch, CAST(max(l_tax) * 1000 AS DECIMAL(10,4)) AS wind
  FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey GROUP BY 1, 2, 3, 4)"""


@query("daily_weather_view", f"""
WITH {WEATHER} SELECT date AS date_valid_std, postal_code, city_name, city_name AS city, country_desc, strftime(date, '%Y-%m') AS yyyy_mm, CAST(f AS DOUBLE) AS avg_temperature_air_2m_f FROM weather""")
def _(spark, sf):
    df = b.weather(spark, sf).select("date_valid_std", "postal_code", "city_name", "city", "country_desc", "yyyy_mm", "avg_temperature_air_2m_f")
    return amounts(df, "avg_temperature_air_2m_f")


@query("city_weather_of_month", f"""
WITH {WEATHER} SELECT country_desc, city_name, date AS date_valid_std, CAST(sum(f) AS DOUBLE) / count(*) AS avg_temperature_air_2m_f, CAST(max(wind) AS DOUBLE) AS max_wind_speed_100m_mph
FROM weather WHERE year(date) = 1999 AND month(date) = 2 GROUP BY 1, 2, 3""".replace("CAST(sum(f) AS DOUBLE) / count(*)", "round(CAST(sum(f) AS DOUBLE) / count(*), 4)"))
def _(spark, sf):
    df = t.city_weather(b.weather(spark, sf).where(t.in_month(1999, 2)))
    df = amounts(df, "avg_temperature_air_2m_f", "max_wind_speed_100m_mph")
    return df.withColumn("avg_temperature_air_2m_f", F.round("avg_temperature_air_2m_f", 4))


@query("city_weather_view", f"""
WITH {WEATHER} SELECT country_desc, city_name, date AS date_valid_std, CAST(max(wind) AS DOUBLE) AS max_wind_speed_100m_mph FROM weather GROUP BY 1, 2, 3""")
def _(spark, sf):
    return amounts(t.city_weather(b.weather(spark, sf)).drop("avg_temperature_air_2m_f"), "max_wind_speed_100m_mph")


def sales_sql(corrected: bool) -> str:
    """The plain join, with every sale once per weather row, or with both sides
    summed up first."""
    if corrected:
        sales = """(SELECT date, city_name, country_desc, avg(f) AS f, avg(c) AS c, avg(inch) AS inch, avg(mm) AS mm, max(wind) AS wind FROM units GROUP BY 1, 2, 3) u
        LEFT JOIN (SELECT CAST(order_ts AS DATE) AS d, primary_city, country, sum(price) AS price FROM star GROUP BY 1, 2, 3) o"""
    else:
        sales = "units u LEFT JOIN (SELECT CAST(order_ts AS DATE) AS d, primary_city, country, price FROM star) o"
    return f"""WITH {STAR}, {WEATHER}, units AS (SELECT *, CAST((f - 32) * 5 / 9 AS DECIMAL(35,4)) AS c, CAST(inch * 25.4 AS DECIMAL(35,4)) AS mm FROM weather)
    SELECT date, city_name, country_desc, coalesce(CAST(sum(price) AS DOUBLE), 0) AS daily_sales, round(avg(f), 2) AS avg_temperature_fahrenheit,
      round(avg(c), 2) + 0.0 AS avg_temperature_celsius, round(avg(inch), 2) AS avg_precipitation_inches, round(avg(mm), 2) AS avg_precipitation_millimeters,
      CAST(max(wind) AS DOUBLE) AS max_wind_speed_100m_mph
    FROM {sales} ON d = date AND primary_city = city_name AND country = country_desc GROUP BY 1, 2, 3"""


NUMBERS = ["daily_sales", "avg_temperature_fahrenheit", "avg_temperature_celsius", "avg_precipitation_inches", "avg_precipitation_millimeters", "max_wind_speed_100m_mph"]


@query("weather_and_sales_fan_out", sales_sql(False))
def _(spark, sf):
    return amounts(t.weather_sales(b.weather(spark, sf), b.star(spark, sf), corrected=False), *NUMBERS)


@query("weather_and_sales_corrected", sales_sql(True))
def _(spark, sf):
    return amounts(t.weather_sales(b.weather(spark, sf), b.star(spark, sf)), *NUMBERS)


@query("trend_long_format", f"""
WITH x AS ({sales_sql(True)})
SELECT date, 'Daily Sales ($ millions)' AS measure, daily_sales / 1000000 AS value FROM x
UNION ALL SELECT date, 'Avg Temperature (°F)', avg_temperature_fahrenheit FROM x UNION ALL SELECT date, 'Avg Precipitation (in)', avg_precipitation_inches FROM x
UNION ALL SELECT date, 'Max Wind Speed (mph)', max_wind_speed_100m_mph FROM x""")
def _(spark, sf):
    return t.trend_long(t.weather_sales(b.weather(spark, sf), b.star(spark, sf)))
