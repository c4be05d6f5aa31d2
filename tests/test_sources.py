import datetime as dt

import pytest
from pyspark.sql import functions as F

from freshet.functions import columns as c
from freshet.functions import semistructured as s
from freshet.operators import aggregates as agg
from freshet.plans import retail, trucks
from freshet.plans.semantic import INVOICE_MODEL, KeyViolation, LogicalTable, ManyToOne, SemanticModel
from freshet.sources import files, generators, verify


def test_quoted_csv_and_strict_types(spark, tmp_path, rows):
    path = tmp_path / "in.csv"
    path.write_text('id,text\n1,"a, ""quoted"" cell"\n2,plain\n')
    assert rows(files.read_table(spark, str(path), "id int, text string", header=True)) == [(1, 'a, "quoted" cell'), (2, "plain")]
    path.write_text("id,text\nnot a number,x\n")
    with pytest.raises(Exception, match="MALFORMED|malformed"):
        files.read_table(spark, str(path), "id int, text string", header=True).collect()


def test_json_lines_skip_blanks(spark, tmp_path, rows):
    path = tmp_path / "in.jsonl"
    path.write_text('{"id": "q1", "check": "x"}\n\n{"id": "q2"}\n')
    assert rows(files.read_json_lines(spark, str(path), "id string, check string")) == [("q1", "x"), ("q2", None)]


def test_run_folder(spark, tmp_path):
    out = files.write_run(spark.range(3), str(tmp_path), dt.datetime(2025, 1, 2, 3, 4, 5))
    assert out.endswith("run=20250102T030405Z") and spark.read.json(out).count() == 3


def test_generators_are_seeded_and_in_range(spark):
    a, z = (generators.gen_purchases(spark, 500, 10, as_of="2025-06-01") for _ in range(2))
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, z.collect()))
    orders = retail.stage_orders(a).agg(
        F.min("customer_id"), F.max("customer_id"), F.min("product_id"), F.max("product_id"), F.min("quantity"), F.max("quantity"),
        F.min("order_price"), F.max("order_price"), F.min("order_date"), F.max("order_date")).first()
    assert 1001 <= orders[0] and orders[1] <= 1999 and 101 <= orders[2] and orders[3] <= 199 and (orders[4], orders[5]) == (1, 5)
    assert 10 <= orders[6] and orders[7] <= 1000 and orders[8] >= dt.date(2025, 5, 22) and orders[9] <= dt.date(2025, 6, 1)
    customers = generators.gen_customers(spark, 1000).agg(F.min("custid"), F.max("custid")).first()
    assert (int(customers[0]), int(customers[1])) == (1001, 2000)
    stock = generators.gen_products(spark, 100).agg(F.min("pid"), F.min("stock"), F.max("stock")).first()
    assert stock[0] == 101 and stock[1] >= 500 and stock[2] <= 1000


def test_staged_orders_survive_bad_json(spark, rows):
    df = spark.createDataFrame([(1, '{"prodid": 5, "quantity": 2}'), (2, "not json"), (3, None)], "custid int, purchase string")
    assert rows(retail.stage_orders(df), "customer_id", "product_id", "quantity") == [(1, 5, 2), (2, None, None), (3, None, None)]
    customers = spark.createDataFrame([(1, "a"), (9, "z")], "customer_id int, customer_name string")
    fact = retail.customer_orders(customers, retail.stage_orders(df))
    assert rows(fact, "customer_id", "product_id") == [(1, 5), (9, None)]
    assert rows(retail.customer_orders(customers, retail.stage_orders(df), with_product=True), "customer_id") == [(1,)]


def test_dotted_keys_and_states(spark):
    df = spark.createDataFrame([('{"a.b": "x", "a": {"b": "y"}}', '{"STATE": "SUSPENDED"}'), ("{}", "ACTIVE")], "j string, st string")
    got = s.extract(df, "j", {"v": ("a.b", "string")}).select("v", s.state_of("st")).collect()
    assert [tuple(r) for r in got] == [("x", "SUSPENDED"), (None, "ACTIVE")]


def test_load_checks(spark):
    full, empty = spark.range(2), spark.range(0)
    assert verify.load_check(spark, {"a": full, "b": full}).first().state == "COMPLETE"
    assert verify.load_check(spark, {"a": full, "b": None}).first().message == "found 1 of 2 expected tables"
    assert verify.load_check(spark, {"a": full, "b": empty}).first().state == "INCOMPLETE"
    status = {r.column_name: r.status for r in verify.compare_columns(
        spark.range(1).withColumn("x", F.lit(1)), spark.range(1).withColumn("x", F.lit("1")).withColumn("y", F.lit(1))).collect()}
    assert status == {"id": "same", "x": "type_differs", "y": "only_right"}


def test_units_and_masking(spark):
    df = spark.createDataFrame([(41.5, 1.0)], "f double, inch double")
    row = df.select(c.fahrenheit_to_celsius("f"), c.inch_to_millimeter("inch"), c.masked("f", "ANALYST", ["ADMIN"]), c.masked("inch", "ADMIN", ["ADMIN"])).first()
    assert (str(row[0]), str(row[1]), row[2], row[3]) == ("5.2778", "25.4000", 0, 1.0)
    text = spark.createDataFrame([("it's", None)], "a string, b int")
    assert tuple(text.select(c.escape_quotes("a"), c.row_text("a", "b")).first()) == ("it''s", "it's, None")


def test_seconds_are_cut_before_they_are_subtracted(spark):
    df = spark.createDataFrame([(dt.datetime(2025, 1, 1, 0, 0, 0, 900000), dt.datetime(2025, 1, 1, 0, 0, 2, 100000))], "a timestamp_ntz, b timestamp_ntz")
    assert df.select(c.seconds_between("a", "b")).first()[0] == 2


def test_percentiles_ignore_nulls(spark):
    df = spark.createDataFrame([("a", v) for v in (1, 1, 2, 10, None)] + [("b", None)], "k string, v int")
    assert [tuple(r) for r in agg.percentiles(df, ["k"], F.col("v"), {"p": 0.5}).collect()] == [("a", 1.5)]


def test_two_stage_average_skips_nulls(spark):
    df = spark.createDataFrame([(1, 10.0, "x"), (1, None, "y"), (2, 20.0, "x")], "day int, v double, who string")
    _, monthly = agg.two_stage(df, {"day": F.col("day")}, {"all": F.lit(0)}, "v", distinct="who")
    row = monthly.first()
    assert (row.rows, row.total, row.average, row.distinct_who) == (3, 30.0, 15.0, 2)


def test_weather_fan_out_equals_the_plain_join(spark):
    weather = spark.createDataFrame([
        (dt.date(2022, 2, 1), "1", "Hamburg", "Germany", 40.0, 0.1, 20.0), (dt.date(2022, 2, 1), "2", "Hamburg", "Germany", 50.0, 0.3, 30.0),
        (dt.date(2022, 2, 2), "1", "Hamburg", "Germany", 41.0, 0.0, 10.0)],
        "date_valid_std date, postal_code string, city_name string, country_desc string, avg_temperature_air_2m_f double, tot_precipitation_in double, max_wind_speed_100m_mph double")
    star = spark.createDataFrame([(dt.datetime(2022, 2, 1, 9), "Hamburg", "Germany", 10), (dt.datetime(2022, 2, 1, 10), "Hamburg", "Germany", 5)],
                                 "order_ts timestamp_ntz, primary_city string, country string, price int")
    plain = weather.join(star, [weather.date_valid_std == F.to_date("order_ts"), weather.city_name == star.primary_city], "left").groupBy(
        "date_valid_std").agg(F.zeroifnull(F.sum("price")).alias("s"), F.round(F.avg("avg_temperature_air_2m_f"), 2).alias("t"))
    expected = {r.date_valid_std: (r.s, r.t) for r in plain.collect()}
    faithful = trucks.weather_sales(weather, star, corrected=False).collect()
    assert {r.date: (r.daily_sales, r.avg_temperature_fahrenheit) for r in faithful} == expected
    corrected = {r.date: r.daily_sales for r in trucks.weather_sales(weather, star).collect()}
    assert corrected == {dt.date(2022, 2, 1): 15, dt.date(2022, 2, 2): 0}
    long = trucks.trend_long(trucks.weather_sales(weather, star))
    assert long.count() == 8 and {r.measure for r in long.collect()} == {trucks.SALES_MEASURE, *trucks.WEATHER_MEASURES.values()}


def test_campaign_feedback_keeps_campaign_rows(spark, rows):
    campaigns = spark.createDataFrame([("c", "x", 5), ("c", "x", 5), ("c", "y", 1)], "category string, campaign_name string, clicks int")
    cases = spark.createDataFrame([("c", 0.5), ("c", 0.5), ("d", 1.0)], "product string, sentiment double")
    assert rows(retail.campaign_feedback(campaigns, cases)) == [("x", 5, "c", 0.5), ("x", 5, "c", 0.5), ("y", 1, "c", 0.5)]


def test_semantic_keys_and_names(spark):
    model = SemanticModel(
        tables={"f": LogicalTable(primary_key=["id"], metrics={"n": "count(*)"}), "d": LogicalTable(primary_key=["k"], dimensions={"name": "name"})},
        relations=[ManyToOne("f", ["k"], "d", ["k"])])
    fact = spark.createDataFrame([(1, "a"), (2, "a"), (3, None)], "id int, k string")
    once = spark.createDataFrame([("a", "A")], "k string, name string")
    model.check_keys({"f": fact, "d": once})
    with pytest.raises(KeyViolation):
        model.check_keys({"f": fact, "d": once.union(once)})
    got = {r.name: r.n for r in model.query({"f": fact, "d": once}, ["n"], ["name"]).collect()}
    assert got == {"A": 2, None: 1}
    with pytest.raises(KeyError):
        model.query({"f": fact, "d": once}, ["unknown"])
    assert INVOICE_MODEL.resolve("bill") == "invoices" and INVOICE_MODEL.resolve("Supplier Name") == "vendor_name"
