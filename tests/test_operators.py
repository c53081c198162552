import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidemill.functions import enrich
from tidemill.operators.joins import daily_price_and_news
from tidemill.operators.overview import describe, overview
from tidemill.operators.quality import at_least_rules, completeness, profile, validate
from tidemill.operators.ranking import latest, number_rows, top_k, with_share
from tidemill.operators.routing import route, tagged
from tidemill.operators.sql import sql_transform
from tidemill.operators.ticker import preferred_quote, unpivot_ticker
from tidemill.plans import flights, reports, views

# Ranking


def skewed_rows():
    """One key holds a third of all rows, with many equal times; one key is NULL."""
    random.seed(7)
    rows = []
    for i in range(3000):
        key = "hot" if i % 3 == 0 else random.choice(["a", "b", "c", "d", None])
        rows.append((key, random.randrange(50), i))
    return rows


def brute_numbers(rows):
    expected, seen = {}, {}
    for key, time, unique in sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1], r[2])):
        seen[key] = seen.get(key, 0) + 1
        expected[unique] = seen[key]
    return expected


def test_row_numbers_do_not_depend_on_the_ranges(spark):
    rows = skewed_rows()
    df = spark.createDataFrame(rows, "k string, t int, u int")
    numbered = number_rows(df, ["k"], ["t", "u"], "n")
    assert numbered.columns == ["k", "t", "u", "n"] and dict(numbered.dtypes)["n"] == "bigint"
    assert {r["u"]: r["n"] for r in numbered.collect()} == brute_numbers(rows)


def test_row_numbers_of_nothing(spark):
    empty = spark.createDataFrame([], "k string, t int")
    assert number_rows(empty, ["k"], ["t"], "n").count() == 0


def test_hot_key_is_spread(spark):
    """Beyond the limit no task numbers more than its even share of the rows."""
    df = spark.createDataFrame(skewed_rows(), "k string, t int, u int")
    ranged = df.repartitionByRange(30, "k", "t", "u").groupBy(F.spark_partition_id()).count()
    assert ranged.agg(F.max("count")).first()[0] < 400


def test_top_k_latest_and_share(spark):
    df = spark.createDataFrame([("a", 1), ("b", 3), ("c", 3), ("d", 2)], "k string, v int")
    assert [r["k"] for r in top_k(df, 3, F.desc("v"), F.col("k")).collect()] == ["b", "c", "d"]
    assert latest(df, "v", "k").first()["k"] == "c"
    shares = {r["k"]: r["percentage"] for r in with_share(df, "v").collect()}
    assert shares == {"a": 11.11, "b": 33.33, "c": 33.33, "d": 22.22}
    assert "TakeOrderedAndProject" in top_k(df, 3, F.desc("v"))._jdf.queryExecution().toString()


# Joins


def test_grouped_join_equals_the_pairwise_join(spark):
    random.seed(3)
    day = dt.datetime(2024, 1, 1)
    prices = [(day + dt.timedelta(hours=random.randrange(200)), random.randrange(100) / 4, 1.0) for _ in range(200)]
    items = [
        (str(i) if i % 9 else None, day + dt.timedelta(hours=24 * random.randrange(6)), None if i % 5 == 0 else i / 8)
        for i in range(60)
    ]
    market = spark.createDataFrame(prices, "timestamp timestamp_ntz, price double, price_change_24h double")
    news = spark.createDataFrame(items, "id string, published_at timestamp_ntz, sentiment_score double")
    pairs = (
        market.alias("b")
        .join(news.alias("n"), F.to_date("b.timestamp") == F.to_date("n.published_at"), "left")
        .groupBy(F.to_date("b.timestamp").alias("date"))
        .agg(
            F.avg("b.price"),
            F.avg("b.price_change_24h"),
            F.count("n.id"),
            F.avg("n.sentiment_score"),
        )
    )

    def rows(df):
        return sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect())

    got = rows(daily_price_and_news(market, news))
    assert got == rows(pairs) and any(r[3] == 0 and r[4] is None for r in got)


# Quality and overview


def test_validation(spark):
    df = spark.createDataFrame([(1.0, "a"), (-1.0, None), (None, "b")], "price double, id string")
    rules = {**at_least_rules(["price"]), "id required": F.col("id").isNotNull()}
    good, bad = validate(df, rules)
    assert {r["price"] for r in good.collect()} == {1.0, None} and good.columns == ["price", "id"]
    assert [r["failed_rules"] for r in bad.collect()] == [["price below 0", "id required"]]
    assert validate(df, {})[1].count() == 0


def test_completeness(spark):
    df = spark.createDataFrame([(1, None), (2, "x"), (None, None)], "a int, b string")
    rows = {r["column_name"]: (r["total_records"], r["non_null_records"], float(r["completeness_pct"])) for r in completeness(df).collect()}
    assert rows == {"a": (3, 2, 66.67), "b": (3, 1, 33.33)}
    assert [r["column_name"] for r in completeness(df, ["b"]).collect()] == ["b"]
    assert completeness(df.limit(0)).first()["completeness_pct"] is None
    assert [r["column_type"] for r in profile(df).orderBy("position").collect()] == ["int", "string"]


def test_overview_and_describe(spark):
    df = spark.createDataFrame([(1, "x")], "a int, b string")
    rows = {r["table_name"]: tuple(r)[1:] for r in overview({"full": df, "none": df.limit(0)}).collect()}
    assert rows == {"full": (1, "active", "a, b"), "none": (0, "empty", "a, b")}
    assert [(r["col_name"], r["data_type"]) for r in describe(df).limit(20).collect()] == [("a", "int"), ("b", "string")]


# SQL and routing


def test_sql_transform_steps_do_not_see_each_other(spark):
    first = sql_transform(spark.range(3), "SELECT id * 2 AS x FROM input_data")
    second = sql_transform(spark.range(5), "SELECT COUNT(*) AS n FROM input_data")
    assert sorted(r["x"] for r in first.collect()) == [0, 2, 4] and second.first()["n"] == 5
    assert not spark.catalog.tableExists("input_data")
    with pytest.raises(Exception):
        sql_transform(spark.range(1), "SELECT nope FROM input_data")
    assert not spark.catalog.tableExists("input_data")


def test_sql_names_ignore_case(spark):
    df = spark.createDataFrame([(1,)], "fl_date int")
    assert sql_transform(df, "SELECT FL_DATE AS d FROM INPUT_DATA").first()["d"] == 1


def test_routing(spark):
    df = spark.range(10)
    parts = route(df, {"low": "id < 3", "even": F.col("id") % 2 == 0})
    assert parts["low"].count() == 3 and parts["even"].count() == 5
    both = tagged({"low": "id < 3", "even": F.col("id") % 2 == 0})(df)
    assert both.filter("branch = 'low'").count() == 3 and both.count() == 8


# Tickers

PAYLOAD = '{"USD":{"15m":11.0,"buy":9.0,"last":10.0,"sell":10.5,"symbol":"$"},"EUR":{"15m":0,"buy":1,"last":8.0,"sell":2,"symbol":"e"},"XXX":{"last":1}}'


def ticker(spark, *payloads):
    rows = [(i, p, dt.datetime(2024, 1, 1)) for i, p in enumerate(payloads)]
    return spark.createDataFrame(rows, "id int, value string, timestamp timestamp")


def test_unpivot(spark):
    rows = unpivot_ticker(ticker(spark, PAYLOAD, "{}", "bad"), currencies=" usd ,eur, gbp").collect()
    assert {(r["id"], r["currency"], r["price"], r["buy_price"], r["sell_price"], r["price_15m"]) for r in rows} == {
        (0, "USD", 10.0, 9.0, 10.5, 11.0), (0, "EUR", 8.0, 1.0, 2.0, 0.0),
    }


def test_preferred_quote(spark):
    eur = PAYLOAD.replace("USD", "ZZZ")
    none = '{"XXX":{"last":1}}'
    zero = '{"USD":{"15m":5,"last":0}}'
    rows = {r["id"]: r for r in preferred_quote(ticker(spark, PAYLOAD, eur, none, zero)).collect()}
    assert set(rows) == {0, 1, 3}
    assert rows[0]["currency"] == "USD" and abs(rows[0]["price_change"] - 10.0) < 1e-9
    assert rows[1]["currency"] == "EUR" and rows[1]["price_change"] == 0.0
    assert rows[3]["price_change"] == 0.0 and rows[3]["buy_price"] == 0.0


# Enrichments and reports


def test_market_ratios_with_zero_denominators(spark):
    df = spark.sql(
        "SELECT '1' AS id, TIMESTAMP_NTZ '2024-03-04 05:06:07' AS timestamp, 40000D AS price, 1D AS volume_24h, "
        "0D AS market_cap, 0D AS price_change_24h, 0D AS circulating_supply"
    )
    row = enrich.market_ratios(df).first()
    assert row["price_per_coin"] is None and row["volume_market_cap_ratio"] is None
    assert row["volatility_level"] == "medium" and row["price_satoshi"] == 4e10
    assert (row["year"], row["month"], row["day"], row["hour"]) == (2024, 3, 4, 5)


def test_enrich_market_and_news(spark):
    market = spark.sql(
        "SELECT * FROM VALUES (1D, TIMESTAMP '2024-01-01 05:00:00', 1234567D, 2D), (NULL, TIMESTAMP '2024-01-01 00:00:00', 1D, 0D) "
        "AS t(price, timestamp, volume_24h, price_change_24h)"
    )
    row = enrich.enrich_market(market).collect()
    assert len(row) == 1 and row[0]["market_sentiment"] == "bullish" and row[0]["volume_millions"] == 1.23
    assert row[0]["partition_hour"] == 5 and row[0]["ingestion_time"] is not None
    news = spark.sql(
        "SELECT * FROM VALUES ('t', TIMESTAMP '2024-01-01 05:00:00', 0.3D, array('a','b'), 'coindesk'), "
        "('t', TIMESTAMP '2024-01-01 05:00:00', 0.31D, NULL, 'cryptonews'), "
        "('t', TIMESTAMP '2024-01-01 05:00:00', -0.31D, array(), NULL) AS t(title, published_at, sentiment_score, keywords, source)"
    )
    rows = [(r["sentiment_category"], r["keyword_count"], r["source_category"]) for r in enrich.enrich_news(news).collect()]
    assert rows == [("neutral", 2, "major"), ("positive", None, "aggregator"), ("negative", 0, "other")]


def test_sql_leaves_a_view_of_its_name_alone(spark):
    spark.range(5).createOrReplaceTempView("input_data")
    try:
        assert sql_transform(spark.range(2), "SELECT * FROM input_data").count() == 2
        assert spark.table("input_data").count() == 5
    finally:
        spark.catalog.dropTempView("input_data")
    sql_transform(spark.range(2), "SELECT * FROM input_data")
    assert not spark.catalog.tableExists("input_data")


def test_engagement_keeps_written_precedence(spark):
    df = spark.sql(
        "SELECT '1' AS id, 't' AS title, 'cc' AS content, 0D AS sentiment_score, 3 AS votes_positive, 2 AS votes_liked, "
        "1 AS votes_negative, 1 AS votes_disliked, 0 AS votes_toxic"
    )
    row = enrich.news_votes(df).first()
    assert (row["positive_votes"], row["negative_votes"], row["engagement_score"]) == (5, 2, 5)
    assert row["engagement_ratio"] == 3 / 8 and row["content_length"] == 2


def test_ages_and_revenue(spark):
    ages = spark.createDataFrame([(29,), (30,), (49,), (50,)], "age int")
    assert [r["age_group"] for r in enrich.age_groups(ages).orderBy("age").collect()] == ["young", "middle", "middle", "senior"]
    events = spark.sql(
        "SELECT * FROM VALUES (1, 'purchase', TIMESTAMP '2024-01-01 05:00:00', 9D), (1, 'view', TIMESTAMP '2024-01-01 05:00:00', 9D), "
        "(NULL, 'purchase', TIMESTAMP '2024-01-01 05:00:00', 9D) AS t(user_id, event_type, timestamp, amount)"
    )
    assert [r["revenue"] for r in enrich.revenue(events).collect()] == [9.0, 0.0]


def test_performance_edges(spark):
    rows = [(0.0, 0.0), (0.0, 15.0), (15.0, 15.0), (16.0, None), (None, 16.0), (None, None), (-5.0, 3.0), (None, -1.0)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, d double, a double")
    labels = [r[0] for r in df.orderBy("i").select(flights.performance(F.col("d"), F.col("a"))).collect()]
    assert labels == ["Early", "On Time", "On Time", "Delayed", "Delayed", "Unknown", "Unknown", "Unknown"]
