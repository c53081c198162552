"""The report tables (flights, retail, tracks, market, news, users, orders) over the test tables.

Each is a projection of one table, so filters and column pruning reach the Parquet scan.
``ORACLE`` holds the same definitions for the SQL oracle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.buckets import at_least, below
from ..functions.enrich import market_sentiment, sentiment_category, source_category
from ..functions.text import extract_keywords, sentiment_score

# The fixed moment that "last N days" counts back from.
AS_OF = "2024-01-31 00:00:00"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def _hundredths(column: str) -> Column:
    return (F.col(column) % 101).cast("double") / F.lit(100.0)


def _one_of(key: str, *values: str) -> Column:
    """One of the values for each row, in turn by a key: reports then meet every label they have."""
    at = (F.col(key) % len(values) + 1).cast("int")
    return F.element_at(F.array(*[F.lit(v) for v in values]), at)


# What a news text ends in, and sources in turn: all words and groups that the enrichments look for.
ENDINGS = ("", " A crash and a fall.", " Bitcoin and DeFi rally up!", " NFT drop, negative, down", " crypto BTC blockchain", " Surge and gain")
SOURCES = ("coindesk", "cryptonews", "src1", "src2", "bitcoin.com", "cryptopanic", "cointelegraph")


def flights(spark: SparkSession, folder: str) -> DataFrame:
    known = F.col("l_orderkey") % 17 != 0
    return table(spark, folder, "lineitem").select(
        F.to_date("l_shipdate").alias("fl_date"),
        F.when(known, F.col("l_quantity") - 20).alias("dep_delay"),
        F.when(F.col("l_orderkey") % 13 != 0, F.col("l_linenumber") * 10 - 25).cast("double").alias("arr_delay"),
        (F.col("l_extendedprice") / 40).alias("distance"),
        (F.col("l_quantity") * 5).alias("air_time"),
        F.col("l_orderkey").alias("order_key"),
        F.col("l_linenumber").alias("line_number"),
    )


def retail(spark: SparkSession, folder: str) -> DataFrame:
    rating = F.lit(1.0) + (F.col("p_size") % 41).cast("double") / F.lit(10.0)
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("product_key"),
        F.col("p_brand").alias("brand"),
        F.col("p_type").alias("category"),
        ((F.col("p_retailprice") - 899) * 60).alias("actual_price"),
        rating.alias("average_rating"),
        (F.col("p_size") % 7 == 0).alias("out_of_stock"),
        F.concat(_one_of("p_partkey", "$1,", "$", "$12,"), F.lpad(F.col("p_size").cast("string"), 3, "0")).alias("price_text"),
        F.concat(
            (1 + F.floor((F.col("p_size") % 41) / 10)).cast("string"), F.lit("."), (F.col("p_size") % 41 % 10).cast("string")
        ).alias("rating_text"),
        F.col("p_size").cast("string").alias("no_of_ratings"),
    )


def tracks(spark: SparkSession, folder: str) -> DataFrame:
    base = table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("order_key"),
        F.col("l_linenumber").alias("key"),
        _hundredths("l_partkey").alias("valence"),
        _hundredths("l_suppkey").alias("energy"),
        (F.col("l_quantity") / F.lit(50.0)).alias("danceability"),
        (60 + F.col("l_orderkey") % 121).cast("double").alias("tempo"),
        (60000 + (F.col("l_orderkey") * 7919) % 360000).alias("duration_ms"),
    )
    return base.withColumns(
        {
            "danceability_category": at_least(
                F.col("danceability"), ((0.7, "highly_danceable"), (0.5, "danceable")), "not_danceable"
            ),
            "energy_category": at_least(
                F.col("energy"), ((0.7, "high_energy"), (0.4, "medium_energy")), "low_energy"
            ),
            "mood_category": at_least(
                F.col("valence"), ((0.7, "very_positive"), (0.5, "positive"), (0.3, "neutral")), "negative"
            ),
            "tempo_category": below(F.col("tempo"), ((80, "slow"), (120, "medium"), (160, "fast")), "very_fast"),
            "duration_seconds": F.col("duration_ms") / F.lit(1000.0),
        }
    )


def raw_market(spark: SparkSession, folder: str) -> DataFrame:
    """Market rows as they arrive, before enrichment."""
    return table(spark, folder, "events").select(
        F.col("event_id").cast("string").alias("id"),
        F.col("ts").alias("timestamp"),
        F.col("event_type").alias("currency"),
        (F.col("value") * 1000).alias("price"),
        (F.col("value") * 1e7).alias("volume_24h"),
        (F.col("value") * 1e9).alias("market_cap"),
        (F.col("value") - 50).alias("price_change_24h"),
        F.lit(1e6).alias("circulating_supply"),
    )


def market(spark: SparkSession, folder: str) -> DataFrame:
    return raw_market(spark, folder).withColumn(
        "market_sentiment", market_sentiment(F.col("price_change_24h"))
    )


def raw_news(spark: SparkSession, folder: str) -> DataFrame:
    """News rows as they arrive. The title is the first line; scores cover the whole text."""
    content = F.concat("text", _one_of("doc_id", *ENDINGS))
    published = F.timestamp_add("DAY", (F.col("doc_id") % 30).cast("int"), F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
    return table(spark, folder, "documents").select(
        F.col("doc_id").cast("string").alias("id"),
        F.substring_index("text", "\n", 1).alias("title"),
        content.alias("content"),
        _one_of("doc_id", *SOURCES).alias("source"),
        published.alias("published_at"),
        sentiment_score(content).alias("sentiment_score"),
        extract_keywords(content).alias("keywords"),
        *[
            (F.col("doc_id") % divisor).cast("int").alias(f"votes_{name}")
            for name, divisor in (("positive", 7), ("liked", 5), ("negative", 3), ("disliked", 2))
        ],
        F.lit(0).alias("votes_toxic"),
    )


def news(spark: SparkSession, folder: str) -> DataFrame:
    return raw_news(spark, folder).withColumns(
        {
            "sentiment_category": sentiment_category(F.col("sentiment_score")),
            "source_category": source_category(F.col("source")),
        }
    )


def users(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "customer").select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("name"),
        (18 + F.col("c_custkey") % 60).alias("age"),
        F.col("c_mktsegment").alias("city"),
    )


def sales(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("timestamp"),
        F.col("o_totalprice").alias("amount"),
    )


ORACLE = {
    "v_flights": """
        select cast(l_shipdate as date) as fl_date,
               case when l_orderkey % 17 = 0 then null else l_quantity - 20 end as dep_delay,
               cast(case when l_orderkey % 13 <> 0 then l_linenumber * 10 - 25 end as double) as arr_delay,
               l_extendedprice / 40 as distance, l_quantity * 5 as air_time,
               l_orderkey as order_key, l_linenumber as line_number
        from lineitem""",
    "v_retail": """
        select p_partkey as product_key, p_brand as brand, p_type as category,
               (p_retailprice - 899) * 60 as actual_price,
               cast(1 as double) + cast(p_size % 41 as double) / cast(10 as double) as average_rating,
               (p_size % 7 = 0) as out_of_stock,
               concat(['$1,', '$', '$12,'][p_partkey % 3 + 1], lpad(cast(p_size as varchar), 3, '0')) as price_text,
               concat(cast(1 + (p_size % 41) // 10 as varchar), '.', cast(p_size % 41 % 10 as varchar)) as rating_text,
               cast(p_size as varchar) as no_of_ratings
        from part""",
    "v_tracks": """
        select *, case when danceability >= 0.7 then 'highly_danceable'
                       when danceability >= 0.5 then 'danceable' else 'not_danceable' end as danceability_category,
               case when energy >= 0.7 then 'high_energy'
                    when energy >= 0.4 then 'medium_energy' else 'low_energy' end as energy_category,
               case when valence >= 0.7 then 'very_positive' when valence >= 0.5 then 'positive'
                    when valence >= 0.3 then 'neutral' else 'negative' end as mood_category,
               case when tempo < 80 then 'slow' when tempo < 120 then 'medium'
                    when tempo < 160 then 'fast' else 'very_fast' end as tempo_category,
               duration_ms / cast(1000 as double) as duration_seconds
        from (select l_orderkey as order_key, l_linenumber as key,
                     cast(l_partkey % 101 as double) / cast(100 as double) as valence,
                     cast(l_suppkey % 101 as double) / cast(100 as double) as energy,
                     l_quantity / cast(50 as double) as danceability,
                     cast(60 + l_orderkey % 121 as double) as tempo,
                     60000 + (l_orderkey * 7919) % 360000 as duration_ms
              from lineitem)""",
    "v_market": """
        select cast(event_id as varchar) as id, ts as timestamp, event_type as currency, value * 1000 as price,
               value * cast(1e7 as double) as volume_24h, value * cast(1e9 as double) as market_cap,
               value - 50 as price_change_24h, cast(1e6 as double) as circulating_supply,
               case when value - 50 > 0 then 'bullish' when value - 50 < 0 then 'bearish' else 'neutral' end
                   as market_sentiment
        from events""",
    "v_news": f"""
        select *, case when sentiment_score > 0.3 then 'positive' when sentiment_score < -0.3 then 'negative'
                       else 'neutral' end as sentiment_category,
               case when source in ('coindesk', 'cointelegraph', 'bitcoin.com') then 'major'
                    when source in ('cryptopanic', 'cryptonews') then 'aggregator' else 'other' end as source_category
        from (select cast(doc_id as varchar) as id, split_part(first_text, chr(10), 1) as title, text as content, source,
                     timestamp '2024-01-01 00:00:00' + to_days(cast(doc_id % 30 as integer)) as published_at,
                     cast(p - n as double) / cast(p + n + 1 as double) as sentiment_score, keywords,
                     cast(doc_id % 7 as integer) as votes_positive, cast(doc_id % 5 as integer) as votes_liked,
                     cast(doc_id % 3 as integer) as votes_negative, cast(doc_id % 2 as integer) as votes_disliked,
                     0 as votes_toxic
              from (select *,
                           len(list_filter(['bull', 'bullish', 'surge', 'rally', 'gain', 'up', 'positive'],
                                           lambda w: contains(lower(text), w))) as p,
                           len(list_filter(['bear', 'bearish', 'crash', 'drop', 'fall', 'down', 'negative'],
                                           lambda w: contains(lower(text), w))) as n,
                           list_filter(['bitcoin', 'btc', 'crypto', 'blockchain', 'defi', 'nft'],
                                       lambda w: contains(lower(text), w)) as keywords
                    from (select doc_id, text as first_text, concat(text, {list(ENDINGS)}[doc_id % {len(ENDINGS)} + 1]) as text,
                                 {list(SOURCES)}[doc_id % {len(SOURCES)} + 1] as source from documents)))""",
    "v_users": """
        select c_custkey as id, c_name as name, 18 + c_custkey % 60 as age, c_mktsegment as city from customer""",
    "v_sales": """
        select o_orderkey as order_id, o_custkey as customer_id, o_orderdate as timestamp, o_totalprice as amount
        from orders""",
}


def with_views(sql: str) -> str:
    """The oracle query with the definitions of the views it names put in front."""
    used = [f"{name} as ({body})" for name, body in ORACLE.items() if name in sql]
    return f"with {', '.join(used)} {sql}" if used else sql
