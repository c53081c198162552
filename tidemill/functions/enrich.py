"""Row enrichments for market, news, user and event tables (``DataFrame -> DataFrame``)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .buckets import below
from .text import price_volatility

# Source groups of the news enrichment.
MAJOR_SOURCES = ("coindesk", "cointelegraph", "bitcoin.com")
AGGREGATOR_SOURCES = ("cryptopanic", "cryptonews")

AGE_LIMITS = ((30, "young"), (50, "middle"))
TAX_FACTOR = 1.1


def market_sentiment(change: Column) -> Column:
    return F.when(change > 0, "bullish").when(change < 0, "bearish").otherwise("neutral")


def sentiment_category(score: Column) -> Column:
    return F.when(score > 0.3, "positive").when(score < -0.3, "negative").otherwise("neutral")


def source_category(source: Column) -> Column:
    return (
        F.when(source.isin(*MAJOR_SOURCES), "major")
        .when(source.isin(*AGGREGATOR_SOURCES), "aggregator")
        .otherwise("other")
    )


def date_hour(df: DataFrame, event_time: str) -> DataFrame:
    """Add ``partition_date`` and ``partition_hour`` of an event-time column."""
    return df.withColumns(
        {
            "partition_date": F.to_date(event_time),
            "partition_hour": F.hour(event_time).cast("bigint"),
        }
    )


def enrich_market(df: DataFrame, now: Column | None = None) -> DataFrame:
    """Ingestion columns, sentiment and volume in millions; rows need a price and a time."""
    kept = df.filter(F.col("price").isNotNull() & F.col("timestamp").isNotNull())
    return date_hour(kept, "timestamp").withColumns(
        {
            "ingestion_time": F.current_timestamp() if now is None else now,
            "market_sentiment": market_sentiment(F.col("price_change_24h")),
            "volume_millions": F.round(F.col("volume_24h") / 1000000, 2),
        }
    )


def enrich_news(df: DataFrame, now: Column | None = None) -> DataFrame:
    """Ingestion columns, sentiment and source groups; rows need a title and a publish time."""
    kept = df.filter(F.col("title").isNotNull() & F.col("published_at").isNotNull())
    return date_hour(kept, "published_at").withColumns(
        {
            "ingestion_time": F.current_timestamp() if now is None else now,
            "sentiment_category": sentiment_category(F.col("sentiment_score")),
            "keyword_count": F.array_size("keywords").cast("bigint"),
            "source_category": source_category(F.col("source")),
        }
    )


def market_ratios(df: DataFrame) -> DataFrame:
    """Price and volume ratios with calendar parts; a zero denominator gives NULL."""
    time = F.col("timestamp")
    return df.select(
        "id",
        "timestamp",
        "price",
        "volume_24h",
        "market_cap",
        "price_change_24h",
        (F.col("price") * 1000000).alias("price_satoshi"),
        F.try_divide("market_cap", "circulating_supply").alias("price_per_coin"),
        (F.try_divide("volume_24h", "market_cap") * 100).alias("volume_market_cap_ratio"),
        price_volatility(F.col("price")).alias("volatility_level"),
        *[
            F.date_part(F.lit(part), time).cast("bigint").alias(part)
            for part in ("year", "month", "day", "hour")
        ],
    )


def news_votes(df: DataFrame) -> DataFrame:
    """Vote totals and engagement.

    ``engagement_score`` keeps the precedence the formula is written with: the integer quotient
    is taken first. ``engagement_ratio`` is the balance per vote that the name suggests.
    """
    good = F.col("votes_positive") + F.col("votes_liked")
    bad = F.col("votes_negative") + F.col("votes_disliked") + F.col("votes_toxic")
    votes = df.withColumns({"positive_votes": good, "negative_votes": bad})
    up, down = F.col("positive_votes"), F.col("negative_votes")
    return votes.select(
        "id",
        "title",
        "content",
        "sentiment_score",
        "positive_votes",
        "negative_votes",
        F.expr("positive_votes - (negative_votes div (positive_votes + negative_votes + 1))").alias(
            "engagement_score"
        ),
        ((up - down) / (up + down + 1)).alias("engagement_ratio"),
        sentiment_category(F.col("sentiment_score")).alias("sentiment_category"),
        F.length("title").cast("bigint").alias("title_length"),
        F.length("content").cast("bigint").alias("content_length"),
    )


def age_groups(df: DataFrame, age: str = "age") -> DataFrame:
    return df.withColumn("age_group", below(F.col(age), AGE_LIMITS, "senior"))


def revenue(df: DataFrame) -> DataFrame:
    """Purchase amounts as revenue, zero for every other event; rows need a user."""
    return df.filter(F.col("user_id").isNotNull()).select(
        "user_id",
        "event_type",
        "timestamp",
        F.when(F.col("event_type") == "purchase", F.col("amount")).otherwise(F.lit(0.0)).alias("revenue"),
        F.to_date("timestamp").alias("partition_date"),
    )
