"""Reports over news items, and news against prices."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import daily_price_and_news
from ..operators.ranking import top_k
from .market import since


def recent_count(df: DataFrame, as_of: str, hours: int = 24) -> DataFrame:
    return df.filter(since("published_at", as_of, hours=hours)).agg(F.count(F.lit(1)).alias("count"))


def sentiment_mix(df: DataFrame, as_of: str | None = None, days: int = 7) -> DataFrame:
    """Articles per sentiment category; over all time without ``as_of``."""
    recent = df if as_of is None else df.filter(since("published_at", as_of, days))
    return (
        recent.groupBy("sentiment_category")
        .agg(F.count(F.lit(1)).alias("count"), F.avg("sentiment_score").alias("avg_sentiment"))
        .orderBy(F.desc("count"))
    )


def top_sources(df: DataFrame, as_of: str, days: int = 7, sources: int = 5) -> DataFrame:
    grouped = (
        df.filter(since("published_at", as_of, days)).groupBy("source").agg(F.count(F.lit(1)).alias("article_count"))
    )
    return top_k(grouped, sources, F.desc("article_count"), F.col("source"))


def price_against_news(market: DataFrame, news: DataFrame, as_of: str, days: int = 30) -> DataFrame:
    """Means over the days that have news. Only days that can meet are read on either side."""
    recent = news.filter(since("published_at", as_of, days))
    daily = daily_price_and_news(market.filter(since("timestamp", as_of, days)), recent)
    return daily.filter(F.col("news_count") > 0).agg(
        F.count(F.lit(1)).alias("days_with_data"),
        F.avg("avg_price").alias("avg_daily_price"),
        F.avg("news_count").alias("avg_daily_news"),
        F.avg("avg_sentiment").alias("avg_daily_sentiment"),
    )


def daily_news(df: DataFrame, as_of: str, days: int = 30) -> DataFrame:
    return (
        df.filter(since("published_at", as_of, days))
        .groupBy(F.to_date("published_at").alias("date"))
        .agg(
            F.count(F.lit(1)).alias("news_count"),
            F.avg("sentiment_score").alias("avg_sentiment"),
            F.sum("votes_positive").alias("total_positive_votes"),
        )
        .orderBy("date")
    )
