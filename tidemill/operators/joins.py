"""Joins on computed day keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def daily_price_and_news(market: DataFrame, news: DataFrame) -> DataFrame:
    """Per day: mean price and change, number of (price, news) pairs, mean sentiment.

    This equals joining every price with every news item of its day and grouping by day. Both
    sides are grouped first, so the join sees one row per day on each side: a pair count is the
    product of the two counts, and the means do not depend on how often a row is repeated.
    Days without news keep a NULL sentiment and count 0.
    """
    prices = market.groupBy(F.to_date("timestamp").alias("date")).agg(
        F.avg("price").alias("avg_price"),
        F.avg("price_change_24h").alias("avg_price_change"),
        F.count(F.lit(1)).alias("prices"),
    )
    items = news.groupBy(F.to_date("published_at").alias("news_date")).agg(
        F.count("id").alias("items"), F.avg("sentiment_score").alias("avg_sentiment")
    )
    pairs: Column = F.col("prices") * F.coalesce("items", F.lit(0))
    return prices.join(items, prices["date"] == items["news_date"], "left").select(
        "date", "avg_price", "avg_price_change", pairs.alias("news_count"), "avg_sentiment"
    )
