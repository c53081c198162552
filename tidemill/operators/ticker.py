"""Ticker payloads: a JSON map from currency to quotes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Default currencies in order of preference, and the payload's fields.
CURRENCIES = ("USD", "EUR", "GBP", "JPY", "CNY", "CAD", "AUD", "CHF")
QUOTE = "struct<`15m`:double,buy:double,last:double,sell:double,symbol:string>"


def _wanted(currencies: Sequence[str] | str) -> list[str]:
    names = currencies.split(",") if isinstance(currencies, str) else currencies
    return [n.strip().upper() for n in names]


def _quotes(value: str):
    return F.from_json(F.col(value), f"map<string,{QUOTE}>")


def unpivot_ticker(
    df: DataFrame, value: str = "value", currencies: Sequence[str] | str = CURRENCIES, time: str = "timestamp"
) -> DataFrame:
    """One row per wanted currency present in each payload. Purely row-local: no shuffle."""
    keep = [c for c in df.columns if c not in (value, time)]
    exploded = df.select(*keep, F.col(time), F.explode(_quotes(value)).alias("currency", "quote"))
    return exploded.filter(F.col("currency").isin(_wanted(currencies))).select(
        *keep,
        "currency",
        F.col("quote.last").alias("price"),
        F.col("quote.buy").alias("buy_price"),
        F.col("quote.sell").alias("sell_price"),
        F.col("quote.15m").alias("price_15m"),
        F.col(time).alias("timestamp"),
    )


def preferred_quote(
    df: DataFrame, value: str = "value", currencies: Sequence[str] | str = CURRENCIES
) -> DataFrame:
    """The first currency of the list each payload has, with its change in percent over 15 minutes.

    The change is 0 unless both prices are positive. Payloads with none of the currencies drop out.
    """
    keep = [c for c in df.columns if c != value]
    names = _wanted(currencies)
    parsed = df.select(*keep, _quotes(value).alias("quotes"))
    chosen = parsed.withColumn(
        "currency",
        F.coalesce(*[F.when(F.try_element_at("quotes", F.lit(n)).isNotNull(), F.lit(n)) for n in names]),
    ).filter(F.col("currency").isNotNull())
    quoted = chosen.withColumn("quote", F.try_element_at("quotes", F.col("currency")))
    price = F.coalesce(F.col("quote.last"), F.lit(0.0))
    later = F.coalesce(F.col("quote.15m"), F.lit(0.0))
    return quoted.select(
        *keep,
        "currency",
        price.alias("price"),
        F.coalesce(F.col("quote.buy"), F.lit(0.0)).alias("buy_price"),
        F.coalesce(F.col("quote.sell"), F.lit(0.0)).alias("sell_price"),
        F.when((price > 0) & (later > 0), F.try_divide(later - price, price) * 100)
        .otherwise(F.lit(0.0))
        .alias("price_change"),
    )
