"""Text functions: Unicode trimming, title case, lexicon sentiment and keyword extraction."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# The code points with the Unicode White_Space property.
UNICODE_WHITESPACE = "".join(
    map(chr, [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000])
)

# The same code points as a pattern: by property, which Java matches faster than a list of 25.
WHITESPACE_RUN = r"[\s\x85\p{Z}]+"

# The sentiment lexicon and the keyword list.
POSITIVE_WORDS = ("bull", "bullish", "surge", "rally", "gain", "up", "positive")
NEGATIVE_WORDS = ("bear", "bearish", "crash", "drop", "fall", "down", "negative")
KEYWORDS = ("bitcoin", "btc", "crypto", "blockchain", "defi", "nft")


def trim_unicode(text: Column) -> Column:
    """Strip every kind of Unicode white space from both ends (``trim`` only strips spaces)."""
    return F.btrim(text, F.lit(UNICODE_WHITESPACE))


def title_words(text: Column) -> Column:
    """Upper-case the first letter of each word, keep the rest, and join by single spaces."""
    words = F.filter(F.split(text, WHITESPACE_RUN), lambda word: word != "")
    return F.array_join(
        F.transform(words, lambda word: F.concat(F.upper(F.left(word, F.lit(1))), F.substr(word, F.lit(2)))),
        " ",
    )


def _hits(text: Column, words: tuple[str, ...]) -> Column:
    lowered = F.lower(text)
    return reduce(lambda a, b: a + b, [F.contains(lowered, F.lit(w)).cast("int") for w in words])


def sentiment_score(text: Column) -> Column:
    """(p - n) / (p + n + 1), where p and n count the lexicon words found anywhere in the text."""
    good, bad = _hits(text, POSITIVE_WORDS), _hits(text, NEGATIVE_WORDS)
    return (good - bad).cast("double") / (good + bad + F.lit(1)).cast("double")


def extract_keywords(text: Column) -> Column:
    """The known keywords that occur in the text, in list order; NULL for no text.

    Built from functions that take part in code generation and are always evaluated, so the text
    is lower-cased once for all of them.
    """
    lowered = F.lower(text)
    found = F.array(*[F.when(F.contains(lowered, F.lit(word)), F.lit(word)) for word in KEYWORDS])
    none = F.array().cast("array<string>")
    return F.concat(F.array_except(found, F.array(F.lit(None).cast("string"))), F.when(text.isNotNull(), none))


def price_volatility(price: Column) -> Column:
    """Volatility level of a price; a missing price is low."""
    return F.when(price > 50000, "high").when(price > 30000, "medium").otherwise("low")


def _hits_sql(words: tuple[str, ...]) -> str:
    return " + ".join(f"CAST(contains(lower(body), '{w}') AS INT)" for w in words)


def register_functions(spark: SparkSession) -> None:
    """Make the functions callable from SQL text, as SQL functions that Catalyst inlines."""
    good, bad = _hits_sql(POSITIVE_WORDS), _hits_sql(NEGATIVE_WORDS)
    found = ", ".join(f"IF(contains(lower(body), '{w}'), '{w}', NULL)" for w in KEYWORDS)
    definitions = (
        f"sentiment_score(body STRING) RETURNS DOUBLE RETURN "
        f"CAST(({good}) - ({bad}) AS DOUBLE) / CAST(({good}) + ({bad}) + 1 AS DOUBLE)",
        "price_volatility(price DOUBLE) RETURNS STRING RETURN "
        "CASE WHEN price > 50000 THEN 'high' WHEN price > 30000 THEN 'medium' ELSE 'low' END",
        "extract_keywords(body STRING) RETURNS ARRAY<STRING> RETURN "
        f"concat(array_except(array({found}), array(CAST(NULL AS STRING))), "
        "IF(body IS NULL, NULL, CAST(array() AS ARRAY<STRING>)))",
        "array_length(items ARRAY<STRING>) RETURNS INT RETURN array_size(items)",
    )
    for body in definitions:
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {body}")
