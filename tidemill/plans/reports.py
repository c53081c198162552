"""The report catalogue: every report by name, with the oracle's SQL for the same answer.

Both sides round fractions to four digits, give percentages as DOUBLE and counts as BIGINT. Means
of a few values often end in a 5 at the digit that is rounded away, and then the order of additions
decides; both sides add a nudge first.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import enrich
from ..functions.text import UNICODE_WHITESPACE, register_functions
from ..operators.clean import clean_data
from ..operators.overview import overview
from ..operators.quality import profile
from ..operators.ranking import latest, number_rows
from ..operators.sql import sql_transform
from ..session import pin_settings
from . import datasets, flights, market, news, retail, tracks, views
from .views import AS_OF, with_views

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

DIGITS, NUDGE = 4, 1e-7


def rounded(df: DataFrame) -> DataFrame:
    """Fractions to four digits, so that the order of additions does not show."""

    def shown(field: T.StructField) -> Column:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DoubleType):
            return F.round(column + NUDGE, DIGITS).alias(field.name)
        return column

    return df.select(*[shown(f) for f in df.schema.fields])


def report(name: str, sql: str, exact: bool = False) -> Callable[[Query], Query]:
    """Register a report under a name together with its oracle query. ``exact`` reports show values
    of single rows, where both sides compute the same number and rounding could only add ties."""

    def add(query: Query) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            result = query(pin_settings(spark), folder)
            return result if exact else rounded(result)

        QUERIES[name] = run
        ORACLE[name] = with_views(sql)
        return query

    return add


def simple(name: str, view: Callable, plan: Callable, sql: str, exact: bool = False) -> None:
    report(name, sql, exact)(lambda spark, folder: plan(view(spark, folder)))


# Flights

simple("f1_flight_dates", views.flights, flights.date_range, """
    select count(*) as total_flights, min(fl_date) as earliest_date, max(fl_date) as latest_date from v_flights""")

simple("f2_delays_by_day", views.flights, flights.delays_by_day, """
    select fl_date, count(*) as flights_count, round(avg(dep_delay) + 1e-7, 4) as avg_departure_delay,
           round(avg(arr_delay) + 1e-7, 4) as avg_arrival_delay,
           count(*) filter (where dep_delay > 15) as delayed_departures,
           count(*) filter (where arr_delay > 15) as delayed_arrivals
    from v_flights group by fl_date""")

# The limits as a table of ranges, of which the first that holds counts: a missing delay is in no range.
simple("f3_performance_share", views.flights, flights.performance_share, """
    select * from (with rules(place, label, dep_from, dep_to, arr_from, arr_to) as (values
            (1, 'Early', -1e9, 0, -1e9, 0), (2, 'On Time', 0, 15, 0, 15),
            (3, 'Delayed', 15.0001, 1e9, null, null), (3, 'Delayed', null, null, 15.0001, 1e9)),
        labelled as (
            select row, coalesce(min_by(label, place), 'Unknown') as label
            from (select dep_delay, arr_delay, row_number() over () as row from v_flights) left join rules
            on (dep_from is null or dep_delay between dep_from and dep_to) and (arr_from is null or arr_delay between arr_from and arr_to)
            group by row)
    select label as performance_category, count(*) as flight_count,
           round(count(*) * cast(100 as double) / (select count(*) from v_flights), 2) as percentage
    from labelled group by label)""")

simple("f4_delays_by_distance", views.flights, flights.delays_by_distance, """
    select case when distance >= 2000 then 'Very Long (>2000mi)' when distance >= 1000 then 'Long (1000-2000mi)'
                when distance >= 500 then 'Medium (500-1000mi)' when distance is null then 'Very Long (>2000mi)'
                else 'Short (<500mi)' end as distance_category,
           count(*) as flights, round(avg(dep_delay) + 1e-7, 4) as avg_dep_delay, round(avg(arr_delay) + 1e-7, 4) as avg_arr_delay,
           round(avg(air_time) + 1e-7, 4) as avg_air_time
    from v_flights group by distance_category""")

simple("f5_worst_days", views.flights, flights.worst_days, """
    select fl_date, round(total + 1e-7, 4) as total_avg_delay, max_departure_delay, max_arrival_delay, flights_count
    from (select fl_date, avg(dep_delay + arr_delay) as total, max(dep_delay) as max_departure_delay,
                 max(arr_delay) as max_arrival_delay, count(*) as flights_count
          from v_flights where dep_delay > 0 or arr_delay > 0 group by fl_date)
    order by total desc nulls last, fl_date limit 10""")

# Retail

simple("r1_product_overview", views.retail, retail.product_overview, """
    select count(*) as total_products, count(distinct brand) as unique_brands,
           count(distinct category) as unique_categories, round(min(actual_price) + 1e-7, 4) as min_price,
           round(max(actual_price) + 1e-7, 4) as max_price, round(avg(actual_price) + 1e-7, 4) as avg_price
    from v_retail""")

simple("r2_top_brands", views.retail, retail.top_brands, """
    select brand, count(*) as product_count, round(avg(actual_price) + 1e-7, 4) as avg_price,
           round(avg(average_rating) + 1e-7, 4) as avg_rating
    from v_retail where brand is not null group by brand order by product_count desc, brand limit 20""")

simple("r3_category_profile", views.retail, retail.category_profile, """
    select category, count(*) as products, round(avg(actual_price) + 1e-7, 4) as avg_price,
           round(min(actual_price) + 1e-7, 4) as min_price, round(max(actual_price) + 1e-7, 4) as max_price,
           round(avg(average_rating) + 1e-7, 4) as avg_rating, count(*) filter (where out_of_stock) as out_of_stock_count
    from v_retail group by category""")

simple("r4_price_ranges", views.retail, retail.price_ranges, """
    select price_range, n as product_count,
           round(n * cast(100 as double) / (select count(*) from v_retail), 2) as percentage
    from (select case when actual_price < 100 then 'Under $100' when actual_price < 500 then '$100-500'
                      when actual_price < 1000 then '$500-1000' when actual_price < 5000 then '$1000-5000'
                      else 'Over $5000' end as price_range, count(*) as n
          from v_retail group by price_range)""")

simple("r5_rating_groups", views.retail, retail.rating_groups, """
    select case when average_rating < 2 then 'Poor (<2.0)' when average_rating < 3 then 'Fair (2.0-3.0)'
                when average_rating < 4 then 'Good (3.0-4.0)' when average_rating < 4.5 then 'Very Good (4.0-4.5)'
                else 'Excellent (4.5+)' end as rating_category,
           count(*) as products, round(avg(actual_price) + 1e-7, 4) as avg_price
    from v_retail where average_rating is not null group by rating_category""")

simple("r6_stock_status", views.retail, retail.stock_status, """
    select out_of_stock, count(*) as products, round(avg(actual_price) + 1e-7, 4) as avg_price,
           round(avg(average_rating) + 1e-7, 4) as avg_rating
    from v_retail group by out_of_stock""")

# Tracks

simple("s1_track_overview", views.tracks, tracks.track_overview, """
    select count(*) as total_tracks, round(avg(danceability) + 1e-7, 4) as avg_danceability,
           round(avg(energy) + 1e-7, 4) as avg_energy, round(avg(valence) + 1e-7, 4) as avg_valence,
           round(avg(tempo) + 1e-7, 4) as avg_tempo, min(duration_ms) as shortest_track_ms,
           max(duration_ms) as longest_track_ms
    from v_tracks""")

simple("s2_moods", views.tracks, tracks.moods, """
    select case when valence < 0.3 then 'Negative' when valence < 0.5 then 'Neutral'
                when valence < 0.7 then 'Positive' else 'Very Positive' end as mood,
           count(*) as track_count, round(avg(energy) + 1e-7, 4) as avg_energy,
           round(avg(danceability) + 1e-7, 4) as avg_danceability, round(avg(tempo) + 1e-7, 4) as avg_tempo
    from v_tracks group by mood""")

simple("s3_energy_and_dance", views.tracks, tracks.energy_and_dance, """
    select case when energy < 0.4 then 'Low Energy' when energy < 0.7 then 'Medium Energy'
                else 'High Energy' end as energy_level,
           case when danceability < 0.5 then 'Not Danceable' when danceability < 0.7 then 'Danceable'
                else 'Highly Danceable' end as dance_level,
           count(*) as tracks, round(avg(tempo) + 1e-7, 4) as avg_tempo, round(avg(valence) + 1e-7, 4) as avg_positivity
    from v_tracks group by energy_level, dance_level""")

simple("s4_tempos", views.tracks, tracks.tempos, """
    select case when tempo >= 160 then 'Very Fast (>160 BPM)' when tempo >= 120 then 'Fast (120-160 BPM)'
                when tempo >= 80 then 'Medium (80-120 BPM)' else 'Slow (<80 BPM)' end as tempo_range,
           count(*) as tracks, round(avg(energy) + 1e-7, 4) as avg_energy, round(avg(danceability) + 1e-7, 4) as avg_danceability
    from v_tracks group by tempo_range""")

simple("s5_musical_keys", views.tracks, tracks.musical_keys, """
    select key as musical_key, count(*) as tracks, round(avg(valence) + 1e-7, 4) as avg_positivity,
           round(avg(energy) + 1e-7, 4) as avg_energy
    from v_tracks group by key""")

simple("s6_durations", views.tracks, tracks.durations, """
    select case when duration_ms >= 360000 then 'Very Long (>6min)' when duration_ms >= 240000 then 'Long (4-6min)'
                when duration_ms >= 120000 then 'Medium (2-4min)' else 'Short (<2min)' end as duration_category,
           count(*) as tracks, round(avg(energy) + 1e-7, 4) as avg_energy, round(avg(danceability) + 1e-7, 4) as avg_danceability,
           round(avg(valence) + 1e-7, 4) as avg_valence
    from v_tracks group by duration_category""")

# Further examples over the same tables

simple("e1_delay_totals_by_day", views.flights, flights.delay_totals_by_day, """
    select fl_date, round(avg(dep_delay) + 1e-7, 4) as avg_departure_delay, round(avg(arr_delay) + 1e-7, 4) as avg_arrival_delay,
           count(*) as total_flights, cast(sum(cast(coalesce(dep_delay > 15, false) as integer)) as bigint)
               as delayed_departures,
           cast(sum(cast(coalesce(arr_delay > 15, false) as integer)) as bigint) as delayed_arrivals
    from v_flights group by fl_date""")

simple("e2_arrival_by_departure", views.flights, flights.arrival_by_departure, """
    select case when dep_delay > 60 or dep_delay is null then 'Major Delay' when dep_delay > 15 then 'Moderate Delay'
                when dep_delay > 0 then 'Minor Delay' else 'On Time' end as departure_category,
           round(avg(arr_delay) + 1e-7, 4) as avg_arrival_delay, count(*) as flight_count
    from v_flights group by departure_category""")

simple("e3_brand_quality", views.retail, retail.brand_quality, """
    select brand, count(*) as product_count,
           round(avg(cast(regexp_replace(price_text, '[,$]', '', 'g') as double)) + 1e-7, 4) as avg_price,
           round(avg(cast(rating_text as double)) + 1e-7, 4) as avg_rating,
           round(avg(cast(no_of_ratings as integer)) + 1e-7, 4) as avg_num_ratings
    from v_retail where price_text is not null and rating_text is not null
    group by brand having count(*) >= 10""")

simple("e4_rating_by_price", views.retail, retail.rating_by_price, """
    select case when p < 500 then 'Budget' when p < 2000 then 'Mid-Range' else 'Premium' end as price_category,
           round(avg(cast(rating_text as double)) + 1e-7, 4) as avg_rating, count(*) as product_count
    from (select rating_text, cast(replace(replace(price_text, '$', ''), ',', '') as double) as p from v_retail
          where price_text is not null and rating_text is not null)
    group by price_category""")

simple("e5_category_mix", views.tracks, tracks.category_mix, """
    select danceability_category, energy_category, mood_category, count(*) as track_count,
           round(avg(tempo) + 1e-7, 4) as avg_tempo, round(avg(duration_seconds) + 1e-7, 4) as avg_duration_seconds
    from v_tracks group by all""")

simple("e6_tempo_categories", views.tracks, tracks.tempo_categories, """
    select tempo_category, round(avg(energy) + 1e-7, 4) as avg_energy, round(avg(danceability) + 1e-7, 4) as avg_danceability,
           round(avg(valence) + 1e-7, 4) as avg_positivity, count(*) as track_count
    from v_tracks group by tempo_category""")


def _three(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {
        "flights": views.flights(spark, folder),
        "retail": views.retail(spark, folder),
        "spotify": views.tracks(spark, folder),
    }


_COUNTS = """
    select 'flights' as dataset, count(*) as record_count from v_flights
    union all select 'retail', count(*) from v_retail
    union all select 'spotify', count(*) from v_tracks"""


@report("e7_dataset_sizes", f"""
    select dataset, record_count, case dataset when 'flights' then 'Flight operations data'
           when 'retail' then 'E-commerce product data' else 'Music audio features data' end as description
    from ({_COUNTS})""")
def _sizes(spark, folder):
    return datasets.dataset_sizes(_three(spark, folder))


@report("e8_indicators", """
    select 'Flight On-Time Performance' as metric, cast(cast(count(*) filter (where dep_delay <= 0) * 100.0 / count(*)
           as decimal(5, 2)) as double) as value_pct from v_flights
    union all select 'Average Product Rating', cast(cast(avg(cast(rating_text as double)) as decimal(5, 2)) as double)
              from v_retail where rating_text is not null
    union all select 'High Energy Music Percentage',
              cast(cast(count(*) filter (where energy_category = 'high_energy') * 100.0 / count(*) as decimal(5, 2))
              as double) from v_tracks""")
def _indicators(spark, folder):
    shares = datasets.indicators(*_three(spark, folder).values())
    return shares.withColumn("value_pct", F.col("value_pct").cast("double"))


_E9 = """
    select '{0}' as dataset, '{1}' as column_name, count(*) as total_records, count({1}) as non_null_records,
           cast(cast(count({1}) * 100.0 / count(*) as decimal(5, 2)) as double) as completeness_pct from {2}"""


@report("e9_completeness", " union all ".join(
    [_E9.format("flights", "dep_delay", "v_flights"), _E9.format("retail", "actual_price", "v_retail")]))
def _completeness(spark, folder):
    shares = datasets.completeness_report(
        {
            "flights": (views.flights(spark, folder), ["dep_delay"]),
            "retail": (views.retail(spark, folder), ["actual_price"]),
        }
    )
    return shares.withColumn("completeness_pct", F.col("completeness_pct").cast("double"))


@report("m1_dataset_summary", _COUNTS)
def _summary(spark, folder):
    return datasets.dataset_counts(_three(spark, folder))


# Samples and descriptions: name, view, order that makes a sample repeatable, columns with types

_TABLES = {
    "flights": (views.flights, "v_flights", "fl_date, order_key, line_number, distance, air_time", {
        "fl_date": "date", "dep_delay": "double", "arr_delay": "double", "distance": "double",
        "air_time": "double", "order_key": "bigint", "line_number": "int"}),
    "retail": (views.retail, "v_retail", "product_key", {
        "product_key": "bigint", "brand": "string", "category": "string", "actual_price": "double",
        "average_rating": "double", "out_of_stock": "boolean", "price_text": "string",
        "rating_text": "string", "no_of_ratings": "string"}),
    "spotify": (views.tracks, "v_tracks", "order_key, key, valence, energy, danceability", {
        "order_key": "bigint", "key": "int", "valence": "double", "energy": "double",
        "danceability": "double", "tempo": "double", "duration_ms": "bigint",
        "danceability_category": "string", "energy_category": "string", "mood_category": "string",
        "tempo_category": "string", "duration_seconds": "double"}),
}


def _register_samples(name: str, view: Callable, sql_view: str, order: str, columns: dict[str, str]) -> None:
    keys = order.split(", ")

    @report(f"m2_sample_{name}", f"""
        select '{name}' as source, * from (select * from {sql_view} order by {order} limit 3)""", exact=True)
    def _tagged(spark, folder):
        return datasets.tagged_sample(name, view(spark, folder), keys)

    @report(f"t1_count_{name}", f"select count(*) as total_records from {sql_view}")
    def _count(spark, folder):
        return view(spark, folder).agg(F.count(F.lit(1)).alias("total_records"))

    @report(f"t2_preview_{name}", f"select * from {sql_view} order by {order} limit 10", exact=True)
    def _preview(spark, folder):
        return view(spark, folder).orderBy(*keys).limit(10)

    described = " union all ".join(
        f"select cast({i} as bigint) as position, '{c}' as column_name, '{t}' as column_type, "
        f"count(*) as total_records, count({c}) as non_null_records from {sql_view}"
        for i, (c, t) in enumerate(columns.items(), 1)
    )

    @report(f"t3_describe_{name}", described)
    def _describe(spark, folder):
        return profile(view(spark, folder))

    @report(f"t4_column_analysis_{name}", f"select * from ({described}) order by position limit 20")
    def _columns(spark, folder):
        return profile(view(spark, folder)).orderBy("position").limit(20)


for _name, _definition in _TABLES.items():
    _register_samples(_name, *_definition)


# Market and news

_MOMENT = f"timestamp '{AS_OF}'"


@report("q1_table_overview", """
    select 'market' as table_name, count(*) as record_count, case count(*) when 0 then 'empty' else 'active' end
           as status, 'id, timestamp, currency, price, volume_24h' as sample_columns from v_market
    union all select 'news', count(*), case count(*) when 0 then 'empty' else 'active' end,
           'id, title, content, source, published_at' from v_news""")
def _overview(spark, folder):
    return overview({"market": views.market(spark, folder), "news": views.news(spark, folder)})


simple("q2_latest_price", views.market, market.latest_price, """
    select timestamp, price, volume_24h, market_cap,
           price_change_24h, market_sentiment
    from v_market order by timestamp desc, id desc limit 1""", exact=True)

simple("q3_daily_trend", views.market, lambda df: market.daily_trend(df, AS_OF), f"""
    select cast(timestamp as date) as date, round(avg(price) + 1e-7, 4) as avg_price, round(min(price) + 1e-7, 4) as min_price,
           round(max(price) + 1e-7, 4) as max_price, count(*) as data_points
    from v_market where timestamp >= {_MOMENT} - interval 7 day group by date""")

simple("q4_recent_news", views.news, lambda df: news.recent_count(df, AS_OF), f"""
    select count(*) as count from v_news where published_at >= {_MOMENT} - interval 24 hour""")

simple("q5_sentiment_mix", views.news, lambda df: news.sentiment_mix(df, AS_OF), f"""
    select sentiment_category, count(*) as count, round(avg(sentiment_score) + 1e-7, 4) as avg_sentiment
    from v_news where published_at >= {_MOMENT} - interval 7 day group by sentiment_category""")

simple("q6_top_sources", views.news, lambda df: news.top_sources(df, AS_OF), f"""
    select source, count(*) as article_count from v_news where published_at >= {_MOMENT} - interval 7 day
    group by source order by article_count desc, source limit 5""")


@report("q7_price_against_news", f"""
    select count(*) as days_with_data, round(avg(price) + 1e-7, 4) as avg_daily_price, round(avg(pairs) + 1e-7, 4) as avg_daily_news,
           round(avg(score) + 1e-7, 4) as avg_daily_sentiment
    from (select cast(m.timestamp as date) as day, avg(m.price) as price, count(n.id) as pairs,
                 avg(n.sentiment_score) as score
          from v_market m left join v_news n on cast(m.timestamp as date) = cast(n.published_at as date)
          where m.timestamp >= {_MOMENT} - interval 30 day group by day)
    where pairs > 0""")
def _price_news(spark, folder):
    return news.price_against_news(views.market(spark, folder), views.news(spark, folder), AS_OF)


simple("q8_price_by_hour", views.market, market.price_by_hour, """
    select cast(extract(hour from timestamp) as bigint) as hour, round(avg(price) + 1e-7, 4) as avg_price
    from v_market group by 1""")

simple("q9_sentiment_all_time", views.news, news.sentiment_mix, """
    select sentiment_category, count(*) as count, round(avg(sentiment_score) + 1e-7, 4) as avg_sentiment
    from v_news group by sentiment_category""")

simple("q9_latest_row", views.market, lambda df: latest(df, "timestamp", "id"), """
    select * from v_market order by timestamp desc, id desc limit 1""", exact=True)

simple("b1_daily_volume", views.market, lambda df: market.daily_volume(df, AS_OF), f"""
    select cast(timestamp as date) as date, round(avg(price) + 1e-7, 4) as avg_price, round(max(price) + 1e-7, 4) as max_price,
           round(min(price) + 1e-7, 4) as min_price, round(sum(volume_24h), 0) as total_volume
    from v_market where timestamp >= {_MOMENT} - interval 7 day group by date""")
_volume = QUERIES["b1_daily_volume"]
QUERIES["b1_daily_volume"] = lambda spark, folder: _volume(spark, folder).withColumn(
    "total_volume", F.round("total_volume", 0)
)

simple("b2_daily_news", views.news, lambda df: news.daily_news(df, AS_OF), f"""
    select cast(published_at as date) as date, count(*) as news_count, round(avg(sentiment_score) + 1e-7, 4) as avg_sentiment,
           cast(sum(votes_positive) as bigint) as total_positive_votes
    from v_news where published_at >= {_MOMENT} - interval 30 day group by date""")

# Enrichments, at a fixed time


def _clock() -> Column:
    return F.lit(AS_OF).cast("timestamp_ntz")


@report("p1_market_enrichment", """
    select *, cast(timestamp as date) as partition_date, cast(hour(timestamp) as bigint) as partition_hour,
           round(volume_24h / 1000000, 2) as volume_millions, timestamp '2024-01-31 00:00:00' as ingestion_time
    from v_market where price is not null and timestamp is not null""", exact=True)
def _enriched_market(spark, folder):
    cleaned = clean_data(views.raw_market(spark, folder), remove_nulls=True, trim_strings=True)
    return enrich.enrich_market(cleaned, _clock())


_TRIM_CHARS = "|| ".join(
    f"chr({ord(c)}) " for c in UNICODE_WHITESPACE
)


@report("p2_news_enrichment", f"""
    select id, lower(trim(title, w)) as title, lower(trim(content, w)) as content, lower(trim(source, w)) as source,
           published_at, sentiment_score, array_to_string(keywords, ',') as keywords,
           votes_positive, votes_liked, votes_negative, votes_disliked, votes_toxic,
           cast(published_at as date) as partition_date, cast(hour(published_at) as bigint) as partition_hour,
           sentiment_category, cast(len(keywords) as bigint) as keyword_count, source_category,
           timestamp '2024-01-31 00:00:00' as ingestion_time
    from v_news, (select {_TRIM_CHARS} as w) where title is not null and published_at is not null""", exact=True)
def _enriched_news(spark, folder):
    # Score and keywords are NULL only where the text is, so testing the stored columns is enough.
    stored = ["id", "title", "content", "source", "published_at"]
    cleaned = clean_data(views.raw_news(spark, folder), True, True, "lower", subset=stored)
    return enrich.enrich_news(cleaned, _clock()).withColumn("keywords", F.array_join("keywords", ","))


simple("c1_market_ratios", views.market, enrich.market_ratios, """
    select id, timestamp, price, volume_24h,
           market_cap, price_change_24h,
           price * 1000000 as price_satoshi,
           market_cap / nullif(circulating_supply, 0) as price_per_coin,
           volume_24h / nullif(market_cap, 0) * 100 as volume_market_cap_ratio,
           case when price > 50000 then 'high' when price > 30000 then 'medium' else 'low' end as volatility_level,
           cast(year(timestamp) as bigint) as year, cast(month(timestamp) as bigint) as month,
           cast(day(timestamp) as bigint) as day, cast(hour(timestamp) as bigint) as hour
    from v_market""", exact=True)

simple("c2_news_votes", views.news, enrich.news_votes, """
    select id, title, content, sentiment_score, up as positive_votes,
           down as negative_votes, cast(up - (down // (up + down + 1)) as bigint) as engagement_score,
           cast(up - down as double) / (up + down + 1) as engagement_ratio, sentiment_category,
           cast(length(title) as bigint) as title_length, cast(length(content) as bigint) as content_length
    from (select *, votes_positive + votes_liked as up, votes_negative + votes_disliked + votes_toxic as down
          from v_news)""", exact=True)


@report("g1_age_groups", """
    select case when age >= 50 then 'senior' when age >= 30 then 'middle' else 'young' end as age_group,
           count(*) as count
    from v_users group by age_group""")
def _age_groups(spark, folder):
    return enrich.age_groups(views.users(spark, folder)).groupBy("age_group").agg(F.count(F.lit(1)).alias("count"))


@report("g2_order_sequence", """
    select *, amount * cast(1.1 as double) as amount_with_tax,
           cast(row_number() over (partition by customer_id order by timestamp, order_id) as bigint) as order_sequence
    from v_sales""", exact=True)
def _order_sequence(spark, folder):
    taxed = views.sales(spark, folder).withColumn("amount_with_tax", F.col("amount") * enrich.TAX_FACTOR)
    return number_rows(taxed, ["customer_id"], ["timestamp", "order_id"], "order_sequence")


@report("win2_one_key", """
    select l_orderkey, l_linenumber, row_number() over (order by l_shipdate, l_orderkey, l_linenumber) as place
    from (select * from lineitem qualify row_number() over (partition by l_orderkey, l_linenumber order by l_partkey, l_suppkey) = 1)""",
    exact=True)
def _one_key(spark, folder):
    """All order lines under one key, numbered by date."""
    lines = views.table(spark, folder, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(
        F.min_by("l_shipdate", F.struct("l_partkey", "l_suppkey")).alias("l_shipdate")
    )
    keyed = lines.withColumn("all", F.lit("all"))
    numbered = number_rows(keyed, ["all"], ["l_shipdate", "l_orderkey", "l_linenumber"], "place")
    return numbered.select("l_orderkey", "l_linenumber", "place")


@report("e10_revenue", """
    select user_id, event_type, ts as timestamp, case event_type when 'purchase' then value else 0 end as revenue,
           cast(ts as date) as partition_date
    from events where user_id is not null""", exact=True)
def _revenue(spark, folder):
    events = views.table(spark, folder, "events")
    return enrich.revenue(events.withColumnsRenamed({"ts": "timestamp", "value": "amount"}))


@report("udf_sql_functions", """
    select id, sentiment_score as score, array_to_string(keywords, ',') as found,
           cast(len(keywords) as bigint) as found_count,
           ['low', 'low', 'low', 'low', 'medium', 'medium', 'high', 'high'][cast(id as bigint) % 8 + 1] as price_level
    from v_news""", exact=True)
def _sql_functions(spark, folder):
    register_functions(spark)
    return sql_transform(
        views.raw_news(spark, folder),
        "SELECT id, sentiment_score(content) AS score, array_join(extract_keywords(content), ',') AS found, "
        "CAST(array_length(extract_keywords(content)) AS BIGINT) AS found_count, "
        "price_volatility(CAST(CAST(id AS BIGINT) % 8 * 10000 AS DOUBLE)) AS price_level FROM input_data",
    )
