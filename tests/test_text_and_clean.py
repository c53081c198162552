from pyspark.sql import functions as F

from tidemill.functions.buckets import at_least, at_most, below
from tidemill.functions.text import (
    UNICODE_WHITESPACE,
    extract_keywords,
    price_volatility,
    register_functions,
    sentiment_score,
    title_words,
    trim_unicode,
)
from tidemill.operators.clean import clean_data, passthrough


def one(spark, function, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(function(F.col("v"))).collect()]


def test_whitespace_is_what_python_strips_of_unicode_spaces():
    assert len(UNICODE_WHITESPACE) == 25
    assert UNICODE_WHITESPACE.strip() == ""


def test_trim(spark):
    values = [None, "", "  a\t", " b　", "  c d \r\n", "e​"]
    assert one(spark, trim_unicode, values) == [None, "", "a", "b", "c d", "e​"]


def test_title_keeps_the_rest_of_a_word(spark):
    values = [None, "", "hELLO  wORLD", "a\tb c", " ümlaut ßx", "　x"]
    assert one(spark, title_words, values) == [None, "", "HELLO WORLD", "A B C", "Ümlaut SSx", "X"]


def test_sentiment(spark):
    values = [None, "", "bullish", "up and down", "CRASH of the BEARS", "Surge, rally, gain", "cup"]
    expected = [None, 0.0, 2 / 3, 0.0, -2 / 3, 3 / 4, 1 / 2]
    assert one(spark, sentiment_score, values) == expected


def test_keywords_in_list_order(spark):
    values = [None, "", "NFT and Bitcoin", "cryptocurrency", "btc defi blockchain"]
    assert one(spark, extract_keywords, values) == [
        None, [], ["bitcoin", "nft"], ["crypto"], ["btc", "blockchain", "defi"],
    ]


def test_volatility(spark):
    assert one(spark, price_volatility, [None, 30000.0, 30000.5, 50000.0, 50001.0], "double") == [
        "low", "low", "medium", "medium", "high",
    ]


def test_sql_functions_equal_columns(spark):
    register_functions(spark)
    values = [None, "", "bullish NFT", "down with btc"]
    for name, function in (("sentiment_score", sentiment_score), ("extract_keywords", extract_keywords)):
        by_sql = one(spark, lambda c, n=name: F.expr(f"{n}(v)"), values)
        assert by_sql == one(spark, function, values)
    assert spark.sql("SELECT array_length(array('a','b')), array_length(NULL)").first() == (2, None)
    assert spark.sql("SELECT price_volatility(40000)").first()[0] == "medium"


def test_buckets_put_null_last(spark):
    limits = ((1.0, "a"), (2.0, "b"))
    values = [None, 0.5, 1.0, 1.5, 2.0]
    assert one(spark, lambda c: below(c, limits, "z"), values, "double") == ["z", "a", "b", "b", "z"]
    assert one(spark, lambda c: at_most(c, limits, "z"), values, "double") == ["z", "a", "a", "b", "b"]
    falling = ((2.0, "b"), (1.0, "a"))
    assert one(spark, lambda c: at_least(c, falling, "z"), values, "double") == ["z", "z", "a", "a", "b"]


ROWS = [(1, "  a\t", 1.0), (2, None, 2.0), (3, "hELLO  wORLD", None), (None, " x", 4.0)]


def cleaned(spark, **options):
    df = spark.createDataFrame(ROWS, "id int, s string, d double")
    return sorted((tuple(r) for r in clean_data(df, **options).collect()), key=repr)


def test_clean_trims_only_text(spark):
    assert ("a" in {r[1] for r in cleaned(spark, trim_strings=True)})
    assert {r[2] for r in cleaned(spark, trim_strings=True)} == {1.0, 2.0, None, 4.0}


def test_clean_cases(spark):
    assert "HELLO WORLD" in {r[1] for r in cleaned(spark, normalize_case="title")}
    assert "hello  world" in {r[1] for r in cleaned(spark, normalize_case="lower")}
    assert "HELLO  WORLD" in {r[1] for r in cleaned(spark, normalize_case="upper")}
    assert cleaned(spark, normalize_case="odd") == sorted(ROWS, key=repr)
    assert cleaned(spark) == sorted(ROWS, key=repr)


def test_time_stamps_keep_their_letters(spark):
    df = spark.createDataFrame([("2024-01-15T10:30:00Z", "At 2024-01-15T10:30:00Z")], "a string, b string")
    assert tuple(clean_data(df, normalize_case="lower").first()) == ("2024-01-15T10:30:00Z", "at 2024-01-15t10:30:00z")
    lowered = clean_data(df, normalize_case="lower", keep_time_stamps=False)
    assert lowered.first()["a"] == "2024-01-15t10:30:00z"


def test_clean_removes_rows_with_nulls(spark):
    assert cleaned(spark, remove_nulls=True, trim_strings=True) == [(1, "a", 1.0)]
    assert {r[0] for r in cleaned(spark, remove_nulls=True, subset=["id"])} == {1, 2, 3}


def test_clean_null_test_reaches_the_scan(spark, place):
    spark.createDataFrame(ROWS, "id int, s string, d double").write.parquet(place + "/t")
    plan = clean_data(spark.read.parquet(place + "/t"), remove_nulls=True, trim_strings=True)
    text = plan._jdf.queryExecution().toString()
    assert "IsNotNull(s)" in text and "IsNotNull(id)" in text


def test_passthrough(spark):
    df = spark.range(3)
    assert passthrough(df) is df
