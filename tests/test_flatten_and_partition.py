import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tidemill.operators.flatten import flatten_columns, json_flatten, rows_as_flat_json
from tidemill.operators.partitioning import add_partition

NESTED = '{"a":{"b":{"c":1,"d":null}},"e":[],"f":[{"g":2},{"g":3}],"h":"x","i":[[4,5]]}'


def flat(spark, text, separator="_", depth=5):
    df = spark.createDataFrame([(text,)], "value string")
    out = json_flatten(df, separator, depth, value="value").first()["flattened_data"]
    return None if out is None else json.loads(out)


@pytest.mark.parametrize(
    "depth, expected",
    [
        (0, {}),
        (1, {"e": [], "h": "x"}),
        (2, {"e": [], "h": "x"}),
        (3, {"a_b_c": 1, "a_b_d": None, "e": [], "f_g": 2, "h": "x", "i": 4}),
        (5, {"a_b_c": 1, "a_b_d": None, "e": [], "f_g": 2, "h": "x", "i": 4}),
    ],
)
def test_flatten_text_depth(spark, depth, expected):
    assert flat(spark, NESTED, "_", depth) == expected


def test_flatten_text_separators_and_edges(spark):
    assert flat(spark, '{"a":{"b":1}}', "") == {"ab": 1}
    assert flat(spark, '{"a":{"b":1}}', ".") == {"a.b": 1}
    assert flat(spark, '{"a":{"b":1},"a_b":2}') == {"a_b": 2}
    assert flat(spark, '{"a":{}}') == {}
    assert flat(spark, "not json") is None
    assert flat(spark, '{"s":"{\\"x\\":1}"}') == {"s": '{"x":1}'}


MESSAGES = [
    NESTED,
    '{"a":{"b":null},"e":[],"f":[],"z":"é"}',
    '{"a":null,"f":null,"h":null,"i":[]}',
    '{"a":{"b":{"c":2.50,"e":{"x":{"y":1}}}},"f":[{"g":null}],"i":[null],"n":{}}',
    '{"f":[null,{"g":1}],"i":[[]],"n":{"B":1,"b":"t","q r":[{"s":[{"t":1}]}]}}',
    "null",
    "{}",
    "no json",
    None,
]


@pytest.mark.parametrize("depth", [0, 1, 2, 3, 4, 5, 9])
@pytest.mark.parametrize(
    "more",
    [[], ['{"h":{"x":1}}', '{"h":[7]}'], ['{"a.b":1,"a":{"b":{"c":1}}}', '{"a":{"b":3}}'], ['{"it\'s":1}'], ["[1]", "5"]],
    ids=["one shape", "odd rows", "equal names", "names no path holds", "no objects"],
)
def test_flattening_by_shape_gives_the_same_text(spark, more, depth):
    df = spark.createDataFrame(list(enumerate(MESSAGES + more)), "id int, value string")
    general = json_flatten(df, ".", depth, value="value")
    by_shape = json_flatten(df, ".", depth, value="value", by_shape=True)
    assert by_shape.columns == general.columns
    assert sorted(by_shape.collect(), key=str) == sorted(general.collect(), key=str)


def test_flattening_by_shape_without_rows_and_on_streams(spark, place):
    empty = spark.createDataFrame([], "value string")
    assert json_flatten(empty, value="value", by_shape=True).collect() == []
    with pytest.raises(ValueError, match="stream"):
        json_flatten(spark.readStream.text(place), value="value", by_shape=True)


def test_flatten_columns(spark):
    df = spark.sql(
        "SELECT 1 AS id, named_struct('b', named_struct('c', 2, 'd', CAST(NULL AS STRING))) AS a, "
        "array(named_struct('g', 3), named_struct('g', 4)) AS f, CAST(array() AS ARRAY<INT>) AS e, map('k', 5) AS m"
    )
    out = flatten_columns(df)
    assert out.columns == ["id", "a_b_c", "a_b_d", "f_g", "e", "m"]
    assert tuple(out.first()) == (1, 2, None, 3, None, '{"k":5}')
    assert flatten_columns(df, max_depth=1).columns == ["id", "m"]
    assert flatten_columns(df, max_depth=0).columns == []
    assert flatten_columns(df, separator="").columns[1] == "abc"


def test_flatten_columns_refuses_equal_names(spark):
    df = spark.sql("SELECT named_struct('b', 1) AS a, 2 AS a_b")
    with pytest.raises(ValueError, match="a_b"):
        flatten_columns(df)
    assert flatten_columns(df, separator=".").columns == ["a.b", "a_b"]


def test_rows_as_flat_json(spark):
    df = spark.sql("SELECT 1 AS id, named_struct('b', CAST(NULL AS STRING)) AS a")
    assert json.loads(rows_as_flat_json(df).first()[0]) == {"a_b": None, "id": 1}


def keys(spark, partition_by, pattern="", sql=None):
    df = spark.sql(sql or "SELECT * FROM VALUES (1, 'x', DATE'2024-01-15'), (2, NULL, NULL) AS t(n, s, d)")
    fixed = F.lit("2024-02-03 10:00:00").cast("timestamp")
    rows = add_partition(df, partition_by, pattern, fixed).collect()
    assert {r["partition_date"] for r in rows} == {"2024-02-03"}
    return [r["partition_key"] for r in rows]


def test_partition_keys(spark):
    assert keys(spark, []) == ["", ""]
    assert keys(spark, ["n"]) == ["1", "2"]
    assert keys(spark, ["n", "s"]) == ["1/x", "2/unknown"]
    assert keys(spark, ["n", "gone"]) == ["1/unknown", "2/unknown"]
    assert keys(spark, ["n", "s"], "{0}-{1}!") == ["1-x!", "2-unknown!"]
    assert keys(spark, ["n"], "{0}-{7}") == ["1-{7}", "2-{7}"]
    assert keys(spark, ["s"], "fixed") == ["fixed", "fixed"]


def test_partition_date_patterns(spark):
    assert keys(spark, ["d"], "yyyy/MM/dd") == ["2024/01/15", "unknown"]
    parts = "SELECT * FROM VALUES (2024, 1, 15), (2024, 13, 1) AS t(year, month, day)"
    assert keys(spark, ["year", "month", "day"], "yyyy/MM/dd", parts) == ["2024/01/15", "unknown"]


def test_partition_date_defaults_to_today(spark):
    got = add_partition(spark.range(1), ["id"]).first()["partition_date"]
    today = dt.datetime.now(dt.timezone.utc).date()
    assert got in {str(today), str(today - dt.timedelta(days=1))}
