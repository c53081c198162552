import pytest
from pyspark.sql import types as T

from tidemill.operators.quality import required_rules
from tidemill.schema import (
    SchemaMismatch,
    check_strict,
    conform,
    conform_and_union,
    infer_schema,
    merge_schemas,
    nested_paths,
    promote,
    schema_evolution,
    schema_from_config,
)
from tidemill.schema.spec import infers


def ddl(text):
    return T.DataType.fromDDL(text)


def shape(schema):
    return [(f.name, f.dataType.simpleString()) for f in schema.fields]


def test_schema_from_config(spark):
    config = {
        "fields": [
            {"name": "a", "data_type": "int64"},
            {"name": "b", "data_type": "float64", "nullable": True},
            {"name": "c", "data_type": "boolean"},
            {"name": "d", "data_type": "uuid"},
        ]
    }
    schema = schema_from_config(config)
    assert shape(schema) == [("a", "bigint"), ("b", "double"), ("c", "boolean"), ("d", "string")]
    assert [f.nullable for f in schema.fields] == [False, True, False, False]
    assert set(required_rules(schema)) == {"a required", "c required", "d required"}
    assert infers(None) and not infers(config) and infers({"auto_infer": True})


@pytest.mark.parametrize(
    "old, new, result",
    [
        (T.IntegerType(), T.LongType(), T.LongType()),
        (T.FloatType(), T.DoubleType(), T.DoubleType()),
        (T.IntegerType(), T.DoubleType(), T.DoubleType()),
        (T.LongType(), T.DoubleType(), T.DoubleType()),
        (T.LongType(), T.StringType(), T.LongType()),
        (T.DoubleType(), T.LongType(), T.DoubleType()),
        (T.StringType(), T.BooleanType(), T.StringType()),
    ],
)
def test_promotion(old, new, result):
    assert promote(old, new) == result


def test_merge_keeps_order_and_appends(spark):
    merged = merge_schemas(ddl("b int, gone string, a float"), ddl("new2 string, A double, b bigint, new1 int"))
    assert shape(merged) == [("b", "bigint"), ("gone", "string"), ("a", "double"), ("new2", "string"), ("new1", "int")]


def test_conform(spark):
    df = spark.sql("SELECT 1 AS a, 'x' AS b, named_struct('k', 1) AS c, 9 AS extra")
    out = conform(df, ddl("A bigint, b int, c string, d double"))
    assert shape(out.schema) == [("A", "bigint"), ("b", "int"), ("c", "string"), ("d", "double")]
    assert tuple(out.first()) == (1, None, '{"k":1}', None)


def test_union_of_different_schemas(spark):
    union, schema = conform_and_union(
        [spark.sql("SELECT 1 AS a"), spark.sql("SELECT 1.5D AS a, 'x' AS b"), spark.sql("SELECT 'y' AS b")]
    )
    assert shape(schema) == [("a", "double"), ("b", "string")]
    assert sorted(map(tuple, union.collect()), key=repr) == [(1.0, None), (1.5, "x"), (None, "y")]


def test_inference(spark):
    rows = [
        '{"i":1,"d":1.5,"s":"x","b":true,"n":null,"e":[],"l":[null,2],"o":{"k":1},"odd name":1}',
        '{"i":2,"d":3,"mix":1}',
        '{"mix":"text","big":12345678901234567890}',
        "broken",
        "[1]",
        "null",
        "7",
    ]
    df = spark.createDataFrame([(r,) for r in rows], "value string")
    found = dict(shape(infer_schema(df)))
    assert found == {
        "i": "bigint", "d": "double", "s": "string", "b": "boolean", "n": "string", "e": "string",
        "l": "array<bigint>", "o": "string", "odd name": "bigint", "mix": "string", "big": "double",
    }
    nested = infer_schema(df, keep_objects=True)
    assert dict(shape(nested))["o"] == "struct<k:bigint>"
    assert infer_schema(spark.createDataFrame([("broken",)], "value string")).fields == []


def test_nested_paths(spark):
    schema = ddl("a struct<b: struct<c: bigint>, l: array<struct<x: int>>>, s string")
    assert [(p, t.simpleString()) for p, t in nested_paths(schema)] == [
        ("a.b.c", "bigint"), ("a.l.x", "int"), ("s", "string"),
    ]


def test_strict_mode_raises_on_every_difference(spark):
    registered = ddl("a bigint, b string")
    check_strict(ddl("b string, a bigint"), registered)
    for other in ("a bigint, b string, c int", "a bigint", "a int, b string"):
        with pytest.raises(SchemaMismatch):
            check_strict(ddl(other), registered)
    df = spark.sql("SELECT 1 AS a")
    with pytest.raises(SchemaMismatch):
        schema_evolution(df, registered, strict_mode=True)


def test_evolution_modes(spark):
    df = spark.sql("SELECT 2.5D AS a, 'new' AS c")
    registered = ddl("a bigint, b string")
    assert shape(schema_evolution(df, registered).schema) == [("a", "bigint"), ("b", "string")]
    widened = schema_evolution(df, registered, auto_infer=True)
    assert shape(widened.schema) == [("a", "double"), ("b", "string"), ("c", "string")]
    assert tuple(widened.first()) == (2.5, None, "new")
    assert schema_evolution(df) is df
