import json
from pathlib import Path

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.schema import infer_schema
from tidemill.sources.csv_files import csv_rejects, csv_scan
from tidemill.sources.json_files import bad_records, detect_formats, json_scan
from tidemill.sources.json_values import parse_json, split_json
from tidemill.sources.kafka import connector, kafka_options, kafka_stream
from tidemill.sources.tables import parquet_scan, table_scan


def write(folder, name, text):
    path = Path(folder) / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


def tuples(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# CSV


def test_csv_with_header_over_two_files(spark, place):
    write(place, "a.csv", "id,name,score,day,ok\n1,x,1.5,2024-01-01,true\n")
    write(place, "b.csv", "id,name,score,day,ok\n2,y,,2024-01-02,false\n")
    df = csv_scan(spark, f"{place}/*.csv", has_header=True)
    assert [(f.name, f.dataType.simpleString()) for f in df.schema.fields] == [
        ("id", "bigint"), ("name", "string"), ("score", "double"), ("day", "date"), ("ok", "boolean"),
    ]
    assert df.count() == 2 and df.agg(F.sum("id")).first()[0] == 3


def test_csv_without_header(spark, place):
    write(place, "a.csv", "1,x\n2,y\n")
    df = csv_scan(spark, f"{place}/a.csv")
    assert df.columns == ["col_0", "col_1"] and tuples(df) == [(1, "x"), (2, "y")]


def test_csv_no_match(spark, place):
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        csv_scan(spark, f"{place}/*.csv")


def test_csv_types_fit_all_rows(spark, place):
    lines = [f"{i},{i}" for i in range(150)] + ["0.5,7"]
    write(place, "a.csv", "\n".join(lines) + "\n")
    write(place, "b.csv", "\n".join(["7,x"] * 50) + "\n")
    rows = csv_scan(spark, f"{place}/*.csv")
    assert [f.dataType.simpleString() for f in rows.schema] == ["double", "string"] and rows.count() == 201


def test_csv_conflict_with_a_given_schema(spark, place):
    lines = [f"{i},{i}" for i in range(150)] + ["x,7", "1,2,3"]
    write(place, "a.csv", "\n".join(lines) + "\n")
    given = T.DataType.fromDDL("a bigint, b bigint")
    dropped = csv_scan(spark, f"{place}/a.csv", schema=given)
    # the same rows whatever columns a query uses
    assert dropped.count() == 150 and dropped.select("b").count() == 150
    rejected = csv_rejects(spark, f"{place}/a.csv", schema=given)
    assert tuples(rejected) == [("1", "2", "wrong number of fields"), ("x", "7", "a is no bigint")]
    assert csv_scan(spark, f"{place}/a.csv", schema=given, bad_rows="null").filter("a is null").count() == 1
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        csv_scan(spark, f"{place}/a.csv", schema=given, bad_rows="fail").collect()


def test_csv_ragged_rows_are_dropped(spark, place):
    write(place, "a.csv", "1,a\n2,b,extra\n3,c\n")
    df = csv_scan(spark, f"{place}/a.csv")
    assert tuples(df) == [(1, "a"), (3, "c")] and df.count() == 2
    text_only = T.DataType.fromDDL("p string, q string")
    assert csv_scan(spark, f"{place}/a.csv", schema=text_only).count() == 2


def test_csv_mode_is_checked(spark, place):
    with pytest.raises(ValueError):
        csv_scan(spark, place, bad_rows="maybe")


# JSON files

ARRAY = '[\n {"id": 1, "n": "a"},\n {"id": 2, "n": "b"}\n]'
OBJECT = '{\n "id": 3,\n "n": "c"\n}\n'
LINES = '{"id": 4, "n": "d"}\n\n  \n{"id": 5, "n": "e"}\n'


def test_json_formats_are_detected(spark, place):
    write(place, "a.json", ARRAY)
    write(place, "deep/er/o.json", "\n" + OBJECT)
    write(place, "deep/l.json", LINES)
    write(place, "bad.json", '{"id": 6, "n"\n{"id": 7, "n": "g"}\n')
    write(place, "skip.txt", "x")
    found = {Path(r["file"]).name: r["format"] for r in detect_formats(spark, place).collect()}
    assert found == {"a.json": "array", "o.json": "object", "l.json": "ndjson", "bad.json": "ndjson"}


def test_json_auto_reads_mixed_folders(spark, place):
    write(place, "a.json", ARRAY)
    write(place, "deep/o o.json", OBJECT)
    write(place, "deep/l.json", LINES)
    assert tuples(json_scan(spark, place).select("id", "n")) == [(1, "a"), (2, "b"), (3, "c"), (4, "d"), (5, "e")]


def test_json_one_format(spark, place):
    write(place, "o.json", OBJECT)
    assert tuples(json_scan(spark, place, "object").select("id")) == [(3,)]
    assert tuples(json_scan(spark, place).select("id")) == [(3,)]


def test_json_bad_lines(spark, place):
    write(place, "l.json", LINES + "{broken\n")
    schema = T.DataType.fromDDL("id bigint, n string")
    kept = json_scan(spark, place, "ndjson", schema=schema, continue_on_error=True)
    assert tuples(kept) == [(4, "d"), (5, "e")]
    assert bad_records(spark, place) == 1
    with pytest.raises(Exception, match="MALFORMED"):
        json_scan(spark, place, "ndjson", schema=schema).collect()
    with pytest.raises(ValueError):
        json_scan(spark, place, "xml")


# JSON values

SCHEMA = T.StructType(
    [
        T.StructField("i", T.LongType()),
        T.StructField("d", T.DoubleType()),
        T.StructField("s", T.StringType()),
        T.StructField("b", T.BooleanType()),
        T.StructField("a", T.ArrayType(T.LongType())),
    ]
)
MESSAGES = [
    '{"i":1,"d":2,"s":"x","b":true,"a":[1,2],"extra":9}',
    '{"i":1.5,"d":"no","s":7,"b":"true"}',
    '{"s":{"k":[1]},"i":null}',
    "[1,2]",
    "null",
    '{"i":',
    "",
    None,
]


def test_parse_json_keeps_objects_only(spark):
    df = spark.createDataFrame(list(enumerate(MESSAGES)), "n int, value string")
    rows = {r["n"]: tuple(r)[1:] for r in parse_json(df, SCHEMA, keep=["n"]).collect()}
    assert set(rows) == {0, 1, 2}
    assert rows[0] == (1, 2.0, "x", True, [1, 2])
    assert rows[1] == (None, None, "7", None, None)
    assert rows[2] == (None, None, '{"k":[1]}', None, None)


def test_parse_json_defaults(spark):
    df = spark.createDataFrame([("{}",)], "value string")
    assert tuple(parse_json(df, SCHEMA, on_missing="default").first()) == (0, 0.0, "", False, None)
    with pytest.raises(ValueError):
        parse_json(df, SCHEMA, on_missing="guess")


def test_repeated_keys_take_the_last_value(spark):
    df = spark.createDataFrame([('{"i":1,"i":2}',)], "value string")
    assert parse_json(df, SCHEMA).first()["i"] == 2
    assert infer_schema(df).fieldNames() == ["i"]


def test_split_json_loses_nothing_but_missing_text(spark):
    df = spark.createDataFrame(list(enumerate(MESSAGES)), "n int, value string")
    good, bad = split_json(df)
    assert {r["n"] for r in good.collect()} == {0, 1, 2}
    assert {r["n"]: r["reason"] for r in bad.collect()} == {
        3: "not an object", 4: "not an object", 5: "malformed", 6: "malformed",
    }


# Tables and topics


def test_parquet_scan(spark, place):
    spark.range(4).selectExpr("id", "id % 2 AS p").write.partitionBy("p").parquet(place + "/t")
    assert sorted(parquet_scan(spark, place + "/t").columns) == ["id", "p"]
    assert parquet_scan(spark, place + "/t/**/*.parquet", view="deep").columns == ["id"]
    assert spark.sql("SELECT COUNT(*) FROM deep").first()[0] == 4
    assert table_scan(spark, place + "/t").count() == 4
    assert table_scan(spark, "deep").count() == 4


def test_kafka_options_and_columns(spark, place):
    seen = {}

    def reader(session, options):
        seen.update(options)
        return session.createDataFrame([(bytearray(b'{"a":1}'), bytearray(b"k"))], "value binary, key binary")

    spec = {"brokers": "h:1,h:2", "topic": "t", "group_id": "g", "max_offsets_per_trigger": 10}
    df = kafka_stream(spark, spec, reader)
    assert df.columns == ["value"] and df.first()[0] == '{"a":1}'
    assert seen == kafka_options(spec)
    assert seen["kafka.bootstrap.servers"] == "h:1,h:2" and seen["subscribe"] == "t"
    assert seen["groupIdPrefix"] == "g" and seen["maxOffsetsPerTrigger"] == "10"


def test_kafka_connector_missing_is_reported(spark):
    with pytest.raises(AnalysisException, match="kafka|Kafka"):
        connector(spark, kafka_options({"brokers": "h:1", "topic": "t"}))


def test_json_text_is_json():
    assert json.loads(ARRAY)[1]["id"] == 2


def test_many_files_of_mixed_formats(spark, place):
    """Tasks do not follow the number of files, and the schema is the one that Spark's reader infers."""
    rows = [{"id": i, "n": {"x": i / 2 if i % 3 else 1}, "t": None if i % 3 else ["a"], "big": 10**25 if i == 7 else i} for i in range(150)]
    for name, kept in (("mixed", range(150)), ("alone", range(0, 150, 2))):
        Path(place, name).mkdir()
        for i in kept:
            text = json.dumps(rows[i], indent=1) if i % 2 == 0 else json.dumps([rows[i], rows[i]], indent=1)
            Path(place, name, f"f {i}.json").write_text(text)
    context = spark.sparkContext
    context.setJobGroup("many files", "")
    try:
        got = json_scan(spark, f"{place}/mixed")
        tracker = context.statusTracker()
        jobs = [tracker.getJobInfo(j) for j in tracker.getJobIdsForGroup("many files")]
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    assert max(tracker.getStageInfo(s).numTasks for j in jobs for s in j.stageIds if tracker.getStageInfo(s)) <= 64
    assert got.orderBy("id").select("id").collect() == [(i,) for i in range(150) for _ in range(1 + i % 2)]
    alone = spark.read.option("multiLine", "true").json(f"{place}/alone")
    assert json_scan(spark, f"{place}/mixed").select("id", "n", "big").schema["n"] == alone.schema["n"]
    assert json_scan(spark, f"{place}/alone").schema == alone.schema
    assert spark.conf.get("spark.sql.sources.parallelPartitionDiscovery.parallelism") == "10000"
