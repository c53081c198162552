import datetime as dt
import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.schema import SchemaMismatch
from tidemill.sinks.files import kafka_frame, kafka_write, parquet_dir, partitioned_write, stdout_pretty
from tidemill.sinks.changes import each_change
from tidemill.sinks.landed import LandedTable, append_to_catalog


def test_stdout(spark, capfd):
    stdout_pretty(spark.createDataFrame([(1, "x")], "a int, b string"))
    assert "|a" in capfd.readouterr().out.replace(" ", "")


def test_parquet_dir_replaces(spark, place):
    for n in (5, 3):
        target = parquet_dir(spark.range(n), "out", place)
    assert target == f"{place}/out.parquet" and spark.read.parquet(target).count() == 3


def test_partitioned_write_prunes(spark, place):
    df = spark.range(100).selectExpr("id", "id % 4 AS part", "CAST(id % 3 AS INT) AS hour")
    partitioned_write(df, place + "/t", ["part", "hour"])
    read = spark.read.parquet(place + "/t").filter("part = 2")
    assert read.count() == 25
    assert "PartitionFilters: [isnotnull(part" in read._jdf.queryExecution().toString()


def test_kafka_frame(spark):
    df = spark.createDataFrame([(1, None, [1])], "a int, b string, c array<int>")
    row = kafka_frame(df, F.col("a")).first()
    assert row["key"] == "1" and json.loads(row["value"]) == {"a": 1, "b": None, "c": [1]}
    assert kafka_frame(df).first()["key"] == ""


def test_landed_table_evolves_through_all_promotions(spark, place):
    table = LandedTable(spark, place + "/t", ["p"])
    table.append(spark.sql("SELECT 1 AS a, CAST(1.5 AS FLOAT) AS b, 2 AS c, 3L AS d, 'x' AS p"), "1", evolve=True)
    table.append(spark.sql("SELECT 2L AS a, 2.5D AS b, 3.5D AS c, 'y' AS p, 4.5D AS d"), "2", evolve=True)
    table.append(spark.sql("SELECT 'later' AS e, 'x' AS p, 'no number' AS a"), "3", evolve=True)
    assert [v[0] for v in table.schemas.versions()] == [1, 2, 3]
    assert [f"{f.name}:{f.dataType.simpleString()}" for f in table.schema().fields] == [
        "a:bigint", "b:double", "c:double", "d:double", "p:string", "e:string",
    ]
    rows = sorted((tuple(r) for r in table.read().collect()), key=repr)
    assert rows == [
        (1, 1.5, 2.0, 3.0, "x", None),
        (2, 2.5, 3.5, 4.5, "y", None),
        (None, None, None, None, "x", "later"),
    ]
    assert table.read().filter("p = 'y'").count() == 1


def test_landed_table_refuses_changes_unless_allowed(spark, place):
    table = LandedTable(spark, place + "/t")
    table.append(spark.sql("SELECT 1L AS a, 'x' AS b"))
    table.append(spark.sql("SELECT 2L AS a"))
    with pytest.raises(SchemaMismatch):
        table.append(spark.sql("SELECT 3L AS a, 1 AS fresh"))
    assert len(table.schemas.versions()) == 1 and table.read().count() == 2


def test_two_writers_cannot_register_the_same_version(spark, place):
    table = LandedTable(spark, place + "/t")
    schema = T.StructType([T.StructField("a", T.LongType())])
    table.schemas.register(1, schema)
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        table.schemas.register(1, schema)


def test_repeated_load_counts_once(spark, place):
    table = LandedTable(spark, place + "/t", ["p"])
    df = spark.range(10).selectExpr("id", "id % 2 AS p")
    for _ in range(3):
        table.append(df, "same")
    table.append(df.limit(4), "other")
    assert table.read().count() == 14
    log = {r["load_id"]: r for r in table.loads().collect()}
    assert log["same"]["added_records"] == 10 and log["other"]["added_records"] == 4
    last = max(log.values(), key=lambda r: r["snapshot_id"])
    assert last["total_records"] == 14 and last["parent_id"] == 1 and last["added_files"] >= 1
    assert all(r["added_bytes"] > 0 and r["schema_id"] == 1 and r["operation"] == "append" for r in log.values())


def test_empty_table_and_empty_load(spark, place):
    table = LandedTable(spark, place + "/t")
    with pytest.raises(FileNotFoundError):
        table.read()
    assert table.loads().count() == 0 and table.schema() is None
    table.append(spark.range(0).toDF("id"), "none")
    assert table.read().count() == 0
    assert table.loads().first()["added_records"] == 0


def test_append_to_catalog(spark, place):
    spark.sql(f"CREATE DATABASE shop LOCATION '{place}/shop'")
    try:
        append_to_catalog(spark.sql("SELECT 1 AS a, 'x' AS b"), "shop.sales")
        append_to_catalog(spark.sql("SELECT 'y' AS b, 2 AS a"), "shop.sales")
        assert sorted(map(tuple, spark.table("shop.sales").select("a", "b").collect())) == [(1, "x"), (2, "y")]
    finally:
        spark.sql("DROP DATABASE shop CASCADE")


def test_a_load_in_a_catalog_table_is_replaced(spark, place):
    spark.sql(f"CREATE DATABASE stock LOCATION '{place}/stock'")
    try:
        for load, rows in (("one", "(1, 'x'), (2, 'y')"), ("two", "(3, 'z')"), ("one", "(1, 'x'), (2, 'y')")):
            append_to_catalog(spark.sql(f"SELECT * FROM VALUES {rows} AS t(a, `b.c`)"), "stock.goods", load)
        append_to_catalog(spark.sql("SELECT 'w' AS `b.c`, 4 AS a"), "stock.goods")  # a load of its own
        got = spark.table("stock.goods")
        assert sorted(r["a"] for r in got.collect()) == [1, 2, 3, 4] and got.select("load_id").distinct().count() == 3
        with pytest.raises(SchemaMismatch, match="differ"):
            append_to_catalog(spark.sql("SELECT 1 AS a"), "stock.goods", "three")
        spark.sql("CREATE TABLE stock.plain (a INT) USING parquet")
        with pytest.raises(SchemaMismatch, match="load_id"):
            append_to_catalog(spark.sql("SELECT 1 AS a"), "stock.plain", "one")
    finally:
        spark.sql("DROP DATABASE stock CASCADE")


def test_a_time_filter_opens_matching_loads_only(spark, place):
    table = LandedTable(spark, place + "/timed", event_time="ts")
    for day in range(1, 6):
        table.append(spark.sql(f"SELECT id, timestamp_ntz'2024-01-0{day} 00:00:00' + make_interval(0, 0, 0, 0, id) AS ts FROM range(20)"), f"day{day}")
    table.append(spark.sql("SELECT 99L AS id, CAST(NULL AS TIMESTAMP_NTZ) AS ts"), "none")
    log = {r["load_id"]: (r["min_time"], r["max_time"], r["added_records"]) for r in table.loads().collect()}
    assert log["day3"] == (dt.datetime(2024, 1, 3), dt.datetime(2024, 1, 3, 19), 20) and log["none"] == (None, None, 1)
    part = table.read(since="2024-01-02 10:00:00", until="2024-01-04 05:00:00")
    assert part.count() == 10 + 20 + 5
    for day in (1, 5):  # files of loads outside are not opened: reading them would fail
        for file in Path(place, f"timed/data/load_id=day{day}").rglob("*.parquet"):
            file.write_bytes(b"broken")
    assert part.count() == 10 + 20 + 5
    with pytest.raises(Exception, match="(?i)parquet"):
        table.read().count()


def test_each_load_is_handed_on_once(spark, place):
    table, out = LandedTable(spark, place + "/fed"), LandedTable(spark, place + "/copy")
    copy = lambda rows, load: out.append(rows, load)
    ids = lambda: sorted(r["id"] for r in out.read().collect())
    assert each_change(table, "copier", copy) == 0
    table.append(spark.range(5), "one")
    table.append(spark.range(5, 8), "two")
    spark.range(100, 107).write.parquet(place + "/fed/data/load_id=lost/schema_id=1")  # not logged
    assert each_change(table, "copier", copy) == 1 and ids() == list(range(8))
    table.append(spark.range(5), "one")  # replaced after it was handed on
    assert each_change(table, "copier", copy) == 0 and ids() == list(range(8))
    table.append(spark.range(8, 11), "three")

    def crash(rows, load):
        out.append(rows, load)
        raise RuntimeError("lost after the write")

    with pytest.raises(RuntimeError):
        each_change(table, "copier", crash)
    table.append(spark.range(11, 12), "four")  # logged while the third run is not done
    assert each_change(table, "copier", copy) == 2 and ids() == list(range(12))
    assert each_change(table, "other", copy) == 1 and len(ids()) == 24  # each consumer has its own place


def test_loads_that_are_not_logged_do_not_count(spark, place):
    table = LandedTable(spark, place + "/logged")
    table.append(spark.range(5), "one")
    spark.range(7).write.parquet(place + "/logged/data/load_id=two/schema_id=1")
    assert table.read().count() == 5


def test_retyped_values_are_refused_or_kept(spark, place):
    table = LandedTable(spark, place + "/typed")
    table.append(spark.sql("SELECT 1L AS a"))
    text = spark.sql("SELECT * FROM VALUES ('2'), ('x') AS t(a)")
    with pytest.raises(SchemaMismatch, match="change the type"):
        table.append(text)
    table.append(text, "second", evolve=True)
    assert sorted((r["a"] is None, r["a"]) for r in table.read().collect()) == [(False, 1), (False, 2), (True, None)]
    assert [(r["column_name"], r["value"], r["load_id"]) for r in table.unfit().collect()] == [("a", "x", "second")]
    assert {r["load_id"]: r["unfit_values"] for r in table.loads().collect()}["second"] == 1


def test_kafka_writers_get_records_and_options(spark, place, monkeypatch):
    """Without a broker: what the writers hand to Spark."""
    from pyspark.sql.readwriter import DataFrameWriter

    seen = {}
    monkeypatch.setattr(DataFrameWriter, "save", lambda self, *a, **k: seen.update(df=self._df))
    kafka_write(spark.sql("SELECT 1 AS a, 'k' AS b"), "broker:9092", "topic", F.col("b"))
    assert seen["df"].columns == ["key", "value"] and seen["df"].first()["value"] == '{"a":1,"b":"k"}'
