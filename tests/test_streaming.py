import datetime as dt
import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidemill.operators.sql import sql_transform
from tidemill.sinks.files import stdout_stream
from tidemill.sinks.landed import LandedTable
from tidemill.sources.kafka import kafka_stream
from tidemill.sources.tables import parquet_stream
from tidemill.sinks.variant_table import VariantTable
from tidemill.streaming.count_window import close_window, each_window
from tidemill.streaming.late import late_log, part_late
from tidemill.streaming.ingest import drain, each_batch, to_landed, to_parquet, trigger_options
from tidemill.streaming.topic_table import TopicTable, parse_messages
from tidemill.streaming.windows import joint_window_stats, latest_updates, to_updates, window_stats

START = dt.datetime(2024, 1, 1)


def events(spark, first, last, hours=0):
    rows = [(i, START + dt.timedelta(hours=hours, minutes=7 * i), float(i % 10), "ab"[i % 2]) for i in range(first, last)]
    return spark.createDataFrame(rows, "id int, ts timestamp_ntz, v double, k string").coalesce(1)


def add(spark, folder, df):
    df.write.mode("append").parquet(folder)


def lines(folder, name, rows):
    Path(folder).mkdir(parents=True, exist_ok=True)
    Path(folder, name).write_text("".join(r if isinstance(r, str) else json.dumps(r) + "\n" for r in rows))


def text_reader(folder, per_batch=1):
    return lambda spark, options: spark.readStream.option("maxFilesPerTrigger", per_batch).text(folder)


def topic(spark, folder, per_batch=1):
    return kafka_stream(spark, {"brokers": "x:1", "topic": "t"}, text_reader(folder, per_batch))


def test_triggers():
    assert trigger_options(None) == {"availableNow": True}
    assert trigger_options("5 seconds") == {"processingTime": "5 seconds"}


def test_restart_neither_loses_nor_repeats(spark, place):
    src, out, check = place + "/src", place + "/out", place + "/check"
    add(spark, src, events(spark, 0, 50))
    drain(to_parquet(parquet_stream(spark, src, 1), out, check))
    assert spark.read.parquet(out).count() == 50
    add(spark, src, events(spark, 50, 80))
    drain(to_parquet(parquet_stream(spark, src, 1), out, check))
    drain(to_parquet(parquet_stream(spark, src, 1), out, check))
    ids = [r["id"] for r in spark.read.parquet(out).select("id").collect()]
    assert sorted(ids) == list(range(80))


def test_failed_batch_is_replayed_once(spark, place):
    """The batch is written, then the query dies before Spark can commit it; it runs again."""
    src, root, check = place + "/src", place + "/t", place + "/check"
    add(spark, src, events(spark, 0, 30))

    def crash(batch, load_id):
        LandedTable(batch.sparkSession, root).append(batch, load_id)
        raise RuntimeError("lost after the write")

    with pytest.raises(Exception, match="lost after the write"):
        drain(each_batch(parquet_stream(spark, src), crash, check, "replay"))
    drain(to_landed(parquet_stream(spark, src), root, check, "replay"))
    table = LandedTable(spark, root)
    assert table.read().count() == 30 and table.loads().count() == 1


def test_stream_of_several_loads_equals_the_batch(spark, place):
    src, root, check = place + "/src", place + "/t", place + "/check"
    for part in range(4):
        add(spark, src, events(spark, part * 10, part * 10 + 10))
    drain(to_landed(parquet_stream(spark, src, 1), root, check, "loads", ["k"]))
    table = LandedTable(spark, root)
    assert table.loads().count() == 4
    expected = sorted(map(tuple, spark.read.parquet(src).collect()))
    assert sorted(map(tuple, table.read().select("id", "ts", "v", "k").collect())) == expected


def test_a_running_stream_picks_up_new_files_until_stopped(spark, place):
    src, root = place + "/src", place + "/t"
    add(spark, src, events(spark, 0, 10))
    query = to_landed(parquet_stream(spark, src), root, place + "/check", "running", every="1 second")
    try:
        query.processAllAvailable()
        add(spark, src, events(spark, 10, 25))
        query.processAllAvailable()
        assert query.isActive
    finally:
        query.stop()
    assert LandedTable(spark, root).read().count() == 25


def test_a_new_checkpoint_keeps_earlier_loads(spark, place):
    root = place + "/t"
    for part, (first, last) in enumerate(((0, 10), (10, 25))):
        add(spark, f"{place}/src{part}", events(spark, first, last))
        drain(to_landed(parquet_stream(spark, f"{place}/src{part}"), root, f"{place}/check{part}", "same"))
    assert sorted(r["id"] for r in LandedTable(spark, root).read().collect()) == list(range(25))


def test_updates_of_a_stream_begun_anew_are_newer(spark, place):
    src, out = place + "/src", place + "/out"
    for part in range(3):
        add(spark, src, events(spark, part * 4, part * 4 + 4))
        drain(to_updates(window_stats(parquet_stream(spark, src), "ts", "v", "1 day"), out, place + "/one"))
    add(spark, src, events(spark, 12, 16))
    drain(to_updates(window_stats(parquet_stream(spark, src), "ts", "v", "1 day"), out, place + "/two"))
    assert latest_updates(spark.read.parquet(out), ["window_start"]).first()["data_points"] == 16


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def test_windows_over_a_stream_equal_the_table(spark, place):
    src, out, check = place + "/src", place + "/out", place + "/check"
    for part in range(3):
        add(spark, src, events(spark, part * 20, part * 20 + 20))
    stats = dict(time="ts", value="v", width="1 hour", keys=["k"])
    drain(to_updates(window_stats(parquet_stream(spark, src, 1), late_by="1 hour", **stats), out, check))
    final = latest_updates(spark.read.parquet(out), ["window_start", "k"])
    table = window_stats(spark.read.parquet(src), **stats)
    assert rows_of(final.select(table.columns)) == rows_of(table)


def test_window_edges(spark):
    rows = [(dt.datetime(2024, 1, 1, 0, 59, 59), 1.0), (dt.datetime(2024, 1, 1, 1), 2.0)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, v double")
    out = window_stats(df, "ts", "v", "1 hour").orderBy("window_start").collect()
    assert [(r["window_start"].hour, r["data_points"], r["avg_value"]) for r in out] == [(0, 1, 1.0), (1, 1, 2.0)]
    assert window_stats(df, "ts", "v", "1 day").first()["data_points"] == 2


def test_rows_within_the_watermark_count_and_later_ones_do_not(spark, place):
    src, out, check = place + "/src", place + "/out", place + "/check"

    def run(*rows):
        df = spark.createDataFrame(
            [(START + dt.timedelta(hours=h), 1.0) for h in rows], "ts timestamp_ntz, v double"
        ).coalesce(1)
        add(spark, src, df)
        query = to_updates(window_stats(parquet_stream(spark, src), "ts", "v", "1 hour", late_by="2 hours"), out, check)
        drain(query)

    run(0.0, 10.0)
    run(9.5)
    run(1.0)
    counts = {
        r["window_start"].hour: r["data_points"]
        for r in latest_updates(spark.read.parquet(out), ["window_start"]).collect()
    }
    assert counts == {0: 1, 10: 1, 9: 1}
    # a stateless sink has no such policy: every row is kept
    drain(to_parquet(parquet_stream(spark, src), place + "/all", place + "/check2"))
    assert spark.read.parquet(place + "/all").count() == 4


def test_count_windows_evaluate_sql_per_group_of_files(spark, place):
    src, out = place + "/src", place + "/out"
    for part in range(5):
        add(spark, src, events(spark, part * 4, part * 4 + 4))

    def evaluate(batch, load_id):
        ranked = sql_transform(batch, "SELECT id, ROW_NUMBER() OVER (ORDER BY id) AS rn, COUNT(*) OVER () AS n FROM input_data")
        ranked.write.mode("overwrite").parquet(f"{out}/load_id={load_id}")

    drain(each_batch(parquet_stream(spark, src, 2), evaluate, place + "/check", "w"))
    rows = spark.read.parquet(out).collect()
    assert len(rows) == 20 and sorted({r["n"] for r in rows}) == [4, 8] and max(r["rn"] for r in rows) == 8


# Staged evolution: fields appear one after the other, then a type widens

STAGES = [
    [{"id": 1, "name": "a", "type": "t", "value": 1}],
    [{"id": 2, "name": "b", "type": "t", "value": 2, "timestamp": "2024-01-01T00:00:00Z"}],
    [{"id": 3, "name": "c", "type": "t", "value": 3, "metadata": {"k": [1]}}],
    [{"id": 4, "name": "d", "type": "t", "value": 4, "tags": ["x", "y"]}],
    [{"id": 5, "name": "e", "type": "t", "value": 5, "is_processed": True}],
    [{"id": 6, "name": "f", "type": "t", "value": 6.5, "score": 0.5}, "broken\n"],
    [{"id": 7, "name": "g", "type": "t", "value": 7, "new_field": None}],
]


def test_topic_to_table_evolves_stage_by_stage(spark, place):
    src = place + "/topic"
    loader = TopicTable(place + "/t", evolve=True, sql="SELECT *, id % 2 AS side FROM input_data WHERE id <> 4", partition_by=["side"])
    for i, stage in enumerate(STAGES):
        lines(src, f"{i}.json", stage)
        drain(loader.start(topic(spark, src), place + "/check", "staged"))
    table = LandedTable(spark, loader.root)
    rows = {r["id"]: r for r in table.read().collect()}
    assert set(rows) == {1, 2, 3, 5, 6, 7}
    assert rows[3]["metadata"] == '{"k":[1]}' and rows[5]["is_processed"] is True
    assert rows[6]["value"] == 6.5 and rows[1]["value"] == 1.0 and rows[1]["score"] is None
    assert len(table.schemas.versions()) == 6
    assert {f.name for f in table.schema().fields} >= {"timestamp", "metadata", "score", "new_field", "side"}


def test_fields_once_seen_stay_for_sparse_batches(spark, place):
    src = place + "/topic"
    loader = TopicTable(place + "/t", evolve=True, sql="SELECT id, price * 2 AS twice FROM input_data")
    for i, message in enumerate(({"id": 1, "price": 1.5}, {"id": 2}, {"id": 3, "price": 4})):
        lines(src, f"{i}.json", [message])
        drain(loader.start(topic(spark, src), place + "/check", "sparse"))
    rows = LandedTable(spark, loader.root).read().orderBy("id").collect()
    assert [(r["id"], r["twice"]) for r in rows] == [(1, 3.0), (2, None), (3, 8.0)]


def test_topic_needs_a_schema(spark):
    df = spark.createDataFrame([('{"a":1}',)], "value string")
    with pytest.raises(ValueError, match="no schema available"):
        parse_messages(df, {"auto_infer": False})
    assert parse_messages(df, None).columns == ["a"]
    fixed = {"fields": [{"name": "a", "data_type": "string"}]}
    assert parse_messages(df, fixed).first()["a"] == "1"


def test_dead_letters_are_kept_with_a_reason(spark, place):
    lines(place + "/topic", "0.json", ['{"a":\n', "[1]\n", {"a": 1}])
    loader = TopicTable(place + "/t", dead_letters=place + "/dead")
    for _ in range(2):
        drain(loader.start(topic(spark, place + "/topic"), place + "/check", "dead"))
    dead = spark.read.json(place + "/dead").collect()
    assert {(r["value"], r["reason"]) for r in dead} == {('{"a":', "malformed"), ("[1]", "not an object")}
    assert LandedTable(spark, loader.root).read().count() == 1


def test_topic_skips_batches_without_rows(spark, place):
    lines(place + "/topic", "0.json", ["broken\n"])
    lines(place + "/topic", "1.json", [{"a": 1}])
    loader = TopicTable(place + "/t", sql="SELECT * FROM input_data WHERE a > 5")
    drain(loader.start(topic(spark, place + "/topic"), place + "/check", "empty"))
    assert LandedTable(spark, loader.root).schemas.versions() == []


def test_console_stream(spark, place):
    add(spark, place + "/src", events(spark, 0, 3))
    query = drain(stdout_stream(parquet_stream(spark, place + "/src").select(F.col("id")), place + "/check"))
    assert query.lastProgress["numInputRows"] == 3 and "Console" in query.lastProgress["sink"]["description"]


def test_windows_of_batches_and_marks(spark, place):
    """A mark in the stream closes a window early; a crash between write and close repeats the window."""
    src, check, out = place + "/src", place + "/check", LandedTable(spark, place + "/out")
    seen = []

    def write(rows, load):
        seen.append((load.rsplit("-", 1)[1], sorted(r["id"] for r in rows.collect())))
        LandedTable(rows.sparkSession, out.root).append(rows.groupBy().agg(F.count(F.lit(1)).alias("n")), load)

    def batch(first, last):
        add(spark, src, events(spark, first, last))
        return drain(each_window(parquet_stream(spark, src), write, check, "w", 3, closes=F.col("id") == 6))

    for first, last in ((0, 2), (2, 4), (4, 5), (5, 7), (7, 9)):
        query = batch(first, last)
    assert seen == [("000000000000", [0, 1, 2, 3, 4]), ("000000000003", [5, 6])]
    for _ in range(2):
        close_window(query, spark, write, check, "w", 3)
    assert seen[2:] == [("000000000004", [7, 8])]
    assert sorted(r["n"] for r in out.read().collect()) == [2, 2, 5]
    assert len(list(Path(check, "windows/rows").glob("number=*"))) <= 2  # batches of closed windows go
    batch(9, 10)
    assert batch(10, 11) and seen[3:] == []


def test_late_rows_are_kept_and_counted(spark, place):
    src, check = place + "/src", place + "/check"
    parts = {k: LandedTable(spark, f"{place}/{k}") for k in ("now", "late")}

    def run(crash=False):
        def late(rows, load):
            LandedTable(rows.sparkSession, parts["late"].root).append(rows, load)
            if crash:
                raise RuntimeError("lost after the write")

        now = lambda rows, load: LandedTable(rows.sparkSession, parts["now"].root).append(rows, load)
        drain(part_late(parquet_stream(spark, src), "ts", "2 hours", now, late, check, "parted"))

    def rows(*hours):
        data = [(h, None if h is None else START + dt.timedelta(hours=h)) for h in hours]
        add(spark, src, spark.createDataFrame(data, "h int, ts timestamp_ntz").coalesce(1))

    rows(5, 0, None)  # one batch: only the row without a time is late
    run()
    rows(3, 2, 9)  # the first is at the limit of two hours before 5
    with pytest.raises(Exception, match="lost after the write"):
        run(crash=True)
    run()
    rows(8, 6)
    run()
    read = lambda k: [r["h"] for r in parts[k].read().orderBy("h").collect()]
    assert read("now") == [0, 3, 5, 8, 9] and read("late") == [None, 2, 6]
    log = [(r["batch"], r["newest"].hour, r["rows"], r["late"]) for r in late_log(spark, check).orderBy("batch").collect()]
    assert log == [(0, 5, 3, 1), (1, 9, 3, 1), (2, 9, 2, 1)]


@pytest.mark.parametrize("wait, hours", [(True, [0, 1]), (False, [0, 1, 2, 3])])
def test_windows_of_two_sources_close_when_both_have_passed(spark, place, wait, hours):
    def stream(name, *at):
        rows = [(START + dt.timedelta(hours=h), 1.0) for h in at]
        add(spark, f"{place}/{name}", spark.createDataFrame(rows, "ts timestamp_ntz, v double").coalesce(1))
        return parquet_stream(spark, f"{place}/{name}")

    streams = {"fast": stream("fast", 0, 1, 2, 3, 5), "slow": stream("slow", 0, 3)}
    closed = joint_window_stats(streams, "ts", "v", "1 hour", "1 hour", wait_for_idle=wait)
    drain(to_parquet(closed, place + "/out", place + "/check"))
    got = spark.read.schema(closed.schema).parquet(place + "/out")
    assert sorted(r["window_start"].hour for r in got.where("source = 'fast'").collect()) == hours
    spark.conf.unset("spark.sql.streaming.multipleWatermarkPolicy")


def test_messages_without_a_schema(spark, place):
    landed = VariantTable(spark, place)
    text = lambda *rows: spark.createDataFrame([(r,) for r in rows], "value string")
    landed.load(text('{"a": 1, "b": "x"}', "not json", "[1]", None), "one")
    landed.load(text('{"a": 2.5, "it\'s": true}'), "two")
    landed.load(text('{"a": "odd", "c": {"d": [1, {"e": null}]}, "b": 7}'), "three")
    landed.load(text('{"a": 2.5, "it\'s": true}'), "two")  # a replay
    schema = landed.schema()
    assert {f.name: f.dataType.simpleString() for f in schema.fields} == {"a": "double", "b": "string", "it's": "boolean", "c": "string"}
    got = sorted(map(tuple, landed.typed().select("a", "b", "it's", "c").collect()), key=str)
    assert got == [(1.0, "x", None, None), (2.5, None, True, None), (None, "7", None, '{"d":[1,{"e":null}]}')]
    assert sorted(r["rejected"] or "" for r in landed.rejects().collect()) == ["", "[1]", "not json"]
    whole = landed.typed(landed.schema(keep_objects=True)).where("c is not null").first()
    assert whole["c"]["d"] is not None
